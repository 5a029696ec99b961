"""Plain versions of the operators, one document after the other."""

import collections
import math
import re

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def fingerprint(text, n=4):
    words = WORD.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(values, near):
    """For each place the first place of its connected set."""
    root = list(range(len(values)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(values)):
        for b in range(a):
            if near(values[a], values[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(k) for k in range(len(values))]


def removed_words(docs, window):
    """docs: (id, text). The words, and the places removed, of each document."""
    order = lambda i: math.inf if i is None else i
    words = [WORD.findall(text or "") for _, text in docs]
    least = {}
    for (i, _), w in zip(docs, words):
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            least[key] = min(least.get(key, math.inf), order(i))
    gone = []
    for (i, _), w in zip(docs, words):
        out = set()
        for k in range(len(w) - window + 1):
            if least[tuple(w[k : k + window])] < order(i):
                out.update(range(k, k + window))
        gone.append(out)
    return words, gone


def repetition(text):
    text = text or ""
    words = WORD.findall(text)
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    counts = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    repeated = set()
    for k in range(len(words) - 4):
        if counts[tuple(words[k : k + 5])] > 1:
            repeated.update(range(k, k + 5))
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, again, len(repeated), failed


def coverage(text, n):
    words, seen, inside = WORD.findall(text or ""), set(), set()
    for k in range(len(words) - n + 1):
        gram = tuple(words[k : k + n])
        if gram in seen:
            inside.update(range(k, k + n))
        seen.add(gram)
    return sum(len(words[k]) for k in inside) / max(1, sum(map(len, words)))


def line_templates(docs, min_documents, similar, depth=3):
    """docs: (id, text), distinct. The kept texts."""
    order = lambda k: (docs[k][0] is None, docs[k][0])

    def mask(line):
        line = re.sub(r"[\t-\r ]+", " ", line).strip(" ")
        return re.sub(r"[^ ]*[0-9][^ ]*", "<*>", line)

    lines = [[] if text is None else text.split("\n") for _, text in docs]
    bodies = collections.defaultdict(set)
    for k, own in enumerate(lines):
        for line in own:
            if mask(line):
                bodies[mask(line)].add(k)
    leaves = collections.defaultdict(list)
    for body in bodies:
        tokens = body.split(" ")
        leaves[len(tokens), tuple(tokens[:depth])].append(body)
    template = {}
    for leaf, own in leaves.items():
        head = min(own, key=lambda b: (-len(bodies[b]), b)).split(" ")
        for body in own:
            same = sum(a == b for a, b in zip(body.split(" "), head))
            template[body] = leaf if same >= len(head) * similar else body
    holders = collections.defaultdict(set)
    for body, found in bodies.items():
        holders[template[body]] |= found
    keeper = {t: min(found, key=order) for t, found in holders.items() if len(found) >= min_documents}
    out = []
    for k, own in enumerate(lines):
        kept = [x for x in own if not mask(x) or keeper.get(template[mask(x)], k) == k]
        out.append(docs[k][1] if len(kept) == len(own) else "\n".join(kept))
    return out
