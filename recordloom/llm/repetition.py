"""Quality rules by repetition: how much of a text lies in repeated n-grams and lines.

Rolling hashes of word n-grams, for all documents of a slice at once in numpy, find the
occurrences after the first of every n-gram; the code points they cover, each counted
once, are set against those of all words. The same for lines. A longer n-gram can repeat
only where the shortest does, so only those places are hashed again.

Defined results: a null or blank text has no words, fails the base rule and is not
kept. Rows that repeat stay. Words, lines and n-grams are compared as they are written.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.text import Words, buffers, mix, ngrams, rows_that, slices, span_hashes, utf8, whole

#: Largest share of characters in repeated n-grams, by the words of the n-gram.
COVERAGE = {5: 0.15, 6: 0.14, 7: 0.13, 8: 0.12, 9: 0.11, 10: 0.10}
#: Largest share of characters in repeated lines.
LINE_COVERAGE = 0.20
#: Base rule: at least so many words, and at most so many of 100 in repeated 5-word windows.
LEAST_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
SYMBOLS = b"#*$%&|<>"

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, line_share double, " + ", ".join(f"share_{n} double" for n in COVERAGE)
)


def _later(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places whose key occurred before, and all places whose key occurs more than once."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    later = order[1:][same]
    return later, np.union1d(later, order[:-1][same])


def _covered(places: np.ndarray, n: int, count: int) -> np.ndarray:
    """Which of ``count`` words lie in an ``n``-word window that starts at one of the places."""
    steps = np.zeros(count + 1, np.int64)
    steps[places] = 1
    ends = np.zeros(count + 1, np.int64)
    ends[places + n] = 1
    return np.cumsum(steps - ends)[:count] > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The counts and shares of each document of a slice."""
    words = Words(data, offsets)
    docs = len(offsets) - 1

    def per_doc(values: np.ndarray, doc: np.ndarray) -> np.ndarray:
        return np.bincount(doc, weights=values, minlength=docs).astype(np.int64)

    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    chars = points[words.end] - points[words.start]
    out = {"n_words": words.counts().astype(np.int64), "word_chars": per_doc(chars, words.doc)}
    symbols = np.concatenate([[0], np.cumsum(np.isin(data, np.frombuffer(SYMBOLS, np.uint8)))])
    out["n_symbols"] = symbols[offsets[1:]] - symbols[offsets[:-1]]

    hashes = span_hashes(data, words.start, words.end)
    own = mix(np.arange(docs, dtype=np.uint64) + np.uint64(1))  # tells documents apart

    def keys(n: int, places: np.ndarray) -> np.ndarray:
        return mix(ngrams(hashes, n)[places] ^ own[words.doc[places]])

    total = np.maximum(out["word_chars"], 1)
    base = np.flatnonzero(whole(words, REPEAT_WINDOW))
    _, repeated = _later(keys(REPEAT_WINDOW, base))
    repeated = base[repeated]
    inside = _covered(repeated, REPEAT_WINDOW, len(words))
    out["n_repeat_words"] = per_doc(inside, words.doc)
    for n in COVERAGE:
        least = repeated if n >= REPEAT_WINDOW else np.arange(max(0, len(words) - n + 1))
        starts = least[least + n <= len(words)]
        starts = starts[whole(words, n)[starts]]
        later, _ = _later(keys(n, starts)) if len(starts) else (starts, starts)
        covered = _covered(starts[later], n, len(words))
        out[f"share_{n}"] = per_doc(chars * covered, words.doc) / total

    breaks = np.flatnonzero(data == 10)
    line_start = np.union1d(offsets[:-1][np.diff(offsets) > 0], (breaks + 1)[~np.isin(breaks + 1, offsets)])
    line_end = np.minimum(
        np.append(breaks, len(data))[np.searchsorted(breaks, line_start)],
        offsets[np.searchsorted(offsets, line_start, side="right")],
    )
    in_words = np.concatenate([[0], np.cumsum(chars)])
    first, last = np.searchsorted(words.start, line_start), np.searchsorted(words.start, line_end)
    some = last > first
    line_start, line_end, first, last = line_start[some], line_end[some], first[some], last[some]
    line_doc = np.searchsorted(offsets, line_start, side="right") - 1
    later, _ = _later(mix(span_hashes(data, line_start, line_end) ^ own[line_doc]))
    out["n_dup_lines"] = np.bincount(line_doc[later], minlength=docs).astype(np.int64)
    out["line_share"] = per_doc((in_words[last] - in_words[first])[later], line_doc[later]) / total

    out["base_failed"] = (out["n_words"] < LEAST_WORDS) | (100 * out["n_repeat_words"] > REPEAT_PERCENT * out["n_words"])
    within = out["line_share"] <= LINE_COVERAGE
    for n, most in COVERAGE.items():
        within &= out[f"share_{n}"] <= most
    out["kept"] = ~out["base_failed"] & within
    return out


def score(docs: DataFrame) -> DataFrame:
    """``doc_id`` with every count and share, the base rule and the verdict ``kept``."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))
    names = [field.split()[0] for field in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            found = measure(*buffers(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[n]) for n in names[1:])], names)

    return plain.mapInArrow(run, SCHEMA)


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text passes, with their columns."""
    return rows_that(docs, lambda texts: measure(*buffers(texts))["kept"])
