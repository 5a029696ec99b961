"""SentencePiece encoding and decoding that keeps offsets into the original text.

A text is normalised by the model's compiled character map, a double-array trie: at each
place the longest prefix that the map knows is replaced, else one character goes over as it
is. Every normalised byte remembers the source byte its replacement began at. Byte-pair
merges then find the pieces, and a piece's ends in the normalised text give its span of the
original bytes.

Merges never cross the start of a run of spaces if no piece has a space after another
character, which is looked up in the model; texts are then cut there into segments,
equal segments of a slice are found by their hashes (and compared byte by byte), and the ids of
segments are kept between slices. New segments of up to ``SHORT`` characters are rows of one
numpy matrix, each round merging one pair of every row; longer ones use a heap.

Defined results: a null text is empty; an empty one has only the begin and end ids. Texts over
``PART`` bytes are worked on in parts that end before a space between two letters or digits,
which changes nothing (where the map has no rule across such a place, else they stay whole).
Bytes that are not UTF-8 count as U+FFFD each. Models of other kinds than byte-pair encoding, or
with user-defined or unused pieces, suffix spaces or a denormaliser, are errors. Rows that
repeat, null ids and other columns are as any others; an empty table gives an empty result.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.text import alike, buffers, slices, utf8
from recordloom.sources.workers import ship_package

#: Bytes of a text worked on at once; characters of a row of the merging matrix.
PART, SHORT = 1 << 20, 32
#: Segments kept by a worker, and the bytes of the longest kept.
KEPT_SEGMENTS, KEPT_BYTES = 300_000, 64
SPACE, MARK = 0x20, b"\xe2\x96\x81"
NONE = np.int32(2**31 - 1)

# Numbers of fields and kinds of pieces in the public model format.
PIECES, TRAINER, NORMALIZER, DENORMALIZER = 1, 2, 3, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2

codecs.register_error("each_byte", lambda error: ("�", error.start + 1))
_models: dict[bytes, Model] = {}


def message(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a protocol buffer's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: a trie over bytes, and the texts its values point to."""

    def __init__(self, compiled: bytes):
        (size,) = struct.unpack("<I", compiled[:4])
        self.units = np.frombuffer(compiled[4 : 4 + size], "<u4").astype(np.int64)
        self.texts = np.frombuffer(compiled[4 + size :], np.uint8)
        ends = np.flatnonzero(self.texts == 0)
        self._ends = np.append(ends, len(self.texts))

    @staticmethod
    def _offset(unit: np.ndarray) -> np.ndarray:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: np.ndarray, at: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each place the bytes of the longest known prefix (0: none), and its value."""
        length, value = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        node = np.full(len(at), self._offset(self.units[:1])[0])
        some, step = np.arange(len(at)), 0
        while len(some):
            some = some[at[some] + step < limit[some]]
            byte = data[at[some] + step].astype(np.int64)
            place = node[some] ^ byte
            inside = place < len(self.units)
            some, byte, place = some[inside], byte[inside], place[inside]
            unit = self.units[place]
            known = (unit & 0x800000FF) == byte
            some, unit, place = some[known], unit[known], place[known]
            node[some] = place ^ self._offset(unit)
            step += 1
            leaf = (unit >> 8 & 1) == 1
            length[some[leaf]] = step
            value[some[leaf]] = self.units[node[some[leaf]]] & 0x7FFFFFFF
        return length, value

    def size(self, value: np.ndarray) -> np.ndarray:
        """Bytes of the texts at these values."""
        return self._ends[np.searchsorted(self._ends, value)] - value

    def crosses_spaces(self) -> bool:
        """Whether a rule has a space next to a letter or digit, or may have."""
        plain = [c for c in range(128) if chr(c).isalnum()]
        pairs = [(c, SPACE) for c in plain] + [(SPACE, c) for c in plain]
        for pair in pairs:
            node = int(self._offset(self.units[:1])[0])
            for byte in pair:
                unit = int(self.units[node ^ byte]) if node ^ byte < len(self.units) else -1
                if unit < 0 or unit & 0x800000FF != byte:
                    break
                node ^= byte ^ int(self._offset(np.int64(unit)))
            else:
                return True
        return False


class Normalizer:
    """Texts to normalised texts with the source place of every byte.

    Inside, a space symbol is the byte 0x20, which no normalised text has otherwise.
    """

    def __init__(self, compiled: bytes = b"", dummy_prefix: bool = True, remove_extra: bool = True):
        self.map = CharacterMap(compiled) if compiled else None
        self.dummy_prefix, self.remove_extra = dummy_prefix, remove_extra
        self.cuts = self.map is None or not self.map.crosses_spaces()

    def __call__(self, data: np.ndarray, offsets: np.ndarray, head: np.ndarray, tail: np.ndarray):
        """Normalised bytes, their offsets, the source place of each and the place after each text.

        ``head`` and ``tail``: whether a text is the start and the end of its document. Places count
        from the start of ``data``.
        """
        start = np.flatnonzero((data & 0xC0) != 0x80)
        step = np.diff(np.append(start, len(data)))
        text = np.searchsorted(offsets, start, side="right") - 1
        length, pool, source = step, data, start
        if self.map is not None and len(start):
            known, value = self.map.longest(data, start, offsets[text + 1])
            taken = known > 0
            reached = np.ones(len(start), bool)
            over = 0
            for i in np.flatnonzero(known > step).tolist():  # rules of several characters
                if start[i] >= over:
                    over = start[i] + known[i]
                    reached[i + 1 : np.searchsorted(start, over)] = False
            step = np.where(taken, known, step)
            length = np.where(taken, self.map.size(value), step)
            source = np.where(taken, len(data) + value, start)
            pool = np.concatenate([data, self.map.texts])
            start, text, length, source = start[reached], text[reached], length[reached], source[reached]
        ends = np.cumsum(length)
        chunk = np.repeat(np.arange(len(start)), length)
        out = pool[np.arange(len(chunk)) + np.repeat(source - (ends - length), length)]
        place, text_of = start[chunk], text[chunk]
        begins = np.ones(len(offsets) - 1, bool)
        if self.remove_extra:
            space = out == SPACE
            alone = (length == 1) & (np.append(out, 0)[ends - length] == SPACE)
            begins = np.bincount(text[~alone], minlength=len(begins)) > 0
            # spaces that start their replacement go if a space, or nothing, is before that
            first = np.zeros(len(out), bool)
            first[(ends - length)[length > 0]] = True
            new = np.ones(len(out), bool)
            new[1:] = text_of[1:] != text_of[:-1]
            behind = np.zeros(len(out), bool)
            behind[1:] = space[:-1]
            behind = np.where(new, head[text_of], behind)
            run = np.maximum.accumulate(np.where(~space | first, np.arange(len(out)), 0))
            kept = ~(space & space[run] & first[run] & behind[run])
            out, place, text_of = out[kept], place[kept], text_of[kept]
        mark = np.flatnonzero(out[:-2] == MARK[0])
        mark = mark[(out[mark + 1] == MARK[1]) & (out[mark + 2] == MARK[2])]
        if len(mark):
            out[mark] = SPACE
            kept = np.ones(len(out), bool)
            kept[np.concatenate([mark + 1, mark + 2])] = False
            out, place, text_of = out[kept], place[kept], text_of[kept]
        after = offsets[1:].copy()
        if self.dummy_prefix:
            put = np.flatnonzero(head & (np.diff(offsets) > 0) & begins)
            at = np.searchsorted(text_of, put)
            where = offsets[put].copy()
            if self.remove_extra:  # the prefix stands where the spaces before the text end
                where = start[~alone][np.searchsorted(text[~alone], put)]
            out, place, text_of = np.insert(out, at, SPACE), np.insert(place, at, where), np.insert(text_of, at, put)
        if self.remove_extra and len(out):
            run = np.maximum.accumulate(np.where(out != SPACE, np.arange(len(out)), -1))
            last = np.searchsorted(text_of, np.arange(len(offsets) - 1), side="right") - 1
            first = np.searchsorted(text_of, np.arange(len(offsets) - 1))
            kept = np.ones(len(out), bool)
            for i in np.flatnonzero(tail & (last >= first)).tolist():
                solid = max(int(run[last[i]]) + 1, int(first[i]))
                if solid <= last[i]:
                    after[i] = place[solid]
                    kept[solid : last[i] + 1] = False
            out, place, text_of = out[kept], place[kept], text_of[kept]
        return out, np.searchsorted(text_of, np.arange(len(offsets))), place, after


class Model:
    """``data``: the bytes of a model file."""

    def __init__(self, data: bytes):
        pieces, normalizer, trainer = [], {}, {}
        for number, value in message(data):
            if number == PIECES:
                fields = dict(message(value))
                score = struct.unpack("<f", fields.get(2, b"\0\0\0\0"))[0]
                pieces.append((fields.get(1, b""), score, fields.get(3, NORMAL)))
            elif number == NORMALIZER:
                normalizer = dict(message(value))
            elif number == TRAINER:
                trainer = dict(message(value))
            elif number == DENORMALIZER and dict(message(value)).get(2):
                raise ValueError("models with a denormaliser are not supported")
        kinds = np.array([kind for *_, kind in pieces])
        if trainer.get(3, 1) != BPE or trainer.get(24) or not normalizer.get(5, 1):
            raise ValueError("only byte-pair models with the space symbol before words are supported")
        if np.isin(kinds, (USER_DEFINED, UNUSED)).any():
            raise ValueError("user-defined and unused pieces are not supported")
        self.normalizer = Normalizer(
            normalizer.get(2, b""), bool(normalizer.get(3, 1)), bool(normalizer.get(4, 1))
        )
        self.strips = self.normalizer.dummy_prefix or self.normalizer.remove_extra
        ids = {piece: i for i, (piece, _, kind) in enumerate(pieces) if kind != UNKNOWN}
        self.begin, self.end = ids.get(trainer.get(46, b"<s>"), -1), ids.get(trainer.get(47, b"</s>"), -1)
        self.unknown = int(np.flatnonzero(kinds == UNKNOWN)[0])
        self.count = len(pieces)
        self.bytes = None
        if trainer.get(35):
            self.bytes = np.array([ids[b"<0x%02X>" % b] for b in range(256)], np.int64)

        words = {piece.replace(MARK, b" "): (i, score) for i, (piece, score, kind) in enumerate(pieces) if kind == NORMAL and b" " not in piece}
        texts = {word.decode(): found for word, found in words.items()}
        self.cuts = not any(a != " " and b == " " for word in texts for a, b in zip(word, word[1:]))
        self.symbol = np.arange(0x110000, dtype=np.int64) + self.count  # characters that are no pieces
        for word, (i, _) in texts.items():
            if len(word) == 1:
                self.symbol[ord(word)] = i
        ranks = {score: rank for rank, score in enumerate(sorted({score for _, score in words.values()}, reverse=True))}
        pairs = {}
        for word, (i, score) in texts.items():
            for cut in range(1, len(word)):
                left, right = (self._symbol_of(part, texts) for part in (word[:cut], word[cut:]))
                if left is not None and right is not None:
                    pairs[left << 32 | right] = (ranks[score], i)
        self._keys = np.array(sorted(pairs), np.int64)
        self._ranks = np.array([pairs[k][0] for k in self._keys.tolist()], np.int32)
        self._merged = np.array([pairs[k][1] for k in self._keys.tolist()], np.int64)
        self.pairs = pairs

        self.is_control = kinds == CONTROL
        self.is_byte = kinds == BYTE
        #: bytes of a piece in the normalised text, where a space symbol is one byte
        self.length = np.array([len(p.replace(MARK, b" ")) for p, *_ in pieces], np.int64)
        self.length[self.is_byte] = 1
        surface = {NORMAL: lambda p: p.replace(MARK, b" "), BYTE: lambda p: bytes([int(p[3:5], 16)])}
        unknown = trainer.get(44, " ⁇ ".encode())
        shown = [surface[k](p) if k in surface else unknown if k == UNKNOWN else b"" for p, _, k in pieces]
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_size = np.array([len(s) for s in shown], np.int64)
        self.shown_start = np.cumsum(self.shown_size) - self.shown_size
        self.opens = np.array([s[:1] == b" " for s in shown]) & (kinds == NORMAL)
        self.kept: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    @staticmethod
    def of(data: bytes) -> Model:
        """One model for each file and worker."""
        name = hashlib.sha256(data).digest()
        if name not in _models:
            _models[name] = Model(data)
        return _models[name]

    def _symbol_of(self, part: str, texts: dict) -> int | None:
        if part in texts:
            return texts[part][0]
        return int(self.symbol[ord(part)]) if len(part) == 1 else None

    # merging

    def _pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The place of each pair in the table of pairs, -1 for none."""
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), at, -1)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        at = self._pair(left, right)
        return np.where(at >= 0, self._ranks[at], NONE)

    def merge_rows(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of symbols, filled up with -1, merged as far as they go; rows and symbols, flat.

        In a round each row merges its first best pair, so all rows get shorter by one.
        """
        rows, done = np.arange(len(symbols)), []
        ranks = self._rank(symbols[:, :-1], symbols[:, 1:])
        while True:
            best = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(rows), np.int64)
            open_ = np.zeros(len(rows), bool) if not ranks.shape[1] else ranks[np.arange(len(rows)), best] < NONE
            if not open_.all():
                shut = symbols[~open_]
                r, c = np.nonzero(shut >= 0)
                done.append((rows[~open_][r], shut[r, c]))
                rows, symbols, ranks, best = rows[open_], symbols[open_], ranks[open_], best[open_]
            if not len(rows):
                break
            n, width = symbols.shape
            every = np.arange(n)
            merged = self._merged[self._pair(symbols[every, best], symbols[every, best + 1])]
            left = np.ones((n, width), bool)
            left[every, best + 1] = False
            symbols = symbols[left].reshape(n, width - 1)
            symbols[every, best] = merged
            left = np.ones((n, width - 1), bool)
            left[every, best] = False
            ranks = ranks[left].reshape(n, width - 2)
            if width > 2:
                some = np.flatnonzero(best > 0)
                ranks[some, best[some] - 1] = self._rank(symbols[some, best[some] - 1], merged[some])
                some = np.flatnonzero(best < width - 2)
                ranks[some, best[some]] = self._rank(merged[some], symbols[some, best[some] + 1])
        row, found = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(row, kind="stable")
        return row[order], found[order]

    def merge_long(self, symbols: list[int]) -> list[int]:
        """One row of any length, by a heap of its pairs."""
        pairs, n = self.pairs, len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def push(i: int, j: int) -> None:
            found = pairs.get(symbols[i] << 32 | symbols[j])
            if found is not None:
                heap.append((found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            push(i, i + 1)
        heapq.heapify(heap)
        while heap:
            _, i, left, right, merged = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != left or j >= n or symbols[j] != right:
                continue
            symbols[i], symbols[j] = merged, -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            fresh = len(heap)
            if before[i] >= 0:
                push(before[i], i)
            if after[i] < n:
                push(i, after[i])
            for entry in [heap.pop() for _ in range(len(heap) - fresh)]:
                heapq.heappush(heap, entry)
        return [s for s in symbols if s >= 0]

    def _ids(self, row: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids: characters that are no pieces become their bytes, or unknown."""
        strange = symbols >= self.count
        if self.bytes is None or not strange.any():
            return row, np.where(strange, self.unknown, symbols)
        code = np.where(strange, symbols - self.count, 0)
        size = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        ends = np.cumsum(size)
        out = np.repeat(symbols, size)
        for k in range(4):
            some = np.flatnonzero(strange & (size > k))
            rest = size[some] - 1 - k  # bytes that follow
            bits = code[some] >> 6 * rest
            lead = np.array([0, 0x00, 0xC0, 0xE0, 0xF0])[size[some]]
            out[ends[some] - size[some] + k] = self.bytes[(lead | bits) if k == 0 else (0x80 | bits & 0x3F)]
        return np.repeat(row, size), out

    def _learn(self, segments: list[bytes]) -> list[bytes]:
        """The ids (32-bit, as bytes) of new segments; a character that is unknown is one id."""
        texts = [s.decode() for s in segments]
        sizes = np.array([len(t) for t in texts])
        found: list[bytes] = [b""] * len(segments)
        at_most = 4
        while at_most <= SHORT:
            some = np.flatnonzero((sizes <= at_most) & ((sizes > at_most // 2) | (at_most == 4)))
            for part in np.array_split(some, -(-len(some) // 32_768) or 1):
                if not len(part):
                    continue
                joined = "".join([texts[i] for i in part.tolist()])
                code = np.frombuffer(joined.encode("utf-32-le"), "<u4")
                symbols = np.full((len(part), at_most), -1, np.int64)
                symbols[np.arange(at_most) < sizes[part][:, None]] = self.symbol[code]
                row, ids = self._ids(*self.merge_rows(symbols))
                ends = np.searchsorted(row, np.arange(len(part)), side="right") * 4
                raw, begin = ids.astype("<u4").tobytes(), 0
                for i, end in zip(part.tolist(), ends.tolist()):
                    found[i] = raw[begin:end]
                    begin = end
            at_most *= 2
        for i in np.flatnonzero(sizes > SHORT).tolist():
            code = np.frombuffer(texts[i].encode("utf-32-le"), "<u4")
            merged = np.array(self.merge_long(self.symbol[code].tolist()), np.int64)
            found[i] = self._ids(np.zeros(len(merged), np.int64), merged)[1].astype("<u4").tobytes()
        return found

    # encoding

    def _segments(self, norm: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Where segments start: texts, and runs of spaces in them."""
        new = np.zeros(len(norm) + 1, bool)
        if self.cuts:
            space = norm == SPACE
            new[1:-1] = space[1:] & ~space[:-1]
        new[offsets[:-1]] = True
        new[-1] = False
        return np.flatnonzero(new)

    def _looked_up(self, norm: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments, one after the other, and how many each has."""
        first, same = alike(norm, start, end)
        raw = norm.tobytes()
        names = [raw[a:b] for a, b in zip(start[first].tolist(), end[first].tolist())]
        if len(self.kept) > KEPT_SEGMENTS:
            self.kept, self.before = {}, self.kept
        kept, before = self.kept, self.before
        values = list(map(kept.get, names))
        missing = [i for i, value in enumerate(values) if value is None]
        new = []
        for i in missing:
            value = before.get(names[i])
            if value is None:
                new.append(i)
            else:
                values[i] = kept[names[i]] = value
        for i, value in zip(new, self._learn([names[i] for i in new]) if new else ()):
            values[i] = value
            if len(names[i]) <= KEPT_BYTES:
                kept[names[i]] = value
        count = np.array([len(v) for v in values], np.int64) // 4
        ids = np.frombuffer(b"".join(values), "<u4")
        begin = np.cumsum(count) - count
        counts = count[same]
        ends = np.cumsum(counts)
        return ids[np.arange(counts.sum()) + np.repeat(begin[same] - (ends - counts), counts)], counts

    def _encoded(self, data: np.ndarray, offsets: np.ndarray, head: np.ndarray, tail: np.ndarray):
        """Ids of the texts, how many each has, and the ends of their spans in ``data``."""
        norm, bounds, place, after = self.normalizer(data, offsets, head, tail)
        texts = len(offsets) - 1
        if not len(norm):
            none = np.zeros(0, np.int64)
            return none, np.zeros(texts, np.int64), none, none
        filled = np.append(np.flatnonzero(np.diff(bounds) > 0), texts)
        start = self._segments(norm, bounds[filled])
        end = np.append(start[1:], len(norm))
        ids, counts = self._looked_up(norm, start, end)
        ids = ids.astype(np.int64)
        size = self.length[ids]
        text = np.searchsorted(bounds, start, side="right") - 1
        text = np.repeat(text, counts)
        if self.bytes is None:
            size = self._sizes(ids, size, norm)
        stop = np.cumsum(size)
        begin = stop - size
        if self.bytes is None:  # neighbours that are unknown are one
            joined = np.zeros(len(ids), bool)
            joined[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown) & (text[1:] == text[:-1])
            last = np.append(~joined[1:], True)
            stop = stop[last]
            ids, begin, text = ids[~joined], begin[~joined], text[~joined]
        # the place after a text's last byte is the text's own end
        where = place[np.minimum(stop, len(place) - 1)]
        final = stop == bounds[text + 1]
        where = np.where(final, after[text], where)
        return ids, np.bincount(text, minlength=texts), place[begin], where

    def _sizes(self, ids: np.ndarray, size: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """Bytes of each id's text, where an unknown id stands for one character of any size."""
        size, at = size.copy(), 0
        lead = np.array([1] * 192 + [2] * 32 + [3] * 16 + [4] * 16)
        strange = np.flatnonzero(ids == self.unknown)
        moved = np.cumsum(np.where(ids == self.unknown, 0, size))
        for k, i in enumerate(strange.tolist()):
            size[i] = lead[norm[moved[i] + at]]
            at += size[i]
        return size

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each text its ids, begin and end among them, and the spans' begins and ends in it."""
        control = np.zeros(1, np.int64)
        for first, last, at in self._parts(data, offsets):
            found = []
            for a, b in zip(at[:-1], at[1:]):
                inner = offsets[first : last + 1] - a if last - first > 1 else np.array([0, b - a])
                one = np.ones(last - first, bool)
                head, tail = one & (a == offsets[first]), one & (b == offsets[last])
                found.append((a, *self._encoded(data[a:b], inner, head, tail)))
            if len(found) > 1:  # one document in several parts
                ids, begin, end = (np.concatenate([f[k] + (f[0] - at[0] if k > 2 else 0) for f in found]) for k in (1, 3, 4))
                counts = np.array([len(ids)])
            else:
                _, ids, counts, begin, end = found[0]
            base = offsets[first:last] - offsets[first]
            stops = np.cumsum(counts)
            for k, (x, y) in enumerate(zip((stops - counts).tolist(), stops.tolist())):
                size = offsets[first + k + 1] - offsets[first + k]
                yield (
                    np.concatenate([control + self.begin, ids[x:y], control + self.end]),
                    np.concatenate([control, begin[x:y] - base[k], control + size]),
                    np.concatenate([control, end[x:y] - base[k], control + size]),
                )

    def _parts(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
        """Texts in groups of about ``PART`` bytes, a longer one alone with the places where it is cut."""
        first, ends = 0, offsets.tolist()
        while first < len(ends) - 1:
            if ends[first + 1] - ends[first] > PART:
                last, at = first + 1, [ends[first]]
                while self.cuts and self.normalizer.cuts and ends[last] - at[-1] > PART:
                    cut = self._cut(data, at[-1] + PART, ends[last])
                    if cut == ends[last]:
                        break
                    at.append(cut)
                yield first, last, [*at, ends[last]]
            else:
                last = first + 1
                while last < len(ends) - 1 and ends[last + 1] - ends[first] <= PART:
                    last += 1
                yield first, last, [ends[first], ends[last]]
            first = last

    @staticmethod
    def _cut(data: np.ndarray, at: int, end: int) -> int:
        """The first space after ``at`` that is between two ASCII letters or digits, or the end."""
        while at < end:
            some = data[at : min(end, at + PART)]
            low = some | 0x20
            plain = (some < 128) & (((low >= 97) & (low <= 122)) | ((some >= 48) & (some <= 57)))
            found = np.flatnonzero((some[1:-1] == SPACE) & plain[:-2] & plain[2:])
            if len(found):
                return at + 1 + int(found[0])
            at += max(1, len(some) - 2)
            if len(some) < 3:
                break
        return end

    # decoding

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The text, as UTF-8, of each list of ids; ids outside the vocabulary are errors."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.count):
            raise ValueError("an id outside the vocabulary")
        size, start = self.shown_size[ids], self.shown_start[ids]
        if self.strips and len(ids):
            # the first piece with a text loses one leading space
            lone = self.opens[ids] & (size == 1) & self.normalizer.remove_extra
            text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
            loud = np.flatnonzero(~(self.is_control[ids] | lone))
            first = loud[np.unique(text[loud], return_index=True)[1]]
            limit = np.full(len(offsets) - 1, len(ids))
            limit[text[first]] = first
            size[lone & (np.arange(len(ids)) < limit[text])] = 0
            first = first[self.opens[ids[first]]]
            size[first] -= 1
            start[first] += 1
        ends = np.cumsum(size)
        out = self.shown[np.arange(size.sum()) + np.repeat(start - (ends - size), size)].tobytes()
        stops = np.append(0, ends)[offsets].tolist()
        texts = [out[a:b] for a, b in zip(stops[:-1], stops[1:])]
        if self.is_byte[ids].any():
            texts = [_valid(t) for t in texts]
        return texts


def _valid(raw: bytes) -> bytes:
    """Every byte that is not UTF-8 replaced."""
    try:
        raw.decode()
    except UnicodeDecodeError:
        return raw.decode(errors="each_byte").encode()
    return raw


def _texts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the batch's texts, all of them UTF-8."""
    data, offsets = buffers(batch.column("text"))
    try:
        data.tobytes().decode()
    except UnicodeDecodeError:
        texts = [_valid(t) for t in batch.column("text").to_pylist()]
        return buffers(pa.array(texts, pa.binary()))
    return data, offsets


def _plain(docs: DataFrame) -> DataFrame:
    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8(F.col("text").cast("string")).alias("text"))


def encode(docs: DataFrame, model: bytes) -> DataFrame:
    """``doc_id``, ``ids`` with the begin and end ids, and each id's span of the text's bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Model.of(model)
        for batch in slices(batches, "text", PART):
            ids, begins, ends = zip(*codec.encode(*_texts(batch)))
            columns = [pa.array(list(x), pa.list_(kind)) for x, kind in ((ids, pa.int32()), (begins, pa.int64()), (ends, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "ids", "begins", "ends"])

    return _plain(docs).mapInArrow(run, "doc_id long, ids array<int>, begins array<long>, ends array<long>")


def decode(encoded: DataFrame, model: bytes) -> DataFrame:
    """``doc_id`` and ``text`` of rows with ``ids``; null lists, and null ids in a list, are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Model.of(model)
        for batch in batches:
            lists = [[i for i in ids or () if i is not None] for ids in batch.column("ids").to_pylist()]
            offsets = np.cumsum([0, *map(len, lists)])
            flat = np.array([i for ids in lists for i in ids], np.int64)
            texts = [t.decode() for t in codec.decode(flat, offsets)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    plain = encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return plain.mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, model: bytes) -> DataFrame:
    """Encode and decode in one pass: the number of ids, and hashes of ids, spans and decoded text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, sha256 = Model.of(model), hashlib.sha256
        for batch in slices(batches, "text", PART):
            found = list(codec.encode(*_texts(batch)))
            offsets = np.cumsum([0, *(len(ids) for ids, *_ in found)])
            decoded = codec.decode(np.concatenate([ids for ids, *_ in found]), offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(np.diff(offsets)),
                    pa.array([sha256(ids.astype("<u4").tobytes()).hexdigest() for ids, *_ in found]),
                    pa.array([sha256(np.stack([a, b], 1).astype("<u4").tobytes()).hexdigest() for _, a, b in found]),
                    pa.array([sha256(text).hexdigest() for text in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "spans_sha256", "decoded_sha256"],
            )

    names = "doc_id long, n_tokens long, ids_sha256 string, spans_sha256 string, decoded_sha256 string"
    return _plain(docs).mapInArrow(run, names)
