"""Token ids by the tokenizers library, with the ids of repeated pieces kept.

A text without two white spaces side by side can be cut before every space and around
every line break: a byte-level pre-tokenizer makes no token across such a cut. So
pieces are encoded once and looked up afterwards; new ones are encoded together,
each on a line of its own. All other texts are encoded whole.
"""

from __future__ import annotations

import hashlib
import os
import re

import numpy as np
import pyarrow as pa

from recordloom.llm.text import alike, buffers, span_hashes, unequal

#: Pieces kept by a worker: when there are so many, those not seen since the last time go.
KEPT_PIECES = 700_000
#: Bytes of text worked on at once: their arrays fit a core's cache.
SLICE_BYTES = 1 << 19
#: Pieces encoded as one text.
TOGETHER = 100

# White space but a leading space and a line break alone.
ODD = re.compile(r"[^\S \n]|[\x1c-\x1f]")
_encoders: dict[str, Encoder] = {}


class Encoder:
    """``tokenizer``: the text of a tokenizer's JSON file."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer)
        self.newline = self._ids("\n")
        self.kept, self.before = self._fresh(), Table()
        self.limit = KEPT_PIECES
        kind = type(self.tokenizer.pre_tokenizer).__name__
        self.cuts = (
            kind == "ByteLevel"
            and self.tokenizer.normalizer is None
            and len(self.newline) == 1
            and not self.tokenizer.pre_tokenizer.add_prefix_space
        )

    @staticmethod
    def of(tokenizer: str, limit: int | None = None) -> Encoder:
        """One encoder for each vocabulary and worker; ``limit`` to the pieces it keeps."""
        name = hashlib.sha256(tokenizer.encode()).hexdigest()
        if name not in _encoders:
            _encoders[name] = Encoder(tokenizer)
        _encoders[name].limit = limit or KEPT_PIECES
        return _encoders[name]

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def _fresh(self) -> Table:
        """A table that has the line break alone, which is never learned."""
        table, line = Table(), np.array([10], np.uint8)
        table.add(span_hashes(line, np.array([0]), np.array([1])), line, np.array([1]), self.newline, np.array([len(self.newline)]))
        return table

    def _learn(self, pieces: list[bytes], hashes: np.ndarray) -> None:
        """Keep the ids of pieces that are not kept."""
        parts = [pieces[at : at + TOGETHER] for at in range(0, len(pieces), TOGETHER)]
        ids, counts = [], []
        for at in range(0, len(parts), TOGETHER):  # the library's results are large, so not all at once
            some = parts[at : at + TOGETHER]
            joined = [b"\n".join(part).decode() for part in some]
            for part, found in zip(some, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)):
                own, count = self._apart(len(part), np.array(found.ids, "<u4"))
                ids.append(own)
                counts.append(count)
        texts = np.frombuffer(b"".join(pieces), np.uint8)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        self.kept.add(hashes, texts, sizes, np.concatenate(ids), np.concatenate(counts))

    def _apart(self, count: int, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``count`` pieces, which were encoded as lines of one text, and how many each has."""
        line = ids == self.newline[0]
        cuts = np.flatnonzero(line)
        if len(cuts) != count - 1:
            raise ValueError("the tokenizer does not keep line breaks apart")
        return ids[~line], np.diff(cuts, prepend=-1, append=len(ids)) - 1

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens."""
        return self.encode_utf8(*buffers(pa.array(texts, pa.large_string())))

    def encode_utf8(self, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
        """The ids of each text, given as bytes."""
        whole = whole_texts(data, offsets) if self.cuts else np.ones(len(offsets) - 1, bool)
        start, end, text = piece_spans(data, offsets, whole)
        hashes = span_hashes(data, start, end)
        first, same = alike(data, start, end, hashes)
        raw = data.tobytes()
        flat, begin, counts = self._found(raw, data, start[first], end[first], hashes[first])
        begin, counts = begin[same], counts[same]
        ids = flat[spread(begin, counts)]
        stops = np.cumsum(np.bincount(text, counts, len(whole)).astype(np.int64))
        out = np.split(ids, stops[:-1]) if len(stops) else []
        for k in np.flatnonzero(whole & (np.diff(offsets) > 0)).tolist():
            out[k] = self._ids(raw[offsets[k] : offsets[k + 1]].decode())
        return out

    def _found(
        self, raw: bytes, data: np.ndarray, start: np.ndarray, end: np.ndarray, hashes: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """An array of ids, and where each piece's ids begin in it and how many they are; new pieces are learned.

        ``raw`` are the bytes of ``data``.
        """
        if len(self.kept) > self.limit:
            self.kept, self.before = self._fresh(), self.kept
        number = self.kept.find(hashes, data, start, end)
        open_ = np.flatnonzero(number < 0)
        if len(open_):
            old = self.before.find(hashes[open_], data, start[open_], end[open_])
            was = old >= 0
            if was.any():
                self.kept.add(hashes[open_[was]], *self.before.rows(old[was]))
            new = open_[~was]
            if len(new):
                self._learn([raw[a:b] for a, b in zip(start[new].tolist(), end[new].tolist())], hashes[new])
            number[open_] = self.kept.find(hashes[open_], data, start[open_], end[open_])
        flat, begin, counts = self.kept.ids.values, self.kept.first.values[number], self.kept.counts.values[number].astype(np.int64)
        for k in np.flatnonzero(number < 0).tolist():  # another piece has the same hash
            own = self._ids(raw[start[k] : end[k]].decode())
            begin[k], counts[k] = len(flat), len(own)
            flat = np.concatenate([flat, own])
        return flat, begin, counts

    def _looked_up(self, names: list[bytes]) -> list[bytes]:
        """The ids of pieces given one by one, as bytes."""
        raw = b"".join(names)
        data, ends = np.frombuffer(raw, np.uint8), np.cumsum([len(name) for name in names])
        start = ends - [len(name) for name in names]
        flat, begin, counts = self._found(raw, data, start, ends, span_hashes(data, start, ends))
        return [flat[a : a + n].tobytes() for a, n in zip(begin.tolist(), counts.tolist())]


class Grown:
    """An array that grows at its end."""

    def __init__(self, kind):
        self._room, self._size = np.empty(1024, kind), 0

    def append(self, values: np.ndarray) -> None:
        size = self._size + len(values)
        if size > len(self._room):
            room = np.empty(max(size, 2 * len(self._room)), self._room.dtype)
            room[: self._size] = self.values
            self._room = room
        self._room[self._size : size] = values
        self._size = size

    @property
    def values(self) -> np.ndarray:
        return self._room[: self._size]


def spread(begin: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The places of all elements of stretches, one after the other."""
    ends = np.cumsum(counts)
    return np.arange(counts.sum()) + np.repeat(begin - (ends - counts), counts)


class Table:
    """Pieces of text with their ids, found by 64-bit hashes and then compared byte by byte.

    Of pieces that share a hash, the first is kept.
    """

    def __init__(self):
        self.slots = np.full(1 << 12, -1, np.int32)
        self.hashes, self.texts, self.ids = Grown(np.uint64), Grown(np.uint8), Grown("<u4")
        self.start, self.first, self.sizes, self.counts = (Grown(kind) for kind in (np.int64, np.int64, np.int32, np.int32))

    def __len__(self) -> int:
        return len(self.hashes.values)

    def __getitem__(self, piece: bytes) -> bytes:
        """The ids of one piece, as bytes."""
        data, start, end = np.frombuffer(piece, np.uint8), np.array([0]), np.array([len(piece)])
        number = self.find(span_hashes(data, start, end), data, start, end)
        if number[0] < 0:
            raise KeyError(piece)
        return self.rows(number)[2].tobytes()

    def _of_hash(self, hashes: np.ndarray) -> np.ndarray:
        """The number of the piece with each hash, -1 if there is none."""
        number, kept = np.full(len(hashes), -1, np.int64), self.hashes.values
        if not len(kept):
            return number
        last = len(self.slots) - 1
        open_, slot = np.arange(len(hashes)), (hashes & np.uint64(last)).astype(np.int64)
        while len(open_):
            there = self.slots[slot]
            same = (there >= 0) & (kept[there] == hashes[open_])
            number[open_[same]] = there[same]
            on = (there >= 0) & ~same
            open_, slot = open_[on], (slot[on] + 1) & last
        return number

    def find(self, hashes: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The number of each piece, -1 if it is not kept."""
        number, size = self._of_hash(hashes), end - start
        if len(self):
            number[(number >= 0) & (self.sizes.values[number] != size)] = -1
        hit = np.flatnonzero(number >= 0)
        for differ in unequal(data, start[hit], self.texts.values, self.start.values[number[hit]], size[hit]):
            number[hit[differ]] = -1
        return number

    def rows(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Bytes and sizes, ids and their counts of kept pieces."""
        sizes, counts = self.sizes.values[number].astype(np.int64), self.counts.values[number].astype(np.int64)
        texts = self.texts.values[spread(self.start.values[number], sizes)]
        return texts, sizes, self.ids.values[spread(self.first.values[number], counts)], counts

    def add(self, hashes: np.ndarray, texts: np.ndarray, sizes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Keep pieces, given as their bytes one after the other, of which none is kept."""
        one = np.sort(np.unique(hashes, return_index=True)[1])
        one = one[self._of_hash(hashes[one]) < 0]
        start, first = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
        before, of_texts, of_ids = len(self), len(self.texts.values), len(self.ids.values)
        if len(one) < len(hashes):
            texts, ids = texts[spread(start[one], sizes[one])], ids[spread(first[one], counts[one])]
            hashes, sizes, counts = hashes[one], sizes[one], counts[one]
            start, first = np.cumsum(sizes) - sizes, np.cumsum(counts) - counts
        given = (hashes, texts, sizes, ids, counts, start + of_texts, first + of_ids)
        for grown, values in zip((self.hashes, self.texts, self.sizes, self.ids, self.counts, self.start, self.first), given):
            grown.append(values)
        if 2 * len(self) > len(self.slots):
            self.slots = np.full(1 << (2 * len(self)).bit_length(), -1, np.int32)
            before = 0
        self._place(np.arange(before, len(self)))

    def _place(self, number: np.ndarray) -> None:
        """Give each piece a slot."""
        last = len(self.slots) - 1
        slot = (self.hashes.values[number] & np.uint64(last)).astype(np.int64)
        while len(number):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = number[free]  # of those that meet in a slot, one stays
            on = self.slots[slot] != number
            number, slot = number[on], (slot[on] + 1) & last


# White space in UTF-8 other than a space and a line break, and separators of ASCII.
_ODD_BYTES = np.zeros(256, bool)
_ODD_BYTES[[9, 11, 12, 13, 0x1C, 0x1D, 0x1E, 0x1F]] = True
_LEADS = np.zeros(256, bool)
_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ODD_CHARACTERS = np.array(
    [int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in
     (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)


def whole_texts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The texts that can't be cut: white space side by side, at the end, or of other kinds, or special tokens."""
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    space, line = data == 32, data == 10
    beside = (space[:-1] & (space | line)[1:]) | (line[:-1] & line[1:]) | ((data[:-1] == 60) & (data[1:] == 124))
    found = [np.flatnonzero(beside & ~begins[1:-1]), np.flatnonzero(space & begins[1:]), np.flatnonzero(_ODD_BYTES[data])]
    lead = np.flatnonzero(_LEADS[data])
    if len(lead):
        ahead = np.append(data, [0, 0]).astype(np.int64)
        two = ahead[lead] << 16 | ahead[lead + 1] << 8
        third = np.where(ahead[lead] == 0xC2, 0, ahead[lead + 2])
        found.append(lead[np.isin(two | third, _ODD_CHARACTERS)])
    whole = np.zeros(len(offsets) - 1, bool)
    whole[np.searchsorted(offsets, np.concatenate(found), side="right") - 1] = True
    return whole


def piece_spans(data: np.ndarray, offsets: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begins, ends and texts of the pieces of all texts but the ``whole`` ones: cut before spaces and around line breaks."""
    new = np.zeros(len(data) + 1, bool)
    new[:-1] = (data == 32) | (data == 10)
    new[1:] |= data == 10
    new[offsets] = True
    edges = np.flatnonzero(new)
    start, end = edges[:-1], edges[1:]
    text = np.searchsorted(offsets, start, side="right") - 1
    if whole.any():
        some = ~whole[text]
        start, end, text = start[some], end[some], text[some]
    return start, end, text


class Lookup:
    """What is kept of the pieces of many texts, each looked up once.

    ``new`` are those that are not; what was kept the time before is taken over.
    """

    def __init__(self, cut: list[list[str] | None], kept: dict, before: dict):
        self.cut, self.known, self.open = cut, [], []
        missing: set[str] = set()
        for pieces in cut:
            known = None if pieces is None else list(map(kept.get, pieces))
            at = [] if known is None else [i for i, value in enumerate(known) if value is None]
            missing.update([pieces[i] for i in at])
            self.known.append(known)
            self.open.append(at)
        for piece in missing:
            if piece in before:
                kept[piece] = before[piece]
        self.new = [piece for piece in missing if piece not in kept]

    def values(self, kept: dict) -> list[list[bytes | None] | None]:
        """The kept values by text, when the new ones are kept too."""
        for pieces, known, at in zip(self.cut, self.known, self.open):
            for i in at:
                known[i] = kept[pieces[i]]
        return self.known


def pieces_of(text: str) -> list[str] | None:
    """The text cut where no token crosses, or None if it can't be cut.

    A piece with other white space than a leading space tells no more than that its
    text can't be cut either.
    """
    if "  " in text or "\n\n" in text or " \n" in text or "<|" in text or "\0" in text or text[-1:] == " ":
        return None
    return text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")

