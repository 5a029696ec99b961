"""Byte-level BPE by a segment tree over byte positions, and its inverse.

Every position that starts a live token holds the rank of the pair it forms with its
right neighbour. A segment tree keeps the leftmost least rank at its root; a merge takes
that pair, makes it one token and renews the leaves of the merged token, its left
neighbour and the position that vanished, each on one path to the root. Many short
matches are worked on together as rows of one numpy tree, long ones one by one.

A text is split by the vocabulary's pattern; each match is encoded by itself. Null texts
are empty and have no ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordloom.llm.encoder import ODD, Lookup, pieces_of
from recordloom.llm.text import slices

#: Matches up to this many bytes share a numpy tree; pieces kept until those unused go.
SHORT, KEPT_PIECES = 64, 400_000
NONE = np.int64(1) << np.int64(62)

_codecs: dict[str, Codec] = {}


class Codec:
    """``ranks``: the text of a rank file; ``pattern``: what splits a text."""

    def __init__(self, ranks: str, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
        self.token = {b: a for a, b in self.rank.items()}
        self.split = regex.compile(pattern).findall
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 32 | right] = rank
        self.pairs = pairs
        self._keys = np.array(sorted(pairs), np.int64)
        self._ranks = np.array([pairs[k] for k in self._keys.tolist()], np.int64)
        self.kept: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}

    @staticmethod
    def of(ranks: str, pattern: str) -> Codec:
        """One codec for each vocabulary and worker."""
        name = hashlib.sha256(f"{pattern}\0{ranks}".encode()).hexdigest()
        if name not in _codecs:
            _codecs[name] = Codec(ranks, pattern)
        return _codecs[name]

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 32 | right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where(self._keys[at] == keys, self._ranks[at], NONE)

    def merge_many(self, matches: list[bytes], leaves: int) -> list[bytes]:
        """The ids (32-bit, as bytes) of matches of at most ``leaves`` bytes, a power of two."""
        n, lengths = len(matches), np.array([len(m) for m in matches])
        padded = np.frombuffer(b"".join(m.ljust(leaves, b"\0") for m in matches), np.uint8).reshape(n, leaves)
        ids = self.byte[padded]
        place = np.arange(leaves)
        live = place < lengths[:, None]
        after, before = np.tile(place + 1, (n, 1)), np.tile(place - 1, (n, 1))
        # a node is the least (rank, position) below it: the rank in the high bits
        tree = np.full((n, 2 * leaves), NONE)
        ranks = self._pair_ranks(ids[:, :-1], ids[:, 1:])
        tree[:, leaves:-1] = np.where(live[:, 1:] & (ranks < NONE), ranks * leaves + place[:-1], NONE)
        for node in range(leaves - 1, 0, -1):
            tree[:, node] = np.minimum(tree[:, 2 * node], tree[:, 2 * node + 1])
        rows = np.flatnonzero(tree[:, 1] < NONE)
        while len(rows):
            root = tree[rows, 1]
            at, gone_rank = root % leaves, root // leaves
            gone = after[rows, at]
            follow = after[rows, gone]
            ids[rows, at], live[rows, gone] = gone_rank, False
            after[rows, at] = follow
            inner = follow < lengths[rows]
            before[rows[inner], follow[inner]] = at[inner]
            self._renew(tree, rows, gone, np.full(len(rows), NONE), leaves)
            with_next = np.full(len(rows), NONE)
            found = self._pair_ranks(gone_rank[inner], ids[rows[inner], follow[inner]])
            with_next[inner] = np.where(found < NONE, found * leaves + at[inner], NONE)
            self._renew(tree, rows, at, with_next, leaves)
            ahead = before[rows, at]
            some = ahead >= 0
            found = self._pair_ranks(ids[rows[some], ahead[some]], gone_rank[some])
            value = np.where(found < NONE, found * leaves + ahead[some], NONE)
            self._renew(tree, rows[some], ahead[some], value, leaves)
            rows = rows[tree[rows, 1] < NONE]
        flat, ends = ids[live].astype("<u4").tobytes(), np.cumsum(live.sum(axis=1)) * 4
        return [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    @staticmethod
    def _renew(tree, rows, leaf, value, leaves) -> None:
        """Set one leaf of each row and the nodes on its path to the root."""
        node = leaf + leaves
        tree[rows, node] = value
        while leaves > 1:
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])
            leaves >>= 1

    def merge_one(self, match: bytes) -> bytes:
        """The ids of one match of any length: O(log n) for each merge."""
        n = len(match)
        leaves = 1 << (n - 1).bit_length()
        ids, pairs, none = [int(self.byte[b]) for b in match], self.pairs, int(NONE)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * leaves)

        def value(i: int) -> int:
            j = after[i]
            rank = pairs.get(ids[i] << 32 | ids[j]) if j < n else None
            return none if rank is None else rank * leaves + i

        def renew(i: int, v: int) -> None:
            node = i + leaves
            tree[node] = v
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                tree[node] = a if a < b else b
                node >>= 1

        for i in range(n):
            tree[leaves + i] = value(i)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            rank, i = divmod(tree[1], leaves)
            gone = after[i]
            ids[i], ids[gone] = rank, -1
            after[i] = after[gone]
            if after[i] < n:
                before[after[i]] = i
            renew(gone, none)
            renew(i, value(i))
            if before[i] >= 0:
                renew(before[i], value(before[i]))
        return np.array([x for x in ids if x >= 0], "<u4").tobytes()

    def _learn(self, pieces: list[str]) -> None:
        matches = [[m.encode() for m in self.split(piece)] for piece in pieces]
        known: dict[bytes, bytes] = {}
        by_size: dict[int, list[bytes]] = {}
        for match in set().union(*matches):
            if match in self.rank:
                known[match] = np.array([self.rank[match]], "<u4").tobytes()
            elif len(match) > SHORT:
                known[match] = self.merge_one(match)
            else:
                by_size.setdefault(1 << (len(match) - 1).bit_length(), []).append(match)
        for leaves, some in by_size.items():
            for at in range(0, len(some), 1 << 15):
                part = some[at : at + (1 << 15)]
                known.update(zip(part, self.merge_many(part, leaves)))
        for piece, own in zip(pieces, matches):
            self.kept[piece] = b"".join([known[m] for m in own])

    @staticmethod
    def _cut(text: str) -> list[str]:
        pieces = None if ODD.search(text) else pieces_of(text)
        return [text] if pieces is None else pieces

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        cut = [self._cut(text) for text in texts]
        if len(self.kept) > KEPT_PIECES:
            self.kept, self.before = {}, self.kept
        looked = Lookup(cut, self.kept, self.before)
        if looked.new:
            self._learn(looked.new)
        kept = self.kept
        found = [np.frombuffer(b"".join(values), "<u4") for values in looked.values(kept)]
        for pieces in cut:
            if len(pieces) == 1:  # whole texts are not worth keeping
                kept.pop(pieces[0], None)
        return found

    def decode(self, ids) -> bytes:
        token = self.token
        return b"".join([token[i] for i in ids])


def encode(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id`` and ``ids`` of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for batch in slices(batches, "text"):
            ids = codec.encode([text or "" for text in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int64()))], ["doc_id", "ids"])

    return _plain(docs).mapInArrow(run, "doc_id long, ids array<long>")


def decode(encoded: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """``doc_id`` and the bytes, as ``decoded``, of rows with ``ids``; null ids decode to none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        for batch in batches:
            decoded = [codec.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(decoded, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def digests(docs: DataFrame, ranks: str, pattern: str) -> DataFrame:
    """Encode and decode in one pass; per document the number of ids and the hashes of both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(ranks, pattern)
        names = {i: str(i) for i in codec.token}
        sha256 = hashlib.sha256
        for batch in slices(batches, "text"):
            ids = [x.tolist() for x in codec.encode([text or "" for text in batch.column("text").to_pylist()])]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([sha256(" ".join([names[i] for i in x]).encode()).hexdigest() for x in ids]),
                    pa.array([sha256(codec.decode(x)).hexdigest() for x in ids]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _plain(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
