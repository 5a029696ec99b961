"""Token ids in compressed binary files with an index for reading single documents.

Each document's ids are one zstandard frame, made with a dictionary that all frames
share. A file holds the frames of a range of documents in ascending ``doc_id``, then an
index (an Arrow stream of id, place, size and number of ids), then a footer with the
hash of the dictionary, the place of the index and the width of an id. The folder also
has the dictionary and a table of the files, with the number of ids before each.

Null texts are empty documents; rows with a null ``doc_id`` come first; rows that repeat
an id stay, in any order among themselves. Columns other than id and text are not stored.
"""

from __future__ import annotations

import contextlib
import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from recordloom.llm.encoder import SLICE_BYTES, Encoder
from recordloom.llm.folders import SharedWriter, open_input, shared_folder
from recordloom.llm.text import buffers, slices

MAGIC = b"TOKSTOR1"
FOOTER = struct.Struct("<8s32sQQQB")

#: Documents (and the longest of them, in characters) that the dictionary is trained on.
DICTIONARY_DOCUMENTS, DICTIONARY_LONGEST = 1000, 20_000
DICTIONARY_BYTES = 64 << 10
#: Bytes of text to a file.
FILE_BYTES = 24 << 20

INDEX = pa.schema([("doc_id", pa.int64()), ("place", pa.uint64()), ("size", pa.uint64()), ("n_tokens", pa.int64())])

FILES = pa.schema(
    [("file", pa.int32()), ("path", pa.string()), ("docs", pa.int64()), ("tokens", pa.int64()), ("least", pa.int64()), ("most", pa.int64())]
)
FILES_SQL = "file int, path string, docs long, tokens long, least long, most long"


def measured(docs: DataFrame, rows: int) -> tuple[int, list[str]]:
    """The bytes of all texts and at most ``DICTIONARY_DOCUMENTS`` of the ``rows`` texts, from one reading."""
    share = min(1.0, DICTIONARY_DOCUMENTS / max(rows, 1))
    seen, of_id = Observation(), F.xxhash64("doc_id")
    chosen = F.pmod(of_id, F.lit(1 << 30)) < int(share * (1 << 30))
    counted = docs.observe(seen, F.sum(F.octet_length("text")).alias("bytes"))
    some = counted.where(chosen & (F.length("text") <= DICTIONARY_LONGEST)).select("text", of_id.alias("of_id"))
    texts = [row.text for row in some.orderBy("of_id").limit(DICTIONARY_DOCUMENTS).collect()]
    return seen.get.get("bytes") or 0, texts


def train_dictionary(texts: list[str], tokenizer: str, end_id: int | None, width: int) -> bytes:
    """A dictionary from the ids of some documents.

    Where they are too few or too much alike to train one, the ids themselves are the dictionary.
    """
    ids = Encoder.of(tokenizer).encode(texts)
    samples = [_serialized(x, end_id, width) for x in ids if len(x) > 4]
    if len(samples) >= 16:
        with contextlib.suppress(zstandard.ZstdError):
            return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    return b"".join(samples)[:DICTIONARY_BYTES]


def _serialized(ids: np.ndarray, end_id: int | None, width: int) -> bytes:
    if end_id is not None:
        ids = np.append(ids, np.uint32(end_id))
    return ids.astype(f"<u{width}").tobytes()


def write_store(docs: DataFrame, tokenizer: str, end_id: int | None = None, folder: str | None = None) -> str:
    """Encode ``docs`` (``doc_id``, ``text``) into a new folder; returns the folder.

    ``tokenizer`` is the text of a tokenizer's JSON file. One reading measures the texts and
    takes the dictionary's sample, one of the ids alone finds their ranges for files of even size,
    another encodes; what is shuffled is compressed.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folder = folder or shared_folder(spark, "tokens")
    size, sample = measured(docs, docs.count())
    files = max(1, -(-size // FILE_BYTES))
    cuts: list[int] = []
    if files > 1:
        shares = [i / files for i in range(1, files)]
        found = docs.agg(F.percentile_approx("doc_id", shares, 100 * files)).first()[0]
        cuts = sorted(set(found or []))
    largest = max(Encoder.of(tokenizer).tokenizer.get_vocab_size(), end_id or 0)
    width = 2 if largest < 1 << 16 else 4
    dictionary = train_dictionary(sample, tokenizer, end_id, width)

    def compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(tokenizer)
        press = _compressor(dictionary)
        for batch in slices(batches, "text", SLICE_BYTES):
            ids = encoder.encode_utf8(*buffers(batch.column("text")))
            doc_ids = batch.column("doc_id")
            place = np.searchsorted(cuts, doc_ids.fill_null(-(1 << 63)).to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(place, pa.int32()),
                    doc_ids,
                    pa.array([len(x) + (end_id is not None) for x in ids], pa.int64()),
                    pa.array([press.compress(_serialized(x, end_id, width)) for x in ids], pa.binary()),
                ],
                ["file", "doc_id", "n_tokens", "frame"],
            )

    frames = docs.mapInArrow(compressed, "file int, doc_id long, n_tokens long, frame binary")
    dealt = frames.repartitionById(len(cuts) + 1, F.col("file"))
    ordered = dealt.sortWithinPartitions("file", "doc_id")

    def stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = hashlib.sha256(dictionary).digest()
        writer, file, place, index = None, None, 0, []

        def close():
            writer.write(footer_of(pa.Table.from_batches(index, INDEX), place, digest, width))
            writer.close()
            tokens = sum(int(np.sum(part.column("n_tokens").to_numpy())) for part in index)
            docs_in = sum(part.num_rows for part in index)
            ids = pc.min_max(pa.chunked_array([part.column("doc_id") for part in index])).as_py()
            row = {"file": file, "path": writer.path, "docs": docs_in, "tokens": tokens, "least": ids["min"], "most": ids["max"]}
            return pa.RecordBatch.from_pylist([row], FILES)

        for batch in batches:
            for of_file in _runs(batch, "file"):
                if of_file.column("file")[0].as_py() != file:
                    if writer:
                        yield close()
                    file = of_file.column("file")[0].as_py()
                    writer, place, index = SharedWriter(folder, f"ids-{file:06d}"), 0, []
                sizes = np.array([len(x.as_buffer()) for x in of_file.column("frame")], np.uint64)
                places = place + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.uint64)
                writer.write(b"".join(of_file.column("frame").to_pylist()))
                columns = [of_file.column("doc_id"), pa.array(places), pa.array(sizes), of_file.column("n_tokens")]
                index.append(pa.RecordBatch.from_arrays(columns, schema=INDEX))
                place += int(sizes.sum())
        if writer:
            yield close()

    listed = ordered.mapInArrow(stored, FILES_SQL).collect()  # a row for each file
    listed.sort(key=lambda row: row.file)
    rows, before = [], 0
    for row in listed:
        rows.append((*row, before))
        before += row.tokens
    spark.createDataFrame(rows, f"{FILES_SQL}, start long").coalesce(1).write.parquet(f"{folder}/files")
    spark.createDataFrame([(dictionary,)], "bytes binary").coalesce(1).write.parquet(f"{folder}/dictionary")
    return folder


def _runs(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """The batch cut where ``column`` changes."""
    values = batch.column(column).to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _compressor(dictionary: bytes):
    shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    return zstandard.ZstdCompressor(level=1, dict_data=shared, write_dict_id=False)


def footer_of(index: pa.Table, place: int, digest: bytes, width: int) -> bytes:
    """The end of a file whose frames take ``place`` bytes."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, INDEX) as stream:
        stream.write_table(index)
    raw = sink.getvalue().to_pybytes()
    return raw + FOOTER.pack(MAGIC, digest, place, len(raw), index.num_rows, width)


class StoredFile:
    """One file, open for reading."""

    def __init__(self, path: str, dictionary: bytes):
        self._file = open_input(path)
        size = self._file.size()
        self._file.seek(size - FOOTER.size)
        magic, digest, place, length, _, self.width = FOOTER.unpack(self._file.read(FOOTER.size))
        if magic != MAGIC or digest != hashlib.sha256(dictionary).digest():
            raise ValueError(f"{path} is no token file, or is of another dictionary")
        self._file.seek(place)
        self.index = pa.ipc.open_stream(self._file.read(length)).read_all().combine_chunks()
        shared = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self._open = zstandard.ZstdDecompressor(dict_data=shared)

    def ids(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(self._open.decompress(raw), f"<u{self.width}").astype("<u4")

    def document(self, row: int) -> np.ndarray:
        """The ids of one document, without reading others."""
        self._file.seek(self.index["place"][row].as_py())
        return self.ids(self._file.read(self.index["size"][row].as_py()))

    def documents(self, rows: range) -> list[np.ndarray]:
        """The ids of consecutive documents, from one reading."""
        places = self.index["place"].to_numpy()[rows.start : rows.stop].tolist()
        sizes = self.index["size"].to_numpy()[rows.start : rows.stop].tolist()
        self._file.seek(places[0])
        raw, first = self._file.read(sum(sizes)), places[0]
        return [self.ids(raw[p - first : p - first + s]) for p, s in zip(places, sizes)]


def _opened(spark: SparkSession, folder: str) -> tuple[DataFrame, bytes]:
    return spark.read.parquet(f"{folder}/files"), bytes(spark.read.parquet(f"{folder}/dictionary").first()[0])


def read_store(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before), ``n_tokens`` and ``ids``."""
    return store_rows(spark, folder, lambda ids: pa.array(ids, pa.list_(pa.int64())), "ids array<long>")


def store_rows(spark: SparkSession, folder: str, make, column: str) -> DataFrame:
    """As ``read_store`` with ``make`` of the ids of many documents in place of the ids."""
    files, dictionary = _opened(spark, folder)
    count = max(1, files.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                file = StoredFile(row["path"], dictionary)
                counts = file.index["n_tokens"].to_numpy()
                start = row["start"] + np.cumsum(counts) - counts
                at = 0
                while at < len(counts):
                    enough = np.searchsorted(np.cumsum(counts[at:]), 1 << 20, side="right")
                    to = min(len(counts), at + max(1, int(enough)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            file.index["doc_id"].slice(at, to - at).combine_chunks(),
                            pa.array(start[at:to]),
                            pa.array(counts[at:to]),
                            make(file.documents(range(at, to))),
                        ],
                        ["doc_id", "start", "n_tokens", column.split()[0]],
                    )
                    at = to

    dealt = files.repartitionById(count, F.col("file"))
    return dealt.mapInArrow(read, f"doc_id long, start long, n_tokens long, {column}")


def read_document(spark: SparkSession, folder: str, doc_id: int) -> list[np.ndarray]:
    """The ids of the documents with this id, from the indexes of the files that may have it and their frames alone."""
    files, dictionary = _opened(spark, folder)
    files = files.where(F.lit(doc_id).between(F.col("least"), F.col("most")))

    def found(batches):
        for batch in batches:
            for row in batch.to_pylist():
                file = StoredFile(row["path"], dictionary)
                rows = np.flatnonzero(file.index["doc_id"].fill_null(doc_id + 1).to_numpy() == doc_id)
                ids = [file.document(int(r)).tolist() for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int64()))], ["ids"])

    return [np.array(row.ids, "<u4") for row in files.mapInArrow(found, "ids array<long>").collect()]
