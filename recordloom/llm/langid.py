"""Language identification by error-correcting output codes.

Every language has a codeword of signs; for each bit a linear classifier on hashed
byte n-grams predicts the sign. A text's margins are compared with all codewords under
an exponential loss, weighted by how well each bit did on each language in training
(loss-weighted decoding); the nearest codeword wins. Where the second is almost as
near, the text is marked ambiguous.

Defined results: a null text or one without any letter is ``und`` with score 0, and so
is every text if no labelled row was learned from. Rows with a null text, label or id
are not learned from. Rows that repeat stay.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordloom.llm.text import buffers, lower, rows_that, slices, utf8

#: Features: hashed byte n-grams of these lengths in so many columns.
LENGTHS, COLUMNS = (1, 2, 3), 1 << 14
#: Bytes of text worked on at once: every byte becomes a row of weights.
SLICE_BYTES = 512 << 10
#: The sample that is learned from: rows of each language, and the most bytes of a text.
SAMPLE_ROWS, SAMPLE_LONGEST = 300, 20_000
#: Spans that are taken of a longer text, one in each of so many equal parts.
SPANS = 20
#: Ridge penalty of the classifiers, relative to the features' mean square.
PENALTY = 1e-2
#: A text is ambiguous if the two nearest codewords' losses differ by less than this share.
AMBIGUOUS = 0.02
#: Languages up to which the code has every distinct column.
EXHAUSTIVE = 6


@dataclass
class Model:
    languages: list[str]
    code: np.ndarray  # language x bit, signs
    weights: np.ndarray  # column x bit, with a last row of zeros
    bias: np.ndarray
    trust: np.ndarray  # language x bit, rows sum to 1


def codewords(languages: int) -> np.ndarray:
    """A row of signs for each language; no column is constant, none repeats another."""
    if languages < 2:
        return np.ones((languages, 1), np.int8)
    if languages <= EXHAUSTIVE:
        bits = np.arange(1, 1 << (languages - 1))
        rows = [np.zeros(len(bits), int)] + [bits >> k & 1 for k in range(languages - 1)]
        return (2 * np.array(rows) - 1).astype(np.int8)
    draw, best = np.random.default_rng(languages), (-1, None)
    for _ in range(50):
        code = draw.choice([-1, 1], (languages, math.ceil(10 * math.log2(languages)))).astype(np.int8)
        code = code[:, np.abs(code.sum(axis=1 - 1)) < languages]
        apart = (code.shape[1] - (code.astype(int) @ code.T.astype(int) - 10**6 * np.eye(languages)).max()) / 2
        best = max(best, (apart, code), key=lambda x: x[0])
    return best[1]


def _columns(data: np.ndarray, offsets: np.ndarray, n: int) -> np.ndarray:
    """The feature of the n-gram at each byte; ``COLUMNS`` where it leaves the document."""
    count = len(data)
    key = np.zeros(count, np.uint32)
    for k in range(n):
        key[: count - k] = (key[: count - k] << np.uint32(8)) | data[k:]
    key = ((key + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(32 - COLUMNS.bit_length() + 1)
    columns = key.astype(np.int32)
    for back in range(1, n):
        ends = offsets[1:] - back
        columns[ends[ends >= offsets[:-1]]] = COLUMNS
    return columns


def _features(texts: list[bytes]) -> np.ndarray:
    """Shares of the n-grams of each text; rows for training only."""
    out = np.zeros((len(texts), COLUMNS), np.float32)
    for row, text in enumerate(texts):
        data = lower(np.frombuffer(text, np.uint8))
        for n in LENGTHS:
            found = np.bincount(_columns(data, np.array([0, len(data)]), n), minlength=COLUMNS + 1)
            out[row] += found[:COLUMNS]
    return out / np.maximum(out.sum(axis=1, keepdims=True), 1)


def fit(texts: list[bytes], labels: list[str]) -> Model:
    """Ridge classifiers in their dual form: one solve for all bits."""
    languages = sorted(set(labels))
    code = codewords(len(languages))
    if not languages:
        return Model([], code, np.zeros((COLUMNS + 1, 1), np.float32), np.zeros(1), np.ones((0, 1)))
    of = np.array([languages.index(label) for label in labels])
    rows = _features(texts)
    mean = rows.mean(axis=0)
    rows -= mean
    signs = code[of].astype(np.float64)
    share = 1 / np.bincount(of, minlength=len(languages))[of]  # every language weighs the same
    level = (signs * share[:, None]).sum(axis=0) / share.sum()
    kernel = (rows @ rows.T).astype(np.float64)
    penalty = PENALTY * max(np.trace(kernel) / len(rows), 1e-12)
    dual = np.linalg.solve(kernel + np.diag(penalty * share.mean() / share), signs - level)
    weights = (rows.T @ dual.astype(np.float32)).astype(np.float32)
    margins = rows @ weights + level
    right = (np.sign(margins) == signs).astype(float)
    trust = np.array([(right[of == k].sum(axis=0) + 1) / ((of == k).sum() + 2) for k in range(len(languages))])
    trust /= trust.sum(axis=1, keepdims=True)
    return Model(languages, code, np.vstack([weights, np.zeros((1, weights.shape[1]), np.float32)]), level - mean @ weights, trust)


def train(docs: DataFrame, learn: Column) -> Model:
    """A model from at most ``SAMPLE_ROWS`` rows of each ``lang`` among the rows with ``learn``.

    Which rows depends on a hash of ``doc_id``, and so does where the spans of a long text
    lie. Only counts and the sample reach the driver; its size is bounded by the rows, the
    bytes taken of a text and the languages.
    """
    rows = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    rows = rows.where(F.octet_length("text") > 0).select("doc_id", "lang", _sampled("text").alias("text"))
    counts = {row.lang: row.n for row in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return fit([], [])
    draw = F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30))
    # about one and a half times what is wanted passes a threshold; the rest is cut by rank
    least = F.create_map(*(F.lit(x) for lang, n in counts.items() for x in (lang, min(1.0, 1.5 * (SAMPLE_ROWS + 20) / n))))
    some = rows.where(draw < least[F.col("lang")] * (1 << 30)).withColumn("draw", draw)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("draw", "doc_id", "text"))
    sample = some.withColumn("rank", rank).where(F.col("rank") <= SAMPLE_ROWS).orderBy("lang", "rank").collect()
    return fit([bytes(row.text) for row in sample], [row.lang for row in sample])


def _sampled(text: str) -> Column:
    """The text's bytes; of a long one, spans from the whole of it."""
    raw, size = F.col(text).cast("binary"), F.octet_length(text).cast("long")
    span, part = SAMPLE_LONGEST // SPANS, F.floor(size / SPANS)
    starts = [part * k + F.pmod(F.xxhash64("doc_id", F.lit(k)), part - span + 1) for k in range(SPANS)]
    spans = F.concat(*(F.substring(raw, (start + 1).cast("int"), F.lit(span)) for start in starts))
    return F.when(size <= SAMPLE_LONGEST, raw).otherwise(spans)


def _has_letter(data: np.ndarray, offsets: np.ndarray, texts: pa.Array) -> np.ndarray:
    folded = data | 32
    plain = np.concatenate([[0], np.cumsum((folded >= 97) & (folded <= 122))])
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    for row in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[row] = any(c.isalpha() for c in texts[int(row)].as_py().decode(errors="replace"))
    return found


def margins(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """The margin of each bit for each document of a slice."""
    data = lower(data)
    sizes = np.diff(offsets)
    total = np.zeros((len(sizes), model.weights.shape[1]))
    some = np.flatnonzero(sizes > 0)
    if len(some):
        for n in LENGTHS:
            at = _columns(data, offsets, n)
            total[some] += np.add.reduceat(model.weights[at], offsets[:-1][some], axis=0, dtype=np.float64)
    grams = sum(np.maximum(sizes - n + 1, 0) for n in LENGTHS)
    return total / np.maximum(grams, 1)[:, None] + model.bias


def decode(margins_: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest language of each row, a score in 0..1, and whether it is ambiguous."""
    loss = np.exp(-margins_[:, None, :] * model.code[None]) * model.trust[None]
    distance = loss.sum(axis=2)
    order = np.argsort(distance, axis=1, kind="stable")
    rows = np.arange(len(distance))
    best = distance[rows, order[:, 0]]
    second = distance[rows, order[:, 1]] if distance.shape[1] > 1 else np.full(len(best), np.inf)
    with np.errstate(invalid="ignore"):
        score = np.where(np.isinf(second), 1.0, second / (best + second))
    return order[:, 0], score, 2 * score - 1 < AMBIGUOUS


SCHEMA = "doc_id long, lang_pred string, score double, ambiguous boolean"


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``lang_pred``, ``score`` and ``ambiguous`` of every text."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), utf8("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], object)
        for batch in slices(batches, "text", SLICE_BYTES):
            best, score, ambiguous = judged(batch.column("text"), model)
            columns = [pa.array(names[best], pa.string()), pa.array(score), pa.array(ambiguous)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "lang_pred", "score", "ambiguous"])

    return plain.mapInArrow(run, SCHEMA)


def judged(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The language's place (the last for ``und``), the score, and whether no language is sure."""
    if not model.languages:
        return np.zeros(len(texts), int), np.zeros(len(texts)), np.ones(len(texts), bool)
    data, offsets = buffers(texts)
    best, score, ambiguous = decode(margins(data, offsets, model), model)
    known = _has_letter(data, offsets, texts)
    return np.where(known, best, len(model.languages)), np.where(known, score, 0.0), ambiguous | ~known


def keep(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text has a language that is not ambiguous, with their columns.

    Where no language was learned, all whose text has a letter.
    """
    if not model.languages:
        return rows_that(docs, lambda texts: _has_letter(*buffers(texts), texts), SLICE_BYTES)
    return rows_that(docs, lambda texts: ~judged(texts, model)[2], SLICE_BYTES)
