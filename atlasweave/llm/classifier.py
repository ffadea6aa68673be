"""Quality classifier: logistic regression over hashed word n-grams, trained by FTRL-proximal.

Features of a text are hashed counts of its words, word pairs, word shapes and
pairs of shapes; a shape keeps case, digits and signs (runs as one) and forgets
letters, and a pair of shapes tells whether both words are the same and whether
the pair of words came before in the text.  A score is the sparse dot product of
feature values and weights, through the logistic function.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens

U64 = np.uint64

# what a byte is to a shape: letters of either case, digits and bytes of longer characters are alike
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[0x61:0x7B], _SHAPE[0x80:], _SHAPE[0x41:0x5B], _SHAPE[0x30:0x3A] = 0x61, 0x61, 0x41, 0x30


@dataclass(frozen=True)
class Classifier:
    bits: int = 18  # of the feature space
    sample: int = 8000  # labelled rows learnt from, those with the smallest hashes of their ids
    epochs: int = 4
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.5
    threshold: float = 0.7
    shapes: bool = True  # use word shapes, repeated words and repeated pairs beside the words and pairs themselves

    def __post_init__(self) -> None:
        if not 8 <= self.bits <= 24 or self.sample < 1 or self.epochs < 1 or min(self.alpha, self.beta) <= 0:
            raise ValueError(f"bad parameters: {self}")


def features(raw: np.ndarray, offsets: np.ndarray, lo: int, hi: int, bits: int, with_shapes: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers and values of rows lo:hi, one row after another, and their bounds; rows have length 1."""
    w = tokens.words(raw, offsets, lo, hi)
    word, row = w.hashes(), w.row
    kind = _SHAPE[raw[offsets[lo] : offsets[hi]]]
    keep = np.ones(len(kind), dtype=bool)
    keep[1:] = kind[1:] != kind[:-1]
    keep[w.start] = True
    at = np.append(0, np.cumsum(keep))
    # bytes between words are kept or not, which changes no span: it starts at its first byte and ends after its last
    shape = tokens.span_hashes(kind[keep], at[w.start], at[w.end])
    pair, p0 = tokens.ngrams(word, w.first, 2)
    again = np.zeros(len(pair), dtype=bool)
    own = pair ^ tokens.mix(row[p0].astype(U64))
    order = np.argsort(own, kind="stable")
    again[order[1:]] = own[order[1:]] == own[order[:-1]]
    shapes, s0 = tokens.ngrams(shape, w.first, 2)
    with np.errstate(over="ignore"):
        flags = (word[s0] == word[s0 + 1]).astype(U64) * U64(2) + again.astype(U64) + U64(1)
        shapes = tokens.mix(shapes + flags * U64(0x9E3779B97F4A7C15))
        all_ = np.concatenate([word, tokens.mix(pair ^ U64(1)), tokens.mix(shape ^ U64(2)), shapes])
    rows = np.concatenate([row, row[p0], row, row[s0]])
    if not with_shapes:
        n = len(word) + len(pair)
        all_, rows = all_[:n], rows[:n]
    key = (rows.astype(np.int64) << bits) | (all_ >> U64(64 - bits)).astype(np.int64)
    key, count = np.unique(key, return_counts=True)
    bounds = np.searchsorted(key >> bits, np.arange(hi - lo + 1))
    value = np.log1p(count.astype(np.float32))
    squares = np.append(0.0, np.cumsum(value.astype(np.float64) ** 2))
    norm = np.sqrt(squares[bounds[1:]] - squares[bounds[:-1]])
    value /= np.repeat(np.maximum(norm, 1e-9), np.diff(bounds)).astype(np.float32)
    return (key & ((1 << bits) - 1)).astype(np.int32), value, bounds


def _extract(p: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tokens.text_buffer(batch.column(0))
            for lo, hi in tokens.blocks(offsets):
                at, value, bounds = features(raw, offsets, lo, hi, p.bits, p.shapes)
                b = pa.array(bounds.astype(np.int32))
                yield pa.record_batch([batch.column(1).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.ListArray.from_arrays(b, pa.array(at)), pa.ListArray.from_arrays(b, pa.array(value))], names=["turn", "label", "at", "value"])

    return run


def ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, p: Classifier) -> np.ndarray:
    """Weights, the last being the bias (McMahan and others, 2013)."""
    size = (1 << p.bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    bias = size - 1
    rng = np.random.default_rng(5)
    for _ in range(p.epochs):
        for i in rng.permutation(len(rows)):
            at, x = rows[i]
            at, x = np.append(at, bias), np.append(x, 1.0)
            zi, ni = z[at], n[at]
            w = np.where(np.abs(zi) <= p.l1, 0.0, (np.sign(zi) * p.l1 - zi) / ((p.beta + np.sqrt(ni)) / p.alpha + p.l2))
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - labels[i]) * x
            sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / p.alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return np.where(np.abs(z) <= p.l1, 0.0, (np.sign(z) * p.l1 - z) / ((p.beta + np.sqrt(n)) / p.alpha + p.l2)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", params: Classifier | None = None) -> np.ndarray:
    """Weights learnt from at most ``sample`` labelled ids for which ``allowed`` (over the id) holds.

    Null labels and ids are left out; of an id labelled more than once the smallest
    label counts, of an id with several texts the smallest.  Without labels of both
    kinds every weight is 0.
    """
    p = params or Classifier()
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).where("id is not null and label in (0, 1)")
    known = known.withColumnRenamed("id", id_col).where(allowed).withColumnRenamed(id_col, "id").groupBy("id").agg(F.min("label").alias("label"))
    chosen = known.withColumn("turn", F.xxhash64("id")).orderBy("turn", "id").limit(p.sample)
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")  # sample rows at most
    texts = texts.groupBy("id", "turn", "label").agg(F.min("text").alias("text")).select("text", "turn", "label")
    got = texts.mapInArrow(_extract(p), "turn long, label int, at array<int>, value array<float>").toArrow()
    order = np.argsort(got["turn"].to_numpy(), kind="stable")
    labelled = got["label"].to_numpy()[order].astype(float)
    if len(set(labelled.tolist())) < 2:
        return np.zeros((1 << p.bits) + 1, dtype=np.float32)
    lists = [(c.combine_chunks().flatten().to_numpy(), np.append(0, np.cumsum([len(x) for x in c]))) for c in (got["at"], got["value"])]
    rows = [(lists[0][0][a:b], lists[1][0][a:b]) for a, b in zip(lists[0][1][:-1], lists[0][1][1:], strict=True)]
    return ftrl([rows[i] for i in order], labelled, p)


def with_scores(docs: DataFrame, weights: np.ndarray, text_col: str = "text", params: Classifier | None = None) -> DataFrame:
    """``docs`` with a double ``_score``; null text scores as empty text, by the bias alone."""
    p = params or Classifier()
    docs = docs.drop("_score")
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tokens.text_buffer(batch.column(at))
            out = np.zeros(batch.num_rows)
            for lo, hi in tokens.blocks(offsets):
                number, value, bounds = features(raw, offsets, lo, hi, p.bits, p.shapes)
                total = np.append(0.0, np.cumsum(weights[number] * value.astype(np.float64)))
                out[lo:hi] = total[bounds[1:]] - total[bounds[:-1]]
            score = 1 / (1 + np.exp(-np.clip(np.round(out + float(weights[-1]), 9), -35, 35)))
            yield pa.record_batch([*batch.columns, pa.array(score)], names=[*batch.schema.names, "_score"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_score", T.DoubleType())]))


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    p = Classifier()
    weights = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), rest != 2, params=p)
    scored = with_scores(docs, weights, params=p)
    return scored.select("doc_id", F.coalesce(rest == 2, F.lit(False)).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= p.threshold).cast("int").alias("predicted"))
