"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

A test item's word n-grams are its seeds, common or not: edited copies of one
passage share what few seeds they keep, so a seed's number of rows tells nothing.
One pass finds the seeds in each text, joins hits of an item that lie near one
diagonal into a passage, and aligns passage and item.

Test items are a stated query set.  They are held in memory in blocks of a
bounded number of bytes; a larger set takes more passes over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .scratch import Scratch, free_name

U64 = np.uint64
HITS = 1 << 20  # of seeds in rows, times the seed's places in items, that are joined at once


@dataclass(frozen=True)
class Decontamination:
    seed_words: int = 3
    hits: int = 2  # different seeds that a passage has at least, fewer where the item has no more
    mismatch: float = -0.5  # a match scores 1
    gap: float = -0.5
    threshold: float = 0.5  # of the alignment's score per word of the item
    block_bytes: int = 16 << 20  # of test items held at once

    def __post_init__(self) -> None:
        if self.seed_words < 1 or self.hits < 1 or not 0 < self.threshold <= 1:
            raise ValueError(f"bad parameters: {self}")


@dataclass
class Items:
    """One block of test items."""

    ids: np.ndarray
    words: np.ndarray  # hashes of all items' words
    first: np.ndarray  # n + 1 bounds in words
    seeds: np.ndarray  # sorted distinct seed hashes
    at: np.ndarray  # len(seeds) + 1 bounds in item and offset
    item: np.ndarray  # of each occurrence of a seed
    offset: np.ndarray

    @classmethod
    def of(cls, ids: list[int], texts: list[str], p: Decontamination) -> Items:
        raw, offsets = tokens.text_buffer(pa.array(texts, type=pa.string()))
        w = tokens.words(raw, offsets, 0, len(texts), tokens.ALNUM)
        hashes = w.hashes()
        got, at = _seeds(hashes, w.first, p.seed_words)
        row = np.searchsorted(w.first, at, side="right") - 1
        order = np.argsort(got, kind="stable")
        seeds, start = np.unique(got[order], return_index=True)
        return cls(np.array(ids, dtype=np.int64), hashes, w.first, seeds, np.append(start, len(got)), row[order], (at - w.first[row])[order])

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are seeds, and which."""
        if not len(self.seeds):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        if not hasattr(self, "_table"):
            self._bits = max(16, int(len(self.seeds)).bit_length() + 5)
            self._table = np.zeros(1 << self._bits, dtype=bool)
            self._table[self.seeds >> U64(64 - self._bits)] = True
        maybe = np.flatnonzero(self._table[hashes >> U64(64 - self._bits)])
        at = np.minimum(np.searchsorted(self.seeds, hashes[maybe]), len(self.seeds) - 1)
        hit = self.seeds[at] == hashes[maybe]
        return maybe[hit], at[hit]


def _seeds(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-word seeds of each row, and its whole words where it has fewer."""
    got, at = tokens.ngrams(hashes, first, n)
    counts = np.diff(first)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        got = np.concatenate([got, hashes[first[short]]])
        at = np.concatenate([at, first[short]])
    return got, at


def align(a: np.ndarray, b: np.ndarray, p: Decontamination) -> np.ndarray:
    """Smith-Waterman scores of pairs of rows of ``a`` (items) and ``b`` (passages); 0 pads items, 1 passages.

    Linear gap costs let a row of the matrix follow from the one before by a
    running maximum, so all pairs advance together, one item word at a time.
    """
    n, width = b.shape
    slope = np.arange(width, dtype=np.float32) * np.float32(-p.gap)
    above = np.zeros((n, width), dtype=np.float32)
    best = np.zeros(n, dtype=np.float32)
    for i in range(a.shape[1]):
        score = np.where(b == a[:, i : i + 1], np.float32(1), np.float32(p.mismatch))
        score[:, 1:] += above[:, :-1]
        np.maximum(score, above + np.float32(p.gap), out=score)
        np.maximum(score, 0, out=score)
        score += slope
        np.maximum.accumulate(score, axis=1, out=score)
        above = score - slope
        above[a[:, i] == 0] = 0
        np.maximum(best, above.max(axis=1), out=best)
    return best


def _passages(w: tokens.Words, hashes: np.ndarray, items: Items, p: Decontamination):
    """Candidates, some rows at a time: row, item, first and last word (in the block) of the passage."""
    got, at = _seeds(hashes, w.first, p.seed_words) if _has_short(items, p) else tokens.ngrams(hashes, w.first, p.seed_words)
    if _has_short(items, p):  # an item of fewer words is sought by its first word
        got, at = np.concatenate([got, hashes]), np.concatenate([at, np.arange(len(hashes))])
    pos, seed = items.lookup(got)
    if not len(pos):
        return
    row = np.searchsorted(w.first, at[pos], side="right") - 1
    order = np.argsort(row, kind="stable")
    pos, seed, row = at[pos][order], seed[order], row[order]
    start = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    end = np.append(start[1:], len(row))
    total = np.append(0, np.cumsum(np.diff(items.at)[seed]))
    k = 0
    while k < len(start):
        to = max(k + 1, int(np.searchsorted(total[end], total[start[k]] + HITS, side="right")))
        yield _clusters(w, pos[start[k] : end[to - 1]], seed[start[k] : end[to - 1]], items, p)
        k = to


def _clusters(w: tokens.Words, pos: np.ndarray, seed: np.ndarray, items: Items, p: Decontamination):
    """``_passages`` from the seeds at given places."""
    counts = np.diff(items.at)[seed]
    pos, src = np.repeat(pos, counts), np.repeat(seed, counts)
    step = np.arange(len(src)) - np.repeat(np.cumsum(counts) - counts, counts)
    occ = items.at[src] + step
    item, offset = items.item[occ], items.offset[occ]
    row = np.searchsorted(w.first, pos, side="right") - 1
    diagonal = pos - offset
    order = np.lexsort((diagonal, item, row))
    row, item, diagonal, offset = row[order], item[order], diagonal[order], offset[order]
    length = np.diff(items.first)
    margin = 4 + length // 4
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > margin[item[1:]])
    start = np.flatnonzero(new)
    end = np.append(start[1:], len(row)) - 1
    cluster = np.cumsum(new) - 1
    pairs = np.unique(cluster * (1 << 32) + offset)
    distinct = np.bincount(pairs >> 32, minlength=len(start))
    it = item[start]
    need = np.minimum(p.hits, np.maximum(1, length[it] - p.seed_words + 1))
    ok = distinct >= need
    r, it = row[start][ok], it[ok]
    lo = np.maximum(w.first[r], diagonal[start][ok] - margin[it])
    hi = np.minimum(w.first[r + 1], diagonal[end][ok] + length[it] + margin[it])
    return r, it, lo, hi


def _has_short(items: Items, p: Decontamination) -> bool:
    return bool((np.diff(items.first) < p.seed_words).any())


def _scores(hashes: np.ndarray, found, items: Items, p: Decontamination) -> np.ndarray:
    """Score per word of the item, for each candidate; longer passages are cut into overlapping ones."""
    r, it, lo, hi = found
    length = np.diff(items.first)[it]
    reach = 3 * length + 16  # a passage with many copies in a row is aligned piece by piece
    pieces = np.maximum(1, -(-(hi - lo - length) // np.maximum(1, reach - length)))
    who = np.repeat(np.arange(len(r)), pieces)
    k = np.arange(len(who)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    a0 = lo[who] + k * (reach - length)[who]
    a1 = np.minimum(hi[who], a0 + reach[who])
    out = np.zeros(len(r), dtype=np.float64)
    order = np.argsort(length[who], kind="stable")
    for part in np.array_split(order, max(1, int((reach[who] * 1.0).sum() // 200_000) + 1)):
        if not len(part):
            continue
        ln, wd = int(length[who[part]].max()), int((a1 - a0)[part].max())
        a = _padded(items.words, items.first[it[who[part]]], length[who[part]], ln, 0)
        b = _padded(hashes, a0[part], (a1 - a0)[part], wd, 1)
        np.maximum.at(out, who[part], align(a, b, p) / length[who[part]])
    return out


def _padded(values: np.ndarray, start: np.ndarray, length: np.ndarray, width: int, pad: int) -> np.ndarray:
    at = np.arange(width)
    inside = at < length[:, None]
    return np.where(inside, values[np.where(inside, start[:, None] + at, 0)], U64(pad))


def _judge(block: Broadcast, p: Decontamination, at: int, out: str):
    """Adds the verdict of one block of items, under ``out``, to batches whose column ``at`` is the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items: Items = block.value
        for batch in batches:
            raw, offsets = tokens.text_buffer(batch.column(at))
            n = batch.num_rows
            score, best, many = np.zeros(n), np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
            for lo, hi in tokens.blocks(offsets):
                w = tokens.words(raw, offsets, lo, hi, tokens.ALNUM)
                hashes = w.hashes()
                for found in _passages(w, hashes, items, p):
                    if not len(found[0]):
                        continue
                    got = _scores(hashes, found, items, p)
                    order = np.lexsort((items.ids[found[1]], -got, found[0]))
                    r, s, i = found[0][order], got[order], found[1][order]
                    top = np.append(True, r[1:] != r[:-1])
                    score[lo + r[top]], best[lo + r[top]] = s[top], i[top]
                    over = np.unique(r[s >= p.threshold] * len(items.ids) + i[s >= p.threshold])
                    np.add.at(many, lo + over // len(items.ids), 1)
            hit = score >= p.threshold
            ids = pa.array(np.where(hit, items.ids[best], 0) if len(items.ids) else np.zeros(n, np.int64), mask=~hit)
            leak = pa.StructArray.from_arrays([pa.array(hit), ids, pa.array(np.minimum(score, 1.0)), pa.array(many)], names=["contaminated", "item_id", "score", "n_items"])
            yield pa.record_batch([*batch.columns, leak], names=[*batch.schema.names, out])

    return run


def with_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", params: Decontamination | None = None, out: str = "_leak") -> DataFrame:
    """``docs`` with a struct ``out``: ``contaminated``, ``item_id`` (the best, smallest on ties), ``score``, ``n_items``.

    Words are runs of ASCII letters and digits and of any other character, A-Z
    lowered.  Null, empty and wordless texts hold no leak; test items with a null
    id or without words are left out.  An item of fewer than ``seed_words`` words is
    found wherever its words stand, so one of a single word contaminates every text
    with that word.  Equal test items both count; equal rows get equal verdicts.  An
    empty benchmark finds nothing.  Other columns pass through; one named as ``out``
    is replaced.

    One block of items is broadcast at a time.  With several, each block's verdicts
    are written before the next block is loaded, and the best of them joined back.
    """
    p = params or Decontamination()
    docs = docs.drop(out)
    sc = docs.sparkSession.sparkContext
    kind = T.StructType([T.StructField("contaminated", T.BooleanType()), T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType()), T.StructField("n_items", T.LongType())])
    items = benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where(r"i is not null and t rlike '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]'")
    total = items.agg(F.sum(F.octet_length("t") + 16)).first()[0] or 0
    n_blocks = max(1, -(-total // p.block_bytes))

    def block(k: int) -> Broadcast:
        rows = items.where(F.pmod(F.xxhash64("i"), F.lit(n_blocks)) == k).orderBy("i", "t").toArrow()  # about block_bytes
        return sc.broadcast(Items.of(rows["i"].to_pylist(), rows["t"].to_pylist(), p))

    if n_blocks == 1:
        return docs.mapInArrow(_judge(block(0), p, docs.columns.index(text_col), out), T.StructType([*docs.schema.fields, T.StructField(out, kind)]))
    scratch = Scratch(docs.sparkSession, "leaks")
    uid = free_name("uid", [*docs.columns, out])
    rows = scratch.write(docs.withColumn(uid, F.monotonically_increasing_id()), "rows")
    texts = rows.select(uid, text_col)
    found = None
    for k in range(n_blocks):
        held = block(k)
        judged = texts.mapInArrow(_judge(held, p, 1, "leak"), T.StructType([*texts.schema.fields, T.StructField("leak", kind)]))
        part = scratch.write(judged.where("leak.score > 0").select(uid, "leak"), f"block{k}")
        held.destroy()
        found = part if found is None else found.unionByName(part)
    leak = lambda f: F.col(f"leak.{f}")
    top = F.min(F.struct(-leak("score"), F.coalesce(leak("item_id"), F.lit(0)).alias("tie"), leak("item_id").alias("item_id")))
    best = found.groupBy(uid).agg(F.bool_or(leak("contaminated")).alias("contaminated"), top["item_id"].alias("item_id"), F.max(leak("score")).alias("score"), F.sum(leak("n_items")).alias("n_items"))
    best = best.select(uid, F.struct("contaminated", "item_id", "score", "n_items").alias(out))
    none = F.struct(F.lit(False).alias("contaminated"), F.lit(None).cast("long").alias("item_id"), F.lit(0.0).alias("score"), F.lit(0).cast("long").alias("n_items"))
    return rows.join(best, uid, "left").select(*docs.columns, F.coalesce(out, none).alias(out))


def op4_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    judged = with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.select("doc_id", "_leak.contaminated", "_leak.item_id", "_leak.score", "_leak.n_items")
