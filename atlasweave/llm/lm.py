"""Language-model scores of documents: PPM code length beside a smoothed unigram base."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import ppm, tokens
from .scratch import Scratch

U64 = np.uint64


@dataclass(frozen=True)
class Scoring:
    order: int = 5  # bytes of the longest context
    nodes: int = 4_000_000  # most frequent keys (context and byte) that are looked up in memory; all others by a join
    hot_words: int = 500_000  # most frequent words that are looked up in memory; all others by a join
    flush: int = 2_000_000  # keys that a task counts before it merges them

    def __post_init__(self) -> None:
        if not 0 <= self.order <= 6 or self.nodes < 1 or self.hot_words < 0 or self.flush < 1:
            raise ValueError(f"bad parameters: {self}")


def held_out_rows(id_col: str) -> Column:
    """Rows whose crc32 of the id as text leaves 0 by 10; a null id does not."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 10 == 0, F.lit(False))


class _Counter:
    """Counts keys of one kind in bounded memory, yielding partial sums."""

    def __init__(self, kind: int, limit: int):
        self.kind, self.limit, self.parts, self.held = kind, limit, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(np.unique(keys, return_counts=True))
        self.held += len(self.parts[-1][0])
        if self.held > self.limit:
            merged = self.merge()
            self.parts, self.held = [merged], len(merged[0])
            if 2 * self.held > self.limit:
                yield from self.flush()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        own, inverse = np.unique(keys, return_inverse=True)
        return own, np.bincount(inverse, weights=counts, minlength=len(own)).astype(np.int64)

    def flush(self) -> Iterator[pa.RecordBatch]:
        keys, counts = self.merge()
        self.parts, self.held = [], 0
        for at in range(0, len(keys), 100_000):
            k, c = keys[at : at + 100_000], counts[at : at + 100_000]
            yield pa.record_batch([pa.array(np.full(len(k), self.kind, np.int8)), pa.array(k.view(np.int64)), pa.array(c)], names=["kind", "key", "n"])


def _lowered(raw: np.ndarray, offsets: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    return tokens.LOWER[raw[offsets[lo] : offsets[hi]]], offsets[lo : hi + 1] - offsets[lo]


def _gather(p: Scoring):
    """Counts of words (kind 0) and keys (kind 1) of the rows to learn from, and of the other rows' keys (kind 2)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        word, gram, other = _Counter(0, p.flush), _Counter(1, p.flush), _Counter(2, p.flush)
        for batch in batches:
            for learn in (True, False):
                own = batch.filter(pc.equal(batch.column(1), learn))
                raw, offsets = tokens.text_buffer(own.column(0))
                for lo, hi in tokens.blocks(offsets):
                    if learn:
                        yield from word.add(tokens.words(raw, offsets, lo, hi).hashes())
                    yield from (gram if learn else other).add(ppm.grams(*_lowered(raw, offsets, lo, hi), p.order)[0])
        for counter in (word, gram, other):
            yield from counter.flush()

    return run


def _last(col: str, n: int) -> Column:
    """The last n bytes of a key."""
    return F.col(col).bitwiseAND(F.lit((1 << (8 * n)) - 1))


def _values(keys: DataFrame, order: int, scratch: Scratch) -> DataFrame:
    """``key``, ``m`` and ``value``, the log10 probability of the key's last byte after the bytes before it.

    ``keys``: each with how often it was learned (``n``) and occurs at all (``m``).
    As ``ppm.Model`` works it out, but the trie's levels are tables: what was
    learned meets its context, and what was not walks down by joins.
    """
    levels = [keys.where("n > 0").select("key", "n")]
    for k in range(order - 1, -1, -1):  # update exclusion: a shorter context counts once per longer one
        levels.append(scratch.write(levels[-1].groupBy(_last("key", k + 1).alias("key")).agg(F.count("*").alias("n")), f"level{k}"))
    levels.reverse()
    contexts: list[DataFrame] = []
    sums = [F.sum("n").alias("total"), F.count("*").alias("kinds")]
    for k, level in enumerate(levels):  # left, rest: symbols and twice their counts one level below without this context's
        own = level.withColumn("ctx", F.shiftright("key", 8))
        if k:
            low = levels[k - 1].select(F.col("key").alias("suffix"), F.col("n").alias("low"))
            below = contexts[k - 1].select(F.col("ctx").alias("short"), F.col("total").alias("low_total"), F.col("kinds").alias("low_kinds"))
            met = own.withColumn("suffix", _last("key", k)).join(low, "suffix").groupBy("ctx").agg(*sums, F.sum("low").alias("gone"))
            met = met.withColumn("short", _last("ctx", k - 1)).join(below, "short")
            out = met.select("ctx", "total", "kinds", (F.col("low_kinds") - F.col("kinds")).alias("left"), (2 * (F.col("low_total") - F.col("gone"))).alias("rest"))
        else:
            out = own.groupBy("ctx").agg(*sums).select("ctx", "total", "kinds", (256 - F.col("kinds")).alias("left"), (256 - F.col("kinds")).alias("rest"))
        contexts.append(scratch.write(out, f"contexts{k}"))

    log = lambda x: F.log10(x.cast("double"))
    n, total, kinds, left, rest = (F.col(c) for c in ("n", "total", "kinds", "left", "rest"))
    learned = keys.where("n > 0").withColumn("ctx", F.shiftright("key", 8)).join(contexts[order], "ctx")
    learned = learned.select("key", "m", (log(2 * n - 1) - log(2 * total)).alias("value"))

    zero = F.lit(0.0)
    walk = keys.where("n = 0").select("key", "m", zero.alias("value"), F.lit(True).alias("todo"), F.lit(True).alias("direct"), zero.alias("below"), zero.alias("escape"))
    for k in range(order, -1, -1):
        found = contexts[k] if k > 2 else F.broadcast(contexts[k])  # 65,536 rows at most
        walk = walk.withColumn("ctx", F.shiftright(_last("key", k + 1), 8)).join(found, "ctx", "left")
        if k < order:
            entries = levels[k].select(F.col("key").alias("own"), "n")
            walk = walk.withColumn("own", _last("key", k + 1)).join(entries if k > 1 else F.broadcast(entries), "own", "left")
        else:
            walk = walk.withColumn("n", F.lit(None).cast("long"))
        direct, some = F.col("direct"), kinds.isNotNull() & (left > 0)
        hit = log(2 * n - 1) - F.when(direct, log(2 * total)).otherwise(F.col("below"))
        miss = F.when(direct, log(kinds) - log(2 * total)).otherwise(F.col("escape"))
        step = F.when(~F.col("todo") | kinds.isNull(), zero).when(n.isNotNull(), hit).otherwise(miss)
        walk = walk.select(
            "key",
            "m",
            (F.col("value") + step).alias("value"),
            (F.col("todo") & n.isNull()).alias("todo"),
            (direct & kinds.isNull()).alias("direct"),
            F.when(some, log(rest)).otherwise(zero if k else F.when(kinds.isNull(), log(F.lit(256))).otherwise(zero)).alias("below"),
            F.when(some, log(left) - log(rest)).otherwise(zero).alias("escape"),
        )
    missed = walk.select("key", "m", (F.col("value") - F.when(F.col("todo"), F.col("below")).otherwise(zero)).alias("value"))
    return scratch.write(learned.unionByName(missed), "values")


def _least(rows: DataFrame, col: str, limit: int) -> int:
    """The smallest count, a power of 2, that no more than ``limit`` rows reach."""
    by_size = rows.groupBy(F.floor(F.log2(col)).cast("int").alias("power")).count().orderBy(F.col("power").desc()).collect()  # 63 rows at most
    least, held = 62, 0  # none
    for r in by_size:
        if held + r["count"] > limit:
            break
        least, held = r.power, held + r["count"]
    return 2**least


#: The indexes that a Python worker has built last, by their name; tasks of one job share them.
_built: dict[str, tuple[tokens.Index, tokens.Index]] = {}


def _score(tables: Broadcast, name: str, train: tuple[int, int, int], p: Scoring):
    """Per row: tokens, base and known from hot words, the score from hot keys, and its other words and keys."""
    n_all, v_all, n_docs = train
    bottom = np.log10(n_all + 0.1 * (v_all + 1))
    end = np.log10(n_docs + 0.1) - bottom

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, values, hot, hot_n = tables.value
        if name not in _built:
            _built.clear()
            _built[name] = tokens.Index(often), tokens.Index(hot)
        trie, index = _built[name]
        logs = np.log10(hot_n + 0.1) - bottom
        for batch in batches:
            raw, offsets = tokens.text_buffer(batch.column(3))
            for lo, hi in tokens.blocks(offsets):
                w = tokens.words(raw, offsets, lo, hi)
                hashes, first = w.hashes(), w.first
                row = index.find(hashes)
                got = row >= 0
                base = _sums(np.where(got, logs[row] if len(logs) else 0.0, 0.0), first) + end
                known = _sums(got.astype(np.int64), first) + (n_docs > 0)
                keys, at = ppm.grams(*_lowered(raw, offsets, lo, hi), p.order)
                row = np.concatenate([trie.find(keys[k : k + ppm.CHUNK]) for k in range(0, len(keys), ppm.CHUNK)])
                met = row >= 0
                score = np.add.reduceat(np.where(met, values[row] if len(values) else 0.0, 0.0), at[:-1])
                part = [batch.column(k).slice(lo, hi - lo) for k in range(3)]
                yield pa.record_batch([*part, pa.array(np.diff(first) + 1), pa.array(known), pa.array(base), _lists(hashes, ~got, first), pa.array(score), _lists(keys, ~met, at)], names=["uid", "id", "held_out", "n_tokens", "known", "base", "rare", "score", "seldom"])

    return run


def _lists(values: np.ndarray, chosen: np.ndarray, first: np.ndarray) -> pa.ListArray:
    """The chosen values of each row."""
    at = np.flatnonzero(chosen)
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(at, first).astype(np.int32)), pa.array(values[at].view(np.int64)))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values)) if values.dtype != float else None
    if total is not None:
        return total[first[1:]] - total[first[:-1]]
    out = np.zeros(len(first) - 1)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        out[full] = np.add.reduceat(values, first[full])
    return out


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text", params: Scoring | None = None) -> DataFrame:
    """Id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score`` of every row.

    Both models learn from all rows that aren't held out and then score every row.
    Base: log10 probability of the row's words and one end, by counts with 0.1
    added.  Score: log10 probability of the text's bytes, A-Z lowered, and its end
    under the PPM trie of ``order`` at every size.  Null text counts as empty: only its end is scored.  Where
    nothing is left to learn from, counts are 0 and bytes equally likely.  Repeated
    rows count as often as they occur and get equal scores.
    """
    p = params or Scoring()
    scratch = Scratch(docs.sparkSession, "lm")
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    learn = F.coalesce(~F.col("held_out"), F.lit(False))
    counts = rows.select("text", learn.alias("learn")).mapInArrow(_gather(p), "kind byte, key long, n long")
    counts = counts.groupBy((F.col("kind") > 0).alias("gram"), "key").agg(F.sum(F.when(F.col("kind") < 2, F.col("n")).otherwise(0)).alias("n"), F.sum("n").alias("m"))
    counts = scratch.write(counts, "counts")
    words = counts.where("not gram")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    n_docs = rows.where(learn).count()
    train = (total[0] + n_docs, total[1] + (n_docs > 0), n_docs)

    values = _values(counts.where("gram").select("key", "n", "m"), p.order, scratch)
    often = _least(values, "m", p.nodes)
    keys = values.where(F.col("m") >= F.lit(often)).select("key", "value").toArrow()  # nodes at most
    least = _least(words, "n", p.hot_words)
    hot = words.where(F.col("n") >= F.lit(least)).select("key", "n").toArrow()  # hot_words at most

    tables = (keys["key"].to_numpy().view(U64), keys["value"].to_numpy(), hot["key"].to_numpy().view(U64), hot["n"].to_numpy())
    scorer = _score(docs.sparkSession.sparkContext.broadcast(tables), uuid.uuid4().hex, train, p)
    kind = rows.schema["id"].dataType.simpleString()
    scored = scratch.write(rows.mapInArrow(scorer, f"uid long, id {kind}, held_out boolean, n_tokens long, known long, base double, rare array<long>, score double, seldom array<long>"), "scored")
    cold = words.where(F.col("n") < F.lit(least)).select(F.col("key").alias("word"), "n")
    bottom = F.lit(train[0] + 0.1 * (train[1] + 1))
    rare = scored.select("uid", F.explode("rare").alias("word")).join(cold, "word", "left")
    more = rare.groupBy("uid").agg(F.sum(F.log10((F.coalesce("n", F.lit(0)) + 0.1) / bottom)).alias("more"), F.count("n").alias("met"))
    others = values.where(F.col("m") < F.lit(often)).select("key", "value")
    seldom = scored.select("uid", F.explode("seldom").alias("key")).join(others, "key").groupBy("uid").agg(F.sum("value").alias("deep"))
    out = scored.drop("rare", "seldom").join(more, "uid", "left").join(seldom, "uid", "left")
    return out.select(
        F.col("id").alias(id_col),
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("met", F.lit(0))).cast("long").alias("n_known"),
        F.lit(train[0]).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("deep", F.lit(0.0))).alias("score"),
    )


def op7_ppm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score_documents(docs, held_out_rows("doc_id"))
