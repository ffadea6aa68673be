"""Balanced label propagation: linked documents move to their neighbours' shards under quotas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .prefix import running_sum
from .scratch import Scratch


@dataclass(frozen=True)
class Sharding:
    shards: int = 16
    rounds: int = 10  # of label propagation at most
    full: float = 0.98  # part of a shard's even share that its linked rows may take before no more come
    fine: int = 1 << 14  # hash ranges that the start is dealt in, and slots numbered in
    grain: int = 400  # parts of a shard that a block of linked rows has at most the size of one of

    def __post_init__(self) -> None:
        if self.shards < 1 or self.rounds < 0 or not 0 < self.full <= 1:
            raise ValueError(f"bad parameters: {self}")


def balanced_shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: str | None = None, params: Sharding | None = None) -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard`` of every row.

    Rows are linked where they share ``group`` (SQL over the columns; the text by
    default).  The law is ``bytes``.  Linked rows start dealt by hash; then blocks
    (rows of one group that started in one shard, split where they are large) move
    in rounds to the shard that holds most of their group and has room.  A quota
    binds each pair of shards: as much goes from i to j as comes back, and beyond
    that a part of what j may still take; the largest gain goes first.  Rows
    without links cut nothing wherever they are, so they fill every shard up to
    its even share.  A group larger than a shard fills one after another.

    ``slot`` numbers a shard's rows from 0 in an order of hashes that spreads equal rows too.  ``grown_shard`` is null
    under this law.  Null text: size 1, crc of nothing, linked with empty texts;
    a null id is hashed as such.  Repeated rows are one group.  An empty table
    gives an empty one; other columns are ignored.
    """
    p = params or Sharding()
    scratch = Scratch(docs.sparkSession, "sharding")
    text = F.coalesce(F.col(text_col), F.lit(""))
    linked = F.md5(text.cast("binary")) if group is None else F.coalesce(F.expr(group).cast("string"), F.lit(""))
    rows = docs.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        linked.alias("grp"),
    )
    rows = rows.withColumn("place", F.xxhash64(F.lit("place"), "doc_id", "grp", "uid"))
    rows = scratch.write(rows.withColumn("fine", F.pmod("place", F.lit(p.fine))), "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    share = max(1.0, total / p.shards)

    # a group's rows meet its sums by one of 64 hashes, so that a hot group spreads
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(F.lit("salt"), "uid"), F.lit(64)))
    sums = salted.groupBy("grp", "salt").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"))
    groups = sums.groupBy("grp").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).where("n > 1")
    parts = F.least(F.col("n"), F.floor(F.col("bytes") * p.grain / F.lit(share * p.shards)) + 1).cast("int")
    known = sums.select("grp", "salt").join(groups.select("grp", parts.alias("parts")), "grp")
    placed = salted.join(known, ["grp", "salt"], "left").drop("salt")
    start = F.pmod(F.xxhash64(F.lit("start"), "uid"), F.lit(p.shards)).cast("int")
    part = F.pmod(F.xxhash64(F.lit("part"), "uid"), F.col("parts")).cast("int")
    placed = placed.withColumn("start", F.when(F.col("parts").isNotNull(), start)).withColumn("part", part).drop("parts")
    placed = scratch.write(placed, "placed")
    blocks = placed.where("part is not null").groupBy("grp", "start", "part").agg(F.sum("size").alias("bytes"))
    blocks = scratch.write(blocks.withColumn("shard", F.col("start")), "blocks")
    held = {r.shard: r.s for r in blocks.groupBy("shard").agg(F.sum("bytes").alias("s")).collect()}  # one number per shard
    sizes = [held.get(i, 0) for i in range(p.shards)]
    blocks = _propagate(blocks, sizes, share, p, scratch)

    # rows without links fill what is left of each shard, in ranges of their hash
    sums = placed.where("part is null").groupBy("fine").agg(F.sum("size").alias("s"))
    middle = F.sum("s").over(Window.orderBy("fine")) - F.col("s") / 2
    left = [max(0.0, share - s) for s in sizes]
    ends = [sum(left[: i + 1]) for i in range(p.shards)]
    fill = F.lit(p.shards - 1)
    for i in reversed(range(p.shards - 1)):
        fill = F.when(F.col("middle") <= F.lit(ends[i]), i).otherwise(fill)
    dealt = sums.withColumn("middle", middle).select("fine", fill.cast("int").alias("dealt"))
    moved = blocks.select("grp", "start", "part", F.col("shard").alias("to"))
    done = placed.join(moved, ["grp", "start", "part"], "left").join(F.broadcast(dealt), "fine", "left")  # at most p.fine rows
    done = done.withColumn("shard", F.coalesce("to", "dealt"))
    done = scratch.write(done.select("uid", "doc_id", "size", "text_crc32", "shard", "fine", "place"), "assigned")
    out = running_sum(done, ["shard"], "fine", [F.col("place"), F.col("doc_id"), F.col("uid")], F.lit(1).cast("long"), "number")
    return out.select(F.col("doc_id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("number") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "uid")


def _propagate(blocks: DataFrame, sizes: list[int], share: float, p: Sharding, scratch: Scratch) -> DataFrame:
    for step in range(p.rounds):
        tally = blocks.groupBy("grp", "shard").agg(F.sum("bytes").alias("held"))
        closed = [i for i, s in enumerate(sizes) if s >= p.full * share - 1]
        best = tally.where(~F.col("shard").isin(closed)).groupBy("grp").agg(F.max(F.struct("held", F.xxhash64("grp", "shard").alias("tie"), "shard")).alias("b"))
        want = blocks.where(~F.col("shard").isin(closed)).join(tally, ["grp", "shard"]).join(best.select("grp", F.col("b.shard").alias("target"), F.col("b.held").alias("there")), "grp").where("shard <> target")
        want = scratch.write(want.select("grp", "start", "part", "bytes", "shard", "target", (F.col("there") - F.col("held")).alias("gain")), f"want{step}")
        flow = {(r.shard, r.target): r.s for r in want.groupBy("shard", "target").agg(F.sum("bytes").alias("s")).collect()}  # shards squared at most
        if not flow:
            scratch.drop(want)
            break
        quota = _quotas(flow, sizes, share, p)
        limits = blocks.sparkSession.createDataFrame([(i, j, float(q)) for (i, j), q in quota.items()], "shard int, target int, quota double")
        # the blocks with the largest gain first, in classes of gain that are ordered by hash
        turn = (F.lit(64) - F.ceil(F.log2(F.col("gain") + 2)).cast("long")) * 4096 + F.pmod(F.xxhash64("grp", "start", "part"), F.lit(4096))
        queue = running_sum(want.withColumn("turn", turn), ["shard", "target"], "turn", [F.col("grp"), F.col("start"), F.col("part")], F.col("bytes"), "upto")
        go = queue.join(F.broadcast(limits), ["shard", "target"]).where("upto <= quota")
        go = scratch.write(go.select("grp", "start", "part", "bytes", "shard", "target"), f"go{step}")
        moved = go.groupBy("shard", "target").agg(F.sum("bytes").alias("s")).collect()
        for r in moved:
            sizes[r.shard] -= r.s
            sizes[r.target] += r.s
        after = blocks.join(go.select("grp", "start", "part", "target"), ["grp", "start", "part"], "left")
        after = scratch.write(after.select("grp", "start", "part", "bytes", F.coalesce("target", "shard").alias("shard")), f"blocks{step}")
        scratch.drop(blocks, want, go)
        blocks = after
        if not moved:
            break
    return blocks


def _quotas(flow: dict[tuple[int, int], int], sizes: list[int], share: float, p: Sharding) -> dict[tuple[int, int], float]:
    """Bytes that may go from shard to shard: exchanges, and a part of the room there."""
    asked: dict[int, int] = {}
    for (i, j), wanted in flow.items():
        asked[j] = asked.get(j, 0) + max(0, wanted - flow.get((j, i), 0))
    out = {}
    for (i, j), wanted in flow.items():
        back = min(wanted, flow.get((j, i), 0))
        room = max(0.0, p.full * share - sizes[j])
        out[i, j] = back + (room * (wanted - back) / asked[j] if asked[j] else 0.0)
    return out


def op10_balanced_sharding(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return balanced_shards(docs).drop("uid")
