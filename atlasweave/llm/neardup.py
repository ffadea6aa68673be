"""MinHash near-duplicates with odd sketches.

Each text becomes the set of its distinct word shingles.  MinHash samples under
independent hashes, in bands, find candidates.  The bottom-k MinHash sample (the k
smallest shingle hashes; all of a set that has no more) is folded into an odd
sketch, a bitmap of parities: the population count of the XOR of two sketches
tells how many samples differ, and for high similarities tells it precisely
(Mitzenmacher, Pagh and Pham, 2014).  Candidates that it lets pass are confirmed
on the full shingle sets; components of the confirmed links are the groups.

Equal sets are one class before anything is paired.  The smallest class of a band's
bucket is its star; each class is compared with the star that it shares most bands
with, then with the others that are still in another component.  Where that leaves a
bucket in several components, those of its largest component are compared with the
others and the others with one another, in blocks, each
naming its closest partners in another component, in rounds of growing number; the
last round has no limit, and ends the others where none is met, so no candidate pair is
lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens
from .components import connected_components
from .scratch import Scratch, free_name

U32, U64 = np.uint32, np.uint64


@dataclass(frozen=True)
class NearDup:
    """Parameters.  A link needs ``100 * |A and B| >= percent * |A or B|``."""

    ngram: int = 5
    percent: int = 85
    bands: int = 24  # a pair at 0.85 shares none of 24 bands of 5 rows once in a million
    rows: int = 5
    samples: int = 1024  # smallest hashes that are folded
    bits: int = 2048  # of an odd sketch
    deviations: float = 5.0  # by which a candidate's differing bits may exceed those of the threshold
    block: int = 512  # classes of a bucket that are compared at once
    rounds: tuple[int, ...] = (4, 0)  # partners named in each round; 0: all
    confirm: int = 1 << 15  # shingles of partners that a star is confirmed with in one part

    def __post_init__(self) -> None:
        if self.ngram < 1 or not 50 <= self.percent <= 100 or self.bands < 1 or self.rows < 1 or self.samples < 1 or self.bits % 64:
            raise ValueError(f"bad parameters: {self}")

    def most_bits(self, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Differing bits of two sketches, of sets of n and m, beyond which they can't be a link; below 0 where sizes rule it out."""
        small, large = np.minimum(n, m).astype(float), np.maximum(n, m).astype(float)
        j = self.percent / 100
        part = np.minimum(1.0, self.samples / large)  # of either set that the smaller of two samples reaches
        differ = part * (small + large) * (1 - j) / (1 + j)
        beyond = np.minimum(small, self.samples) - part * small  # samples of the smaller set that lie above it
        spread = np.sqrt(differ * (1 - part) + beyond * (1 - part)) * 2
        most = differ + beyond + self.deviations * spread + 1
        folded = self.bits * (1 - np.exp(-2 * most / self.bits)) / 2
        out = folded + self.deviations * np.sqrt(2 * most * most / self.bits)
        return np.where(100 * small < self.percent * large, -1.0, np.minimum(out, most))


def _sample_hashes(p: NearDup) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(77)
    return rng.integers(0, 2**31, p.bands * p.rows, dtype=U32) * U32(2) + U32(1), rng.integers(0, 2**32, p.bands * p.rows, dtype=U32)


def minhash(sets: np.ndarray, bounds: np.ndarray, p: NearDup) -> np.ndarray:
    """n_rows x (bands * rows) minima, of rows whose sets aren't empty."""
    mult, add = _sample_hashes(p)
    x = (sets >> U64(32)).astype(U32)
    out = np.empty((len(bounds) - 1, len(mult)), dtype=U32)
    scratch = np.empty_like(x)
    with np.errstate(over="ignore"):
        for i in range(len(mult)):
            np.multiply(x, mult[i], out=scratch)
            np.add(scratch, add[i], out=scratch)
            out[:, i] = np.minimum.reduceat(scratch, bounds[:-1])
    return out


def odd_sketch(sets: np.ndarray, bounds: np.ndarray, p: NearDup) -> np.ndarray:
    """n_rows x (bits / 8) bytes: the parity of how many of a row's samples fall on each bit; sets are sorted."""
    n = len(bounds) - 1
    row = np.repeat(np.arange(n), np.diff(bounds))
    taken = np.arange(len(sets)) - bounds[row] < p.samples
    bit = (tokens.mix(sets[taken]) % U64(p.bits)).astype(np.int64)
    parity = (np.bincount(row[taken] * p.bits + bit, minlength=n * p.bits) & 1).astype(np.uint8).reshape(n, p.bits)
    return np.packbits(parity, axis=1)


def _sketches(p: NearDup):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = tokens.text_buffer(batch.column(1))
            for lo, hi in tokens.blocks(offsets):
                sets, bounds = tokens.shingle_sets(tokens.words(raw, offsets, lo, hi), p.ngram)
                n = np.diff(bounds)
                full = np.flatnonzero(n)
                k1, k2 = np.zeros(hi - lo, U64), np.zeros(hi - lo, U64)
                bands: list = [None] * (hi - lo)
                odd: list = [None] * (hi - lo)
                if len(full):
                    at = np.append(bounds[full], bounds[-1])
                    with np.errstate(over="ignore"):
                        k1[full] = tokens.mix(np.add.reduceat(sets, at[:-1]) + n[full].astype(U64))
                        k2[full] = tokens.mix(np.add.reduceat(tokens.mix(sets ^ U64(0x5BF03635F0A31B85)), at[:-1]))
                    samples = minhash(sets, at, p)
                    used = samples.reshape(len(full), p.bands, p.rows).astype(U64)
                    with np.errstate(over="ignore"):
                        key = (used * tokens._STEP[: p.rows]).sum(axis=2, dtype=U64) + np.arange(p.bands, dtype=U64) * U64(0x9E3779B97F4A7C15)
                    key, sketch = tokens.mix(key).view(np.int64), odd_sketch(sets, at, p)
                    for i, row in enumerate(full):
                        bands[row], odd[row] = key[i], sketch[i].tobytes()
                yield pa.record_batch(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        batch.column(1).slice(lo, hi - lo),
                        batch.column(2).slice(lo, hi - lo),
                        batch.column(3).slice(lo, hi - lo),
                        pa.array(n.astype(np.int64)),
                        pa.array(k1.view(np.int64)),
                        pa.array(k2.view(np.int64)),
                        pa.array(bands, type=pa.list_(pa.int64())),
                        pa.array(odd, type=pa.binary()),
                    ],
                    names=["uid", "text", "id", "row", "n_shingles", "k1", "k2", "bands", "odd"],
                )

    return run


def _close(p: NearDup):
    """Keeps pairs whose sketches differ in few enough bits; adds the partner's size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for star, uid, first, n, odd in _stars(batches, lambda c: (c[0].to_numpy(), _stack(c[1]))):
            far = np.bitwise_count(odd ^ odd[first]).sum(axis=1)
            ok = (far <= p.most_bits(n, n[first])) & (uid != star)
            yield pa.record_batch([pa.array(star[ok]), pa.array(uid[ok]), pa.array(n[ok])], names=["a", "b", "nb"])

    return run


def _confirmed(p: NearDup):
    """Of every pair whether the full sets of its texts are similar enough."""

    def sets_of(columns: list[pa.Array]) -> tuple[list[np.ndarray]]:
        raw, offsets = tokens.text_buffer(columns[0])
        out: list[np.ndarray] = []
        for lo, hi in tokens.blocks(offsets):
            sets, bounds = tokens.shingle_sets(tokens.words(raw, offsets, lo, hi), p.ngram)
            out += [sets[x:y] for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        return (out,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for star, uid, first, sets in _stars(batches, sets_of):
            pairs = np.flatnonzero(uid != star)
            ok = np.zeros(len(pairs), dtype=bool)
            for k, i in enumerate(pairs):
                x, y = sets[first[i]], sets[i]
                if 100 * min(len(x), len(y)) >= p.percent * max(len(x), len(y)):
                    common = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())
                    ok[k] = 100 * common >= p.percent * (len(x) + len(y) - common)
            yield pa.record_batch([pa.array(star[pairs]), pa.array(uid[pairs]), pa.array(ok)], names=["a", "b", "ok"])

    return run


def _stars(batches: Iterator[pa.RecordBatch], read) -> Iterator[tuple]:
    """Rows (``a``, ``part``, ``uid``, payload) with their star's place, the star's own row being put first where it came in an earlier batch.

    Rows come sorted, each group's star before its partners.
    """
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch] if last is None else [last, batch]).combine_chunks()
        star, part, uid = (table.column(k).to_numpy() for k in (0, 1, 2))
        new = np.append(True, (star[1:] != star[:-1]) | (part[1:] != part[:-1]))
        first = np.flatnonzero(new)[np.cumsum(new) - 1]
        kept = table.slice(int(first[-1]), 1).to_batches()[0]
        yield star, uid, first, *read([table.column(k).combine_chunks() for k in range(4, table.num_columns)])
        last = kept


def _stack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=U64).reshape(len(column), -1)


def _partners(p: NearDup, most: int):
    """Of two blocks of a bucket: for each class its closest partners of another component, and whether it has more.

    A pair that meets in several bands counts in the first of them only.
    """

    def run(table):
        uid, comp, side, n = (table.column(c).to_numpy() for c in ("uid", "component", "side", "n_shingles"))
        odd = _stack(table.column("odd").combine_chunks())
        bands = np.array(table.column("bands").combine_chunks().flatten()).reshape(len(uid), -1)
        band = table.column("band")[0].as_py()
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        out_a, out_b, capped = [], [], []
        for i in left:
            to = right[comp[right] != comp[i]]
            to = to[~(bands[to, :band] == bands[i, :band]).any(axis=1)]
            far = np.bitwise_count(odd[to] ^ odd[i]).sum(axis=1)
            near = far <= p.most_bits(n[to], n[i])
            to, far = to[near], far[near]
            many = bool(most) and len(to) > most
            if many:
                to = to[np.argpartition(far, most - 1)[:most]]
            capped.append(np.full(len(to), many))
            out_a.append(np.minimum(uid[i], uid[to]))
            out_b.append(np.maximum(uid[i], uid[to]))
        empty = np.zeros(0, np.int64)
        return pa.table({"a": np.concatenate([empty, *out_a]), "b": np.concatenate([empty, *out_b]), "capped": np.concatenate([np.zeros(0, bool), *capped])})

    return run


def _meet(pairs: DataFrame, payload: DataFrame, weight: str, most: int) -> DataFrame:
    """``a``, ``part``, ``uid``, ``partner``, payload: each star once beside its partners, in parts of about ``most`` by ``weight``, sorted.

    A hot star's partners are told apart by a hash before anything is joined by
    star, so that neither it nor its payload meets all of them in one task.
    """
    hashed = pairs.select("a", "b", F.col(weight).alias("w") if weight else F.lit(1).cast("long").alias("w"), F.pmod(F.xxhash64("b"), F.lit(64)).alias("h"))
    counts = hashed.groupBy("a", "h").agg(F.sum("w").alias("w"))
    totals = counts.groupBy("a").agg(F.sum("w").alias("total"))
    parts = counts.join(totals, "a").select("a", "h", F.least(F.lit(64), F.ceil(F.col("total") / most)).alias("slots"), F.when(F.col("total") > 64 * most, F.ceil(F.col("w") / most)).otherwise(F.lit(1)).alias("n"))
    part = F.col("h") % F.col("slots") + 64 * F.pmod(F.xxhash64("b", F.lit(1)), F.col("n"))
    dealt = hashed.join(parts, ["a", "h"]).select("a", part.cast("long").alias("part"), F.col("b").alias("uid"))
    ids = dealt.unionByName(dealt.select("a", "part").distinct().select("a", "part", F.col("a").alias("uid")))
    met = ids.hint("merge").join(payload, "uid")  # one plan at every size
    met = met.select("a", "part", "uid", (F.col("uid") != F.col("a")).alias("partner"), *[c for c in payload.columns if c != "uid"])
    return met.repartition("a", "part").sortWithinPartitions("a", "part", "partner")


def _check(pairs: DataFrame, nodes: DataFrame, p: NearDup, scratch: Scratch, sketched: bool) -> DataFrame:
    """Pairs (a < b) with ``ok``: whether their full sets confirm the link."""
    if sketched:
        pairs = pairs.join(nodes.select(F.col("uid").alias("b"), F.col("n_shingles").alias("nb")), "b").select("a", "b", "nb")
    else:
        pairs = _meet(scratch.write(pairs, "pairs"), nodes.select("uid", "n_shingles", "odd"), "", p.block).mapInArrow(_close(p), "a long, b long, nb long")
    pairs = scratch.write(pairs, "candidates")
    out = scratch.write(_meet(pairs, nodes.select("uid", "text"), "nb", p.confirm).mapInArrow(_confirmed(p), "a long, b long, ok boolean"), "checked")
    scratch.drop(pairs)
    return out


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", params: NearDup | None = None, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_shingles``, ``component_id``, ``kept``, ``keeper``.

    With ``carry``: the rows of ``docs`` that are keepers, with their columns as they were.

    Words are runs of anything but ASCII white space, A-Z lowered.  ``component_id``
    is the smallest id reachable over links; ``kept`` says that the row has that
    id; ``keeper`` is true for exactly one row of each group, also when ids repeat.

    Null or wordless text: an empty set, linked with nothing, kept.  A null id
    takes part by its text but is never a group's id unless no row there has one,
    and then ``component_id`` is null and the rows are kept.  Repeated rows have
    equal sets and so one group.  Columns other than the two are ignored,
    whatever their names.
    """
    p = params or NearDup()
    spark = docs.sparkSession
    scratch = Scratch(spark, "neardup")
    source = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"), F.struct(F.lit(0).alias(free_name("none", docs.columns)), *[c for c in docs.columns if c != text_col]).alias("row") if carry else F.lit(None).cast("boolean").alias("row"))
    schema = T.StructType([*source.schema.fields, *T._parse_datatype_string("n_shingles long, k1 long, k2 long, bands array<long>, odd binary").fields])
    base = scratch.write(source.mapInArrow(_sketches(p), schema), "sketches")

    some = base.where("n_shingles > 0")
    classes = scratch.write(some.groupBy("k1", "k2").agg(F.min("uid").alias("rep")), "classes")
    keyed = base.select("uid", "bands").join(classes.select(F.col("rep").alias("uid")), "uid", "left_semi").select("uid", F.posexplode("bands").alias("band", "bucket"))
    starts = keyed.groupBy("band", "bucket").agg(F.min("uid").alias("start"), F.count("*").alias("n")).where("n > 1").select("band", "bucket", "start")
    members = keyed.join(starts, ["band", "bucket"]).groupBy("uid").agg(F.collect_list(F.struct("band", "bucket", "start")).alias("met"))
    members = scratch.write(members, "members")  # classes with their buckets, one in each band at most
    nodes = base.select("uid", "text", "n_shingles", "odd", "bands").join(members.select("uid").hint("merge"), "uid", "left_semi")
    nodes = scratch.write(nodes, "nodes")  # texts and sketches of the classes that share a bucket; no others are moved

    # the first class of a bucket is its star; each class meets the star that it shares most bands with, and others only if they stay apart
    stars = members.select(F.col("uid").alias("b"), F.explode("met.start").alias("a")).where("a <> b").groupBy("b", "a").agg(F.count("*").alias("shared"))
    closest = stars.groupBy("b").agg(F.max(F.struct("shared", (-F.col("a")).alias("a"))).alias("s")).select((-F.col("s.a")).alias("a"), "b")
    tested = [_check(closest, nodes, p, scratch, sketched=False)]
    comps = _grown(None, tested[0], scratch)
    apart = _labelled(members, comps)
    heads = apart.groupBy("band", "bucket").agg(F.min_by("component", "uid").alias("of"), F.min("component").alias("c0"), F.max("component").alias("c1")).where("c0 < c1").select("band", "bucket", "of")
    others = apart.join(heads, ["band", "bucket"]).where("component <> of").select(F.col("start").alias("a"), F.col("uid").alias("b")).distinct()
    others = others.join(tested[0].select("a", "b"), ["a", "b"], "left_anti")
    tested.append(_check(others, nodes, p, scratch, sketched=False))
    comps = _grown(comps, tested[1], scratch)
    for most in p.rounds:
        labelled = _labelled(members, comps)
        # the largest component of a bucket, whose classes are not compared with one another, and the others
        sizes = labelled.groupBy("band", "bucket", "component").agg(F.count("*").alias("n"))
        split = sizes.groupBy("band", "bucket").agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("n"), F.count("*").alias("kinds")).where("kinds > 1 and n > 2")
        parts = lambda n: F.ceil(n / p.block).cast("int")
        split = split.select("band", "bucket", F.col("main.component").alias("main"), parts(F.col("main.n")).alias("mains"), parts(F.col("n") - F.col("main.n")).alias("rest"))
        open_rows = scratch.write(labelled.join(split, ["band", "bucket"]), "open")
        if open_rows.isEmpty():
            scratch.drop(open_rows)
            break
        named = _dealt(open_rows).join(nodes.select("uid", "odd", "n_shingles", "bands"), "uid").groupBy("band", "bucket", "main", "p0", "p1").applyInArrow(_partners(p, most), "a long, b long, capped boolean")
        named = scratch.write(named, "named")
        pairs = named.select("a", "b").distinct()
        for done in tested:
            pairs = pairs.join(done.select("a", "b"), ["a", "b"], "left_anti")
        tested.append(_check(pairs, nodes, p, scratch, sketched=True))
        comps = _grown(comps, tested[-1], scratch)
        done = named.where("capped").isEmpty()  # then every candidate pair has been tested
        scratch.drop(open_rows, named)
        if done:
            break

    rows = base.select("uid", "id", "n_shingles", "k1", "k2")
    roots = classes.join(comps.withColumnRenamed("node", "rep"), "rep", "left").select("k1", "k2", F.coalesce("component", "rep").alias("root"))
    filled = rows.where("n_shingles > 0").join(roots, ["k1", "k2"]).select("uid", "id", "n_shingles", "root")
    grouped = scratch.write(filled.unionByName(rows.where("n_shingles = 0").withColumn("root", F.col("uid")).select("uid", "id", "n_shingles", "root")), "grouped")
    scratch.drop(classes, nodes, members, *tested, *([] if carry else [base]))
    # a group's smallest id and, of the rows with that id, the first; written, so that the join below stands alone and can be split
    first = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id"), F.col("uid"))).alias("f")
    heads = scratch.write(grouped.groupBy("root").agg(first).select("root", F.col("f.id").alias("component_id"), F.col("f.uid").alias("keeper_uid")), "heads")
    marked = grouped.join(heads, "root").withColumn("keeper", F.col("uid") == F.col("keeper_uid"))
    if carry:
        left = base.select("uid", "text", "row").join(marked.where("keeper").select("uid"), "uid", "left_semi")
        return left.select(*[F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns])
    return marked.select(F.col("id").alias(id_col), "n_shingles", "component_id", F.expr("id <=> component_id").alias("kept"), "keeper")


def _labelled(members: DataFrame, comps: DataFrame) -> DataFrame:
    """Classes of each bucket with their component, those without a link being their own."""
    found = members.join(comps.withColumnRenamed("node", "uid"), "uid", "left")
    return found.select("uid", F.coalesce("component", "uid").alias("component"), F.inline("met"))


def _dealt(rows: DataFrame) -> DataFrame:
    """Classes of open buckets, dealt to the blocks where they meet: the largest component's with all others', and the others' with one another.

    ``side``: 0 names partners, 1 is named, 2 does both.
    """
    part = lambda n: F.pmod(F.xxhash64("uid"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    kept = ["band", "bucket", "component", "uid"]
    main = rows.where("component = main").withColumn("p1", every("rest")).select(*kept, F.lit(True).alias("main"), part("mains").alias("p0"), "p1", F.lit(1).alias("side"))
    rest = rows.where("component <> main")
    met = rest.withColumn("p0", every("mains")).select(*kept, F.lit(True).alias("main"), "p0", part("rest").alias("p1"), F.lit(0).alias("side"))
    own = rest.withColumn("part", part("rest")).withColumn("other", every("rest"))
    side = F.when(F.col("part") == F.col("other"), 2).when(F.col("part") < F.col("other"), 0).otherwise(1)
    own = own.select(*kept, F.lit(False).alias("main"), F.least("part", "other").alias("p0"), F.greatest("part", "other").alias("p1"), side.alias("side"))
    return main.unionByName(met).unionByName(own)


def _grown(comps: DataFrame | None, tested: DataFrame, scratch: Scratch) -> DataFrame:
    """Components once the confirmed ones of ``tested`` join those of before."""
    links = tested.where("ok").select("a", "b")
    if comps is not None:
        if links.isEmpty():
            return comps
        links = links.union(comps.select("node", "component"))
    return scratch.write(connected_components(links, scratch), "components")


def op3_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs)
