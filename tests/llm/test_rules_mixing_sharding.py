import math
import random
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from atlasweave.llm.mixing import OP5_SQL, mix_sources, source_targets
from atlasweave.llm.rules import OP9_SQL, with_rules
from atlasweave.llm.scratch import Scratch
from atlasweave.llm.sharding import Sharding, _propagate, balanced_shards

from . import cases

UNIQUE = lambda rows: list({r[0]: r for r in rows if r[0] is not None}.values())


def in_duckdb(rows, sql):
    db = duckdb.connect()
    db.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, source VARCHAR)")
    db.executemany("INSERT INTO documents VALUES (?, ?, ?)", [r[:3] for r in rows])
    return db.execute(sql).fetchall(), [c[0] for c in db.description]


def same(got, want):
    rows, names = want
    key = lambda r: tuple(round(x, 6) if isinstance(x, float) else x for x in r)
    assert sorted(map(key, (tuple(r[n] for n in names) for r in got)), key=str) == sorted(map(key, rows), key=str)


def brute_repeats(ws):
    windows = Counter(zip(ws, ws[1:], ws[2:], strict=False))
    return len({i + k for i in range(len(ws) - 2) if windows[tuple(ws[i : i + 3])] > 1 for k in range(3)})


def test_rules(spark):
    rows = [*UNIQUE(cases.documents()), (900, "a b c a b c a b", "a", "", "", "", 0), (901, "x\nx\n\nx \ny", "a", "", "", "", 0), (902, "the # of | and " * 30, "a", "", "", "", 0)]
    out = with_rules(cases.frame(spark, rows))
    assert out.columns == [*cases.frame(spark, rows).columns, "_rules"]
    got = {r.doc_id: r._rules for r in out.collect()}
    for r in rows:
        ws, m = cases.words(r[1]), got[r[0]]
        assert (m.n_words, m.word_chars, m.n_repeat_words) == (len(ws), sum(map(len, ws)), brute_repeats(ws))
        assert m.base_failed == (len(ws) < 50 or 2 * m.n_repeat_words > len(ws))
        assert not (m.kept and m.base_failed)
    assert got[901].n_dup_lines == 1 and "symbols" in got[902].failed and got[50].kept is False  # w123 words hold no stop words
    query = [dict(doc_id=k, failed=",".join(m.failed), **{n: m[n] for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")}) for k, m in got.items()]
    same(query, in_duckdb(rows, OP9_SQL))
    assert with_rules(cases.frame(spark, [])).count() == 0


def test_targets_stop_and_are_shared_again(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), (None, 500), ("c", 0)], "source string, source_size long")
    got = {r.source: r.target for r in source_targets(sizes, Scratch(spark, "test")).collect()}
    assert got["a"] == 30 and got["c"] == 0 and sum(got.values()) == pytest.approx(1510)
    assert got[None] / got["b"] == pytest.approx(1 / 2)  # places: a 1, b 2, c 3, null 1


def test_targets_of_many_sources_are_the_plain_ones(spark):
    rng = random.Random(17)
    given = {f"h{rng.randrange(10**6)}": rng.choice([0, 1, 7, 90, 4000]) for _ in range(400)} | {None: 50}
    got = {r.source: r.target for r in source_targets(spark.createDataFrame(list(given.items()), "source string, source_size long"), Scratch(spark, "test")).collect()}
    names = sorted((n for n in given if n is not None)) + [None]
    weight = {n: 1.0 + i % 3 for i, n in enumerate(names)}
    want, free = {}, set(names)
    while True:
        left = sum(given.values()) - sum(want.values())
        level = left / sum(weight[n] for n in free)
        over = {n for n in free if level * weight[n] > 3 * given[n]}
        if not over:
            break
        want |= {n: 3.0 * given[n] for n in over}
        free -= over
    want |= {n: level * weight[n] for n in free}
    assert got == {n: pytest.approx(v) for n, v in want.items()}


def test_mixing_spreads_rows_without_ids(spark):
    rows = [(None, "w " * (1 + i % 7) + f"n{i}", "ab"[i % 2], "", "", "", 0) for i in range(600)]
    got = [sorted((r.source_size, r["size"], r.taken) for r in mix_sources(cases.frame(spark, rows[::d])).collect()) for d in (1, -1)]
    assert got[0] == got[1]  # whatever the order of the rows


def test_mixing(spark):
    rows = UNIQUE(cases.documents())
    got = mix_sources(cases.frame(spark, rows)).collect()
    same(got, in_duckdb(rows, OP5_SQL))
    assert all(r.taken <= 3 * r["size"] and r.taken % max(1, r["size"]) == 0 for r in got)
    again = mix_sources(cases.frame(spark, rows)).collect()
    assert sorted(map(str, got)) != [] and sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    assert mix_sources(cases.frame(spark, [])).count() == 0
    assert mix_sources(cases.frame(spark)).count() == len(cases.documents())  # repeated and null ids


def test_mixing_keeps_to_targets(spark):
    rows = [(i, "w " * (1 + i % 7), "ab"[i % 10 == 0], "", "", "", 0) for i in range(3000)]
    got = mix_sources(cases.frame(spark, rows)).collect()
    for source in "ab":
        own = [r for r in got if rows[r.doc_id][2] == source]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 7


def test_propagation_is_the_plain_one(spark):
    rng = random.Random(23)
    p = Sharding(shards=5, rounds=6)
    blocks = [(f"g{g}", start, part, rng.randrange(1, 60)) for g in range(40) for start in range(5) for part in range(rng.randrange(0, 3))]
    share = sum(b[3] for b in blocks) / p.shards / 0.9
    frame = spark.createDataFrame(blocks, "grp string, start int, part int, bytes long")
    ties = {(r.grp, r.shard): r.h for r in frame.select("grp").distinct().crossJoin(spark.range(5).select(F.col("id").cast("int").alias("shard"))).select("grp", "shard", F.xxhash64("grp", "shard").alias("h")).collect()}
    turns = {(r.grp, r.start, r.part): r.h for r in frame.select("grp", "start", "part", F.pmod(F.xxhash64("grp", "start", "part"), F.lit(4096)).alias("h")).collect()}

    at = {b[:3]: b[1] for b in blocks}
    size = {b[:3]: b[3] for b in blocks}
    for _ in range(p.rounds):
        sizes = [sum(size[b] for b in at if at[b] == i) for i in range(p.shards)]
        held = {}
        for b, shard in at.items():
            held[b[0], shard] = held.get((b[0], shard), 0) + size[b]
        open_ = {i for i in range(p.shards) if sizes[i] < p.full * share - 1}
        want = {}
        for b, shard in at.items():
            there = max(((h, ties[g, i], i) for (g, i), h in held.items() if g == b[0] and i in open_), default=None)
            if there and shard in open_ and there[2] != shard:
                want.setdefault((shard, there[2]), []).append((64 - math.ceil(math.log2(there[0] - held[b[0], shard] + 2)), turns[b], b))
        flow = {k: sum(size[b] for *_, b in v) for k, v in want.items()}
        asked = [sum(max(0, f - flow.get((j, i), 0)) for (i, j), f in flow.items() if j == k) for k in range(p.shards)]
        moves = {}
        for (i, j), queue in want.items():
            back = min(flow[i, j], flow.get((j, i), 0))
            quota = back + (max(0.0, p.full * share - sizes[j]) * (flow[i, j] - back) / asked[j] if asked[j] else 0)
            total = 0
            for *_, b in sorted(queue):
                total += size[b]
                if total <= quota:
                    moves[b] = j
        if not moves:
            break
        at |= moves
    assert sum(at[b] != b[1] for b in at) > 10
    sizes = [sum(b[3] for b in blocks if b[1] == i) for i in range(p.shards)]
    scratch = Scratch(spark, "test")
    got = _propagate(scratch.write(frame.withColumn("shard", F.col("start")), "blocks"), sizes, share, p, scratch).collect()
    assert {(r.grp, r.start, r.part): r.shard for r in got} == at
    assert sizes == [sum(size[b] for b in at if at[b] == i) for i in range(p.shards)]


def test_sharding_of_repeated_rows_and_no_ids(spark):
    rows = [(None, "same", "a", "", "", "", 0)] * 300 + [(7, "one", "a", "", "", "", 0)] * 300 + [(i, None, "a", "", "", "", 0) for i in range(100, 200)]
    got = balanced_shards(cases.frame(spark, rows), params=Sharding(shards=3)).collect()
    by = Counter(r.shard for r in got)
    assert len(got) == 700 and all(sorted(r.slot for r in got if r.shard == s) == list(range(n)) for s, n in by.items())


def test_sharding(spark):
    rows = cases.documents() + [(1000 + i, f"same {i % 40}", "a", "", "", "", 0) for i in range(1200)] + [(5000 + i, f"own {i} " * 20, "a", "", "", "", 0) for i in range(1500)]
    got = balanced_shards(cases.frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r.shard, []).append(r)
    text = {}
    for r in rows:
        text.setdefault(r[0], r[1] or "")
    for r in got:
        if r.doc_id is not None:
            assert r["size"] == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
    assert all(sorted(r.slot for r in own) == list(range(len(own))) for own in by.values())
    shards = {}
    for r in got:
        shards.setdefault((r.text_crc32, r["size"]), set()).add(r.shard)
    whole = [len(s) == 1 for k, s in shards.items() if sum((r.text_crc32, r["size"]) == k for r in got) > 1]
    assert sum(whole) >= 0.9 * len(whole)
    assert balanced_shards(cases.frame(spark, [])).count() == 0


def test_sharding_splits_a_group_larger_than_a_shard(spark):
    rows = [(i, "the same text", "a", "", "", "", 0) for i in range(900)] + [(10_000 + i, f"own {i}", "a", "", "", "", 0) for i in range(2700)]
    got = balanced_shards(cases.frame(spark, rows), params=Sharding(shards=4)).collect()
    sizes = Counter()
    for r in got:
        sizes[r.shard] += r["size"]
    assert max(sizes.values()) < 1.03 * min(sizes.values())
