import random

import corpus_pipeline
from atlasweave.llm.rules import with_rules

from . import cases


def test_stages(spark, tmp_path):
    rows = [(i, ("the cat and the dog of it " * 3 + cases.prose(random.Random(i % 40), 80, 4000)), "abc"[i % 3]) for i in range(80)]
    item = cases.prose(random.Random(999), 25, 4000)
    rows += [(500, "the of and " + cases.prose(random.Random(7000), 80, 4000) + " " + item, "a"), (501, "junk", "b"), (502, None, None)]
    docs = spark.createDataFrame([(a, b, "en", c, 1) for a, b, c in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now, counts = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        counts.append(now.count())
        if name != corpus_pipeline.STAGES[-1][0]:
            assert now.columns == docs.columns
        if name == "quality_rules":
            assert counts[0] == with_rules(docs).where("_rules.kept").count() and now.where("doc_id in (501, 502)").count() == 0
        if name == "near_dedup":
            assert sorted(r.doc_id for r in now.collect()) == [*range(40), 500]
        if name == "decontamination":
            assert sorted(r.doc_id for r in now.collect()) == list(range(40))
    assert counts[4] == counts[3] > 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == counts[4]


def test_near_dedup_stage_links_at_four_fifths(spark):
    def edited(n, *places):
        return " ".join(f"e{n}x{k}" if k in places else f"w{n}x{k}" for k in range(100))

    rows = [(n, edited(n), "a") for n in range(3)] + [(10 + n, edited(n, 30, 60), "b") for n in range(3)]  # 86 of 106 shingles: 0.81
    rows += [(20, edited(0, 20, 50, 80), "b")]  # 81 of 111: 0.73
    out = corpus_pipeline.deduplicate(spark, spark.createDataFrame(rows, "doc_id long, text string, source string"), "")
    assert sorted(r.doc_id for r in out.collect()) == [0, 1, 2, 20]


CLASHES = ("_row", "_times", "_copy", "_rules", "_leak", "row", "times", "copy", "rules", "leak", "uid", "none", "_no_column", "size", "taken", "grp", "n")


def test_stages_keep_clashing_columns_and_bear_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, "some test item that nobody holds at all")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    good = "the cat and the dog of it " + cases.prose(random.Random(1), 80, 4000)
    rows = [(1, good, "a"), (1, good, "a"), (None, good, "a"), (2, None, "b"), (3, "", None), (4, " ".join("the" if k % 20 == 0 else w for k, w in enumerate(cases.prose(random.Random(2), 30_000, 10**6).split())), None)]
    docs = spark.createDataFrame([(*r, *range(len(CLASHES))) for r in rows], "doc_id long, text string, source string, " + ", ".join(f"`{c}` int" for c in CLASHES))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(tuple(r)[3:] == tuple(range(len(CLASHES))) for r in out.collect())
        assert stage(spark, docs.where("false"), str(tmp_path)).count() == 0
    kept = corpus_pipeline.quality(spark, docs, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "1", "4", "None"]
    assert sorted(str(r.doc_id) for r in corpus_pipeline.deduplicate(spark, docs, str(tmp_path)).collect()) == ["1", "2", "3", "4"]
    assert corpus_pipeline.decontaminate(spark, docs, str(tmp_path)).count() == 6
    spread = corpus_pipeline.shard(spark, docs, str(tmp_path)).collect()
    assert len(spread) == 6 and corpus_pipeline.shard(spark, docs.where("false"), str(tmp_path)).count() == 0
