import os

import pytest

from atlasweave.llm.neardup import NearDup, near_duplicates

from . import cases


def brute(rows, percent=85):
    sets, parent = [], list(range(len(rows)))
    for r in rows:
        w = cases.words(cases.lower(r[1]))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return sorted(((r[0], len(sets[i]), ids.get(find(i))) for i, r in enumerate(rows)), key=str)


def test_as_brute_force(spark):
    rows = cases.documents()
    got = near_duplicates(cases.frame(spark, rows)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    keepers = [r for r in got if r.keeper]
    assert len({r.component_id for r in keepers if r.component_id and r.n_shingles}) == len([r for r in keepers if r.component_id and r.n_shingles])


def test_large_bucket_in_small_blocks(spark):
    """Copies at about the threshold: links that only pairs away from the bucket's first class have."""
    import random

    rng = random.Random(5)
    base = [f"v{rng.randrange(10**6)}" for _ in range(150)]
    rows = []
    for i in range(60):
        w = list(base)
        for at in rng.sample(range(150), rng.choice((1, 2, 3, 4))):
            w[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(w), "a", "u", "i", "l", 1))
    got = near_duplicates(cases.frame(spark, rows), params=NearDup(block=8)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


def test_empty_table_and_carry(spark):
    empty = cases.frame(spark, [])
    assert near_duplicates(empty).count() == 0
    kept = near_duplicates(cases.frame(spark), carry=True)
    assert kept.columns == cases.frame(spark).columns
    texts = [r.text for r in kept.collect()]
    assert len([t for t in texts if t and t.startswith(cases.documents()[4][1][:40])]) <= 2
    assert sum(t is None or not t.strip() for t in texts) == 3


def test_unlinked_and_linked_classes_of_one_bucket(spark):
    """A large component, small ones and single classes that share most of their words."""
    import random

    rng = random.Random(15)
    base = [f"v{k}" for k in range(200)]
    rows = []
    for i in range(70):
        w = list(base)
        for at in rng.sample(range(200), 2 if i < 40 else rng.choice((8, 9, 10))):
            w[at] = f"x{i}y{at}" if i < 60 else f"z{i % 5}y{at}"
        rows.append((i, " ".join(w), "a", "u", "i", "l", 1))
    for params in (NearDup(), NearDup(block=7, rounds=(1, 0), confirm=300)):
        got = near_duplicates(cases.frame(spark, rows), params=params).collect()
        assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(rows)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no test tables")
def test_table_as_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = near_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
