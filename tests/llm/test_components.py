import random

from atlasweave.llm.components import connected_components
from atlasweave.llm.scratch import Scratch


def test_components_are_those_of_a_walk(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(7, k) for k in range(200, 260)] + [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(5, 5), (9, 8), (8, 9), (9, 8)]
    near = {}
    for a, b in edges:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    want = {}
    for node in sorted(near):
        todo = [] if node in want else [node]
        while todo:
            at = todo.pop()
            if at not in want:
                want[at] = node
                todo += near[at]
    got = connected_components(spark.createDataFrame(edges, "a long, b long"), Scratch(spark, "test")).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert connected_components(spark.createDataFrame([], "a long, b long"), Scratch(spark, "test")).count() == 0
