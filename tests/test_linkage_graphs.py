import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from atlasweave.functions import articles, names, tags
from atlasweave.operators import graphs, reconcile, sinks, snapshots, spatial
from atlasweave.plans.map_queries import GOLDEN

ROUTES = {("A", "B"): 93.30, ("A", "C"): 238.82, ("A", "D"): 159.29, ("A", "E"): 341.76, ("B", "C"): 257.42, ("B", "D"): 177.89, ("B", "E"): 360.36, ("C", "D"): 156.39, ("C", "E"): 102.94, ("D", "E"): 259.33}
SECOND = {("A", "B"): None, ("A", "C"): 263.81, ("C", "D"): None}


@pytest.fixture(scope="module")
def golden(spark):
    return spark.createDataFrame([(a, b, x, x) for a, b, x in GOLDEN], "node1_id string, node2_id string, length double, weight double")


def test_golden_routes(spark, golden):
    starts = spark.createDataFrame([(n, n) for n in "ABCD"], "run string, node string")
    got = {(r.run, r.node): r.cost for r in graphs.shortest_from(golden, starts).collect()}
    for pair, cost in ROUTES.items():
        assert got[pair] == pytest.approx(cost, abs=1e-6)
    path = graphs.find_path(golden, "A", "E").first()
    assert path.path == ["A", "INT2", "INT3", "INT1", "C", "E"] and path.exists
    assert not graphs.find_path(golden, "A", "nowhere").first().exists
    same = graphs.find_path(golden, "A", "A").first()
    assert same.path == ["A"] and same.distance == 0


@pytest.mark.parametrize("pair", SECOND)
def test_second_best(golden, pair):
    got = [r.length for r in graphs.k_shortest(golden, *pair).collect()]
    assert got[0] == pytest.approx(ROUTES[pair]) and (len(got) == 1 if SECOND[pair] is None else got[1] == pytest.approx(SECOND[pair]))


def test_thick_lines_flip_the_winner(spark):
    edges = spark.createDataFrame([("a", "b", 10.0, 10.0), ("a", "c", 6.0, 3.0), ("c", "b", 6.0, 3.0), ("x", "y", 1.0, 1.0)], "node1_id string, node2_id string, length double, weight double")
    assert graphs.find_path(edges, "a", "b").first().path == ["a", "b"]
    heavy = graphs.find_path(edges, "a", "b", weighted=True).first()
    assert heavy.path == ["a", "c", "b"] and (heavy.distance, heavy.weighted_distance) == (12, 6)
    report = sinks.route_report(*[graphs.find_path(edges, "a", to) for to in ("b", "c", "y")])
    assert [r.line for r in report.collect()][2] == "Second: no path"


def test_network_from_curves(spark):
    paths = spark.createDataFrame([("p1", 0, "M 0 0 L 100 0", "stroke-width:4.1px"), ("p2", 1, "M 50 -40 L 50 60", None)], "path_id string, path_ord int, d string, style string")
    places = spark.createDataFrame([("X", 2.0, 1.0), ("Y", 51.0, 58.0), ("Far", 500.0, 500.0)], "name string, x double, y double")
    nodes, edges = graphs.build_network(paths, places)
    kinds = {r.id: r.node_type for r in nodes.collect()}
    assert {k: v for k, v in kinds.items() if v == "location"} == {"X": "location", "Y": "location"} and kinds["INT1"] == "intersection" and "Far" not in kinds
    links = {frozenset((r.node1_id, r.node2_id)): r for r in edges.collect()}
    ab = links[frozenset(("X", "INT1"))]
    assert ab.length == pytest.approx(48, abs=2.5) and ab.weight == pytest.approx(ab.length / 2)
    assert sinks.network_map(nodes, edges).count() >= len(kinds)
    drawn = sinks.annotate("<svg></svg>", [r.element for r in sinks.drawing_layer(nodes, edges).collect()])
    assert drawn.count("<line") == edges.count() and sinks.annotate(drawn, []).count("<line") == 0
    valid = graphs.is_location(nodes, spark.createDataFrame([("x",), ("int1",)], "name string")).collect()
    assert {r.name: r.valid for r in valid} == {"x": True, "int1": False}


def test_grid_join_is_the_plain_join(spark):
    rng = random.Random(1)
    a = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(80)]
    b = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(80)]
    got = spatial.distance_join(spark.createDataFrame(a, "i int, ax double, ay double"), spark.createDataFrame(b, "j int, bx double, by double"), 1.3)
    want = {(i, j) for i, x, y in a for j, u, v in b if (x - u) ** 2 + (y - v) ** 2 < 1.3**2}
    assert {(r.i, r.j) for r in got.collect()} == want
    near = spatial.nearest(spark.createDataFrame(a, "i int, ax double, ay double"), spark.createDataFrame(b, "j int, bx double, by double"), "i", 3.0, ["j"], ["j"])
    for r in near.collect():
        _, x, y = a[r.i]
        assert r.j == min(b, key=lambda q: ((x - q[1]) ** 2 + (y - q[2]) ** 2, q[0]))[0]


@pytest.mark.parametrize("block", [8, 2048])
def test_pairs_within_is_the_plain_join(spark, block):
    rng = random.Random(4)
    rows = [(i, rng.uniform(-5, 5), rng.uniform(-5, 5)) for i in range(150)] + [(200 + i, rng.gauss(-1, 0.1), rng.gauss(2, 0.1)) for i in range(60)]
    rows += [(300 + i, 1.3 * (i % 4), -1.3) for i in range(12)]  # on the edges of cells, and copies
    rng.shuffle(rows)
    rows += [(7, 0.0, 0.0), (None, 0.0, 0.0), (400, None, 0.0), (401, float("nan"), 0.0), (402, float("inf"), 0.0), (403, float("inf"), 0.0), (404, 1e300, 0.0), (405, 1e300, 0.0)]
    got = spatial.pairs_within(spark.createDataFrame(rows, "id int, x double, y double"), "id", 1.3, block=block)
    far = lambda x, y, u, v: math.sqrt((x - u) * (x - u) + (y - v) * (y - v))
    placed = [r for r in rows if None not in r]
    want = sorted((i, j, far(x, y, u, v)) for i, x, y in placed for j, u, v in placed if i < j and far(x, y, u, v) < 1.3)
    assert got.columns == ["a", "b", "dist"] and len(want) > 2000
    assert sorted(map(tuple, got.collect())) == want


def test_pairs_of_a_full_cell_are_the_work_of_many_tasks(spark):
    points = spark.range(200).select("id", (F.col("id") / 1000).alias("x"), (F.col("id") % 7 / 1000).alias("y"))
    got = spatial.pairs_within(points, "id", 1.0, block=10).select(F.spark_partition_id().alias("task"))
    shares = [r["count"] for r in got.groupBy("task").count().collect()]
    assert sum(shares) == 200 * 199 / 2 and max(shares) < sum(shares) / 2


def test_nearest_over_levels_is_the_plain_search(spark):
    rng = random.Random(3)
    towns = [(rng.uniform(-9, 9), rng.uniform(-9, 9)) for _ in range(3)]
    b = [(d, i, *(rng.gauss(c, 0.05) for c in rng.choice(towns))) for i in range(400) for d in "pq"]  # clumps that most rows lie beside
    b += [(d, 1000 + i, float(i % 5), 0.0) for i in range(40) for d in "pq"]  # places that many share
    a = [(d, i, rng.uniform(-12, 12), rng.uniform(-12, 12)) for i in range(150) for d in "pq"] + [("p", 900, 2.5, 0.0), ("p", 901, 2.5, 0.0), ("r", 902, 0.0, 0.0), ("p", 903, float("nan"), 0.0), ("p", 904, None, 0.0), ("p", 905, 14.0, 0.0)]
    asked, points = spark.createDataFrame(a, "doc string, i int, ax double, ay double"), spark.createDataFrame(b, "doc string, j int, bx double, by double")
    near = spatial.nearest(asked, points, "i", 4.0, ["j", "bx"], ["j"], on=("doc",), levels=3)
    want = {}
    for d, i, x, y in a:
        found = [(math.sqrt((x - u) ** 2 + (y - v) ** 2), j) for e, j, u, v in b if x is not None and e == d]
        if found and min(found)[0] < 4:
            want[d, i] = min(found)[1]
    assert near.columns == ["doc", "i", "dist", "j", "bx"] and len(want) > 100
    assert {(r.doc, r.i): r.j for r in near.collect()} == want


def test_thinning(spark):
    rng = random.Random(2)
    points = [(0, i, rng.uniform(0, 30), rng.uniform(0, 30)) for i in range(200)]
    kept = []
    for _, i, x, y in points:
        if all((x - u) ** 2 + (y - v) ** 2 >= 9 for _, u, v in kept):
            kept.append((i, x, y))
    got = spatial.thin(spark.createDataFrame(points, "g int, i int, x double, y double"), ["g"], 3.0, ["i"])
    assert sorted(r.i for r in got.collect()) == [i for i, _, _ in kept]


def test_merge(spark):
    own = spark.createDataFrame([("Köln", "", "", 0), ("Bonn", "kept", "", 1)], "Settlement string, Notes string, Tags string, _ord long")
    other = spark.createDataFrame([("Koeln", "", 0), ("Koln", "second", 1), ("Köln", "third", 2), ("Bonn", "new", 3), ("Neuss", "n", 4), ("Neuss", "n", 5)], "Settlement string, Notes string, _ord long")
    got = sorted((r.Settlement, r.Notes, r.Tags) for r in reconcile.merge(own, other, {"Notes": "Notes"}).collect())
    assert got == [("Bonn", "kept", ""), ("Köln", "second", ""), ("Neuss", "n", '"source:MadAlfred"'), ("Neuss", "n", '"source:MadAlfred"')]


def test_wiki_lookup_and_overwrite(spark):
    places = spark.createDataFrame([("Düsseldorf (Altstadt)",), ("Nichts",)], "Settlement string")
    pages = spark.createDataFrame([("Altstadt", "u1"), ("Dusseldorf", "u2")], "title string, url string")
    got = {r.Settlement: (r.status, r.page.url if r.page else None) for r in reconcile.wiki_lookup(places, pages).collect()}
    assert got == {"Düsseldorf (Altstadt)": ("found", "u2"), "Nichts": ("missing", None)}
    rows = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    assert sorted(map(tuple, reconcile.overwrite(rows, spark.createDataFrame([("a", "")], "k string, v string"), "k", ["v"]).collect())) == [("a", ""), ("b", "y")]


def test_names_and_tags(spark):
    row = spark.range(1).select(
        names.comparison_variants(F.lit(" Größe ")).alias("c"),
        names.bracket_variants(F.lit("A (B) (C)")).alias("b"),
        names.strip_marks(F.lit("Éçøß")).alias("s"),
        names.strip_marks_any(F.lit("Éçøß")).alias("t"),
        tags.parse_tags(F.lit('"""source:2eSH"""'), F.lit("timber; textiles")).alias("tags"),
        tags.tag_issues(F.array(F.lit("source:2eSH"), F.lit("source:no"), F.lit("plain"), F.lit("a:b:c"))).alias("issues"),
    ).first()
    assert row.c == ["größe", "große", "groesse"] or row.c[:2] == ["größe", "große"] and "grösse" in row.c and "groeße" in row.c
    assert row.b == ["A (B) (C)", "A", "B"] and row.s == row.t == "Ecøß"
    assert row.tags == ["source:2eSH", "trade:timber", "trade:textiles"] and row.issues == ["source:no", "format:plain"]


def test_description(spark):
    html = """<aside><p>aside text that is long enough here</p></aside><p>short</p><p>"quoted paragraph that is long enough"</p>
    <p>First one[1] is here , with Mr. smith. Second<sup class="reference">[2a]</sup> sentence! Third? Fourth.</p><p>""" + "Long " * 60 + """</p><p>Never reached because enough was said.</p>"""
    got = spark.createDataFrame([(html,), (None,), ("<p>",)], "h string").select(articles.description(F.col("h")).alias("d")).collect()
    assert got[0].d == "First one is here, with Mr. smith. Second sentence! Third?" and got[1].d == got[2].d == ""


def test_snapshots(spark, tmp_path):
    old = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "k string, v string")
    new = spark.createDataFrame([("a", "1"), ("b", ""), ("d", "4")], "k string, v string")
    assert {r.k: (r.change, r.columns) for r in snapshots.difference(old, new, ["k"], ["v"]).collect()} == {"a": ("same", None), "b": ("changed", "v"), "c": ("removed", None), "d": ("added", None)}
    assert [r.k for r in snapshots.emptied(old, new, ["k"], "v").collect()] == ["b"]
    rows = spark.createDataFrame([("s", 1), ("s", 3), ("s", 2)], "series string, taken int")
    assert {r.taken: r.before for r in snapshots.consecutive(rows).collect()} == {1: None, 2: 1, 3: 2}
    source = tmp_path / "a.geojson"
    source.write_text("{}")
    out = tmp_path / "live"
    assert snapshots.deploy({"a": source}, out, ["a", "zz"]) == {"a": "deployed", "zz": "missing"}
    snapshots.deploy({"a": source}, out)
    assert len(list(out.iterdir())) == 2
    assert snapshots.mark_validated(tmp_path, {"a": []}) and not snapshots.mark_validated(out, {"a": ["bad"]})
    gaps = spark.createDataFrame([("k", "u", ""), ("l", "", "")], "key string, url string, description string")
    filled = snapshots.fill_descriptions(gaps, spark.createDataFrame([("k", "<p>A sentence that is long enough.</p>")], "key string, html string"), "key", "url", "description")
    assert {r.key: r.description for r in filled.collect()} == {"k": "A sentence that is long enough.", "l": ""}


def test_landing_stream(spark, tmp_path):
    from atlasweave.sources.gazetteers import HEADERS
    from atlasweave.streaming.landing import landing_stream

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "empire_20240101_000000.csv").write_text(",".join(HEADERS["wiki"]) + "\na,b,c,d,e\n")
    stream = landing_stream(spark, str(tmp_path / "in"), "wiki").writeStream.format("memory").queryName("landed").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    stream.awaitTermination(60)
    assert [(r.settlement, r.series, str(r.taken)) for r in spark.table("landed").collect()] == [("a", "empire", "2024-01-01 00:00:00")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet='ab:; "', max_size=12), min_size=1, max_size=6))
def test_tag_splitting_as_plain_python(spark, texts):
    want = [[t.strip() for t in text.strip().strip('"').split(";") if t.strip()] for text in texts]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(tags.split_list(F.col("t")).alias("x")).collect()
    assert [r.x for r in got] == want
