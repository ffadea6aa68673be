"""Queries over drawings against their SQL, labels written back, networks by drawing, synced sheets."""

import os

import duckdb
import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from atlasweave.functions import affine, geo
from atlasweave.operators import graphs, sinks, snapshots
from atlasweave.plans import catalogue, drawing_queries
from atlasweave.sources import drawings, gazetteers

HERE = "/root/testdata/sf0.001"
NS = 'xmlns="http://www.w3.org/2000/svg" xmlns:inkscape="http://www.inkscape.org/namespaces/inkscape"'


def plain(rows):
    return sorted(str(tuple(round(v, 6) if isinstance(v, float) else v for v in r)) for r in rows)


@pytest.mark.skipif(not os.path.isdir(HERE), reason="no test tables")
@pytest.mark.parametrize("name", ["settlements", "settlement_rejects", "points_of_interest", "roads", "transform_log", "label_written", "settlement_geojson", "layer_features", "route_requests", "nms", "route_table"])
def test_as_duckdb(spark, name):
    db = duckdb.connect()
    for file in os.listdir(HERE):
        db.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM read_parquet('{HERE}/{file}')")
    want = db.execute(catalogue.ORACLE_SQL[name])
    columns = [c[0] for c in want.description]
    assert plain(catalogue.QUERIES[name](spark, HERE).select(*columns).collect()) == plain(want.fetchall())


def test_every_drawing_query_has_sql():
    assert {f for f in catalogue.QUERIES if f in vars(drawing_queries)} <= set(catalogue.ORACLE_SQL)


def test_groups_without_label_are_skipped_and_some_factions_reject_silently(spark):
    xml = f"""<svg {NS}><g><g inkscape:label="Settlements"><g inkscape:label="Empire"><g id="g12"><text>Lost</text></g><g inkscape:label="North"><g id="g13"><text>Found</text></g><text/></g></g>
    <g inkscape:label="Wood Elves"><g id="w"><text x="?">Bad</text><text>Glade</text></g></g></g></g><g inkscape:label="Points of Interest"><g id="g9"><text>None</text></g></g></svg>"""
    rows = drawings.flatten(spark.createDataFrame([("d", xml), ("e", None)], "doc string, xml string"))
    got = {(r.faction, r.province, r.name, r.reason) for r in drawings.settlements(rows).collect()}
    assert got == {("empire", "North", "Found", None), ("empire", "North", None, "No text content"), ("wood_elves", None, "Glade", None)}
    assert drawings.points_of_interest(rows).count() == 0


def test_labels_are_written_only_where_something_changes(spark):
    same = f'<svg {NS}><g inkscape:label="A"><text  inkscape:label="x">x</text></g></svg>'
    other = f'<?xml version="1.0"?>\n<svg {NS}><g inkscape:label="A"><g><text>y</text><text> </text></g></g><g inkscape:label="B"><text>z</text></g></svg>'
    made = drawings.with_labels(spark.createDataFrame([("same", same), ("other", other), ("none", None)], "doc string, xml string"), ["A", "C"])
    got = {r.doc: (r.xml, r.changed) for r in made.collect()}
    assert got["same"] == (same, 0) and got["none"] == (None, 0) and got["other"][1] == 1
    assert got["other"][0].startswith('<?xml version="1.0"?>\n<svg xmlns=') and 'inkscape:label="y"' in got["other"][0] and 'label="z"' not in got["other"][0]


def test_drawings_are_flattened_as_their_pieces_come(spark, monkeypatch):
    monkeypatch.setattr(drawings, "PIECE", 5)  # pieces end inside of tags and characters
    names = ["Ä &amp; ü", "B<!-- c -->b", "<tspan>C</tspan> <g><tspan> d </tspan></g>"]
    xml = f'<?xml version="1.0" encoding="ISO-8859-1"?><svg {NS}><g inkscape:label="Ö" transform="scale(2)">' + "".join(f'<text x="{i}">{n}</text>' for i, n in enumerate(names)) + "</g><path/></svg>"
    asked = spark.createDataFrame([("a", xml), ("b", ""), ("c", None), ("d", xml)], "doc string, xml string")
    got = [(r.doc, r.doc_order, r.depth, r.tag, r.labels, r.name, r.first_span) for r in drawings.flatten(asked).orderBy("doc", "doc_order").collect()]
    rows = [(0, 0, "svg", [], None, None), (1, 1, "g", [], None, None), (2, 2, "text", ["Ö"], "Ä & ü", None), (3, 2, "text", ["Ö"], "Bb", None), (4, 2, "text", ["Ö"], "C", "C"), (5, 1, "path", [], None, None)]
    assert got == [(doc, *r) for doc in "ad" for r in rows]


def test_rows_leave_while_a_drawing_is_still_read(spark, monkeypatch):
    read, taken = [], {}
    xml = f"<svg {NS}>" + "<text>x</text>" * 5000 + "</svg>"

    def pieces():
        for i in range(0, len(xml), 1000):
            read.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(["d"]), pa.array([i // 1000], pa.int32()), pa.array([i + 1000 >= len(xml)]), pa.array([xml[i : i + 1000].encode()])], names=["doc", "part", "last", "piece"])

    class Pieces:
        def mapInArrow(self, run, schema):  # noqa: N802
            taken["run"] = run

    monkeypatch.setattr(drawings, "_pieces", lambda documents: Pieces())
    drawings.flatten(None)
    out = taken["run"](pieces())
    assert next(out).num_rows < 200 and len(read) == 1
    assert sum(b.num_rows for b in out) > 4800


def test_labels_are_written_without_a_tree(spark, monkeypatch):
    rest = '<q:z xmlns:q="urn:q" q:a="1&quot;"/><text inkscape:label="B">x</text>&gt;<text/>'
    body = '<g inkscape:label="A"><text>a &amp; <!-- c -->b</text><g><text id="t"><tspan> C </tspan><tspan>d</tspan></text></g><a><text>no</text></a><text inkscape:label="e">e</text></g>'
    xml = f'<?xml version="1.0"?>\n<svg {NS}>{body}<g inkscape:label="A"><text>second</text></g>{rest}</svg>'
    taken = {}

    class Pieces:
        def mapInArrow(self, run, schema):  # noqa: N802
            taken["run"] = run
            return self

        def unionByName(self, other):  # noqa: N802
            return self

    tables = spark.createDataFrame([("d", xml)], "doc string, xml string")
    with monkeypatch.context() as m:
        m.setattr(drawings, "_pieces", lambda documents: Pieces())
        m.setattr(drawings.ET, "fromstring", lambda text: pytest.fail("a tree of the whole drawing"))
        drawings.with_labels(tables, ["A"])
        data = xml.encode()
        steps = [data[i : i + 7] for i in range(0, len(data), 7)]
        batch = pa.RecordBatch.from_arrays([pa.array(["d"] * len(steps)), pa.array(range(len(steps)), pa.int32()), pa.array([i + 1 == len(steps) for i in range(len(steps))]), pa.array(steps)], names=["doc", "part", "last", "piece"])
        made = next(taken["run"](iter([batch]))).to_pylist()[0]
    # as a tree is written
    for prefix, uri in drawings.NAMESPACES:
        drawings.ET.register_namespace(prefix, uri)
    tree = drawings.ET.fromstring(xml)
    texts = list(tree.iter("{http://www.w3.org/2000/svg}text"))
    texts[0].set(drawings.LABEL, "a & b")
    texts[1].set(drawings.LABEL, "C d")
    assert made == {"doc": "d", "xml": '<?xml version="1.0"?>\n' + drawings.ET.tostring(tree, encoding="unicode"), "changed": 2}
    got = drawings.with_labels(tables, ["A"]).collect()
    assert [r.asDict() for r in got] == [made]


def test_networks_of_several_drawings_stay_apart(spark):
    paths = [("p1", 0, "M 0 0 L 100 0", None), ("p2", 1, "M 50 -40 L 50 60", None)]
    places = [("X", 2.0, 1.0), ("Y", 51.0, 58.0)]
    kind = "path_id string, path_ord int, d string, style string"
    nodes, edges = graphs.build_network(spark.createDataFrame(paths, kind), spark.createDataFrame(places, "name string, x double, y double"))
    want = plain(edges.select("node1_id", "node2_id", "path_id", "length").collect())
    twice = spark.createDataFrame([(d, *p) for d in "ab" for p in paths], "doc string, " + kind)
    both = graphs.build_network(twice, spark.createDataFrame([(d, *p) for d in "ab" for p in places], "doc string, name string, x double, y double"))
    for doc in "ab":
        assert plain(both[1].where(F.col("doc") == doc).select("node1_id", "node2_id", "path_id", "length").collect()) == want
    assert both[0].count() == 2 * nodes.count()


def test_sync_leaves_the_target_on_failure(tmp_path):
    landing, target = tmp_path / "landing", tmp_path / "target"
    landing.mkdir()
    header = ",".join(gazetteers.HEADERS["wiki"])
    (landing / "a.csv").write_text(header + "\r\nx,u,t,d,i\r\n", newline="")
    (landing / "b.csv").write_text("wrong,header\n1,2\n")
    sheets = {"a": "wiki", "b": "wiki", "c": "wiki"}
    got = snapshots.sync(landing, target, sheets)
    assert got["a"] == "synced" and got["b"].startswith("invalid") and got["c"] == "not read"
    assert (target / "a.csv").read_bytes() == (header + "\nx,u,t,d,i\n").encode() and not (target / "b.csv").exists() and not (target / ".validated").exists()
    (landing / "b.csv").write_text(header + "\ny,u,t,d,i\n")
    assert set(snapshots.sync(landing, target, {"a": "wiki", "b": "wiki"}).values()) == {"synced"} and (target / ".validated").exists()
    (landing / "b.csv").write_text("now,unchecked\n1,2\n")
    assert snapshots.sync(landing, target, {"b": "wiki"}, validate=True)["b"].startswith("invalid") and "y,u" in (target / "b.csv").read_text()
    assert snapshots.sync(landing, target, {"b": "wiki"}, dry_run=True) == {"b": "would sync"}
    assert snapshots.sync(landing, target, {"b": "wiki"}) == {"b": "synced"} and len(list((target / "backups").iterdir())) >= 2


def test_strict_transforms_and_viewer_layers(spark):
    one = lambda text, strict: spark.range(1).select(affine.parse_transform(F.lit(text), strict).alias("m")).first().m
    assert one("translate(a 2) scale(2)", False).a == 2
    with pytest.raises(PySparkException, match="no number"):
        one("translate(a 2) scale(2)", True)
    feature = spark.createDataFrame([('{"geometry":{"coordinates":[1.0,2.0]},"properties":{"name":"n"}}',)], "feature string")
    assert sorted(r.layer for r in sinks.viewer_layers({"settlements": feature, "water": feature}).collect()) == ["settlement_markers", "settlements", "water"]
    assert spark.range(1).select(geo.coordinate_text(F.lit(1.23456), F.lit(2.0), F.lit(0.5)).alias("t")).first().t == "X=1.235, Y=2.000, Z=50.000"
    with pytest.raises(ValueError):
        sinks.viewer_layers({})
