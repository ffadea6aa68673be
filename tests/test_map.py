from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from atlasweave.functions import affine, geo, paths, values
from atlasweave.functions.paths import Curve, drawn_points
from atlasweave.operators import dedupe, reconcile, reports, sinks, tiles
from atlasweave.plans import catalogue
from atlasweave.sources import drawings, gazetteers

MAP = Path(__file__).parent / "fixtures" / "map.svg"


@pytest.fixture(scope="module")
def rows(spark):
    return drawings.read_drawings(spark, str(MAP)).cache()


def test_flatten_and_transforms(rows):
    got = {r.id: r for r in drawings.placed(rows.where("tag = 'text'")).collect()}
    assert got["t1"].name == "Alt Burg" and (got["t1"].px, got["t1"].py) == (3.0, 4.0)
    assert got["t1"].path == ["Settlements", "Empire", "Northland"]
    assert (got["t6"].px, got["t6"].py) == (pytest.approx(3.0), pytest.approx(8.0))
    assert got["t1"].lon == pytest.approx((3 - 428.530) * 0.017504) and got["t4"].px is None


def test_settlements(rows):
    found = drawings.settlements(rows)
    reasons = {r.id: r.reason for r in found.where("reason is not null").collect()}
    assert reasons == {"t4": "Invalid coordinates", "t5": "No text content", "c1": "Not a text element"}
    valid = found.where("reason is null")
    first = dedupe.first_wins(valid, ["scope", "name"], "doc_order")
    assert sorted((r.faction, r.province or "", r.name) for r in first.collect()) == [("empire", "Northland", "Alt Burg"), ("empire", "Northland", "Deep"), ("empire", "Northland", "Twice"), ("empire", "Southland", "Twice"), ("karaz_ankor", "", "Hold"), ("kislev", "Kislev", "Cold")]
    twice = dedupe.duplicates(valid, ["scope", "name"], "doc_order", "px", "py").collect()
    assert [(r.name, r.occurrences, [e.px for e in r.entries]) for r in twice] == [("Twice", 2, [11.0, 13.0])]


def test_other_layers(rows):
    assert sorted((r.name, r.poi_type) for r in drawings.points_of_interest(rows).collect()) == [("Abbey", "Monasteries and Temples"), ("Cave", "Caves")]
    assert [(r.name, r.province_type) for r in drawings.region_labels(rows).collect()] == [("Northland", "Province")]
    assert sorted((r.name, r.waterbody_type) for r in drawings.water_labels(rows).collect()) == [("Fen", "Small Marsh"), ("Mere", "Lake")]
    paths, places = drawings.route_inputs(rows)
    assert [(r.path_id, r.d) for r in paths.collect()] == [("p1", "M 0 0 L 20 0")] and [r.name for r in places.collect()] == ["A"]
    frame = drawings.frame_bounds(rows, "Frame").first()
    assert (frame.x0, frame.y0, frame.x1, frame.y1) == (10, 20, 70, 100)
    scale = drawings.document_scale(rows).first()
    assert scale.scale_x == pytest.approx(200 * 96 / 25.4 / 400)
    assert {r.label: r.transform for r in drawings.transform_audit(rows, "Settlements", "Empire").collect()} == {"Northland": "scale(2)", "Southland": "NO TRANSFORM"}
    assert drawings.transform_log(rows).count() == 5
    assert {r.status for r in drawings.relabelled(rows).collect()} == {"updated", "no_text"}


def test_roads_layers_and_logs(spark, rows):
    road = drawings.roads(rows).first()
    assert (road.road_id, road.road_type) == ("road_000", "Highway") and road.points[0] == (0, 0) and road.points[1].x == pytest.approx(1.7504)
    line = drawings.roads(rows).select(sinks.line_feature(F.col("points"), [F.col("road_id")]).alias("f")).first().f
    assert '"LineString"' in line and "road_000" in line
    shown = {r.label: r.style for r in drawings.layer_visibility(rows, ["Roads"]).collect()}
    assert shown["Roads"] == "display:inline" and shown["Settlements"] == "display:none"
    found = drawings.settlements(rows)
    assert reports.reject_log(found).count() == 3
    twice = dedupe.duplicates(found.where("reason is null"), ["scope", "name"], "doc_order")
    assert reports.duplicate_log(twice).first().line == "1 names, 2 entries"
    status = spark.createDataFrame([("b", "left_only"), ("A", "right_only"), ("c", "both")], "name string, status string")
    assert [r.line for r in reports.reconciliation_lines(status, "name").collect()][3:] == ["  A (right_only)", "  b (left_only)"]
    cells = spark.createDataFrame([(["a", "1"],), (["b"],), (["c", "x"],)], "cells array<string>")
    assert [tuple(r) for r in gazetteers.positional_population(cells).collect()] == [("a", 1)]
    assert gazetteers.first_existing(["/nowhere", str(MAP)]) == str(MAP)
    assert spark.range(1).select(values.mobile_portrait(F.lit(400), F.lit(800)).alias("m")).first().m


def test_whole_run(spark, rows):
    found = dedupe.first_wins(drawings.settlements(rows).where("reason is null"), ["scope", "name"], "doc_order")
    gaz = spark.createDataFrame([("empire", "Alt Burg", "4000", "a:b; c", "Fur, Ore", "n", "", "T", "", ""), ("empire", "Nowhere", "7", "", "", "", "", "", "", "")], "faction string, name string, Population string, Tags string, Trade string, Notes string, wiki_url string, wiki_title string, wiki_description string, wiki_image string")
    rich = reconcile.enrich_settlements(found, gaz)
    top = rich.where("name = 'Alt Burg'").first()
    assert (top.population, top.size_category, top.tags, top.tag_issues, top.wiki.title, top.wiki.url) == (4000, 4, ["a:b", "c", "trade:Fur, Ore"], ["format:c"], "T", None)
    assert {r.population_status for r in rich.collect()} == {"given", "not_in_gazetteer"}
    assert [r.name for r in reconcile.missing_from(gaz, found, ["faction", "name"]).collect()] == ["Nowhere"]
    status = reconcile.status_of_both(found, gaz, ["faction", "name"])
    report = reports.processing_report(rich, drawings.points_of_interest(rows), drawings.region_labels(rows), drawings.water_labels(rows), status)
    values_ = {(r.section, r.key, r.metric): r.value for r in report.collect()}
    assert values_[("factions", "empire", "settlements")] == 4 and values_[("reconciliation", "right_only", "count")] == 1
    assert reports.as_text(report).count() == len(values_)
    feature = sinks.settlement_features(rich.where("name = 'Alt Burg'")).first().feature
    assert '"wiki":{"title":"T","url":null' in feature and '"coordinates":[' in feature
    assert sinks.collection(sinks.settlement_features(rich)).first().geojson.count('"Feature"') == 6


def test_transform_forms(spark):
    texts = ["translate(3)", "scale(2 3)", "rotate(90)", "matrix(1,2,3,4,5,6)", "matrix(1,2)", "", "skewX(45)", "translate (1,2) scale(2)", "rotate(a)"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").withColumn("m", affine.parse_transform(F.col("t"))).withColumn("s", F.when(F.col("t") != "rotate(a)", affine.parse_transform(F.col("t"), strict=True)))  # of which that is an error
    got = {r.t: (tuple(round(v, 9) for v in r.m), tuple(round(v, 9) for v in r.s or ())) for r in df.collect()}
    identity = (1, 0, 0, 1, 0, 0)
    assert got["translate(3)"][0] == (1, 0, 0, 1, 3, 0) and got["scale(2 3)"][0] == (2, 0, 0, 3, 0, 0) and got["rotate(90)"][0] == (0, 1, -1, 0, 0, 0)
    assert got["matrix(1,2,3,4,5,6)"][0] == (1, 2, 3, 4, 5, 6) and got["matrix(1,2)"][0] == got[""][0] == got["rotate(a)"][0] == identity
    assert got["skewX(45)"] == (identity, (1, 0, 1, 1, 0, 0))
    assert got["translate (1,2) scale(2)"] == ((2, 0, 0, 2, 1, 2), (2, 0, 0, 2, 0, 0))


def test_paths():
    assert drawn_points("M 1 1 2 2 L 3,3 h 2 V 0 l 1 1 Z q 1 2") == [(1, 1), (2, 2), (3, 3), (5, 3), (5, 0), (6, 1)]
    assert drawn_points("m 1 1 c 0 0 1") == [(1, 1)] and len(drawn_points("M0 0 C 0 1 1 1 1 0")) == 21
    curve = Curve("M 0 0 L 10 0 L 10 30")
    assert curve.length() == 40 and curve.points([0.25])[0] == 10 and curve.points([0.5])[0] == 10 + 10j
    assert curve.length(0.25, 0.5) == pytest.approx(10)


def test_sampled_paths_come_in_frames_of_many(spark, monkeypatch):
    frames = []
    plain = pd.DataFrame({"n": [1, 2, 3, 4], "name": ["a", None, "c", "d"], "d": ["M 0 0 L 30 0 L 30 10", "M 0 0 L 4 0", "M 0 0 L 30 0 L 30 10", None]})

    class Paths:
        """Stands for a table of one batch; notes the frames made of it."""

        columns, schema, sparkSession = list(plain.columns), spark.createDataFrame([], "n long, name string, d string").schema, spark  # noqa: N815

        def repartition(self, n):
            return self

        def mapInPandas(self, run, schema):  # noqa: N802
            frames.extend(run(iter([plain])))

    paths.sample_paths(Paths(), 3)
    assert len(frames) == 1
    got = [tuple(r) for r in frames[0][["n", "name", "k", "x", "y"]].itertuples(index=False)]
    assert got[:3] == [(1, "a", 0, 0, 0), (1, "a", 1, 20, 0), (1, "a", 2, 30, 10)] and [r[3] for r in got[3:6]] == [0, 2, 4]
    assert [r[2:] for r in got[6:9]] == [r[2:] for r in got[:3]] and [r[3:] for r in got[9:]] == [(0, 0)] * 3
    monkeypatch.setattr(paths, "FRAME_POINTS", 1)  # a frame a path
    paths.sample_paths(Paths(), 3)
    assert len(frames) == 5 and pd.concat(frames[1:], ignore_index=True).equals(frames[0])
    table = spark.createDataFrame([(r.n, r.name, r.d) for r in plain.itertuples()], "n long, name string, d string")
    assert sorted(tuple(r) for r in paths.sample_paths(table, 3).select("n", "k", "x", "y").collect()) == sorted((r[0], *r[2:]) for r in got)


def test_sequential_ids_past_a_thousand_are_as_their_sql(spark, tmp_path):
    spark.range(1200).select(F.col("id").alias("p_partkey"), F.lit("b").alias("p_brand")).write.parquet(str(tmp_path / "part.parquet"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW part AS SELECT * FROM read_parquet('{tmp_path}/part.parquet/*.parquet')")
    want = db.execute(catalogue.ORACLE_SQL["sequential_ids"]).fetchall()
    assert sorted(map(tuple, catalogue.QUERIES["sequential_ids"](spark, str(tmp_path)).collect())) == sorted(want)
    whole = spark.range(1200).select(drawings.numbered("road", F.lit(0), "id").alias("r"))
    assert whole.distinct().count() == 1200 and whole.where("r = 'road_1199'").count() == 1


def test_tiles(spark):
    every = tiles.manifest(tiles.blocks(spark, 1, 4, 3))
    assert every.count() == sum(4**z for z in range(1, 5)) and every.select("path").distinct().count() == every.count()
    area = tiles.with_area(tiles.blocks(spark, 1, 1), 0.0, 0.0, 8.0, 8.0).first()
    assert (area.x0, area.y0, area.x1, area.y1) == (0, 0, 8, 8)
    with pytest.raises(ValueError):
        tiles.blocks(spark, 0, 4)
    point = spark.range(1).select(geo.quadrant(F.lit(1.0), F.lit(60.0)).alias("q"), geo.quadrant(F.lit(99.0), F.lit(60.0)).alias("out")).first()
    assert (point.q, point.out) == ("NE", None)


def test_values(spark):
    given = [" 42 ", "4.0", "1_000", "+7", "abc", "", None, "1__0", "-3"]
    df = spark.createDataFrame([(g,) for g in given], "g string")
    assert [r.v for r in df.select(values.safe_int(F.col("g")).alias("v")).collect()] == [42, None, 1000, 7, None, None, None, None, -3]
    sizes = spark.createDataFrame([(p,) for p in (0, 300, 301, 900, 901, 3000, 3001, 15000, 15001, 49999, 50000)], "p int")
    assert [r.c for r in sizes.select(values.size_category(F.col("p")).alias("c")).collect()] == [1, 1, 2, 2, 3, 3, 4, 4, 5, 5, 6]
    drawn = [r.p for r in spark.range(4000).select(values.drawn_population(F.col("id").cast("string")).alias("p")).collect()]
    assert max(drawn) <= 800 and sum(50 < p < 5000 for p in drawn) > 3200


def test_gazetteer_files(spark, tmp_path):
    header = ",".join(gazetteers.HEADERS["population"])
    row = lambda name, people: f'{name},{people},"a, b",,"""source:TOW""",,,P,,,R,,,,,,'
    (tmp_path / "empire_20240101_000000.csv").write_text(f"{header}\n{row('A', 1)}\n{row('B', 2)}\n{row('A', 3)}\n")
    (tmp_path / "empire_20240202_000000.csv").write_text(f"{header}\n{row('A', 1)}\n")
    rows = gazetteers.read_snapshots(spark, str(tmp_path), "population")
    assert rows.select("series", "taken").distinct().count() == 2
    old = gazetteers.by_name(rows.where("taken < '2024-02-01'"))
    assert {r.name: r.Population for r in old.collect()} == {"A": "3", "B": "2"} and old.first().Tags == '"source:TOW"'
    assert gazetteers.header_errors(gazetteers.HEADERS["type"], "type", 1) == [] and len(gazetteers.header_errors(["x"], "type", 0)) == 2
    epochs = gazetteers.unpivot_epochs(old).where("Settlement = 'B'").collect()
    assert sorted((r.year, r.province, r.ruler) for r in epochs) == [(2276, None, None), (2512, None, None), (2515, "P", "R")]
