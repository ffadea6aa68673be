"""Drawings made of the tables, one a region, and what is read from them.

Each query writes the tables' rows as layered drawings and reads those; its SQL works
out from the rows themselves what must be found.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geo
from ..operators import dedupe, graphs, lineage, reconcile, reports, sinks
from ..sources import drawings
from .registry import Tables, query


def _text(name: Column, x: Column, y: Column, more: Column | None = None) -> Column:
    return F.concat(F.lit('<text x="'), x.cast("string"), F.lit('" y="'), y.cast("string"), F.lit('"'), more if more is not None else F.lit(""), F.lit(">"), name, F.lit("</text>"))


def _joined(rows: DataFrame, keys: list[str], order: str, element: Column, out: str) -> DataFrame:
    """Elements of each key in order, as one text."""
    return rows.groupBy(*keys).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, element.alias("e")))), lambda x: x["e"]), "").alias(out))


def atlas(t: Tables) -> DataFrame:
    """``doc``, ``xml``: customers as settlements, suppliers as holds and points, nations as labels, water, roads and paths."""
    k = F.col("c_custkey")
    kind, x, y = F.pmod(k, F.lit(5)), F.pmod(k, F.lit(1000)), F.pmod(k, F.lit(97))
    spans = F.concat(F.lit("<tspan>Old</tspan><tspan>"), F.col("c_name"), F.lit("</tspan>"))
    town = F.when(kind == 1, _text(spans, x, y)).when(kind == 2, _text(F.lit(" "), x, y)).when(kind == 3, _text(F.col("c_name"), F.lit("bad"), y))
    town = town.when(kind == 4, F.lit('<rect x="1" y="1"/>')).otherwise(_text(F.col("c_name"), x, y, F.lit(' transform="translate(1,1)"')))
    towns = _joined(t.customer, ["c_nationkey"], "c_custkey", town, "towns").withColumnRenamed("c_nationkey", "n_nationkey")
    s = F.col("s_suppkey")
    hold = F.when(s % 4 == 0, _text(F.lit(""), s, s)).otherwise(_text(F.col("s_name"), s, F.pmod(s, F.lit(50))))
    holds = _joined(t.supplier, ["s_nationkey"], "s_suppkey", hold, "holds").withColumnRenamed("s_nationkey", "n_nationkey")
    layers = F.array(*[F.lit(v) for v in ("Other", "Monastaries and Temples", "Caves")])
    points = t.supplier.select("s_nationkey", F.get(layers, (s % 3).cast("int")).alias("layer"), "s_suppkey", _text(F.col("s_name"), s, F.lit(3)).alias("e"))
    points = _joined(points, ["s_nationkey", "layer"], "s_suppkey", F.col("e"), "p").select(F.col("s_nationkey").alias("n_nationkey"), F.concat(F.lit('<g inkscape:label="'), F.col("layer"), F.lit('">'), F.col("p"), F.lit("</g>")).alias("p"))
    points = points.groupBy("n_nationkey").agg(F.array_join(F.sort_array(F.collect_list("p")), "").alias("points"))
    n, name = F.col("n_nationkey"), F.col("n_name")
    group = F.when(n % 6 == 5, F.format_string('<g id="g%d">', n)).otherwise(F.format_string('<g inkscape:label="%s" transform="translate(%d,2)">', name, n))
    nations = t.nation.join(towns, "n_nationkey", "left").join(holds, "n_nationkey", "left").join(points, "n_nationkey", "left")
    part = lambda c: F.coalesce(c, F.lit(""))
    rows = nations.select(
        "n_regionkey",
        "n_nationkey",
        F.concat(group, part(F.col("towns")), F.lit("</g>")).alias("empire"),
        F.concat(F.format_string('<g id="h%d" transform="translate(0,%d)">', n, n), part(F.col("holds")), F.lit("</g>")).alias("dwarfs"),
        part(F.col("points")).alias("points"),
        F.concat(F.when(n % 2 == 0, '<g inkscape:label="Provinces" transform="scale(3)">').otherwise('<g inkscape:label="Rivers">'), _text(name, n, F.lit(1)), F.lit("</g>")).alias("labels"),
        F.concat(F.when(n % 2 == 0, '<g inkscape:label="marshes"><g inkscape:label="small-marsh">').otherwise('<g inkscape:label="lakes"><g>'), _text(name, n, F.lit(7)), F.lit("</g></g>")).alias("water"),
        F.format_string('<g inkscape:label="%s"><path id="r%d" d="M %d 0 l 3,4 H 100 C 100 10 110 20 120 %d"/></g>', F.when(n % 2 == 0, "Highway").otherwise("Trail"), n, n, n).alias("roads"),
        F.format_string('<path id="p%d" d="M %d 0 L %d 50" style="stroke-width:%dpx"/>', (n / 2).cast("long"), n, n, n + 1).alias("paths"),
        F.format_string('<text x="%d" y="1"><tspan>%s</tspan></text>', n, F.upper(F.substring(name, 1, 2))).alias("places"),
    )
    parts = ("empire", "dwarfs", "points", "labels", "water", "roads", "paths", "places")
    joined = rows.groupBy("n_regionkey").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", *parts))).alias("all"))
    of = lambda c: F.array_join(F.transform("all", lambda r: r[c]), "")
    r = F.col("n_regionkey")
    xml = F.concat(
        F.format_string('<svg xmlns="http://www.w3.org/2000/svg" xmlns:inkscape="http://www.inkscape.org/namespaces/inkscape" width="%dmm" height="297mm" viewBox="%d 0 210 594">', 210 + r, r),
        F.format_string('<rect inkscape:label="Frame" x="%d" y="2" width="10" height="20" transform="rotate(90)"/>', r),
        F.lit('<g inkscape:label="Settlements" inkscape:groupmode="layer" transform="scale(2)"><g inkscape:label="Empire">'), of("empire"),
        F.lit('</g><g inkscape:label="Dwarf Holds">'), of("dwarfs"),
        F.lit('</g></g><g inkscape:label="Points of Interest" style="fill:red;display:inline">'), of("points"),
        F.lit('<g id="loose"><text x="1" y="1">Nowhere</text></g></g><g inkscape:label="Region Labels" transform="translate(5)">'), of("labels"),
        F.lit('</g><g inkscape:label="Water Labels">'), of("water"),
        F.lit('</g><g inkscape:label="Roads" transform="scale(9)">'), of("roads"),
        F.lit('</g><g inkscape:label="PATHS" inkscape:groupmode="layer">'), of("paths"),
        F.lit('</g><g inkscape:label="Locations" inkscape:groupmode="layer">'), of("places"), F.lit("</g></svg>"),
    )
    return joined.select(F.format_string("r%d", r).alias("doc"), xml.alias("xml"))


def _rows(t: Tables) -> DataFrame:
    return drawings.flatten(atlas(t))


LON, LAT = "round((({0})::DOUBLE - 428.530) * 0.017504, 6)", "round((3347.85 - ({0})::DOUBLE) * 0.017504, 6)"

# towns as drawn: kind 0 has a transform of its own, 1 two spans; the others are left out
TOWNS_SQL = """(SELECT c_custkey AS k, c_custkey % 5 AS kind, n_name AS province, 'r' || n_regionkey AS doc, n_nationkey AS n, CASE WHEN c_custkey % 5 = 1 THEN 'Old ' ELSE '' END || c_name AS name,
 2.0::DOUBLE * (c_custkey % 1000 + n_nationkey + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END) AS px, 2.0::DOUBLE * (c_custkey % 97 + 2 + CASE WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END) AS py
 FROM customer JOIN nation ON n_nationkey = c_nationkey WHERE n_nationkey % 6 <> 5)"""
HOLDS_SQL = """(SELECT s_suppkey AS k, s_name AS name, 'r' || n_regionkey AS doc, 2.0::DOUBLE * s_suppkey AS px, 2.0::DOUBLE * (s_suppkey % 50 + n_nationkey) AS py
 FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE s_suppkey % 4 <> 0)"""


def _placed(rows: DataFrame, *first: str) -> DataFrame:
    return rows.select("doc", *first, *[F.round(c, 6).alias(c) for c in ("px", "py", "lon", "lat")])


@query(
    "settlements",
    f"SELECT doc, 'empire' AS faction, province, name, px, py, {LON.format('px')} AS lon, {LAT.format('py')} AS lat FROM {TOWNS_SQL} WHERE kind < 2 UNION ALL "
    f"SELECT doc, 'karaz_ankor', NULL, name, px, py, {LON.format('px')}, {LAT.format('py')} FROM {HOLDS_SQL}",
)
def settlements(t: Tables) -> DataFrame:
    return _placed(drawings.settlements(_rows(t)).where("reason is null"), "faction", "province", "name")


_REASON_SQL = "CASE kind WHEN 2 THEN 'No text content' WHEN 3 THEN 'Invalid coordinates' ELSE 'Not a text element' END"


@query("settlement_rejects", f"SELECT doc, province, {_REASON_SQL} AS reason, count(*) AS n FROM {TOWNS_SQL} WHERE kind > 1 GROUP BY ALL")
def settlement_rejects(t: Tables) -> DataFrame:
    return drawings.settlements(_rows(t)).where("reason is not null").groupBy("doc", "province", "reason").agg(F.count("*").alias("n"))


@query("reject_log", f"SELECT {_REASON_SQL} || ' at Settlements/Empire/' || province AS line, count(*) AS n FROM {TOWNS_SQL} WHERE kind > 1 GROUP BY ALL")
def reject_log(t: Tables) -> DataFrame:
    lines = reports.reject_log(drawings.settlements(_rows(t)))
    return lines.groupBy(F.substring_index("line", ":", 1).alias("line")).agg(F.count("*").alias("n"))


@query(
    "points_of_interest",
    f"""SELECT 'r' || n_regionkey AS doc, s_name AS name, CASE s_suppkey % 3 WHEN 0 THEN 'Other' WHEN 1 THEN 'Monasteries and Temples' ELSE 'Caves' END AS poi_type, s_suppkey::DOUBLE AS px, 3.0::DOUBLE AS py,
    {LON.format('s_suppkey')} AS lon, {LAT.format('3')} AS lat FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
)
def points_of_interest(t: Tables) -> DataFrame:
    return _placed(drawings.points_of_interest(_rows(t)), "name", "poi_type")


@query(
    "region_labels",
    f"SELECT 'r' || n_regionkey AS doc, n_name AS name, 'Province' AS province_type, 3.0::DOUBLE * n_nationkey + 5 AS px, 3.0::DOUBLE AS py, {LON.format('3 * n_nationkey + 5')} AS lon, {LAT.format('3')} AS lat FROM nation WHERE n_nationkey % 2 = 0",
)
def region_labels(t: Tables) -> DataFrame:
    return _placed(drawings.region_labels(_rows(t)), "name", "province_type")


@query(
    "water_labels",
    f"SELECT 'r' || n_regionkey AS doc, n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'Small Marsh' ELSE 'Lake' END AS waterbody_type, n_nationkey::DOUBLE AS px, 7.0::DOUBLE AS py, {LON.format('n_nationkey')} AS lon, {LAT.format('7')} AS lat FROM nation",
)
def water_labels(t: Tables) -> DataFrame:
    return _placed(drawings.water_labels(_rows(t)), "name", "waterbody_type")


_ROADS_SQL = """(SELECT 'r' || n_regionkey AS doc, n_nationkey AS n, 'road_' || lpad((row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1)::VARCHAR, 3, '0') AS road_id,
 CASE WHEN n_nationkey % 2 = 0 THEN 'Highway' ELSE 'Trail' END AS road_type FROM nation)"""


@query(
    "roads",
    f"""SELECT doc, road_id, road_type, 23::INTEGER AS n_points, {LON.format('n')} AS x0, {LAT.format('0')} AS y0, {LON.format('n + 3')} AS x1, {LAT.format('4')} AS y1, {LON.format('100')} AS x2, {LAT.format('4')} AS y2,
    {LON.format('(125 * 100 + 375 * 100 + 375 * 110 + 125 * 120) / 1000.0::DOUBLE + 0 * n')} AS xm, round((3347.85 - (125 * 4 + 375 * 10 + 375 * 20 + 125 * n) / 1000.0::DOUBLE) * 0.017504, 6) AS ym FROM {_ROADS_SQL}""",
)
def roads(t: Tables) -> DataFrame:
    """Ends of a road's lines and the middle of its curve, drawn with 21 points so that there is one."""
    found = drawings.roads(_rows(t), samples=21)
    at = lambda i, c: F.round(F.get("points", F.lit(i))[c], 6)
    return found.select("doc", "road_id", "road_type", (F.size("points") - 1).cast("int").alias("n_points"), *[at(i, c).alias(f"{c}{i}") for i in range(3) for c in "xy"], at(13, "x").alias("xm"), at(13, "y").alias("ym"))


@query("roads_total", f"SELECT road_type, count(*) AS roads, sum(23)::BIGINT AS points FROM {_ROADS_SQL} GROUP BY road_type")
def roads_total(t: Tables) -> DataFrame:
    return reports.road_totals(drawings.roads(_rows(t)))


@query("frame_bounds", "SELECT 'r' || r_regionkey AS doc, -22.0::DOUBLE AS x0, r_regionkey::DOUBLE AS y0, -2.0::DOUBLE AS x1, r_regionkey + 10.0::DOUBLE AS y1 FROM region")
def frame_bounds(t: Tables) -> DataFrame:
    return drawings.frame_bounds(_rows(t), "Frame").select("doc", *[F.round(c, 6).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("document_scale", "SELECT 'r' || r_regionkey AS doc, round((210 + r_regionkey) * 96 / 25.4::DOUBLE / 210, 6) AS scale_x, round(297 * 96 / 25.4::DOUBLE / 594, 6) AS scale_y, r_regionkey::DOUBLE AS view_x, 0.0::DOUBLE AS view_y FROM region")
def document_scale(t: Tables) -> DataFrame:
    return drawings.document_scale(_rows(t)).select("doc", F.round("scale_x", 6).alias("scale_x"), F.round("scale_y", 6).alias("scale_y"), "view_x", "view_y")


@query(
    "transform_log",
    """SELECT 'r' || n_regionkey AS doc, 'Settlements/Empire/' || n_name AS layer_path, 'translate(' || n_nationkey || ',2)' AS transform FROM nation WHERE n_nationkey % 6 <> 5 UNION ALL
    SELECT 'r' || n_regionkey, 'Settlements/Dwarf Holds/h' || n_nationkey, 'translate(0,' || n_nationkey || ')' FROM nation UNION ALL SELECT 'r' || n_regionkey, 'Region Labels/Provinces', 'scale(3)' FROM nation WHERE n_nationkey % 2 = 0 UNION ALL
    SELECT 'r' || r_regionkey, p, f FROM region, (VALUES ('Settlements', 'scale(2)'), ('Region Labels', 'translate(5)'), ('Roads', 'scale(9)')) v(p, f)""",
)
def transform_log(t: Tables) -> DataFrame:
    return drawings.transform_log(_rows(t)).select("doc", "layer_path", "transform")


@query("transform_audit", "SELECT 'r' || n_regionkey AS doc, n_name AS label, 'translate(' || n_nationkey || ',2)' AS transform FROM nation WHERE n_nationkey % 6 <> 5")
def transform_audit(t: Tables) -> DataFrame:
    return drawings.transform_audit(_rows(t), "Settlements", "Empire")


@query("layer_visibility", "SELECT 'r' || r_regionkey AS doc, label, CASE label WHEN 'Points of Interest' THEN 'fill:red;display:none' WHEN 'Roads' THEN 'display:inline' ELSE 'display:none' END AS style FROM region, (SELECT unnest(['Settlements', 'Points of Interest', 'Region Labels', 'Water Labels', 'Roads', 'PATHS', 'Locations']) AS label)")
def layer_visibility(t: Tables) -> DataFrame:
    return drawings.layer_visibility(_rows(t), ["Roads"]).select("doc", "label", "style")


@query(
    "route_paths",
    """SELECT 'r' || n_regionkey AS doc, 'p' || n_nationkey // 2 AS path_id, 'M ' || max(n_nationkey) || ' 0 L ' || max(n_nationkey) || ' 50' AS d, 'stroke-width:' || (max(n_nationkey) + 1) || 'px' AS style FROM nation GROUP BY n_regionkey, n_nationkey // 2""",
)
def route_paths(t: Tables) -> DataFrame:
    return drawings.route_inputs(_rows(t))[0].select("doc", "path_id", "d", "style")


@query("route_places", "SELECT 'r' || n_regionkey AS doc, upper(substr(n_name, 1, 2)) AS name, max(n_nationkey)::DOUBLE AS x, 1.0::DOUBLE AS y FROM nation GROUP BY n_regionkey, upper(substr(n_name, 1, 2))")
def route_places(t: Tables) -> DataFrame:
    return drawings.route_inputs(_rows(t))[1].select("doc", "name", "x", "y")


_TOWN = lambda: (F.get("labels", F.lit(1)) == "Empire") & F.get("labels", F.lit(2)).isNotNull()


@query("label_status", f"SELECT doc, CASE WHEN kind = 2 THEN 'no_text' ELSE 'updated' END AS status, count(*) AS n FROM {TOWNS_SQL} WHERE kind < 4 GROUP BY ALL")
def label_status(t: Tables) -> DataFrame:
    """What labelling the towns' texts would do; those in groups without label are no towns."""
    towns = drawings.relabelled(_rows(t)).where(_TOWN())
    return towns.groupBy("doc", "status").agg(F.count("*").alias("n"))


@query("label_written", f"SELECT doc, count(*) AS labelled, 0::BIGINT AS again FROM {TOWNS_SQL} WHERE kind IN (0, 1, 3) GROUP BY doc")
def label_written(t: Tables) -> DataFrame:
    """Towns that carry their name as label once it is written, and those a second run would still change."""
    once = drawings.with_labels(atlas(t), ["Settlements", "Empire"])
    found = drawings.relabelled(drawings.flatten(once)).where(_TOWN() & (F.col("label") == F.col("name")))
    again = drawings.with_labels(once.select("doc", "xml"), ["Settlements", "Empire"]).select("doc", F.col("changed").alias("again"))
    return found.groupBy("doc").agg(F.count("*").alias("labelled")).join(again, "doc").select("doc", "labelled", F.col("again").cast("long").alias("again"))


def _first(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    """Towns by name, of repeated ones the first."""
    return dedupe.first_wins(drawings.settlements(_rows(t) if rows is None else rows).where("reason is null and faction = 'empire'"), ["doc", "scope", "name"], "doc_order")


def _gazetteer(t: Tables) -> DataFrame:
    """Rows for most towns: every third has no population, every seventh one that can't be read."""
    k, empty = F.col("c_custkey"), F.lit("")
    people = F.when(k % 3 == 0, " ").when(k % 7 == 0, "many").otherwise(F.concat(F.lit(" "), (k * 10).cast("string")))
    name = F.concat(F.when(k % 5 == 1, "Old ").otherwise(""), F.col("c_name"))
    rows = t.customer.where("c_custkey % 11 <> 0").select(F.lit("empire").alias("faction"), name.alias("name"), people.alias("Population"), F.concat(F.lit("source:TOW;"), F.col("c_mktsegment")).alias("Tags"), F.lit("Fur").alias("Trade"), F.lit("a; b").alias("Notes"))
    return rows.select("*", empty.alias("wiki_title"), F.col("name").alias("wiki_url"), empty.alias("wiki_description"), empty.alias("wiki_image"))


_RICH_SQL = f"""(SELECT t.*, c_mktsegment, k % 11 <> 0 AS known, CASE WHEN k % 11 = 0 THEN 'not_in_gazetteer' WHEN k % 3 = 0 THEN 'missing' WHEN k % 7 = 0 THEN 'unparseable' ELSE 'given' END AS population_status,
 CASE WHEN k % 11 = 0 OR k % 3 = 0 OR k % 7 = 0 THEN 42 ELSE k * 10 END::INTEGER AS population FROM {TOWNS_SQL} t JOIN customer ON c_custkey = k WHERE kind < 2)"""
_SIZE_SQL = "CASE WHEN population <= 300 THEN 1 WHEN population <= 900 THEN 2 WHEN population <= 3000 THEN 3 WHEN population <= 15000 THEN 4 WHEN population <= 49999 THEN 5 ELSE 6 END::INTEGER"


def _rich(t: Tables, rows: DataFrame | None = None) -> DataFrame:
    return reconcile.enrich_settlements(_first(t, rows), _gazetteer(t), F.lit(42))


@query(
    "enrich_settlements",
    f"""SELECT doc, name, population_status, population, {_SIZE_SQL} AS size_category, CASE WHEN known THEN 'source:TOW|' || c_mktsegment || '|trade:Fur' ELSE '' END AS tags,
    CASE WHEN known THEN 'a|b' ELSE '' END AS notes, CASE WHEN known THEN 'format:' || c_mktsegment ELSE '' END AS issues, CASE WHEN known THEN name END AS url FROM {_RICH_SQL}""",
)
def enrich_settlements(t: Tables) -> DataFrame:
    joined = lambda c: F.coalesce(F.array_join(c, "|"), F.lit("")).alias(c if c != "tag_issues" else "issues")
    return _rich(t).select("doc", "name", "population_status", "population", "size_category", joined("tags"), joined("notes"), joined("tag_issues"), F.col("wiki.url").alias("url"))


@query(
    "settlement_geojson",
    f"SELECT doc, name, 'Feature' AS type, province, population, {LON.format('px')} AS lon, {LAT.format('py')} AS lat, px, py FROM {_RICH_SQL}",
)
def settlement_geojson(t: Tables) -> DataFrame:
    """GeoJSON of the towns, read again."""
    form = "type string, geometry struct<type:string,coordinates:array<double>>, properties struct<name:string,province:string,population:int,inkscape_coordinates:array<double>>"
    read = sinks.settlement_features(_rich(t), "doc").select("doc", F.from_json("feature", form).alias("f"))
    at = lambda c, i: F.round(F.get(c, F.lit(i)), 6)
    place, shown = "f.properties.inkscape_coordinates", "f.geometry.coordinates"
    return read.select("doc", "f.properties.name", "f.type", "f.properties.province", "f.properties.population", at(shown, 0).alias("lon"), at(shown, 1).alias("lat"), at(place, 0).alias("px"), at(place, 1).alias("py"))


@query("typed_geojson", f"SELECT n_name AS name, CASE WHEN n_nationkey % 2 = 0 THEN 'Small Marsh' ELSE 'Lake' END AS waterbody_type, {LON.format('n_nationkey')} AS lon, {LAT.format('7')} AS lat FROM nation")
def typed_geojson(t: Tables) -> DataFrame:
    form = "geometry struct<coordinates:array<double>>, properties struct<name:string,waterbody_type:string>"
    read = sinks.typed_features(drawings.water_labels(_rows(t)), "waterbody_type").select(F.from_json("feature", form).alias("f"))
    return read.select("f.properties.name", "f.properties.waterbody_type", *[F.round(F.get("f.geometry.coordinates", F.lit(i)), 6).alias(c) for i, c in enumerate(("lon", "lat"))])


@query(
    "processing_report",
    f"""WITH t AS (SELECT * FROM {_RICH_SQL}) SELECT 'factions' AS section, key, metric, value FROM (SELECT unnest(['empire', 'all']) AS key), (SELECT unnest(['settlements', 'population']) AS metric, unnest([(SELECT count(*) FROM t), (SELECT sum(population)::BIGINT FROM t)]) AS value)
    UNION ALL SELECT 'provinces', province, 'settlements', count(*) FROM t GROUP BY province UNION ALL SELECT 'provinces', province, 'population', sum(population)::BIGINT FROM t GROUP BY province
    UNION ALL SELECT 'points', CASE s_suppkey % 3 WHEN 0 THEN 'Other' WHEN 1 THEN 'Monasteries and Temples' ELSE 'Caves' END, 'count', count(*) FROM supplier GROUP BY 2
    UNION ALL SELECT 'regions', 'Province', 'count', count(*) FROM nation WHERE n_nationkey % 2 = 0
    UNION ALL SELECT 'water', CASE WHEN n_nationkey % 2 = 0 THEN 'Small Marsh' ELSE 'Lake' END, 'count', count(*) FROM nation GROUP BY 2
    UNION ALL SELECT 'invalid_tags', 'empire', 'count', count(*) FROM t WHERE known
    UNION ALL SELECT 'missing_population', province, 'count', count(*) FROM t WHERE population_status <> 'given' GROUP BY province
    UNION ALL SELECT 'reconciliation', CASE WHEN known THEN 'both' ELSE 'left_only' END, 'count', count(*) FROM t GROUP BY known
    UNION ALL SELECT 'reconciliation', 'right_only', 'count', (SELECT count(*) FROM customer WHERE c_custkey % 11 <> 0) - (SELECT count(*) FROM t WHERE known)
    UNION ALL SELECT 'roads', road_type, 'count', count(*) FROM {_ROADS_SQL} GROUP BY road_type UNION ALL SELECT 'roads', road_type, 'points', count(*) * 23 FROM {_ROADS_SQL} GROUP BY road_type""",
)
def processing_report(t: Tables) -> DataFrame:
    rows = lineage.cut(_rows(t))  # read by every section
    rich = lineage.cut(_rich(t, rows))
    status = reconcile.status_of_both(rich, _gazetteer(t), ["faction", "name"])
    return reports.processing_report(rich, drawings.points_of_interest(rows), drawings.region_labels(rows), drawings.water_labels(rows), status, drawings.roads(rows))


@query(
    "layer_features",
    f"""SELECT 'water' AS layer, n_name AS name, {LON.format('n_nationkey')} AS lon, {LAT.format('7')} AS lat, printf('X=%.3f, Y=%.3f', (n_nationkey - 428.530::DOUBLE) * 0.017504::DOUBLE, (3347.85::DOUBLE - 7) * 0.017504::DOUBLE) AS at FROM nation
    UNION ALL SELECT 'regions', n_name, {LON.format('3 * n_nationkey + 5')}, {LAT.format('3')}, printf('X=%.3f, Y=%.3f', (3 * n_nationkey + 5 - 428.530::DOUBLE) * 0.017504::DOUBLE, (3347.85::DOUBLE - 3) * 0.017504::DOUBLE) FROM nation WHERE n_nationkey % 2 = 0""",
)
def layer_features(t: Tables) -> DataFrame:
    """The viewer's layers as one table, with each feature's place as text."""
    rows = _rows(t)
    layers = {
        "water": sinks.typed_features(drawings.water_labels(rows), "waterbody_type"),
        "regions": sinks.typed_features(drawings.region_labels(rows), "province_type"),
    }
    return sinks.viewer_layers(layers).select("layer", "name", F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"), geo.coordinate_text(F.col("lon"), F.col("lat")).alias("at"))


@query(
    "network_by_drawing",
    """SELECT 'r' || n_regionkey AS doc, count(DISTINCT n_nationkey // 2) AS paths, count(DISTINCT upper(substr(n_name, 1, 2))) AS places FROM nation GROUP BY n_regionkey""",
)
def network_by_drawing(t: Tables) -> DataFrame:
    paths, places = drawings.route_inputs(_rows(t))
    return paths.groupBy("doc").agg(F.count("*").alias("paths")).join(places.groupBy("doc").agg(F.count("*").alias("places")), "doc")


@query("hidden_frame", "SELECT 'r' || r_regionkey AS doc, 1::BIGINT AS doc_order, 'display:none' AS style FROM region")
def hidden_frame(t: Tables) -> DataFrame:
    return drawings.hidden_element(_rows(t), "Frame")


@query(
    "route_requests",
    """SELECT a.n_nationkey AS k, upper(trim(' ' || lower(a.n_name))) AS start_name, CASE WHEN a.n_nationkey % 5 = 0 THEN upper(a.n_name) WHEN a.n_nationkey % 5 = 1 THEN 'NOWHERE' ELSE b.n_name END AS end_name,
    CASE WHEN a.n_nationkey % 5 = 0 THEN 'same' WHEN a.n_nationkey % 5 = 1 THEN 'unknown end' ELSE 'ok' END AS status
    FROM nation a JOIN nation b ON b.n_nationkey = (a.n_nationkey + 7) % 25""",
)
def route_requests(t: Tables) -> DataFrame:
    """Requests between nations: some of one end, some to a place that isn't there."""
    n = F.col("n_nationkey")
    ends = t.nation.select(F.pmod(n - 7, F.lit(25)).alias("n_nationkey"), F.lower("n_name").alias("other"))
    asked = t.nation.join(ends, "n_nationkey").select(n.alias("k"), F.concat(F.lit(" "), F.lower("n_name")).alias("start"), F.when(n % 5 == 0, F.col("n_name")).when(n % 5 == 1, "nowhere").otherwise(F.col("other")).alias("end"))
    nodes = t.nation.select(F.col("n_name").alias("id"), F.lit("location").alias("node_type"))
    return graphs.checked_requests(nodes, asked).select("k", F.col("start").alias("start_name"), F.col("end").alias("end_name"), "status")
