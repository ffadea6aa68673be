"""Coordinates, transforms, tiles, distances and networks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import affine, geo, values
from ..operators import graphs, sinks, spatial, tiles
from .registry import Tables, query


@query("geo_convert", "SELECT l_orderkey, l_linenumber, round((l_extendedprice / 50 - 428.530) * 0.017504, 6) AS lon, round((3347.85 - l_quantity * 40) * 0.017504, 6) AS lat FROM lineitem")
def geo_convert(t: Tables) -> DataFrame:
    return t.lineitem.select("l_orderkey", "l_linenumber", F.round(geo.longitude(F.col("l_extendedprice") / 50), 6).alias("lon"), F.round(geo.latitude(F.col("l_quantity") * 40), 6).alias("lat"))


@query(
    "calibration_error",
    """SELECT p AS point, round((x - 428.530) * 0.017504 - lon, 6) AS lon_error, round((3347.85 - y) * 0.017504 - lat, 6) AS lat_error,
    round(sqrt(((x - 428.530) * 0.017504 - lon) ** 2 + ((3347.85 - y) * 0.017504 - lat) ** 2), 6) AS error FROM (VALUES """
    + ", ".join(f"('{p}', {x}::DOUBLE, {y}::DOUBLE, {a}::DOUBLE, {b}::DOUBLE)" for p, x, y, a, b in geo.CALIBRATION)
    + ") v(p, x, y, lon, lat)",
)
def calibration_error(t: Tables) -> DataFrame:
    rows = t.spark.createDataFrame(list(geo.CALIBRATION), "point string, x double, y double, lon double, lat double")
    dx, dy = geo.longitude(F.col("x")) - F.col("lon"), geo.latitude(F.col("y")) - F.col("lat")
    return rows.select("point", F.round(dx, 6).alias("lon_error"), F.round(dy, 6).alias("lat_error"), F.round(F.sqrt(dx * dx + dy * dy), 6).alias("error"))


def _points(t: Tables) -> DataFrame:
    """Customers as points: balance against key."""
    return t.customer.select("c_custkey", (F.col("c_acctbal") / 100).alias("x"), (F.pmod("c_custkey", F.lit(97)) * 1.0).alias("y"))


POINTS_SQL = "(SELECT c_custkey, c_acctbal / 100 AS x, (c_custkey % 97) * 1.0::DOUBLE AS y, c_nationkey FROM customer)"


@query(
    "affine_parse",
    """SELECT n_nationkey, round(k + cos(radians(30)) * 2 - 4 * sin(radians(30)), 6) AS x, round(2 + sin(radians(30)) * 2 + 4 * cos(radians(30)), 6) AS y,
    round(2.0::DOUBLE * k + 3, 6) AS mx FROM (SELECT n_nationkey, n_nationkey::DOUBLE AS k FROM nation)""",
)
def affine_parse(t: Tables) -> DataFrame:
    m = affine.parse_transform(F.format_string("translate(%d, 2) rotate(30) scale(2) skewZ(1)", "n_nationkey"))
    n = affine.parse_transform(F.format_string("matrix(2 0 0 2 3 4)"))
    k = F.col("n_nationkey").cast("double")
    return t.nation.select("n_nationkey", F.round(affine.apply_x(m, F.lit(1.0), F.lit(2.0)), 6).alias("x"), F.round(affine.apply_y(m, F.lit(1.0), F.lit(2.0)), 6).alias("y"), F.round(affine.apply_x(n, k, F.lit(0.0)), 6).alias("mx"))


@query("affine_compose", "SELECT c_custkey, round(10 + 2 * (x * 0.5 - 1), 6) AS px, round(20 + 2 * (y * 0.5 - 1), 6) AS py FROM " + POINTS_SQL)
def affine_compose(t: Tables) -> DataFrame:
    m = affine.compose_all(F.transform(F.array(F.lit("translate(10 20)"), F.lit(""), F.lit("scale(2)"), F.lit("translate(-1,-1)"), F.lit("scale(.5)")), lambda x: affine.parse_transform(x)))
    return _points(t).select("c_custkey", F.round(affine.apply_x(m, F.col("x"), F.col("y")), 6).alias("px"), F.round(affine.apply_y(m, F.col("x"), F.col("y")), 6).alias("py"))


@query("bbox", f"SELECT c_nationkey, min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM {POINTS_SQL} GROUP BY c_nationkey")
def bbox(t: Tables) -> DataFrame:
    p = _points(t).join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    return spatial.bounds(p, "c_nationkey")


@query(
    "bezier_sample",
    """SELECT p_partkey, i::INTEGER AS i, round(3 * m * m * s * a + 3 * m * s * s * b + s * s * s * 10, 4) AS x, round(3 * m * m * s * b + s * s * s * a, 4) AS y
    FROM (SELECT p_partkey, p_size::DOUBLE AS a, p_retailprice / 100 AS b, unnest(range(0, 20)) AS i FROM part), LATERAL (SELECT i / 19.0::DOUBLE AS s, 1 - i / 19.0::DOUBLE AS m)""",
)
def bezier_sample(t: Tables) -> DataFrame:
    at = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    a, b, zero = F.col("p_size").cast("double"), F.col("p_retailprice") / 100, F.lit(0.0)
    points = geo.bezier(at(zero, zero), at(a, b), at(b, zero), at(F.lit(10.0), a))
    return t.part.select("p_partkey", F.posexplode(points).alias("i", "p")).select("p_partkey", "i", F.round("p.x", 4).alias("x"), F.round("p.y", 4).alias("y"))


@query("polyline_length", "SELECT user_id, round(coalesce(sum(sqrt((v - pv) ** 2 + 1)), 0), 4) AS length FROM (SELECT user_id, value AS v, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pv FROM events) GROUP BY user_id")
def polyline_length(t: Tables) -> DataFrame:
    """Each user's values in order as a line whose points are 1 apart on the x axis."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", "value"))), lambda e, i: F.struct(i.cast("double").alias("x"), e["value"].alias("y")))
    return t.events.groupBy("user_id").agg(ordered.alias("points")).select("user_id", F.round(geo.polyline_length(F.col("points")), 4).alias("length"))


@query("tile_grid", "SELECT z::INTEGER AS z, x::INTEGER AS x, y::INTEGER AS y, z || '/' || x || '/' || y || '.png' AS path FROM (SELECT unnest(range(1, 7)) AS z) a, LATERAL (SELECT unnest(range(0, (2 ** z)::BIGINT)) AS x) b, LATERAL (SELECT unnest(range(0, (2 ** z)::BIGINT)) AS y) c")
def tile_grid(t: Tables) -> DataFrame:
    return tiles.manifest(tiles.blocks(t.spark, 1, 6)).select("z", "x", "y", "path")


@query("tile_assign", f"SELECT c_custkey, CASE WHEN x BETWEEN -10 AND 90 THEN least(floor((x + 10) / 100 * 16), 15)::INTEGER ELSE -1 END AS tx, CASE WHEN y BETWEEN 0 AND 60 THEN least(floor(y / 60 * 16), 15)::INTEGER ELSE -1 END AS ty FROM {POINTS_SQL}")
def tile_assign(t: Tables) -> DataFrame:
    return _points(t).select("c_custkey", F.coalesce(tiles.tile_of(F.col("x"), -10.0, 100.0, F.lit(4)), F.lit(-1)).alias("tx"), F.coalesce(tiles.tile_of(F.col("y"), 0.0, 60.0, F.lit(4)), F.lit(-1)).alias("ty"))


@query(
    "block_areas",
    """SELECT z, col, row, round(100 + col * w, 4) AS x0, round(50 + (n - row - k) * h, 4) AS y0, round(100 + (col + k) * w, 4) AS x1, round(50 + (n - row) * h, 4) AS y1
    FROM (SELECT z::INTEGER AS z, c::INTEGER AS col, r::INTEGER AS row, n, least(n, 8) AS k, 740.0::DOUBLE / n AS w, 370.0::DOUBLE / n AS h FROM (SELECT unnest(range(1, 7)) AS z), LATERAL (SELECT (2 ** z)::BIGINT AS n) b,
    LATERAL (SELECT unnest(range(0, n, least(n, 8))) AS c) d, LATERAL (SELECT unnest(range(0, n, least(n, 8))) AS r) e)""",
)
def block_areas(t: Tables) -> DataFrame:
    return tiles.with_area(tiles.blocks(t.spark, 1, 6, 8), 100.0, 50.0, 840.0, 420.0).select("z", "col", "row", *[F.round(c, 4).alias(c) for c in ("x0", "y0", "x1", "y1")])


@query("resolutions", "SELECT z::INTEGER AS z, round(37.0::DOUBLE / (256 * 2 ** z), 10) AS frame, round(0.15003::DOUBLE * 0.9997 / 2 ** z / 1.56221, 10) AS quadrant FROM (SELECT unnest(range(1, 9)) AS z)")
def resolutions(t: Tables) -> DataFrame:
    return tiles.viewer_config(t.spark).select("z", F.round("resolution", 10).alias("frame"), F.round(geo.view_resolution(F.col("z"), True), 10).alias("quadrant"))


@query("quadrant", f"SELECT c_custkey, CASE WHEN x - 40 BETWEEN -19.045 AND 18.457 AND y BETWEEN 31.949 AND 69.451 THEN (CASE WHEN y < 50.7 THEN 'S' ELSE 'N' END) || (CASE WHEN x - 40 < -0.294 THEN 'W' ELSE 'E' END) END AS quadrant FROM {POINTS_SQL}")
def quadrant(t: Tables) -> DataFrame:
    return _points(t).select("c_custkey", geo.quadrant(F.col("x") - 40, F.col("y")).alias("quadrant"))


@query("viewer_rows", "SELECT n_nationkey, -1 - n_nationkey AS y FROM nation")
def viewer_rows(t: Tables) -> DataFrame:
    return t.nation.select("n_nationkey", geo.viewer_row(F.col("n_nationkey")).alias("y"))


@query("css_display", "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'fill:red;display:none' ELSE 'display:none;fill:' || p_brand END AS style FROM part")
def css_display(t: Tables) -> DataFrame:
    given = F.when(F.pmod("p_partkey", F.lit(2)) == 0, "fill:red; Display:inline;").otherwise(F.concat(F.lit("fill:"), "p_brand"))
    return t.part.select("p_partkey", values.with_display(given, "none").alias("style"))


@query("stroke_width", "SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 2.05::DOUBLE WHEN p_partkey % 3 = 1 THEN p_size * 1.0::DOUBLE ELSE p_size + 0.5::DOUBLE END AS width FROM part")
def stroke_width(t: Tables) -> DataFrame:
    k = F.pmod("p_partkey", F.lit(3))
    style = F.when(k == 0, "fill:none;stroke-width:wide").when(k == 1, F.format_string("fill:none;stroke-width: %dpx", "p_size")).otherwise(F.format_string("stroke-width:x;stroke-width:%d.5mm", "p_size"))
    return t.part.select("p_partkey", values.stroke_width(style).alias("width"))


@query("css_length", "SELECT p_partkey, round(p_size * CASE p_partkey % 5 WHEN 0 THEN 96 WHEN 1 THEN 96 / 25.4::DOUBLE WHEN 2 THEN 96 / 2.54::DOUBLE WHEN 3 THEN 96 / 72.0::DOUBLE ELSE 1 END, 4) AS px FROM part")
def css_length(t: Tables) -> DataFrame:
    unit = F.element_at(F.array(*[F.lit(u) for u in ("in", "mm", "cm", "pt", "")]), (F.pmod("p_partkey", F.lit(5)) + 1).cast("int"))
    return t.part.select("p_partkey", F.round(values.length_px(F.concat(F.col("p_size").cast("string"), unit)), 4).alias("px"))


SUPPLIERS_SQL = "(SELECT s_suppkey, s_acctbal / 100 AS sx, (s_suppkey % 97) * 1.0::DOUBLE AS sy FROM supplier)"


def _suppliers(t: Tables) -> DataFrame:
    return t.supplier.select("s_suppkey", (F.col("s_acctbal") / 100).alias("ax"), (F.pmod("s_suppkey", F.lit(97)) * 1.0).alias("ay"))


@query(
    "nearest_point",
    f"SELECT s_suppkey, arg_min(c_custkey, (sqrt((sx - x) * (sx - x) + (sy - y) * (sy - y)), c_custkey)) AS c_custkey, round(min(sqrt((sx - x) * (sx - x) + (sy - y) * (sy - y))), 6) AS dist FROM {SUPPLIERS_SQL}, {POINTS_SQL} WHERE sqrt((sx - x) * (sx - x) + (sy - y) * (sy - y)) < 10 GROUP BY s_suppkey",
)
def nearest_point(t: Tables) -> DataFrame:
    b = _points(t).select("c_custkey", F.col("x").alias("bx"), F.col("y").alias("by"))
    return spatial.nearest(_suppliers(t), b, "s_suppkey", 10.0, ["c_custkey"], ["c_custkey"], levels=4).select("s_suppkey", "c_custkey", F.round("dist", 6).alias("dist"))


@query("distance_join", f"SELECT a.c_custkey AS a, b.c_custkey AS b, round(sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)), 6) AS dist FROM {POINTS_SQL} a, {POINTS_SQL} b WHERE a.c_custkey < b.c_custkey AND sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) < 1.5")
def distance_join(t: Tables) -> DataFrame:
    return spatial.pairs_within(_points(t), "c_custkey", 1.5).select("a", "b", geo.rounded(F.col("dist"), 6).alias("dist"))


@query(
    "nms",
    f"""WITH RECURSIVE p AS (SELECT c_nationkey AS g, c_custkey AS k, x, y FROM {POINTS_SQL}),
    r AS (SELECT 0 AS i, * FROM p UNION ALL SELECT i + 1, g, k, x, y FROM (SELECT *, first_value(x) OVER w AS fx, first_value(y) OVER w AS fy, first_value(k) OVER w AS fk FROM r WINDOW w AS (PARTITION BY g ORDER BY k)) WHERE k <> fk AND (x - fx) ** 2 + (y - fy) ** 2 >= 100)
    SELECT g AS c_nationkey, min(k) AS c_custkey, arg_min(x, k) AS x, arg_min(y, k) AS y FROM r GROUP BY g, i""",
)
def nms(t: Tables) -> DataFrame:
    p = _points(t).join(t.customer.select("c_custkey", "c_nationkey"), "c_custkey")
    return spatial.thin(p, ["c_nationkey"], 10.0, ["c_custkey"])


@query("consecutive_edges", "SELECT user_id, event_id AS a, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events QUALIFY b IS NOT NULL")
def consecutive_edges(t: Tables) -> DataFrame:
    return graphs.consecutive(t.events.select("user_id", "ts", F.col("event_id")), ["user_id"], ["ts", "event_id"], F.col("event_id")).select("user_id", "a", "b")


EDGES_SQL = """(SELECT n_nationkey AS a, (n_nationkey + 1) % 25 AS b, 1.0::DOUBLE + n_nationkey % 5 AS length, (1.0::DOUBLE + n_nationkey % 5) * (2.05::DOUBLE / (1.0::DOUBLE + n_regionkey)) AS weight FROM nation
 UNION ALL SELECT n_nationkey, n_regionkey * 5, 4.5::DOUBLE + n_nationkey % 3, (4.5::DOUBLE + n_nationkey % 3) * (2.05::DOUBLE / 3) FROM nation WHERE n_nationkey <> n_regionkey * 5)"""


def _edges(t: Tables) -> DataFrame:
    """A ring over the nations and a hub for every region."""
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    ring = t.nation.select(k.cast("string").alias("node1_id"), F.pmod(k + 1, F.lit(25)).cast("string").alias("node2_id"), (1.0 + k % 5).alias("length"), (1.0 + r).alias("stroke"))
    hubs = t.nation.where(k != r * 5).select(k.cast("string").alias("node1_id"), (r * 5).cast("string").alias("node2_id"), (4.5 + k % 3).alias("length"), F.lit(3.0).alias("stroke"))
    return ring.unionByName(hubs).withColumn("weight", geo.edge_weight(F.col("length"), F.col("stroke"))).drop("stroke")


@query("edge_weight", f"SELECT a::VARCHAR AS a, b::VARCHAR AS b, round(length, 6) AS length, round(weight, 6) AS weight FROM {EDGES_SQL}")
def edge_weight(t: Tables) -> DataFrame:
    return _edges(t).select(F.col("node1_id").alias("a"), F.col("node2_id").alias("b"), F.round("length", 6).alias("length"), F.round("weight", 6).alias("weight"))


@query("adjacency", f"SELECT a::VARCHAR AS src, b::VARCHAR AS dst, round(weight, 6) AS weight FROM {EDGES_SQL} UNION ALL SELECT b::VARCHAR, a::VARCHAR, round(weight, 6) FROM {EDGES_SQL}")
def adjacency(t: Tables) -> DataFrame:
    return graphs.adjacency(_edges(t)).select("src", "dst", F.round("weight", 6).alias("weight"))


@query("degree", f"SELECT src AS node, count(*) AS degree, array_to_string(list_sort(list_distinct(list(dst))), ',') AS neighbours FROM (SELECT a::VARCHAR AS src, b::VARCHAR AS dst FROM {EDGES_SQL} UNION ALL SELECT b::VARCHAR, a::VARCHAR FROM {EDGES_SQL}) GROUP BY src")
def degree(t: Tables) -> DataFrame:
    return graphs.degrees(_edges(t)).select("node", "degree", F.array_join("neighbours", ",").alias("neighbours"))


def _hops(cost: str, rounds: int = 10) -> str:
    """Min-plus rounds over the edges from node 0, one table expression each."""
    out = [f"WITH e AS (SELECT a, b, {cost} AS c FROM {EDGES_SQL} UNION ALL SELECT b, a, {cost} FROM {EDGES_SQL}), d0 AS (SELECT 0 AS node, 0.0::DOUBLE AS c)"]
    for i in range(rounds):
        out.append(f"d{i + 1} AS (SELECT node, min(c) AS c FROM (SELECT * FROM d{i} UNION ALL SELECT b, d{i}.c + e.c FROM d{i} JOIN e ON a = node) GROUP BY node)")
    return ", ".join(out) + f" SELECT node::VARCHAR AS node, round(c, 4) AS cost FROM d{rounds}"


def _from_zero(t: Tables, cost: str) -> DataFrame:
    starts = t.spark.createDataFrame([("0", "0")], "run string, node string")
    return graphs.shortest_from(_edges(t), starts, cost).select("node", F.round("cost", 4).alias("cost"))


@query("sssp", _hops("length"))
def sssp(t: Tables) -> DataFrame:
    return _from_zero(t, "length")


@query("sssp_weighted", _hops("weight"))
def sssp_weighted(t: Tables) -> DataFrame:
    return _from_zero(t, "weight")


def _routes_sql(rounds: int = 10) -> str:
    out = [f"WITH e AS (SELECT a, b, length AS c FROM {EDGES_SQL} UNION ALL SELECT b, a, length FROM {EDGES_SQL}), d0 AS (SELECT n_nationkey AS s, n_nationkey AS node, 0.0::DOUBLE AS c FROM nation)"]
    for i in range(rounds):
        out.append(f"d{i + 1} AS (SELECT s, node, min(c) AS c FROM (SELECT * FROM d{i} UNION ALL SELECT s, b, d{i}.c + e.c FROM d{i} JOIN e ON a = node) GROUP BY s, node)")
    ends = "CASE WHEN n_nationkey % 5 = 0 THEN n_nationkey::VARCHAR WHEN n_nationkey % 5 = 1 THEN 'X' ELSE ((n_nationkey + 7) % 25)::VARCHAR END"
    return ", ".join(out) + f' SELECT n_nationkey::VARCHAR AS start, {ends} AS "end", round(c, 4) AS distance, c IS NOT NULL AS "exists" FROM nation LEFT JOIN d{rounds} ON s = n_nationkey AND node::VARCHAR = {ends}'


@query("route_table", _routes_sql())
def route_table(t: Tables) -> DataFrame:
    """Routes of many requests in one search, some to the start itself or to a place that isn't there."""
    n = F.col("n_nationkey")
    end = F.when(n % 5 == 0, n.cast("string")).when(n % 5 == 1, "X").otherwise(F.pmod(n + 7, F.lit(25)).cast("string"))
    asked = t.nation.select(n.cast("string").alias("start"), end.alias("end"))
    return graphs.find_paths(_edges(t), asked).select("start", "end", F.round("distance", 4).alias("distance"), "exists")


@query("reachability", "SELECT count(*) AS reached FROM nation")
def reachability(t: Tables) -> DataFrame:
    return _from_zero(t, "length").agg(F.count("*").alias("reached"))


# A network whose routes are known, as pairs of nodes and lengths.
GOLDEN = (("A", "INT2", 37.35), ("B", "INT2", 55.95), ("C", "INT1", 117.96), ("C", "E", 102.94), ("C", "EP_path3_0", 51.76), ("C", "EP_path3_1", 72.26), ("D", "INT1", 38.43), ("E", "EP_path1_1", 2.42), ("EP_path2_1", "INT2", 33.06), ("EP_path2_1", "INT3", 17.61), ("INT1", "INT3", 57.83), ("INT2", "INT3", 25.68))


@query(
    "k_shortest",
    "WITH RECURSIVE e(a, b, l) AS (VALUES "
    + ", ".join(f"('{a}', '{b}', {x}::DOUBLE), ('{b}', '{a}', {x}::DOUBLE)" for a, b, x in GOLDEN)
    + "), r AS (SELECT 'A' AS node, ['A'] AS path, 0.0::DOUBLE AS length UNION ALL SELECT e.b, list_append(r.path, e.b), r.length + e.l FROM r JOIN e ON e.a = r.node WHERE NOT list_contains(r.path, e.b)) "
    "SELECT array_to_string(path, ' -> ') AS path, round(length, 2) AS length FROM r WHERE node = 'E' ORDER BY length LIMIT 2",
)
def k_shortest(t: Tables) -> DataFrame:
    edges = t.spark.createDataFrame([(a, b, x, x) for a, b, x in GOLDEN], "node1_id string, node2_id string, length double, weight double")
    return graphs.k_shortest(edges, "A", "E").select(F.array_join("path", " -> ").alias("path"), F.round("length", 2).alias("length"))


@query(
    "geojson_features",
    f"SELECT c_custkey, 'Feature' AS type, 'Point' AS shape, round((x - 428.530) * 0.017504, 6) AS lon, round((3347.85 - y) * 0.017504, 6) AS lat, c_custkey AS key, true AS shows_null FROM {POINTS_SQL}",
)
def geojson_features(t: Tables) -> DataFrame:
    props = [F.col("c_custkey"), F.lit(None).cast("string").alias("wiki")]
    made = _points(t).select("c_custkey", sinks.point_feature(geo.longitude(F.col("x")), geo.latitude(F.col("y")), props).alias("feature"))
    read = made.withColumn("f", F.from_json("feature", "type string, geometry struct<type:string,coordinates:array<double>>, properties struct<c_custkey:bigint>"))
    at = lambda i: F.round(F.get("f.geometry.coordinates", F.lit(i)), 6)
    return read.select("c_custkey", "f.type", F.col("f.geometry.type").alias("shape"), at(0).alias("lon"), at(1).alias("lat"), F.col("f.properties.c_custkey").alias("key"), F.col("feature").contains('"wiki":null').alias("shows_null"))
