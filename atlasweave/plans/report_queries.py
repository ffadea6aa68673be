"""Files, logs, networks and histories: what they hold, against SQL over the rows they are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, paths, values
from ..operators import dedupe, graphs, lineage, reconcile, reports, sinks, snapshots, tiles
from ..sources import gazetteers
from ..streaming import landing
from .map_queries import EDGES_SQL, GOLDEN, _edges
from .registry import Tables, query


def _sheet(t: Tables) -> DataFrame:
    """Customers as rows of the population flavour, with quotes, commas and line ends in their notes."""
    given = {
        "Settlement": F.concat(F.lit(" "), "c_name", F.lit(" ")),
        "Population": F.col("c_custkey").cast("string"),
        "Notes": F.concat(F.lit('a "b", c\nd '), "c_mktsegment"),
        "Province_2515": F.concat(F.lit(" "), F.col("c_nationkey").cast("string")),
    }
    return t.customer.select(*[given.get(c, F.lit("")).alias(c) for c in gazetteers.HEADERS["population"]])


@query("csv_scan", "SELECT trim(c_name) AS name, c_custkey::VARCHAR AS people, 'a \"b\", c' || chr(10) || 'd ' || c_mktsegment AS notes FROM customer WHERE c_nationkey = 7")
def csv_scan(t: Tables) -> DataFrame:
    """A gazetteer written as CSV, read again with its header checked, of one province."""
    folder = lineage.folder(t.spark, "csv")
    sinks.write_csv(_sheet(t), folder)
    rows = gazetteers.by_name(gazetteers.read_csv(t.spark, folder, "population"), province="7")
    return rows.select("name", F.col("Population").alias("people"), F.col("Notes").alias("notes"))


@query("csv_stream", "SELECT CASE c_nationkey % 2 WHEN 0 THEN 'even' ELSE 'odd' END AS series, count(*) AS n, sum(c_custkey)::BIGINT AS people FROM customer GROUP BY 1")
def csv_stream(t: Tables) -> DataFrame:
    """Sheets that landed, read as a stream until none is left."""
    folder = lineage.folder(t.spark, "landing")
    rows = _sheet(t).withColumn("series", F.when(F.trim("Province_2515").cast("int") % 2 == 0, "even").otherwise("odd"))
    for series in ("even", "odd"):  # a folder has the name of its series, as a file has
        sinks.write_csv(rows.where(F.col("series") == series).drop("series"), f"{folder}/{series}_20260101_120000.csv")
    stream = landing.landing_stream(t.spark, f"{folder}/*", "population")
    out = lineage.folder(t.spark, "landed")
    stream.writeStream.option("checkpointLocation", out + "-offsets").trigger(availableNow=True).format("parquet").start(out).awaitTermination()
    read = t.spark.read.schema(stream.schema).parquet(out)
    return read.groupBy("series").agg(F.count("*").alias("n"), F.sum(F.col("Population").cast("long")).alias("people"))


@query("positional_scan", "SELECT c_name AS name, c_custkey AS population FROM customer WHERE c_custkey % 4 = 0")
def positional_scan(t: Tables) -> DataFrame:
    """Rows without header: whole, short, without a number, or with a broken one."""
    k = F.col("c_custkey")
    cells = F.when(k % 4 == 0, F.array(F.concat(F.lit(" "), "c_name"), F.concat(k.cast("string"), F.lit(" ")), F.lit("x"))).when(k % 4 == 1, F.array("c_name")).when(k % 4 == 2, F.array(F.col("c_name"), F.lit("")))
    return gazetteers.positional_population(t.customer.select(cells.otherwise(F.array(F.col("c_name"), F.lit("1.5"))).alias("cells")))


@query("wiki_lookup", "SELECT n_name AS name, CASE n_nationkey % 4 WHEN 3 THEN NULL ELSE n_nationkey END AS page, CASE WHEN n_nationkey % 4 = 3 THEN 'missing' ELSE 'found' END AS status FROM nation")
def wiki_lookup(t: Tables) -> DataFrame:
    """Names with brackets and diacritics; pages by the name, what is before its bracket, or inside of it."""
    k, name = F.col("n_nationkey"), F.col("n_name")
    asked = t.nation.select(name, F.when(k % 4 == 0, name).when(k % 4 == 1, F.concat(name, F.lit(" (Old "), name, F.lit(")"))).when(k % 4 == 2, F.concat(name, F.lit("é"))).otherwise(F.concat(F.lit("No "), name)).alias("Settlement"))
    pages = t.nation.select(F.when(k % 4 == 1, F.concat(F.lit("Old "), name)).when(k % 4 == 2, F.concat(name, F.lit("e"))).otherwise(name).alias("title"), k.alias("page_key"))
    return reconcile.wiki_lookup(asked, pages).select(F.col("n_name").alias("name"), F.col("page.page_key").alias("page"), "status")


@query(
    "enrich_regions",
    """SELECT n_name AS name, 'Province' AS province_type, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'Land of ' || n_name END AS formal_title, CASE WHEN n_nationkey % 3 = 0 THEN '' ELSE 'R' || n_regionkey END AS part_of,
    CASE WHEN n_nationkey % 3 = 1 THEN n_nationkey * 100 ELSE 0 END::INTEGER AS population, CASE WHEN n_nationkey % 3 = 1 THEN 'u' END AS url FROM nation""",
)
def enrich_regions(t: Tables) -> DataFrame:
    """A third of the labels has no row, another third a row with blanks."""
    k = F.col("n_nationkey")
    labels = t.nation.select(F.col("n_name").alias("name"), F.lit("Province").alias("province_type"))
    rows = t.nation.where(k % 3 != 0).select(
        F.col("n_name").alias("name"), F.concat(F.lit("Land of "), "n_name").alias("formal_title"), F.when(k % 3 == 1, " u ").otherwise(" ").alias("info_wiki_url"), F.lit("").alias("info_image"), F.lit("").alias("info_description"),
        F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("part_of"), F.when(k % 3 == 1, (k * 100).cast("string")).otherwise(" ").alias("population"), F.lit("Other").alias("province_type"),
    )
    return reconcile.enrich_regions(labels, rows).select("name", "province_type", "formal_title", "part_of", "population", F.col("info.wiki_url").alias("url"))


@query("duplicate_log", "WITH d AS (SELECT p_name, count(*) AS n FROM part GROUP BY p_name HAVING count(*) > 1) SELECT count(*) || ' names, ' || sum(n) || ' entries' AS line FROM d UNION ALL SELECT p_name || ': ' || n || ' times' FROM d")
def duplicate_log(t: Tables) -> DataFrame:
    lines = reports.duplicate_log(dedupe.duplicates(t.part, ["p_name"], "p_partkey"), "p_name")
    return lines.select(F.regexp_replace("line", r"(?s) \[.*", "").alias("line"))


_SIDES_SQL = "(SELECT coalesce(a.n, b.n) AS name, CASE WHEN a.n IS NULL THEN 'right_only' WHEN b.n IS NULL THEN 'left_only' ELSE 'both' END AS status FROM (SELECT n_name AS n FROM nation WHERE n_nationkey < 15) a FULL JOIN (SELECT n_name AS n FROM nation WHERE n_nationkey > 8) b ON a.n = b.n)"


@query("reconciliation_lines", f"SELECT status || ': ' || count(*) AS line FROM {_SIDES_SQL} GROUP BY status UNION ALL SELECT '  ' || name || ' (' || status || ')' FROM {_SIDES_SQL} WHERE status <> 'both'")
def reconciliation_lines(t: Tables) -> DataFrame:
    key = F.col("n_name").alias("name")
    status = reconcile.status_of_both(t.nation.where("n_nationkey < 15").select(key), t.nation.where("n_nationkey > 8").select(key), ["name"])
    return reports.reconciliation_lines(status, "name").select("line")


@query("report_text", "SELECT printf('%-20s %-24s %-14s %12s', 'types', p_type, 'count', format('{:,}', count(*) * 1000)) AS line FROM part GROUP BY p_type")
def report_text(t: Tables) -> DataFrame:
    rows = reports.type_counts(t.part, "p_type").select(F.lit("types").alias("section"), F.col("type").alias("key"), F.lit("count").alias("metric"), (F.col("n") * 1000).alias("value"))
    return reports.as_text(rows)


def _nodes(t: Tables) -> DataFrame:
    k = F.col("n_nationkey")
    return t.nation.select(k.cast("string").alias("id"), (k * 1.5).cast("double").alias("x"), (F.col("n_regionkey") * 2.5).cast("double").alias("y"), F.when(k % 2 == 0, "location").otherwise("endpoint").alias("node_type"))


@query(
    "network_map",
    f"""WITH e AS (SELECT least(a::VARCHAR, b::VARCHAR) AS a, greatest(a::VARCHAR, b::VARCHAR) AS b, arg_min(length, length) AS l, arg_min(weight, length) AS w FROM {EDGES_SQL} GROUP BY 1, 2)
    SELECT printf('  %-12s (%-12s) at (%6.1f, %6.1f)', n_nationkey::VARCHAR, CASE WHEN n_nationkey % 2 = 0 THEN 'location' ELSE 'endpoint' END, n_nationkey * 1.5::DOUBLE, n_regionkey * 2.5::DOUBLE) AS line FROM nation
    UNION ALL SELECT '  ' || a || ': ' || string_agg(b || printf(' [%.2fmm, weighted:%.2fmm]', l, w), ', ' ORDER BY b) FROM e GROUP BY a""",
)
def network_map(t: Tables) -> DataFrame:
    return sinks.network_map(_nodes(t), _edges(t).withColumn("t_start", F.col("length"))).select("line")


@query(
    "network_layer",
    f"""SELECT printf('<line x1="%.3f" y1="%.3f" x2="%.3f" y2="%.3f" style="stroke:#888888;stroke-width:0.5"/>', a.n_nationkey * 1.5::DOUBLE, a.n_regionkey * 2.5::DOUBLE, b.n_nationkey * 1.5::DOUBLE, b.n_regionkey * 2.5::DOUBLE) AS element
    FROM {EDGES_SQL} e JOIN nation a ON a.n_nationkey = e.a JOIN nation b ON b.n_nationkey = e.b UNION ALL
    SELECT printf('<circle cx="%.3f" cy="%.3f" r="%.1f" style="fill:%s;stroke:#000000"/><text x="%.3f" y="%.3f">%s</text>', n_nationkey * 1.5::DOUBLE, n_regionkey * 2.5::DOUBLE, CASE WHEN n_nationkey % 2 = 0 THEN 2.5::DOUBLE ELSE 1.5::DOUBLE END,
    CASE WHEN n_nationkey % 2 = 0 THEN '#ff0000' ELSE '#0000ff' END, n_nationkey * 1.5::DOUBLE + 3, n_regionkey * 2.5::DOUBLE - 2, n_nationkey::VARCHAR) FROM nation""",
)
def network_layer(t: Tables) -> DataFrame:
    return sinks.drawing_layer(_nodes(t), _edges(t).withColumn("path_id", F.lit("p"))).select("element")


@query("route_report", "SELECT line FROM (VALUES ('Shortest: A -> INT2 -> INT3 -> INT1 -> C -> E (341.76, weighted 341.76)'), ('Weighted: A -> INT2 -> INT3 -> INT1 -> C -> E (341.76, weighted 341.76)'), ('Second: no path')) v(line)")
def route_report(t: Tables) -> DataFrame:
    edges = t.spark.createDataFrame([(a, b, x, x) for a, b, x in GOLDEN], "node1_id string, node2_id string, length double, weight double")
    return sinks.route_report(graphs.find_path(edges, "A", "E"), graphs.find_path(edges, "A", "E", weighted=True), graphs.find_path(edges, "A", "nowhere"))


@query("neighbours", f"SELECT b::VARCHAR AS neighbour, round(length, 6) AS length FROM (SELECT a, b, length FROM {EDGES_SQL} UNION ALL SELECT b, a, length FROM {EDGES_SQL}) WHERE a = 5")
def neighbours(t: Tables) -> DataFrame:
    return sinks.neighbours(_edges(t), "5").select("neighbour", F.round("length", 6).alias("length"))


@query("locations", "SELECT n_nationkey::VARCHAR AS id FROM nation WHERE n_nationkey % 2 = 0")
def locations(t: Tables) -> DataFrame:
    return graphs.locations(_nodes(t))


@query("location_validity", "SELECT ' nation_' || n_nationkey AS name, n_nationkey < 20 AS valid FROM nation")
def location_validity(t: Tables) -> DataFrame:
    nodes = t.nation.where("n_nationkey < 20").select(F.concat(F.lit("Nation_"), F.col("n_nationkey").cast("string")).alias("id"), F.lit("location").alias("node_type"))
    return graphs.is_location(nodes, t.nation.select(F.concat(F.lit(" nation_"), F.col("n_nationkey").cast("string")).alias("name"))).select("name", "valid")


_STEP = "299 / 999.0::DOUBLE"
_ALONG_SQL = f"""(WITH h AS (SELECT 'r' || n_regionkey AS doc, n_nationkey AS n, row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS i FROM nation),
 spots AS (SELECT doc, 'h' || n AS path_id, 2.0::DOUBLE + i AS stroke, unnest(['EP_h' || n || '_0', 'S' || n, 'INT' || i, 'EP_h' || n || '_1']) AS node, unnest([0.0::DOUBLE, 100 * {_STEP}, 150.0::DOUBLE, 299.0::DOUBLE]) AS pos FROM h
  UNION ALL SELECT doc, 'v', 2.05::DOUBLE, 'INT' || i, 50.0::DOUBLE * i FROM h UNION ALL SELECT DISTINCT doc, 'v', 2.05::DOUBLE, unnest(['EP_v_0', 'EP_v_1']), unnest([0.0::DOUBLE, 299.0::DOUBLE]) FROM h)
 SELECT *, CASE WHEN pos < 2 THEN 0 ELSE floor((pos - 2) / ({_STEP})) + 1 END AS k FROM spots)"""


@query(
    "network_edges",
    f"""SELECT doc, path_id, a, b, round((k2 - k) * {_STEP}, 4) AS length, round((k2 - k) * {_STEP} * 2.05 / stroke, 4) AS weight
    FROM (SELECT doc, path_id, stroke, node AS a, k, lead(node) OVER w AS b, lead(k) OVER w AS k2 FROM {_ALONG_SQL} WINDOW w AS (PARTITION BY doc, path_id ORDER BY k)) WHERE b IS NOT NULL""",
)
def network_edges(t: Tables) -> DataFrame:
    """Each region's nations as level lines, all crossed by one upright line, with a station beside each.

    A node lies on a path from the first of 1,000 samples that is nearer than 2.
    """
    order = F.row_number().over(Window.partitionBy("n_regionkey").orderBy("n_nationkey"))
    rows = t.nation.select(F.format_string("r%d", "n_regionkey").alias("doc"), F.col("n_nationkey").alias("n"), order.alias("i"))
    level = rows.select("doc", F.format_string("h%d", "n").alias("path_id"), F.col("i").alias("path_ord"), F.format_string("M 0 %d L 299 %d", F.col("i") * 50, F.col("i") * 50).alias("d"), F.format_string("stroke-width:%dpx", F.col("i") + 2).alias("style"))
    upright = rows.select("doc").distinct().select("doc", F.lit("v").alias("path_id"), F.lit(0).alias("path_ord"), F.lit("M 150 0 L 150 299").alias("d"), F.lit(None).cast("string").alias("style"))
    stations = rows.select("doc", F.format_string("S%d", "n").alias("name"), F.lit(30.0).alias("x"), (F.col("i") * 50 + 1.0).alias("y"))
    _, edges = graphs.build_network(level.unionByName(upright), stations)
    return edges.select("doc", "path_id", F.col("node1_id").alias("a"), F.col("node2_id").alias("b"), F.round("length", 4).alias("length"), F.round("weight", 4).alias("weight"))


@query(
    "path_points",
    "SELECT p_partkey, i::INTEGER AS i, x::DOUBLE AS x, y::DOUBLE AS y FROM (SELECT p_partkey, unnest([0, 1, 2, 3]) AS i, unnest([p_size, p_size + 3, p_size + 3, 7]) AS x, unnest([0, 4, p_size, p_size]) AS y FROM part)",
)
def path_points(t: Tables) -> DataFrame:
    d = F.format_string("M %d,0 l 3 4 V %d x H 7 Z", "p_size", "p_size")
    return t.part.select("p_partkey", F.posexplode(paths.path_points(d)).alias("i", "p")).select("p_partkey", "i", "p.x", "p.y")


@query("path_samples", "SELECT p_partkey, k::INTEGER AS k, round(least(s, 30), 4) AS x, round(greatest(s - 30, 0), 4) AS y FROM (SELECT p_partkey, k, (30 + p_size) * k / 4.0::DOUBLE AS s FROM part, (SELECT unnest([0, 1, 2, 3, 4]) AS k))")
def path_samples(t: Tables) -> DataFrame:
    lines = t.part.select("p_partkey", F.format_string("M 0 0 L 30 0 L 30 %d", "p_size").alias("d"))
    return paths.sample_paths(lines, 5).select("p_partkey", "k", F.round("x", 4).alias("x"), F.round("y", 4).alias("y"))


@query("snapshot_pairs", "SELECT user_id, ts::VARCHAR AS taken, lag(ts) OVER (PARTITION BY user_id ORDER BY ts)::VARCHAR AS before FROM (SELECT DISTINCT user_id, ts FROM events)")
def snapshot_pairs(t: Tables) -> DataFrame:
    pairs = snapshots.consecutive(t.events, "user_id", "ts")
    return pairs.select("user_id", F.col("ts").cast("string").alias("taken"), F.col("before").cast("string").alias("before"))


@query("emptied", "SELECT o_orderkey FROM orders WHERE o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0")
def emptied(t: Tables) -> DataFrame:
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    old, new = t.orders.select(k, F.when(k % 5 != 0, s).otherwise(" ").alias("s")), t.orders.select(k, F.when(k % 7 == 0, "  ").otherwise(s).alias("s"))
    return snapshots.emptied(old, new, ["o_orderkey"], "s")


@query("blanks", "SELECT c_custkey, s IS NULL OR trim(s) = '' AS blank, nullif(s, '') AS kept, nullif(trim(s), '') AS trimmed, TRY_CAST(trim(s) AS DOUBLE) AS number FROM (SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '  ' WHEN 3 THEN ' ' || c_custkey || '.5 ' ELSE c_mktsegment END AS s FROM customer)")
def blanks(t: Tables) -> DataFrame:
    k = F.col("c_custkey")
    s = F.when(k % 5 == 1, "").when(k % 5 == 2, "  ").when(k % 5 == 3, F.concat(F.lit(" "), k.cast("string"), F.lit(".5 "))).when(k % 5 == 4, F.col("c_mktsegment"))
    return t.customer.select("c_custkey", values.blank(s).alias("blank"), values.empty_to_null(s).alias("kept"), values.trimmed_or_null(s).alias("trimmed"), values.number_or_null(s).alias("number"))


@query("lookup_variants", "SELECT w, CASE WHEN strip_accents(w) = w THEN w || ' (x)|' || w || '|x' ELSE w || ' (x)|' || strip_accents(w) || ' (x)|' || w || '|' || strip_accents(w) || '|x' END AS variants FROM (SELECT DISTINCT unnest(string_split_regex(text, '[^\\p{L}]+')) AS w FROM documents) WHERE w <> ''")
def lookup_variants(t: Tables) -> DataFrame:
    words = t.documents.select(F.explode(F.split("text", r"[^\p{L}]+")).alias("w")).where("w <> ''").distinct()
    return words.select("w", F.array_join(names.lookup_variants(F.concat("w", F.lit(" (x)"))), "|").alias("variants"))


@query("strip_marks_any", "SELECT DISTINCT w, strip_accents(w) AS plain FROM (SELECT unnest(string_split_regex(text, '[^\\p{L}]+')) AS w FROM documents)")
def strip_marks_any(t: Tables) -> DataFrame:
    return t.documents.select(F.explode(F.split("text", r"[^\p{L}]+")).alias("w")).distinct().select("w", names.strip_marks_any(F.col("w")).alias("plain"))


@query("mobile_portrait", "SELECT p_partkey, p_size * 40 <= 768 AND p_partkey % 2000 > p_size * 40 AS portrait FROM part")
def mobile_portrait(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", values.mobile_portrait(F.col("p_size") * 40, F.col("p_partkey") % 2000).alias("portrait"))


@query("frame_pixels", "SELECT p_partkey, round((p_size - 3.5::DOUBLE) * 1.25, 6) AS px FROM part")
def frame_pixels(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", F.round(tiles.to_pixels(F.col("p_size"), F.lit(3.5), F.lit(1.25)), 6).alias("px"))
