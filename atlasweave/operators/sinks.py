"""GeoJSON, CSV, network maps, annotated drawings and snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .graphs import adjacency

# How nodes are drawn (fill, radius); other types as path_node.
NODE_STYLES = {"location": ("#ff0000", 2.5), "intersection": ("#00ff00", 2.0), "endpoint": ("#0000ff", 1.5), "path_node": ("#888888", 1.0)}


def point_feature(lon: Column, lat: Column, properties: list[Column]) -> Column:
    """GeoJSON text of a point; properties that are null stay as nulls."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    return F.to_json(feature, {"ignoreNullFields": "false"})


def line_feature(points: Column, properties: list[Column]) -> Column:
    """GeoJSON text of a line from an array of structs of x and y."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.lit("LineString").alias("type"), F.transform(points, lambda p: F.array(p["x"], p["y"])).alias("coordinates")).alias("geometry"), F.struct(*properties).alias("properties"))
    return F.to_json(feature, {"ignoreNullFields": "false"})


def settlement_features(rows: DataFrame, *kept: str) -> DataFrame:
    place = F.array("px", "py").alias("inkscape_coordinates")
    return rows.select(*kept, "faction", "doc_order", point_feature(F.col("lon"), F.col("lat"), [*map(F.col, ("name", "province", "population", "tags", "notes", "size_category")), place, F.col("wiki")]).alias("feature"))


def typed_features(rows: DataFrame, kind: str, *more: str) -> DataFrame:
    """Features of typed points: holds, points of interest, regions, water."""
    place = F.array("px", "py").alias("inkscape_coordinates")
    return rows.select("doc_order", point_feature(F.col("lon"), F.col("lat"), [F.col("name"), F.col(kind), *map(F.col, more), place]).alias("feature"))


# Layers of the viewer whose features also stand in a layer of markers alone.
MARKED_LAYERS = {"settlements": "settlement_markers", "dwarf_settlements": "dwarf_settlement_markers"}


def viewer_layers(layers: dict[str, DataFrame]) -> DataFrame:
    """``layer``, ``name``, ``lon``, ``lat``, ``feature`` of point features by layer, those of marked layers in both."""
    form = "geometry struct<coordinates:array<double>>, properties struct<name:string>"
    out = None
    for layer, features in layers.items():
        names = F.array(*[F.lit(n) for n in (layer, MARKED_LAYERS.get(layer)) if n])
        read = features.select(F.explode(names).alias("layer"), F.from_json("feature", form).alias("f"), "feature")
        read = read.select("layer", "f.properties.name", F.get("f.geometry.coordinates", F.lit(0)).alias("lon"), F.get("f.geometry.coordinates", F.lit(1)).alias("lat"), "feature")
        out = read if out is None else out.unionByName(read)
    if out is None:
        raise ValueError("no layers")
    return out


def write_features(features: DataFrame, path: str, order: str = "doc_order") -> None:
    """One GeoJSON feature a line, in parts ordered over the whole."""
    features.orderBy(order).select("feature").write.mode("overwrite").text(path)


def collection(features: DataFrame, order: str = "doc_order") -> DataFrame:
    """One row with a whole FeatureCollection, for maps that fit one file."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(order, "feature"))), lambda x: x["feature"])
    return features.agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(ordered, ","), F.lit("]}")).alias("geojson"))


def newline_normalised(text: Column) -> Column:
    return F.regexp_replace(text, "\r\n?", "\n")


def write_csv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_snapshot(rows: DataFrame, path: str, stamp: str) -> None:
    """Append the rows below ``taken=<stamp>``; earlier snapshots stay."""
    rows.withColumn("taken", F.lit(stamp)).write.mode("append").partitionBy("taken").parquet(path)


def network_map(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Lines of a network's text map: nodes, then each node's links, every pair of nodes once."""
    node_lines = nodes.select(F.lit(0).alias("part"), F.col("id").alias("at"), F.format_string("  %-12s (%-12s) at (%6.1f, %6.1f)", "id", "node_type", "x", "y").alias("line"))
    pairs = edges.groupBy(F.least("node1_id", "node2_id").alias("a"), F.greatest("node1_id", "node2_id").alias("b")).agg(F.min_by(F.struct("length", "weight"), "t_start").alias("e"))
    text = F.format_string("%s [%.2fmm, weighted:%.2fmm]", "b", "e.length", "e.weight")
    links = pairs.groupBy("a").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("b", text.alias("t")))), lambda x: x["t"]), ", ").alias("links"))
    edge_lines = links.select(F.lit(1).alias("part"), F.col("a").alias("at"), F.concat(F.lit("  "), F.col("a"), F.lit(": "), F.col("links")).alias("line"))
    return node_lines.unionByName(edge_lines).orderBy("part", "at")


def _xml(text: Column) -> Column:
    for char, name in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(name))
    return text


def drawing_layer(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Elements of a layer that shows a network: links first, then nodes with labels; ``part``, ``at``, ``element``."""
    ends = edges.join(nodes.select(F.col("id").alias("node1_id"), F.col("x").alias("x1"), F.col("y").alias("y1")), "node1_id").join(nodes.select(F.col("id").alias("node2_id"), F.col("x").alias("x2"), F.col("y").alias("y2")), "node2_id")
    lines = ends.select(F.lit(0).alias("part"), F.concat_ws("|", "node1_id", "node2_id", "path_id").alias("at"), F.format_string('<line x1="%.3f" y1="%.3f" x2="%.3f" y2="%.3f" style="stroke:#888888;stroke-width:0.5"/>', "x1", "y1", "x2", "y2").alias("element"))
    fill, radius = F.lit(NODE_STYLES["path_node"][0]), F.lit(NODE_STYLES["path_node"][1])
    for kind, (colour, size) in NODE_STYLES.items():
        fill, radius = F.when(F.col("node_type") == kind, colour).otherwise(fill), F.when(F.col("node_type") == kind, size).otherwise(radius)
    dot = F.format_string('<circle cx="%.3f" cy="%.3f" r="%.1f" style="fill:%s;stroke:#000000"/><text x="%.3f" y="%.3f">%s</text>', F.col("x"), F.col("y"), radius, fill, F.col("x") + 3, F.col("y") - 2, _xml(F.col("id")))
    return lines.unionByName(nodes.select(F.lit(1).alias("part"), F.col("id").alias("at"), dot.alias("element"))).orderBy("part", "at")


def legend(spark: SparkSession) -> DataFrame:
    rows = [(2, f"{i}", f'<circle cx="5" cy="{5 + 5 * i}" r="{size}" style="fill:{colour}"/><text x="10" y="{6 + 5 * i}">{kind}</text>') for i, (kind, (colour, size)) in enumerate(NODE_STYLES.items())]
    return spark.createDataFrame(rows, "part int, at string, element string")


def annotate(drawing: str, elements: list[str]) -> str:
    """A drawing with the elements in a layer at its end; a layer of an earlier call is taken out."""
    import re

    plain = re.sub(r'(?s)<g id="network-layer">.*?</g>', "", drawing)
    return re.sub(r"</svg>\s*$", lambda m: f'<g id="network-layer">{"".join(elements)}</g></svg>', plain)


def route_report(best: DataFrame, weighted: DataFrame, second: DataFrame) -> DataFrame:
    """Text of a route, of the one preferring thick lines and of the second best."""
    line = lambda df, title: df.select(F.when(F.col("exists"), F.format_string(title + ": %s (%.2f, weighted %.2f)", F.array_join("path", " -> "), "distance", "weighted_distance")).otherwise(F.lit(title + ": no path")).alias("line"))
    return line(best, "Shortest").unionByName(line(weighted, "Weighted")).unionByName(line(second, "Second"))


def neighbours(edges: DataFrame, node: str) -> DataFrame:
    return adjacency(edges).where(F.col("src") == node).select(F.col("dst").alias("neighbour"), "length", "weight")
