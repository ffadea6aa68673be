"""Networks of curves and routes over them."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import edge_weight
from ..functions.paths import Curve, sample_paths
from ..functions.values import stroke_width
from .lineage import cut
from .spatial import distance_join, nearest, thin

EDGE_COLUMNS = ["node1_id", "node2_id", "length", "weight"]


def adjacency(edges: DataFrame) -> DataFrame:
    """Both directions of every edge: ``src``, ``dst`` and its other columns; a self-loop comes twice."""
    rest = [c for c in edges.columns if c not in ("node1_id", "node2_id")]
    there = edges.select(F.col("node1_id").alias("src"), F.col("node2_id").alias("dst"), *rest)
    return there.unionByName(edges.select(F.col("node2_id").alias("src"), F.col("node1_id").alias("dst"), *rest))


def other_end(node: Column) -> Column:
    """The edge's other end; its first one for a node that isn't an end."""
    return F.when(node == F.col("node1_id"), F.col("node2_id")).otherwise(F.col("node1_id"))


def degrees(edges: DataFrame) -> DataFrame:
    return adjacency(edges).groupBy(F.col("src").alias("node")).agg(F.count("*").alias("degree"), F.sort_array(F.collect_set("dst")).alias("neighbours"))


def shortest_from(edges: DataFrame, starts: DataFrame, cost: str = "length", every: int = 4, max_rounds: int = 10_000) -> DataFrame:
    """Cheapest routes from each start (``run``, ``node``) to all nodes it reaches.

    ``run`` tells searches apart; with a column ``cut_a``/``cut_b`` in ``starts`` the
    run's routes avoid all edges between those two nodes.  Result: ``run``, ``node``,
    ``cost``, ``length``, ``weight``, ``path``.  Each round extends only what got
    cheaper in the last one; of equal costs the first path by name stays.
    """
    both = adjacency(edges.select(*EDGE_COLUMNS)).where("src <> dst")
    both = both.groupBy("src", "dst").agg(F.min(F.struct(F.col(cost).alias("c"), "length", "weight")).alias("e")).select("src", "dst", F.col("e.c").alias("step"), "e.length", "e.weight")
    cuts = [c for c in ("cut_a", "cut_b") if c in starts.columns]
    zero = F.lit(0.0)
    known = starts.select("run", *cuts, "node", zero.alias("cost"), zero.alias("length"), zero.alias("weight"), F.array("node").alias("path"))
    front = known
    for n in range(max_rounds):
        f = front.select("run", *cuts, F.col("node").alias("src"), F.col("cost").alias("_c"), F.col("length").alias("_l"), F.col("weight").alias("_w"), F.col("path").alias("_p"))
        reach = f.join(both, "src").where(~F.array_contains("_p", F.col("dst")))
        if cuts:
            reach = reach.where(~((F.least("src", "dst") == F.least("cut_a", "cut_b")) & (F.greatest("src", "dst") == F.greatest("cut_a", "cut_b"))))
        found = reach.select("run", *cuts, F.col("dst").alias("node"), (F.col("_c") + F.col("step")).alias("cost"), (F.col("_l") + F.col("length")).alias("length"), (F.col("_w") + F.col("weight")).alias("weight"), F.concat("_p", F.array("dst")).alias("path"))
        best = found.groupBy("run", *cuts, "node").agg(F.min(F.struct("cost", "path", "length", "weight")).alias("b")).select("run", *cuts, "node", "b.*")
        old = known.select("run", "node", F.col("cost").alias("had"))
        fresh = best.join(old, ["run", "node"], "left").where("had is null or cost < had").drop("had").select(*known.columns)
        fresh = cut(fresh)
        if fresh.isEmpty():
            return known.drop(*cuts)
        kept = known.join(fresh.select("run", "node"), ["run", "node"], "left_anti")
        known = kept.unionByName(fresh)
        if n % every == every - 1:
            known = cut(known)
        front = fresh
    raise RuntimeError("no end of cheaper routes: a cost below 0?")


def find_paths(edges: DataFrame, requests: DataFrame, weighted: bool = False) -> DataFrame:
    """One row per request (``start``, ``end``): with ``path``, ``distance``, ``weighted_distance``, ``exists``.

    All starts are searched for at once, each once.  A request whose end no edge
    touches, or that can't be reached, has an empty path and doesn't exist.
    """
    starts = requests.select(F.col("start").alias("run"), F.col("start").alias("node")).where("node is not null").distinct()
    got = shortest_from(edges, starts, "weight" if weighted else "length")
    known = adjacency(edges.select(*EDGE_COLUMNS)).select(F.col("src").alias("end")).distinct()
    hit = got.select(F.col("run").alias("start"), F.col("node").alias("end"), "path", F.col("length").alias("distance"), F.col("weight").alias("weighted_distance")).join(known, "end", "left_semi")
    more = [c for c in requests.columns if c not in ("start", "end")]
    out = requests.join(hit, ["start", "end"], "left")
    return out.select(*more, "start", "end", F.coalesce("path", F.array().cast("array<string>")).alias("path"), "distance", "weighted_distance", F.col("path").isNotNull().alias("exists"))


def find_path(edges: DataFrame, start: str, end: str, weighted: bool = False) -> DataFrame:
    """``find_paths`` of one request."""
    return find_paths(edges, edges.sparkSession.createDataFrame([(start, end)], "start string, end string"), weighted)


def k_shortest(edges: DataFrame, start: str, end: str, k: int = 2, weighted: bool = False) -> DataFrame:
    """The best route and those found when one of its steps is taken out, distinct, the cheapest ``k``.

    All exclusions run together as one search, told apart by ``run``.  This follows
    the simple rule that only the best route is branched from, not Yen's algorithm.
    """
    cost = "weight" if weighted else "length"
    best = find_path(edges, start, end, weighted).where("exists")
    steps = best.select(F.posexplode(F.expr("transform(sequence(1, greatest(size(path) - 1, 1)), i -> struct(element_at(path, i) as a, try_element_at(path, i + 1) as b))")).alias("i", "s")).where("s.b is not null")
    starts = steps.select(F.format_string("without %d", "i").alias("run"), F.lit(start).alias("node"), F.col("s.a").alias("cut_a"), F.col("s.b").alias("cut_b"))
    others = shortest_from(edges, cut(starts), cost).where(F.col("node") == end).select("path", "length", "weight")
    first = best.select("path", F.col("distance").alias("length"), F.col("weighted_distance").alias("weight"))
    routes = first.unionByName(others).groupBy("path").agg(F.min("length").alias("length"), F.min("weight").alias("weight"))
    return routes.orderBy(cost, "path").limit(k)


def locations(nodes: DataFrame) -> DataFrame:
    return nodes.where("node_type = 'location'").select("id").orderBy("id")


def is_location(nodes: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (``name``) with ``valid``: a location has that name, letters of either case."""
    known = nodes.where("node_type = 'location'").select(F.upper("id").alias("_k"), F.col("id").alias("node"))
    return requests.join(known, F.upper(F.trim("name")) == F.col("_k"), "left").select(*requests.columns, "node", F.col("node").isNotNull().alias("valid"))


def checked_requests(nodes: DataFrame, requests: DataFrame) -> DataFrame:
    """Requests (``start``, ``end``) in trimmed upper case, with ``status``: ok, same, unknown start or unknown end."""
    known = nodes.where("node_type = 'location'").select(F.upper("id").alias("_k")).distinct()
    clean = lambda c: F.upper(F.trim(F.coalesce(F.col(c), F.lit("")))).alias(c)
    asked = requests.select(*[clean(c) if c in ("start", "end") else F.col(c) for c in requests.columns])
    for c in ("start", "end"):
        asked = asked.join(known.withColumnRenamed("_k", c).withColumn(f"_{c}", F.lit(True)), c, "left")
    status = F.when(F.col("_start").isNull(), "unknown start").when(F.col("_end").isNull(), "unknown end").when(F.col("start") == F.col("end"), "same").otherwise("ok")
    return asked.withColumn("status", status).select(*requests.columns, "status")


def snap(places: DataFrame, paths: DataFrame, within: float = 10.0, samples: int = 1000) -> DataFrame:
    """Each drawing's locations at the nearest sampled point of a path, earliest path and parameter on ties: ``doc``, ``name``, ``path_id``, ``t``, ``x``, ``y``."""
    points = sample_paths(paths.select("doc", "path_id", "path_ord", "d"), samples).select("doc", "path_id", "path_ord", "t", F.col("x").alias("bx"), F.col("y").alias("by"))
    spots = places.select("doc", "name", F.col("x").alias("ax"), F.col("y").alias("ay"))
    got = nearest(spots, points, "name", within * (1 + 1e-12) + 1e-12, ["path_id", "bx", "by"], ["path_ord", "t"], on=("doc",))
    return got.select("doc", "name", "path_id", "t", F.col("bx").alias("x"), F.col("by").alias("y"))


def intersections(paths: DataFrame, tolerance: float = 2.0, separation: float = 10.0, samples: int = 300) -> DataFrame:
    """Places where two paths of a drawing come nearer than ``tolerance``, thinned to one per ``separation``: ``doc``, ``n`` from 1, ``x``, ``y``.

    Pairs are thinned each by itself in parallel; what is left, a few points per
    pair, is then thinned once for each drawing in order of the pairs.
    """
    points = sample_paths(paths.select("doc", "path_ord", "d"), samples)
    a = points.select("doc", F.col("path_ord").alias("p1"), F.col("t").alias("t1"), F.col("x").alias("ax"), F.col("y").alias("ay"))
    b = points.select("doc", F.col("path_ord").alias("p2"), F.col("t").alias("t2"), F.col("x").alias("bx"), F.col("y").alias("by"))
    met = distance_join(a, b, tolerance, on=("doc",)).where("p1 < p2").select("doc", "p1", "p2", "t1", "t2", F.col("ax").alias("x"), F.col("ay").alias("y"), "dist")
    kept = thin(thin(met, ["doc", "p1", "p2"], separation, ["dist", "t1", "t2"]), ["doc"], separation, ["p1", "p2", "dist", "t1", "t2"])
    number = F.row_number().over(Window.partitionBy("doc").orderBy("p1", "p2", "dist", "t1", "t2"))
    return kept.select("doc", number.alias("n"), "x", "y")


def build_nodes(crossings: DataFrame, snapped: DataFrame, paths: DataFrame, tolerance: float = 2.0, strict: bool = False) -> DataFrame:
    """Nodes ``doc``, ``id``, ``x``, ``y``, ``node_type``, ``ord`` of each drawing: crossings, then locations, then loose ends of paths.

    A location within ``tolerance`` of a node takes that node over; with ``strict``
    only of one that isn't a location.  Which node is met first depends on all before,
    so a drawing's nodes are one sequential pass; a grid finds the near ones.
    """
    ends = sample_paths(paths.select("doc", "path_id", "path_ord", "d"), 2).select("doc", F.lit(2).alias("stage"), (F.col("path_ord") * 2 + F.col("k")).cast("long").alias("at"), F.format_string("EP_%s_%d", "path_id", "k").alias("id"), "x", "y")
    given = crossings.select("doc", F.lit(0).alias("stage"), F.col("n").cast("long").alias("at"), F.format_string("INT%d", "n").alias("id"), "x", "y")
    spots = snapped.select("doc", F.lit(1).alias("stage"), F.lit(0).cast("long").alias("at"), F.col("name").alias("id"), "x", "y")
    rows = given.unionByName(spots).unionByName(ends)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        nodes: dict[int, tuple] = {}  # by turn
        cells: dict[tuple[int, int], set[int]] = {}
        cell = lambda x, y: (int(x // tolerance), int(y // tolerance))
        for turn, r in enumerate(frame.sort_values(["stage", "at", "id"]).itertuples(index=False)):
            i, j = cell(r.x, r.y)
            near = [n for a in (-1, 0, 1) for b in (-1, 0, 1) for n in cells.get((i + a, j + b), ())]
            near = [n for n in near if (nodes[n][2] - r.x) ** 2 + (nodes[n][3] - r.y) ** 2 < tolerance**2 and not (strict and r.stage == 1 and nodes[n][4] == "location")]
            x, y = r.x, r.y
            if near and r.stage == 2:
                continue
            if near and r.stage == 1:
                _, _, x, y, _ = nodes.pop(min(near))
                cells[cell(x, y)].remove(min(near))
            nodes[turn] = (r.doc, r.id, x, y, ("intersection", "location", "endpoint")[r.stage])
            cells.setdefault(cell(x, y), set()).add(turn)
        return pd.DataFrame([[*n, i] for i, n in enumerate(nodes.values())], columns=["doc", "id", "x", "y", "node_type", "ord"])

    return rows.groupBy("doc").applyInPandas(run, "doc string, id string, x double, y double, node_type string, ord long")


def consecutive(rows: DataFrame, keys: list[str], order: list[str], value: Column) -> DataFrame:
    """Of each key the value of every row but the last (``a``) with the next one's (``b``)."""
    steps = rows.select(*keys, value.alias("a"), F.lead(value).over(Window.partitionBy(*keys).orderBy(*order)).alias("b"))
    return steps.where("b is not null")


def build_edges(nodes: DataFrame, paths: DataFrame, tolerance: float = 2.0, samples: int = 1000) -> DataFrame:
    """Edges between consecutive nodes of each path; a node lies where the path first comes near it."""
    points = sample_paths(paths.select("doc", "path_id", "path_ord", "d"), samples).select("doc", "path_id", "t", F.col("x").alias("bx"), F.col("y").alias("by"))
    spots = nodes.select("doc", "id", "ord", F.col("x").alias("ax"), F.col("y").alias("ay"))
    on = distance_join(spots, points, tolerance, on=("doc",)).groupBy("doc", "path_id", "id", "ord").agg(F.min("t").alias("t"))
    steps = consecutive(on, ["doc", "path_id"], ["t", "ord", "id"], F.struct("id", "t"))
    drawn = steps.join(paths.select("doc", "path_id", "d", stroke_width(F.col("style")).alias("stroke")), ["doc", "path_id"])

    @F.pandas_udf("double")
    def part(d: pd.Series, t0: pd.Series, t1: pd.Series) -> pd.Series:
        curves = {x: Curve(x) for x in set(d)}
        return pd.Series([curves[x].length(a, b) for x, a, b in zip(d, t0, t1, strict=True)])

    length = part(F.col("d"), F.col("a.t"), F.col("b.t"))
    out = drawn.select("doc", F.col("a.id").alias("node1_id"), F.col("b.id").alias("node2_id"), "path_id", F.col("a.t").alias("t_start"), F.col("b.t").alias("t_end"), length.alias("length"), "stroke")
    return out.withColumn("weight", edge_weight(F.col("length"), F.col("stroke"))).drop("stroke")


def build_network(paths: DataFrame, places: DataFrame, tolerance: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of the network that each drawing's paths and locations make; without column ``doc`` all are one drawing's."""
    whole = "doc" not in paths.columns
    if whole:
        paths, places = paths.withColumn("doc", F.lit("")), places.withColumn("doc", F.lit(""))
    nodes = cut(build_nodes(intersections(paths, tolerance), snap(places, paths), paths, tolerance))
    edges = cut(build_edges(nodes, paths, tolerance))
    return (nodes.drop("doc"), edges.drop("doc")) if whole else (nodes, edges)
