"""Distance joins over a grid, nearest points and greedy thinning."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import distance
from . import lineage


def _cell(c: str, size: float) -> Column:
    return F.floor(F.col(c) / F.lit(size)).cast("long")


def distance_join(a: DataFrame, b: DataFrame, within: float, ax: str = "ax", ay: str = "ay", bx: str = "bx", by: str = "by", on: tuple[str, ...] = ()) -> DataFrame:
    """Pairs nearer than ``within``, with ``dist``; of equal ``on`` columns only.

    Cells of that size: a's row meets the nine cells around its own by an equality
    join, so no pair of far rows is ever made.
    """
    near = F.explode(F.flatten(F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda i: F.transform(F.sequence(F.lit(-1), F.lit(1)), lambda j: F.struct((_cell(ax, within) + i).alias("i"), (_cell(ay, within) + j).alias("j"))))))
    left = a.withColumn("_c", near).withColumn("_i", F.col("_c.i")).withColumn("_j", F.col("_c.j")).drop("_c")
    right = b.withColumn("_i", _cell(bx, within)).withColumn("_j", _cell(by, within))
    met = left.join(right, ["_i", "_j", *on]).withColumn("dist", distance(F.col(ax), F.col(ay), F.col(bx), F.col(by)))
    return met.where(F.col("dist") < within).drop("_i", "_j")


def pairs_within(points: DataFrame, key: str, within: float, x: str = "x", y: str = "y", block: int = 2048) -> DataFrame:
    """Pairs of rows nearer than ``within``, each once: ``a`` < ``b``, their keys, and ``dist``.

    A row meets its own cell and four of the eight around it, as its other neighbours meet it.
    A cell of more than ``block`` rows is dealt out in parts of about that size, each met by all
    askers: the join keeps one part in memory, its sorts spill, and a full cell is the
    work of many tasks.  What is shuffled are five rows for each, and as many for each further
    part of a cell; what is returned grows with the square of a cell's rows.
    """
    size = within * 1.0001  # near rows stay in neighbouring cells when quotients are rounded
    cell = lambda c: F.floor(F.greatest(F.lit(-1e18), F.least(F.lit(1e18), F.col(c) / size)))
    rows = points.select(F.col(key).alias("_k"), F.col(x).cast("double").alias("_x"), F.col(y).cast("double").alias("_y"))
    rows = rows.where(F.col("_k").isNotNull() & (F.abs("_x") < float("inf")) & (F.abs("_y") < float("inf"))).withColumn("_i", cell("_x")).withColumn("_j", cell("_y"))
    # few cells are full: one for each ``block`` rows at most
    full = F.broadcast(rows.groupBy("_i", "_j").count().where(F.col("count") > block).select("_i", "_j", F.ceil(F.col("count") / block).cast("int").alias("_n")))
    parts = F.coalesce("_n", F.lit(1))
    # a number of tasks, as Spark would coalesce them by bytes while work goes by pairs
    spark = points.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    held = rows.join(full, ["_i", "_j"], "left").withColumn("_s", F.pmod(F.xxhash64("_k"), parts).cast("int")).drop("_n")
    around = F.array(*[F.struct((F.col("_i") + i).alias("i"), (F.col("_j") + j).alias("j"), F.lit(i == j == 0).alias("own")) for i, j in ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))])
    asks = rows.select(F.col("_k").alias("_l"), F.col("_x").alias("_u"), F.col("_y").alias("_v"), F.explode(around).alias("_c")).select("_l", "_u", "_v", F.col("_c.i").alias("_i"), F.col("_c.j").alias("_j"), F.col("_c.own").alias("_own"))
    asks = asks.join(full, ["_i", "_j"], "left").withColumn("_s", F.explode(F.sequence(F.lit(0), parts - 1))).drop("_n")
    at = ["_i", "_j", "_s"]
    met = asks.repartition(tasks, *at).join(held.repartition(tasks, *at).hint("merge"), at)
    dist = distance(F.col("_u"), F.col("_v"), F.col("_x"), F.col("_y"))
    once = F.when(F.col("_own"), F.col("_l") < F.col("_k")).otherwise(F.col("_l") != F.col("_k"))
    return met.where((dist < within) & once).select(F.least("_l", "_k").alias("a"), F.greatest("_l", "_k").alias("b"), dist.alias("dist"))


def nearest(a: DataFrame, b: DataFrame, a_id: str, within: float, carried: list[str], tie: list[str], on: tuple[str, ...] = (), levels: int = 0, **columns: str) -> DataFrame:
    """For each row of ``a`` the nearest row of ``b`` nearer than ``within``; ties by ``tie``.

    Without ``levels`` each row meets all rows of the nine cells around it, which suits
    few rows a cell.  With them, cells are divided by 4 along each axis so many times, and a
    search goes down only into cells that can hold the nearest row: work grows with
    the rows, not with their product, as long as the smallest cells hold few places.
    """
    fields = [*tie, *[c for c in carried if c not in tie]]
    if levels:
        met = _descended(a, b, within, fields, on, levels, **columns)
    else:
        met = distance_join(a, b, within, on=on, **columns)
    best = F.min(F.struct("dist", *fields)).alias("_b")
    return met.groupBy(*on, a_id).agg(best).select(*on, a_id, "_b.*")


def _descended(a: DataFrame, b: DataFrame, within: float, fields: list[str], on: tuple[str, ...], levels: int, ax: str = "ax", ay: str = "ay", bx: str = "bx", by: str = "by") -> DataFrame:
    """Rows of ``a`` with ``dist`` and ``fields`` of their nearest row of ``b``, found by branch and bound over a pyramid of cells."""
    size = [within / 4**k for k in range(levels + 1)]
    at = lambda c, k: F.floor(F.col(c) / F.lit(size[k])).cast("long")
    # rows of one place differ in their ties only
    places = b.select(*on, F.col(bx).alias("_px"), F.col(by).alias("_py"), F.struct(*fields).alias("_v")).groupBy(*on, "_px", "_py").agg(F.min("_v").alias("_v"))
    places = lineage.cut(places.where("not isnan(_px) and not isnan(_py)"))
    cells = [F.struct(F.lit(k).alias("k"), at("_px", k).alias("i"), at("_py", k).alias("j")) for k in range(levels + 1)]
    # a place stands for each cell
    pyramid = places.select(*on, "_px", "_py", F.explode(F.array(*cells)).alias("_c")).groupBy(*on, "_c.k", "_c.i", "_c.j").agg(F.min(F.struct("_px", "_py")).alias("_r"))
    pyramid = lineage.cut(pyramid)
    me = [*on, "_ax", "_ay"]
    asked = a.select(*on, F.col(ax).alias("_ax"), F.col(ay).alias("_ay")).where("not isnan(_ax) and not isnan(_ay)").distinct()
    far = distance(F.col("_ax"), F.col("_ay"), F.col("_r._px"), F.col("_r._py"))

    def around(k: int) -> Column:
        return F.array(*[F.struct(F.lit(k).alias("k"), (at("_ax", k) + i).alias("i"), (at("_ay", k) + j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])

    def reaches(k: int) -> Column:
        """Whether a cell may hold a place as near as the bound, with room for rounding."""
        gap = lambda p, c: F.greatest(F.col(c) * size[k] - F.col(p), F.col(p) - (F.col(c) + 1) * size[k], F.lit(0.0))
        dx, dy = gap("_ax", "i"), gap("_ay", "j")
        return F.sqrt(dx * dx + dy * dy) <= F.col("_u") * (1 + 1e-9) + (F.abs("_ax") + F.abs("_ay")) * 1e-12

    # a first bound from the places that stand for the cells around, of every size
    near = asked.select(*me, F.explode(F.concat(*[around(k) for k in range(levels + 1)])).alias("_c")).select(*me, "_c.*")
    bound = near.join(pyramid, [*on, "k", "i", "j"]).groupBy(*me).agg(F.least(F.min(far), F.lit(float(within))).alias("_u"))
    left = bound.select(*me, "_u", F.explode(around(0)).alias("_c")).select(*me, "_u", "_c.i", "_c.j").where(reaches(0))
    for k in range(1, levels + 1):
        below = pyramid.where(F.col("k") == k).select(*on, F.shiftright("i", 2).alias("_pi"), F.shiftright("j", 2).alias("_pj"), "i", "j", "_r")
        down = left.withColumnsRenamed({"i": "_pi", "j": "_pj"}).join(below, [*on, "_pi", "_pj"]).where(reaches(k))
        closer = F.least(F.col("_u"), F.min(far).over(Window.partitionBy(*me)))
        left = down.withColumn("_u", closer).where(reaches(k)).select(*me, "_u", "i", "j")
    held = places.withColumn("i", at("_px", levels)).withColumn("j", at("_py", levels))
    dist = distance(F.col("_ax"), F.col("_ay"), F.col("_px"), F.col("_py"))
    found = left.join(held, [*on, "i", "j"]).select(*me, dist.alias("dist"), "_v").where(F.col("dist") < within)
    found = found.groupBy(*me).agg(F.min(F.struct("dist", "_v")).alias("_b")).select(*[F.col(c).alias(f"_on_{c}") for c in on], "_ax", "_ay", "_b.dist", "_b._v.*")
    same = (F.col(ax) == F.col("_ax")) & (F.col(ay) == F.col("_ay"))
    for c in on:
        same = same & (F.col(c) == F.col(f"_on_{c}"))
    return a.select(*[c for c in a.columns if c not in fields and c != "dist"]).join(found, same)


def bounds(points: DataFrame, *group: str) -> DataFrame:
    """Box of each group's points (x, y)."""
    return points.groupBy(*group).agg(F.min("x").alias("x0"), F.min("y").alias("y0"), F.max("x").alias("x1"), F.max("y").alias("y1"))


def thin(points: DataFrame, group: list[str], separation: float, order: list[str]) -> DataFrame:
    """Greedy thinning: in ``order``, a point stays unless one that stayed is nearer than ``separation`` (columns x, y).

    Sequential within a group, hence a grouped map; a grid of cells of that size
    finds the neighbours, so a group costs as much as its points.
    """

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(order, kind="stable")
        cells: dict[tuple[int, int], list[tuple[float, float]]] = {}
        keep = np.zeros(len(frame), dtype=bool)
        for n, (x, y) in enumerate(zip(frame["x"], frame["y"], strict=True)):
            i, j = int(np.floor(x / separation)), int(np.floor(y / separation))
            close = any((x - u) ** 2 + (y - v) ** 2 < separation**2 for di in (-1, 0, 1) for dj in (-1, 0, 1) for u, v in cells.get((i + di, j + dj), ()))
            if not close:
                keep[n] = True
                cells.setdefault((i, j), []).append((x, y))
        return frame[keep]

    return points.groupBy(*group).applyInPandas(run, points.schema)
