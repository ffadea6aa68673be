"""Affine transforms (a, b, c, d, e, f) as structs, parsed, composed and applied."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FIELDS = ("a", "b", "c", "d", "e", "f")


def matrix(*values: Column | float) -> Column:
    return F.struct(*[(v if isinstance(v, Column) else F.lit(float(v))).cast("double").alias(n) for n, v in zip(FIELDS, values, strict=True)])


IDENTITY = (1.0, 0.0, 0.0, 1.0, 0.0, 0.0)


def compose(outer: Column, inner: Column) -> Column:
    """The transform that applies ``inner`` first."""
    o, i = outer, inner
    return matrix(
        o["a"] * i["a"] + o["c"] * i["b"],
        o["b"] * i["a"] + o["d"] * i["b"],
        o["a"] * i["c"] + o["c"] * i["d"],
        o["b"] * i["c"] + o["d"] * i["d"],
        o["a"] * i["e"] + o["c"] * i["f"] + o["e"],
        o["b"] * i["e"] + o["d"] * i["f"] + o["f"],
    )


def compose_all(matrices: Column) -> Column:
    """Product of an array of matrices, the outermost first."""
    return F.aggregate(matrices, matrix(*IDENTITY), compose)


def apply_x(m: Column, x: Column, y: Column) -> Column:
    return m["a"] * x + m["c"] * y + m["e"]


def apply_y(m: Column, x: Column, y: Column) -> Column:
    return m["b"] * x + m["d"] * y + m["f"]


def _one(name: Column, text: Column, strict: bool) -> Column:
    """Matrix of one function call; null where the name or its arguments aren't understood."""
    raw = F.filter(F.split(F.trim(text), r"[\s,]+"), lambda x: x != "")
    n = F.transform(raw, lambda x: x.try_cast("double"))
    arg = lambda i, default=None: F.coalesce(F.get(n, F.lit(i)), F.lit(default).cast("double")) if default is not None else F.get(n, F.lit(i))
    count = F.size(n)
    good = ~F.exists(n, lambda x: x.isNull()) & (count > 0)
    turn = F.radians(arg(0))
    cos, sin = F.cos(turn), F.sin(turn)
    cx, cy = arg(1, 0.0), arg(2, 0.0)
    centred = count >= 3
    rotation = F.when(centred, matrix(cos, sin, -sin, cos, cx - cos * cx + sin * cy, cy - sin * cx - cos * cy)).otherwise(matrix(cos, sin, -sin, cos, 0.0, 0.0))
    enough = count == 6 if strict else count >= 6
    out = (
        F.when(name == "translate", matrix(1.0, 0.0, 0.0, 1.0, arg(0), arg(1, 0.0)))
        .when(name == "scale", matrix(arg(0), 0.0, 0.0, F.coalesce(arg(1), arg(0)), 0.0, 0.0))
        .when(name == "rotate", rotation)
        .when((name == "matrix") & enough, matrix(*[arg(i) for i in range(6)]))
    )
    if strict:
        out = out.when(name == "skewX", matrix(1.0, 0.0, F.tan(turn), 1.0, 0.0, 0.0)).when(name == "skewY", matrix(1.0, F.tan(turn), 0.0, 1.0, 0.0, 0.0))
        unreadable = F.concat(F.lit("transform with no number: "), name, F.lit("("), text, F.lit(")"))
        return F.when(F.exists(n, lambda x: x.isNull()), F.raise_error(unreadable)).otherwise(F.when(good, out))
    return F.when(good, out)


def parse_transform(text: Column, strict: bool = False) -> Column:
    """Matrix of a transform attribute; calls that aren't understood count as none.

    ``strict`` is the form for tile frames: skews are known, ``matrix`` needs exactly
    six numbers, no blank may stand before a bracket, and an argument that isn't a
    number is an error.
    """
    form = r"([A-Za-z]+)\(([^)]*)\)" if strict else r"([A-Za-z]+)\s*\(([^)]*)\)"
    text = F.coalesce(text, F.lit(""))
    calls = F.arrays_zip(F.regexp_extract_all(text, F.lit(form), 1).alias("name"), F.regexp_extract_all(text, F.lit(form), 2).alias("args"))
    return compose_all(F.array_compact(F.transform(calls, lambda c: _one(c["name"], c["args"], strict))))
