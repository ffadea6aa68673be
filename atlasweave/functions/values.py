"""Numbers, blanks, classes and style attributes as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(text: Column) -> Column:
    """Null, empty or only white space."""
    return F.trim(F.coalesce(text, F.lit(""))) == ""


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def trimmed_or_null(text: Column) -> Column:
    return F.nullif(F.trim(text), F.lit(""))


def safe_int(text: Column) -> Column:
    """Whole number as Python reads it: blanks around, a sign, single underscores between digits; else null."""
    ok = text.rlike(r"^\s*[+-]?[0-9]+(_[0-9]+)*\s*$")
    return F.when(ok, F.regexp_replace(F.trim(text), r"[_\s]", "").try_cast("bigint"))


def population(text: Column) -> Column:
    """``safe_int`` with blank as 0."""
    return F.when(blank(text), F.lit(0).cast("bigint")).otherwise(safe_int(text))


# The largest population of each size class but the last.
SIZE_LIMITS = (300, 900, 3000, 15000, 49999)


def size_category(people: Column) -> Column:
    """1 (village) to 6 (metropolis); null stays null."""
    out = F.when(people.isNull(), F.lit(None))
    for i, limit in enumerate(SIZE_LIMITS):
        out = out.when(people <= limit, i + 1)
    return out.otherwise(len(SIZE_LIMITS) + 1).cast("int")


def drawn_population(key: Column, mean: float = 5.0, sigma: float = 0.8, most: int = 800, instead: int = 782) -> Column:
    """Log-normal population that depends on ``key`` alone, so a plan may run again.

    Two hashes of the key give a normal deviate by the Box-Muller formula.
    """
    unit = lambda salt: (F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(1 << 30)) + 0.5) / float(1 << 30)
    normal = F.sqrt(-2 * F.log(unit("r"))) * F.cos(2 * 3.141592653589793 * unit("a"))
    drawn = F.floor(F.exp(F.lit(mean) + F.lit(sigma) * normal)).cast("int")
    return F.when(drawn > most, instead).otherwise(drawn)


def number_or_null(text: Column) -> Column:
    return F.trim(text).try_cast("double")


def stroke_width(style: Column, default: float = 2.05) -> Column:
    """Width of a style's first stroke-width part that is a number, units taken off."""
    parts = F.filter(F.split(F.coalesce(style, F.lit("")), ";"), lambda p: p.contains("stroke-width:"))
    values = F.transform(parts, lambda p: F.trim(F.regexp_replace(F.element_at(F.split(p, ":"), 2), "px|mm|pt", "")).try_cast("double"))
    return F.coalesce(F.get(F.filter(values, lambda v: v.isNotNull()), F.lit(0)), F.lit(default))


# CSS pixels in one unit of length.
PIXELS = {"in": 96.0, "mm": 96.0 / 25.4, "cm": 96.0 / 2.54, "pt": 96.0 / 72.0, "px": 1.0, "": 1.0}


def length_px(text: Column) -> Column:
    """CSS length in pixels; null where it isn't one."""
    form = r"^\s*([+-]?[0-9]*\.?[0-9]+(?:[eE][+-]?[0-9]+)?)\s*([a-z]*)\s*$"
    number, unit = F.regexp_extract(text, form, 1).try_cast("double"), F.regexp_extract(text, form, 2)
    factor = F.lit(None).cast("double")
    for name, pixels in PIXELS.items():
        factor = F.when(unit == name, pixels).otherwise(factor)
    return number * factor


def with_display(style: Column, value: str) -> Column:
    """Style with its display parts set to ``value``, or with one put first."""
    parts = F.filter(F.transform(F.split(F.coalesce(style, F.lit("")), ";"), lambda p: F.trim(p)), lambda p: p != "")
    is_display = lambda p: F.lower(p).startswith("display")
    new = F.lit(f"display:{value}")
    changed = F.transform(parts, lambda p: F.when(is_display(p), new).otherwise(p))
    return F.array_join(F.when(F.exists(parts, is_display), changed).otherwise(F.concat(F.array(new), parts)), ";")


def mobile_portrait(width: Column, height: Column) -> Column:
    return (width <= 768) & (height > width)
