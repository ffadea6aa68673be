"""History of datasets: the latest snapshot, what changed, what to deploy."""

from __future__ import annotations

import csv
import io
import shutil
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest(rows: DataFrame, keys: list[str], taken: str = "taken") -> DataFrame:
    """Rows of each series' newest snapshot."""
    newest = rows.groupBy(*keys).agg(F.max(taken).alias(taken))
    return rows.join(newest, [*keys, taken], "left_semi")


def consecutive(rows: DataFrame, series: str = "series", taken: str = "taken") -> DataFrame:
    """Each snapshot of a series with the one before it."""
    return rows.select(series, taken).distinct().withColumn("before", F.lag(taken).over(Window.partitionBy(series).orderBy(taken)))


def difference(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Keys of either with ``change``: added, removed, changed or same, and the columns that changed.

    Both sides are tagged and grouped once; keys are unique on either side.
    """
    tagged = old.select(*keys, F.struct(*columns).alias("o"), F.lit(None).cast(new.select(F.struct(*columns).alias("n")).schema["n"].dataType).alias("n"))
    tagged = tagged.unionByName(new.select(*keys, F.lit(None).cast(old.select(F.struct(*columns).alias("o")).schema["o"].dataType).alias("o"), F.struct(*columns).alias("n")))
    both = tagged.groupBy(*keys).agg(F.first("o", ignorenulls=True).alias("o"), F.first("n", ignorenulls=True).alias("n"))
    names = F.array_compact(F.array(*[F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in columns]))
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(F.size("names") > 0, "changed").otherwise("same")
    return both.withColumn("names", names).select(*keys, change.alias("change"), F.when(change == "changed", F.array_join("names", ",")).alias("columns"))


def emptied(old: DataFrame, new: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Keys whose value was given and now is blank."""
    o = old.where(F.trim(F.coalesce(F.col(column), F.lit(""))) != "").select(*keys)
    return new.where(F.trim(F.coalesce(F.col(column), F.lit(""))) == "").select(*keys).join(o, keys, "left_semi")


def fill_descriptions(rows: DataFrame, articles: DataFrame, key: str, url: str, description: str) -> DataFrame:
    """``rows`` with missing descriptions filled from ``articles`` (``key``, ``html``); only rows with a url and none are worked on."""
    from ..functions.articles import description as of
    from .reconcile import needs_description

    need = needs_description(F.col(url), F.col(description))
    todo = rows.where(need).select(key).distinct()
    made = articles.join(todo, key, "left_semi").select(key, of(F.col("html")).alias("_made"))
    out = rows.join(made, key, "left")
    return out.select(*[F.when(need, F.coalesce("_made", F.col(c))).otherwise(F.col(c)).alias(c) if c == description else F.col(c) for c in rows.columns])


def deploy(sources: dict[str, Path], target: Path, names: list[str] | None = None, dry_run: bool = False) -> dict[str, str]:
    """Copy files by stem after a time-stamped backup of what is there; status by name."""
    done = {}
    for name in sorted(names or sources):
        if name not in sources or not sources[name].exists():
            done[name] = "missing"
            continue
        to = target / sources[name].name
        if not dry_run:
            if to.exists():
                shutil.copy2(to, to.with_name(f"{to.stem}_{datetime.now():%Y%m%d_%H%M%S}{to.suffix}"))
            target.mkdir(parents=True, exist_ok=True)
            shutil.copy2(sources[name], to)
        done[name] = "would deploy" if dry_run else "deployed"
    return done


def sync(landing: Path, target: Path, sheets: dict[str, str], dry_run: bool = False, validate: bool = False) -> dict[str, str]:
    """Take landed sheets (``<name>.csv``, flavours by name) over into ``target``; what was done with each.

    Headers and rows are checked until all sheets have passed once, and whenever
    ``validate`` says so.  A sheet is backed up with a time stamp and then replaced in
    one move; one that is missing, unreadable or fails its checks leaves its target.
    """
    from ..sources.gazetteers import header_errors

    first = not (target / ".validated").exists()
    done, errors = {}, {}
    for name, flavour in sheets.items():
        try:
            with open(landing / f"{name}.csv", encoding="utf-8", newline="") as file:
                text = file.read()
            rows = list(csv.reader(io.StringIO(text)))
        except (OSError, UnicodeDecodeError, csv.Error) as e:
            done[name], errors[name] = "not read", [str(e)]
            continue
        errors[name] = header_errors(rows[0] if rows else [], flavour, len(rows) - 1) if first or validate else []
        if errors[name]:
            done[name] = "invalid: " + "; ".join(errors[name])
        elif dry_run:
            done[name] = "would sync"
        else:
            target.mkdir(parents=True, exist_ok=True)
            to = target / f"{name}.csv"
            if to.exists():
                (target / "backups").mkdir(exist_ok=True)
                shutil.copy2(to, target / "backups" / f"{name}_{datetime.now():%Y%m%d_%H%M%S}.csv")
            part = target / f".{name}.part"
            part.write_text(text.replace("\r\n", "\n").replace("\r", "\n"), encoding="utf-8", newline="")
            part.replace(to)
            done[name] = "synced"
    if first and not dry_run:
        mark_validated(target, errors)
    return done


def mark_validated(folder: Path, results: dict[str, list[str]]) -> bool:
    """Leave a marker only when every dataset passed its checks."""
    passed = bool(results) and not any(results.values())
    if passed:
        (folder / ".validated").write_text(datetime.now().isoformat())
    return passed
