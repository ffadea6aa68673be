"""SVG path data: points as drawn, and points at parameters of a path."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMMAND = re.compile(r"([MmLlHhVvCcSsQqTtAaZz])")
ARITY = {"M": 2, "L": 2, "H": 1, "V": 1, "C": 6}
FRAME_POINTS = 65_536  # points in a frame of samples, one path's at least


def _number(token: str) -> float | None:
    try:
        return float(token)
    except ValueError:
        return None


def _runs(d: str) -> Iterator[tuple[str, list[str]]]:
    """Each command letter with the tokens that follow it."""
    parts = COMMAND.split(d.replace(",", " "))
    for letter, rest in zip(parts[1::2], parts[2::2], strict=True):
        yield letter, rest.split()


def segments(d: str) -> list[np.ndarray]:
    """Lines (2 points) and cubics (4 points) of a path's M, L, H, V and C commands, each an array of complex numbers.

    A pair after M is another move.  Numbers that can't be read are skipped, a
    command with too few numbers left does nothing, and Z leaves the pen where it is.
    A move is a segment of one point.
    """
    pen, out = 0j, []
    for letter, tokens in _runs(d):
        kind, relative = letter.upper(), letter.islower()
        if kind not in ARITY:
            continue
        numbers = [n for n in map(_number, tokens) if n is not None]
        size = ARITY[kind]
        for at in range(0, len(numbers) - size + 1, size):
            v = numbers[at : at + size]
            if kind == "H":
                goal = [complex(v[0] + (pen.real if relative else 0), pen.imag)]
            elif kind == "V":
                goal = [complex(pen.real, v[0] + (pen.imag if relative else 0))]
            else:
                goal = [complex(a, b) + (pen if relative else 0) for a, b in zip(v[::2], v[1::2], strict=True)]
            out.append(np.array(goal if kind == "M" else [pen, *goal]))
            pen = goal[-1]
    return out


def _cubic(points: np.ndarray, t: np.ndarray) -> np.ndarray:
    basis = np.stack([(1 - t) ** 3, 3 * (1 - t) ** 2 * t, 3 * (1 - t) * t**2, t**3])
    return points @ basis


def drawn_points(d: str, samples: int = 20) -> list[tuple[float, float]]:
    """Ends of moves and lines and ``samples`` points of every cubic, its start among them."""
    out: list[complex] = []
    for s in segments(d or ""):
        out += list(_cubic(s, np.linspace(0, 1, samples))) if len(s) == 4 else [s[-1]]
    return [(float(p.real), float(p.imag)) for p in out]


def path_points(d: Column, samples: int = 20) -> Column:
    """Points of path data as an array of structs of x and y."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def points(texts: pd.Series) -> pd.Series:
        return texts.map(lambda s: [{"x": x, "y": y} for x, y in drawn_points(s or "", samples)])

    return points(d)


class Curve:
    """A path by arc length: ``point(t)`` for t from 0 to 1, each segment having its share of the length."""

    FINE = 1000  # pieces of a cubic for its length

    def __init__(self, d: str):
        self.parts = [s for s in segments(d) if len(s) > 1]
        self.lengths = np.array([self._length(s) for s in self.parts])
        self.total = float(self.lengths.sum())
        self.upto = np.append(0.0, np.cumsum(self.lengths))

    def _length(self, s: np.ndarray) -> float:
        if len(s) == 2:
            return float(abs(s[1] - s[0]))
        return float(np.abs(np.diff(_cubic(s, np.linspace(0, 1, self.FINE + 1)))).sum())

    def points(self, t: np.ndarray) -> np.ndarray:
        if not self.parts or self.total == 0:
            return np.full(len(t), self.parts[0][0] if self.parts else 0j)
        goal = np.clip(t, 0, 1) * self.total
        which = np.minimum(np.searchsorted(self.upto, goal, side="right") - 1, len(self.parts) - 1)
        out = np.empty(len(t), dtype=complex)
        for k in np.unique(which):
            own = which == k
            share = np.clip((goal[own] - self.upto[k]) / self.lengths[k], 0, 1) if self.lengths[k] else np.zeros(own.sum())
            s = self.parts[k]
            out[own] = s[0] + (s[1] - s[0]) * share if len(s) == 2 else _cubic(s, share)
        return out

    def length(self, t0: float = 0.0, t1: float = 1.0, samples: int = 100) -> float:
        """Whole length, or of a part as chords between ``samples`` points."""
        if t0 <= 0 and t1 >= 1:
            return self.total
        return float(np.abs(np.diff(self.points(np.linspace(t0, t1, samples)))).sum())


def sample_paths(paths: DataFrame, samples: int) -> DataFrame:
    """``samples`` points of every path: its columns but ``d``, and ``k``, ``t``, ``x``, ``y``.

    Frames hold many paths' points, since a frame costs far more than the points of one
    path, and equal paths of a frame are worked out once.  Path data is short and its points
    are not, so paths are dealt out to all cores, however few files they came from.
    """
    kept = [c for c in paths.columns if c != "d"]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in paths.schema if f.name != "d") + ", k int, t double, x double, y double"

    t, step = np.linspace(0, 1, samples), max(1, FRAME_POINTS // samples)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), step):
                part = batch.iloc[at : at + step]
                which, texts = pd.factorize(part["d"].fillna(""))
                p = np.stack([Curve(d).points(t) for d in texts])[which].ravel()
                out = part[kept].take(np.repeat(np.arange(len(part)), samples)).reset_index(drop=True)
                yield out.assign(k=np.tile(np.arange(samples, dtype=np.int32), len(part)), t=np.tile(t, len(part)), x=p.real, y=p.imag)

    return paths.repartition(paths.sparkSession.sparkContext.defaultParallelism).mapInPandas(run, schema)
