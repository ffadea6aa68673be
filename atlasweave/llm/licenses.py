"""License scans: fuzzy search for short notices.

A notice that may have k edits is split into k + 1 pieces, of which every match
within k edits holds one unchanged.  One automaton finds all pieces, and the exact
base phrases, in a text's words joined by blanks; in the window around each piece the
regex library's bounded-error matching confirms the notice and counts its edits.
Windows are searched one by one, each once; where matches overlap, fewer edits win.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tokens

# Phrases whose exact places are counted, and their labels.
BASE_PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# Notices in words, and their labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("released under the mit license", "mit"),
    ("licensed under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("licensed under the gnu general public license version 3", "gpl"),
    ("licensed under the gnu general public license version 2", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd"),
    ("subject to the terms of the mozilla public license", "mpl"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd"),
    ("licensed under a creative commons attribution", "cc-by"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "reserved"),
)


@dataclass(frozen=True)
class Scan:
    notices: tuple[tuple[str, str], ...] = NOTICES
    base: tuple[tuple[str, str], ...] = BASE_PHRASES
    letters_per_edit: int = 12  # a notice may have one edit for so many of its characters
    most_edits: int = 6

    def __post_init__(self) -> None:
        if self.letters_per_edit < 5 or self.most_edits < 0:  # else a window could hold two matches
            raise ValueError(f"bad parameters: {self}")

    def edits(self, notice: str) -> int:
        return min(self.most_edits, len(notice) // self.letters_per_edit)


@dataclass
class Finder:
    """The automaton and the bounded-error patterns of a scan."""

    scan: Scan
    automaton: ahocorasick.Automaton = field(init=False)

    def __post_init__(self) -> None:
        entries: dict[str, list] = {}
        self.patterns = []
        for i, (phrase, _) in enumerate(self.scan.base):
            entries.setdefault(f" {phrase} ", []).append(("base", i, 0))
        for i, (notice, _) in enumerate(self.scan.notices):
            k, text = self.scan.edits(notice), f" {notice} "
            self.patterns.append(regex.compile(f"(?b)(?:{regex.escape(text, literal_spaces=True)}){{e<={k}}}"))
            cuts = [round(len(text) * j / (k + 1)) for j in range(k + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                entries.setdefault(text[a:b], []).append(("piece", i, a))
        self.automaton = ahocorasick.Automaton()
        for piece, what in entries.items():
            self.automaton.add_word(piece, (len(piece), what))
        self.automaton.make_automaton()

    def find(self, text: str) -> tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]:
        """Of words between blanks: base places (phrase, at) and matches (notice, at, end, edits)."""
        base, windows = [], set()
        for last, (length, what) in self.automaton.iter(text):
            start = last + 1 - length
            for kind, i, offset in what:
                if kind == "base":
                    base.append((i, start))
                    continue
                notice = self.scan.notices[i][0]
                k = self.scan.edits(notice)
                windows.add((i, max(0, start - offset - k), min(len(text), start - offset + len(notice) + 2 + k)))
        found = set()
        for i, lo, hi in windows:  # too short for two matches, so the best one is the seed's own or overlaps it
            m = self.patterns[i].search(text, lo, hi)
            if m:
                found.add((i, m.start(), m.end(), sum(m.fuzzy_counts)))
        return base, self._best(found)

    def _best(self, found: set) -> list[tuple[int, int, int, int]]:
        """Without matches that overlap one of fewer edits: notices differ by a word only."""
        fewer: list[tuple[int, int]] = []
        out: list[tuple[int, int, int, int]] = []
        for edits in sorted({m[3] for m in found}):
            level = sorted((m for m in found if m[3] == edits), key=lambda m: m[1])
            starts = [a for a, _ in fewer]
            free = []
            for m in level:
                at = bisect.bisect_left(starts, m[2] - 1)
                if at == 0 or fewer[at - 1][1] <= m[1] + 1:
                    free.append(m)
            out += free
            fewer = _merged([*fewer, *[(m[1], m[2]) for m in free]])
        return sorted(out, key=lambda m: (m[1], m[0]))


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


_MATCH = "label string, first_word long, last_word long, edits long"


def _joined(w: tokens.Words) -> tuple[str, np.ndarray, np.ndarray]:
    """The block's words with a blank before and after each, row after row; where rows and words begin."""
    lengths = w.end - w.start + 1
    at = np.append(0, np.cumsum(lengths)) + 1  # of each word, after the blank before it
    n_rows = len(w.first) - 1
    row = w.row
    out = np.full(int(at[-1]) + n_rows, 0x20, dtype=np.uint8)
    at = at[:-1] + row  # each row has one blank more, before its first word
    inside = np.repeat(at - w.start, lengths - 1) + _ranges(w.start, w.end)
    out[inside] = w.data[_ranges(w.start, w.end)]
    begin = np.append(0, np.cumsum(np.bincount(row, weights=lengths, minlength=n_rows).astype(np.int64) + 1))
    return out.tobytes().decode("latin-1"), begin, at


def _ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    n = end - start
    return np.arange(n.sum()) + np.repeat(start - np.append(0, np.cumsum(n))[:-1], n)


def with_licenses(docs: DataFrame, text_col: str = "text", scan: Scan | None = None) -> DataFrame:
    """``docs`` with a struct ``_license``: ``n_words``, ``base`` and ``matches`` (arrays of label, first and last word, edits), ``score``.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lowered,
    numbered from 0.  ``score`` is 1 less the smallest share of edited characters
    of a match, 1 with a base place, 0 without either.  Null, empty and wordless
    texts have no words and no matches; every place of a repeated notice counts.
    Other columns pass through; one named ``_license`` is replaced.
    """
    scan = scan or Scan()
    docs = docs.drop("_license")
    where = docs.columns.index(text_col)
    kind = T._parse_datatype_string(f"n_words long, base array<struct<{_MATCH.replace(' ', ':').replace(',:', ',')}>>, matches array<struct<{_MATCH.replace(' ', ':').replace(',:', ',')}>>, score double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(scan)
        match = pa.list_(pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("edits", pa.int64())]))
        for batch in batches:
            raw, offsets = tokens.text_buffer(batch.column(where))
            n_words, bases, found, scores = [], [], [], []
            for lo, hi in tokens.blocks(offsets):
                w = tokens.words(raw, offsets, lo, hi, tokens.ALNUM)
                joined, begin, at = _joined(w)
                n_words += w.counts.tolist()
                for i in range(hi - lo):
                    base, matches = finder.find(joined[begin[i] : begin[i + 1]])
                    if not base and not matches:
                        bases.append([]), found.append([]), scores.append(0.0)
                        continue
                    own = at[w.first[i] : w.first[i + 1]] - begin[i]
                    number = lambda x: int(np.searchsorted(own, x, side="right")) - 1  # noqa: B023, E731
                    bases.append([{"label": scan.base[k][1], "first_word": number(x + 1), "last_word": number(x + len(scan.base[k][0])), "edits": 0} for k, x in base])
                    found.append([{"label": scan.notices[k][1], "first_word": max(0, number(a + 1)), "last_word": max(0, number(b - 2)), "edits": e} for k, a, b, e in matches])
                    scores.append(max([1.0] * bool(base) + [1 - e / len(scan.notices[k][0]) for k, _, _, e in matches]))
            out = pa.StructArray.from_arrays([pa.array(n_words, pa.int64()), pa.array(bases, match), pa.array(found, match), pa.array(scores, pa.float64())], names=["n_words", "base", "matches", "score"])
            yield pa.record_batch([*batch.columns, out], names=[*batch.schema.names, "_license"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("_license", kind)]))


def op8_license_scan(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    base, own = F.col("_license.base"), F.col("_license.matches")
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return with_licenses(docs).select(
        "doc_id",
        "_license.n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(base["first_word"]).alias("first_word"),
        F.array_max(base["first_word"]).alias("last_word"),
        joined(base["label"]).alias("base_labels"),
        joined(F.concat(base["label"], own["label"])).alias("labels"),
        "_license.score",
        F.size(own).cast("long").alias("n_matches"),
        F.array_join(F.transform(own, lambda m: F.format_string("%s:%d-%d:%d", m["label"], m["first_word"], m["last_word"], m["edits"])), ",").alias("spans"),
    )
