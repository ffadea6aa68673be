"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to a in is that it for was on with as be by this are at from or an he "
    "de la le et les des en un du une que pour est par dans qui avec pas sur au ne se ce "
    "der die und den von zu das mit sich auf für ist im nicht dem ein eine als auch es "
    "el y los las del por con no su para al lo como más pero"
).split()


@dataclass(frozen=True)
class Rule:
    """A row is rejected where ``measure`` is below ``low`` or above ``high`` times ``per`` (or 1)."""

    name: str
    measure: str
    per: str | None = None
    low: float | None = None
    high: float | None = None

    def fails(self, m: Column) -> Column:
        value, unit = m[self.measure], m[self.per] if self.per else F.lit(1)
        out = F.lit(False)
        if self.low is not None:
            out = out | (value < F.lit(self.low) * unit)
        if self.high is not None:
            out = out | (value > F.lit(self.high) * unit)
        return out


#: The table of thresholds.
BASE_RULES = (
    Rule("few_words", "n_words", low=50),
    Rule("repeated_words", "n_repeat_words", per="n_words", high=0.5),
)
RULES = (
    Rule("word_length", "word_chars", per="n_words", low=2.0, high=15.0),
    Rule("symbols", "n_symbols", per="n_words", high=0.3),
    Rule("stop_words", "n_stop_words", per="n_words", low=0.02),
    Rule("duplicate_lines", "n_dup_lines", per="n_lines", high=0.5),
)


MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stop_words")


def _let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeats(words: Column) -> Column:
    """Words that lie in a 3-word window which the array holds twice or more."""

    def covered(hashes: Column) -> Column:
        last = F.size(hashes) - 1
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            twin = lambda k, x: F.coalesce(F.get(p, k)["h"] == x["h"], F.lit(False))
            kept = F.filter(p, lambda x, k: twin(k - 1, x) | twin(k + 1, x))
            return F.array_sort(F.transform(kept, lambda x: x["i"]))

        def spread(s: Column) -> Column:
            gaps = F.transform(s, lambda x, k: F.coalesce(F.least(F.get(s, k + 1) - x, F.lit(3)), F.lit(3)))
            return F.aggregate(gaps, F.lit(0).cast("long"), lambda acc, g: acc + g)

        found = _let(_let(pairs, starts), spread)
        return F.when((last < 1) | (F.size(F.array_distinct(hashes)) == F.size(hashes)), F.lit(0).cast("long")).otherwise(found)

    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(windows, covered))


def measures(text: Column) -> Column:
    """Struct of the measures that rules are stated in; a null text counts as an empty one."""
    text = F.coalesce(text, F.lit(""))

    def of(x: Column) -> Column:
        words, lines, t = x["words"], x["lines"], x["text"]
        long = lambda c: c.cast("long")
        return F.struct(
            long(F.size(words)).alias("n_words"),
            long(F.char_length(t) - F.regexp_count(t, F.lit(SPACE))).alias("word_chars"),
            long(F.regexp_count(t, F.lit(SYMBOLS))).alias("n_symbols"),
            long(F.size(lines) - F.size(F.array_distinct(lines))).alias("n_dup_lines"),
            _repeats(words).alias("n_repeat_words"),
            long(F.size(lines)).alias("n_lines"),
            long(F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS)))).alias("n_stop_words"),
        )

    words = F.filter(F.split(text, SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return _let(F.struct(text.alias("text"), words.alias("words"), lines.alias("lines")), of)


def with_rules(docs: DataFrame, text_col: str = "text", base: tuple[Rule, ...] = BASE_RULES, rules: tuple[Rule, ...] = RULES, out: str = "_rules") -> DataFrame:
    """``docs`` with one struct column ``out``: all measures, ``base_failed``, ``failed`` and ``kept``.

    Measured over the whole text.  Null, empty and blank texts have no words and
    fail ``few_words``.  Every row is judged by itself, so repeated rows get equal
    verdicts and an empty table gives an empty one.  Other columns pass through;
    a column of ``docs`` named as ``out`` is replaced.
    """

    def judge(m: Column) -> Column:
        named = lambda table: F.array_compact(F.array(*[F.when(r.fails(m), F.lit(r.name)) for r in table]))
        base_failed, failed = named(base), named((*base, *rules))
        return F.struct(*[m[n].alias(n) for n in MEASURES], (F.size(base_failed) > 0).alias("base_failed"), failed.alias("failed"), (F.size(failed) == 0).alias("kept"))

    return docs.withColumn(out, _let(measures(F.col(text_col)), judge))


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    r = lambda n: F.col(f"_rules.{n}").alias(n)
    return with_rules(docs).select("doc_id", *[r(n) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")], F.array_join("_rules.failed", ",").alias("failed"))


_STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)
OP9_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM t),
p AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w),
g AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i], ws[i + 1], ws[i + 2]) AS n FROM p),
c AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM g, (SELECT unnest([0, 1, 2]) AS k) WHERE n > 1 GROUP BY doc_id),
m AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
             CAST(length(text) - len(regexp_extract_all(text, '[\x20\x09-\x0D]')) AS BIGINT) AS word_chars,
             CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
             CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words, CAST(len(ls) AS BIGINT) AS n_lines,
             len(list_filter(ws, lambda x: lower(x) IN ({_STOP_SQL}))) AS n_stop_words
      FROM w LEFT JOIN c ON c.doc_id = w.doc_id),
f AS (SELECT *, list_filter([
        CASE WHEN n_words < 50 THEN 'few_words' END,
        CASE WHEN 2 * n_repeat_words > n_words THEN 'repeated_words' END,
        CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 'word_length' END,
        CASE WHEN n_symbols > 0.3::DOUBLE * n_words THEN 'symbols' END,
        CASE WHEN n_stop_words < 0.02::DOUBLE * n_words THEN 'stop_words' END,
        CASE WHEN 2 * n_dup_lines > n_lines THEN 'duplicate_lines' END], lambda x: x IS NOT NULL) AS fails FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 2 * n_repeat_words > n_words AS base_failed, len(fails) = 0 AS kept,
       array_to_string(fails, ',') AS failed FROM f"""
