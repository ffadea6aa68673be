"""Short descriptions from articles in HTML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns of what isn't read as an article's text.
REMOVED = (
    r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>",
    r"(?is)<aside\b[^>]*>.*?</aside\s*>",
    r"(?is)<table\b[^>]*>.*?</table\s*>",
    r"(?is)<(sup|span)\b[^>]*class\s*=\s*[\"'][^\"']*reference[^\"']*[\"'][^>]*>.*?</\1\s*>",
    r"(?is)<blockquote\b[^>]*>.*?</blockquote\s*>",
)

# Character references that descriptions decode.
REFERENCES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&"))


def paragraphs(html: Column) -> Column:
    """Texts of the paragraphs outside of asides, tables, references and quotations."""
    body = F.coalesce(html, F.lit(""))
    for pattern in REMOVED:
        body = F.regexp_replace(body, pattern, "")
    found = F.regexp_extract_all(body, F.lit(r"(?is)<p\b[^>]*>(.*?)</p\s*>"), 1)

    def plain(p: Column) -> Column:
        out = F.regexp_replace(p, r"(?s)<[^>]*>", " ")
        for name, char in REFERENCES:
            out = F.replace(out, F.lit(name), F.lit(char))
        return F.trim(F.regexp_replace(out, r"\s+", " "))

    return F.transform(found, plain)


def leading_paragraphs(texts: Column, most: int = 200, least: int = 20) -> Column:
    """Paragraphs of ``least`` characters that don't begin with a quotation mark, until they pass ``most`` characters."""
    fit = F.filter(texts, lambda p: (F.length(p) >= least) & ~p.startswith('"') & ~p.startswith("'"))
    empty = F.struct(F.array().cast("array<string>").alias("kept"), F.lit(0).alias("n"))

    def step(acc: Column, p: Column) -> Column:
        taken = F.struct(F.concat(acc["kept"], F.array(p)).alias("kept"), (acc["n"] + F.length(p) + F.when(acc["n"] > 0, 1).otherwise(0)).cast("int").alias("n"))
        return F.when(acc["n"] > most, acc).otherwise(taken)

    return F.aggregate(fit, empty, step)["kept"]


# Citation marks, blanks before punctuation, and where a sentence ends.
CITATION, BEFORE_PUNCTUATION, SENTENCE_END = r"\[\d+[a-z]?\]", r"\s+([.,!?;:])", r"(?<=[.!?])\s+(?=[A-Z])"


def clean_citations(text: Column) -> Column:
    """Without ``[1]`` and ``[2a]``, white space collapsed, none before punctuation."""
    out = F.regexp_replace(text, CITATION, "")
    out = F.regexp_replace(out, r"\s+", " ")
    return F.regexp_replace(out, BEFORE_PUNCTUATION, "$1")


def first_sentences(text: Column, count: int = 3) -> Column:
    """The first sentences; one ends at white space between .!? and a capital."""
    return F.trim(F.array_join(F.slice(F.split(text, SENTENCE_END), 1, count), " "))


def description(html: Column) -> Column:
    """At most three sentences about an article; '' where it has none."""
    joined = F.array_join(leading_paragraphs(paragraphs(html)), " ")
    return F.coalesce(first_sentences(clean_citations(joined)), F.lit(""))
