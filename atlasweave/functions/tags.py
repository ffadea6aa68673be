"""Tags and notes of gazetteer rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sources that a tag may name.
VALID_SOURCES = (
    "AndyLaw 2eSH 4eAotE1 4eEiS 4ePBtTC 4eSCoSaS 4eCRB 4eDotRC NCC WFB8e AmbChron G&FT TOW 1eMSDtR "
    "4eLoSaS 4eTHRC 4eMCotWW 1eDSaS TWW3 2eKAAotDC MadAlfred MA 4eStarter 4eUA1 4eAotE3 4eUA2 WAWE6E WAWE8E"
).split()


def split_list(text: Column) -> Column:
    """Items between semicolons, outer quotation marks taken off, blanks dropped."""
    inner = F.btrim(F.trim(F.coalesce(text, F.lit(""))), F.lit('"'))
    return F.filter(F.transform(F.split(inner, ";"), lambda x: F.trim(x)), lambda x: x != "")


def parse_notes(text: Column) -> Column:
    return split_list(text)


def parse_tags(tags: Column, trade: Column) -> Column:
    """Tags, then each traded good as ``trade:<good>``."""
    return F.concat(split_list(tags), F.transform(split_list(trade), lambda x: F.concat(F.lit("trade:"), x)))


def tag_issues(tags: Column) -> Column:
    """What is wrong with each tag that is wrong: ``format:<tag>`` or ``source:<value>``."""
    valid = F.array(*[F.lit(s) for s in VALID_SOURCES])

    def issue(tag: Column) -> Column:
        at = F.instr(tag, ":")
        kind, value = F.substring(tag, F.lit(1), at - 1), F.substring(tag, at + 1, F.length(tag))
        return F.when(at == 0, F.concat(F.lit("format:"), tag)).when((kind == "source") & ~F.array_contains(valid, value), F.concat(F.lit("source:"), value))

    return F.array_compact(F.transform(tags, issue))


def add_tag(tags: Column, tag: str) -> Column:
    """Quoted tag list with ``"tag"`` added after a comma unless the text holds it."""
    quoted = F.lit(f'"{tag}"')
    held = F.coalesce(tags, F.lit(""))
    return F.when(F.trim(held) == "", quoted).when(F.instr(held, tag) > 0, held).otherwise(F.concat(held, F.lit(","), quoted))
