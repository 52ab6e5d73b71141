"""Identifier normalisation, keys and pair scoring, as native column expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from carelake.fixed_values import AUTO_LINK_CONFIDENCE, MATCH_RULES, STATUS_WORDS

# Spark's trim() removes blanks only; source text also carries tabs, line ends and
# non-breaking spaces.
_OUTER_SPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(text: Column) -> Column:
    """Text without leading and trailing whitespace of any kind.

    Most texts begin and end with a visible ASCII character and have none; the pattern,
    which costs more than the rest of a visit, is left to the others.
    """
    bare = F.ascii(text).between(33, 126) & F.ascii(F.right(text, F.lit(1))).between(33, 126)
    return F.when(bare, text).otherwise(F.regexp_replace(text, _OUTER_SPACE, ""))


def normalise_email(raw: Column) -> Column:
    """Stripped and lower-cased; NULL unless there is an @ inside."""
    cleaned = F.lower(strip(raw))
    plausible = cleaned.contains("@") & ~cleaned.startswith("@") & ~cleaned.endswith("@")
    return F.when(plausible, cleaned)


def normalise_phone(raw: Column) -> Column:
    """Australian number as ten digits starting with 0, else NULL."""
    digits = F.regexp_replace(raw, "[^0-9]", "")
    national = (
        F.when(
            digits.startswith("0061"),
            F.concat(F.lit("0"), F.substring(digits, F.lit(5), F.length(digits))),
        )
        .when(
            digits.startswith("61") & (F.length(digits) == 11),
            F.concat(F.lit("0"), F.substring(digits, F.lit(3), F.length(digits))),
        )
        .otherwise(digits)
    )
    # Spreadsheets drop the leading zero.
    padded = F.when(
        (F.length(national) == 9) & ~national.startswith("0"), F.concat(F.lit("0"), national)
    ).otherwise(national)
    return F.when((F.length(padded) == 10) & padded.startswith("0"), padded)


def name_key(first: Column, last: Column) -> Column:
    """Letters of both names, upper-cased and joined; NULL if there are none."""
    letters = F.regexp_replace(F.concat_ws("", first, last), "[^A-Za-z]", "")
    return F.nullif(F.upper(letters), F.lit(""))


def canonical_status(raw: Column) -> Column:
    """The status a source word stands for; 'unknown' if none is listed."""
    words = F.create_map(*[F.lit(x) for pair in STATUS_WORDS.items() for x in pair])
    return F.coalesce(F.try_element_at(words, F.lower(strip(raw))), F.lit("unknown"))


def surrogate_key(source: str, natural_id: Column) -> Column:
    """First 32 hex characters of SHA-256 over ``source||id``.

    A NULL id gives a NULL key, so that the quality checks on missing keys can fire.
    """
    text = F.concat(F.lit(f"{source}||"), natural_id.cast("string"))
    return F.substring(F.sha2(text, 256), 1, 32)


def _same(a: Column, b: Column) -> Column:
    # Missing on both sides is not a match, and neither is empty text.
    return F.coalesce((a == b) & (a.cast("string") != ""), F.lit(False))


def match_confidence(a: Mapping[str, Column], b: Mapping[str, Column]) -> Column:
    """Confidence that two normalised party records are one person; the first rule that
    holds decides, NULL if none does (J06). Fields absent from a mapping never match."""
    score = None
    for _, confidence, fields in MATCH_RULES:
        if not all(f in a and f in b for f in fields):
            continue
        holds = F.lit(True)
        for f in fields:
            holds = holds & _same(a[f], b[f])
        score = (F.when if score is None else score.when)(holds, F.lit(confidence))
    return F.lit(None).cast("double") if score is None else score


def auto_link(confidence: Column) -> Column:
    """True where two records may be linked without review."""
    return F.coalesce(confidence >= AUTO_LINK_CONFIDENCE, F.lit(False))
