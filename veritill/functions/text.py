"""String expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from veritill.model import STATUS_SYNONYMS

# The code points Unicode counts as white space, plus the four ASCII separators.
_ASCII_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f "
_UNICODE_SPACE = "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
_SPACE = _ASCII_SPACE + _UNICODE_SPACE

_LETTER_RUNS = r"(\p{L}+|[^\p{L}]+)"
_WORD_RUNS = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"


def strip(c: Column) -> Column:
    """Drop white space of any kind at both ends.

    Trimming spaces is much cheaper than trimming a set; the set is only tried on text that
    then still begins or ends outside printable ASCII.
    """
    plain = F.trim(c)
    printable = F.ascii(plain).between(33, 126) & F.ascii(F.substring(plain, -1, 1)).between(33, 126)
    return F.when(printable, plain).otherwise(F.btrim(c, F.lit(_SPACE)))


def lower_strip(c: Column) -> Column:
    """C20: lower case without surrounding white space."""
    return strip(F.lower(c))


def _capitalise_runs(c: Column, runs: str) -> Column:
    pieces = F.regexp_extract_all(F.lower(c), F.lit(runs), F.lit(1))
    return F.array_join(F.transform(pieces, lambda piece: F.initcap(piece)), "")


def title_case(c: Column) -> Column:
    """Capital at the start of every run of letters, so ``t-light 3d`` is ``T-Light 3D``.

    ``initcap`` only sees words between spaces; it is right, and cheaper, for text made of
    letters and spaces alone.
    """
    return F.when(c.rlike(r"[^\p{L} ]"), _capitalise_runs(c, _LETTER_RUNS)).otherwise(F.initcap(c))


def capitalise_words(c: Column) -> Column:
    """SQL-style capitalisation, where digits belong to words (``3d`` is ``3d``)."""
    return F.when(c.rlike(r"[^\p{L}\p{N} ]"), _capitalise_runs(c, _WORD_RUNS)).otherwise(F.initcap(c))


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literal_map(mapping: Mapping[str, str]) -> Column:
    return F.expr("map(" + ", ".join(_quoted(part) for pair in mapping.items() for part in pair) + ")")


def lookup(c: Column, mapping: Mapping[str, str]) -> Column:
    """Value of a literal map, null for other keys."""
    return F.try_element_at(literal_map(mapping), c)


def normalise_status(c: Column) -> Column:
    """C14: lower case, then fold synonyms; unknown values pass through, null stays null."""
    plain = lower_strip(c)
    return F.coalesce(lookup(plain, STATUS_SYNONYMS), plain)


def flag(c: Column) -> Column:
    """Boolean from true/false/1/0 in any letter case, null for anything else."""
    text = lower_strip(c.cast("string"))
    return F.when(text.isin("true", "1"), F.lit(True)).when(text.isin("false", "0"), F.lit(False))


def decimal_text(c: Column, digits: int) -> Column:
    """Fixed-point text of a double, rounded half-even on its exact value."""
    return F.call_function("format_number", c, F.lit("0." + "0" * digits if digits else "0"))


def grouped_text(c: Column) -> Column:
    """Integer text with thousands separators."""
    return F.format_number(c, 0)
