"""Text clean-up expressions (JVM built-ins only, so they stay in codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strata.schemas import LOCATION_SEPARATOR, SPACE_TOKEN


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def last_token(c: Column | str, sep: str = LOCATION_SEPARATOR) -> Column:
    """Last ``sep``-separated token of a text.

    A trailing separator gives the empty string, a text without separator is
    returned whole, null stays null.
    """
    return F.element_at(F.split(_col(c), _regex_literal(sep)), -1)


def normalize_name(c: Column | str, space_token: str = SPACE_TOKEN, legacy: bool = False) -> Column:
    """Display form of an upper-case name whose spaces are spelled ``Nan``.

    Default: replace the case-sensitive token by a space, lower-case, then
    capitalise the first letter after each space (``CHINANanSEA`` ->
    ``China Sea``). ``legacy=True`` lower-cases first and then replaces the
    lower-case token, which also eats letters inside words (``Chi Ansea``).
    Capitalisation follows spaces only: ``GUINEA-BISSAU`` -> ``Guinea-bissau``.
    """
    col = _col(c)
    if legacy:
        spaced = F.regexp_replace(F.lower(col), _regex_literal(space_token.lower()), " ")
    else:
        spaced = F.lower(F.regexp_replace(col, _regex_literal(space_token), " "))
    return F.initcap(spaced)


def _regex_literal(text: str) -> str:
    """Escape a literal for use as a Java regular expression."""
    special = set("\\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in text)
