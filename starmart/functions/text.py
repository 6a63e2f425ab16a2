"""Text expressions: place labels and code cleanup (built-in regex functions only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def part(col: str | Column, sep: str, index: int) -> Column:
    """``index``-th piece (0-based) of ``col`` split on the regex ``sep``; null past the end.

    ``F.get`` instead of ``[index]``: under ANSI the subscript raises on a short array.
    """
    return F.get(F.split(_c(col), sep), F.lit(index))


def drop_blanks(col: str | Column) -> Column:
    """Remove every blank character (space), as code columns are cleaned."""
    return F.regexp_replace(_c(col), " ", "")


def split_place(col: str | Column, mode: str = "reference") -> dict[str, Column]:
    """Split a place label such as ``'ANCHORAGE, AK'`` into ``city`` and ``state_code``.

    ``reference``: city = text before the first comma; state code = first two characters of
    the second comma piece with its blanks removed.  Two-comma labels take the middle piece and
    a foreign label such as ``'CALGARY, CANADA'`` yields ``'CA'``.

    ``strict``: state code = a whole two-letter upper-case token that opens the *last* comma
    piece (null otherwise); city = everything before the last comma.
    """
    c = _c(col)
    if mode == "reference":
        return {
            "city": part(c, ",", 0),
            "state_code": F.substring(drop_blanks(part(c, ",", 1)), 1, 2),
        }
    if mode == "strict":
        has_comma = F.instr(c, ",") > 0
        last = F.regexp_extract(c, r",([^,]*)$", 1)
        code = F.regexp_extract(last, r"^\s*([A-Z]{2})(?:[^A-Za-z]|$)", 1)
        return {
            "city": F.when(has_comma, F.regexp_extract(c, r"^(.*),[^,]*$", 1)),
            "state_code": F.when(has_comma & (code != ""), code),
        }
    raise ValueError(f"unknown mode {mode!r}")


def join_key(col: str | Column) -> Column:
    """Case- and blank-insensitive helper key for joining place names across sources."""
    return F.upper(F.trim(_c(col)))
