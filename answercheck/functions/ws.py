"""Whitespace as Python's str.strip() / str.split() see it, for Spark and DuckDB.

Spark's trim() strips blanks only and its regex classes over many Unicode ranges are
slow, so: stripping is ``btrim`` over the character set, and squashing maps every
whitespace character to a blank with ``translate`` before collapsing blank runs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python's str.split() and str.strip() treat as whitespace.
WS_CODES = (list(range(0x09, 0x0E)) + list(range(0x1C, 0x21)) + [0x85, 0xA0, 0x1680]
            + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
WS_CHARS = "".join(chr(c) for c in WS_CODES)
# The same set as a regex class valid in Java and RE2 syntax.
WS_CLASS = "[" + "".join(f"\\x{{{c:02X}}}" for c in WS_CODES) + "]"


def strip_ws(c: Column) -> Column:
    """str.strip()."""
    return F.btrim(c, F.lit(WS_CHARS))


def squash(c: Column) -> Column:
    """" ".join(s.split()): every whitespace run becomes one blank, ends stripped."""
    return F.trim(F.regexp_replace(F.translate(c, WS_CHARS, " " * len(WS_CHARS)), " +", " "))


def tokens(c: Column) -> Column:
    """s.split(): whitespace tokens, none empty."""
    return F.filter(F.split(squash(c), " "), lambda t: t != F.lit(""))


# --- the same in DuckDB SQL (oracles) -------------------------------------------------------

WS_SQL = "(" + " || ".join(f"chr({c})" for c in WS_CODES) + ")"
BLANKS_SQL = f"repeat(' ', {len(WS_CODES)})"


def strip_ws_sql(x: str) -> str:
    return f"trim({x}, {WS_SQL})"


def squash_sql(x: str) -> str:
    return f"trim(regexp_replace(translate({x}, {WS_SQL}, {BLANKS_SQL}), ' +', ' ', 'g'))"


def tokens_sql(x: str) -> str:
    return f"list_filter(string_split({squash_sql(x)}, ' '), lambda t: t <> '')"
