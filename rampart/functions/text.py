"""String and number helpers, as Columns and as SQL fragments.

Fragments exist because lambdas over map/array values and long literal maps are
far shorter (and much cheaper to plan) as ``F.expr`` text than as nested Column
calls.  Everything here runs inside the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters that Unicode (and the ASCII separators 1C-1F) count as whitespace;
# Spark's plain trim() only removes U+0020.
SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same for a character class of a Java pattern, whose own \s is ASCII only.
SPACE_CLASS = r"\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# What a decimal float may look like; try_cast alone also takes "1d" or "0x1p3".
FLOAT_SYNTAX = (
    r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
)


def literal(text: str | None) -> str:
    """A Python string as a SQL string literal."""
    if text is None:
        return "CAST(NULL AS STRING)"
    escaped = text.replace("\\", "\\\\").replace("'", "\\'").replace("\0", "\\0")
    return f"'{escaped}'"


def string_array(items) -> str:
    """A Python list as a SQL ``array<string>`` literal."""
    items = list(items)
    if not items:
        return "CAST(array() AS ARRAY<STRING>)"
    return "array(" + ", ".join(literal(i) for i in items) + ")"


def string_map(pairs: dict) -> str:
    """A flat dict of strings as a SQL ``map<string,string>`` literal."""
    if not pairs:
        return "CAST(map() AS MAP<STRING,STRING>)"
    return "map(" + ", ".join(f"{literal(k)}, {literal(v)}" for k, v in pairs.items()) + ")"


def strip_sql(expr: str) -> str:
    return f"trim(BOTH {literal(SPACE)} FROM {expr})"


def strip(col: Column) -> Column:
    """Remove every kind of leading and trailing whitespace."""
    return F.trim(col, F.lit(SPACE))


def char_count(col: Column, char: str) -> Column:
    """How often one character occurs."""
    return F.length(col) - F.length(F.replace(col, F.lit(char), F.lit("")))


def number_sql(expr: str) -> str:
    """Text to double; NULL when the text is not a float (NaN counts as not)."""
    text = strip_sql(expr)
    return (
        f"CASE WHEN {text} RLIKE {literal(FLOAT_SYNTAX)}"
        f" THEN try_cast(replace({text}, '_', '') AS DOUBLE)"
        f" WHEN lower({text}) IN ('inf', '+inf', '-inf', 'infinity', '+infinity', '-infinity')"
        f" THEN double('Infinity') END"
    )


def round_half_even(col: Column, digits: int) -> Column:
    """Round on the binary value of a double, ties to even.

    ``bround`` looks at the shortest decimal text of a double, so it takes 2.675
    (really 2.67499...) for a tie.  Where that text does end in a 5 one place
    further, the true side is found from an error-free product.
    """
    scale = float(10 ** (digits + 1))
    near = F.bround(col * F.lit(scale), 0)
    half_of_place = F.pmod(F.abs(near), F.lit(10.0)) == F.lit(5.0)
    spread = col * F.lit(134217729.0)
    high = spread - (spread - col)
    low = col - high
    error = (high * F.lit(scale) - near) + low * F.lit(scale)
    step = F.lit(5.0)
    down = F.bround((near - step) / F.lit(scale), digits)
    up = F.bround((near + step) / F.lit(scale), digits)
    tie_text = half_of_place & (F.abs(error) < F.lit(1e-6))
    return (
        F.when(tie_text & (error < 0), down)
        .when(tie_text & (error > 0), up)
        .otherwise(F.bround(col, digits))
    )


def last_wins_map_sql(keys: str, vals: str) -> str:
    """Map from parallel arrays where a repeated key keeps its last value.

    ``map_from_arrays`` fails on repeats unless the session says otherwise, and a
    library should not depend on (or change) a session setting.
    """
    return (
        f"CASE WHEN size(array_distinct({keys})) = size({keys})"
        f" THEN map_from_arrays({keys}, {vals})"
        f" ELSE map_from_arrays(array_distinct({keys}),"
        f" transform(array_distinct({keys}), k -> element_at(reverse({vals}),"
        f" int(array_position(reverse({keys}), k))))) END"
    )
