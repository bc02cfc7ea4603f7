"""Text cleaning of the regulatory-limits table, as Spark column expressions.

The original cleaned cells with Python ``re`` / ``str`` functions. Java regex
differs: ``\\s`` and ``\\d`` are ASCII-only unless ``(?U)`` is set, ``.`` stops
at more line terminators unless ``(?d)`` is set, and Python's ``str.strip()``
and ``\\s`` also treat U+001C..U+001F as whitespace. The patterns below set
those flags so results equal the Python ones on any Unicode text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the limits document (they must equal the original's):
# subscript digits for 0-9, the limit-value pattern (number + unit + origin),
# the name of an untitled pollutant, the misprinted benzene formulas and their
# fix (case-insensitive), and the separator of several values in one cell.
SUBSCRIPT_DIGITS = "₀₁₂₃₄₅₆₇₈₉"
MEASURE_PATTERN = r"([\d,.]+\s*(?:µg/m³|µg/m3|mg/m³|mg/m3|ng/m³|ng/m3))\s*\((FR|UE)\)"
UNKNOWN_POLLUTANT = "Inconnu"
BENZENE_FIXES = ["CH66", "CH₆₆"]
BENZENE = "C6H6"
JOIN = " ; "

# Python's notion of whitespace, in Java regex syntax (use with (?U)).
WS = r"[\s\x1c-\x1f]"
# (?U): Unicode \d and \s in Java, as in Python.
MEASURE = "(?U)" + MEASURE_PATTERN
# Tokens that cover a string left to right: a parenthesised group as Python's
# non-greedy r"\((.*?)\)" would match it, a run without "(", or a lone "(".
TOKENS = r"(?d)\(.*?\)|[^(]+|\("


def strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing Unicode whitespace."""
    return F.regexp_replace(c, rf"(?U)^{WS}+|{WS}+$", "")


def clean_field(c: Column) -> Column:
    """Newlines to spaces, then strip."""
    return strip(F.regexp_replace(c, "\n", " "))


def _fix_group(token: Column) -> Column:
    inner = F.substr(token, F.lit(2), F.length(token) - 2)
    inner = F.regexp_replace(inner, rf"(?U){WS}+", "")
    for wrong in BENZENE_FIXES:
        inner = F.regexp_replace(inner, f"(?iu){wrong}", BENZENE)
    inner = F.translate(inner, "0123456789", SUBSCRIPT_DIGITS)
    is_group = F.startswith(token, F.lit("(")) & (F.length(token) >= 2)
    return F.when(is_group, F.concat(F.lit("("), inner, F.lit(")"))).otherwise(token)


def component_name(name: Column) -> Column:
    """Normalise a pollutant name: no blanks after ``(`` or before ``)``; inside
    each parenthesised group remove blanks, fix the benzene formula and write
    digits as subscripts (``BENZÈNE ( CH66 )`` → ``BENZÈNE (C₆H₆)``)."""
    s = F.regexp_replace(name, rf"(?U)\({WS}+", "(")
    s = F.regexp_replace(s, rf"(?U){WS}+\)", ")")
    tokens = F.regexp_extract_all(s, F.lit(TOKENS), 0)
    return F.array_join(F.transform(tokens, _fix_group), "")


def pollutant_title(cell: Column) -> Column:
    """Title cell → pollutant name.

    NULL or empty → ``Inconnu``. Otherwise line 1 stripped; line 2 (stripped,
    spaces removed) is inserted before the last ``)`` of line 1, or appended
    when there is none; further lines are ignored. Then ``component_name``.
    """
    parts = F.split(cell, "\n")
    main = strip(F.get(parts, 0))
    second = F.get(parts, 1)
    index = F.replace(strip(second), F.lit(" "), F.lit(""))
    last_paren = F.length(main) - F.instr(F.reverse(main), ")") + 1
    merged = (
        F.when(second.isNull(), main)
        .when(F.instr(main, ")") == 0, F.concat(main, index))
        .otherwise(F.concat(F.substr(main, F.lit(1), last_paren - 1), index, F.substr(main, last_paren)))
    )
    named = F.when(cell.isNull() | (cell == ""), F.lit(UNKNOWN_POLLUTANT)).otherwise(merged)
    return component_name(named)


def normalise_spaces(c: Column) -> Column:
    """Runs of whitespace → one space, then strip."""
    return F.trim(F.regexp_replace(c, rf"(?U){WS}+", " "))


def measurement_values(c: Column) -> Column:
    """Limit values of a measurement cell: every ``<number> <unit> (FR|UE)``
    joined with `` ; ``; the normalised text when nothing matches."""
    n = normalise_spaces(F.coalesce(c, F.lit("")))
    found = F.regexp_extract_all(n, F.lit(MEASURE), 1)
    return F.when(F.size(found) > 0, F.array_join(found, JOIN)).otherwise(n)


def measurement_origins(c: Column) -> Column:
    """Origins (FR / UE) of the matched values joined with `` ; ``, else ``""``."""
    n = normalise_spaces(F.coalesce(c, F.lit("")))
    found = F.regexp_extract_all(n, F.lit(MEASURE), 2)
    return F.when(F.size(found) > 0, F.array_join(found, JOIN)).otherwise(F.lit(""))
