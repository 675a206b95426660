"""Scalar text helpers as native Column expressions.

Missing-value rules follow the reference: ``paste0`` prints a missing part as the
text ``NA``; a regex/contains test on a missing value is false; an if/else whose
condition is missing is missing (``when_r``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.col(x) if isinstance(x, str) else F.lit(x)


def lit_or_col(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def paste0(*parts) -> Column:
    """L1: concatenate; a missing part becomes the text ``NA``. Strings are
    literals; pass ``F.col`` for columns."""
    return F.concat(*[F.coalesce(lit_or_col(p).cast("string"), F.lit("NA")) for p in parts])


def when_r(cond: Column, yes: Column, no: Column) -> Column:
    """``if_else`` with R's rule that a missing condition gives a missing result."""
    return F.when(cond.isNull(), F.lit(None)).when(cond, yes).otherwise(no)


def grepl(c, pattern: str, *, fixed: bool = False, ignore_case: bool = False) -> Column:
    """Pattern test; missing input -> false."""
    x = _c(c)
    if fixed:
        t = F.lower(x).contains(pattern.lower()) if ignore_case else x.contains(pattern)
    else:
        t = x.rlike(("(?i)" if ignore_case else "") + pattern)
    return F.coalesce(t, F.lit(False))


def replace_first(x: Column, placeholder: str, value: Column) -> Column:
    """Replace the first occurrence of the literal ``placeholder`` (L2/L3 step).

    ``overlay`` at position 0 would corrupt the text, hence the guard; a missing
    replacement gives a missing result where the placeholder occurs."""
    pos = F.locate(placeholder, x)
    return F.when(pos > 0, F.overlay(x, value, pos, F.lit(len(placeholder)))).otherwise(x)


def interpolate_template(template: Column, replacements: Mapping[str, Column | str] | Sequence[tuple[str, Column | str]]) -> Column:
    """L3: for each name in order, replace the first ``{name}`` by the value.

    Values are Columns or literal strings. A placeholder occurring twice keeps its
    second occurrence; an absent placeholder changes nothing."""
    items = replacements.items() if isinstance(replacements, Mapping) else replacements
    x = template
    for name, value in items:
        x = replace_first(x, "{" + name + "}", lit_or_col(value))
    return x


def interpolate_key_column(df, replacements: Mapping[str, Column | str], template_col: str = "EIA_template",
                           out_col: str = "EIA_key", strip_prefix: str = "EIA_"):
    """L4: write the interpolated key into ``out_col`` and drop the other columns
    whose name starts with ``strip_prefix`` (the template and its parameters)."""
    out = df.withColumn(out_col, interpolate_template(F.col(template_col), replacements))
    strip = [c for c in out.columns if c.startswith(strip_prefix) and c != out_col]
    return out.drop(*strip)


# digits with an optional sign, point and exponent; no type suffixes, no words
NUMBER_TEXT = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def parse_number_text(c) -> Column:
    """Numeric text with thousands commas -> double; anything else (e.g.
    the below-threshold sentinel ``+``, or words such as ``inf``) -> missing. Never
    raises under ANSI."""
    plain = F.trim(F.regexp_replace(_c(c), ",", ""))
    return F.when(plain.rlike(NUMBER_TEXT), plain.try_cast("double"))


def below_threshold(c, sentinel: str = "+") -> Column:
    """L10 companion flag: the cell holds the sentinel."""
    return F.coalesce(F.trim(_c(c)) == F.lit(sentinel), F.lit(False))


def ceil_div(index: Column, n: int) -> Column:
    """L14 ``ceiling(i / n)`` as a long."""
    return F.ceil(index / F.lit(n)).cast("long")
