"""Unit-name normalisation as native Column expressions.

All of these are folds of ``replace`` / ``regexp_replace`` / ``when`` over a
fixed, ordered rule list, so they stay inside whole-stage codegen. They are
meant to run on *distinct* unit strings (a few dozen), never per fact row.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.session import row_count_at_most

# ---------------------------------------------------------------------------
# Alias -> registry name. Applied in this order, literally, all
# occurrences (the order is load-bearing: "2019 $/b" before "2019 $", "cents"
# before "2019 cent", "Mt CO2/yr" before "/yr", and "per" last - which also
# hits the "per" inside "percent").
# ---------------------------------------------------------------------------
UNIT_ALIASES: list[tuple[str, str]] = [
    ("2019 $/b", "US_2019_Dollar/barrelnew"),
    ("2020 $/b", "US_2020_Dollar/barrelnew"),
    ("2021 $/b", "US_2021_Dollar/barrelnew"),
    ("dollars", "dollar"),
    ("US$2018", "US_2018_Dollar"),
    ("2012  $", "US_2012_Dollar"),
    ("2012 $", "US_2012_Dollar"),
    ("chained 2012 dollar (seasonally-adjusted annual rate)", "US_2012_Dollar"),
    ("2019 $/st", "US_2019_Dollar/short_ton"),
    ("2019 $", "US_2019_Dollar"),
    ("2020 $", "US_2020_Dollar"),
    ("2021 $", "US_2021_Dollar"),
    ("cents", "cent"),
    ("2019 cent", "US_2019_cent"),
    ("2020 cent", "US_2020_cent"),
    ("2021 cent", "US_2021_cent"),
    ("kilowatt hour", "kWh"),
    ("quads", "quadrillion btu"),
    ("BkWh", "billion kwh"),
    ("million Btu", "MMBtu"),
    ("MMmt CO2", "Million_ton_CO2_yr"),
    ("Mt CO2/yr", "Million_ton_CO2_yr"),
    ("million metric tons CO2", "Million_ton_CO2_yr"),
    ("Million Metric Tons of Carbon Dioxide", "Million_ton_CO2_yr"),
    ("metric tons", "metric_tons"),
    ("cubic feet", "cubic_feet"),
    ("short tons", "short_tons"),
    ("/yr", ""),
    ("per", "/"),
]

# ---------------------------------------------------------------------------
# Registry / source names -> template display names.
# ---------------------------------------------------------------------------
TEMPLATE_DISPLAY_NAMES: list[tuple[str, str]] = [
    ("US_2018_Dollar/GJ", "US$2018/GJ"),
    ("MMmt CO2", "Mt CO2/yr"),
    ("million metric tons CO2", "Mt CO2/yr"),
    ("Million_ton_CO2_yr", "Mt CO2/yr"),
    ("EJ", "EJ/yr"),
    ("Billion_US_2018_Dollar", "billion US$2018/yr"),
    ("US_2018_Dollars/GJ", "US$2018/GJ"),
]

# ---------------------------------------------------------------------------
# Whole-value source unit aliases (L18), exact matches only.
# ---------------------------------------------------------------------------
SOURCE_UNIT_ALIASES: list[tuple[str, str]] = [
    ("MMmt CO2", "MMTCO2e"),
    ("million metric tons", "MMTCO2e"),
    ("billion 2012 $", "billion dollars"),
    ("billion chained 2012 dollars (seasonally-adjusted annual rate)", "billion dollars"),
    ("MMst", "million short_tons"),
    ("MMb/d", "million barrels/day"),
]

# ---------------------------------------------------------------------------
# The alternative normaliser (L6). Ordered substitutions; entries
# marked regex are regular expressions, the rest literal.
# ---------------------------------------------------------------------------
ALT_SUBSTITUTIONS: list[tuple[str, str, bool]] = [
    (" per ", "/", True),
    ("Number", "number", True),
    ("N", "N2O", True),
    ("cwt.", "hundredweight", True),
    ("short ton", "ton", True),
    ("fraction", "percent/hundred", True),
    (" ", "*", True),
]
ALT_ALIASES: list[tuple[str, str]] = [("quads", "quadrillion Btu"), ("short ton", "ton")]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fold_replace(c: Column | str, pairs: Sequence[tuple[str, str]]) -> Column:
    """Sequential literal replace-all over an ordered alias list."""
    return reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), pairs, _col(c))


MAX_ALIASES = 10_000


def with_aliases_replaced(df: DataFrame, columns: Mapping[str, str], aliases: DataFrame, max_aliases: int = MAX_ALIASES) -> DataFrame:
    """L5 with the aliases as a table (``rank, alias, name``): for each ``out: column`` of ``columns``, ``column`` with all aliases
    replaced, all occurrences, in the order of rank (equal ranks by alias, then name). The table becomes one array, read once by a
    scalar subquery; more than ``max_aliases`` rows are an error. Rows without an alias or a name, and empty aliases, change
    nothing. Meant for distinct values."""
    usable = aliases.where("alias <> '' and name is not null")
    if not row_count_at_most(usable, max_aliases):
        raise ValueError(f"more than {max_aliases} aliases")
    ranked = usable.select(F.sort_array(F.collect_list(F.struct("rank", "alias", "name"))).alias("a")).scalar()
    own = df.withColumn("__aliases", ranked)
    return own.withColumns({out: F.aggregate("__aliases", F.col(c).cast("string"), lambda text, one: F.replace(text, one["alias"], one["name"]))
                            for out, c in columns.items()}).drop("__aliases")


def standardize_unit_names(c: Column | str, aliases: Sequence[tuple[str, str]] = UNIT_ALIASES) -> Column:
    """Alias -> registry names, literal, ordered, all occurrences."""
    return fold_replace(c, aliases)


def standardize_unit_names_alt(c: Column | str, equivalence_sets: Sequence[Sequence[str]] = ()) -> Column:
    """Collapse each equivalence set to its first member, then the ordered
    substitutions, then the alias list. The equivalence sets are parameters."""
    x = source = _col(c)
    chain = None  # one chained test of the original value: the first set that holds it wins
    for members in map(list, equivalence_sets):
        if members:
            chain = (F if chain is None else chain).when(source.isin(members), F.lit(members[0]))
    if chain is not None:
        x = chain.otherwise(source)
    for pat, rep, is_regex in ALT_SUBSTITUTIONS:
        x = F.regexp_replace(x, F.lit(pat), F.lit(rep)) if is_regex else F.replace(x, F.lit(pat), F.lit(rep))
    return fold_replace(x, ALT_ALIASES)


def map_whole_values(c: Column | str, mapping: Sequence[tuple[str, str]]) -> Column:
    """Exact whole-value lookup, else keep the value."""
    x = _col(c)
    m = F.create_map(*[F.lit(v) for kv in mapping for v in kv])
    return F.coalesce(F.element_at(m, x), x)


def relabel_units(variable: Column | str, unit: Column | str) -> Column:
    """The five context-dependent relabel rules, in order.

    R1 per-day barrels and R2 per-day cubic feet become annual totals (the day
    count lives in the mapping factor); R3 CO2 emissions in plain metric tons get
    the CO2 unit; R4 short tons on a coal variable become coal energy; R5 any
    ``barrel``/``barrels`` becomes ``barrelnew`` (``barrels?`` = longest match).
    A missing guard is false, so the unit is kept.
    """
    v, u = _col(variable), _col(unit)
    u = F.when(u == "million barrels per day", F.lit("million barrels")).otherwise(u)
    u = F.when(u == "billion cubic feet per day", F.lit("billion cubic_feet")).otherwise(u)
    r3 = F.coalesce(v.contains("Emissions|CO2") & (u == "million metric tons"), F.lit(False))
    u = F.when(r3, F.lit("million metric tons CO2")).otherwise(u)
    r4 = F.coalesce(v.rlike("(?i)coal") & u.rlike("(?i)short tons"), F.lit(False))
    u = F.when(r4, F.regexp_replace(u, F.lit("short tons"), F.lit("short_tons_coal"))).otherwise(u)
    return F.regexp_replace(u, F.lit("barrels?"), F.lit("barrelnew"))


RenameFun = Callable[[Column], Column]
