"""Unit registry (U1): a small, bounded table ``name, kind, scale, dims``.

``scale`` is the size of one unit in base units; ``dims`` is the sorted list of
``(base dimension, exponent)`` pairs, so two units are convertible exactly when
their ``dims`` are equal. ``kind`` is ``symbol`` (matched case-sensitively) or
``name`` (may also match case-insensitively when that is unambiguous).

The registry is built on the driver from a fixed list of definitions plus an SI
prefix rule, then becomes a DataFrame; its size is known at construction, so it
is always safe to broadcast. Users add units with ``UnitDef`` rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([
    T.StructField("name", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("scale", T.DoubleType(), False),
    T.StructField("dims", T.ArrayType(T.StructType([
        T.StructField("dim", T.StringType(), False),
        T.StructField("exp", T.IntegerType(), False),
    ]), False), False),
])


@dataclass(frozen=True)
class UnitDef:
    """One unit: ``names`` are aliases; value = ``multiplier`` x ``of`` (a unit
    expression of already-defined units, ``""`` for dimensionless) or, when
    ``base`` is set, a new base dimension of its own."""

    names: tuple[str, ...]
    multiplier: float = 1.0
    of: str = ""
    base: str | None = None
    kind: str = "name"
    prefixable: bool = False
    dims: dict = field(default_factory=dict)


# ---------------------------------------------------------------------------
# Fixed values. Base units with SI (and common customary) values; Btu is the
# International Table Btu. Dimensions are SI base dimensions plus the custom
# base dimensions introduced below.
# ---------------------------------------------------------------------------
SI_PREFIXES = [
    # (symbol, name, factor)
    ("y", "yocto", 1e-24), ("z", "zepto", 1e-21), ("a", "atto", 1e-18), ("f", "femto", 1e-15),
    ("p", "pico", 1e-12), ("n", "nano", 1e-9), ("u", "micro", 1e-6), ("m", "milli", 1e-3),
    ("c", "centi", 1e-2), ("d", "deci", 1e-1), ("da", "deka", 1e1), ("h", "hecto", 1e2),
    ("k", "kilo", 1e3), ("M", "mega", 1e6), ("G", "giga", 1e9), ("T", "tera", 1e12),
    ("P", "peta", 1e15), ("E", "exa", 1e18), ("Z", "zetta", 1e21), ("Y", "yotta", 1e24),
]

BASE_UNITS = [
    UnitDef(("g",), kind="symbol", prefixable=True, dims={"kg": 1}, multiplier=1e-3),
    UnitDef(("gram",), prefixable=True, dims={"kg": 1}, multiplier=1e-3),
    UnitDef(("m",), kind="symbol", prefixable=True, dims={"m": 1}),
    UnitDef(("meter", "metre"), prefixable=True, dims={"m": 1}),
    UnitDef(("s",), kind="symbol", prefixable=True, dims={"s": 1}),
    UnitDef(("second",), prefixable=True, dims={"s": 1}),
    UnitDef(("A",), kind="symbol", prefixable=True, dims={"A": 1}),
    UnitDef(("ampere",), prefixable=True, dims={"A": 1}),
    UnitDef(("K",), kind="symbol", prefixable=True, dims={"K": 1}),
    UnitDef(("kelvin",), prefixable=True, dims={"K": 1}),
    UnitDef(("mol",), kind="symbol", prefixable=True, dims={"mol": 1}),
    UnitDef(("mole",), prefixable=True, dims={"mol": 1}),
    UnitDef(("J",), kind="symbol", prefixable=True, dims={"kg": 1, "m": 2, "s": -2}),
    UnitDef(("joule",), prefixable=True, dims={"kg": 1, "m": 2, "s": -2}),
    UnitDef(("W",), kind="symbol", prefixable=True, dims={"kg": 1, "m": 2, "s": -3}),
    UnitDef(("watt",), prefixable=True, dims={"kg": 1, "m": 2, "s": -3}),
    UnitDef(("L",), kind="symbol", prefixable=True, multiplier=1e-3, dims={"m": 3}),
    UnitDef(("liter", "litre"), prefixable=True, multiplier=1e-3, dims={"m": 3}),
    UnitDef(("t",), kind="symbol", prefixable=True, multiplier=1e3, dims={"kg": 1}),
    UnitDef(("tonne", "metric_ton"), prefixable=True, multiplier=1e3, dims={"kg": 1}),
    UnitDef(("Wh",), kind="symbol", prefixable=True, multiplier=3600.0, of="J"),
    UnitDef(("watthour",), prefixable=True, multiplier=3600.0, of="J"),
    UnitDef(("min",), kind="symbol", multiplier=60.0, of="s"),
    UnitDef(("minute",), multiplier=60.0, of="s"),
    UnitDef(("h", "hr"), kind="symbol", multiplier=3600.0, of="s"),
    UnitDef(("hour",), multiplier=3600.0, of="s"),
    UnitDef(("d",), kind="symbol", multiplier=86400.0, of="s"),
    UnitDef(("day",), multiplier=86400.0, of="s"),
    UnitDef(("yr", "a"), kind="symbol", multiplier=31556925.9747, of="s"),
    UnitDef(("year",), multiplier=31556925.9747, of="s"),
    UnitDef(("lb",), kind="symbol", multiplier=0.45359237, of="kg"),
    UnitDef(("pound",), multiplier=0.45359237, of="kg"),
    UnitDef(("short_ton", "ton"), multiplier=2000.0, of="pound"),
    UnitDef(("bbl",), kind="symbol", multiplier=0.158987294928, of="m m m"),
    UnitDef(("barrel",), multiplier=0.158987294928, of="m m m"),
    UnitDef(("Btu", "BTU", "btu"), kind="symbol", multiplier=1055.05585262, of="J"),
    UnitDef(("British_thermal_unit",), multiplier=1055.05585262, of="J"),
    UnitDef(("kt",), kind="symbol", multiplier=1852.0 / 3600.0, dims={"m": 1, "s": -1}),  # knot, not kilotonne
    UnitDef(("percent",), multiplier=0.01),
]

# ---------------------------------------------------------------------------
# Fixed values. The harmonisation registry: number words, energy equivalents,
# emissions and money by price year (a producer price index ratio to 2018).
# Nominal cents/dollars count as 2018 money.
# ---------------------------------------------------------------------------
HARMONIZATION_UNITS = [
    UnitDef(("thousand", "Thousand"), multiplier=1e3),
    UnitDef(("million", "Million"), multiplier=1e6),
    UnitDef(("billion", "Billion"), multiplier=1e9),
    UnitDef(("quadrillion", "Quadrillion"), multiplier=1e15),
    UnitDef(("trillion", "Trillion"), multiplier=1e12),
    UnitDef(("MMBtu",), multiplier=1e6, of="Btu"),
    UnitDef(("kwh", "kWh"), multiplier=1e3, of="watthour"),
    UnitDef(("bkwh",), multiplier=1e9, of="kwh"),
    UnitDef(("short_tons_coal",), multiplier=18875000.0, of="Btu"),
    UnitDef(("cubic_feet",), multiplier=1037.0, of="Btu"),
    UnitDef(("barrelnew",), multiplier=6.011708, of="GJ"),
    UnitDef(("Million_ton_CO2_yr",), base="Million_ton_CO2_yr"),
    UnitDef(("cent",), base="cent"),
    UnitDef(("USD", "US2018D", "dollar", "US_2018_Dollar"), multiplier=100.0, of="cent"),
    UnitDef(("US_2012_Dollar",), multiplier=106.10422 / 101.51688, of="US_2018_Dollar"),
    UnitDef(("US_2016_Dollar",), multiplier=106.10422 / 98.47496, of="US_2018_Dollar"),
    UnitDef(("US_2019_Dollar",), multiplier=106.10422 / 106.43044, of="US_2018_Dollar"),
    UnitDef(("US_2020_Dollar",), multiplier=106.10422 / 103.96754, of="US_2018_Dollar"),
    UnitDef(("US_2021_Dollar",), multiplier=106.10422 / 115.35418, of="US_2018_Dollar"),
    UnitDef(("US_2019_cent",), multiplier=0.01, of="US_2019_Dollar"),
    UnitDef(("US_2020_cent",), multiplier=0.01, of="US_2020_Dollar"),
    UnitDef(("US_2021_cent",), multiplier=0.01, of="US_2021_Dollar"),
]

# ---------------------------------------------------------------------------
# Fixed values. Optional second registry for agricultural / emissions data:
# counting words, count-like base units, hundredweight, bales, kilotonne as
# "kt", CO2-equivalent mass units, kWh as its own base and nominal dollars.
# It replaces the harmonisation set when selected (kWh and dollars differ).
# ---------------------------------------------------------------------------
VARIANT_UNITS = [
    UnitDef(("dozen", "Dozen"), multiplier=12.0),
    UnitDef(("hundred", "Hundred"), multiplier=1e2),
    UnitDef(("thousand", "Thousand"), multiplier=1e3),
    UnitDef(("million", "Million"), multiplier=1e6),
    UnitDef(("billion", "Billion"), multiplier=1e9),
    UnitDef(("trillion", "Trillion"), multiplier=1e12),
    UnitDef(("quadrillion", "Quadrillion"), multiplier=1e15),
    UnitDef(("head",), base="head"),
    UnitDef(("person",), base="person"),
    UnitDef(("capita",), base="capita"),
    UnitDef(("number",), base="number"),
    UnitDef(("hundredweight",), multiplier=100.0, of="pound"),
    UnitDef(("bales",), base="bales"),
    UnitDef(("CO2e",), multiplier=1.0),
    UnitDef(("tCO2e",), multiplier=1.0, of="t CO2e"),
    UnitDef(("MMTCO2e",), multiplier=1e6, of="tCO2e"),
    UnitDef(("gCO2e",), multiplier=1.0, of="g CO2e"),
    UnitDef(("MMT",), multiplier=1e6, of="tonne"),
    UnitDef(("kWh",), base="kWh"),
    UnitDef(("dollars",), base="dollars"),
    UnitDef(("cents",), multiplier=0.01, of="dollars"),
]
# In the variant set "kt" is a kilotonne (the default reading is a knot).
VARIANT_OVERRIDES = {"kt": (1e6, {"kg": 1})}


def _combine(parts):
    scale, dims = 1.0, {}
    for s, d, sign in parts:
        scale = scale * s if sign > 0 else scale / s
        for k, v in d.items():
            dims[k] = dims.get(k, 0) + sign * v
    return scale, {k: v for k, v in dims.items() if v}


def build_unit_table(defs: list[UnitDef], *, prefixes=SI_PREFIXES) -> dict[str, tuple[str, float, dict]]:
    """Resolve definitions in order into ``name -> (kind, scale, dims)``.

    Prefixed forms (``kW``, ``kilowatt``, ``GJ`` ...) are generated from the rule
    prefix x prefixable base; explicit definitions win over generated ones. A name
    that two definitions give is an error.
    """
    table: dict[str, tuple[str, float, dict]] = {}
    generated: dict[str, tuple[str, float, dict]] = {}

    def lookup(tok):
        if tok in table:
            return table[tok]
        if tok in generated:
            return generated[tok]
        raise KeyError(f"unit '{tok}' used before it is defined")

    def resolve_expr(expr):
        sides = expr.split("/")
        parts = []
        for i, side in enumerate(sides):
            for tok in side.split():
                try:
                    parts.append((float(tok), {}, 1 if i == 0 else -1))
                except ValueError:
                    _, s, d = lookup(tok)
                    parts.append((s, d, 1 if i == 0 else -1))
        return _combine(parts)

    for u in defs:
        if u.base is not None:
            scale, dims = u.multiplier, {u.base: 1}
        elif u.of:
            s, d = resolve_expr(u.of)
            scale, dims = u.multiplier * s, dict(d)
        else:
            scale, dims = u.multiplier, dict(u.dims)
        for n in u.names:
            if n in table:
                raise ValueError(f"unit '{n}' is defined more than once")
            table[n] = (u.kind, scale, dims)
        if u.prefixable:
            for psym, pname, pf in prefixes:
                for n in u.names:
                    key = (psym if u.kind == "symbol" else pname) + n
                    generated.setdefault(key, (u.kind, pf * scale, dims))
    for k, v in generated.items():
        table.setdefault(k, v)
    return table


def registry_rows(variant: bool = False, extra: list[UnitDef] | None = None) -> list[tuple]:
    defs = BASE_UNITS + (VARIANT_UNITS if variant else HARMONIZATION_UNITS) + list(extra or [])
    table = build_unit_table(defs)
    if variant:
        for name, (scale, dims) in VARIANT_OVERRIDES.items():
            table[name] = ("symbol", scale, dims)
    return [(n, k, float(s), [(d, int(e)) for d, e in sorted(dm.items())]) for n, (k, s, dm) in table.items()]


def unit_registry(spark: SparkSession, variant: bool = False, extra: list[UnitDef] | None = None) -> DataFrame:
    """The registry as a DataFrame (bounded: a few hundred rows)."""
    return spark.createDataFrame(registry_rows(variant, extra), REGISTRY_SCHEMA)
