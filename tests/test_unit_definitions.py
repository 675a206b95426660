"""Units as data: the definition graph, prefixes before a registry table's units, repeated names."""

import math
import re

import pytest

from conftest import rows
from yearloom.operators.units.algebra import RepeatedUnits, convertibility_classes, repeated_units, resolve_unit_expressions, unit_factor_table, unit_lookup
from yearloom.operators.units.definitions import DEFINITION_SCHEMA, definition_table, prefix_table, resolve_definitions
from yearloom.operators.units.registry import BASE_UNITS, HARMONIZATION_UNITS, SI_PREFIXES, VARIANT_UNITS, UnitDef, build_unit_table, registry_rows
from yearloom.session import DEFAULT_BROADCAST_ROWS


def define(spark, *defs, prefixes=False):
    table = spark.createDataFrame([(n, "name", m, of, base, None, p) for n, m, of, base, p in defs], DEFINITION_SCHEMA)
    units = resolve_definitions(table, prefix_table(spark) if prefixes else None)
    found = {r.name: (r.scale, {d.dim: d.exp for d in r.dims}) for r in units.registry.collect()}
    return found, rows(units.violations)


def test_products_quotients_and_numbers(spark):
    found, bad = define(spark, ("m", 1.0, None, "m", False), ("s", 1.0, None, "s", False), ("speed", 2.0, "m/s", None, False),
                        ("ratio", 1.0, "3 m / m", None, False), ("area", 1.0, "m*m", None, False), ("odd", 5.0, "area speed / 10 s / s", None, False), ("dozen", 12.0, None, None, False))
    assert not bad
    assert found == {"m": (1.0, {"m": 1}), "s": (1.0, {"s": 1}), "speed": (2.0, {"m": 1, "s": -1}), "ratio": (3.0, {}), "area": (1.0, {"m": 2}),
                     "odd": (1.0, {"m": 3, "s": -3}), "dozen": (12.0, {})}


def test_long_chain_takes_few_rounds(spark, monkeypatch):
    from yearloom.operators.units import definitions as D
    n, written = 700, []
    monkeypatch.setattr(D, "materialize", lambda df, keep=D.materialize: written.append(1) or keep(df))
    found, bad = define(spark, ("u0", 1.0, None, "m", False), *[(f"u{k}", 2.0 if k % 2 else 0.5, f"u{k - 1}", None, False) for k in range(1, n)])
    assert not bad and len(found) == n and all(found[f"u{k}"] == (2.0 if k % 2 else 1.0, {"m": 1}) for k in range(n))
    assert len(written) <= 6 + n.bit_length() + 1


def test_cycles_unknown_and_repeated_names(spark):
    found, bad = define(spark, ("m", 1.0, None, "m", False), ("a", 2.0, "b", None, False), ("b", 3.0, "c c", None, False), ("c", 1.0, "a m", None, False),
                        ("leads", 1.0, "m/a", None, False), ("self", 1.0, "self", None, False), ("gone", 1.0, "m nowhere", None, False), ("far", 2.0, "gone", None, False),
                        ("twice", 1.0, "m", None, False), ("twice", 2.0, "m", None, False), ("uses", 1.0, "twice", None, False), (None, 1.0, "m", None, False), ("fine", 4.0, "m", None, False))
    assert set(found) == {"m", "fine"}
    assert set(bad) == {(x, "cycle", None) for x in ("a", "b", "c", "leads", "self")} | {
        ("gone", "unknown", "nowhere"), ("far", "unknown", "nowhere"), ("twice", "repeated", None), ("uses", "unknown", "twice"), (None, "unnamed", "m")}


def test_prefixed_tokens_in_definitions(spark):
    found, bad = define(spark, ("m", 1.0, None, "m", True), ("s", 1.0, None, "s", False), ("x", 2.0, "kilom/s", None, False), ("kilom", 7.0, "m", None, False),
                        ("y", 1.0, "megam", None, False), ("z", 1.0, "kilos", None, False), prefixes=True)
    assert found["x"] == (14.0, {"m": 1, "s": -1}) and found["y"] == (1e6, {"m": 1})  # an exact name comes first
    assert bad == [("z", "unknown", "kilos")]


def test_empty_table(spark):
    units = resolve_definitions(spark.createDataFrame([], DEFINITION_SCHEMA))
    assert units.registry.count() == 0 and units.violations.count() == 0


@pytest.mark.parametrize("defs", [BASE_UNITS + HARMONIZATION_UNITS, BASE_UNITS + VARIANT_UNITS])
def test_built_in_definitions_as_data(spark, defs):
    units = resolve_definitions(definition_table(spark, defs), prefix_table(spark))
    assert rows(units.violations) == []
    want = build_unit_table(defs, prefixes=SI_PREFIXES)
    got = {r.name: r for r in units.registry.collect()}
    assert set(got) == {n for u in defs for n in u.names}
    for n, r in got.items():
        assert math.isclose(r.scale, want[n][1], rel_tol=1e-14) and {d.dim: d.exp for d in r.dims} == want[n][2] and r.kind == want[n][0]


PAIRS = [("quadrillion Btu", "EJ"), ("MILLION Barrelnews", "GJ"), ("GW", "EJ"), ("furlong", "EJ"), ("cents/kwh", "US_2018_Dollar/GJ"), ("", "EJ"),
         ("2 million", "thousand"), ("Kilowatts", "GW"), ("kilowatt hours", "EJ"), ("dam", "m"), ("Gs", "s"), ("MMBtus", "TJ"), ("kt", "Mt"), ("kilot", "Mt"), ("mmol", "mole")]


def test_registry_table_with_prefixes_agrees_with_the_list(spark):
    units = resolve_definitions(definition_table(spark, BASE_UNITS + HARMONIZATION_UNITS), prefix_table(spark))
    table = unit_lookup(units.registry, prefixes=prefix_table(spark))
    pairs = spark.createDataFrame(PAIRS, "from_unit string, to_unit string")
    got, want = ({(r.from_unit, r.to_unit): r.factor for r in unit_factor_table(pairs, rename_fun=lambda c: c, registry=x).collect()} for x in (table, None))
    assert got.keys() == want.keys()
    for k, f in want.items():
        assert (got[k] is None) == (f is None) and (f is None or math.isclose(got[k], f, rel_tol=1e-12)), k
    assert sum(f is not None for f in want.values()) >= 10


def test_repeated_names_are_refused(spark):
    twice = [*registry_rows(), ("GW", "symbol", 5.0, [("m", 1)])]
    table = spark.createDataFrame([(n, k, float(s), [{"dim": d, "exp": int(e)} for d, e in dims]) for n, k, s, dims in twice],
                                  "name string, kind string, scale double, dims array<struct<dim:string,exp:int>>")
    assert rows(repeated_units(table)) == [("GW", 2)]
    for registry in (twice, table):
        with pytest.raises(RepeatedUnits, match="GW"):
            unit_lookup(registry)
    with pytest.raises(ValueError, match="quad"):
        unit_lookup(extra=[UnitDef(("quad",), 1e15, "Btu"), UnitDef(("quad",), 2e15, "Btu")])


def test_registry_tables_are_not_broadcast(spark, monkeypatch):
    """However small they look when they have more rows than may be broadcast: only the prefixes go through the driver."""
    from yearloom.operators.units import algebra as A
    plans = []
    monkeypatch.setattr(A, "DEFAULT_BROADCAST_ROWS", 0, raising=False)
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(A, "materialize", lambda df, keep=A.materialize: plans.append(plan(df)) or keep(df))
    registry = spark.range(40).selectExpr("concat('u', id) as name", "if(id % 2 = 0, 'symbol', 'name') as kind", "id + 1D as scale",
                                          "array(struct('m' as dim, 1 as exp)) as dims", "id % 5 <> 0 as prefixable")
    pairs = spark.range(400).selectExpr("concat(element_at(array('', 'k', 'Kilo', 'mega'), int(id % 4) + 1), 'u', id % 50, if(id % 3 = 0, 's', '')) as from_unit", "'u3' as to_unit")
    out = unit_factor_table(pairs, rename_fun=lambda c: c, registry=unit_lookup(registry, prefixes=prefix_table(spark)))
    plans.append(plan(out))
    joins = [line for p in plans for line in p.split("\n") if "Join" in line]
    assert len(joins) >= 6 and all("prefix" in line for line in joins if "Broadcast" in line)
    got = {r.from_unit: r.factor for r in out.collect()}
    assert len(got) == pairs.distinct().count()
    for unit, factor in got.items():
        prefix, k = unit.rstrip("s").split("u")
        symbol, takes = int(k) % 2 == 0, int(k) % 5 != 0
        times = {"": 1.0, "k": 1e3 if symbol and takes else None, "Kilo": 1e3 if not symbol and takes else None, "mega": 1e6 if not symbol and takes else None}[prefix]
        assert factor == (None if times is None or int(k) >= 40 else times * (int(k) + 1) / 4), unit


def test_factors_of_many_units_hold_no_broadcast_table(spark, monkeypatch):
    """A registry of more rows than may be broadcast, whose written size is small: no task holds one of its tables whole."""
    from yearloom.operators.units import algebra as A
    n, plans = DEFAULT_BROADCAST_ROWS + 1000, []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(A, "materialize", lambda df, keep=A.materialize: plans.append(plan(df)) or keep(df))
    registry = spark.range(n).selectExpr("concat('u', id) as name", "'name' as kind", "id % 50 + 1D as scale", "array(struct(if(id % 2 = 0, 'm', 's') as dim, 1 as exp)) as dims")
    pairs = spark.range(2 * n).selectExpr(f"concat('U', id % {n + 7}, 's') as from_unit", "concat('u', id % 1000) as to_unit")
    out = unit_factor_table(pairs, rename_fun=lambda c: c, registry=registry)
    got = {(r.from_unit, r.to_unit): r.factor for r in out.collect()}
    plans.append(plan(out))
    assert sum("ShuffledHashJoin" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)
    want = {(i % (n + 7), i % 1000) for i in range(2 * n)}
    assert got == {(f"U{a}s", f"u{b}"): (a % 50 + 1) / (b % 50 + 1) if a < n and a % 2 == b % 2 else None for a, b in want}


EXPRESSIONS = ["m", "m s/kg", "2 m*m / s / 4 kg", "m/m", "nowhere m/gone", "", " / s", "3", "m//s", "m m m m m", "m s kg m s / m s kg gone 2 m", "m*s*kg/2/s/kg", "/", "s/s s s s s s", None]


@pytest.mark.parametrize("broadcast_rows", [0, 50_000])
def test_expressions_by_a_table_agree_with_the_list(spark, monkeypatch, broadcast_rows):
    """Short and long ones, numbers, unknown tokens, empty sides; and classes in which no expression's tokens are gathered by a shuffle."""
    from yearloom.operators.units import algebra as A
    plans = []
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(A, "materialize", lambda df, keep=A.materialize: plans.append(plan(df)) or keep(df))
    monkeypatch.setattr(A, "DEFAULT_BROADCAST_ROWS", broadcast_rows, raising=False)
    units = [("m", "name", 2.0, [("m", 1)]), ("s", "name", 3.0, [("s", 1)]), ("kg", "symbol", 5.0, [("kg", 1), ("m", 2)])]
    table = spark.createDataFrame([(n, k, x, [{"dim": d, "exp": e} for d, e in dims]) for n, k, x, dims in units],
                                  "name string, kind string, scale double, dims array<struct<dim:string,exp:int>>")
    exprs = spark.createDataFrame([(e,) for e in EXPRESSIONS], "expr string")
    assert rows(resolve_unit_expressions(exprs, registry=table)) == rows(resolve_unit_expressions(exprs, registry=units))
    short = spark.createDataFrame([(e,) for e in EXPRESSIONS if e is None or len(re.findall(r"[^\s*/]+", e)) <= A.JOINED_TOKENS], "unit string")
    want = rows(convertibility_classes(short, rename_fun=lambda c: c, registry=units))
    plans.clear()
    out = convertibility_classes(short, rename_fun=lambda c: c, registry=table)
    assert rows(out) == want and len(want) == short.where("unit is not null").count()
    assert not any("collect_list" in p for p in plans)
