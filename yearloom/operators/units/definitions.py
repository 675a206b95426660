"""Unit definitions as a table (U1): the graph "this unit is so many of those" resolved to base dimensions.

A definition is a row ``name, kind, multiplier, of`` and, optionally, ``base``, ``dims`` and
``prefixable``: the unit is ``multiplier`` times the unit expression ``of`` (as in
``units.algebra``: tokens are numbers, defined names, or a prefix and a prefixable name), or
``multiplier`` of a base dimension of its own (``base``), or of a product of dimensions
(``dims``: name -> exponent); with none of them it is a plain number.

Every unit is held as a scale and a product of powers of others. A round replaces each factor by
that unit's own product, for all units at once: chains shorten by half, so a definition that is
``d`` steps from its base dimensions takes ``log2(d)`` rounds of one equi-join, whatever the number
of definitions. A round that finishes no unit leaves only cycles, and is the last. Nothing is
collected but counts.

What can't be resolved comes out as violations (``name, problem, detail``): ``unnamed``;
``repeated`` (a name with more than one row; none of them counts); ``unknown`` (``detail``: a name
that no row defines, met directly or on the way); ``cycle`` (a unit that leads to itself, or to
such a unit).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.operators.units.algebra import NUMBER_TOKEN, prefix_splits, unit_tokens
from yearloom.operators.units.registry import SI_PREFIXES, UnitDef
from yearloom.session import materialize

DEFINITION_SCHEMA = "name string, kind string, multiplier double, of string, base string, dims map<string,int>, prefixable boolean"


@dataclass
class ResolvedUnits:
    """``registry`` (name, kind, scale, dims, prefixable) serves wherever a registry table is taken; ``violations`` lists the rest."""

    registry: DataFrame
    violations: DataFrame


def definition_table(spark: SparkSession, defs: list[UnitDef]) -> DataFrame:
    """Definitions given as a list, one row a name."""
    return spark.createDataFrame([(n, u.kind, float(u.multiplier), u.of or None, u.base, dict(u.dims) or None, u.prefixable)
                                  for u in defs for n in u.names], DEFINITION_SCHEMA)


def prefix_table(spark: SparkSession, prefixes=SI_PREFIXES) -> DataFrame:
    """``prefix, kind, factor``: symbols go before symbols, names before names."""
    return spark.createDataFrame([(t, kind, float(f)) for symbol, name, f in prefixes for t, kind in ((symbol, "symbol"), (name, "name"))],
                                 "prefix string, kind string, factor double")


def _definitions(table: DataFrame) -> DataFrame:
    optional = {"kind": ("string", "name"), "multiplier": ("double", 1.0), "prefixable": ("boolean", False),
                "of": ("string", None), "base": ("string", None), "dims": ("map<string,int>", None)}
    cols = [F.col("name").cast("string").alias("name")]
    for c, (kind, default) in optional.items():
        own = F.col(c).cast(kind) if c in table.columns else F.lit(None).cast(kind)
        cols.append((own if default is None else F.coalesce(own, F.lit(default))).alias(c))
    return table.select(*cols)


def resolve_definitions(definitions: DataFrame, prefixes: DataFrame | None = None) -> ResolvedUnits:
    """Resolve a table of definitions; ``prefixes`` as by ``prefix_table`` (none: no prefixed names)."""
    every = materialize(_definitions(definitions))
    counted = every.where("name is not null").groupBy("name").agg(F.count("*").alias("n"))
    defs = materialize(every.join(counted.where("n = 1").select("name"), "name"))
    n_defs = defs.count()

    # the tokens of each definition: its numbers, and the defined units they name
    tokens = defs.where("of is not null and base is null and dims is null").select("name", F.explode(unit_tokens(F.col("of"))).alias("t")).select("name", "t.*")
    number = F.when(F.col("tok").rlike(NUMBER_TOKEN), F.col("tok").try_cast("double"))
    tokens = tokens.withColumn("number", number)
    asked = tokens.where("number is null").select("tok").distinct()
    named = defs.select(F.col("name").alias("unit"), "kind", "prefixable")
    known = asked.join(named.select("unit"), F.col("tok") == F.col("unit"), "left").withColumn("factor", F.lit(1.0))
    if prefixes is not None:
        split = prefix_splits(known.where("unit is null").select("tok"), "tok", prefixes, named)
        known = known.join(split.withColumnsRenamed({"unit": "part", "factor": "times"}), "tok", "left").select(
            "tok", F.coalesce("unit", "part").alias("unit"), F.when(F.col("unit").isNull(), F.coalesce("times", F.lit(1.0))).otherwise(F.lit(1.0)).alias("factor"))
    terms = tokens.join(known, "tok", "left")
    # kinds of parts: a dimension, an unknown name, and a unit still to be replaced
    part = F.struct(F.coalesce("unit", "tok").alias("target"), F.when(F.col("unit").isNull(), "unknown").otherwise("unit").alias("kind"),
                    F.col("sign").cast("double").alias("exp"))
    direct = terms.groupBy("name").agg(F.product(F.pow(F.coalesce("number", "factor"), F.col("sign").cast("double"))).alias("f"),
                                       F.collect_list(F.when(F.col("number").isNull(), part)).alias("parts"))
    dims = F.when(F.col("base").isNotNull(), F.create_map("base", F.lit(1))).otherwise(F.col("dims"))
    ends = F.transform(F.map_entries(dims), lambda d: F.struct(d["key"].alias("target"), F.lit("dimension").alias("kind"), d["value"].cast("double").alias("exp")))
    state = materialize(defs.join(direct, "name", "left").select(
        "name", (F.col("multiplier") * F.coalesce("f", F.lit(1.0))).alias("scale"), _like_parts(F.coalesce("parts", ends, F.expr(NO_PARTS))).alias("parts")))

    # a unit of depth d is done once 2 ** round reaches d, and depths have no gaps: a round that finishes no unit leaves only cycles
    still = n_defs + 1
    while True:
        open_ = state.where(F.exists("parts", lambda p: p["kind"] == "unit")).count()
        if not open_ or open_ == still:
            break
        still = open_
        of = state.select(F.col("name").alias("target"), F.lit("unit").alias("kind"), F.col("scale").alias("s"), F.col("parts").alias("inner"))
        each = state.select("name", "scale", F.explode_outer("parts").alias("p")).select("name", "scale", "p", "p.target", "p.kind")
        met = each.join(of, ["target", "kind"], "left")
        power = F.col("p")["exp"]
        inside = F.transform("inner", lambda q: F.struct(q["target"].alias("target"), q["kind"].alias("kind"), (q["exp"] * power).alias("exp")))
        now = F.when(F.col("s").isNotNull(), inside).when(F.col("p").isNotNull(), F.array("p")).otherwise(F.expr(NO_PARTS))
        state = materialize(met.groupBy("name").agg(
            (F.first("scale") * F.product(F.when(F.col("s").isNotNull(), F.pow("s", power)).otherwise(F.lit(1.0)))).alias("scale"),
            _like_parts(F.flatten(F.collect_list(now))).alias("parts")))

    each = state.select("name", F.explode("parts").alias("p")).select("name", "p.target", "p.kind")
    nothing = F.lit(None).cast("string")
    problems = (counted.where("n > 1").select("name", F.lit("repeated").alias("problem"), nothing.alias("detail"))
                .unionByName(every.where("name is null").select("name", F.lit("unnamed").alias("problem"), F.col("of").alias("detail")))
                .unionByName(each.where("kind = 'unknown'").select("name", F.lit("unknown").alias("problem"), F.col("target").alias("detail")))
                .unionByName(each.where("kind = 'unit'").select("name").distinct().select("name", F.lit("cycle").alias("problem"), nothing.alias("detail"))))
    whole = state.where(F.forall("parts", lambda p: p["kind"] == "dimension")).select("name", "scale", F.array_sort(F.transform(
        "parts", lambda p: F.struct(p["target"].alias("dim"), p["exp"].cast("int").alias("exp")))).alias("dims"))
    registry = defs.select("name", "kind", "prefixable").join(whole, "name").select("name", "kind", "scale", "dims", "prefixable")
    return ResolvedUnits(materialize(registry), materialize(problems))


NO_PARTS = "cast(array() as array<struct<target:string,kind:string,exp:double>>)"


def _like_parts(parts: Column) -> Column:
    """Like factors of a unit together; those that cancel go (exponents as doubles: a cycle may double them every round)."""
    kinds = F.array_distinct(F.transform(parts, lambda p: F.struct(p["target"].alias("target"), p["kind"].alias("kind"))))
    summed = F.transform(kinds, lambda k: F.struct(k["target"].alias("target"), k["kind"].alias("kind"), F.aggregate(
        F.filter(parts, lambda p: (p["target"] == k["target"]) & (p["kind"] == k["kind"])), F.lit(0.0), lambda x, p: x + p["exp"]).alias("exp")))
    return F.filter(summed, lambda p: p["exp"] != 0)
