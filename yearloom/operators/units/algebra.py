"""Unit algebra (U2, U3) as native expressions over *distinct* unit strings.

A unit expression is ``num [/ den [/ den ...]]``; each side is a product of
tokens separated by blanks or ``*``. A token is a number or a registry unit.
Token lookup, in priority order: exact name; exact name minus a trailing plural
``s``; then, for units registered as names, the same two case-insensitively
(only where the lower-case spelling is unambiguous).

The scale of an expression is the product of numerator scales (left to right,
starting at 1.0) divided by the product of denominator scales; its dimension is
the sum of token dimensions (denominators negated). A factor from ``a`` to ``b``
is ``scale(a) / scale(b)``, defined when their dimensions are equal.

The registry is bounded (a few hundred units), so it enters the plan as four
literal lookup maps; resolving a unit is then one projection of higher-order
functions (``split`` / ``transform`` / ``filter`` / ``aggregate``) - no join, no
shuffle. It is applied to distinct unit strings only, never per fact row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yearloom.functions.unit_names import standardize_unit_names
from yearloom.operators.units.registry import UnitDef, registry_rows
from yearloom.session import DEFAULT_BROADCAST_ROWS, broadcast_checked, materialize, row_count_at_most

_TOKEN_SPLIT = r"[\s*]+"
NUMBER_TOKEN = r"^[0-9.]+([eE][+-]?[0-9]+)?$"
DIMS_TYPE = "array<struct<dim:string,exp:int>>"
JOINED_TOKENS = 4  # tokens of an expression that are looked up in place; a join each


def _dims_text(dims) -> str:
    return "|".join(f"{d}:{e}" for d, e in dims)


@dataclass(frozen=True)
class UnitLookup:
    """The registry as literal key/value arrays (exact names, and unambiguous
    lower-case spellings of ``name``-kind units)."""

    exact_keys: tuple
    exact_scales: tuple
    exact_dims: tuple
    ci_keys: tuple
    ci_scales: tuple
    ci_dims: tuple

    @classmethod
    def from_rows(cls, rows) -> UnitLookup:
        exact = {}
        for name, kind, scale, dims in rows:
            if name in exact:
                raise RepeatedUnits(f"units defined more than once: {name}")
            exact[name] = (float(scale), _dims_text(sorted((d, int(e)) for d, e in dims)), kind)
        lowered: dict[str, set] = {}
        for name, (scale, dims, kind) in exact.items():
            if kind == "name":
                lowered.setdefault(name.lower(), set()).add((scale, dims))
        ci = {k: next(iter(v)) for k, v in lowered.items() if len(v) == 1}
        ek = sorted(exact)
        ck = sorted(ci)
        return cls(tuple(ek), tuple(exact[k][0] for k in ek), tuple(exact[k][1] for k in ek),
                   tuple(ck), tuple(ci[k][0] for k in ck), tuple(ci[k][1] for k in ck))

    def maps(self):
        # Each array is one delimited string literal split by Spark (constant-
        # folded by the optimizer), instead of one literal per element.
        sep = "\u001f"

        def arr(items, vtype):
            if not items:
                return F.array().cast(f"array<{vtype}>")
            return F.split(F.lit(sep.join(items)), sep).cast(f"array<{vtype}>")

        def m(keys, vals, vtype):
            texts = [repr(v) for v in vals] if vtype == "double" else list(vals)
            return F.map_from_arrays(arr(list(keys), "string"), arr(texts, vtype))
        return (m(self.exact_keys, self.exact_scales, "double"), m(self.exact_keys, self.exact_dims, "string"),
                m(self.ci_keys, self.ci_scales, "double"), m(self.ci_keys, self.ci_dims, "string"))


@dataclass(frozen=True)
class RegistryTable:
    """A registry as a table (name, kind, scale, dims and, if units take prefixes, prefixable) of any size, and its prefixes."""

    units: DataFrame
    prefixes: DataFrame | None = None


class RepeatedUnits(ValueError):
    """A registry that holds a name more than once."""


def unit_lookup(registry=None, *, variant: bool = False, extra: list[UnitDef] | None = None, prefixes: DataFrame | None = None):
    """Build the lookup from the built-in registry (plus ``extra`` definitions) or
    from a list of registry rows. With a registry DataFrame (name, kind, scale, dims)
    units are resolved by joins with it, at any size; units it marks ``prefixable`` also
    with the ``prefixes`` (prefix, kind, factor) given. A name that occurs twice, in a
    list or a table, is refused: which of its meanings counts would be an accident."""
    if isinstance(registry, (UnitLookup, RegistryTable)):
        return registry
    if isinstance(registry, DataFrame):
        twice = [r["name"] for r in repeated_units(registry).orderBy("name").limit(10).collect()]
        if twice:
            raise RepeatedUnits(f"units defined more than once: {', '.join(map(str, twice))}")
        return RegistryTable(registry, prefixes)
    if registry is None:
        return UnitLookup.from_rows(registry_rows(variant, extra))
    return UnitLookup.from_rows(registry)


def token_lists(expr: Column) -> tuple[Column, Column]:
    """The tokens above and below the line of a unit expression, as arrays of text."""
    def tokens(side: Column) -> Column:
        return F.array_remove(F.split(side, _TOKEN_SPLIT), "")

    expr = F.coalesce(expr, F.lit(""))
    below = F.expr("cast(array() as array<string>)")
    at = F.instr(expr, "/")
    return tokens(F.substring_index(expr, "/", 1)), F.when(at > 0, tokens(F.translate(F.substring(expr, at + 1, F.length(expr)), "/", " "))).otherwise(below)


def unit_tokens(expr: Column) -> Column:
    """array<struct<tok string, sign int>> for a unit expression."""
    above, below = token_lists(expr)
    return F.concat(F.transform(above, lambda t: F.struct(t.alias("tok"), F.lit(1).alias("sign"))),
                    F.transform(below, lambda t: F.struct(t.alias("tok"), F.lit(-1).alias("sign"))))


def _lookup_token(tok: Column, maps) -> Column:
    """struct<scale double, dims string> for one token, or NULL if unknown."""
    ex_s, ex_d, ci_s, ci_d = maps
    single = F.regexp_replace(tok, "s$", "")
    numeric = F.when(tok.rlike(NUMBER_TOKEN), tok.try_cast("double"))
    cands = [(ex_s, ex_d, tok), (ex_s, ex_d, single), (ci_s, ci_d, F.lower(tok)), (ci_s, ci_d, F.lower(single))]
    out = F.when(numeric.isNotNull(), F.struct(numeric.alias("scale"), F.lit("").alias("dims")))
    for ms, md, k in cands:
        out = out.when(F.map_contains_key(ms, k),
                       F.struct(F.element_at(ms, k).alias("scale"), F.element_at(md, k).alias("dims")))
    return out


def _parse_dims(text: Column) -> Column:
    parts = F.filter(F.split(text, r"\|"), lambda x: x != "")
    return F.transform(parts, lambda x: F.struct(F.split(x, ":").getItem(0).alias("dim"),
                                                 F.split(x, ":").getItem(1).cast("int").alias("exp")))


def _resolved_tokens(expr: Column, maps) -> Column:
    """array<struct<tok, sign, m: struct<scale, dims text>>> for an expression."""
    return F.transform(unit_tokens(expr), lambda t: F.struct(t["tok"].alias("tok"), t["sign"].alias("sign"),
                                                         _lookup_token(t["tok"], maps).alias("m")))


def _summed(flat: Column) -> Column:
    """Dimensions of a list with repeats: each once, sorted, without those that cancel."""
    names = F.sort_array(F.array_distinct(flat["dim"]))
    summed = F.transform(names, lambda n: F.struct(
        n.alias("dim"),
        F.aggregate(F.filter(flat, lambda d: d["dim"] == n), F.lit(0), lambda a, d: a + d["exp"]).alias("exp")))
    return F.filter(summed, lambda d: d["exp"] != 0).cast(DIMS_TYPE)


def _summarize(toks: Column) -> Column:
    """Scale, dims and unknown tokens from resolved tokens (see module doc)."""
    def prod(sign: int) -> Column:
        side = F.filter(toks, lambda t: t["sign"] == sign)
        return F.aggregate(side, F.lit(1.0).cast("double"), lambda acc, t: acc * t["m"]["scale"])

    unresolved = F.transform(F.filter(toks, lambda t: t["m"].isNull()), lambda t: t["tok"])
    flat = F.flatten(F.transform(toks, lambda t: F.transform(
        _parse_dims(F.coalesce(t["m"]["dims"], F.lit(""))),
        lambda d: F.struct(d["dim"].alias("dim"), (d["exp"] * t["sign"]).alias("exp")))))
    return F.struct(F.when(F.size(unresolved) == 0, prod(1) / prod(-1)).alias("scale"),
                    _summed(flat).alias("dims"),
                    unresolved.alias("unresolved"))


_EXPR_CACHE: dict = {}


def _cached(kind: str, col: str, lookup: UnitLookup) -> Column:
    """The resolution expressions are large trees of higher-order functions; they
    are unresolved (bound by column name), so each is built once per Spark
    application and registry and reused by every query."""
    from pyspark.sql import SparkSession

    session = SparkSession.getActiveSession()
    key = (session.sparkContext.applicationId if session else None, kind, col, lookup)
    hit = _EXPR_CACHE.get(key)
    if hit is None:
        if len(_EXPR_CACHE) >= 64:
            _EXPR_CACHE.clear()
        hit = _resolved_tokens(F.col(col), lookup.maps()) if kind == "tokens" else _summarize(F.col(col))
        _EXPR_CACHE[key] = hit
    return hit


def with_resolved_many(df: DataFrame, specs: list[tuple[str, str]], lookup: UnitLookup) -> DataFrame:
    """Add, for each ``(expr_col, out_col)``, ``out_col`` = struct<scale, dims,
    unresolved> of the unit expression in ``expr_col``. Two projections: the token
    lookup is computed once per row and then referenced (Catalyst does not inline
    a non-cheap expression that is used several times). With a registry DataFrame
    the distinct expressions are resolved by joins and joined back."""
    if isinstance(lookup, RegistryTable):
        asked = df.select(F.explode(F.array_distinct(F.array(*[F.coalesce(F.col(e), F.lit("")) for e, _ in specs]))).alias("__e")).distinct()
        done = _by_rows(materialize(_with_resolved_rows(asked, "__e", "__r", lookup)))
        for e, o in specs:
            df = df.join(done.withColumnRenamed("__r", o), F.coalesce(F.col(e), F.lit("")) == F.col("__e"), "left").drop("__e")
        return df
    toks = [_cached("tokens", e, lookup).alias(f"__toks_{o}") for e, o in specs]
    step = df.select("*", *toks)
    outs = [_cached("summary", f"__toks_{o}", lookup).alias(o) for _, o in specs]
    return step.select(*df.columns, *outs)


def prefix_cuts(tokens: DataFrame, tok_col: str, prefixes: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """``tokens`` by every beginning that is a prefix: with its length ``k``, the ``unit`` after it, and the prefix's ``kind`` and
    ``factor``. ``prefixes`` (``prefix, kind, factor``) match in the columns ``by`` too; few, they are broadcast after a size check."""
    longest = prefixes.agg(F.max(F.length("prefix"))).first()[0] or 0
    ends = F.sequence(F.lit(1), F.least(F.lit(longest), F.length(tok_col) - 1)) if longest else F.expr("cast(array() as array<int>)")
    cut = tokens.where(F.length(tok_col) > 1).select("*", F.explode(ends).alias("k"))
    cut = cut.select("*", F.expr(f"substring(`{tok_col}`, 1, k)").alias("prefix"), F.expr(f"substring(`{tok_col}`, k + 1)").alias("unit"))
    return cut.join(broadcast_checked(prefixes.select(*by, "prefix", "kind", "factor")), [*by, "prefix"]).drop("prefix")


def prefix_splits(tokens: DataFrame, tok_col: str, prefixes: DataFrame, units: DataFrame) -> DataFrame:
    """``tok_col, unit, factor`` of the tokens that are a prefix and a prefixable unit of the prefix's kind; the longest prefix counts.
    Every beginning of a token meets the prefixes (``prefix, kind, factor``), and its rest the ``units`` (``unit, kind, prefixable``)."""
    found = prefix_cuts(tokens.select(tok_col), tok_col, prefixes).join(shuffled(units.where("prefixable").select("unit", "kind")), ["unit", "kind"])
    return found.groupBy(tok_col).agg(F.max_by(F.struct("unit", "factor"), F.struct("k", "unit")).alias("u")).select(tok_col, "u.unit", "u.factor")


def shuffled(table: DataFrame) -> DataFrame:
    """The side of a join that has a row a key and grows with the registry: hashed by partition. Its written size says little of its
    size in memory, by which a broadcast would fill the driver."""
    return table.hint("shuffle_hash")


def _by_rows(table: DataFrame) -> DataFrame:
    """A written side of a join: broadcast if its rows are few, else as by ``shuffled``."""
    return F.broadcast(table) if row_count_at_most(table, DEFAULT_BROADCAST_ROWS) else shuffled(table)


def repeated_units(registry: DataFrame) -> DataFrame:
    """U1 check: names that a registry table holds more than once (``name, n_rows``)."""
    return registry.groupBy("name").agg(F.count("*").alias("n_rows")).where("n_rows > 1")


def _registry_lookup(registry: DataFrame) -> DataFrame:
    """(mode, key, scale, dims text, kind, prefixable) rows: exact names, and lower-case spellings of ``name`` units where all that
    share one agree. Written once: both sides of a factor, and every spelling, read it."""
    dims = F.array_join(F.transform(F.array_sort(F.transform("dims", lambda d: F.struct(d["dim"].alias("dim"), d["exp"].alias("exp")))),
                                    lambda d: F.concat(d["dim"], F.lit(":"), d["exp"].cast("string"))), "|")
    prefixable = F.coalesce("prefixable", F.lit(False)) if "prefixable" in registry.columns else F.lit(False)
    exact = registry.select("name", F.col("scale").cast("double").alias("scale"), dims.alias("dims"), "kind", prefixable.alias("prefixable"))
    unit = F.struct("scale", "dims", "prefixable")
    folded = exact.where("kind = 'name'").groupBy(F.lower("name").alias("key")).agg(F.min(unit).alias("a"), F.max(unit).alias("b")).where("a = b")
    return materialize(exact.select(F.lit("exact").alias("mode"), F.col("name").alias("key"), "scale", "dims", "kind", "prefixable").unionByName(
        folded.select(F.lit("folded").alias("mode"), "key", "a.scale", "a.dims", F.lit("name").alias("kind"), "a.prefixable")))


def _token_units(tokens: DataFrame, registry: DataFrame, prefixes: DataFrame | None) -> DataFrame:
    """``tok, scale, dims`` of distinct tokens that a registry table resolves: by the exact name; then, for the rest of the tokens, with
    a prefix, without a plural ``s`` (and with a prefix), and the same in lower case. The first in this order counts."""
    lookup = _registry_lookup(registry)
    exact = lookup.where("mode = 'exact'").select(F.col("key").alias("tok"), "scale", "dims")
    first = materialize(tokens.join(shuffled(exact), "tok", "left"))
    done, rest = first.where("scale is not null"), first.where("scale is null").select("tok")
    if rest.isEmpty():
        return done
    single = F.regexp_replace("tok", "s$", "")
    spellings = F.array(*[F.struct(F.lit(2 * k).alias("rank"), F.lit(m).alias("mode"), t.alias("key")) for k, (m, t) in enumerate((
        ("exact", F.col("tok")), ("exact", single), ("folded", F.lower("tok")), ("folded", F.lower(single))))])
    asked = rest.select("tok", F.explode(spellings).alias("s")).select("tok", "s.*").where(F.col("rank").isin(0, 4) | (single != F.col("tok")))
    tried = asked.select("tok", "rank", F.lit(0).alias("k"), "mode", "key", F.lit(None).cast("string").alias("before"), F.lit(1.0).alias("factor"))
    if prefixes is not None and "prefixable" in registry.columns:
        forms = prefixes.select(F.lit("exact").alias("mode"), "prefix", "kind", "factor").unionByName(
            prefixes.where("kind = 'name'").select(F.lit("folded").alias("mode"), F.lower("prefix").alias("prefix"), "kind", "factor"))
        tried = tried.unionByName(prefix_cuts(asked, "key", forms, ("mode",)).select(
            "tok", (F.col("rank") + 1).alias("rank"), "k", "mode", F.col("unit").alias("key"), F.col("kind").alias("before"), "factor"))
    found = tried.join(shuffled(lookup), ["mode", "key"]).where("before is null or (prefixable and kind = before)")
    best = found.groupBy("tok").agg(F.min(F.struct("rank", -F.col("k"), (F.col("factor") * F.col("scale")).alias("scale"), "dims")).alias("u")).select("tok", "u.scale", "u.dims")
    return done.unionByName(best)


def _with_resolved_rows(df: DataFrame, expr_col: str, out_col: str, lookup: RegistryTable) -> DataFrame:
    """``with_resolved`` by joins, row by row; each distinct token is looked up once. Expressions of up to ``JOINED_TOKENS`` tokens stay
    rows: the first tokens of all meet the units in one join, then the second ones. Those of longer ones are gathered by expression."""
    kept, expr = [F.col(c) for c in df.columns], F.coalesce(F.col(expr_col), F.lit(""))
    above, below = token_lists(expr)
    rows = materialize(df.select("*", F.concat(above, below).alias("__t"), F.size(above).alias("__above")))
    longest = rows.agg(F.max(F.size("__t"))).first()[0] or 0
    number = lambda t: F.when(t.rlike(NUMBER_TOKEN), t.try_cast("double"))
    names = rows.select(F.explode("__t").alias("tok")).where(number(F.col("tok")).isNull()).distinct()
    dims = _summed(_parse_dims(F.col("dims")))
    over = F.transform(dims, lambda d: F.struct(d["dim"].alias("dim"), (-d["exp"]).alias("exp")))
    units = materialize(_token_units(names, lookup.units, lookup.prefixes).where("scale is not null").select(
        F.col("tok").alias("__unit"), F.struct("scale", dims.alias("dims"), over.alias("over")).alias("__u")))
    units = _by_rows(units)

    # scales above and below the line, dimensions and unknown tokens, token by token
    met = {"__num": F.lit(1.0), "__den": F.lit(1.0), "__dims": F.expr(f"cast(array() as {DIMS_TYPE})"), "__unknown": F.expr("cast(array() as array<string>)")}
    short = (rows.where(F.size("__t") <= JOINED_TOKENS) if longest > JOINED_TOKENS else rows).withColumns(met)
    for k in range(min(longest, JOINED_TOKENS)):
        tok, top = F.get("__t", F.lit(k)), F.col("__above") > k
        asked = short.withColumn("__n", number(tok))
        # rows that ask for nothing are dealt out by their expression: no token has a slash
        key = F.when(F.col("__n").isNull() & tok.isNotNull(), tok).otherwise(F.concat(F.lit("/"), expr))
        asked = asked.withColumn("__key", key).join(units, F.col("__key") == F.col("__unit"), "left")
        scale, known = F.coalesce("__n", "__u.scale", F.lit(1.0)), tok.isNull() | F.col("__n").isNotNull() | F.col("__unit").isNotNull()
        short = asked.select(
            *kept, "__t", "__above", F.when(top, F.col("__num") * scale).otherwise(F.col("__num")).alias("__num"),
            F.when(top, F.col("__den")).otherwise(F.col("__den") * scale).alias("__den"),
            F.when(F.col("__unit").isNull(), F.col("__dims")).otherwise(F.concat("__dims", F.when(top, F.col("__u.dims")).otherwise(F.col("__u.over")))).alias("__dims"),
            F.when(known, F.col("__unknown")).otherwise(F.concat("__unknown", F.array(tok))).alias("__unknown"))
    result = [*kept, *met]
    out = short.select(*result)
    if longest > JOINED_TOKENS:
        long = rows.where(F.size("__t") > JOINED_TOKENS)
        each = long.select(expr.alias("__x"), "__t", "__above").dropDuplicates(["__x"]).select("__x", "__above", F.posexplode("__t").alias("pos", "tok"))
        unit = F.struct("pos", "tok", (F.col("__above") > F.col("pos")).alias("top"), number(F.col("tok")).alias("n"), F.col("__u").alias("u"))
        lists = each.join(units, F.col("tok") == F.col("__unit"), "left").groupBy("__x").agg(F.sort_array(F.collect_list(unit)).alias("__l"))

        def product(top: bool) -> Column:
            return F.aggregate(F.filter("__l", lambda t: t["top"] == top), F.lit(1.0), lambda x, t: x * F.coalesce(t["n"], t["u"]["scale"], F.lit(1.0)))

        dims = F.flatten(F.transform(F.filter("__l", lambda t: t["u"].isNotNull()), lambda t: F.when(t["top"], t["u"]["dims"]).otherwise(t["u"]["over"])))
        unknown = F.transform(F.filter("__l", lambda t: t["n"].isNull() & t["u"].isNull()), lambda t: t["tok"])
        lists = lists.select("__x", product(True).alias("__num"), product(False).alias("__den"), dims.alias("__dims"), unknown.alias("__unknown"))
        out = out.unionByName(long.join(shuffled(lists), expr == F.col("__x")).select(*result))
    dims = F.when(F.size("__dims") < 2, F.col("__dims")).otherwise(_summed(F.col("__dims")))
    scale = F.when(F.size("__unknown") == 0, F.col("__num") / F.col("__den"))
    return out.select(*kept, F.struct(scale.alias("scale"), dims.alias("dims"), F.col("__unknown").alias("unresolved")).alias(out_col))


def with_resolved(df: DataFrame, expr_col: str, out_col: str, lookup: UnitLookup) -> DataFrame:
    """``with_resolved_many`` for one column."""
    return with_resolved_many(df, [(expr_col, out_col)], lookup)


def resolve_expression(expr: Column, lookup: UnitLookup) -> Column:
    """Column form of ``with_resolved`` (single expression; use on small tables)."""
    return _summarize(_resolved_tokens(expr, lookup.maps()))


def resolve_unit_expressions(exprs: DataFrame, expr_col: str = "expr", registry=None) -> DataFrame:
    """For each distinct expression: ``scale``, ``dims`` (sorted (dim, exp)
    pairs), ``unresolved`` (unknown tokens) and ``resolved`` (bool)."""
    lookup = unit_lookup(registry)
    e = materialize(exprs.select(F.col(expr_col)).where(F.col(expr_col).isNotNull()).distinct())
    r = with_resolved(e, expr_col, "_r", lookup)
    return r.select(expr_col, "_r.scale", "_r.dims", "_r.unresolved", (F.size("_r.unresolved") == 0).alias("resolved"))


def unit_factor_table(pairs: DataFrame, from_col: str = "from_unit", to_col: str = "to_unit",
                      rename_fun=standardize_unit_names, registry=None, *, cut_lineage: bool = True) -> DataFrame:
    """U2 + U3 on distinct (from, to) pairs.

    Returns ``from_col, to_col, from_units_unit, to_units_unit, factor,
    convertible``; ``factor`` is NULL unless convertible. One distinct plus one
    projection; ``pairs`` should already be small (distinct unit pairs).
    ``cut_lineage=False`` is for pairs that are already a literal or a written
    table (nothing for a filter to be pushed into)."""
    lookup = unit_lookup(registry)
    # Cut lineage first: otherwise a filter on the result (e.g. "convertible")
    # could be pushed below the distinct and run the lookup once per fact row.
    p = pairs.select(F.col(from_col).alias("_f"), F.col(to_col).alias("_t")).distinct()
    if cut_lineage:
        p = materialize(p)
    p = p.withColumn("_fs", rename_fun(F.col("_f"))).withColumn("_ts", rename_fun(F.col("_t")))
    p = with_resolved_many(p, [("_fs", "_rf"), ("_ts", "_rt")], lookup)
    ok = F.coalesce((F.size("_rf.unresolved") == 0) & (F.size("_rt.unresolved") == 0)
                    & (F.col("_rf.dims") == F.col("_rt.dims")), F.lit(False))
    return p.select(
        F.col("_f").alias(from_col), F.col("_t").alias(to_col),
        F.col("_fs").alias("from_units_unit"), F.col("_ts").alias("to_units_unit"),
        F.when(ok, F.col("_rf.scale") / F.col("_rt.scale")).alias("factor"),
        ok.alias("convertible"),
    )


def convertibility_classes(units: DataFrame, unit_col: str = "unit", rename_fun=standardize_unit_names, registry=None) -> DataFrame:
    """U3 for all units at once: ``unit, dims, class_id`` of the distinct units, where units convert into one another exactly when
    they share a ``class_id`` (the smallest unit of the class); an unresolvable unit has none. The dimensions' text is the grouping
    key, so nothing compares pairs: one aggregate (map-side first) and a join back."""
    u = units.select(F.col(unit_col).alias("unit")).where("unit is not null").distinct().withColumn("_s", rename_fun(F.col("unit")))
    lookup = unit_lookup(registry)
    resolved = _with_resolved_rows(u, "_s", "_r", lookup) if isinstance(lookup, RegistryTable) else with_resolved(materialize(u), "_s", "_r", lookup)
    known = materialize(resolved.select("unit", F.when(F.size("_r.unresolved") == 0, dims_signature(F.col("_r.dims"))).alias("dims")))
    least = known.where("dims is not null").groupBy("dims").agg(F.min("unit").alias("class_id"))
    return known.join(least, "dims", "left").select("unit", "dims", "class_id")


def dims_signature(dims: Column) -> Column:
    """Readable dimension text, e.g. ``kg^1 m^2 s^-2`` (empty = dimensionless)."""
    return F.array_join(F.transform(dims, lambda d: F.concat(d["dim"], F.lit("^"), d["exp"].cast("string"))), " ")


__all__ = ["UnitLookup", "RegistryTable", "RepeatedUnits", "repeated_units", "prefix_splits", "unit_tokens", "unit_lookup", "resolve_expression", "with_resolved", "with_resolved_many", "resolve_unit_expressions", "unit_factor_table",
           "dims_signature", "convertibility_classes"]
