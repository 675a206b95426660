"""The paths taken when a side is beyond the broadcast bound, on skewed data
(one key holding a third of all rows): same results, no broadcast of the
unbounded side, and partial aggregation before every shuffle."""

from pyspark.sql import functions as F

from conftest import rows
from yearloom.operators.aggregate import group_total_keep_rows, key_batches, scaled_rollup
from yearloom.operators.joins import full_outer_join, full_outer_with_dim, join_dim
from yearloom.operators.units.convert import convert_crosswalk, convert_rowwise


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _skewed(spark, n=3000):
    # key "hot" holds a third of the rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 50).cast("string"))).alias("g"),
        (F.col("id") % 7).cast("double").alias("value"),
        F.when(F.col("id") % 2 == 0, F.lit("GW")).otherwise(F.lit("MW")).alias("unit"),
        F.col("id"))


def test_group_total_beyond_bound(spark):
    df = _skewed(spark)
    a = rows(group_total_keep_rows(df, ["g"], max_broadcast_rows=1).select("id", "group_total"))
    b = rows(group_total_keep_rows(df, ["g"]).select("id", "group_total"))
    assert a == b
    hot = df.where("g = 'hot'").agg(F.sum("value")).first()[0]
    assert all(t == hot for i, t in a if i % 3 == 0)


def test_join_and_full_outer_beyond_bound(spark):
    fact = _skewed(spark).select("g", "id")
    dim = spark.range(60).select(F.when(F.col("id") == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), F.col("id").cast("string"))).alias("g"), F.col("id").alias("d"))
    j = join_dim(fact, dim, ["g"], "left", max_broadcast_rows=1)
    assert rows(j.select("id", "d")) == rows(join_dim(fact, dim, ["g"], "left").select("id", "d"))
    small = rows(full_outer_with_dim(fact, dim, ["g"], max_broadcast_rows=1).select("g", "id", "d"))
    assert small == rows(full_outer_join(fact, dim, ["g"]).select("g", "id", "d"))


def test_conversion_beyond_bound(spark):
    df = _skewed(spark)
    a = rows(convert_rowwise(df, F.lit("kW"), max_broadcast_rows=0).select("id", "unit", "value"))
    b = rows(convert_rowwise(df, F.lit("kW")).select("id", "unit", "value"))
    assert a == b
    xw = spark.createDataFrame([("GW", "MW"), ("MW", "kW")], "from_unit string, to_unit string")
    c = rows(convert_crosswalk(df, xw, max_broadcast_rows=1).select("id", "unit", "value"))
    d = rows(convert_crosswalk(df, xw).select("id", "unit", "value"))
    assert c == d and c[0][1] == "MW"


def test_rollup_combines_hot_key_before_the_shuffle(spark):
    df = _skewed(spark).select(F.lit("D").alias("dataset"), F.lit("S").alias("scenario"), F.col("g").alias("variable"),
                               F.lit("USA").alias("region"), "unit", F.lit(2020).alias("year"), "value",
                               F.lit(1.0).alias("factor"))
    out = scaled_rollup(df)
    plan = _plan(out)
    assert plan.index("partial_sum") > plan.index("Exchange")      # partial aggregate sits below the exchange
    assert out.where("variable = 'hot'").count() == 2


def test_key_batches_many_partitions(spark):
    keys = _skewed(spark).select("g")
    got = sorted(key_batches(keys, "g", 10, partitions=5).collect())
    assert [r.key_index for r in got] == list(range(1, 52))


def test_salted_fallback_joins(spark):
    df = _skewed(spark)
    a = rows(group_total_keep_rows(df, ["g"], max_broadcast_rows=1, salt_buckets=8).select("id", "group_total"))
    b = rows(group_total_keep_rows(df, ["g"]).select("id", "group_total"))
    assert a == b
    fact = df.select("g", "id")
    dim = spark.range(60).select(F.when(F.col("id") == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), F.col("id").cast("string"))).alias("g"), F.col("id").alias("d"))
    salted = join_dim(fact, dim, ["g"], "left", max_broadcast_rows=1, salt_buckets=8)
    assert salted.columns == ["g", "id", "d"]
    assert rows(salted.select("id", "d")) == rows(join_dim(fact, dim, ["g"], "left").select("id", "d"))
    plan = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan
    fo = rows(full_outer_with_dim(fact, dim, ["g"], max_broadcast_rows=1, salt_buckets=4).select("g", "id", "d"))
    assert fo == rows(full_outer_join(fact, dim, ["g"]).select("g", "id", "d"))
