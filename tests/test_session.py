"""Session helpers: literal tables, size checks, broadcast decisions, lineage cuts."""

from decimal import Decimal

from yearloom.session import (broadcast_checked, local_frame, materialize, row_count_at_most, scratch_dir)


def test_local_frame_literals(spark):
    rows_in = [("a'b\\c", Decimal("365"), 1e-24, None, True), (None, Decimal("-1.5"), 2.5, 7, False)]
    df = local_frame(spark, rows_in, "s string, f decimal(10,2), d double, i int, b boolean")
    assert [tuple(r) for r in df.collect()] == [("a'b\\c", Decimal("365.00"), 1e-24, None, True),
                                                (None, Decimal("-1.50"), 2.5, 7, False)]
    assert "LocalTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert local_frame(spark, [], "x string").count() == 0


def test_size_check_boundaries(spark):
    df = spark.range(10)
    assert row_count_at_most(df, 10) and not row_count_at_most(df, 9)
    assert row_count_at_most(df.limit(0), 0)


def test_broadcast_decision(spark):
    df = spark.range(10)
    assert broadcast_checked(df, 5) is df                       # beyond the bound: unhinted
    assert broadcast_checked(df, 5, known_rows=3) is not df     # proven bound: hinted
    assert broadcast_checked(df, 50) is not df


def test_materialize_under_checkpoint_folder(spark):
    df = materialize(spark.range(5).selectExpr("id * 2 AS x"))
    assert sorted(r.x for r in df.collect()) == [0, 2, 4, 6, 8]
    def path(uri):
        return "/" + uri.split(":", 1)[1].lstrip("/")

    assert path(df.inputFiles()[0]).startswith(path(scratch_dir(spark)) + "/")
    assert path(scratch_dir(spark)).startswith(path(spark.sparkContext.getCheckpointDir()))
