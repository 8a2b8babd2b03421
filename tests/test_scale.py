"""Scales of signals beyond 32 bits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyscope.functions.exprs import fits_int
from tallyscope.operators import scale
from tallyscope.plans import estimate_queries

DAY = dt.date(2024, 1, 28)


def scaled(spark, users):
    truth = spark.createDataFrame([(840, DAY, "a1", users)], "country int, date date, app string, active_users long")
    estimates = spark.createDataFrame([(840, DAY, "a1", 0.25)], "country int, date date, app string, p double")
    return estimates, scale.median_scale(estimates, truth, "p", min_truth=1000)


@pytest.mark.parametrize("users", [5_000, 2**40])
def test_scales_beyond_int(spark, users):
    estimates, adj = scaled(spark, users)
    assert [tuple(r) for r in adj.collect()] == [(840, users * 4)]
    got = scale.scale_signal(estimates, adj, "p", "raw_est").first()
    assert (got["raw_est_active_users"], got["raw_est_adj"]) == (users, users * 4)


@pytest.mark.parametrize("users, kind", [(5_000, "int"), (2**40, "bigint")])
def test_queries_keep_the_sql_type_where_scales_fit(spark, monkeypatch, users, kind):
    _, adj = scaled(spark, users)
    monkeypatch.setattr(estimate_queries, "adjustments", lambda d: (adj, adj.limit(0), adj.limit(0)))
    out = estimate_queries.sql_typed(None, adj.withColumn("mp_adj", F.col("adj")))
    assert dict(out.dtypes) == {"country": "int", "adj": kind, "mp_adj": kind}
    assert [tuple(r) for r in out.collect()] == [(840, users * 4, users * 4)]


def test_fits_int(spark):
    def fits(*values):
        rows = spark.createDataFrame([(v,) for v in values], "x long")
        return rows.agg(fits_int("x").alias("f")).first()["f"]

    assert fits() and fits(None) and fits(-(2**31), 2**31 - 1, None)
    assert not fits(2**31) and not fits(-(2**31) - 1, None)
