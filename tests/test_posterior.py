"""Rows of sessions and apps: dealt over tasks, by the mean time of a session's known hosts."""

from pyspark.sql import functions as F

from tallyscope.operators import posterior

EVENTS = "country int, did string, session_id string, host string, ts long"
PARAMS = "app string, host string, total_host_portion double, host_portion_per_bundle double"


def tables(spark, sessions=40):
    events = [(840, f"d{k}", f"s{k}", host, ts) for k in range(sessions) for host, ts in [("h1", 10), ("h1", 20), ("h2", 40), ("new", 99)]]
    events += [(None, "d0", "s0", "h1", 1), (840, None, "s0", "h1", 1), (840, "d0", None, "h1", 1), (840, "d0", "s0", None, 1)]
    known = [("a", "h1", 8.0, 2.0), ("b", "h1", 8.0, 6.0), ("a", "h2", 4.0, 4.0), ("c", "h3", 1.0, 1.0)]
    return spark.createDataFrame(events, EVENTS), spark.createDataFrame(known, PARAMS)


def test_pairs_are_dealt_by_rows(spark, monkeypatch):
    monkeypatch.setattr(posterior, "ROWS_PER_TASK", 10)
    events, known = tables(spark)
    pairs = posterior.session_pairs(events, known)
    assert pairs.rdd.getNumPartitions() == 12
    got = pairs.withColumn("_part", F.spark_partition_id()).collect()
    assert len(got) == 120 and len({(r["session_id"], r["_part"]) for r in got}) == 40
    # h1 has two apps, so its events count twice: (2 * 30 + 40) / (2 * 2 + 1).
    assert {r["avg_session"] for r in got} == {20.0}
    assert sorted((r["app"], r["host"], r["host_portion_per_bundle"]) for r in got if r["session_id"] == "s7") == [("a", "h1", 2.0), ("a", "h2", 4.0), ("b", "h1", 6.0)]


def test_no_known_hosts(spark):
    events, known = tables(spark, 2)
    assert posterior.posterior_scores(events, known.limit(0)).count() == 0


def test_frames_of_several_reaches_equal_single_ones(spark):
    events, known = tables(spark, 5)
    key = lambda df: sorted(map(str, df.collect()))
    both = posterior.first_frame_posteriors(events, known, (1, 2))
    for n in (1, 2):
        want = posterior.windowed_posterior(events, known, n).groupBy(*posterior.SESSION, "app", "avg_session")
        assert key(both.filter(F.col("reach") == n).drop("reach")) == key(want.agg(F.min_by("posterior", "host").alias("posterior")))
