import hashlib
import itertools
import random

from pyspark.sql import functions as F

from tallyscope.operators import sessions

KEYS = sessions.CAP_KEYS


def panel(spark, rows):
    schema = "did string, country int, source string, model string, cv string, osv string, v string, local_ts_ms bigint, id int"
    return spark.createDataFrame(rows, schema)


def make_rows(seed, n=120):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        device = rng.choice(["a", "b", "c"])
        model = None if device == "c" else "m"
        ts = rng.choice([0, 40_000, 3_590_000, 7_300_000]) + rng.randrange(0, 30_000, 500)
        rows.append((device, 840, "s", model, "c", "o", "v", ts, i))
    return rows


def capped_reference(rows, length, gap):
    """Cut groups by the rule as stated: rank of the gap among all inner gaps of the key."""
    out = {}
    for _, part in itertools.groupby(sorted(rows, key=lambda r: (str(r[:7]), r[7])), key=lambda r: r[:7]):
        part = list(part)
        deltas = [None] + [b[7] - a[7] for a, b in zip(part, part[1:])]
        opens = [d is None or d > gap for d in deltas]

        def running(flags):
            sums = list(itertools.accumulate(int(f) for f in flags))
            last = {r[7]: s for r, s in zip(part, sums)}
            return [last[r[7]] for r in part]

        group = running(opens)
        span = {}
        for r, g in zip(part, group):
            lo, hi = span.get(g, (r[7], r[7]))
            span[g] = (min(lo, r[7]), max(hi, r[7]))
        cuts = [int((span[g][1] - span[g][0]) / length) for g in group]
        inner = [None if o else d for d, o in zip(deltas, opens)]
        present = [d for d in inner if d is not None]
        rank = [1 + (len(present) if d is None else sum(x > d for x in present)) for d in inner]
        final = running([o or k <= c for o, k, c in zip(opens, rank, cuts)])
        for r, f in zip(part, final):
            key = "\x1f".join("\x00" if x is None else str(x) for x in r[:7])
            out[r[8]] = hashlib.md5(f"{f}\x1f{key}".encode()).hexdigest()
    return out


def test_capped_sessions_follow_the_rule(spark):
    for seed, slice_ms in ((1, 3_600_000), (2, 10_000), (3, 10**9)):
        rows = make_rows(seed)
        found = sessions.sessionize_capped(panel(spark, rows), slice_ms=slice_ms).select("id", "session_id").collect()
        assert {r.id: r.session_id for r in found} == capped_reference(rows, 4950, 10_000)


def test_gap_sessions_do_not_depend_on_slices(spark):
    rows = [(d, t) for d in ("x", "y") for t in (0, 0, 600, 1201, 1201, 5000, 9000, 9100, 20000)]
    df = spark.createDataFrame(rows, "did string, ts int")
    results = [
        sorted(tuple(r) for r in sessions.sessionize(df, ["did"], 600, slice_width=w).collect()) for w in (100, 3600, 10**6)
    ]
    assert results[0] == results[1] == results[2]
    ids = {t: s for d, t, s in results[0] if d == "x"}
    assert ids == {0: "x-1", 600: "x-1", 1201: "x-4", 5000: "x-6", 9000: "x-7", 9100: "x-7", 20000: "x-9"}


def test_stretches_merge_at_sixty_cells_only(spark):
    times = [0] * 3 + [60] * 3 + [121] * 3 + [122]
    df = spark.createDataFrame([("d", 1, t * 1000) for t in times], "did string, country int, ts_ms bigint")
    found = sessions.foreground_split(df).orderBy("first_cell").collect()
    assert [(r.kind, r.first_cell, r.last_cell, r.requests) for r in found] == [(1, 0, 60, 6), (1, 121, 121, 3), (0, 122, 122, 1)]


def test_reporting_day_is_in_fixed_zone(spark):
    # 2024-07-02 04:30 UTC is still July 1st at UTC-5, daylight saving or not.
    ts = 1719894600000
    df = spark.createDataFrame([(ts, 0), (ts + 3_600_000, 3600), (ts + 1_800_000, 0)], "ts bigint, tz int")
    assert sessions.ingest_panel(df, "2024-07-01").count() == 2


def test_painting_keeps_sessions_without_known_hosts(spark):
    s = spark.createDataFrame([("s1", "a"), ("s1", "b"), ("s1", "b"), ("s2", "z")], "session_id string, host string")
    p = spark.createDataFrame([("a", 0.9), ("b", 0.1)], "host string, p_browsing double")
    found = {r.session_id: (r.median_p_browsing, r.m) for r in sessions.paint_sessions(s, p).withColumn(
        "m", F.round("mean_p_browsing", 4)).collect()}
    assert found == {"s1": (0.1, round(1.1 / 3, 4)), "s2": (None, None)}
