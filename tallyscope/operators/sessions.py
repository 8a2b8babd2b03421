"""Panel ingest, foreground detection and sessions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyscope.contracts import require
from tallyscope.functions import scan
from tallyscope.functions.exprs import key_text, ratio
from tallyscope.sources.tables import as_date

CAP_KEYS = ["did", "country", "source", "model", "cv", "osv", "v"]


def explode_uploads(uploads: DataFrame) -> DataFrame:
    """One row per event of the nested upload log."""
    return uploads.select(*[c for c in uploads.columns if c != "events"], F.inline("events"))


def ingest_panel(events: DataFrame, day: dt.date | str, zone: str = "EST") -> DataFrame:
    """Events of one reporting day.

    ``ts`` is epoch milliseconds of the device clock and ``tz`` its offset from UTC in seconds. The day is the
    calendar date of the UTC time in a fixed zone. The filter on raw ``ts`` repeats that bound loosely (any offset
    is within a day) so that the scan can skip row groups.
    """
    d = as_date(day)
    midnight = int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp()) * 1000
    day_ms = 86_400_000
    near = events.filter(F.col("ts").between(midnight - day_ms, midnight + 3 * day_ms))
    utc = F.timestamp_seconds(F.floor(F.col("ts") / 1000) - F.col("tz"))
    return (
        near.withColumn("local_ts", F.timestamp_millis("ts"))
        .withColumn("utc_ts", utc)
        .withColumn("local_ts_ms", F.col("ts"))
        .filter(F.to_date(F.from_utc_timestamp("utc_ts", zone)) == F.lit(d))
    )


def foreground_split(
    panel: DataFrame,
    ts_ms: str = "ts_ms",
    cell_seconds: int = 1,
    merge_cells: int = 60,
    min_requests: int = 3,
) -> DataFrame:
    """Cells of device activity merged into foreground (1) and background (0) stretches.

    One row per stretch: did, country, stretch_id, kind, first and last cell, requests. A cell is foreground with at
    least ``min_requests`` requests; neighbouring cells of equal kind at most ``merge_cells`` apart are merged.
    Counting per cell comes first, so the window sees at most one row per device and cell.
    """
    cells = _cells(panel, ts_ms, cell_seconds, min_requests)
    return (
        _stretches(cells, merge_cells)
        .groupBy("did", "country", "stretch")
        .agg(
            F.min("kind").alias("kind"),
            F.min("cell").alias("first_cell"),
            F.max("cell").alias("last_cell"),
            F.sum("requests").alias("requests"),
        )
        .withColumn("session_id", F.concat_ws("_", "did", "stretch"))
        .drop("stretch")
    )


def foreground_events(
    panel: DataFrame,
    ts_ms: str = "ts_ms",
    cell_seconds: int = 1,
    merge_cells: int = 60,
    min_requests: int = 3,
) -> DataFrame:
    """Events of foreground stretches, with the stretch id and the start of the stretch in ms."""
    cells = _stretches(_cells(panel, ts_ms, cell_seconds, min_requests), merge_cells)
    starts = cells.groupBy("did", "country", "stretch").agg(F.min("cell").alias("first_cell"))
    kept = (
        cells.filter(F.col("kind") == 1)
        .join(starts, ["did", "country", "stretch"])
        .select(
            "did",
            "country",
            "cell",
            F.concat_ws("_", "did", "stretch").alias("session_id"),
            (F.col("first_cell") * F.lit(cell_seconds * 1000)).alias("start_ms"),
        )
    )
    return panel.withColumn("cell", _cell(ts_ms, cell_seconds)).join(kept, ["did", "country", "cell"]).drop("cell")


def clean_foreground(
    events: DataFrame,
    blacklist: DataFrame,
    countries: list[int] | None = None,
    remove_vendor: bool = False,
) -> DataFrame:
    """Drop blacklisted hosts, other countries and, on request, the platform vendor's own hosts."""
    kept = events if countries is None else events.filter(F.col("country").isin(countries))
    if remove_vendor:
        kept = kept.filter(~F.col("host").like("%apple.com"))
    return kept.join(blacklist.select("host").distinct(), "host", "left_anti")


def sessionize_capped(
    panel: DataFrame,
    session_len_ms: int = 4950,
    req_diff_ms: int = 10_000,
    keys: list[str] | None = None,
    ts: str = "local_ts_ms",
    slice_ms: int = 3_600_000,
) -> DataFrame:
    """Sessions split at long gaps, then cut further at the widest gaps of the key until they are short enough.

    Gaps longer than ``req_diff_ms`` separate groups. A group lasting d ms asks for c = int(d / session_len_ms) more
    cuts and gets one before each of its rows whose gap is among the c widest inner gaps of the whole key, that is
    where the gap is at least the c-th widest. So each group needs a single threshold, not a rank for every row.

    The work is done on ticks, the distinct times of a key with their number of rows, so the panel itself is only
    shuffled for the final join. Rows sharing a tick have gap 0 and rank behind every positive gap.
    """
    keys = keys or CAP_KEYS
    require(panel, *keys, ts)
    rows = scan.with_slice(panel.withColumn("_key", key_text(*keys)), ts, slice_ms)
    ticks = scan.number_runs(scan.ticks_of(rows, ts), ts, req_diff_ms)

    whole_key = Window.partitionBy("_key")
    groups = (
        ticks.groupBy("_key", "_run")
        .agg(
            F.floor((F.max(ts) - F.min(ts)) / F.lit(session_len_ms)).alias("_cuts"),
            (F.count(F.lit(1)) - F.sum("_opens")).alias("_inner"),
        )
        .withColumn("_most_cuts", F.max("_cuts").over(whole_key))
        .withColumn("_inner_gaps", F.sum("_inner").over(whole_key))
        .filter(F.col("_cuts") > 0)
    )
    # The c-th widest gap of a key is among the c widest of its slice, so each slice keeps only that many.
    widest_first = F.col("_gap").desc()
    wanted = groups.select("_key", "_most_cuts").distinct()
    thresholds = (
        ticks.filter(F.col("_opens") == 0)
        .join(wanted, "_key")
        .withColumn("_at", F.row_number().over(Window.partitionBy("_key", "_slice").orderBy(widest_first)))
        .filter(F.col("_at") <= F.col("_most_cuts"))
        .withColumn("_cuts", F.row_number().over(Window.partitionBy("_key").orderBy(widest_first)).cast("bigint"))
        .filter(F.col("_cuts") <= F.col("_most_cuts"))
        .select("_key", "_cuts", F.col("_gap").alias("_threshold"))
    )
    limits = groups.join(thresholds, ["_key", "_cuts"], "left").select(
        "_key", "_run", "_cuts", "_inner_gaps", F.coalesce("_threshold", F.lit(0)).alias("_threshold")
    )
    cut = F.when((F.col("_opens") == 1) | (F.col("_gap") >= F.col("_threshold")), 1).otherwise(0)
    # With more cuts than inner gaps, rows sharing a tick are cut as well, which moves the numbering on.
    shared = F.when(F.col("_cuts") > F.col("_inner_gaps"), F.col("_rows") - 1).otherwise(0)
    marked = ticks.join(limits, ["_key", "_run"], "left").select("_key", "_slice", ts, (cut + shared).alias("_steps"))
    numbered = scan.running_sum(marked, ts, F.col("_steps"), "_session").drop("_steps")
    return (
        rows.join(numbered, ["_key", "_slice", ts])
        .withColumn("session_id", F.md5(F.concat_ws("\x1f", F.col("_session").cast("string"), F.col("_key"))))
        .select(*panel.columns, "session_id")
    )


def sessionize(
    df: DataFrame, keys: list[str], gap: int = 600, ts: str = "ts", slice_width: int = 3600
) -> DataFrame:
    """Sessions split at gaps above ``gap``; the id is the keys and the position of the session's first event.

    Works on ticks like :func:`sessionize_capped`.
    """
    require(df, *keys, ts)
    rows = scan.with_slice(df.withColumn("_key", key_text(*keys)), ts, slice_width)
    ticks = scan.number_runs(scan.ticks_of(rows, ts), ts, gap)
    return (
        rows.join(ticks.select("_key", "_slice", ts, "_first"), ["_key", "_slice", ts])
        .withColumn("session_id", F.concat_ws("-", *keys, "_first"))
        .select(*df.columns, "session_id")
    )


def paint_sessions(sessions: DataFrame, browsing: DataFrame) -> DataFrame:
    """Add the lower median and mean browsing probability of a session's hosts, weighted by events.

    Events are first counted per (session, host), and hosts of equal probability are merged, so the median is read off
    a short cumulative count. Sessions without a known host keep NULLs.
    """
    levels = (
        sessions.groupBy("session_id", "host")
        .agg(F.count(F.lit(1)).alias("_events"))
        .join(browsing.select("host", "p_browsing"), "host")
        .groupBy("session_id", "p_browsing")
        .agg(F.sum("_events").alias("_events"))
    )
    session = Window.partitionBy("session_id")
    upto = session.orderBy("p_browsing").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scores = (
        levels.withColumn("_upto", F.sum("_events").over(upto))
        .withColumn("_all", F.sum("_events").over(session))
        .groupBy("session_id")
        .agg(
            F.min(F.when(F.col("_upto") * 2 >= F.col("_all"), F.col("p_browsing"))).alias("median_p_browsing"),
            ratio(F.sum(F.col("p_browsing") * F.col("_events")), F.sum("_events")).alias("mean_p_browsing"),
        )
    )
    return sessions.join(scores, "session_id", "left")


def _cell(ts_ms: str, cell_seconds: int) -> Column:
    return F.floor(F.col(ts_ms) / F.lit(cell_seconds * 1000))


def _cells(panel: DataFrame, ts_ms: str, cell_seconds: int, min_requests: int) -> DataFrame:
    require(panel, "did", "country", ts_ms)
    return (
        panel.groupBy("did", "country", _cell(ts_ms, cell_seconds).alias("cell"))
        .agg(F.count(F.lit(1)).alias("requests"))
        .withColumn("kind", (F.col("requests") >= min_requests).cast("int"))
    )


def _stretches(cells: DataFrame, merge_cells: int) -> DataFrame:
    device = Window.partitionBy("did", "country").orderBy("cell")
    breaks = (
        F.lag("kind").over(device).isNull()
        | (F.lag("kind").over(device) != F.col("kind"))
        | (F.col("cell") - F.lag("cell").over(device) > merge_cells)
    )
    marked = cells.withColumn("_breaks", breaks.cast("int"))
    return marked.withColumn("stretch", F.sum("_breaks").over(device) - 1).drop("_breaks")
