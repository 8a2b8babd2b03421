import os
import datetime as dt
import pytest
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.functions.urls import url_host, with_domain
from tallyscope.operators.sessions import explode_uploads
from tallyscope.sources import tables


def test_write_keeps_or_replaces(spark, tmp_path):
    path = str(tmp_path / "out")
    tables.write_parquet(spark.range(3), path)
    tables.write_parquet(spark.range(9), path)
    assert tables.read_parquet(spark, path).count() == 3
    tables.write_parquet(spark.range(9), path, overwrite=True)
    assert tables.read_parquet(spark, path).count() == 9


def test_first_root_that_has_the_path_wins(spark, tmp_path):
    tables.write_parquet(spark.range(2), "t", roots=[str(tmp_path / "b")])
    roots = [str(tmp_path / "a"), str(tmp_path / "b")]
    assert tables.read_first_root(spark, "t", roots).count() == 2
    with pytest.raises(FileNotFoundError):
        tables.resolve(spark, "absent", roots)


def test_partitioned_table_is_pruned(spark, tmp_path):
    days = spark.createDataFrame([("2024-01-0%d" % d, d) for d in range(1, 8)], "date string, x int")
    path = str(tmp_path / "days")
    tables.write_parquet(days.withColumn("date", F.col("date").cast("date")), path, partition_by=["date"])
    found = tables.read_between_dates(spark, path, "2024-01-04", "2024-01-05", days_back=1)
    assert sorted(r.x for r in found.collect()) == [3, 4, 5]
    assert "PartitionFilters: [isnotnull(date" in found._jdf.queryExecution().executedPlan().toString()


def test_daily_folders_get_a_date(spark, tmp_path):
    for day in ("03", "04"):
        tables.write_parquet(spark.range(1), str(tmp_path / f"year=24/month=02/day={day}"))
    found = tables.read_daily_folders(spark, str(tmp_path), "2024-02-03", "2024-02-04").select("date").collect()
    assert sorted(str(r.date) for r in found) == ["2024-02-03", "2024-02-04"]


def test_json_and_uploads(spark, tmp_path):
    file = tmp_path / "u.json"
    file.write_text('{"did": "d", "tz": 60, "events": [{"ts": 1, "host": "a"}, {"ts": 2, "host": "b"}]}\n')
    uploads = tables.read_json(spark, str(file), "did string, tz int, events array<struct<ts:bigint,host:string>>")
    assert sorted((r.did, r.ts, r.host) for r in explode_uploads(uploads).collect()) == [("d", 1, "a"), ("d", 2, "b")]


def test_models_text():
    found = tables.parse_models("p1,2024-01-07,NB_1,True;p2,2023-12-31,NB_1,False")
    assert [m["is_main_model"] for m in found] == [True, False] and found[1]["model_path"] == "p2"


def test_hosts_and_domains(spark):
    urls = ["http://u@a.b.co.uk:81/x?q", "https://WWW.Example.com", "nonsense", "", "http://10.0.0.1/x"]
    df = spark.createDataFrame([(u,) for u in urls], "url string").withColumn("host", url_host("url"))
    suffixes = spark.createDataFrame([("com",), ("co.uk",), ("uk",)], "suffix string")
    found = {r.url: (r.host, r.domain) for r in with_domain(df, suffixes).collect()}
    assert found == {
        "http://u@a.b.co.uk:81/x?q": ("u@a.b.co.uk:81", "b.co.uk"),
        "https://WWW.Example.com": ("WWW.Example.com", "example.com"),
        "nonsense": ("", "."),
        "": ("", "."),
        "http://10.0.0.1/x": ("10.0.0.1", "10.0.0.1."),
    }


def test_cut_lineage_keeps_rows_and_types(spark):
    df = spark.range(5).select("id", F.array("id").alias("a"), F.create_map("id", F.lit("x")).alias("m"))
    cut = cut_lineage(df)
    assert cut.schema.simpleString() == df.schema.simpleString() and cut.count() == 5


def test_half_written_outputs_are_replaced_and_whole_ones_left(spark, tmp_path):
    one, two = spark.range(3).withColumnRenamed("id", "a"), spark.range(7).withColumnRenamed("id", "a")
    path = f"{tmp_path}/out/table"
    os.makedirs(path)
    one.toPandas().to_parquet(f"{path}/part-0.parquet")  # left by an interrupted job: no success marker
    assert not tables.is_complete(spark, path)
    tables.write_parquet(two, path)
    assert tables.is_complete(spark, path) and spark.read.parquet(path).count() == 7
    tables.write_parquet(one, path)
    assert spark.read.parquet(path).count() == 7
    tables.write_parquet(one, path, overwrite=True)
    assert spark.read.parquet(path).count() == 3
    assert [f for f in os.listdir(f"{tmp_path}/out") if "staging" in f] == []


def test_days_without_marker_are_unfinished(spark, tmp_path):
    path = f"{tmp_path}/days"
    rows = spark.createDataFrame([(dt.date(2024, 1, k), k) for k in (1, 2, 4)], "date date, v int")
    rows.write.partitionBy("date").parquet(path)
    assert tables.finished_dates(spark, path) == []
    tables.mark_finished(spark, path, ["2024-01-01", "2024-01-04", "2024-01-05"])
    assert tables.finished_dates(spark, path) == [dt.date(2024, 1, k) for k in (1, 4, 5)]
    listed = {r.date.day: (r.files, r.complete) for r in tables.date_folders(spark, path).collect()}
    assert listed == {1: (1, True), 2: (1, False), 4: (1, True), 5: (0, True)}
    left = tables.unfinished_dates(spark, path, "2024-01-01", "2024-01-06").collect()
    assert sorted(r.date.day for r in left) == [2, 3, 6]
    assert spark.read.parquet(path).count() == 3


def test_registered_models_are_one_tagged_scan(spark, tmp_path):
    spark.createDataFrame([("a", 1.0)], "app string, w double").write.parquet(f"{tmp_path}/m/1")
    spark.createDataFrame([("b", 2.0, "x"), ("c", 3.0, "y")], "app string, w double, note string").write.parquet(f"{tmp_path}/m/10")
    spark.createDataFrame([("d",)], "app string").write.parquet(f"{tmp_path}/m/with space")
    text = "m/1,2024-01-07,NB_1,True;m/10,2023-12-31,NB_2,False;/m/with space,2023-12-24,NB_1,False"
    rows = {r.app: r for r in tables.read_models(spark, text, str(tmp_path)).collect()}
    assert {a: (str(r.model_date), r.model_type, r.is_main_model) for a, r in rows.items()} == {
        "a": ("2024-01-07", "NB_1", True), "b": ("2023-12-31", "NB_2", False), "c": ("2023-12-31", "NB_2", False), "d": ("2023-12-24", "NB_1", False),
    }
    assert (rows["a"].note, rows["b"].note, rows["d"].w) == (None, "x", None)
    with pytest.raises(ValueError):
        tables.read_models(spark, "", str(tmp_path))
