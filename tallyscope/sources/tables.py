"""Sources, sinks and partition bookkeeping."""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_parquet(spark: SparkSession, *paths: str, base_path: str | None = None) -> DataFrame:
    """Scan one or more directories or globs. With ``base_path``, partition folders below it become columns."""
    reader = spark.read
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    return reader.parquet(*paths)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Scan JSON lines with a declared schema, so that no inference pass over the files is needed."""
    return spark.read.schema(schema).json(path)


def read_avro(spark: SparkSession, path: str) -> DataFrame:
    """Scan Avro files; needs the spark-avro package on the class path."""
    return spark.read.format("avro").load(path)


def as_date(day: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(day) if isinstance(day, str) else day


def between_dates(df: DataFrame, start, end, days_back: int = 0, column: str = "date") -> DataFrame:
    """Rows dated from ``days_back`` days before ``start`` up to ``end``; prunes folders of a partition column."""
    first = as_date(start) - dt.timedelta(days=days_back)
    return df.filter(F.col(column).between(F.lit(first), F.lit(as_date(end))))


def read_between_dates(spark: SparkSession, path: str, start, end, days_back: int = 0) -> DataFrame:
    """Date range of a table partitioned by ``date``: one scan, only the matching folders."""
    return between_dates(read_parquet(spark, path), start, end, days_back)


def daily_paths(path: str, start, end, days_back: int = 0, year_n_digits: int = 2) -> list[str]:
    """Folders year=/month=/day= of a date range, newest first."""
    last = as_date(end)
    span = (last - as_date(start)).days + days_back + 1
    days = (last - dt.timedelta(days=i) for i in range(span))
    return [f"{path}/year={str(d.year)[4 - year_n_digits:]}/month={d:%m}/day={d:%d}" for d in days]


def read_daily_folders(
    spark: SparkSession, path: str, start, end, days_back: int = 0, year_n_digits: int = 2
) -> DataFrame:
    """Date range of a year=/month=/day= tree as one scan with a ``date`` column."""
    folders = daily_paths(path, start, end, days_back, year_n_digits)
    df = read_parquet(spark, *folders, base_path=path)
    year = F.col("year").cast("int") + F.lit(2000 if year_n_digits == 2 else 0)
    return df.withColumn("date", F.make_date(year, F.col("month").cast("int"), F.col("day").cast("int")))


def union_all(frames: Iterable[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Union by name of any number of inputs; absent columns become NULL when allowed."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def read_and_union(spark: SparkSession, paths: Sequence[str], allow_missing: bool = False) -> DataFrame:
    return union_all((read_parquet(spark, p) for p in paths), allow_missing)


def folder_of(spark: SparkSession, path: str):
    """The file system of a path and the path, for listing and renaming."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def resolve(spark: SparkSession, path: str, roots: Sequence[str]) -> str:
    """The path under the first root that has it."""
    for root in roots:
        candidate = f"{root.rstrip('/')}/{path.lstrip('/')}"
        if path_exists(spark, candidate):
            return candidate
    raise FileNotFoundError(f"{path} is under none of {list(roots)}")


def read_first_root(spark: SparkSession, path: str, roots: Sequence[str]) -> DataFrame:
    return read_parquet(spark, resolve(spark, path, roots))


DONE = "_SUCCESS"


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether the job that wrote a folder came to its end."""
    return path_exists(spark, f"{path.rstrip('/')}/{DONE}")


def write_parquet(
    df: DataFrame,
    path: str,
    roots: Sequence[str] = ("",),
    overwrite: bool = False,
    partition_by: Sequence[str] = (),
) -> None:
    """Publish to the first root: replace what is there, or leave an existing complete output alone.

    A new output is written beside its place and moved there when it is complete, so readers never see half of one. What
    an interrupted job has left there, having no success marker, is replaced.
    """
    spark = df.sparkSession
    target = (f"{roots[0].rstrip('/')}/{path.lstrip('/')}" if roots[0] else path).rstrip("/")
    if not overwrite and is_complete(spark, target):
        return
    staging = f"{target}.staging-{uuid.uuid4().hex}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(staging)
    fs, place = folder_of(spark, target)
    if fs.exists(place):
        fs.delete(place, True)
    fs.mkdirs(place.getParent())
    if not fs.rename(folder_of(spark, staging)[1], place):
        raise OSError(f"{staging} could not be moved to {target}")


def mark_finished(spark: SparkSession, path: str, days: Iterable, column: str = "date") -> None:
    """Put a success marker into the folders of these days; a day without rows gets a folder of its own."""
    for day in days:
        fs, marker = folder_of(spark, f"{path.rstrip('/')}/{column}={as_date(day)}/{DONE}")
        fs.create(marker, True).close()


def date_folders(spark: SparkSession, path: str, column: str = "date") -> DataFrame:
    """(date, files, bytes, complete) of every date folder of a tree: data files in it, and whether it has a success marker.

    The listing is one call per day on the driver, of names and sizes only.
    """
    fs, root = folder_of(spark, path)
    rows = []
    for folder in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, f"{column}=*")) or []:
        day = folder.getPath().getName().split("=", 1)[1]
        listed = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(folder.getPath())]
        data = [size for name, size in listed if not name.startswith(("_", "."))]
        rows.append((as_date(day), len(data), sum(data), any(name == DONE for name, _ in listed)))
    return spark.createDataFrame(rows, f"{column} date, files bigint, bytes bigint, complete boolean")


def finished_dates(spark: SparkSession, path: str, column: str = "date") -> list[dt.date]:
    """The dates whose folders have a success marker, ascending."""
    fs, root = folder_of(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(root, f"{column}=*/{DONE}")) or []
    return sorted(as_date(f.getPath().getParent().getName().split("=", 1)[1]) for f in found)


def unfinished_dates(spark: SparkSession, path: str, start, end, column: str = "date") -> DataFrame:
    """Days of the range whose folder is missing or was left half-written."""
    complete = date_folders(spark, path, column).filter("complete")
    return missing_dates(complete, start, end, column)


def inline_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def missing_dates(df: DataFrame, start, end, column: str = "date") -> DataFrame:
    """Days of the range that have no rows."""
    spark = df.sparkSession
    calendar = spark.range(1).select(
        F.explode(
            F.sequence(F.lit(as_date(start)), F.lit(as_date(end)), F.expr("interval 1 day"))
        ).alias(column)
    )
    present = between_dates(df, start, end, column=column).select(column).distinct()
    return calendar.join(present, column, "left_anti")


def parse_models(models: str) -> list[dict]:
    """Model registry text "path,date,type,is_main;…" to records."""
    fields = ("model_path", "model_date", "model_type", "is_main_model")
    records = [dict(zip(fields, item.split(","))) for item in models.split(";") if item]
    return [{**r, "is_main_model": r["is_main_model"] == "True"} for r in records]


def read_models(spark: SparkSession, models: str, root: str = "") -> DataFrame:
    """The parameters of all models of a registry text as one table, tagged with model_date, model_type and is_main_model.

    All folders are one scan, whatever their number. Models may lack columns, which are then null, or have further ones. A
    row's model follows from the folder of its file.
    """
    records = parse_models(models)
    if not records:
        raise ValueError("no models are registered")
    folders = [f"{root.rstrip('/')}/{r['model_path'].lstrip('/')}" if root else r["model_path"] for r in records]
    rows = spark.read.option("mergeSchema", "true").parquet(*folders)
    file = F.regexp_replace(F.url_decode(F.col("_metadata.file_path")), "^[a-zA-Z0-9+.-]+:/+", "/")
    tags = F.lit(None)
    for record, folder in zip(records, folders):
        place = re.sub("^[a-zA-Z0-9+.-]+:/+", "/", folder).rstrip("/") + "/"
        tag = F.struct(
            F.lit(as_date(record["model_date"])).alias("model_date"), F.lit(record["model_type"]).alias("model_type"), F.lit(record["is_main_model"]).alias("is_main_model")
        )
        tags = F.when(file.startswith(place), tag).otherwise(tags)
    return rows.select("*", tags.alias("_model")).select(*rows.columns, "_model.*")
