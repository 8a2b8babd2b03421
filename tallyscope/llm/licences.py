"""Licences of files: from a notice in the file itself, else from the nearest directory above with a licence file."""

from __future__ import annotations

import re
from collections import Counter
from math import log, sqrt
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.functions.lineage import cut_lineage
from tallyscope.llm.common import text_of

#: Notices as they are commonly written, by SPDX identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Use of this source code is governed by a BSD-style license.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
TERM = r"[a-z0-9]+"
#: Names of files that speak for their directory.
LICENCE_FILE = r"^(?i)(licen[cs]e|copying|notice)[^/]*$"


def full_texts() -> dict[str, str]:
    """Whole licences by SPDX identifier, from the files beside this module."""
    return {path.stem: path.read_text() for path in sorted((Path(__file__).parent / "texts").glob("*.txt"))}


def terms(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def vocabulary(templates: dict[str, str]) -> list[str]:
    return sorted({t for text in templates.values() for t in re.findall(TERM, text.lower())})


def weigh(templates: dict[str, str], frequency: dict[str, int], files: int) -> tuple[dict[str, float], dict[str, dict[str, float]]]:
    """Inverse document frequencies of the templates' terms, and the templates as unit vectors."""
    idf = {t: log((1 + files) / (1 + frequency.get(t, 0))) + 1 for t in vocabulary(templates)}
    unit = {}
    for name, text in templates.items():
        found = re.findall(TERM, text.lower())
        vector = {t: found.count(t) * idf[t] for t in found}
        norm = sqrt(sum(w * w for w in vector.values()))
        unit[name] = {t: w / norm for t, w in vector.items()}
    return idf, unit


def telling(unit: dict[str, dict[str, float]], least: float) -> list[str]:
    """Terms of which a line must hold one to reach a cosine of ``least`` with any template: the others are too light even together."""
    found = set()
    for vector in unit.values():
        light = 0.0
        for term, w in sorted(vector.items(), key=lambda x: (x[1], x[0])):
            light += w * w
            if light >= (least - 1e-9) ** 2:
                found.add(term)
    return sorted(found)


def runs_like(name: str, template: str, vector: dict[str, float], least: float) -> Column:
    """Of the terms of a text (column ``all``), those runs (line, terms) that are as long as a template and may reach ``least`` with it.

    Those are runs that hold a heavy term of the template and terms of it that weigh enough together: the cosine is at
    most the root of the sum of their squared weights.
    """
    long, heavy = len(re.findall(TERM, template.lower())), telling({name: vector}, least)

    def squared(x: Column) -> Column:
        case = F.lit(0.0)
        for term, w in vector.items():
            case = F.when(x == term, F.lit(w * w)).otherwise(case)
        return case

    run = lambda i: F.slice("all", i + 1, long)
    at = F.filter(F.transform("all", lambda x, i: F.when(x.isin(heavy), i)), lambda i: i.isNotNull())
    starts = F.array_distinct(F.flatten(F.transform(at, lambda i: F.sequence(F.greatest(i - (long - 1), F.lit(0)), i))))
    held = lambda i: F.aggregate(F.array_distinct(run(i)), F.lit(0.0), lambda total, x: total + squared(x))
    kept = F.filter(starts, lambda i: held(i) >= (least - 1e-6) ** 2)
    return F.transform(kept, lambda i: F.struct(F.concat(F.lit(f"{name}/"), i.cast("string")).alias("line"), run(i).alias("terms")))


def runs(text: DataFrame, templates: dict[str, str], unit: dict[str, dict[str, float]], least: float) -> DataFrame:
    """(path, line, terms): runs of terms, across lines, by the template they may be near to."""
    found = [runs_like(name, templates[name], vector, least) for name, vector in unit.items()]
    return text.select("path", terms(F.col("text")).alias("all")).select("path", F.inline(F.concat(*found)))


def whole(files: DataFrame, texts: dict[str, str], least: float = 0.95) -> DataFrame:
    """(path, licence, score): the licence whose text a licence file is as a whole, with a cosine of ``least`` or more.

    Document frequencies are those in the texts themselves, so terms that all licences have count nothing, and trees full
    of one licence don't take its weight away.
    """
    counts = {name: Counter(re.findall(TERM, text.lower())) for name, text in texts.items()}
    seen = Counter(t for c in counts.values() for t in c)
    idf = {t: log((1 + len(texts)) / (1 + n)) for t, n in seen.items()}
    norm = {name: sqrt(sum((n * idf[t]) ** 2 for t, n in c.items())) for name, c in counts.items()}
    rows = [(t, name, idf[t], n * idf[t] / norm[name]) for name, c in counts.items() for t, n in c.items() if norm[name] and idf[t]]
    weights = files.sparkSession.createDataFrame(rows, "term string, licence string, idf double, weight double")
    held = (
        files.filter(F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE))
        .select("path", F.xxhash64("text").alias("line"), F.explode(terms(text_of())).alias("term"))
        .groupBy("path", "line", "term")
        .agg(F.count("*").alias("n"))
    )
    held = held.join(F.broadcast(weights.select("term", "idf").distinct()), "term").select("path", "line", "term", (F.col("n") * F.col("idf")).alias("w"))
    return nearest_of(cut_lineage(held), weights, least)


def nearest_of(lines: DataFrame, weights: DataFrame, least: float) -> DataFrame:
    """(path, licence, score): the nearest template of any (path, line) of weighted terms with a cosine of ``least`` or more."""
    norms = lines.groupBy("path", "line").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    dots = lines.join(F.broadcast(weights.select("term", "licence", "weight")), "term").groupBy("path", "line", "licence").agg(F.sum(F.col("w") * F.col("weight")).alias("dot"))
    near = dots.join(norms, ["path", "line"]).withColumn("score", F.round(F.col("dot") / F.col("norm"), 9)).filter(F.col("score") >= least)
    return best_of(near)


def best_of(near: DataFrame) -> DataFrame:
    best = F.min(F.struct((-F.col("score")).alias("by"), "licence")).alias("best")
    return near.groupBy("path").agg(best).select("path", F.col("best.licence").alias("licence"), (-F.col("best.by")).alias("score"))


def notices(files: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8) -> DataFrame:
    """(path, licence, score): the template nearest to any line or run of a file, of those with a cosine of ``least`` or more.

    Besides the lines, runs of terms as long as a template are compared, so notices that are wrapped over lines or stand in
    long ones are found, too. Lines, runs and templates are vectors of term counts times inverse document frequency, over the terms of the templates; the
    frequencies are those in all files. Only lines that hold a term heavy enough to make a match possible are compared, by
    joining their terms with the templates' terms. Of equally near templates the first by name is taken.
    """
    words = F.array(*map(F.lit, vocabulary(templates)))
    text = files.select("path", text_of().alias("text"))
    counted = text.select(F.explode(F.array_intersect(terms(F.col("text")), words)).alias("term")).groupBy("term").count()
    frequency = {r["term"]: r["count"] for r in counted.collect()}  # the templates' terms at most
    idf, unit = weigh(templates, frequency, files.count())
    spark = files.sparkSession
    weights = spark.createDataFrame([(t, n, idf[t], w) for n, v in unit.items() for t, w in v.items()], "term string, licence string, idf double, weight double")
    idfs = spark.createDataFrame(list(idf.items()), "term string, idf double")
    heavy = rf"(?i)(?<![a-z0-9])({'|'.join(telling(unit, least))})(?![a-z0-9])"
    text = text.filter(F.col("text").rlike(heavy))
    lines = (
        text.select("path", F.posexplode(F.split("text", "\n")).alias("line", "text"))
        .filter(F.col("text").rlike(heavy))
        .select("path", F.col("line").cast("string").alias("line"), F.explode(terms(F.col("text"))).alias("term"))
    )
    lines = (
        lines.unionByName(runs(text, templates, unit, least).select("path", "line", F.explode("terms").alias("term")))
        .groupBy("path", "line", "term")
        .agg(F.count("*").alias("n"))
    )
    lines = cut_lineage(lines.join(F.broadcast(idfs), "term").select("path", "line", "term", (F.col("n") * F.col("idf")).alias("w")))
    return nearest_of(lines, weights, least)


def directory_of(path: Column) -> Column:
    return F.regexp_extract(path, r"^(.*)/[^/]*$", 1)


def scan(
    files: DataFrame, templates: dict[str, str] = TEMPLATES, least: float = 0.8, texts: dict[str, str] | None = None, carry: tuple[str, ...] = ()
) -> DataFrame:
    """(path, licence, score, origin) for every row of ``files`` (path, text, …), after the columns named in ``carry``.

    A file with a notice has that licence (origin: header). Any other has the licence of the nearest directory, its own or
    one above, with a licence file, that is, a file of a telling name with a notice (origin: the directory; score null). A
    file of such a name that as a whole is one of ``texts`` (by default ``full_texts()``) has that licence like a notice. Of
    several licence files in a directory the one of the highest score speaks, then the smallest path. Else all are null.
    The root's name is empty. Null paths count as empty, null texts, too; rows that repeat a path share the result, from
    any of their texts. No files give no rows. Other columns are ignored.

    Directories are joined, not files: every directory looks up its ancestors, and the files then look up their directory.
    """
    files = files.select(*carry, F.coalesce("path", F.lit("")).alias("path"), "text")
    own = cut_lineage(best_of(notices(files, templates, least).unionByName(whole(files, full_texts() if texts is None else texts))))
    named = own.filter(F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENCE_FILE)).withColumn("dir", directory_of(F.col("path")))
    speaks = named.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("by"), "path", "licence")).alias("best")).select("dir", F.col("best.licence").alias("given"))
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(parts, 1, k), "/").alias("above")))
    dirs = files.select(directory_of(F.col("path")).alias("dir")).distinct()
    nearest = (
        dirs.select("dir", F.explode(above).alias("a"))
        .join(speaks.withColumnRenamed("dir", "above"), F.col("a.above") == F.col("above"))
        .groupBy("dir")
        .agg(F.max(F.struct("a.depth", "above", "given")).alias("from"))
        .select("dir", F.col("from.above").alias("above"), F.col("from.given").alias("given"))
    )
    rows = files.select(*carry, "path", directory_of(F.col("path")).alias("dir"))
    return (
        rows.join(own, "path", "left")
        .join(nearest, "dir", "left")
        .select(
            *carry,
            "path",
            F.coalesce("licence", "given").alias("licence"),
            "score",
            F.when(F.col("licence").isNotNull(), F.lit("header")).otherwise(F.col("above")).alias("origin"),
        )
    )
