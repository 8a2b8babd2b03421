"""Queries over the corpus tables, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyscope.llm import alignment, bagminhash, exact, hosts, licences, lm, mixing, multi_index, packing, pieces, quality, runs, warc
from tallyscope.llm.common import WORD, fold, read, text_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_gru_scores")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under the corpus's own language model."""
    return lm.score_documents(read(spark, sf_dir, "documents"))


TEMPLATE_ROWS = ", ".join(f"('{name}', '{text}')" for name, text in licences.TEMPLATES.items())


@query(
    "op2_licence_scan",
    rf"""
    WITH f AS (
      SELECT doc_id, coalesce(source, 'none') AS s, coalesce(lang, 'none') AS l, coalesce(text, '') AS text FROM documents
    ), p AS (
      SELECT doc_id, text, doc_id % 10 = 0 AS speaks,
        CASE WHEN doc_id % 100 = 0 THEN s WHEN doc_id % 20 = 0 THEN s || '/' || l ELSE s || '/' || l || '/b' || (doc_id // 500) END AS dir,
        CASE WHEN doc_id % 10 = 0 THEN 'LICENSE-' || doc_id ELSE doc_id || '.txt' END AS name
      FROM f
    ), templates(licence, text) AS (VALUES {TEMPLATE_ROWS}),
    tt AS (
      SELECT licence, term, count(*) AS n FROM (SELECT licence, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM templates) GROUP BY ALL
    ), df AS (
      SELECT v.term, count(x.term) AS df
      FROM (SELECT DISTINCT term FROM tt) v
      LEFT JOIN (SELECT unnest(list_distinct(regexp_extract_all(lower(text), '[a-z0-9]+'))) AS term FROM p) x ON v.term = x.term
      GROUP BY 1
    ), idf AS (
      SELECT term, ln((1 + (SELECT count(*) FROM p)) / (1 + df)::DOUBLE) + 1 AS idf FROM df
    ), tw AS (
      SELECT licence, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY licence)) AS weight FROM tt JOIN idf USING (term)
    ), lines AS (
      SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS line, unnest(string_split(text, chr(10))) AS text FROM p
    ), lt AS (
      SELECT doc_id, line, term, count(*) * any_value(idf) AS w
      FROM (SELECT doc_id, line, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS term FROM lines) JOIN idf USING (term)
      GROUP BY ALL
    ), dots AS (
      SELECT doc_id, line, licence, sum(w * weight) AS dot FROM lt JOIN tw USING (term) GROUP BY ALL
    ), norms AS (
      SELECT doc_id, line, sqrt(sum(w * w)) AS norm FROM lt GROUP BY ALL
    ), near AS (
      SELECT doc_id, licence, round(dot / norm, 9) AS score FROM dots JOIN norms USING (doc_id, line) WHERE round(dot / norm, 9) >= 0.8
    ), own AS (
      SELECT doc_id, licence, score FROM near QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, licence) = 1
    ), given AS (
      SELECT dir, licence FROM own JOIN p USING (doc_id) WHERE speaks
      QUALIFY row_number() OVER (PARTITION BY dir ORDER BY score DESC, dir || '/' || name) = 1
    ), inherited AS (
      SELECT d.dir, g.dir AS above, g.licence
      FROM (SELECT DISTINCT dir FROM p) d JOIN given g ON d.dir = g.dir OR starts_with(d.dir, g.dir || '/')
      QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(g.dir) DESC) = 1
    )
    SELECT p.doc_id, p.dir || '/' || p.name AS path, coalesce(o.licence, i.licence) AS licence, o.score,
      CASE WHEN o.licence IS NOT NULL THEN 'header' ELSE i.above END AS origin
    FROM p LEFT JOIN own o ON p.doc_id = o.doc_id LEFT JOIN inherited i ON p.dir = i.dir
    """,
)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, the documents being files of a tree by source, language and number."""
    i = F.col("doc_id")
    source, lang = (F.coalesce(c, F.lit("none")) for c in ("source", "lang"))
    folder = (
        F.when(i % 100 == 0, source)
        .when(i % 20 == 0, F.concat_ws("/", source, lang))
        .otherwise(F.concat_ws("/", source, lang, F.concat(F.lit("b"), F.floor(i / 500))))
    )
    name = F.when(i % 10 == 0, F.concat(F.lit("LICENSE-"), i)).otherwise(F.concat(F.coalesce(i.cast("string"), F.lit("")), F.lit(".txt")))
    files = read(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", folder, name).alias("path"), "text")
    return licences.scan(files, carry=("doc_id",))


@query("op3_sampled_pieces")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sampled segmentation of every document."""
    return pieces.encode(read(spark, sf_dir, "documents"))


@query(
    "op4_exact_dedup",
    r"""
    WITH t AS (
      SELECT doc_id, length(coalesce(text, '')) AS points, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
      FROM documents
    ), k AS (
      SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY points DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY norm) AS group_size
      FROM t
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
    """,
)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and the document of its group of equal texts that stays."""
    return exact.exact_dedup(read(spark, sf_dir, "documents")).drop("raw_hash")


@query(
    "op5_curriculum_mix",
    r"""
    WITH d AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
    ), s AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        (row_number() OVER (ORDER BY source NULLS LAST) - 1) AS place
      FROM d GROUP BY source
    ), w AS (
      SELECT *, CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight,
        2.0::DOUBLE * source_size AS ceiling, 1.5::DOUBLE * sum(source_size) OVER () AS to_deal,
        CASE place % 3 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 1.5::DOUBLE ELSE 1.0::DOUBLE END AS a,
        CASE place % 3 WHEN 0 THEN 1.5::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS b
      FROM s
    ), f AS (
      SELECT *, (to_deal - coalesce(sum(ceiling) OVER (ORDER BY ceiling / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
        / sum(weight) OVER (ORDER BY ceiling / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
      FROM w
    ), g AS (
      SELECT lv AS level FROM f WHERE lv <= ceiling / weight ORDER BY ceiling / weight, place LIMIT 1
    ), t AS (
      SELECT source, source_size, a, b, least(ceiling, level * weight) AS target FROM f, g
    ), o AS (
      SELECT d.*, t.source_size, t.target, t.a, t.b, CAST(floor(t.target + 1e-6) AS BIGINT) AS goal,
        CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(CAST(d.doc_id AS VARCHAR)), d.doc_id
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ), p AS (
      SELECT *, start / goal::DOUBLE AS x, 2 * a / (a + b) AS c, 2 * b / (a + b) AS e FROM o
    )
    SELECT doc_id, size, source_size, target,
      CAST(greatest(0, least(start + size, goal) - start)
        + greatest(0, least(start + source_size + size, goal) - (start + source_size)) AS BIGINT) AS taken,
      CASE WHEN start < goal AND size > 0 THEN
        CASE WHEN abs(e - c) < 1e-12 THEN x
          WHEN sqrt(greatest(c * c + 2 * (e - c) * x, 0.0)) + c <= 0 THEN 0.0
          ELSE 2 * x / (sqrt(greatest(c * c + 2 * (e - c) * x, 0.0)) + c) END END AS first_position
    FROM p
    """,
)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, and when training first reads it, in that order."""
    mixed = mixing.mix(read(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position")


@query("op6_multi_index")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors found for every 50th vector."""
    return multi_index.search(read(spark, sf_dir, "embeddings"))


@query(
    "op7_dictionary_warc",
    """
    WITH p AS (
      SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
    ), f AS (
      SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
    )
    SELECT page_id, payload_bytes, payload_digest,
      CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
    FROM f
    """,
)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives say of every page."""
    return warc.archive_and_read(read(spark, sf_dir, "pages")).drop("url")


@query("op8_compression_quality")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Probability that a document is good, for every document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.score_quality(docs, read(spark, sf_dir, "labels").select("doc_id", "quality"))
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


@query("op9_host_trust")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every page may be read; trust and distrust are spread until they no longer change."""
    return hosts.judge(read(spark, sf_dir, "pages"), rounds=None)


@query("op10_bagminhash")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return bagminhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op11_best_fit_packing")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequence and offset of every piece of every document."""
    return packing.pack(read(spark, sf_dir, "documents"))


@query("op12_token_alignment")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the tokens of two vocabularies lie against each other in every document."""
    return alignment.align(read(spark, sf_dir, "documents"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs`` in which the words of every tenth text repeat from some word on, at a period that follows from doc_id."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeated(words):
        n = F.size(words)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        return F.array_join(F.transform(words, lambda w, i: F.when(i < a, w).otherwise(F.get(words, a + (i - a) % p))), " ")

    # The words are bound to a name, or they would be found anew for each of them.
    planted = F.transform(F.array(F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))), repeated)[0]
    return docs.select("doc_id", text_of().alias("text")).withColumn("text", F.when(h % 10 == 0, planted).otherwise(F.col("text")))


@query("op13_periodic_runs")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of words in every document, the strongest of them, and checksums of all runs and of the text without repeats."""
    found = runs.find_runs(with_planted_runs(read(spark, sf_dir, "documents")))
    none = F.lit(None).cast("struct<start: long, length: long, period: long>")
    best = F.aggregate("runs", none, lambda a, r: F.when(a.isNull() | (r["length"] * a["period"] > a["length"] * r["period"]), r).otherwise(a))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.*",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        digest(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        digest(F.col("collapsed")).alias("collapsed_sha256"),
    )
