"""Absolute scale: medians against ground truth, blending of signals, population."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyscope.contracts import require
from tallyscope.functions.exprs import hash_fold, ratio
from tallyscope.functions.quantile import grouped_quantiles
from tallyscope.sources.tables import as_date

MIN_TRUTH = 30_000
MIN_TRUTH_TRAIN = 15_000
MIN_DAU = 10
LOOKBACK_DAYS = 28
KEYS = ["country", "app"]
SIGNALS = ("raw_est", "ios_share", "mp")

NUMERIC_FEATURES = [
    "averageUserRating", "hasInAppPurchases", "userRatingCount", "rank", "true_n_users", "true_n_sessions",
    "n_users_err", "n_sessions_err", "raw_est_indicator", "ios_share_est_indicator", "mp_est_indicator", "avg_est",
    "raw_est_ratio", "ios_share_est_ratio", "mp_est_ratio",
]
CATEGORICAL_FEATURES = ["category", "country", "contentAdvisoryRating"]


def fix_aliases(df: DataFrame, aliases: DataFrame, column: str = "app") -> DataFrame:
    """Replace ids listed in ``aliases`` (app, fixed_app)."""
    fixes = aliases.select(F.col("app").alias(column), "fixed_app")
    cols = [F.coalesce("fixed_app", column).alias(column) if c == column else F.col(c) for c in df.columns]
    return df.join(fixes, column, "left").select(*cols)


def store_features(metadata: DataFrame, ranks: DataFrame, countries: list[int]) -> DataFrame:
    """Store metadata of every app in every country with its chart rank, -1 when not in the charts."""
    placed = metadata.withColumn("country", F.explode(F.array(*[F.lit(c) for c in countries])))
    charts = ranks.filter(F.col("country").isin(countries)).select("id", "country", "category", "rank")
    return placed.join(charts, ["id", "country", "category"], "left").fillna(-1, ["rank"]).drop("id")


def median_scale(
    estimates: DataFrame,
    truth: DataFrame,
    column: str,
    min_users: float = 0,
    min_truth: float = MIN_TRUTH,
    by_date: bool = True,
) -> DataFrame:
    """Per country: median over apps of mean truth / mean estimate, as a whole number ``adj`` (long: users over a small share).

    Days of the truth the estimate lacks count 0. ``estimates`` needs a device count ``k`` only with ``min_users``.
    """
    on = ["country", "date", "app"] if by_date else KEYS
    k = F.coalesce(F.col("k"), F.lit(0)) if min_users else F.lit(0)
    value = estimates.select(*on, F.col(column).alias("_est"), *(["k"] if min_users else []))
    apps = (
        truth.select("country", "date", "app", "active_users")
        .join(value, on, "left")
        .groupBy(*KEYS)
        .agg(
            F.avg("active_users").alias("_truth"),
            F.avg(F.coalesce(F.col("_est"), F.lit(0.0))).alias("_est"),
            F.avg(k).alias("_k"),
        )
        .filter((F.col("_est") > 0) & (F.col("_k") >= min_users) & (F.col("_truth") > min_truth))
        .withColumn("_adj", ratio("_truth", "_est"))
    )
    medians = grouped_quantiles(apps, ["country"], "_adj", {"adj": 0.5}, discrete=True)
    return medians.select("country", F.floor("adj").cast("bigint").alias("adj"))


def scale_signal(estimates: DataFrame, scale: DataFrame, p: str, name: str) -> DataFrame:
    """Estimate times the country's scale, as ``{name}_active_users`` beside ``{name}_adj``."""
    keep = [c for c in ("date", "country", "app") if c in estimates.columns]
    return estimates.join(scale, "country").select(
        *keep,
        (F.col(p) * F.col("adj")).alias(f"{name}_active_users"),
        F.col("adj").alias(f"{name}_adj"),
    )


def average_signal(scaled: DataFrame, name: str, n_days: Column, with_days: bool = False) -> DataFrame:
    """Mean over the days of the period (absent days count 0) per (country, app)."""
    days = [F.count("date").alias("days_count"), F.min("date").alias("first_seen")] if with_days else []
    return scaled.groupBy(*KEYS).agg(
        F.max(f"{name}_adj").alias(f"{name}_adj"),
        (F.sum(f"{name}_active_users") / n_days).alias(f"{name}_active_users"),
        *days,
    )


def count_days(estimates: DataFrame) -> DataFrame:
    return estimates.select("date").distinct().agg(F.count(F.lit(1)).alias("n_days"))


def join_signals(raw: DataFrame, share: DataFrame, field: DataFrame) -> DataFrame:
    """All (country, app) any signal knows; absent signals are 0."""
    users = [f"{s}_active_users" for s in SIGNALS]
    return (
        raw.join(share, KEYS, "full_outer")
        .join(field, KEYS, "full_outer")
        .fillna(0, subset=users)
        .select(
            *KEYS, "raw_est_active_users", "raw_est_adj", "ios_share_active_users", "ios_share_adj",
            "mp_active_users", "mp_adj", "days_count", "first_seen",
        )
    )


def join_signals_for_training(truth: DataFrame, raw: DataFrame, share: DataFrame, field: DataFrame) -> DataFrame:
    """Mean truth and mean signals over the truth's days, per (country, app) of the truth."""
    day = ["country", "app", "date"]
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0))
    return (
        truth.select(*day, F.col("active_users").alias("ga_active_users"))
        .join(raw, day, "left")
        .join(share, day, "left")
        .groupBy(*KEYS)
        .agg(
            F.avg("ga_active_users").alias("ga_active_users"),
            F.avg(zero("raw_est_active_users")).alias("raw_est_active_users"),
            F.avg(zero("ios_share_active_users")).alias("ios_share_active_users"),
            F.max("raw_est_adj").alias("raw_est_adj"),
            F.max("ios_share_adj").alias("ios_share_adj"),
        )
        .join(field.select(*KEYS, "mp_active_users", "mp_adj"), KEYS, "left")
        .fillna(0, subset=["mp_active_users"])
    )


def blend_features(df: DataFrame, min_dau: float = MIN_DAU) -> DataFrame:
    """Indicators, mean of the present signals, and each signal over the other two."""
    users = {s: F.col(f"{s}_active_users") for s in SIGNALS}
    label = {"raw_est": "raw_est", "ios_share": "ios_share_est", "mp": "mp_est"}
    out = df
    for s in SIGNALS:
        out = out.withColumn(f"{label[s]}_indicator", F.when(users[s] > min_dau, 1).otherwise(0))
    total = sum((users[s] for s in SIGNALS), F.lit(0.0))
    present = sum((F.col(f"{label[s]}_indicator") for s in SIGNALS), F.lit(0))
    out = out.withColumn("avg_est", ratio(total, present))
    for s in SIGNALS:
        others = sum((users[o] for o in SIGNALS if o != s), F.lit(0.0))
        out = out.withColumn(f"{label[s]}_ratio", ratio(users[s], others))
    return out


def add_features(signals: DataFrame, store: DataFrame, evaluation: DataFrame, min_dau: float = MIN_DAU) -> DataFrame:
    """Signals with store and evaluation features attached."""
    return blend_features(signals.join(store, KEYS, "left").join(evaluation, "app", "left"), min_dau)


def closest_signal(truth: str = "ga_active_users", min_dau: float = MIN_DAU) -> Column:
    """Index of the present signal nearest to the truth; the lower index on ties, NULL without a signal."""
    options = [
        F.when(
            F.col(f"{s}_active_users") > min_dau,
            F.struct(
                F.abs(F.col(truth) - F.col(f"{s}_active_users")).cast("double").alias("error"), F.lit(i).alias("at")
            ),
        )
        for i, s in enumerate(SIGNALS)
    ]
    return F.array_min(F.array_compact(F.array(*options))).getField("at")


def train_blend_classifier(
    train: DataFrame, seed: int = 1, folds: int = 3, min_truth: float = MIN_TRUTH_TRAIN, depths=(2, 5, 8), num_trees: int = 20
):
    """Random forest that picks the best signal, tuned by cross-validation on Spark.

    Rows need a raw signal, enough truth and a label. Categories unseen in training are skipped, missing numbers are -1.
    A forest needs as many bins as its largest feature has categories; these are known once the categories are indexed.
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import StringIndexer, VectorAssembler
    from pyspark.ml.tuning import CrossValidator, ParamGridBuilder

    indexed = [f"{c}_idx" for c in CATEGORICAL_FEATURES]
    rows = training_rows(train, min_truth)
    indexer = StringIndexer(inputCols=CATEGORICAL_FEATURES, outputCols=indexed, handleInvalid="skip").fit(rows)
    bins = max(32, *map(len, indexer.labelsArray))
    assembler = VectorAssembler(inputCols=[*indexed, *NUMERIC_FEATURES], outputCol="features")
    forest = RandomForestClassifier(
        featuresCol="features", labelCol="label", probabilityCol="probability", seed=seed, numTrees=num_trees, maxBins=bins
    )
    grid = ParamGridBuilder().addGrid(forest.maxDepth, list(depths)).build()
    tuned = CrossValidator(
        estimator=forest,
        estimatorParamMaps=grid,
        evaluator=MulticlassClassificationEvaluator(metricName="accuracy"),
        numFolds=folds,
        seed=seed,
    )
    return Pipeline(stages=[indexer, assembler, tuned]).fit(rows)


def training_rows(df: DataFrame, min_truth: float = MIN_TRUTH_TRAIN) -> DataFrame:
    usable = (F.col("raw_est_active_users") > MIN_DAU) & (F.col("ga_active_users") > min_truth)
    return ready_features(df).filter(usable & F.col("label").isNotNull())


def ready_features(df: DataFrame) -> DataFrame:
    """Features as the classifier takes them: categories as text, numbers without gaps."""
    require(df, *CATEGORICAL_FEATURES, *NUMERIC_FEATURES)
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in NUMERIC_FEATURES}
    return df.withColumns(numbers).withColumns({c: F.col(c).cast("string") for c in CATEGORICAL_FEATURES})


def blend_probabilities(
    data: DataFrame, train: DataFrame, folds: int = 3, seed: int = 1, min_truth: float = MIN_TRUTH_TRAIN, **forest
) -> DataFrame:
    """Class probabilities of the apps with a raw signal; training apps get theirs from a fold that left them out."""
    from pyspark.ml.functions import vector_to_array

    cols = ["raw_est_model_p", "ios_share_est_model_p", "mp_est_model_p"]

    def score(model, rows: DataFrame) -> DataFrame:
        p = vector_to_array("probability")
        scored = model.transform(ready_features(rows))
        return scored.select(*KEYS, *[F.coalesce(F.get(p, F.lit(i)), F.lit(0.0)).alias(c) for i, c in enumerate(cols)])

    scored = score(train_blend_classifier(train, seed, folds, min_truth, **forest), data.filter("raw_est_indicator = 1"))
    numbered = train.withColumn("_fold", hash_fold(folds, "country", "app"))
    held_out = None
    for fold in range(folds):
        model = train_blend_classifier(numbered.filter(F.col("_fold") != fold), seed, folds, min_truth, **forest)
        part = score(model, training_rows(numbered.filter(F.col("_fold") == fold), min_truth))
        held_out = part if held_out is None else held_out.unionByName(part)
    own = held_out.select(*KEYS, *[F.col(c).alias(f"_{c}") for c in cols])
    return scored.join(own, KEYS, "left").select(
        *KEYS, *[F.coalesce(F.col(f"_{c}"), F.col(c)).alias(c) for c in cols]
    )


def blended_scale(
    signals: DataFrame, probabilities: DataFrame, raw: DataFrame, population: DataFrame, day
) -> DataFrame:
    """Probability-weighted mean of the present signals, and the factor that scales the raw estimate to it.

    Only apps first seen on the first day of the look-back qualify.
    """
    weights = [
        F.col(f"{s}_indicator") * F.col(f"{s}_model_p") for s in ("raw_est", "ios_share_est", "mp_est")
    ]
    users = [F.col(f"{s}_active_users") for s in SIGNALS]
    top = sum((w * u for w, u in zip(weights, users)), F.lit(0.0))
    blended = ratio(top, sum(weights, F.lit(0.0)))
    full_period = F.datediff(F.lit(as_date(day)), F.col("first_seen")) == LOOKBACK_DAYS - 1
    return (
        signals.filter(full_period & (F.col("days_count") >= 1))
        .join(probabilities, KEYS)
        .join(population, "country")
        .withColumn("blended_active_users", blended)
        .withColumn(
            "scale_factor",
            F.try_divide(
                ratio("blended_active_users", "population_size"), ratio("raw_est_active_users", "raw_est_adj")
            ),
        )
        .join(raw.select(*KEYS, F.col("p").alias("raw_est_p"), "n"), KEYS, "left")
        .withColumn("p", F.coalesce("raw_est_p", F.lit(0.0)) * F.col("scale_factor"))
        .select(
            *KEYS, "p", "n", "scale_factor", "raw_est_active_users", "raw_est_adj", "ios_share_active_users",
            "ios_share_adj", "mp_active_users", "mp_adj", "days_count", "raw_est_model_p", "ios_share_est_model_p",
            "mp_est_model_p", "blended_active_users",
        )
    )


def population_scale(estimates: DataFrame, population: DataFrame, bundles: DataFrame) -> DataFrame:
    """Active users = p times the population, with the store id of the app where known."""
    ids = bundles.select(F.col("bundle_id").alias("app"), F.col("id").alias("track_id")).distinct()
    return (
        estimates.join(population.select("country", "population_size"), "country")
        .join(ids, "app", "left")
        .select(
            *[c for c in ("date",) if c in estimates.columns], "country", "app", "track_id",
            (F.col("p") * F.col("population_size")).alias("active_users"),
        )
    )
