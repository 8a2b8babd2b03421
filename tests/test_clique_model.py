import random

import pytest

from tallyscope.operators import cliques


def labelled(spark, seed, turn=1):
    rng = random.Random(seed)
    rows = []
    for k in range(200):
        values = [rng.random() for _ in cliques.FEATURES]
        rows.append((f"c{k}", f"b{k % 7}", *values, float(turn * (values[0] + values[1] - 1) > 0)))
    shape = "clique_id string, bundle_id string, " + ", ".join(f"`{f}` double" for f in cliques.FEATURES) + ", label double"
    return spark.createDataFrame(rows, shape)


def predicted(rows, model):
    return {r["clique_id"]: r["predict"] for r in cliques.predict_candidates(rows, model).collect()}


def test_a_kept_model_scores_like_the_fresh_one_and_is_chosen_by_date(spark, tmp_path):
    path, rows = f"{tmp_path}/models", labelled(spark, 1)
    with pytest.raises(FileNotFoundError):
        cliques.load_model(spark, path, "2024-02-01")
    models = {day: cliques.train_clique_model(labelled(spark, 2, turn), num_trees=5) for day, turn in (("2024-01-07", 1), ("2024-01-14", -1))}
    for day, model in models.items():
        cliques.save_model(model, spark, path, day)
    # A model that was not written to its end does not count.
    models["2024-01-14"].write().save(f"{path}/model_date=2024-01-20")
    for day, own in (("2024-01-07", "2024-01-07"), ("2024-01-13", "2024-01-07"), ("2024-01-31", "2024-01-14")):
        assert predicted(rows, cliques.load_model(spark, path, day)) == predicted(rows, models[own])
    with pytest.raises(FileNotFoundError):
        cliques.load_model(spark, path, "2024-01-06")
    assert predicted(rows, models["2024-01-07"]) != predicted(rows, models["2024-01-14"])
