import math
import os
import random

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from shelfline.plans import bias_model as B
from shelfline.plans import softmax_trees as S
from shelfline.schemas import TRAINING
from shelfline.session import scratch_dir


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    made = []
    for _ in range(900):
        demand, price, weather = r.randint(0, 400) / 4, r.randint(1, 9) * 1.5, r.choice(["Sunny", "Rainy", "Snowy"])
        label = "over-forecast" if demand > 60 and weather != "Rainy" else "under-forecast" if price > 9 else "accurate"
        made.append((demand, price, 5.0, r.choice(["Yes", "No"]), weather, "Winter", label if r.random() < 0.95 else "accurate"))
    return spark.createDataFrame(made, TRAINING).repartition(3)


@pytest.fixture(scope="module")
def model(rows):
    return S.fit(rows, rounds=4, depth=3)


def test_log_loss_falls_every_round(rows, model):
    assert math.isclose(model.losses[0], math.log(3), rel_tol=1e-6)
    assert all(after < before for before, after in zip(model.losses, model.losses[1:]))
    assert B.accuracy(S.score(model, rows)).first().accuracy > 0.93


def test_the_same_rows_give_the_same_trees(rows, model):
    assert S.fit(rows.repartition(7), rounds=4, depth=3) == model


def test_trees_equal_a_plain_fit(rows, model):
    """First round by hand: gradients of equal shares, the best split by plain sums, leaf values."""
    data = [tuple(row) for row in S.clean(rows).select(*model.features, B.LABEL).collect()]
    bins = [[sum(value > cut for cut in model.cuts[name]) if name in model.cuts else max(0, model.codes[name].index(value)) for name, value in zip(model.features, row)] for row in data]
    unit = round((1 / 3) * S.ONE), round((1 / 3) * (2 / 3) * S.ONE), round((1 / 3 - 1) * S.ONE)
    for c, label in enumerate(model.labels):
        g = [unit[2] if row[-1] == label else unit[0] for row in data]
        best = (1e-9, None, None)
        for f in range(len(model.features)):
            for cut in sorted({b[f] for b in bins})[:-1]:
                left = [i for i, b in enumerate(bins) if b[f] <= cut]
                gl, hl, ga, ha = sum(g[i] for i in left), unit[1] * len(left), sum(g), unit[1] * len(g)
                gain = S._gain(gl, hl) + S._gain(ga - gl, ha - hl) - S._gain(ga, ha)
                if min(hl, ha - hl) >= S.ONE and gain > best[0] * (1 + 1e-12):
                    best = (gain, f, cut)
        assert tuple(model.trees[0][c][0][:2]) == best[1:]


def test_probabilities_sum_to_one_and_a_saved_model_scores_alike(spark, rows, model):
    restored = S.load(spark, S.save(model, spark, os.path.join(scratch_dir(spark, "softmax"), "model")))
    assert restored == model
    scored = S.score(restored, rows)
    assert scored.columns == [*rows.columns, B.PREDICTED, "probabilities"]
    assert all(math.isclose(sum(row.probabilities), 1, rel_tol=1e-9) for row in scored.collect())
    odd = spark.createDataFrame([(None, 1.0, None, None, "Hail", "Summer", None)], TRAINING)
    assert S.score(model, odd).first()[B.PREDICTED] in model.labels


def test_sums_of_many_equal_rows_stay_exact():
    """Both parts of a whole number add up to it, and sums of parts to sums of numbers."""
    spark = SparkSession.active()
    numbers = [n * S.ONE * sign + i for i, n in enumerate((1, 3 << 20, 1 << 32)) for sign in (1, -1)]
    rows = spark.createDataFrame([(n,) for n in numbers * 9], "n long")
    low, high = rows.agg(*[F.sum(part(F.col("n"))) for part in S.PARTS]).first()
    assert low + (high << 32) == 9 * sum(numbers)


def test_bins_by_halving_equal_counted_cuts(spark):
    cuts = [-1.5, 0.0, 2.25, 7.0, 7.5]
    values = [-9.0, -1.5, -1.0, 0.0, 0.1, 2.25, 7.0, 7.2, 7.5, 8.0, None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", S._passed(F.col("v"), cuts, 0, len(cuts)).alias("bin"))
    assert all(row.bin == (0 if row.v is None else sum(row.v > cut for cut in cuts)) for row in rows.collect())
