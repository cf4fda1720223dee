import math
import os
from decimal import Decimal

import pytest
from pyspark.ml.classification import OneVsRest, RandomForestClassifier
from pyspark.sql import functions as F

from shelfline.operators.aggregates import count_matrix, quantile_cuts
from shelfline.plans import bias_model as B
from shelfline.session import scratch_dir
from shelfline.sources.files import read_scoring_csv

LABELS = ["accurate", "over-forecast", "under-forecast"]


@pytest.fixture(scope="module")
def rows(spark):
    row = F.col("id")
    return spark.range(600).select(
        "id",
        (row % 50 * 10).cast("double").alias("demand_forecast"),
        (row % 7).cast("double").alias("price"),
        (row % 5 * 5).cast("double").alias("discount"),
        F.when(row % 2 == 0, "yes").otherwise("no").alias("Holiday_Promotion"),
        F.element_at(F.array(*map(F.lit, ["Sunny", "Rainy", "Cloudy"])), (row % 3 + 1).cast("int")).alias(
            "weather_condition"
        ),
        F.element_at(F.array(F.lit("Winter"), F.lit("Summer")), (row % 2 + 1).cast("int")).alias("seasonality"),
        F.when(row % 50 < 15, LABELS[2]).when(row % 50 < 30, LABELS[0]).otherwise(LABELS[1]).alias(B.LABEL),
    )


def test_fit_score_save_load(spark, rows):
    model = B.fit(rows, B.forest(num_trees=5))
    assert model.stages[0].labels == LABELS
    assert B.known_labels(model)["weather_condition"] == ["cloudy", "rainy", "sunny"]
    scored = B.score(model, rows)
    assert B.accuracy(scored).first().accuracy > Decimal("0.9")
    restored = B.load(B.save(model, os.path.join(scratch_dir(spark, "model"), "m")))
    assert B.score(restored, rows).exceptAll(scored).isEmpty()


def test_scoring_without_a_label_and_with_unknown_categories(spark, rows):
    model = B.fit(rows, B.forest(num_trees=5))
    row = B.score(model, read_scoring_csv(spark).withColumn("weather_condition", F.lit("Hail"))).first()
    assert row[B.PREDICTED] == "over-forecast"
    assert (row.Holiday_Promotion, row.weather_condition, row.seasonality) == (1, 0, 0)


def test_boosted_trees_take_three_classes(rows):
    train = rows.limit(200)
    scored = B.score(B.fit(train, B.boosted_trees(max_iter=3, max_depth=3)), train)
    assert B.accuracy(scored).first().accuracy > Decimal("0.9")


def test_split_is_repeatable_and_stratified(rows):
    split = B.stratified_split(rows, ["id"])
    again = B.stratified_split(rows.repartition(5), ["id"])
    assert split.select("id", "is_train").exceptAll(again.select("id", "is_train")).isEmpty()
    shares = split.groupBy(B.LABEL).agg((F.count_if("is_train") / F.count("*")).alias("share")).collect()
    assert len(shares) == 3 and all(abs(row.share - 0.8) < 0.02 for row in shares)
    other = B.stratified_split(rows, ["id"], seed=7)
    assert not split.select("id", "is_train").exceptAll(other.select("id", "is_train")).isEmpty()


def test_evaluation_by_hand(spark):
    pairs = spark.createDataFrame(
        [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("b", "c")] * 2, f"{B.LABEL} string, {B.PREDICTED} string"
    )
    assert B.accuracy(pairs).first().accuracy == Decimal("0.625")
    report = {r.label: (r.precision, r.recall, r.f1, r.support) for r in B.class_report(pairs).collect()}
    assert report["a"] == (1, Decimal("0.75"), Decimal("0.857143"), 4)
    assert report["b"] == (Decimal("0.666667"), Decimal("0.5"), Decimal("0.571429"), 4)
    assert report["c"] == (0, 0, 0, 0)
    means = {r.average: (r.precision, r.recall) for r in B.average_report(B.class_report(pairs)).collect()}
    assert means["macro"] == (Decimal("0.5556"), Decimal("0.4167"))
    assert means["weighted"] == (Decimal("0.8333"), Decimal("0.6250"))
    matrix = {r[B.LABEL]: (r.a, r.b, r.c) for r in count_matrix(pairs, B.LABEL, B.PREDICTED, "abc").collect()}
    assert matrix == {"a": (3, 1, 0), "b": (0, 2, 2)}


def test_best_model_is_the_more_accurate_one(rows):
    candidates = {"stump": B.forest(num_trees=1, max_depth=1), "forest": B.forest(num_trees=5)}
    best, model, scores = B.best_model(candidates, rows, rows)
    assert best == max(scores, key=scores.get) and B.score(model, rows).count() == 600


def test_boosted_trees_pass_over_folded_rows(rows, monkeypatch):
    seen, fit = [], OneVsRest._fit

    def spied(self, dataset):
        seen.append(dataset.agg(F.count("*"), F.sum(B.COPIES)).first())
        return fit(self, dataset)

    monkeypatch.setattr(OneVsRest, "_fit", spied)
    model = B.fit(rows.unionByName(rows), B.boosted_trees(max_iter=2, max_depth=3))
    assert seen[0][0] <= 600 and seen[0][1] == 1200
    assert B.accuracy(B.score(model, rows)).first().accuracy > Decimal("0.9")


def test_a_forest_draws_from_unfolded_rows(rows, monkeypatch):
    monkeypatch.setattr(B, "folded", None)
    assert B.score(B.fit(rows, B.forest(num_trees=2)), rows).count() == 600


def test_a_forest_passes_over_folded_rows_drawn_copy_by_copy(rows, monkeypatch):
    seen, fit = [], RandomForestClassifier._fit

    def spied(self, dataset):
        seen.append(dataset.agg(F.count("*"), F.sum(self.getWeightCol())).first())
        return fit(self, dataset)

    monkeypatch.setattr(RandomForestClassifier, "_fit", spied)
    many = rows.crossJoin(rows.sparkSession.range(20).select())
    model = B.fit(many, B.forest(num_trees=6))
    assert model.stages[-2].getNumTrees == 6 and model.stages[-2].numClasses == 3
    assert all(count <= 600 and abs(draws - 12000) < 700 for count, draws in seen) and len(seen) == 6
    assert len({draws for _, draws in seen}) > 1
    assert B.accuracy(B.score(model, rows)).first().accuracy > Decimal("0.9")


def test_draws_do_not_depend_on_the_partitions(rows):
    labelled = rows.withColumns({"label": F.col("id") % 3 / F.lit(1.0), **{name: F.col("price") for name in B.CODES}})
    first, again = (B.drawn(part, ["price", *B.CODES], 3) for part in (labelled, labelled.repartition(7)))
    assert first.exceptAll(again).isEmpty() and first.count() == again.count() == 21


def test_split_evaluates_its_rows_once(spark, rows):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(label):
        calls.add(1)
        return label

    assert B.stratified_split(rows.withColumn(B.LABEL, counted(B.LABEL)), ["id"]).count() == 600
    assert calls.value == 600


def test_quantiles_count_a_value_once_a_pass(spark, monkeypatch):
    values = sorted((i * 7919 % 5000) ** 2 / 100 - 1000 for i in range(999))
    shares = [i / 32 for i in range(1, 32)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v double").select(F.col("v").cast("decimal(18,4)").alias("v"))
    monkeypatch.setattr(F, "explode", None)
    cuts = quantile_cuts(df, "v", shares, bins=16).first()
    assert [float(cut) for cut in cuts] == [values[math.ceil(share * 999) - 1] for share in shares]
