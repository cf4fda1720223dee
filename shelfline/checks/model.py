"""Forecast-bias classifier: preparation, fit, scoring and evaluation."""

import os

from pyspark.ml.feature import IndexToString
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from shelfline.checks import sql
from shelfline.checks.registry import query
from shelfline.functions.rules import accuracy_flag
from shelfline.operators.aggregates import count_matrix
from shelfline.plans import bias_model as B
from shelfline.plans import marts
from shelfline.plans import softmax_trees as softmax
from shelfline.session import scratch_dir
from shelfline.sources import driver_tables as D

KEY = ["full_date", "store_id", "product_id"]
LABELS = ["accurate", "over-forecast", "under-forecast"]

TRAINING_SQL = f"""{sql.cents('demand_c', 'demand_forecast')}, {sql.cents('price_c', 'price')},
       CAST(disc AS DOUBLE) AS discount, CASE WHEN promo THEN 'yes' ELSE 'no' END AS "Holiday_Promotion",
       weather AS weather_condition, season AS seasonality, {sql.flag()} AS forecast_accuracy_flag"""
LABEL_CODE_SQL = f"""CAST(CASE {sql.flag()} WHEN 'accurate' THEN 0 WHEN 'over-forecast' THEN 1 ELSE 2 END AS DOUBLE)"""


def training(spark, sf_dir):
    return B.training_rows(marts.forecast_deviation(D.star(spark, sf_dir)), *KEY)


def split(spark, sf_dir):
    """Training and test rows, written once so that every fit reads the same files."""
    path = scratch_dir(spark, "training")
    B.stratified_split(training(spark, sf_dir), KEY).write.parquet(path)
    rows = spark.read.parquet(path)
    return rows.where("is_train").drop("is_train"), rows.where(~F.col("is_train")).drop("is_train")


def label_pairs(spark, sf_dir):
    """Given (label, prediction) pairs: the flag at ten and at five percent tolerance."""
    forecast, sold = F.col("demand_forecast"), F.col("units_sold")
    return D.inventory(spark, sf_dir).select(
        F.col("full_date").cast("string").alias("full_date"),
        "store_id",
        "product_id",
        accuracy_flag(forecast, sold).alias(B.LABEL),
        accuracy_flag(forecast, sold, "0.05").alias(B.PREDICTED),
    )


PAIRS = f"pairs AS (SELECT {sql.flag(10)} AS actual, {sql.flag(5)} AS predicted FROM flat)"
REPORT = f"""report AS (
  SELECT label, h, s, p, CASE WHEN p = 0 THEN 0 ELSE {sql.half_up('h', 'NULLIF(p, 0)', 6)} END AS precision,
         CASE WHEN s = 0 THEN 0 ELSE {sql.half_up('h', 'NULLIF(s, 0)', 6)} END AS recall,
         CASE WHEN s + p = 0 THEN 0 ELSE {sql.half_up('2 * h', 'NULLIF(s + p, 0)', 6)} END AS f1
  FROM (SELECT label, COUNT(*) FILTER (actual = label AND predicted = label) AS h,
               COUNT(*) FILTER (actual = label) AS s, COUNT(*) FILTER (predicted = label) AS p
        FROM pairs, (VALUES ('accurate'), ('over-forecast'), ('under-forecast')) AS labels(label) GROUP BY 1)
  WHERE s + p > 0)"""


@query(
    "l1_feature_columns",
    sql.long(f"SELECT {sql.text()}, store_id, product_id, {TRAINING_SQL} FROM flat"),
)
def feature_columns(spark, sf_dir):
    return training(spark, sf_dir)


@query(
    "l2_label_codes",
    sql.long(
        f"""SELECT {sql.flag()} AS forecast_accuracy_flag, {LABEL_CODE_SQL} AS label, COUNT(*) AS row_count
            FROM flat GROUP BY 1, 2"""
    ),
)
def label_codes(spark, sf_dir):
    rows = training(spark, sf_dir).select(B.LABEL)
    coded = B.label_encoder().fit(rows).transform(rows)
    return coded.groupBy(B.LABEL, "label").agg(F.count("*").alias("row_count"))


CODES_SQL = """CAST(CASE WHEN promo THEN 1 ELSE 0 END AS DOUBLE) AS "Holiday_Promotion_code",
       CAST(CASE weather WHEN 'Cloudy' THEN 0 WHEN 'Rainy' THEN 1 WHEN 'Snowy' THEN 2 ELSE 3 END AS DOUBLE)
         AS weather_condition_code,
       CAST(CASE season WHEN 'Autumn' THEN 0 WHEN 'Spring' THEN 1 WHEN 'Summer' THEN 2 ELSE 3 END AS DOUBLE)
         AS seasonality_code"""


@query(
    "l3_category_codes",
    sql.long(
        f"""SELECT CASE WHEN promo THEN '1' ELSE '0' END AS "Holiday_Promotion", lower(weather) AS weather_condition,
                   lower(season) AS seasonality, {CODES_SQL}, COUNT(*) AS row_count FROM flat GROUP BY ALL"""
    ),
)
def category_codes(spark, sf_dir):
    rows = B.clean(training(spark, sf_dir)).select(*B.CATEGORICAL)
    coded = B.category_encoder().fit(rows).transform(rows)
    return coded.groupBy(*B.CATEGORICAL, *B.CODES).agg(F.count("*").alias("row_count"))


@query(
    "l4_assembled_features",
    sql.long(
        f"""SELECT {sql.text()}, store_id, product_id, {sql.cents('demand_c', 'demand_forecast')},
                   {sql.cents('price_c', 'price')}, CAST(disc AS DOUBLE) AS discount, {CODES_SQL} FROM flat"""
    ),
)
def assembled_features(spark, sf_dir):
    rows = B.clean(training(spark, sf_dir))
    coded = B.category_encoder().fit(rows).transform(rows)
    vector = vector_to_array(F.col("features"))
    return B.assembler().transform(coded).select(
        *KEY, *[vector[i].alias(name) for i, name in enumerate(B.NUMERIC + B.CODES)]
    )


@query(
    "l5_stratified_split",
    sql.long(
        f"""SELECT {sql.flag()} AS forecast_accuracy_flag, COUNT(*) AS row_count, TRUE AS within_one_percent
            FROM flat GROUP BY 1"""
    ),
)
def stratified_split(spark, sf_dir):
    share = F.count_if("is_train") / F.count("*")
    return (
        B.stratified_split(training(spark, sf_dir), KEY)
        .groupBy(B.LABEL)
        .agg(
            F.count("*").alias("row_count"),
            ((share >= 0.79) & (share <= 0.81)).alias("within_one_percent"),
        )
    )


@query(
    "l6_boosted_trees",
    sql.long(
        f"""SELECT {sql.flag()} AS forecast_accuracy_flag, COUNT(*) AS row_count, COUNT(*) AS known_predictions,
                   TRUE AS beats_majority FROM flat GROUP BY 1"""
    ),
)
def boosted_trees(spark, sf_dir):
    """All rows scored: rows per actual label, those with a known label predicted, and whether the
    model is right at least as often as the most common label would be."""
    train, test = split(spark, sf_dir)
    rows = train.unionByName(test)
    scored = B.score(B.fit(train), rows).select(B.LABEL, B.PREDICTED)
    right = F.count_if(F.col(B.LABEL) == F.col(B.PREDICTED)).alias("right")
    per_label = scored.groupBy(B.LABEL).agg(
        F.count("*").alias("row_count"), F.count_if(F.col(B.PREDICTED).isin(LABELS)).alias("known_predictions"), right
    )
    whole = per_label.agg(F.sum("right") >= F.max("row_count")).first()[0]
    return per_label.drop("right").withColumn("beats_majority", F.lit(whole))


@query(
    "l6_softmax_trees",
    sql.long(
        f"""SELECT {sql.flag()} AS forecast_accuracy_flag, COUNT(*) AS row_count, COUNT(*) AS known_predictions,
                   TRUE AS beats_majority, TRUE AS loss_falls_each_round FROM flat GROUP BY 1"""
    ),
)
def softmax_trees(spark, sf_dir):
    """As ``l6_boosted_trees`` with one model for all classes, whose log-loss must fall in every round."""
    train, test = split(spark, sf_dir)
    model = softmax.fit(train, rounds=3)
    scored = softmax.score(model, train.unionByName(test)).select(B.LABEL, B.PREDICTED)
    right = F.count_if(F.col(B.LABEL) == F.col(B.PREDICTED)).alias("right")
    per_label = scored.groupBy(B.LABEL).agg(
        F.count("*").alias("row_count"), F.count_if(F.col(B.PREDICTED).isin(LABELS)).alias("known_predictions"), right
    )
    whole = per_label.agg(F.sum("right") >= F.max("row_count")).first()[0]
    falls = all(after < before for before, after in zip(model.losses, model.losses[1:]))
    return per_label.drop("right").withColumns({"beats_majority": F.lit(whole), "loss_falls_each_round": F.lit(falls)})


@query(
    "l7_decoded_labels",
    sql.long(
        f"""SELECT {LABEL_CODE_SQL} AS label, {sql.flag()} AS forecast_predicted_flag, COUNT(*) AS row_count
            FROM flat GROUP BY 1, 2"""
    ),
)
def decoded_labels(spark, sf_dir):
    rows = training(spark, sf_dir).select(B.LABEL)
    encoder = B.label_encoder().fit(rows)
    decoder = IndexToString(inputCol="label", outputCol=B.PREDICTED, labels=encoder.labels)
    decoded = decoder.transform(encoder.transform(rows))
    return decoded.groupBy("label", B.PREDICTED).agg(F.count("*").alias("row_count"))


@query(
    "l8_best_model",
    """SELECT 'boosted trees' AS model, TRUE AS in_range, TRUE AS best_has_highest_score UNION ALL
       SELECT 'forest', TRUE, TRUE""",
)
def best_model(spark, sf_dir):
    """Every candidate with an accuracy between 0 and 1; the returned model, scored again and its hits
    counted anew, has the accuracy reported for the best name, and no other candidate's is higher."""
    train, test = split(spark, sf_dir)
    candidates = {"boosted trees": B.boosted_trees(), "forest": B.forest()}
    best, model, scores = B.best_model(candidates, train, test)
    again = B.score(model, test).select(F.avg((F.col(B.LABEL) == F.col(B.PREDICTED)).cast("int"))).first()[0]
    rows = [(name, float(score), name == best, again) for name, score in scores.items()]
    judged = spark.createDataFrame(rows, "model string, accuracy double, is_best boolean, again double")
    gap = F.col("accuracy") - F.col("again")
    return judged.select(
        "model",
        F.col("accuracy").between(0, 1).alias("in_range"),
        F.when(F.col("is_best"), F.abs(gap) < 1e-6).otherwise(gap < 1e-6).alias("best_has_highest_score"),
    )


@query(
    "l9_saved_model",
    sql.long("SELECT COUNT(*) AS row_count, COUNT(*) AS same_predictions FROM flat"),
)
def saved_model(spark, sf_dir):
    """All rows scored by the fitted model and by the model read back from its folder."""
    train, test = split(spark, sf_dir)
    rows = train.unionByName(test)
    fitted = B.fit(train, B.forest())
    restored = B.load(B.save(fitted, os.path.join(scratch_dir(spark, "l9"), "model")))
    again = B.score(restored, rows).select(*KEY, F.col(B.PREDICTED).alias("again"))
    both = B.score(fitted, rows).select(*KEY, B.PREDICTED).join(again, KEY)
    return both.agg(
        F.count("*").alias("row_count"),
        F.count_if(F.col(B.PREDICTED) == F.col("again")).alias("same_predictions"),
    )


@query(
    "l10_scored_rows",
    sql.long(
        f"""SELECT {sql.text()}, store_id, product_id, {sql.flag()} AS forecast_accuracy_flag, {CODES_SQL},
                   TRUE AS known_prediction FROM flat"""
    ),
)
def scored_rows(spark, sf_dir):
    """Every row with its feature codes and a prediction among the known labels."""
    train, test = split(spark, sf_dir)
    rows = train.unionByName(test)
    scored = B.score(B.fit(rows), rows)
    codes = [F.col(name).cast("double").alias(code) for name, code in zip(B.CATEGORICAL, B.CODES)]
    return scored.select(*KEY, B.LABEL, *codes, F.col(B.PREDICTED).isin(LABELS).alias("known_prediction"))


@query(
    "n1_accuracy",
    sql.long(
        f"""SELECT {sql.half_up('COUNT(*) FILTER (actual = predicted)', 'COUNT(*)', 6)} AS accuracy FROM pairs""",
        PAIRS,
    ),
)
def accuracy(spark, sf_dir):
    return B.accuracy(label_pairs(spark, sf_dir))


@query(
    "n2_class_report",
    sql.long("SELECT label, precision, recall, f1, s AS support FROM report", PAIRS, REPORT),
)
def class_report(spark, sf_dir):
    return B.class_report(label_pairs(spark, sf_dir))


def _micros(name):
    return f"CAST(round({name} * 1000000) AS HUGEINT)"


def _mean(kind, name):
    if kind == "macro":
        total, weight = f"SUM({_micros(name)})", "COUNT(*)"
    else:
        total, weight = f"SUM({_micros(name)} * s)", "SUM(s)"
    return f"{sql.half_up(total, f'1000000 * {weight}', 4)} AS {name}"


@query(
    "n3_average_report",
    sql.long(
        " UNION ALL ".join(
            f"""SELECT '{kind}' AS average, {_mean(kind, 'precision')}, {_mean(kind, 'recall')},
                       {_mean(kind, 'f1')}, CAST(SUM(s) AS BIGINT) AS support FROM report"""
            for kind in ("macro", "weighted")
        ),
        PAIRS,
        REPORT,
    ),
)
def average_report(spark, sf_dir):
    return B.average_report(B.class_report(label_pairs(spark, sf_dir)))


@query(
    "n4_confusion_matrix",
    sql.long(
        """SELECT actual AS forecast_accuracy_flag, COUNT(*) FILTER (predicted = 'accurate') AS "accurate",
                  COUNT(*) FILTER (predicted = 'over-forecast') AS "over-forecast",
                  COUNT(*) FILTER (predicted = 'under-forecast') AS "under-forecast" FROM pairs GROUP BY 1""",
        PAIRS,
    ),
)
def confusion_matrix(spark, sf_dir):
    return count_matrix(label_pairs(spark, sf_dir), B.LABEL, B.PREDICTED, LABELS)
