"""Forecast-bias classifier on Spark ML, trained on the forecast-deviation mart."""

from multiprocessing.pool import ThreadPool

from pyspark import SparkContext, TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, OneVsRest, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import IndexToString, QuantileDiscretizer, StringIndexer, VectorAssembler
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.functions.arithmetic import zero_to_null
from shelfline.functions.cleaning import known_or_first, lower_text, yes_no_to_digit
from shelfline.session import scratch_dir

# Feature, label and output columns.
NUMERIC = ["demand_forecast", "price", "discount"]
CATEGORICAL = ["Holiday_Promotion", "weather_condition", "seasonality"]
FEATURES = NUMERIC + CATEGORICAL
LABEL = "forecast_accuracy_flag"
PREDICTED = "forecast_predicted_flag"

CODES = [f"{name}_code" for name in CATEGORICAL]
BINNED = [f"{name}_bin" for name in NUMERIC]
BINS = 32  # as many as Spark's trees cut a number into
BIN_ERROR = 0.001  # of the rank of a bin's bound
COPIES = "copies"
DRAW_PARTS = 64  # each with a generator of its own
TREES_AT_ONCE = 4
SEED = 42
SPLIT_BUCKETS = 4096
SCORE_PLACES = 6


def clean(rows):
    """Numbers as doubles, categories in lower case, promotion as '1' / '0'."""
    texts = {name: lower_text(F.col(name)) for name in CATEGORICAL}
    texts["Holiday_Promotion"] = yes_no_to_digit(texts["Holiday_Promotion"])
    return rows.withColumns({**texts, **{name: F.col(name).cast("double") for name in NUMERIC}})


def training_rows(deviation, *keep):
    """Feature and label columns of the forecast-deviation mart, categories still as shown."""
    promotion = F.when(F.col("is_promotion_active"), "yes").otherwise("no")
    return deviation.select(
        *keep,
        *[F.col(name).cast("double").alias(name) for name in NUMERIC],
        promotion.alias("Holiday_Promotion"),
        "weather_condition",
        F.col("seaonality").alias("seasonality"),
        LABEL,
    )


def label_encoder():
    """Labels to 0, 1, 2 in alphabetical order."""
    return StringIndexer(inputCol=LABEL, outputCol="label", stringOrderType="alphabetAsc")


def category_encoder():
    return StringIndexer(inputCols=CATEGORICAL, outputCols=CODES, stringOrderType="alphabetAsc")


def assembler(numbers=NUMERIC):
    return VectorAssembler(inputCols=[*numbers, *CODES], outputCol="features")


def number_bins():
    """Numbers to the number of their quantile bin; bounds come from all rows."""
    return QuantileDiscretizer(inputCols=NUMERIC, outputCols=BINNED, numBuckets=BINS, relativeError=BIN_ERROR)


def boosted_trees(max_iter=20, max_depth=5):
    """Gradient-boosted trees, one per class against the rest."""
    trees = GBTClassifier(maxIter=max_iter, maxDepth=max_depth, seed=SEED)
    return OneVsRest(classifier=trees, parallelism=3)


def forest(num_trees=20, max_depth=5):
    return RandomForestClassifier(numTrees=num_trees, maxDepth=max_depth, seed=SEED)


def stratified_split(rows, keys, label=LABEL, share=0.8, seed=SEED):
    """``is_train`` per row: the same on every run, and ``share`` of each label.

    Rows are hashed into buckets by key and seed. The counts per label and bucket (a few
    thousand rows however large the data, so they are broadcast) tell up to which bucket a label's
    share reaches. The hashed rows are written once, as both the counts and the result read them.
    """
    bucket = F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(SPLIT_BUCKETS))
    path = scratch_dir(rows.sparkSession, "hashed-rows")
    rows.withColumn("_bucket", bucket).write.parquet(path)
    hashed = rows.sparkSession.read.parquet(path)
    by_label = Window.partitionBy(label)
    so_far = by_label.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cuts = (
        hashed.groupBy(label, "_bucket")
        .agg(F.count("*").alias("_rows"))
        .select(
            label,
            "_bucket",
            (F.sum("_rows").over(so_far) <= share * F.sum("_rows").over(by_label)).alias("is_train"),
        )
    )
    return hashed.join(F.broadcast(cuts), [label, "_bucket"]).drop("_bucket").select(*rows.columns, "is_train")


def _draws_rows(classifier):
    """Whether each tree draws its own rows, so that equal rows may not be folded into one weighted row."""
    return classifier.hasParam("bootstrap") and classifier.getOrDefault("bootstrap")


def folded(coded, features):
    """Equal rows of label and features as one row with their number, written once."""
    path = scratch_dir(coded.sparkSession, "folded-rows")
    coded.groupBy("label", *features).agg(F.count("*").cast("double").alias(COPIES)).write.parquet(path)
    return coded.sparkSession.read.parquet(path)


def draw_of(tree):
    return f"draw_{tree}"


def drawn(coded, features, trees, share=1.0, seed=SEED):
    """Equal rows of label and features as one row, with how often each tree draws it, written once.

    A bootstrap draws every row Poisson(``share``) times for each tree, so ``n`` equal rows together
    Poisson(``n * share``) times: these are the draws of the unfolded rows. Rows are dealt and sorted by their
    values and each part has its own generator, so the draws do not depend on the cluster.
    """
    columns, draws = ["label", *features], [draw_of(tree) for tree in range(trees)]

    def draw(frames):
        import numpy as np

        generator = np.random.default_rng([seed, TaskContext.get().partitionId()])
        for frame in frames:
            counts = generator.poisson(frame[COPIES].to_numpy()[:, None] * share, (len(frame), trees))
            yield frame[columns].assign(**{name: counts[:, i].astype("float64") for i, name in enumerate(draws)})

    counted = coded.groupBy(*columns).agg(F.count("*").alias(COPIES))
    placed = counted.repartition(DRAW_PARTS, *columns).sortWithinPartitions(*columns)
    path = scratch_dir(coded.sparkSession, "drawn-rows")
    placed.mapInPandas(draw, ", ".join(f"`{name}` double" for name in [*columns, *draws])).write.parquet(path)
    # Label and codes stay categories; bins of numbers stay numbers.
    categories = {name: coded.schema[name].metadata for name in ("label", *CODES)}
    rows = coded.sparkSession.read.parquet(path)
    return rows.select(*[F.col(name).alias(name, metadata=categories.get(name, {})) for name in rows.columns])


def fit_forest(classifier, rows):
    """A forest of trees fitted one by one, each on the rows that it draws (:func:`drawn`)."""
    trees, subset = classifier.getNumTrees(), classifier.getFeatureSubsetStrategy()
    if subset == "auto":
        subset = "all" if trees == 1 else "sqrt"  # as for the whole forest
    alone = {
        classifier.numTrees: 1,
        classifier.bootstrap: False,
        classifier.subsamplingRate: 1.0,
        classifier.featureSubsetStrategy: subset,
    }

    def fit_tree(tree):
        own = {classifier.weightCol: draw_of(tree), classifier.seed: classifier.getSeed() + tree}
        return classifier.copy({**alone, **own}).fit(rows.where(F.col(draw_of(tree)) > 0))

    with ThreadPool(TREES_AT_ONCE) as pool:
        fitted = pool.map(inheritable_thread_target(rows.sparkSession)(fit_tree), range(trees))
    return _joined(classifier, [model._java_obj for model in fitted])


def _joined(classifier, forests):
    """One forest of the trees of several forests of one tree."""
    context = SparkContext._active_spark_context
    models = context._jvm.org.apache.spark.ml.classification
    trees = context._gateway.new_array(models.DecisionTreeClassificationModel, len(forests))
    for i, forest in enumerate(forests):
        trees[i] = forest.trees()[0]
    whole = models.RandomForestClassificationModel(classifier.uid, trees, forests[0].numFeatures(), forests[0].numClasses())
    model = classifier._copyValues(RandomForestClassificationModel(whole))
    model._transfer_params_to_java()
    return model


def fit(training, classifier=None):
    """One fitted pipeline: encoders, bins, features, classifier and label decoder.

    Trees pass over their rows some hundred times. They see a number only by its bin, so rows of equal
    bins, codes and label are folded into one row before the first pass; there are at most as many as
    combinations of these. Boosted trees get their number as weight; a forest draws rows for each tree and
    gets for each how often its copies are drawn.
    """
    classifier = classifier or boosted_trees()
    cleaned = clean(training).select(*FEATURES, LABEL)
    coding = Pipeline(stages=[label_encoder(), category_encoder(), number_bins()]).fit(cleaned)
    vectors, coded = assembler(BINNED), coding.transform(cleaned)
    if _draws_rows(classifier):
        rows = drawn(coded, BINNED + CODES, classifier.getNumTrees(), classifier.getSubsamplingRate(), classifier.getSeed())
        model = fit_forest(classifier, vectors.transform(rows))
    else:
        rows = folded(coded, BINNED + CODES)
        model = classifier.copy({classifier.weightCol: COPIES}).fit(vectors.transform(rows))
    decoder = IndexToString(inputCol="prediction", outputCol=PREDICTED, labels=coding.stages[0].labels)
    return PipelineModel([*coding.stages, vectors, model, decoder])


def known_labels(model):
    """Fitted categories per categorical feature."""
    return dict(zip(CATEGORICAL, model.stages[1].labelsArray))


def prepare(model, rows):
    """Cleaned rows whose unknown categories are replaced by the first known one."""
    known = known_labels(model)
    return clean(rows).withColumns(
        {name: known_or_first(F.col(name), known[name]) for name in CATEGORICAL}
    )


def score(model, rows):
    """Rows with the predicted label; the features appear as they were encoded."""
    scored = model.transform(prepare(model, rows))
    codes = {name: F.col(code).cast("int") for name, code in zip(CATEGORICAL, CODES)}
    kept = [name for name in rows.columns if name not in CODES]
    return scored.withColumns(codes).select(*kept, PREDICTED)


def save(model, path):
    model.write().overwrite().save(path)
    return path


def load(path):
    return PipelineModel.load(path)


def best_model(candidates, train, test):
    """Fit every named classifier; the one with the best test accuracy and all accuracies."""
    fitted = {name: fit(train, classifier) for name, classifier in candidates.items()}
    scores = {name: accuracy(score(model, test)).first()["accuracy"] for name, model in fitted.items()}
    best = max(scores, key=scores.get)
    return best, fitted[best], scores


# Evaluation on (label, prediction) columns


def _share(part, whole):
    exact = part.cast("decimal(18,0)") / zero_to_null(whole.cast("decimal(18,0)"))
    return F.round(exact, SCORE_PLACES).cast("decimal(18,6)")


def accuracy(pairs, *by, actual=LABEL, predicted=PREDICTED):
    hits = F.count_if(F.col(actual) == F.col(predicted))
    return pairs.groupBy(*by).agg(_share(hits, F.count("*")).alias("accuracy"))


def class_report(pairs, actual=LABEL, predicted=PREDICTED):
    """Precision, recall, F1 and support per label, from the counts of label pairs."""
    n, none = F.col("n"), F.lit(0).cast("long")
    hit = F.when(F.col(actual) == F.col(predicted), n).otherwise(none)

    def entry(label, support, predicted_rows, hits):
        names = ["label", "support", "predicted", "hits"]
        values = [F.col(label), support, predicted_rows, hits]
        return F.struct(*[value.alias(name) for name, value in zip(names, values)])

    totals = (
        pairs.groupBy(actual, predicted)
        .agg(F.count("*").alias("n"))
        .select(F.inline(F.array(entry(actual, n, none, hit), entry(predicted, none, n, none))))
        .groupBy("label")
        .agg(*[F.sum(name).alias(name) for name in ("support", "predicted", "hits")])
    )
    hits, support, predicted_rows = F.col("hits"), F.col("support"), F.col("predicted")
    return totals.select(
        "label",
        F.coalesce(_share(hits, predicted_rows), F.lit(0)).cast("decimal(18,6)").alias("precision"),
        F.coalesce(_share(hits, support), F.lit(0)).cast("decimal(18,6)").alias("recall"),
        F.coalesce(_share(2 * hits, support + predicted_rows), F.lit(0)).cast("decimal(18,6)").alias("f1"),
        "support",
    )


def average_report(report):
    """Macro (plain) and weighted (by support) averages of a class report."""
    names = ["precision", "recall", "f1"]
    labels, support = F.count("*"), F.sum("support")
    totals = report.agg(
        labels.alias("labels"),
        support.alias("support"),
        *[F.sum(name).alias(f"macro_{name}") for name in names],
        *[F.sum(F.col(name) * F.col("support")).alias(f"weighted_{name}") for name in names],
    )

    def line(kind, divisor):
        means = [
            F.round(F.col(f"{kind}_{name}") / zero_to_null(F.col(divisor).cast("decimal(18,0)")), 4)
            .cast("decimal(18,4)")
            .alias(name)
            for name in names
        ]
        return F.struct(F.lit(kind).alias("average"), *means, F.col("support"))

    return totals.select(F.inline(F.array(line("macro", "labels"), line("weighted", "support"))))
