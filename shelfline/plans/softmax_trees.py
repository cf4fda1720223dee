"""Boosted trees with one objective for all classes: softmax log-loss, histograms summed by Spark.

Features are cut into at most ``BINS`` bins once. Every round grows one tree per class on the gradients
that the classes share: for each level one aggregation sums gradients and curvatures per class, node,
feature and bin, and the best splits come from those sums, at most
classes x nodes x features x bins rows on the driver, whatever the number of rows. Rows of equal bins and
label have equal gradients in every round, so they are folded into one weighted row before the first; the
rounds work on at most as many rows as there are combinations of bins and labels.

Gradients are rounded to whole multiples of 2^-30 before they are summed, so sums are exact, and the same
rows give the same trees on any cluster. Scores are staged after each round, which ends the lineage.
"""

import json
import math

from dataclasses import asdict, dataclass

from pyspark.sql import functions as F

from shelfline.operators.aggregates import quantile_cuts
from shelfline.plans.bias_model import CATEGORICAL, LABEL, NUMERIC, PREDICTED, clean
from shelfline.session import scratch_dir

BINS = 32
ONE = 1 << 30  # whole units of a gradient of 1
PENALTY = 1.0
LEAST_CURVATURE = 1.0
LOG_LOSS_FLOOR = 1e-15
# Sums of these two parts of whole numbers are exact in 64 bits for 2^31 numbers; the second counts 2^32.
PARTS = [lambda value: value.bitwiseAND(F.lit((1 << 32) - 1)), lambda value: F.shiftright(value, 32)]


@dataclass
class SoftmaxTrees:
    """``cuts``: upper bin bounds per number; ``codes``: known values per category; ``trees``: per round and
    class a list of nodes [feature, bin, left, right, value], a leaf having feature None."""

    labels: list
    cuts: dict
    codes: dict
    trees: list
    rate: float
    losses: list

    @property
    def features(self):
        return [*self.cuts, *self.codes]


def _staged(rows, name):
    path = scratch_dir(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _passed(value, cuts, least, most):
    """How many of the ascending cuts a value is above, by halving; none for NULL."""
    if least == most:
        return F.lit(least)
    middle = (least + most) // 2
    return F.when(value > F.lit(cuts[middle]), _passed(value, cuts, middle + 1, most)).otherwise(_passed(value, cuts, least, middle))


def _bins(model):
    """The bin of every feature; a category that was not seen counts as the first known one."""
    columns = [_passed(F.col(name), cuts, 0, len(cuts)) for name, cuts in model.cuts.items()]
    for name, known in model.codes.items():
        place = F.array_position(F.array(*[F.lit(value) for value in known]), F.col(name))
        columns.append(F.greatest(F.coalesce(place, F.lit(1)) - 1, F.lit(0)).cast("int"))
    return F.array(*columns)


def _leaf_number(tree, bins):
    """The number of the leaf that a row reaches, by as many steps as the tree is deep."""
    if len(tree) == 1:
        return F.lit(0)
    feature, cut, left, right = (
        F.array(*[F.lit(default(i) if node[0] is None else node[part]) for i, node in enumerate(tree)])
        for part, default in enumerate((lambda i: 0, lambda i: 0, lambda i: i, lambda i: i))
    )

    def step(at, _):
        return F.when(F.get(bins, F.get(feature, at)) <= F.get(cut, at), F.get(left, at)).otherwise(F.get(right, at))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_depth(tree))), F.lit(0), step)


def _depth(tree, node=0):
    feature, _, left, right, _ = tree[node]
    return 0 if feature is None else 1 + max(_depth(tree, left), _depth(tree, right))


def _value(tree, bins):
    return F.get(F.array(*[F.lit(float(node[4])) for node in tree]), _leaf_number(tree, bins))


def _shares(scores, k):
    """Softmax of an array of ``k`` scores, as a list of columns."""
    top = F.array_max(scores)
    powers = [F.exp(scores[i] - top) for i in range(k)]
    return [power / sum(powers[1:], powers[0]) for power in powers]


def _leaf_value(g, h, rate):
    return -rate * (g / ONE) / (h / ONE + PENALTY)


def _gain(g, h):
    return (g / ONE) ** 2 / (h / ONE + PENALTY)


def _best_split(sums, features):
    """(gain, feature, bin) of the best split of a node, from {feature: {bin: (g, h)}}; ties take the first."""
    best = (1e-9, None, None)
    for feature in range(features):
        cells = sums.get(feature, {})
        g, h = (sum(cell[i] for cell in cells.values()) for i in (0, 1))
        left_g = left_h = 0
        for cut in sorted(cells)[:-1]:
            left_g, left_h = left_g + cells[cut][0], left_h + cells[cut][1]
            if min(left_h, h - left_h) < LEAST_CURVATURE * ONE:
                continue
            gain = _gain(left_g, left_h) + _gain(g - left_g, h - left_h) - _gain(g, h)
            if gain > best[0] * (1 + 1e-12):
                best = (gain, feature, cut)
    return best


def _grow(rows, k, features, depth, rate):
    """One tree per class over rows (bins, g0.., h0..); one aggregation per level."""
    trees = [[[None, None, None, None, 0.0]] for _ in range(k)]
    open_nodes = [{0} for _ in range(k)]
    for level in range(depth + 1):
        cells = F.array(
            *[
                F.struct(F.lit(c).alias("c"), F.col(f"node{c}").alias("node"), F.lit(f).alias("f"), F.col("bins")[f].alias("bin"), F.col(f"g{c}").alias("g"), F.col(f"h{c}").alias("h"))
                for c in range(k)
                for f in range(features)
            ]
        )
        reached = rows.withColumns({f"node{c}": _leaf_number(trees[c], F.col("bins")) for c in range(k)})
        sums = reached.select(F.inline(cells)).groupBy("c", "node", "f", "bin").agg(*[F.sum(part(F.col(name))).alias(f"{name}_{i}") for name in "gh" for i, part in enumerate(PARTS)])
        found = {}
        for row in sums.collect():
            g, h = (row[f"{name}_0"] + (row[f"{name}_1"] << 32) for name in "gh")
            found.setdefault((row["c"], row["node"]), {}).setdefault(row["f"], {})[row["bin"]] = (g, h)
        for c in range(k):
            next_nodes = set()
            for node in sorted(open_nodes[c]):
                sums = found.get((c, node), {})
                g, h = (sum(cell[i] for cell in sums.get(0, {}).values()) for i in (0, 1))
                trees[c][node][4] = _leaf_value(g, h, rate)
                _, feature, cut = _best_split(sums, features) if level < depth else (0, None, None)
                if feature is not None:
                    left = len(trees[c])
                    trees[c] += [[None, None, None, None, trees[c][node][4]] for _ in range(2)]
                    trees[c][node] = [feature, cut, left, left + 1, 0.0]
                    next_nodes |= {left, left + 1}
            open_nodes[c] = next_nodes
        if not any(open_nodes):
            break
    return trees


def fit(training, rounds=8, depth=5, rate=0.4, label=LABEL):
    """The trees of ``rounds`` rounds; ``losses`` has the mean log-loss before the first and after each."""
    rows = _staged(clean(training).where(F.col(label).isNotNull()).select(*NUMERIC, *CATEGORICAL, label), "boosting-rows")
    seen = rows.select(*[F.collect_set(name).alias(name) for name in [label, *CATEGORICAL]]).first()
    labels = sorted(seen[label])
    codes = {name: sorted(seen[name]) or [""] for name in CATEGORICAL}
    shares = [(i + 1) / BINS for i in range(BINS - 1)]
    cuts = {}
    for name in NUMERIC:
        exact = rows.select(F.col(name).cast("decimal(18,4)").alias(name))
        cuts[name] = sorted({float(value) for value in quantile_cuts(exact, name, shares).first() if value is not None})
    model = SoftmaxTrees(labels, cuts, codes, [], rate, [])
    k = len(labels)
    position = F.array_position(F.array(*[F.lit(name) for name in labels]), F.col(label)).cast("int") - 1
    folded = rows.select(_bins(model).alias("bins"), position.alias("y")).groupBy("bins", "y").agg(F.count("*").alias("n"))
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    state = _staged(folded.withColumn("scores", F.array(*[F.lit(0.0)] * k)).repartition(parts), "boosting")

    def loss(state):
        right = F.lit(0.0)
        for i, share in enumerate(_shares(F.col("scores"), k)):
            right = F.when(F.col("y") == i, share).otherwise(right)
        units = F.round(-F.log(F.greatest(right, F.lit(LOG_LOSS_FLOOR))) * ONE).cast("decimal(20,0)")
        total, n = state.agg(F.sum(units * F.col("n").cast("decimal(18,0)")), F.sum("n")).first()
        return float(total) / ONE / n if n else math.nan

    model.losses.append(loss(state))
    for _ in range(rounds):
        grads = {}
        for i, share in enumerate(_shares(F.col("scores"), k)):
            hit = F.when(F.col("y") == i, 1.0).otherwise(0.0)
            grads[f"g{i}"] = F.round((share - hit) * ONE).cast("long") * F.col("n")
            grads[f"h{i}"] = F.round(share * (1 - share) * ONE).cast("long") * F.col("n")
        trees = _grow(_staged(state.select("bins", *[value.alias(name) for name, value in grads.items()]), "gradients"), k, len(model.features), depth, rate)
        moved = F.array(*[F.col("scores")[i] + _value(trees[i], F.col("bins")) for i in range(k)])
        state = _staged(state.withColumn("scores", moved), "boosting")
        model.trees.append(trees)
        model.losses.append(loss(state))
    return model


def score(model, rows):
    """``rows`` with the predicted label (ties: the first in alphabetical order) and ``probabilities``."""
    k, known = len(model.labels), F.col("__bins")
    names = rows.columns
    given = F.struct(*[F.col(f"`{name}`") for name in names])
    binned = clean(rows.withColumn("__row", given)).select("__row", _bins(model).alias("__bins"))
    totals = []
    for i in range(k):
        values = [_value(trees[i], known) for trees in model.trees]
        totals.append(sum(values[1:], values[0]) if values else F.lit(0.0))
    scored = binned.withColumn("__scores", F.array(*totals))
    label = F.array(*[F.lit(name) for name in model.labels])[(F.array_position(F.col("__scores"), F.array_max("__scores")) - 1).cast("int")]
    shares = F.array(*_shares(F.col("__scores"), k))
    return scored.select(*[F.col("__row")[name].alias(name) for name in names], label.alias(PREDICTED), shares.alias("probabilities"))


def save(model, spark, path):
    """The model as one line of JSON in a text folder of the shared file system."""
    spark.createDataFrame([(json.dumps(asdict(model)),)], "value string").coalesce(1).write.mode("overwrite").text(path)
    return path


def load(spark, path):
    return SoftmaxTrees(**json.loads(spark.read.text(path).first()[0]))
