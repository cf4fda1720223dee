"""Toxicity by a classifier chain of linear models.

The chain predicts its categories in order; each model sees the word features of a text and the
probabilities of the categories before it. In training those probabilities are out of fold: rows
are dealt into folds by a hash of their id, and a row's earlier probabilities come from models that
did not see it. The final models are fitted on all training rows. The default chain is ``poor``
(quality 0), then ``toxic``.

Features are the words of a text (without punctuation) and their first four and five letters, each
present or absent, hashed. A model keeps the ``KEPT`` features whose presence tells most about its
category (those with the largest absolute log-odds weighted by the number of rows) and fits a
logistic regression with a ridge penalty on them by Newton steps.

Training rows are a hash-chosen sample of at most about ``SAMPLE_ROWS`` labelled texts; features
are counted and models fitted by Spark tasks, one per fold and category. Only weights reach the
driver: folds times categories times ``KEPT`` numbers at most. Every text is scored whole.

Defined results: a null or empty text has no features and gets the chain's base rates; rows
without a label teach nothing; a category with one kind of label only gets that label's rate
(slightly smoothed) for all; with no labelled rows at all every probability is 0.5 and nothing is
rejected; equal texts get equal scores; a label row counts once per document row of its id; a
probability of exactly the threshold is not toxic; a row without an id has no label and is scored like
others; an empty table gives an empty result; other columns are not read, whatever their names.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfline.llm.common import _MULTIPLIER, byte_batches, give_back, mix, released, ship, stage

SAMPLE_ROWS = 12_000
FOLDS = 3
KEPT = 400
LEAST_ROWS = 4  # rows a feature must stand in to be kept
RIDGE = 1.0
STEPS = 12
THRESHOLD = 0.5
CATEGORIES = ("poor", "toxic")
BATCH_CHARS = 2 << 20


def features_of(texts):
    """Flat sorted distinct feature hashes per text and the number per text."""
    raw = ["" if t is None else t.lower() for t in texts]
    joined = "\n".join(raw) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    ends = np.cumsum([len(t) + 1 for t in raw])
    inside = _is_letter(codes)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8)))
    starts, stops = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(raw), np.int64)
    chars = mix((codes.astype(np.uint64) + np.uint64(1)) * _MULTIPLIER)
    lengths = stops - starts
    rolling, word, heads = np.zeros(len(starts), np.uint64), np.zeros(len(starts), np.uint64), []
    owner = np.searchsorted(ends, starts, side="right").astype(np.uint64)
    found, owners = [], []
    alive = np.arange(len(starts))
    for at in range(int(lengths.max())):
        alive = alive[lengths[alive] > at]
        rolling[alive] = mix(rolling[alive] + chars[starts[alive] + at] + np.uint64(at + 1))
        if at in (3, 4):
            longer = alive[lengths[alive] > at + 1]
            found.append(mix(rolling[longer] ^ np.uint64(at)))
            owners.append(owner[longer])
        if at >= 63:  # a run of over 64 letters is known by its first 64 and its length
            rolling[alive] ^= lengths[alive].astype(np.uint64)
            break
    found.append(rolling)
    owners.append(owner)
    features, texts_of = np.concatenate(found), np.concatenate(owners)
    order = np.lexsort((features, texts_of))
    features, texts_of = features[order], texts_of[order]
    new = np.concatenate([[True], (features[1:] != features[:-1]) | (texts_of[1:] != texts_of[:-1])])
    features, texts_of = features[new], texts_of[new]
    return features, np.bincount(texts_of.astype(np.int64), minlength=len(raw))


_LETTERS = None


def _is_letter(codes):
    global _LETTERS
    if _LETTERS is None:
        _LETTERS = np.array([chr(c).isalpha() for c in range(0x3000)])
    return np.where(codes < 0x3000, _LETTERS[np.minimum(codes, 0x2FFF)], True)


def fit_linear(features, counts, extra, labels, kept=KEPT):
    """Weights of one model: (feature hashes sorted, their weights, weights of extra columns, bias)."""
    rows = np.repeat(np.arange(len(counts)), counts)
    positive, total = labels.sum(), len(labels)
    if positive == 0 or positive == total or not total:
        rate = (positive + 0.5) / (total + 1)
        return np.empty(0, np.uint64), np.empty(0), np.zeros(extra.shape[1]), float(np.log(rate / (1 - rate)))
    names, inverse = np.unique(features, return_inverse=True)
    n_all = np.bincount(inverse, minlength=len(names))
    n_pos = np.bincount(inverse, labels[rows], len(names))
    odds = np.log((n_pos + 0.5) / (positive + 1)) - np.log((n_all - n_pos + 0.5) / (total - positive + 1))
    worth = np.where(n_all >= LEAST_ROWS, np.abs(odds) * np.sqrt(n_all), -1)
    best = np.sort(np.argsort(-worth, kind="stable")[:kept])
    best = best[worth[best] > 0]
    column = np.full(len(names), -1)
    column[best] = np.arange(len(best))
    used = column[inverse] >= 0
    x = np.zeros((total, len(best) + extra.shape[1] + 1), np.float32)
    x[rows[used], column[inverse[used]]] = 1
    x[:, len(best) : len(best) + extra.shape[1]] = extra
    x[:, -1] = 1
    weights = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], RIDGE)
    ridge[-1] = 1e-6
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - labels) + ridge * weights
        curvature = (x * np.maximum(p * (1 - p), 1e-6)[:, None].astype(np.float32)).T @ x + np.diag(ridge)
        step = np.linalg.solve(curvature.astype(np.float64), gradient)
        weights -= step
        if np.abs(step).max() < 1e-4:
            break
    return names[best], weights[: len(best)], weights[len(best) : -1], float(weights[-1])


def apply_linear(model, features, counts, extra):
    names, weights, extra_weights, bias = model
    score = np.full(len(counts), bias) + extra @ extra_weights
    if len(names) and len(features):
        at = np.minimum(np.searchsorted(names, features), len(names) - 1)
        value = np.where(names[at] == features, weights[at], 0.0)
        sums = np.concatenate([[0.0], np.cumsum(value)])
        ends = np.cumsum(counts)
        score += sums[ends] - sums[ends - counts]
    return 1 / (1 + np.exp(-np.clip(score, -30, 30)))


def _predict_chain(models, features, counts):
    extra = np.zeros((len(counts), 0))
    for model in models:
        extra = np.column_stack([extra, apply_linear(model, features, counts, extra)])
    return extra


def _pack(model):
    names, weights, extra, bias = model
    return names.astype("<u8").tobytes(), weights.astype("<f8").tobytes(), extra.astype("<f8").tobytes(), bias


def _unpack(row):
    return (
        np.frombuffer(row["names"], "<u8"),
        np.frombuffer(row["weights"], "<f8"),
        np.frombuffer(row["extra"], "<f8"),
        row["bias"],
    )


MODEL = "fold int, category int, names binary, weights binary, extra binary, bias double"


def training_rows(docs, labels, categories, id_col, text_col):
    """Staged rows (fold, features, one column per category, earlier: empty) of the labelled sample.

    ``labels`` has one 0/1 column per category. The text features are made here, once.
    """
    ship(docs.sparkSession)
    known = labels.where(" and ".join(f"`{c}` is not null" for c in categories)).where(F.col(id_col).isNotNull())
    share = min(1.0, SAMPLE_ROWS / max(known.count(), 1))
    place = F.pmod(F.xxhash64(F.col(id_col), F.lit("sample")), F.lit(1 << 30))
    chosen = known.where(place < int(share * (1 << 30)) + 1).select(F.col(id_col).alias("__id"), *categories)
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    joined = texts.join(F.broadcast(chosen), texts["doc_id"] == chosen["__id"]).drop("__id")  # at most about SAMPLE_ROWS rows

    def run(batches):
        for frame in byte_batches(released(batches), "text", BATCH_CHARS):
            features, counts = features_of(frame["text"])
            ends = np.cumsum(counts)
            out = frame[["doc_id", *categories]].copy()
            out["features"] = [features[e - n : e].astype("<u8").tobytes() for e, n in zip(ends, counts)]
            yield out

    columns = ", ".join(f"`{c}` double" for c in categories)
    typed = joined.select("doc_id", "text", *[F.col(c).cast("double").alias(c) for c in categories])
    made = typed.mapInPandas(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, {columns}, features binary")
    fold = F.pmod(F.xxhash64("doc_id", F.lit("fold")), F.lit(FOLDS)).cast("int")
    return stage(made.withColumn("fold", fold), "toxicity-training")


def _matrix(frame):
    parts = [np.frombuffer(f, "<u8") for f in frame["features"]]
    counts = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.empty(0, np.uint64)), counts


def fit_chain(docs, labels, categories, id_col="doc_id", text_col="text"):
    """The chain's models, one per category, or None without labelled rows.

    For each category in turn, tasks fit one model per left-out fold and one on all rows (fold -1);
    earlier probabilities of a row come from the models that left its fold out.
    """
    spark = docs.sparkSession
    rows = training_rows(docs, labels, categories, id_col, text_col)
    if rows.isEmpty():
        return None
    models = []  # per category {fold: model}
    for number, category in enumerate(categories):
        earlier = spark.sparkContext.broadcast(list(models))

        def fit(key, frame):
            frame = frame.sort_values(["doc_id", "features"])
            features, counts = _matrix(frame)
            extra = np.zeros((len(frame), 0))
            folds = frame["fold"].to_numpy()
            for before in earlier.value:
                column = np.zeros(len(frame))
                for fold in np.unique(folds):
                    mine = folds == fold
                    kept = np.repeat(mine, counts)
                    column[mine] = apply_linear(before[int(fold)], features[kept], counts[mine], extra[mine])
                extra = np.column_stack([extra, column])
            model = fit_linear(features, counts, extra, frame[category].to_numpy())
            return pd.DataFrame([(int(key[0]), number, *_pack(model))], columns=["fold", "category", "names", "weights", "extra", "bias"])

        copies = rows.withColumn("left_out", F.explode(F.array(*[F.lit(f) for f in range(-1, FOLDS)])))
        training = copies.where("left_out <> fold")
        fitted = training.groupBy("left_out").applyInPandas(fit, MODEL).collect()
        found = {row["fold"]: _unpack(row) for row in fitted}
        models.append({fold: found.get(fold, found[-1]) for fold in range(-1, FOLDS)})
    return [by_fold[-1] for by_fold in models]


def chances(text_col, models, categories, spark):
    """A struct column with the probability of each category of a text column."""
    names = list(categories)
    if models is None:
        return F.struct(*[F.lit(0.5).alias(name) for name in names])
    shared = spark.sparkContext.broadcast(models)

    @F.pandas_udf(", ".join(f"{name} double" for name in names))
    def predict(texts: pd.Series) -> pd.DataFrame:
        parts = byte_batches([pd.DataFrame({"text": texts})], "text", BATCH_CHARS)
        found = [_predict_chain(shared.value, *features_of(part["text"])) for part in parts]
        give_back()
        return pd.DataFrame(np.concatenate(found) if found else np.zeros((0, len(names))), columns=names)

    return predict(text_col)


def toxicity(docs, labels, categories=CATEGORIES, id_col="doc_id", text_col="text"):
    """Per row: doc_id and ``p_<category>`` for each category of the chain."""
    models = fit_chain(docs, labels, list(categories), id_col, text_col)
    found = chances(F.col(text_col), models, categories, docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), found.alias("__found"))
    return rows.select("doc_id", *[F.col("__found")[c].alias(f"p_{c}") for c in categories])


def keep_clean(docs, labels, categories=CATEGORIES, reject="toxic", id_col="doc_id", text_col="text"):
    """``docs`` without the rows whose probability of ``reject`` is over THRESHOLD; all columns stay."""
    models = fit_chain(docs, labels, list(categories), id_col, text_col)
    found = chances(F.col(text_col), models, categories, docs.sparkSession)
    whole = docs.select(F.struct(*[F.col(f"`{n}`") for n in docs.columns]).alias("__row"), found.alias("__found"))
    clean = whole.where(F.col("__found")[reject] <= THRESHOLD)
    return clean.select(*[F.col("__row")[n].alias(n) for n in docs.columns])


def chain_labels(labels):
    """The default chain's 0/1 columns of a label table (doc_id, quality, toxic)."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("poor"), F.col("toxic").alias("toxic"))
