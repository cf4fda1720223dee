"""Benchmark passages and their paraphrases in documents, by latent semantic retrieval.

1. The words of the benchmark form the vocabulary (words found in over ``COMMON`` of all documents
   are left out, but for the ``LEAST_WORDS`` rarest of an item); inverse document frequencies are
   counted over all documents.
2. A distributed randomised SVD of the benchmark's TF-IDF passages gives the latent space: tasks
   multiply their passages with a random test matrix and add up A'(A Q) by blocks of the
   vocabulary; the driver only orthogonalises a matrix of vocabulary times ``RANK`` columns.
3. Every document is cut into overlapping windows; windows with at least ``LEAST_HITS`` words of the
   vocabulary are folded into the space, and items with a cosine of ``COSINE`` or more are candidates.
4. A candidate counts if the longest common subsequence of item and surrounding words covers
   ``SURE`` of the item, or covers ``LIKELY`` of it and holds the item's answer, its last words.

The benchmark is a stated query set. It is taken in blocks of ``ITEM_BLOCK`` items, so what is
broadcast is bounded however large it grows; every document is searched whole for each block.

Defined results: null or empty texts and items match nothing; items without words are left out;
equal items are reported each; an empty benchmark or table gives an empty result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfline.llm.common import PUNCTUATED, byte_batches, give_back, released, ship, stage, word_hashes

COMMON = 0.05
LEAST_WORDS = 8
RANK = 128
POWER_STEPS = 2
WINDOW = 32
STEP = 16
LEAST_HITS = 4
COSINE = 0.35
SURE = 0.8
LIKELY = 0.55
ANSWER_WORDS = 5
ANSWER_SHARE = 0.6
ITEM_BLOCK = 4096
VOCABULARY_BLOCK = 2048
BATCH_CHARS = 1 << 20
WINDOWS_AT_ONCE = 512
LEAK = "item_id long, cosine double, lcs_share double, answer_found boolean"


def hashed(texts):
    """Word hashes of lower-cased texts without punctuation, and where each text's begin."""
    return word_hashes([text.lower() if text is not None else None for text in texts], PUNCTUATED)


def split_items(texts):
    """Word hashes of each text as a list of arrays."""
    words, offsets = hashed(texts)
    return [words[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


class Lookup:
    """Finds the words of a sorted vocabulary; a table of 16 hash bits spares most searches."""

    def __init__(self, vocabulary):
        self.vocabulary = vocabulary
        self.maybe = np.zeros(1 << 16, bool)
        self.maybe[vocabulary & np.uint64(0xFFFF)] = True

    def __call__(self, words):
        """(places in words, numbers in the vocabulary) of the words it holds."""
        place = np.flatnonzero(self.maybe[words & np.uint64(0xFFFF)])
        some = words[place]
        at = np.minimum(np.searchsorted(self.vocabulary, some), len(self.vocabulary) - 1)
        hit = self.vocabulary[at] == some
        return place[hit], at[hit]


def document_frequencies(docs, text_col, vocabulary):
    """Number of documents that hold each word of the sorted vocabulary, over all documents."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        lookup, rows = Lookup(known), max(1, (1 << 24) // len(known))
        totals = np.zeros(len(known), np.int64)
        for frame in byte_batches(released(batches), "text", BATCH_CHARS):
            words, offsets = hashed(frame["text"])
            place, at = lookup(words)
            owner = np.searchsorted(offsets, place, side="right") - 1
            for begin in range(0, len(frame), rows):
                mine = (owner >= begin) & (owner < begin + rows)
                held = np.zeros((min(rows, len(frame) - begin), len(known)), bool)
                held[owner[mine] - begin, at[mine]] = True
                totals += held.sum(axis=0)
        used = np.flatnonzero(totals)
        yield pd.DataFrame({"word": used, "n": totals[used]})

    counted = docs.select(F.col(text_col).alias("text")).mapInPandas(run, "word long, n long")
    found = np.zeros(len(vocabulary), np.int64)
    for row in counted.groupBy("word").agg(F.sum("n").alias("n")).toLocalIterator():
        found[row["word"]] = row["n"]
    return found


def latent_basis(passages, size, rank=RANK, steps=POWER_STEPS):
    """Right singular vectors (size, rank) of rows of weights, by a distributed randomised SVD.

    ``passages`` has columns words (array<int>) and weights (array<double>).
    """
    spark = passages.sparkSession
    rank = max(1, min(rank, size))
    basis = np.random.default_rng(7).standard_normal((size, min(size, rank + 8)))
    basis, _ = np.linalg.qr(basis)
    for _ in range(steps + 1):
        shared = spark.sparkContext.broadcast(basis)

        def multiply(batches):
            q = shared.value
            total = np.zeros_like(q)
            for frame in batches:
                for words, weights in zip(frame["words"], frame["weights"]):
                    total[words] += np.outer(weights, np.asarray(weights) @ q[words])
            for begin in range(0, size, VOCABULARY_BLOCK):
                yield pd.DataFrame({"block": [begin], "part": [total[begin : begin + VOCABULARY_BLOCK].tobytes()]})

        def add(frame):
            parts = [np.frombuffer(part) for part in frame["part"]]
            return pd.DataFrame({"block": frame["block"].iloc[:1], "part": [np.sum(parts, axis=0).tobytes()]})

        blocks = passages.mapInPandas(multiply, "block long, part binary").groupBy("block").applyInPandas(add, "block long, part binary")
        rows = sorted(blocks.collect(), key=lambda row: row["block"])
        product = np.concatenate([np.frombuffer(row["part"]).reshape(-1, basis.shape[1]) for row in rows])
        small = basis.T @ product
        last, (basis, _) = basis, np.linalg.qr(product)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return last @ vectors[:, np.argsort(-values)[:rank]]


def common_subsequence(item, words):
    """Length of the longest common subsequence, bit-parallel over the item's words."""
    places = {}
    for i, word in enumerate(item.tolist()):
        places[word] = places.get(word, 0) | (1 << i)
    full = (1 << len(item)) - 1
    row = full
    for word in words.tolist():
        match = places.get(word)
        if match is not None:
            hit = row & match
            row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


class Searcher:
    """Finds the items of one block in texts."""

    def __init__(self, ids, items, vocabulary, idf, basis):
        self.ids, self.items, self.lookup = ids, items, Lookup(vocabulary)
        self.embedding = (idf[:, None] * basis).astype(np.float32)
        vectors = []
        for words in items:
            vectors.append(self.embedding[np.unique(self.lookup(words)[1])].sum(axis=0))
        vectors = np.array(vectors, np.float32)
        self.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)

    def _windows(self, words, offsets):
        """Rows (text, window number, vector) of windows with enough words of the vocabulary."""
        place, at = self.lookup(words)
        text = np.searchsorted(offsets, place, side="right") - 1
        number = (place - offsets[text]) // STEP
        back = number > 0
        owner = np.concatenate([text, text[back]])
        window = np.concatenate([number, number[back] - 1])
        word = np.concatenate([at, at[back]])
        order = np.lexsort((word, window, owner))
        owner, window, word = owner[order], window[order], word[order]
        if not len(owner):
            return owner, window, np.zeros((0, self.embedding.shape[1]), np.float32)
        same = (owner[1:] == owner[:-1]) & (window[1:] == window[:-1])
        new = np.concatenate([[True], ~(same & (word[1:] == word[:-1]))])
        first = np.concatenate([[True], ~same])[new]
        owner, window, word = owner[new], window[new], word[new]
        begin = np.flatnonzero(first)
        size = np.diff(np.append(begin, len(owner)))
        enough = np.repeat(size >= LEAST_HITS, size)
        begin, size = begin[size >= LEAST_HITS], size[size >= LEAST_HITS]
        if not len(begin):
            return owner[:0], window[:0], np.zeros((0, self.embedding.shape[1]), np.float32)
        start = np.cumsum(size) - size
        sums = np.add.reduceat(self.embedding[word[enough]], start, axis=0)
        return owner[begin], window[begin], sums

    def candidates(self, words, offsets):
        """(text, window, item, cosine) at or over the cosine threshold."""
        texts, windows, vectors = self._windows(words, offsets)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        found = []
        for i in range(0, len(vectors), WINDOWS_AT_ONCE):
            cosine = vectors[i : i + WINDOWS_AT_ONCE] @ self.vectors.T
            row, item = np.nonzero(cosine >= COSINE)
            found.append((texts[i + row], windows[i + row], item, cosine[row, item]))
        return [np.concatenate(part) for part in zip(*found)] if found else [np.empty(0, np.int64)] * 4

    def search(self, texts):
        """Per text its leaks as (item_id, cosine, lcs_share, answer_found), by item."""
        words, offsets = hashed(texts)
        leaks = [{} for _ in texts]
        for text, window, item, cosine in zip(*(c.tolist() for c in self.candidates(words, offsets))):
            wanted = self.items[item]
            at = offsets[text] + window * STEP
            low, high = max(offsets[text], at - len(wanted)), min(offsets[text + 1], at + WINDOW + len(wanted))
            share = common_subsequence(wanted, words[low:high]) / len(wanted)
            if share < LIKELY or share <= leaks[text].get(item, (0, 0))[1]:
                continue
            answer = wanted[-ANSWER_WORDS:]
            answered = common_subsequence(answer, words[low:high]) >= ANSWER_SHARE * len(answer)
            if share >= SURE or answered:
                leaks[text][item] = (cosine, share, answered)
        return [[(int(self.ids[i]), float(c), float(s), bool(a)) for i, (c, s, a) in sorted(found.items())] for found in leaks]


def searcher(docs, block, text_col):
    """The searcher of one block of items (rows item_id, text), or None if none has words."""
    spark = docs.sparkSession
    kept = [(i, w) for (i, _), w in zip(block, split_items([text for _, text in block])) if len(w)]
    if not kept:
        return None
    ids, items = [i for i, _ in kept], [w for _, w in kept]
    vocabulary = np.unique(np.concatenate(items))
    n_docs = max(docs.count(), 1)
    frequency = document_frequencies(docs, text_col, vocabulary)
    wanted = frequency <= COMMON * n_docs
    for words in items:
        at = np.unique(np.searchsorted(vocabulary, words))
        wanted[at[np.argsort(frequency[at], kind="stable")[:LEAST_WORDS]]] = True
    vocabulary, frequency = vocabulary[wanted], frequency[wanted]
    idf = np.log((n_docs + 1) / (frequency + 1)) + 0.1
    rows = []
    for words in items:
        for begin in range(0, max(len(words) - STEP, 1), STEP):
            piece = words[begin : begin + WINDOW]
            at = np.minimum(np.searchsorted(vocabulary, piece), len(vocabulary) - 1)
            used = np.unique(at[vocabulary[at] == piece])
            if len(used):
                rows.append((used.tolist(), idf[used].tolist()))
    passages = stage(spark.createDataFrame(rows, "words array<int>, weights array<double>"), "benchmark-passages")
    return Searcher(ids, items, vocabulary, idf, latent_basis(passages, len(vocabulary)))


def leak_column(docs, benchmark, text_col="text", item_col="item_id", item_text_col="text"):
    """A column expression array<struct> with the leaks of ``docs[text_col]``."""
    spark = docs.sparkSession
    ship(spark)
    items = benchmark.where(F.col(item_text_col).isNotNull() & F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")
    )
    blocks = -(-items.count() // ITEM_BLOCK)
    found = F.array().cast(f"array<struct<{LEAK.replace(' ', ':').replace(',:', ',')}>>")
    for number in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number)
        model = searcher(docs, sorted((r["item_id"], r["text"]) for r in mine.collect()), text_col)
        if model is None:
            continue
        found = F.concat(found, _search_udf(spark.sparkContext.broadcast(model))(F.col(text_col)))
    return found


def _search_udf(shared):
    @F.pandas_udf(f"array<struct<{LEAK.replace(' ', ':').replace(',:', ',')}>>")
    def search(texts: pd.Series) -> pd.Series:
        leaks = []
        for part in byte_batches([pd.DataFrame({"text": texts})], "text", BATCH_CHARS):
            leaks += shared.value.search(part["text"].tolist())
        give_back()
        names = ["item_id", "cosine", "lcs_share", "answer_found"]
        return pd.Series([[dict(zip(names, leak)) for leak in found] for found in leaks], dtype=object)

    return search


def find_leaks(docs, benchmark, id_col="doc_id", text_col="text"):
    """Rows (doc_id, item_id, cosine, lcs_share, answer_found), one per document and leaked item."""
    found = leak_column(docs, benchmark, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.explode(found).alias("leak"))
    return rows.select("doc_id", "leak.*")


def drop_leaks(docs, benchmark, text_col="text"):
    """``docs`` without rows that leak any item, all columns kept."""
    names = docs.columns
    found = leak_column(docs, benchmark, text_col)
    whole = docs.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("__row"), F.size(found).alias("__leaks"))
    return whole.where("__leaks = 0").select(*[F.col("__row")[n].alias(n) for n in names])
