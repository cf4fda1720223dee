r"""Ranked lexical search: the best documents of every item, by grouping documents on term masks.

Terms are runs of characters other than ASCII control characters, spaces and punctuation, with A-Z
lower-cased. With N documents that hold a term, L terms in all of them, n terms in a document, tf of
them equal to a term and df documents that hold it, a term weighs w = floor(1000 ln((2N+2)/(2df+1)))
and adds w * ((10^9 tf) div (1000 tf + 20 m)) to the score of a document, with
m = 50 + (50 n N) div L. An item's score sums this over its distinct terms.

1. One pass over the texts keeps, per document, its number of terms and the (term, tf) pairs of terms
   that some item of the block holds (a staged table), and the sums N, L and df come from it.
2. Tasks take the documents in pieces of at most ``PIECE`` rows. A piece has a bitmap per term, one
   bit per document. For an item the bitmaps of its terms, turned around, give one mask per document,
   and documents of equal masks form a group.
3. What a term adds at most in the piece bounds every mask's score. Masks are evaluated from the
   highest bound down, all their documents exactly, until the item's ``top`` best scores of the task
   so far all exceed the next bound; equal bounds are still evaluated, so ties are whole.
4. The tasks' best rows, ``top`` an item, meet per item, first within ``SALTS`` parts of each item.

Items come in blocks of at most ``ITEMS``, cut where their terms add up to ``TERMS``, so a block has at
most TERMS terms and those of one more item. A block's terms are broadcast as 64-bit hashes. So the work
of a task is bounded by its piece and its block, and no pair of a document and an item is written but
the best.

Terms are compared by a 64-bit hash of their bytes: two different terms of a corpus share one with a
chance of 1e-19 per pair.

Defined results: a null or empty text has no term and is never found; an item without terms finds
nothing; repeated rows of documents are ranked each, beside each other; equal items (same id and
text) count once, other items of one id are ranked each; null ids of documents come after all others
among equal scores; a document scores above 0 to be found; an empty table gives an empty result;
other columns are not read, whatever their names; very long texts are read whole.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.llm.common import byte_batches, ship, stage, word_hashes
from shelfline.llm.sequences import in_order, running

TOP = 50
ITEMS = 1024
TERMS = 1 << 16
PIECE = 4096
SALTS = 16

GAPS = np.ones(256, dtype=bool)
GAPS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def item_terms(items, id_col, text_col):
    """Staged rows (item, block, item_id, terms): distinct items with their distinct term hashes, sorted."""
    ship(items.sparkSession)

    def run(batches):
        for frame in byte_batches(batches, "text"):
            hashes, offsets = word_hashes(frame["text"], GAPS)
            found = [np.unique(hashes[a:b]).view(np.int64) for a, b in zip(offsets[:-1], offsets[1:])]
            yield pd.DataFrame({"item": frame["item"], "terms": found})

    given = items.select(F.col(id_col).alias("item_id"), F.col(text_col).alias("text")).distinct()
    numbered = stage(given.withColumn("item", F.monotonically_increasing_id()), "items")
    terms = numbered.select("item", "text").mapInPandas(run, "item long, terms array<long>").where("size(terms) > 0")
    placed = in_order(stage(terms, "item-terms"), ["item"])
    counted = running(placed, {"count": F.lit(1), "total": F.size("terms").cast("long")})
    block = F.struct(F.floor((F.col("count") - 1) / ITEMS).alias("a"), F.floor((F.col("total") - F.size("terms")) / TERMS).alias("b"))
    return stage(counted.select("item", block.alias("block"), "terms").join(numbered.drop("text"), "item"), "item-blocks")


def document_terms(docs, vocabulary, id_col, text_col):
    """Staged rows (row, n, term, tf): per document its terms of the vocabulary, by their place in it.

    ``row`` numbers the documents; the second table returned holds (row, doc_id).
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        known = shared.value
        for frame in byte_batches(batches, "text"):
            hashes, offsets = word_hashes(frame["text"], GAPS)
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            hit = np.flatnonzero(known[place] == hashes)
            row = np.searchsorted(offsets, hit, side="right") - 1
            pairs, counts = np.unique(row * len(known) + place[hit], return_counts=True)
            rows, terms = np.divmod(pairs, len(known))
            cut = np.searchsorted(rows, np.arange(1, len(frame)))
            columns = {"n": np.diff(offsets), "term": np.split(terms.astype(np.int32), cut), "tf": np.split(counts, cut)}
            yield frame.drop(columns="text").assign(**columns)

    doc_id = F.col(id_col)
    slim = docs.select(F.coalesce(doc_id, filler(docs, id_col)).alias("doc_id"), doc_id.isNull().alias("no_id"), F.col(text_col).alias("text"))
    schema = f"doc_id {slim.schema['doc_id'].dataType.simpleString()}, no_id boolean, n long, term array<int>, tf array<long>"
    return stage(slim.mapInPandas(run, schema).where("n > 0"), "document-terms")


def filler(docs, id_col):
    """What stands for a null id in numpy, where a null would turn long ids into doubles."""
    return F.lit("0").cast(docs.schema[id_col].dataType)


def weights(N, df):
    return np.floor(1000 * np.log((2 * N + 2) / (2 * df + 1))).astype(np.int64)


class Piece:
    """Some documents: what every term adds to their scores, and a bitmap of documents per term."""

    def __init__(self, lengths, terms, tf, weight, N, L):
        self.sizes = np.array([len(t) for t in terms])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.term, tf = np.concatenate(terms), np.concatenate(tf)
        rows = np.repeat(np.arange(len(self.sizes)), self.sizes)
        m = 50 + 50 * lengths * N // L
        self.added = weight[self.term] * (10**9 * tf // (1000 * tf + 20 * m[rows]))
        self.most = np.zeros(len(weight), np.int64)
        np.maximum.at(self.most, self.term, self.added)
        order = np.argsort(self.term, kind="stable")
        edges = np.searchsorted(self.term[order], np.arange(len(weight) + 1))
        self.bitmaps = np.zeros((len(weight), -(-len(self.sizes) // 8)), np.uint8)
        for low in range(0, len(weight), 1024):
            high = min(low + 1024, len(weight))
            part = order[edges[low] : edges[high]]
            held = np.zeros((high - low, len(self.sizes)), bool)
            held[self.term[part] - low, rows[part]] = True
            self.bitmaps[low:high] = np.packbits(held, axis=1)

    def groups(self, terms):
        """(documents with any of the terms, the group of each, the term flags of each group)."""
        bitmaps = self.bitmaps[terms]
        if not bitmaps.any():
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty((0, len(terms)), np.int64)
        there = np.flatnonzero(np.unpackbits(np.bitwise_or.reduce(bitmaps, axis=0), count=len(self.sizes)))
        bits = np.unpackbits(bitmaps, axis=1, count=len(self.sizes))[:, there]
        words = -(-len(terms) // 64)
        masks = np.zeros((len(there), 8 * words), np.uint8)
        masks[:, : -(-len(terms) // 8)] = np.packbits(bits, axis=0).T
        whole = masks.view(np.uint64).ravel() if words == 1 else masks.view(f"V{8 * words}").ravel()
        distinct, group = np.unique(whole, return_inverse=True)
        flags = np.unpackbits(distinct.view(np.uint8).reshape(len(distinct), -1), axis=1, count=len(terms))
        return there, group, flags.astype(np.int64)

    def scores(self, rows, mine):
        """Exact scores of the documents ``rows`` by the terms flagged in ``mine``."""
        sizes = self.sizes[rows]
        first = np.cumsum(sizes) - sizes
        at = np.arange(int(sizes.sum())) + np.repeat(self.starts[rows] - first, sizes)
        gains = np.where(mine[self.term[at]], self.added[at], 0)
        return np.add.reduceat(gains, first)

    def best(self, terms, floor, top):
        """(rows, scores) of all documents that can be among the ``top`` best, none below ``floor``.

        ``floor`` is the lowest of ``top`` scores that are known already, 1 if there are fewer.
        """
        there, group, flags = self.groups(terms)
        mine = np.zeros(len(self.most), bool)
        mine[terms] = True
        bounds = flags @ self.most[terms]
        order = np.argsort(-bounds, kind="stable")
        reach = np.cumsum(np.bincount(group, minlength=len(order))[order])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        members = there[np.argsort(rank[group], kind="stable")]
        rows, scores, done, step = there[:0], there[:0], 0, 2 * top
        while done < len(order) and bounds[order[done]] >= floor:
            begin = int(reach[done - 1]) if done else 0
            possible = int(np.searchsorted(-bounds[order], -floor, side="right"))
            done = min(max(done + 1, int(np.searchsorted(reach, begin + step))), possible)
            chosen = members[begin : int(reach[done - 1])]
            rows, scores = np.concatenate([rows, chosen]), np.concatenate([scores, self.scores(chosen, mine)])
            step *= 2
            if len(scores) >= top:
                floor = max(floor, int(np.partition(scores, len(scores) - top)[len(scores) - top]))
        kept = scores >= floor
        return rows[kept], scores[kept]


def pieces(batches):
    """Frames of at most PIECE rows, filled over batch borders."""
    held, count = [], 0
    for frame in batches:
        for begin in range(0, len(frame), PIECE):
            part = frame.iloc[begin : begin + PIECE]
            if held and count + len(part) > PIECE:
                yield pd.concat(held, ignore_index=True)
                held, count = [], 0
            held.append(part)
            count += len(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def task_best(documents, weight, items, N, L, top):
    """Rows (item, doc_id, no_id, score): every task's ``top`` best documents of each item."""
    shared = documents.sparkSession.sparkContext.broadcast((weight, items))

    def run(batches):
        weight, items = shared.value
        kept = {}
        for frame in pieces(batches):
            piece = Piece(frame["n"].to_numpy(), frame["term"].tolist(), frame["tf"].tolist(), weight, N, L)
            for item, terms in items:
                before = kept.get(item)
                floor = int(before["score"].iloc[-1]) if before is not None and len(before) == top else 1
                rows, scores = piece.best(terms, floor, top)
                if len(rows):
                    found = frame.iloc[rows][["no_id", "doc_id"]].assign(score=scores)
                    found = found if before is None else pd.concat([before, found])
                    kept[item] = found.sort_values(["score", "no_id", "doc_id"], ascending=[False, True, True]).iloc[:top]
        for item, found in kept.items():
            yield found.assign(item=item)[["item", "doc_id", "no_id", "score"]]

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.mapInPandas(run, f"item long, doc_id {kind}, no_id boolean, score long")


def _block_best(docs, terms, id_col, text_col, top):
    """The best rows of the items of one block, ranked."""
    lists = [(row["item"], np.array(row["terms"], np.int64).view(np.uint64)) for row in terms.select("item", "terms").collect()]
    vocabulary = np.unique(np.concatenate([own for _, own in lists]))
    documents = document_terms(docs, vocabulary, id_col, text_col)
    totals = documents.agg(F.count("*").alias("N"), F.sum("n").alias("L")).first()
    df = np.zeros(len(vocabulary), np.int64)
    counts = documents.select(F.explode("term").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    for row in counts.toLocalIterator():
        df[row["term"]] = row["df"]
    items = [(item, np.searchsorted(vocabulary, own)) for item, own in lists]
    rows = task_best(documents, weights(totals["N"], df), items, totals["N"], totals["L"], top)
    order = [F.col("score").desc(), "no_id", "doc_id"]
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS))
    for parts in (["item", salt], ["item"]):
        rows = rows.withColumn("rank", F.row_number().over(Window.partitionBy(*parts).orderBy(*order))).where(F.col("rank") <= top)
    return rows.select("item", "rank", F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "score")


def search(docs, items, id_col="doc_id", text_col="text", item_col="item_id", item_text="text", top=TOP):
    """Per item its ``top`` best documents: item_id, rank (from 1), doc_id, score."""
    terms = item_terms(items, item_col, item_text)
    found = None
    for row in terms.select("block").distinct().orderBy("block").toLocalIterator():
        own = terms.where((F.col("block.a") == row["block"]["a"]) & (F.col("block.b") == row["block"]["b"]))
        best = _block_best(docs, own, id_col, text_col, top)
        best = best.join(own.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else stage(found, "best-so-far").unionByName(best)
    if found is None:
        kinds = items.schema[item_col].dataType.simpleString(), docs.schema[id_col].dataType.simpleString()
        return docs.sparkSession.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")
    return found
