"""Exact Jaccard join of word-shingle sets with signature trees.

1. Every text becomes its set of 5-word shingle hashes; equal sets form one class. A class carries
   its size, its sorted tokens and a bitmap with about two bits of room per token.
2. Classes meet through shared tokens. Two sets with Jaccard similarity >= t share a token among
   the first ``n - ceil(t n) + 1`` of each in any common order (prefix filter, no link is lost).
   The order puts tokens held by more than 0.1 % of all rows last, so that passages found
   everywhere do not bring everyone together. That list has a proven bound: the prefixes hold at
   most 1000 times the mean prefix length of such tokens.
3. A first round looks only at the first four tokens, and links what it can. The second looks at
   whole prefixes, but only at tokens that two different components share; so a large group of
   near copies, joined in round one, costs nothing more. Groups of over ``BLOCK`` classes are cut
   in blocks, and in round two pairs of blocks.
4. Within a group a signature tree decides what to compare: classes sorted by size are its leaves,
   nodes hold the OR of their bitmaps and their size range, and a dual traversal descends only
   into node pairs whose largest possible overlap reaches the threshold. Pairs that survive are
   compared exactly, but for those already in one component.

Round two traverses three times: with bitmaps of two bits per token, for what survives with bitmaps
of eight, and for what still survives with the token sets. Wide bitmaps and token sets are made anew
from the texts that need them; no table holds all tokens.
Tokens are 48 bits of a 64-bit hash; at 500 shingles a text a false match in a pair has a chance
of 1e-9.

Defined results: without words (null, empty) a set is empty and linked with nothing; a text of
fewer than five words is one shingle; repeated rows share a class; a null id is ignored when the
smallest id is chosen, and a set that no row with an id holds is linked with nothing; an empty table gives an empty result.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.llm.common import byte_batches, components, mix, released, runs_of, shingle_sets, ship, sift, stage

K = 5
PERCENT = 80
BLOCK = 512
FIRST_TOKENS = 4
WIDE = 8
HOT_SHARE = 0.001
HOT_LEAST = 64
FAN_OUT = 8
BATCH_CHARS = 1 << 20


def pack(tokens):
    """48-bit tokens as big-endian bytes, so that bytes sort as the numbers do."""
    return tokens.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpack(data):
    raw = np.frombuffer(data, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").ravel().astype(np.uint64)


def bitmap(tokens, room=2):
    """Bits of the tokens in the power of two at or above ``room`` times their number, 64 at least."""
    width = max(64, 1 << int(room * len(tokens) - 1).bit_length())
    bits = np.zeros(width, np.uint8)
    bits[(tokens & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits, words):
    """A bitmap of uint64 words folded by OR to ``words`` of them."""
    bits = np.frombuffer(bits, np.uint64)
    return np.bitwise_or.reduce(bits.reshape(-1, words), axis=0)


def token_sets(texts, k):
    """Sizes, identifying keys (0 for the empty set) and sorted 48-bit tokens of texts."""
    sets = shingle_sets(texts, k)
    sizes = np.array([len(s) for s in sets], np.uint64)
    sums = np.array([np.bitwise_xor.reduce(mix(s)) for s in sets], np.uint64)
    return sizes.astype(np.int64), np.where(sizes > 0, mix(sums ^ sizes).view(np.int64), 0), [s >> np.uint64(16) for s in sets]


def prefix_length(n, percent):
    return n - -(-percent * n // 100) + 1


def prefix(tokens, percent, hot=None):
    """The first tokens of a set, enough for the threshold, with hot ones moved to the end."""
    length = prefix_length(len(tokens), percent)
    if hot is not None and len(hot):
        late = hot[np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)] == tokens
        tokens = np.concatenate([tokens[~late], tokens[late]])
    return tokens[:length]


def sets_table(docs, id_col, text_col, k, percent):
    """Staged rows (doc_id, n, key, bits, prefix) of every row; the prefix is in the order of tokens."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for frame in byte_batches(released(batches), "text", BATCH_CHARS):
            sizes, keys, tokens = token_sets(frame["text"], k)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n": sizes,
                    "key": keys,
                    "bits": [bitmap(t) if len(t) else b"" for t in tokens],
                    "prefix": [pack(prefix(t, percent)) if len(t) else b"" for t in tokens],
                }
            )

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return stage(slim.mapInPandas(run, f"doc_id {kind}, n long, key long, bits binary, prefix binary"), "shingle-sets")


def contents(docs, wanted, id_col, text_col, k, make):
    """Rows (doc_id, key, made) made anew from the texts of ``wanted`` (doc_id) and some others.

    ``made`` is what ``make`` returns as bytes for a sorted token array. Only texts that a filter of bounded
    size lets pass reach Python, and no text shuffles.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for frame in byte_batches(released(batches), "text", BATCH_CHARS):
            _, keys, tokens = token_sets(frame["text"], k)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "key": keys, "made": [make(t) if len(t) else b"" for t in tokens]})

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return sift(slim, "doc_id", wanted).select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, key long, made binary")


def exploded(rows, most=None):
    """Rows (token, key) of rows (key, prefix)."""

    def run(batches):
        for frame in batches:
            parts = [unpack(data)[:most] for data in frame["prefix"]]
            if parts:
                keys = np.repeat(frame["key"].to_numpy(), [len(part) for part in parts])
                yield pd.DataFrame({"token": np.concatenate(parts).astype(np.int64), "key": keys})

    return rows.select("key", "prefix").mapInPandas(run, "token long, key long")


def hot_tokens(sets):
    """Sorted tokens in the prefixes of more than 0.1 % of all rows (64 at least); a bounded list.

    Tasks send only tokens that they meet twice, which the few wanted here are sure to be in most
    tasks. The list only orders tokens: any list gives the same links.
    """
    least = max(HOT_LEAST, int(HOT_SHARE * sets.count()))

    def count(batches):
        tokens = [unpack(data) for frame in batches for data in frame["prefix"]]
        found, n = np.unique(np.concatenate(tokens) if tokens else np.empty(0, np.uint64), return_counts=True)
        yield pd.DataFrame({"token": found[n > 1].astype(np.int64), "n": n[n > 1]})

    counted = sets.select("prefix").mapInPandas(count, "token long, n long")
    hot = counted.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") > least)
    return np.array(sorted(row["token"] for row in hot.select("token").toLocalIterator()), np.uint64)


def ordered_prefixes(docs, sets, hot, id_col, text_col, k, percent):
    """Staged rows (key, prefix) in the common order; only sets with a hot token are made anew."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(hot)

    def mark(batches):
        late = shared.value
        for frame in batches:
            tokens = [unpack(data) for data in frame["prefix"]]
            frame["late"] = [bool(len(late)) and bool(np.isin(t, late).any()) for t in tokens]
            yield frame[["doc_id", "key", "prefix", "late"]]

    kind = sets.schema["doc_id"].dataType.simpleString()
    rows = sets.where("n > 0 and doc_id is not null").select("doc_id", "key", "prefix")
    marked = stage(rows.mapInPandas(mark, f"doc_id {kind}, key long, prefix binary, late boolean"), "prefixes")
    late = marked.where("late").select("doc_id", F.col("key").alias("__key"))
    anew = contents(docs, late.select("doc_id"), id_col, text_col, k, lambda t: pack(prefix(t, percent, shared.value)))
    anew = anew.join(late.distinct(), "doc_id").where("key = __key").select("key", F.col("made").alias("prefix"))
    return marked.where("not late").select("key", "prefix").unionByName(stage(anew, "prefixes-late"))


class Group:
    """Classes of one group with their signature tree; ``links`` gives pairs by dual traversal."""

    def __init__(self, sizes, bits, percent):
        self.order = np.argsort(sizes, kind="stable")
        self.sizes = np.asarray(sizes, np.int64)[self.order]
        self.percent = percent
        words = min(len(b) for b in bits) // 8
        self.bits = np.stack([fold(bits[i], words) for i in self.order])
        self.slack = self.sizes - np.bitwise_count(self.bits).sum(axis=1)
        self.levels = [(self.sizes, self.sizes, self.slack, self.bits)]
        while len(self.levels[-1][0]) > 1:
            low, high, slack, ors = self.levels[-1]
            first = np.arange(0, len(low), FAN_OUT)
            self.levels.append(
                (
                    np.minimum.reduceat(low, first),
                    np.maximum.reduceat(high, first),
                    np.maximum.reduceat(slack, first),
                    np.bitwise_or.reduceat(ors, first, axis=0),
                )
            )

    def _may_link(self, level, a, b):
        """Whether the largest possible overlap of members of nodes a and b reaches the threshold."""
        low, high, slack, ors = self.levels[level]
        fits = 100 * high[a] >= self.percent * low[b]
        both = np.zeros(len(a), np.int64)
        both[fits] = np.bitwise_count(ors[a[fits]] & ors[b[fits]]).sum(axis=1)
        overlap = np.minimum(np.minimum(slack[a], slack[b]) + both, np.minimum(high[a], high[b]))
        return fits & ((100 + self.percent) * overlap >= self.percent * (low[a] + low[b]))

    def links(self):
        """Pairs of positions (i, j), i no larger than j, that the signatures cannot rule out."""
        top = len(self.levels) - 1
        a = b = np.zeros(1, np.int64)
        for level in range(top - 1, -1, -1):
            n = len(self.levels[level][0])
            step = np.arange(FAN_OUT)
            left = (a[:, None, None] * FAN_OUT + step[None, :, None]).repeat(FAN_OUT, 2).ravel()
            right = (b[:, None, None] * FAN_OUT + step[None, None, :]).repeat(FAN_OUT, 1).ravel()
            real = (left < n) & (right < n) & ((left <= right) if level else (left < right))
            a, b = left[real], right[real]
            keep = np.concatenate([self._may_link(level, a[i : i + 65536], b[i : i + 65536]) for i in range(0, len(a), 65536)] or [np.empty(0, bool)])
            a, b = a[keep], b[keep]
        return self.order[a], self.order[b]


def similar(x, y, percent):
    """Whether two sorted token sets reach the threshold."""
    if len(x) > len(y):
        x, y = y, x
    shared = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
    return 100 * shared >= percent * (len(x) + len(y) - shared)


def _find(parent, i):
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


class Asked:
    """Pairs of keys that a task has met in earlier groups of one home; one such group suffices for a pair.

    Holds at most ``most`` pairs: beyond that it forgets all, and pairs are merely asked again.
    """

    def __init__(self, most=1 << 20):
        self.home, self.seen, self.most = None, set(), most

    def new(self, home, keys, a, b):
        """Flags of the pairs of positions (a, b) that are new."""
        if home != self.home or len(self.seen) > self.most:
            self.home, self.seen = home, set()
        low, high = np.minimum(keys[a], keys[b]), np.maximum(keys[a], keys[b])
        pairs = list(zip(low.tolist(), high.tolist()))
        fresh = np.array([pair not in self.seen for pair in pairs], bool)
        self.seen.update(pairs)
        return fresh


def survivors(grouped, percent):
    """Of rows (group, home, key, component, n, bits): those with a possible link to another component.

    A pair that comes up in several groups of one home survives in the first of them only.
    """

    def run(batches):
        asked = Asked()
        for frame in runs_of(released(batches), "group"):
            if len(frame) < 2:
                continue
            a, b = Group(frame["n"].to_numpy(), frame["bits"].tolist(), percent).links()
            labels = frame["component"].to_numpy()
            apart = labels[a] != labels[b]
            a, b = a[apart], b[apart]
            fresh = asked.new(frame["home"].iloc[0], frame["key"].to_numpy(), a, b)
            used = np.unique(np.concatenate([a[fresh], b[fresh]]))
            if len(used):
                yield frame.iloc[used][["group", "key"]]

    ordered = grouped.repartition("home").sortWithinPartitions("home", "group")
    return ordered.mapInPandas(run, "group long, key long")


def verified(grouped, percent):
    """Links (a, b) among rows (group, key, component, tokens), as a forest per group."""

    def run(batches):
        for frame in runs_of(released(batches), "group"):
            if len(frame) < 2:
                continue
            keys = frame["key"].tolist()
            _, inverse = np.unique(frame["component"].to_numpy(), return_inverse=True)
            parent = list(range(len(keys)))
            tokens = [unpack(data) for data in frame["tokens"]]
            found = []
            for i, j in zip(*(side.tolist() for side in Group([len(t) for t in tokens], [bitmap(t, WIDE) for t in tokens], percent).links())):
                x, y = _find(parent, inverse[i]), _find(parent, inverse[j])
                if x != y and similar(tokens[i], tokens[j], percent):
                    parent[max(x, y)] = min(x, y)
                    found.append((keys[i], keys[j]))
            if found:
                yield pd.DataFrame(found, columns=["a", "b"])

    ordered = grouped.repartition("home").sortWithinPartitions("group")
    return ordered.mapInPandas(run, "a long, b long")


def _distinct_groups(rows):
    """Rows (group, home, key) without groups whose members equal another group's.

    ``home`` is the group's smallest key: groups dealt by it lie beside those that share members,
    whose repeated contents then compress.
    """
    lists = rows.groupBy("group").agg(F.sort_array(F.collect_set("key")).alias("keys")).where(F.size("keys") > 1)
    distinct = lists.select(F.xxhash64("keys").alias("group"), "keys").dropDuplicates(["group"])
    return distinct.select("group", F.element_at("keys", 1).alias("home"), F.explode("keys").alias("key"))


def first_groups(tokens):
    """Groups of classes by shared token, hash-cut into parts of about BLOCK."""
    rows = tokens.distinct()
    counts = rows.groupBy("token").agg(F.count("*").alias("size")).where("size > 1")
    part = F.pmod(F.xxhash64("token", "key"), F.ceil(F.col("size") / BLOCK))
    return _distinct_groups(rows.join(counts, "token").select(F.xxhash64("token", part).alias("group"), "key"))


def second_groups(rows, percent):
    """Groups of (token, key, component, n) over several components; large ones as pairs of blocks.

    Members of a group are of one size class or the next, the classes being as wide as the
    threshold allows sizes of similar sets to differ; so a shared passage does not bring short
    and long texts together.
    """
    size_class = F.floor(F.log("n") / float(1.0001 * np.log(100 / percent))).cast("int")
    spread = rows.select("token", "key", "component", F.explode(F.array(size_class, size_class + 1)).alias("class"))
    counts = (
        spread.groupBy("token", "class")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
        .where("low < high")
    )
    blocks = F.ceil(F.col("size") / BLOCK)
    placed = spread.join(counts, ["token", "class"]).withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64("key"), blocks)})
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    pairs = placed.select("token", "class", "key", "block", other.alias("other"))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return _distinct_groups(pairs.select(F.xxhash64("token", "class", low, high).alias("group"), "key"))


def classes_of(docs, id_col="doc_id", text_col="text", k=K, percent=PERCENT):
    """(sets, labels): the staged sets and (key, component) of every linked class."""
    sets = sets_table(docs, id_col, text_col, k, percent)
    first = sets.where("n > 0 and doc_id is not null").groupBy("key").agg(
        F.min("doc_id").alias("__carrier"), F.min("n").alias("n")
    )
    carrier = stage(first, "set-classes")

    def with_bits(rows):
        content = sift(sets.select(F.col("key").alias("__key"), "doc_id", "n", "bits"), "__key", rows.select(F.col("key").alias("__key")))
        chosen = rows.join(carrier.drop("n"), "key")
        match = (F.col("key") == F.col("__key")) & (F.col("__carrier") == F.col("doc_id"))
        return chosen.join(content, match).select(*rows.columns, "n", "bits")

    def with_made(rows, name, make):
        chosen = stage(rows.join(carrier.drop("n"), "key"), "wanted-sets")
        content = contents(docs, chosen.select(F.col("__carrier").alias("doc_id")), id_col, text_col, k, make)
        content = content.withColumnRenamed("key", "__key")
        match = (F.col("key") == F.col("__key")) & (F.col("__carrier") == F.col("doc_id"))
        return chosen.join(content, match).select(*rows.columns, F.col("made").alias(name))

    def labelled(rows, labels):
        known = labels.withColumnRenamed("node", "key")
        return rows.join(known, "key", "left").withColumn("component", F.coalesce("component", "key"))

    prefixes = ordered_prefixes(docs, sets, hot_tokens(sets), id_col, text_col, k, percent)
    start = first_groups(exploded(prefixes, FIRST_TOKENS)).withColumn("component", F.col("key"))
    links = stage(verified(with_made(start, "tokens", pack), percent), "links-first")
    labels = stage(components(links), "components-first")

    holders = Window.partitionBy("token")
    shared = (
        exploded(prefixes)
        .withColumns({"low": F.min("key").over(holders), "high": F.max("key").over(holders)})
        .where("low < high")
        .select("token", "key")
    )
    sized = carrier.select("key", "n").join(labels.withColumnRenamed("node", "key"), "key", "left")
    sized = stage(sized.withColumn("component", F.coalesce("component", "key")), "sized-classes")
    repeated = stage(shared.distinct().join(sized, "key"), "shared-tokens")
    groups = stage(second_groups(repeated, percent).join(sized.drop("n"), "key"), "groups-second")
    possible = labelled(_distinct_groups(survivors(with_bits(groups), percent)), labels)
    wide = with_made(possible.join(carrier.select("key", "n"), "key"), "bits", lambda t: bitmap(t, WIDE))
    possible = labelled(_distinct_groups(survivors(wide, percent)), labels)
    more = stage(verified(with_made(possible, "tokens", pack), percent), "links-second")
    if more.isEmpty():
        return sets, labels
    return sets, stage(components(links.unionByName(more)), "components-second")


def near_duplicate_classes(docs, id_col="doc_id", text_col="text", k=K, percent=PERCENT):
    """Per row: doc_id, n_shingles, component_id (the smallest id reachable by links)."""
    sets, labels = classes_of(docs, id_col, text_col, k, percent)
    rows = sets.select("doc_id", "n", "key").join(labels.withColumnRenamed("node", "key"), "key", "left")
    rows = rows.withColumn("component", F.coalesce("component", "key"))
    smallest = rows.where("n > 0").groupBy("component").agg(F.min("doc_id").alias("first_id"))
    return rows.join(smallest, "component", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first_id")).otherwise(F.col("doc_id")).alias("component_id")
    )


def keep_first(docs, id_col="doc_id", text_col="text", k=K, percent=PERCENT):
    """``docs`` with only the smallest id of each component, all columns kept.

    Only ids that go are joined, and only rows whose id a filter of bounded size lets pass shuffle.
    Rows of equal id and rows without an id stay.
    """
    found = near_duplicate_classes(docs, id_col, text_col, k, percent)
    gone = stage(found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    names = docs.columns
    whole = docs.select(F.col(id_col).alias("__id"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("__row"))
    marked = sift(whole, "__id", gone.select(F.col("__gone").alias("__id")), keep_all=True)
    straight = marked.where("not __maybe")
    kept = marked.where("__maybe").join(gone, F.col("__id") == F.col("__gone"), "left_anti")
    return straight.select("__row").unionByName(kept.select("__row")).select(*[F.col("__row")[n].alias(n) for n in names])
