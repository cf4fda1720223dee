"""What the text operators share: staged tables, shipping of this package, word and shingle hashes."""

import os
import tempfile
import zipfile

import numpy as np
from pyspark.sql import functions as F

from shelfline.session import scratch_dir

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"


def stage(df, label):
    """``df`` written to the shared scratch folder and read back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = "2000"  # texts that a Python worker holds at a time


def ship(spark):
    """Makes this package importable in Python workers, once per session, and bounds their batches."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if getattr(context, "_shelfline_shipped", False):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="shelfline-package-"), "shelfline_package.zip")
    with zipfile.ZipFile(archive, "w") as target:
        for folder, _, names in os.walk(PACKAGE):
            for name in names:
                if name.endswith(".py"):
                    source = os.path.join(folder, name)
                    target.write(source, os.path.relpath(source, os.path.dirname(PACKAGE)))
    context.addPyFile(archive)
    context._shelfline_shipped = True


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(column):
    """A-Z lower-cased, all else unchanged; texts of single-byte characters take the faster way."""
    plain = F.length(column) == F.octet_length(column)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, upper, lower))


def filter_place(place, words):
    """Word number and four bits of the 64-bit hash in column ``place`` in a Bloom filter of ``words`` 64-bit words."""
    bits = [f"shiftleft(1L, cast(shiftright({place}, {shift}) & 63 as int))" for shift in (0, 6, 12, 18)]
    return F.expr(f"pmod(shiftright({place}, 24), {words}L)"), F.expr(" | ".join(bits))


def sift(rows, key, wanted, words=1 << 19, keep_all=False):
    """Rows of ``rows`` whose long ``key`` may be among the keys of ``wanted``, without a shuffle.

    A Bloom filter of the wanted keys, at most ``words`` rows of two longs (8 MB by default), is
    broadcast. A fuller filter lets more rows pass; the join that follows decides. With ``keep_all``
    all rows come back, marked in ``__maybe``.
    """
    word, mask = filter_place("__place", words)
    bloom = stage(
        wanted.select(F.xxhash64(key).alias("__place")).select(word.alias("__word"), mask.alias("__mask")).groupBy("__word").agg(F.bit_or("__mask").alias("__bits")),
        "sieve",
    )
    marked = rows.withColumn("__place", F.xxhash64(key)).withColumns({"__word": word, "__mask": mask})
    hit = F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask")
    tools = ["__word", "__place", "__mask", "__bits"]
    if keep_all:
        probed = marked.join(F.broadcast(bloom), "__word", "left")
        return probed.withColumn("__maybe", F.coalesce(hit, F.lit(False))).drop(*tools)
    return marked.join(F.broadcast(bloom), "__word").where(hit).drop(*tools)


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0x00000100000001B3 | 0x5851F42D00000000)


def mix(values):
    """A bijective finaliser on unsigned 64-bit integers, so that close inputs spread out."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


_POWERS = np.ones(1, dtype=np.uint64)


def _powers(n):
    global _POWERS
    if len(_POWERS) < n:
        _POWERS = np.concatenate(
            [np.ones(1, np.uint64), np.cumprod(np.full(max(n, 4096) - 1, _STEP, np.uint64))]
        )
    return _POWERS[:n]


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[list(SPACES)] = True
PUNCTUATED = _IS_SPACE.copy()  # spaces and ASCII punctuation
PUNCTUATED[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _MULTIPLIER)


def word_hashes(texts, gaps=_IS_SPACE):
    """Hashes of all words of some texts and where each text's words begin.

    Words are runs of bytes other than ``gaps``, the six ASCII spaces unless told otherwise, with
    A-Z lower-cased. Returns
    ``(hashes uint64, offsets int64 of len(texts) + 1)``. None counts as empty.
    """
    raw = [b"" if text is None else text.encode("utf-8", "surrogatepass") for text in texts]
    joined = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(part) + 1 for part in raw], dtype=np.int64)
    space = gaps[joined]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).astype(np.int8)))
    starts, stops = edge[0::2], edge[1::2]
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(raw) + 1, np.int64)
    lengths = stops - starts
    inside = ~space
    letters = _LOWER[joined[inside]]
    first = np.cumsum(lengths) - lengths
    place = np.arange(len(letters), dtype=np.int32) - np.repeat(first.astype(np.int32), lengths)
    values = _BYTE_CODE[letters]
    values *= _powers(int(lengths.max()))[place]
    hashes = mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))
    return hashes, np.concatenate([[0], np.searchsorted(starts, ends)]).astype(np.int64)


def run_hashes(words, k):
    """One hash per run of ``k`` consecutive word hashes (over text borders too)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total = (total + words[i : i + n]) * _MULTIPLIER
        total ^= total >> np.uint64(29)
    return mix(total)


def shingle_sets(texts, k=5):
    """Per text the sorted distinct hashes of its ``k``-word shingles.

    A text of fewer words has its whole sequence as one shingle, a text without words none.
    """
    words, offsets = word_hashes(texts)
    runs = run_hashes(words, k)
    sets = []
    for begin, end in zip(offsets[:-1], offsets[1:]):
        n = int(end - begin)
        if n >= k:
            sets.append(np.unique(runs[begin : end - k + 1]))
        elif n:
            sets.append(run_hashes(words[begin:end], n) + np.uint64(n))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets


def byte_batches(rows, column, limit=8 << 20):
    """Cuts pandas batches so that the texts of one piece stay near ``limit`` characters."""
    for frame in rows:
        sizes = frame[column].map(lambda text: len(text) if text is not None else 0).to_numpy()
        piece = (np.cumsum(sizes) - sizes) // limit if len(sizes) else sizes
        for part in np.unique(piece):
            yield frame[piece == part].reset_index(drop=True)


def give_back():
    """Returns memory that numpy and Arrow have freed to the system; Python workers live on after a task."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU C library
    if trim is not None:
        trim(0)


def released(batches):
    """The batches of a task; at their end freed memory goes back, so that the next stage starts without it."""
    try:
        yield from batches
    finally:
        give_back()


def runs_of(batches, key):
    """Complete runs of equal ``key`` of a sorted partition, over batch borders, as pandas frames."""
    import pandas as pd

    rest = None
    for frame in batches:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        values = frame[key].to_numpy()
        if not len(values):
            continue
        cuts = np.flatnonzero(values[1:] != values[:-1]) + 1
        begin = 0
        for end in cuts.tolist():
            yield frame.iloc[begin:end]
            begin = end
        rest = frame.iloc[begin:].reset_index(drop=True)
    if rest is not None and len(rest):
        yield rest


def components(edges):
    """(node, component) of all nodes of edges (a, b), the component being its smallest node.

    Alternates the large-star and small-star steps of the published MapReduce algorithm. A node's
    smallest neighbour is a map-side minimum joined back, so a node with very many neighbours is
    never gathered in one place; each round's edges are a staged table, which ends the lineage.
    """
    both = edges.where("a <> b").select("a", "b")
    now = stage(both.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before:
            break
        before = state
        turned = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        smallest = turned.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = turned.join(smallest, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stage(large.unionByName(now.join(smallest, "a").select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(small.unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct(), "edges")
    return now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
