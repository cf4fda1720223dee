"""Exact duplicates by two passes over a Bloom filter, with built-in expressions only.

Pass 1 hashes every text and counts the hashes' fingerprints: a fingerprint is a word number of
the filter and four bits inside that 64-bit word. Counts combine on the map side, so a text that
repeats without end costs one row per task. Fingerprints seen more than once set their bits; the
filter is a table of at most ``filter_words`` rows of two longs, which bounds its broadcast.
Pass 2 probes each row: rows whose bits are not all set cannot repeat and pass straight through;
only the others shuffle, by their SHA-256. A fuller filter lets more rows shuffle and changes no
result, so the bound is safe at any size.

Defined results: a null text equals an empty one; a null id is smaller than any other; of rows
equal in text and id one stays; an empty table gives an empty result; other columns, whatever
their names, ride along; texts of any length are hashed whole where they are read.
"""

from pyspark.sql import functions as F

from shelfline.llm.common import ascii_lower, filter_place, stage

FILTER_WORDS = 1 << 20  # 8 MB of bits; as rows of (word, bits) 16 MB


def with_fingerprint(docs, text_col, filter_words):
    """Adds the text's SHA-256 and its place in the filter."""
    word, mask = filter_place("__place", filter_words)
    return (
        docs.withColumn("__sha", F.sha2(ascii_lower(F.coalesce(text_col, F.lit(""))), 256))
        .withColumn("__place", F.xxhash64("__sha"))
        .withColumns({"__word": word, "__mask": mask})
        .drop("__place")
    )


def repeat_filter(marked):
    """The filter as rows (word, bits): the bits of every fingerprint seen more than once."""
    return (
        marked.groupBy("__word", "__mask")
        .agg(F.count("*").alias("__n"))
        .where("__n > 1")
        .groupBy("__word")
        .agg(F.bit_or("__mask").alias("__bits"))
    )


def probe(marked, bloom):
    """Adds ``__maybe``: whether the row's bits are all set."""
    hit = F.coalesce(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
    return marked.join(F.broadcast(bloom), "__word", "left").withColumn("__maybe", hit)


def duplicate_groups(docs, id_col="doc_id", text_col="text", filter_words=FILTER_WORDS):
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Only (id, hash) rows shuffle. Copies of one text are counted on the map side; the counted
    groups join back by hash, where adaptive execution splits a hot hash.
    """
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("__text"))
    marked = stage(with_fingerprint(slim, F.col("__text"), filter_words).drop("__text"), "exact-hashes")
    probed = probe(marked, repeat_filter(marked)).select("doc_id", "__sha", "__maybe")
    single = probed.where(~F.col("__maybe")).select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )
    same_row = probed.where("__maybe").groupBy("__sha", "doc_id").agg(F.count("*").alias("__copies"))
    groups = same_row.groupBy("__sha").agg(
        F.max("doc_id").alias("keep_id"), F.sum("__copies").alias("group_size")
    )
    repeated = (
        same_row.join(groups, "__sha")
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("__copy") == 1)).alias("kept"),
            F.col("__sha").alias("text_sha256"),
        )
    )
    return single.unionByName(repeated)


def drop_duplicates(docs, id_col="doc_id", text_col="text", filter_words=FILTER_WORDS):
    """``docs`` without all but the row of the largest id of each text, all columns kept.

    Rows that cannot repeat never shuffle. Of the others each map task sends one row per text.
    """
    names = docs.columns
    whole = docs.select(
        F.col(id_col).alias("__id"), F.col(text_col).alias("__text"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("__row")
    )
    marked = with_fingerprint(whole, F.col("__text"), filter_words)
    bloom = stage(repeat_filter(marked.select("__word", "__mask")), "exact-filter")
    probed = probe(marked, bloom)
    single = probed.where(~F.col("__maybe")).select("__row")
    best = (
        probed.where("__maybe").groupBy("__sha").agg(F.max_by("__row", F.coalesce("__id", F.lit(-(2**63)))).alias("__row"))
    ).select("__row")
    return single.unionByName(best).select(*[F.col("__row")[n].alias(n) for n in names])
