"""Repeated lines, kept only in the first document that holds them; built-in expressions only.

Lines become (128-bit key hash, document, position). They are range-partitioned by hash and
document and sorted by hash, document and position, so a hash that fills a third of the corpus
spreads over many ranges. The sorted stream yields each document's first position per hash and
the first document per hash (a map-side minimum, one row per hash and task). What leaves the
operator is a bitmap per document, not text: a map from word number to a 64-bit word, with only
the words that lose a line; absent words keep all their lines.

Defined results: a null or empty text is one empty line; a row without an id is returned
unchanged and counts for no other document; rows with one id but different texts are cut
apart by a hash of their text and count as one document; an empty table gives an empty result; other
columns are not read, whatever their names; a very long text has one row per line, whatever their number.
"""

from pyspark.sql import functions as F

from shelfline.llm.common import ascii_lower, stage

LINE_SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
MIN_LENGTH = 10
HASH = ["h1", "h2"]


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def hashed_lines(docs, id_col, text_col, min_length=MIN_LENGTH):
    """Rows (h1, h2, doc_id, text_hash, position) of all lines whose key is long enough."""
    lines = docs.select(
        F.col(id_col).alias("doc_id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.posexplode(_lines(F.col(text_col))).alias("position", "line"),
    ).where(F.col("doc_id").isNotNull())
    key = ascii_lower(F.btrim("line", F.lit(LINE_SPACES)))
    return (
        lines.withColumn("key", key)
        .where(F.length("key") >= min_length)
        .select(
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("second"), "key").alias("h2"),
            "doc_id",
            "text_hash",
            "position",
        )
    )


def keep_bitmaps(docs, id_col="doc_id", text_col="text", min_length=MIN_LENGTH):
    """Rows (doc_id, text_hash, n_dropped, keep: map of word number to bits) of documents that lose lines."""
    staged = stage(hashed_lines(docs, id_col, text_col, min_length), "line-hashes")
    streamed = staged.repartitionByRange(*HASH, "doc_id").sortWithinPartitions(*HASH, "doc_id", "position")
    holders = streamed.groupBy(*HASH, "doc_id").agg(
        F.collect_list(F.struct("text_hash", "position")).alias("places")
    )
    heads = (
        holders.groupBy(*HASH)
        .agg(F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc"))
        .where("first_doc < last_doc")
    )
    dropped = (
        holders.join(heads, HASH)
        .where("doc_id > first_doc")
        .select("doc_id", F.explode("places").alias("place"))
        .select("doc_id", "place.text_hash", "place.position")
        .distinct()
    )
    words = dropped.groupBy("doc_id", "text_hash", F.expr("position div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, position % 64)")).alias("bits"), F.count("*").alias("n")
    )
    return words.groupBy("doc_id", "text_hash").agg(
        F.sum("n").alias("n_dropped"),
        F.map_from_entries(F.collect_list(F.struct("word", F.bitwise_not("bits").alias("bits")))).alias("keep"),
    )


def apply_bitmaps(docs, bitmaps, id_col="doc_id", text_col="text"):
    """(id, n_lines, n_dropped, kept text) of every row; lines without a set bit are left out."""
    rows = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"), F.xxhash64(F.col(text_col)).alias("text_hash")
    )
    joined = rows.join(bitmaps, ["doc_id", "text_hash"], "left")
    kept = F.expr(
        "array_join(filter(split(text, '\n', -1), (line, i) -> "
        "shiftright(coalesce(keep[cast(i div 64 as bigint)], -1L), i % 64) & 1 = 1), '\n')"
    )
    return joined.select(
        "doc_id",
        F.size(_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
    )


def deduplicate_lines(docs, id_col="doc_id", text_col="text", min_length=MIN_LENGTH):
    return apply_bitmaps(docs, keep_bitmaps(docs, id_col, text_col, min_length), id_col, text_col)
