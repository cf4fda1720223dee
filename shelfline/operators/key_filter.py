"""Bloom filters of keys per partition: a bounded table that tells which rows may be known already.

A filter has at most ``words`` rows (partition, word, bits) per partition, whatever the number of its
keys; a key sets four bits of one 64-bit word. A key that was added is always found again. A key that
was not may be found too, the more often the fuller the filter is, so what is found must be checked
against the rows themselves.
"""

from pyspark.sql import functions as F

WORDS = 1 << 12


def _place(keys, words):
    """Word number and bits of a key."""
    key = F.xxhash64(*keys)
    bits = [F.expr(f"shiftleft(1L, cast(shiftright(__key, {shift}) & 63 as int))") for shift in (0, 6, 12, 18)]
    mask = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return key, F.expr(f"cast(pmod(shiftright(__key, 24), {words}L) as int)"), mask


def filter_of(rows, partition, keys, words=WORDS):
    """The filter (partition, word, bits) of all keys of ``rows``."""
    key, word, mask = _place(keys, words)
    placed = rows.select(partition, key.alias("__key")).select(partition, word.alias("word"), mask.alias("bits"))
    return united(placed, partition)


def united(filters, partition):
    """One filter of several: a row per partition and word."""
    return filters.groupBy(partition, "word").agg(F.bit_or("bits").alias("bits"))


def marked(rows, known, partition, keys, words=WORDS):
    """``rows`` with ``maybe_known``: whether the filter of their partition may hold their key."""
    key, word, mask = _place(keys, words)
    placed = rows.withColumn("__key", key).withColumns({"__word": word, "__mask": mask}).drop("__key")
    there = known.select(F.col(partition).alias("__partition"), F.col("word").alias("__other"), F.col("bits").alias("__bits"))
    match = (F.col(partition) == F.col("__partition")) & (F.col("__word") == F.col("__other"))
    hit = F.coalesce(F.col("__bits").bitwiseAND(F.col("__mask")) == F.col("__mask"), F.lit(False))
    return placed.join(there, match, "left").withColumn("maybe_known", hit).select(*rows.columns, "maybe_known")
