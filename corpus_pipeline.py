"""A corpus pipeline as a list of stages; ``run`` applies them to ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and
read again as the next one's ``docs``. All but the last return the columns of ``documents``.

Defined results: null and empty texts are no toxic documents, copies of each other (the row of the
largest id stays), near copies of nothing and free of leaks, and encode to no tokens; rows without an id
are judged by their text and never removed as near copies; of rows equal in text and id one stays; an
empty table gives an empty result of the same columns; further columns, whatever their names, ride along
up to the last stage, which returns its own.
"""

from shelfline.llm import bpe, decontaminate, exact_dedup, jaccard_join, toxicity
from shelfline.llm.common import stage, table
from shelfline.llm.registry import query


def reject_toxic(spark, docs, sf_dir):
    """Drops documents that the classifier chain calls toxic."""
    return toxicity.keep_clean(docs, toxicity.chain_labels(table(spark, sf_dir, "labels")))


def drop_copies(spark, docs, sf_dir):
    """Keeps the row of the largest id of each text."""
    return exact_dedup.drop_duplicates(docs)


def drop_near_copies(spark, docs, sf_dir):
    """Keeps the smallest id of each group of near duplicates."""
    return jaccard_join.keep_first(docs)


def drop_benchmark_leaks(spark, docs, sf_dir):
    """Drops documents that hold a benchmark passage or its paraphrase."""
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def encode(spark, docs, sf_dir):
    """Token counts and digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, bpe.tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("bpe", encode),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


@query("pipeline", ORACLE_SQL)
def pipeline(spark, sf_dir):
    return run(spark, sf_dir)
