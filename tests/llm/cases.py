"""Tables with every awkward row, shared by the tests of the text operators."""

import random

from pyspark.sql import types as T

LONG = " ".join(f"word{i % 977} tail{i}" for i in range(40_000))
SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        *[T.StructField(name, T.StringType()) for name in ("__row", "__id", "key", "n", "__sha", "toxic", "a.b")],
    ]
)
PLAIN = T.StructType(SCHEMA.fields[:2])
SENTENCE = "Some Words of a sentence\nthat several documents hold twice over\n\nand more"


def documents(spark, rows, parts=3):
    """Rows (doc_id, text) with all other columns filled, some of them with NULL."""
    full = [(i, t, "en" if n % 3 else None, "src0", None, "x", "y", None, "z", "s", "0", "d") for n, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(parts)


AWKWARD = [
    (1, ""),
    (2, None),
    (3, SENTENCE),
    (3, SENTENCE),
    (4, SENTENCE.upper()),
    (5, SENTENCE + " at the end"),
    (None, SENTENCE),
    (None, None),
    (6, LONG),
    (7, LONG + " changed"),
    (8, "  \t "),
    (9, "one"),
    (10, "éÀß 漢字 😀 token = 'abcdef'"),
]


def corpus(seed, n=60, vocabulary=300, longest=150):
    """Random texts with copies, near copies and shared passages; ids from 0."""
    r = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)]
    texts = []
    passage = " ".join(r.choice(words) for _ in range(60))
    for _ in range(n):
        kind, text = r.random(), " ".join(r.choice(words) for _ in range(r.randint(1, longest)))
        if texts and kind < 0.3:
            text = r.choice(texts)
        elif texts and kind < 0.6:
            changed = r.choice(texts).split() or ["x"]
            for _ in range(r.randint(1, 4)):
                changed[r.randrange(len(changed))] = r.choice(words)
            text = " ".join(changed)
        elif kind < 0.75:
            text = f"{text}\n{passage}\n{text[:40]}"
        texts.append(text)
    return list(enumerate(texts))
