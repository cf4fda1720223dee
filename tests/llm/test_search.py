import math
import random
import re
from collections import Counter

import pytest

import cases
from shelfline.llm import lexical_search as S

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms_of(text):
    return TERM.findall(text.translate(UPPER)) if text else []


def expected(docs, items, top=S.TOP):
    counts = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    N, L = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(term for _, c in counts for term in c)
    found = Counter()
    for item, text in set(items):
        scored = []
        for i, c in counts:
            m = 50 + 50 * sum(c.values()) * N // L
            score = 0
            for term in set(terms_of(text)):
                if c[term]:
                    score += math.floor(1000 * math.log((2 * N + 2) / (2 * df[term] + 1))) * (10**9 * c[term] // (1000 * c[term] + 20 * m))
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, none, i) in enumerate(sorted(scored)[:top], 1):
            found[(item, rank, None if none else i, -score)] += 1
    return found


def benchmark(spark, rows):
    return spark.createDataFrame([(i, t, "x", None) for i, t in rows], "item_id long, text string, doc_id string, score string").repartition(2)


ITEMS = [(1, "word1 TAIL5 some words"), (2, None), (3, ""), (4, "... !"), (5, "éÀß 漢字"), (5, "éÀß 漢字"), (6, "w1 w2 w3 w1 w299"), (7, "w5")]
BIG = (2**60 + 1, "w1 w5 w5")


@pytest.mark.parametrize("rows", [cases.AWKWARD, [*cases.corpus(4, 90), BIG, (None, "w5 w1"), (17, "w5")], []])
@pytest.mark.parametrize("top", [50, 3])
def test_search_equals_plain_scores(spark, rows, top):
    got = S.search(cases.documents(spark, rows), benchmark(spark, ITEMS), top=top)
    assert Counter(map(tuple, got.collect())) == expected(rows, ITEMS, top)


def test_many_copies_of_the_best_document(spark):
    rows = [(i, "w1 w2 w3") for i in range(300, 0, -1)] + [(i, "w1 w9 " * (i % 5)) for i in range(301, 400)]
    got = S.search(cases.documents(spark, rows), benchmark(spark, ITEMS), top=20)
    assert Counter(map(tuple, got.collect())) == expected(rows, ITEMS, 20)


def test_blocks_of_items_and_small_pieces(spark, monkeypatch):
    r = random.Random(8)
    rows = cases.corpus(9, 80)
    items = [(i, " ".join(f"w{r.randrange(300)}" for _ in range(r.choice([1, 5, 20, 150])))) for i in range(30)]
    monkeypatch.setattr(S, "ITEMS", 11)
    monkeypatch.setattr(S, "TERMS", 200)
    got = S.search(cases.documents(spark, rows), benchmark(spark, items), top=5)
    assert Counter(map(tuple, got.collect())) == expected(rows, items, 5)


def test_no_items(spark):
    assert S.search(cases.documents(spark, cases.AWKWARD), benchmark(spark, [])).collect() == []


def test_masks_are_evaluated_from_the_highest_bound_down():
    import numpy as np

    r = np.random.default_rng(1)
    terms = [np.flatnonzero(r.random(100) < 0.2) for _ in range(400)]
    tf = [r.integers(1, 5, len(t)) for t in terms]
    weight = r.integers(0, 5000, 100)
    piece = S.Piece(r.integers(20, 200, 400), terms, tf, weight, 400, 40_000)
    for size in (1, 7, 64, 65, 90):
        own = np.sort(r.choice(100, size, replace=False))
        mine = np.isin(np.arange(100), own)
        every = piece.scores(np.arange(400), mine)
        rows, scores = piece.best(own, 1, 10)
        assert (scores == every[rows]).all()
        cut = max(1, np.sort(every)[-10])
        assert set(np.flatnonzero(every >= cut)) == set(rows)
        assert len(piece.best(own, int(every.max()) + 1, 10)[0]) == 0
