import random
import re

import numpy as np
import pytest

import cases
from shelfline.llm import jaccard_join, substring_dedup
from shelfline.llm.common import word_hashes


def fold(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text))


def shingles(text):
    words = words_of(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def components(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, x) in enumerate(sets):
        for j in range(i):
            y = sets[j][1]
            shared = len(x & y)
            if shared and 100 * shared >= 80 * (len(x) + len(y) - shared):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    groups = {}
    for i, (doc, _) in enumerate(sets):
        groups.setdefault(find(i), []).append(doc)
    return [(doc, len(s), min(groups[find(i)])) for i, (doc, s) in enumerate(sets)]


@pytest.mark.parametrize("block, hot, first", [(512, 64, 4), (8, 3, 1)])
def test_classes_equal_brute_force(spark, monkeypatch, block, hot, first):
    monkeypatch.setattr(jaccard_join, "BLOCK", block)
    monkeypatch.setattr(jaccard_join, "HOT_LEAST", hot)
    monkeypatch.setattr(jaccard_join, "FIRST_TOKENS", first)
    rows = cases.corpus(7, 150, 200, 60) + [(900, ""), (901, None), (902, "One"), (903, "one"), (904, "A b C"), (905, "a B c")]
    got = jaccard_join.near_duplicate_classes(cases.documents(spark, rows))
    assert sorted(map(tuple, got.collect())) == sorted(components(rows))


def test_awkward_rows_and_first_of_each_class(spark):
    docs = cases.documents(spark, cases.AWKWARD)
    got = sorted(map(tuple, jaccard_join.near_duplicate_classes(docs).collect()), key=repr)
    known = components([row for row in cases.AWKWARD if row[0] is not None])
    assert [row for row in got if row[0] is not None] == sorted(known, key=repr)
    without_id = sorted((row[1:] for row in got if row[0] is None), key=repr)
    assert without_id == sorted([(0, None), (len(shingles(cases.SENTENCE)), 3)], key=repr)
    kept = jaccard_join.keep_first(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    assert sorted(ids) == sorted(doc for doc, _, first in known if doc == first)
    assert jaccard_join.near_duplicate_classes(docs.limit(0)).count() == 0


def test_tree_loses_no_pair():
    rng = np.random.default_rng(3)
    base = [rng.integers(0, 1 << 48, 80).astype(np.uint64) for _ in range(6)]
    sets = []
    for _ in range(150):
        kept = base[rng.integers(6)].copy()
        kept[: rng.integers(0, 20)] = rng.integers(0, 1 << 48, 1)
        sets.append(np.unique(kept[rng.integers(0, 15) :]))
    group = jaccard_join.Group([len(s) for s in sets], [jaccard_join.bitmap(s) for s in sets], 80)
    found = {frozenset(pair) for pair in zip(*(side.tolist() for side in group.links()))}
    for i in range(len(sets)):
        for j in range(i):
            if jaccard_join.similar(sets[i], sets[j], 80):
                assert frozenset((i, j)) in found
    assert len(found) < 150 * 149 // 2


def covered(rows, size=50):
    """Words of each document inside a run of ``size`` words that a smaller id holds too."""
    first, need = {}, {}
    for doc, text in sorted((row for row in rows if row[0] is not None), key=lambda row: row[0]):
        words = words_of(text)
        for p in range(len(words) - size + 1):
            run = tuple(words[p : p + size])
            if first.setdefault(run, doc) < doc:
                need.setdefault(doc, set()).update(range(p, p + size))
    return need


def test_repeated_passages_are_covered(spark):
    rows = cases.corpus(9, 120, 400, 200)
    got = substring_dedup.repeated_passages(cases.documents(spark, rows)).collect()
    have = {}
    for r in got:
        assert r.ref_id < r.doc_id and r.n_words >= 50 and r.n_equal >= 0.8 * r.n_words
        have.setdefault(r.doc_id, set()).update(range(r.start, r.stop))
    need = covered(rows)
    missed = sum(len(need[d] - have.get(d, set())) for d in need)
    assert set(need) <= set(have) and missed <= 0.02 * sum(map(len, need.values()))


def lost_words(spark, rows):
    """Words of ``covered`` that no passage holds, by document."""
    have = {}
    for r in substring_dedup.repeated_passages(cases.documents(spark, rows)).collect():
        have.setdefault(r.doc_id, set()).update(range(r.start, r.stop))
    lost = {doc: need - have.get(doc, set()) for doc, need in covered(rows).items()}
    return {doc: words for doc, words in lost.items() if words}


def changed(rng, passage, every):
    """``passage`` with every ``every``-th word changed."""
    return [f"new{rng.randrange(10**9)}" if i % every == every - 1 else word for i, word in enumerate(passage)]


def test_the_nearest_holder_counts_however_far_it_is(spark):
    rng = random.Random(8)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for i in range(10):
        left, right = text(30), text(30)
        halves = [text(40) + left + text(40), text(40) + right + text(40)]
        whole = [text(40) + left + right + text(40) for _ in range(2)]
        rows += [(i + at, " ".join(words)) for at, words in zip((0, 5000, 10_000, 20_000), halves + whole)]
    assert not lost_words(spark, rows)


def test_passages_with_changed_words_are_found(spark):
    rng = random.Random(4)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    rows, planted = [], {}
    for every in (5, 6, 8, 10, 12):
        for size in (60, 200):
            for _ in range(10):
                passage = text(size)
                rows.append((len(rows), " ".join(text(40) + passage + text(30))))
                planted[len(rows)] = (len(rows) - 1, every, size)
                rows.append((len(rows), " ".join(text(70) + changed(rng, passage, every) + text(20))))
    found = {}
    for r in substring_dedup.repeated_passages(cases.documents(spark, rows)).collect():
        assert r.n_words >= 50 and r.n_equal >= 0.8 * r.n_words
        found.setdefault((r.doc_id, r.ref_id), set()).update(range(r.start, r.stop))
    assert set(found) <= {(doc, ref) for doc, (ref, _, _) in planted.items()}
    for every in (5, 6, 8, 10, 12):
        mine = [(doc, ref, size) for doc, (ref, e, size) in planted.items() if e == every]
        whole = [len(found.get((doc, ref), set()) & set(range(70, 70 + size))) >= 0.8 * size for doc, ref, size in mine]
        assert sum(whole) >= 0.9 * len(whole), every


def test_an_equal_part_of_a_chain_that_differs_too_much_counts(spark):
    rng = random.Random(6)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    equal, rest = text(60), text(240)
    far = [word for i in range(0, 240, 12) for word in rest[i : i + 5] + text(7)]
    rows = [(1, " ".join(equal + rest)), (2, " ".join(equal + far))]
    assert not lost_words(spark, rows)


@pytest.mark.parametrize("size", [60, 500])
@pytest.mark.parametrize("period", [1, 3, 16, 24])
def test_passages_that_repeat_a_phrase_are_covered(spark, size, period):
    rng = random.Random(period)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    phrase = text(period)
    run = lambda n: [phrase[i % period] for i in range(n)]
    rows = [text(20) + run(20) + text(20), text(20) + run(size) + text(20), text(20) + run(30) + text(9)]
    rows += [text(30) + run(size) + text(10), run(size + 21), text(5) + run(3 * size + 40), run(7) + text(30) + run(size - 5)]
    assert not lost_words(spark, [(i, " ".join(words)) for i, words in enumerate(rows)])


def test_passages_of_awkward_rows(spark):
    docs = cases.documents(spark, cases.AWKWARD)
    got = substring_dedup.repeated_passages(docs).collect()
    assert {(r.doc_id, r.ref_id) for r in got} == {(7, 6)}
    assert sum(r.n_equal for r in got) == 80_000
    assert substring_dedup.repeated_passages(docs.limit(0)).count() == 0


def test_chains_ascend_in_both_texts():
    rng = np.random.default_rng(2)
    x = np.sort(rng.integers(0, 400, 80))
    y = rng.integers(0, 400, 80)
    order = np.lexsort((y, x))
    x, y = x[order], y[order]
    seen = set()
    for chain in substring_dedup.chains_of(x, y):
        assert (np.diff(x[chain]) > 0).all() and (np.diff(y[chain]) > 0).all()
        assert not seen & set(chain.tolist())
        seen |= set(chain.tolist())


def test_the_best_chain_has_the_best_score():
    rng = np.random.default_rng(5)
    for _ in range(20):
        x, y = np.sort(rng.choice(300, 25, replace=False)), rng.choice(300, 25, replace=False)
        best = np.zeros(25)
        for i in range(25):
            before = [best[j] - substring_dedup.GAP_COST * (x[i] - x[j] + y[i] - y[j]) for j in range(i) if y[j] < y[i]]
            best[i] = substring_dedup.ANCHOR_SCORE + max([0, *before])
        chains = substring_dedup.chains_of(x, y)
        if best.max() > substring_dedup.ANCHOR_SCORE:
            chain = chains[0]
            gaps = np.diff(x[chain]) + np.diff(y[chain])
            score = len(chain) * substring_dedup.ANCHOR_SCORE - substring_dedup.GAP_COST * gaps.sum()
            assert score == pytest.approx(best.max())


def test_words_are_hashed_alike_in_any_company():
    texts = ["One two\tTHREE", None, "", " four ", "éa ÉA", "x" * 100_000]
    alone = [word_hashes([t])[0].tolist() for t in texts]
    together, offsets = word_hashes(texts)
    assert [together[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == alone
    assert [len(a) for a in alone] == [3, 0, 0, 1, 2, 1] and alone[4][0] != alone[4][1]


def test_holders_between_the_first_and_the_one_before_count(spark):
    """Each half of a run is held by an earlier and a later document than the one that holds the whole run."""
    rng = random.Random(11)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    rows = []
    for i in range(8):
        left, right = text(26 + i), text(26 + i)
        parts = [left, right, left + right, left, right, left + right]
        rows += [(1000 * at + i, " ".join(text(40) + part + text(40))) for at, part in enumerate(parts)]
    assert not lost_words(spark, rows)


def test_runs_that_no_passage_covers_become_passages(spark):
    found = spark.createDataFrame([(7, 1, 0, 60, 0, 60, 60, 55), (7, 2, 30, 90, 0, 60, 60, 60), (8, 1, 0, 500, 0, 500, 500, 500)], substring_dedup.PASSAGE)
    runs = [(7, 3, x, x + 5) for x in (5, 10, 11, 12, 30, 40, 41)] + [(8, 3, 9, 9), (9, 3, 0, 4), (9, 4, 1, 5), (9, 3, 2, 7)]
    got = substring_dedup.uncovered(spark.createDataFrame(runs, substring_dedup.MATCH), found).collect()
    spans = [(7, 3, 11, 12, 5), (7, 3, 41, 41, 5), (9, 3, 0, 0, 4), (9, 4, 1, 1, 4), (9, 3, 2, 2, 5)]
    assert {tuple(r) for r in got} == {(d, r, x, z + 50, x + o, z + 50 + o, z + 50 - x, z + 50 - x) for d, r, x, z, o in spans}
    assert len(got) == len(spans)


def test_straight_chains_are_aligned_together_as_one_by_one(monkeypatch):
    rng = np.random.default_rng(5)
    chained, expected = [], []
    for number in range(400):
        size, lead = int(rng.integers(60, 200)), int(rng.integers(0, substring_dedup.MARGIN + 1))
        a = rng.integers(0, 1 << 32, size, dtype=np.uint32)
        b = np.where(rng.random(size) < rng.choice([0, 0.05, 0.2, 0.4]), np.uint32(7), a)
        shift = int(rng.integers(0, 20))
        a = np.concatenate([a[:lead][::-1][:shift], a])
        gaps = rng.integers(1, 30, int(rng.integers(1, 8)))
        ys = min(lead, size - substring_dedup.SHORT) + np.concatenate([[0], np.cumsum(gaps)])
        ys = ys[ys + substring_dedup.SHORT <= size]
        xs = ys + len(a) - size
        a, b = (words[: at[-1] + substring_dedup.SHORT + substring_dedup.MARGIN] for words, at in ((a, xs), (b, ys)))
        begin, ref_begin = max(0, xs[0] - substring_dedup.MARGIN), max(0, ys[0] - substring_dedup.MARGIN)
        row = xs - begin, ys - ref_begin, a[begin:], b[ref_begin:]
        chained.append(row)
        expected.append(substring_dedup.align(row[0].tolist(), row[1].tolist(), *row[2:]))
    assert substring_dedup.align_straight(chained).tolist() == [list(map(int, row)) for row in expected]
    found = [
        (i, tuple(map(int, passage)))
        for i, row in enumerate(chained)
        for passage in substring_dedup.passages(row[0].tolist(), row[1].tolist(), *row[2:])
        if passage[4] >= substring_dedup.MIN_WORDS and passage[5] >= substring_dedup.IDENTITY * passage[4]
    ]
    assert found and sorted((i, tuple(map(int, passage))) for i, passage in substring_dedup.passages_of(chained)) == sorted(found)
    whole = [row for row in chained if (row[2][: len(row[3])] == row[3][: len(row[2])]).all()]
    monkeypatch.setattr(substring_dedup, "align", None)  # these need no alignment one by one
    assert len(list(substring_dedup.passages_of(whole))) <= len(whole)


@pytest.mark.parametrize("parts", [2, 3])
def test_a_holder_in_between_of_a_passage_with_changed_words_counts(spark, parts):
    """All but one part of a passage are held by earlier and later documents than the one that holds it whole."""
    rng = random.Random(12)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    rows, whole = [], {}
    for i in range(20):
        size = 17 + i % 2 if parts == 3 else 28 + i % 15
        passage = [text(size) for _ in range(parts)]
        pieces = [sum((text(size) if n == out else part for n, part in enumerate(passage)), []) for out in range(parts)]
        passage = sum(passage, [])
        texts = [*pieces, passage, *pieces, changed(rng, passage, 8)]
        rows += [(1000 * at + i, " ".join(text(40) + words + text(40))) for at, words in enumerate(texts)]
        whole[1000 * (len(texts) - 1) + i] = (1000 * parts + i, len(passage))
    found = {}
    for r in substring_dedup.repeated_passages(cases.documents(spark, rows)).collect():
        assert r.n_words >= 50 and r.n_equal >= 0.8 * r.n_words
        found.setdefault((r.doc_id, r.ref_id), set()).update(range(r.start, r.stop))
    covered = [len(found.get((doc, ref), set()) & set(range(40, 40 + size))) >= 0.8 * size for doc, (ref, size) in whole.items()]
    assert sum(covered) >= 0.9 * len(covered)


def test_a_chain_is_refilled_across_a_shift():
    rng = np.random.default_rng(7)
    a = rng.integers(0, 1 << 32, 150, dtype=np.uint32)
    b = np.concatenate([a[:60], rng.integers(0, 1 << 32, 3, dtype=np.uint32), a[60:]])
    chains = substring_dedup.refilled(np.array([10, 30]), np.array([10, 30]), a, b)
    found = [passage for _, passage in substring_dedup.passages_of(chains)]
    assert [tuple(map(int, passage)) for passage in found] == [(0, 150, 0, 153, 153, 150)]
    assert substring_dedup.refilled(np.array([10]), np.array([10]), a, b[:3]) == []
