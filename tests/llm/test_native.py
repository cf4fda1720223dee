import hashlib
import re
from collections import Counter, defaultdict

import pytest

import cases
from shelfline.llm import exact_dedup, line_dedup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("rows", [cases.AWKWARD, cases.corpus(1), []])
@pytest.mark.parametrize("words", [1 << 20, 4])
def test_exact_groups(spark, rows, words):
    folded = [(i, (t or "").translate(UPPER)) for i, t in rows]
    groups = defaultdict(list)
    for i, t in folded:
        groups[t].append(i)
    expected = Counter()
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        taken = False
        for i in ids:
            kept = i == keep and not taken
            taken = taken or kept
            expected[(i, keep, len(ids), kept, sha(t))] += 1
    got = exact_dedup.duplicate_groups(cases.documents(spark, rows), filter_words=words)
    assert Counter(map(tuple, got.collect())) == expected


@pytest.mark.parametrize("rows", [cases.AWKWARD, cases.corpus(2), []])
def test_exact_duplicates_go(spark, rows):
    best = {}
    for i, t in rows:
        folded = (t or "").translate(UPPER)
        best[folded] = max(best.get(folded, -1), -1 if i is None else i)
    docs = cases.documents(spark, rows)
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(-1 if r[0] is None else r[0] for r in kept.collect()) == Counter(best.values())


def test_exact_dedup_stays_native(spark):
    plan = exact_dedup.duplicate_groups(cases.documents(spark, cases.AWKWARD))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan


def lines_expected(rows):
    first = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip("\x20\t\n\x0b\x0c\r").translate(UPPER)
            if i is not None and len(key) >= 10:
                first[key] = min(i, first.get(key, i))
    expected = Counter()
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [
            line
            for line in lines
            if i is None or first.get(line.strip("\x20\t\n\x0b\x0c\r").translate(UPPER), i) == i
        ]
        expected[(i, len(lines), len(lines) - len(kept), "\n".join(kept))] += 1
    return expected


def with_lines(rows):
    return [(i, re.sub(r" (w\d0) ", r"\n\1 ", t)) for i, t in rows]


@pytest.mark.parametrize("rows", [cases.AWKWARD, with_lines(cases.corpus(3, 80, 40)), []])
def test_lines_stay_in_their_first_document(spark, rows):
    got = line_dedup.deduplicate_lines(cases.documents(spark, rows))
    assert Counter(map(tuple, got.collect())) == lines_expected(rows)


def test_keep_bitmaps_hold_only_words_that_lose_lines(spark):
    line = "a line of more than ten characters"
    rows = [(1, line), (2, "\n".join([f"own line number {n} here" for n in range(200)] + [line]))]
    found = line_dedup.keep_bitmaps(cases.documents(spark, rows)).collect()
    assert [(r.doc_id, r.n_dropped, set(r.keep)) for r in found] == [(2, 1, {3})]
    assert found[0].keep[3] == ~(1 << (200 % 64))
