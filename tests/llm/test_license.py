import random
import re
from collections import Counter
from math import ceil

import pytest

import cases
from shelfline.llm import license_scan as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
MIT, LONG_MIT = L.TEMPLATES[0][1], L.TEMPLATES[1][1]


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


def expected(rows, templates=L.TEMPLATES, phrases=L.PHRASES, percent=L.PERCENT):
    known = [(label, words_of(text)) for label, text in templates if words_of(text)]
    found = Counter()
    for i, text in rows:
        words = words_of(text)
        places, base, labels, best = [], set(), set(), 0.0
        for phrase, label in phrases.items():
            parts = phrase.split(" ")
            here = [n for n in range(len(words)) if words[n : n + len(parts)] == parts]
            places += here
            base |= {label} if here else set()
        for label, template in known:
            width, whole = 8, set(template)
            while width < len(template):
                width *= 2
            for begin in range(0, max(1, (len(words) - 1) // width) * width, width):
                shared = len(whole & set(words[begin : begin + 2 * width]))
                if shared >= ceil(percent * len(whole) / 100):
                    labels.add(label)
                    best = max(best, shared / len(whole))
        edge = (min(places), max(places)) if places else (None, None)
        both = ",".join(sorted(base | labels))
        found[(i, len(words), len(places), *edge, ",".join(sorted(base)), both, 1.0 if places else best)] += 1
    return found


def noisy(seed, n=80):
    """Texts around whole, cut and changed notices, with phrases that overlap."""
    r = random.Random(seed)
    filler = ["the", "license", "under", "work", "copy", "é漢", "W1", "of", "version", "2"]
    rows = []
    for i in range(n):
        notice = r.choice(L.TEMPLATES)[1].split()
        notice = [w if r.random() > 0.12 else r.choice(filler) for w in notice][r.randint(0, 2) :]
        around = [[r.choice(filler) for _ in range(r.randint(0, 70))] for _ in range(2)]
        rows.append((i, r.choice([" ", "\n", ", "]).join(around[0] + notice + around[1])))
    return rows


LICENSED = [
    (20, f"x\n{MIT.upper()}\n" * 3),
    (21, "under the MIT license under the mit-license"),
    (22, "cc by nc by nc CC BY-NC cc by nc"),
    (23, "word " * 5000 + LONG_MIT + " word" * 5000),
    (24, L.TEMPLATES[7][1]),
]


@pytest.mark.parametrize("rows", [cases.AWKWARD + LICENSED, noisy(1), noisy(2), []])
def test_scan_equals_plain_comparison(spark, rows):
    got = L.scan_licenses(cases.documents(spark, rows))
    assert Counter(map(tuple, got.collect())) == expected(rows)


def test_own_templates_and_threshold(spark):
    rows = [(1, "a b c d e f g h"), (2, "a b c x y z"), (3, "h g f e d c b a " * 9), (4, "a a a a")]
    templates = [("letters", "a b c d e f g h"), ("four", "a b c d"), ("none", "...")]
    for percent in (50, 75, 100):
        got = L.scan_licenses(cases.documents(spark, rows), templates=templates, phrases={}, percent=percent)
        assert Counter(map(tuple, got.collect())) == expected(rows, templates, {}, percent)
    bare = L.scan_licenses(cases.documents(spark, rows), templates=[], phrases={"a b": "ab"})
    assert {(r.doc_id, r.labels) for r in bare.collect()} == {(1, "ab"), (2, "ab"), (3, ""), (4, "")} | {(3, "")}


def test_held_words_keep_the_common_order(spark):
    docs = cases.documents(spark, noisy(3, 20))
    known = L.template_rows(spark, L.TEMPLATES)
    order = L.common_order(docs, sorted({word for row in known for word in row[2]}))
    blocks = docs.select(L.candidate_blocks(L.words_of(docs.text), known, order).alias("b")).selectExpr("inline(b)").collect()
    assert blocks
    for block in blocks:
        places = [order.index(word) for word in block.held]
        assert places == sorted(places)


def test_scan_stays_native(spark):
    docs = cases.documents(spark, LICENSED)
    plan = L.scan_licenses(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
