import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import cases
from shelfline.llm import decontaminate, language_id, toxicity

LANGUAGES = {"aa": "ba be bi bo lo la", "bb": "xy xu zy zu qy qu", "cc": "mmo mma nno nna rra"}


def speech(r, language, n):
    parts = LANGUAGES[language].split()
    return " ".join("".join(r.choice(parts) for _ in range(r.randint(1, 3))) for _ in range(n))


def spoken(spark, n=90):
    r = random.Random(8)
    rows = [(i, speech(r, lang, 30), lang) for i, lang in ((i, sorted(LANGUAGES)[i % 3]) for i in range(n))]
    rows += [(n, None, "aa"), (n + 1, "12 34 !", "bb"), (n + 2, speech(r, "bb", 20_000), None), (None, "ba be bo", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language_of_held_out_texts(spark):
    docs = spoken(spark)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    got = language_id.identify(docs, held_out=held_out).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.lang_pred == r.lang for r in got if r.doc_id < 90) and any(r.held_out for r in got)
    assert all(0 <= r.score <= 1 for r in got)
    rest = {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id >= 90}
    assert rest[90] == rest[91] == ("und", 0.0) and rest[92][0] == "bb"


def test_language_without_labels(spark):
    docs = spoken(spark, 3).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(docs).collect()} == {"und"}
    assert language_id.identify(docs.limit(0)).count() == 0


def greedy_phrases(text, sample):
    """Longest-match phrases of a text by plain search."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        while end < len(text) and text[at : end + 1] in sample:
            end += 1
        count, at = count + 1, end
    return count


def test_phrases_equal_plain_longest_matches():
    r = random.Random(2)
    samples = {k: speech(r, k, 60) for k in LANGUAGES}
    parser = language_id.Parser(samples)
    texts = [speech(r, r.choice(sorted(LANGUAGES)), r.randint(1, 40)) for _ in range(30)] + ["b", "a" * 700]
    counts, _ = parser.phrases(texts)
    for text, row in zip(texts, counts):
        assert row.tolist() == [greedy_phrases(text, samples[k]) for k in parser.languages]


def toxic_table(spark, n=240):
    r = random.Random(4)
    bad, poor = ["vilest", "scumble", "grotling"], ["zzqq", "xxyy"]
    rows, labels = [], []
    for i in range(n):
        words = [f"w{r.randrange(200)}" for _ in range(r.randint(20, 80))]
        toxic, low = i % 4 == 0, i % 5 == 0
        words[r.randrange(len(words))] = r.choice(bad) if toxic else "fine"
        words[0] = r.choice(poor) if low else words[0]
        rows.append((i, " ".join(words)))
        if i < n // 2:
            labels.append((i, int(low), int(toxic), int(toxic and low)))
    return cases.documents(spark, rows), spark.createDataFrame(labels, "doc_id long, poor int, toxic int, both int"), rows


def test_chain_finds_toxic_texts(spark):
    docs, labels, rows = toxic_table(spark)
    chain = ("poor", "toxic", "both")
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels, chain).collect()}
    wrong = [i for i, _ in rows if (got[i].p_toxic > 0.5) != (i % 4 == 0)]
    assert len(wrong) <= 3
    both = [got[i].p_both for i, _ in rows if i % 20 == 0]
    neither = [got[i].p_both for i, _ in rows if i % 4 and i % 5]
    assert sum(both) / len(both) > 3 * sum(neither) / len(neither)
    kept = toxicity.keep_clean(docs, labels, chain)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if got[i].p_toxic <= 0.5}


def test_later_models_see_earlier_probabilities(spark):
    docs, labels, _ = toxic_table(spark)
    models = toxicity.fit_chain(docs, labels, ["poor", "toxic", "both"])
    assert [len(extra) for _, _, extra, _ in models] == [0, 1, 2]


def test_toxicity_of_awkward_rows(spark):
    _, labels, _ = toxic_table(spark)
    docs = cases.documents(spark, cases.AWKWARD)
    got = toxicity.toxicity(docs, labels, ("poor", "toxic")).collect()
    assert len(got) == len(cases.AWKWARD) and all(0 <= r.p_toxic <= 1 for r in got)
    nothing = toxicity.toxicity(docs, labels.limit(0), ("poor", "toxic")).collect()
    assert {r.p_toxic for r in nothing} == {0.5} and toxicity.keep_clean(docs, labels.limit(0), ("toxic",)).count() == len(got)
    assert toxicity.toxicity(docs.limit(0), labels, ("poor", "toxic")).count() == 0


def test_leaks_and_paraphrases(spark):
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    items = [(j, " ".join(word() for _ in range(r.randint(15, 60)))) for j in range(30)]
    clean = [(i, " ".join(word() for _ in range(r.randint(1, 300)))) for i in range(120)]
    rows, planted = list(clean), set()
    for j, text in items:
        words = text.split()
        for kind in range(2):
            changed = [w if kind == 0 or n % 7 else word() for n, w in enumerate(words)]
            doc = 1000 + 2 * j + kind
            rows.append((doc, " ".join([word() for _ in range(r.randint(0, 90))] + changed + [word() for _ in range(70)])))
            planted.add((doc, j))
    docs = cases.documents(spark, rows + [(2000, None), (2001, ""), (None, items[0][1])])
    benchmark = spark.createDataFrame(items + [(99, None), (100, "")], "item_id long, text string")
    found = decontaminate.find_leaks(docs, benchmark).collect()
    got = {(r.doc_id, r.item_id) for r in found if r.doc_id is not None}
    assert len(got & planted) >= 0.95 * len(planted) and got <= planted
    assert [r.item_id for r in found if r.doc_id is None] == [0]
    kept = decontaminate.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert {i for i, _ in clean} <= ids and not ids & {d for d, _ in got}
    assert decontaminate.find_leaks(docs.limit(0), benchmark).count() == 0
    assert decontaminate.find_leaks(docs, benchmark.limit(0)).count() == 0


def test_latent_basis_spans_the_leading_directions(spark):
    rng = np.random.default_rng(1)
    dense = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 40)) + 0.01 * rng.standard_normal((60, 40))
    rows = [(list(range(40)), row.tolist()) for row in dense]
    basis = decontaminate.latent_basis(spark.createDataFrame(rows, "words array<int>, weights array<double>"), 40, rank=5)
    _, _, vt = np.linalg.svd(dense)
    assert np.linalg.norm(vt[:5] @ basis) == pytest.approx(5**0.5, abs=1e-3)


def test_common_subsequence():
    a, b = np.array([1, 2, 3, 4, 5, 3]), np.array([2, 9, 4, 3, 7])
    assert decontaminate.common_subsequence(a, b) == 3


def test_numerals_are_no_letters(spark):
    rows = [(1, "²³ ½ ①", "en"), (2, "abc def", "en"), (3, "₂ x", None), (4, "12 ٣", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in language_id.identify(docs).collect()}
    assert got[1] == got[4] == ("und", 0.0) and got[2][0] == got[3][0] == "en"


def test_one_id_and_one_text_on_most_labelled_rows(spark):
    """Copies and a shared id neither crowd the sample out nor grow it."""
    r = random.Random(7)
    rows = [(None if i % 2 else 5, speech(r, "aa", 30), "aa") for i in range(600)]
    rows += [(5, "the same text for all of these rows", "aa")] * 700
    rows += [(i, speech(r, "bb", 30), "bb") for i in range(20)] + [(9, "lang " * 4000 + "x", "bb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    sample = language_id.teaching_samples(docs, "text", "lang", F.lit(False))
    assert sorted(sample) == ["aa", "bb"] and all(len(text) <= language_id.SAMPLE_CHARS for text in sample.values())
    texts = sample["aa"].split("\n")[1:]
    assert len(texts) <= language_id.SAMPLE_ROWS and len(set(texts)) == len(texts) and {t for _, t, _ in rows} >= set(texts[:-1])
    assert sample["bb"].index("lang lang") > sum(len(t) for _, t, lang in rows if lang == "bb" and len(t) < 1000)
    assert language_id.teaching_samples(docs.repartition(7), "text", "lang", F.lit(False)) == sample
