import hashlib
import os
import re

import numpy as np

import corpus_pipeline
from shelfline.llm import bpe
from shelfline.llm.common import table
from test_near import components, fold


def plain(text):
    return " ".join(re.findall(r"[^\s!-/:-@\[-`{-~]+", (text or "").lower()))


def test_stages_equal_brute_force(spark, sf_dir):
    from tokenizers import Tokenizer

    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact dedup", "near dedup", "decontamination", "bpe"]
    library = Tokenizer.from_file(bpe.tokenizer_path())
    docs = table(spark, sf_dir, "documents")
    columns, texts, seen = docs.columns, dict(docs.select("doc_id", "text").collect()), []
    for number, (_, step) in enumerate(corpus_pipeline.STAGES):
        path = os.path.join(spark.conf.get("spark.checkpoint.dir"), f"stage-{number}")
        step(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        if number < 4:
            assert docs.columns == columns
        seen.append({row["doc_id"] for row in docs.select("doc_id").collect()})
    toxic = {r.doc_id for r in table(spark, sf_dir, "labels").where("toxic = 1").collect()}
    clean = {r.doc_id for r in table(spark, sf_dir, "labels").where("toxic = 0").collect()}
    toxic, clean = toxic & set(texts), clean & set(texts)  # few labels here: the chain knows some words only
    assert len(clean & seen[0]) >= 0.95 * len(clean), (len(clean), len(clean - seen[0]))
    assert len(toxic - seen[0]) >= 0.5 * len(toxic), (len(toxic), len(toxic - seen[0]))
    last = {}
    for i in sorted(seen[0]):
        last[fold(texts[i])] = i
    assert seen[1] == set(last.values())
    first = {i for i, _, component in components([(i, texts[i]) for i in sorted(seen[1])]) if i == component}
    assert seen[2] == first
    items = [plain(r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    leaked = {i for i in seen[2] if any(item in plain(texts[i]) for item in items)}
    assert leaked and seen[3] == seen[2] - leaked
    for row in docs.collect():
        ids = library.encode(texts[row.doc_id] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert seen[4] == seen[3]
