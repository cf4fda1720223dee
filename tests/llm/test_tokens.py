import hashlib
import os
import random
import zlib

import numpy as np
import pytest

import cases
from shelfline.llm import bpe, token_files

ODD = [
    "", None, " ", "don't 's''s 'll'LLama 're've'd'mm !'s x's't", "a <|endoftext|> b<|startoftext|>",
    "İstanbul ΑΣ ΣΑΣ ﬁ é x café", "日本語 テスト 😀😀 x", "aaaaaaaaaaaaaaaa abababababab", "\x1c\x1f\x85\xa0 ²³½ ٣ ¼x",
    "x" * 5000, "abc" * 3000, "Ǆ ǅ ŉ K Å", "'", "''", "'s", "12345 3.14", "it'S", "tab\tnl\nq\rw", "ÀÉ ß ẞ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


def little_endian(ids):
    return np.array(ids, "<u4").tobytes()


def test_ids_and_texts_equal_the_library(library):
    r = random.Random(5)
    texts = ODD + ["".join(r.choice("abcdeinthor'  .!?sÉñ12#<|>") for _ in range(200)) for _ in range(300)]
    coder = bpe.Encoder(bpe.tokenizer_path())
    for _ in range(2):  # the second time from the cache
        flat, counts = coder.encode_batch(texts)
        decoded = coder.decode_batch(flat, counts)
        for text, ids, back in zip(texts, np.split(flat, np.cumsum(counts)[:-1]), decoded):
            wanted = library.encode(text or "", add_special_tokens=False).ids
            assert ids.tolist() == wanted, text
            assert back == library.decode(wanted, skip_special_tokens=False), text


def test_a_full_cache_starts_anew(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 50)
    coder = bpe.Encoder(bpe.tokenizer_path())
    for text in [t for _, t in cases.corpus(4, 20)] + ODD:
        flat, _ = coder.encode_batch([text])
        assert flat.tolist() == library.encode(text or "", add_special_tokens=False).ids


def test_unknown_ids_are_an_error():
    with pytest.raises(ValueError):
        bpe.Encoder(bpe.tokenizer_path()).decode_batch([10**6], [1])


@pytest.mark.parametrize("rows", [cases.AWKWARD, []])
def test_round_trip(spark, library, rows):
    got = bpe.round_trip(cases.documents(spark, rows), bpe.tokenizer_path())
    expected = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        expected.append((i, len(ids), hashlib.sha256(little_endian(ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, expected))


def test_encoding_and_decoding_as_tables(spark, library):
    docs = cases.documents(spark, cases.AWKWARD)
    encoded = bpe.encode(docs, bpe.tokenizer_path())
    back = {r.doc_id: r.text for r in bpe.decode(encoded, bpe.tokenizer_path()).collect()}
    for i, t in cases.AWKWARD[:5]:
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert back[i] == library.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("rows", [cases.AWKWARD, []])
def test_files_hold_all_documents_in_order(spark, library, rows, monkeypatch):
    manifest = token_files.write_token_files(cases.documents(spark, rows), bpe.tokenizer_path(), end_id=2)
    got = sorted(map(tuple, token_files.read_token_files(manifest).collect()), key=lambda row: row[1])
    start, expected = 0, []
    for i, t in sorted(rows, key=lambda row: (row[0] is not None, row[0], row[1] is not None, row[1])):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 2]
        expected.append((i, start, len(ids), zlib.crc32(little_endian(ids))))
        start += len(ids)
    assert got == expected


def test_a_reader_takes_only_the_frames_it_needs(tmp_path):
    path = str(tmp_path / "part.zst")
    writer = token_files.FileWriter(path)
    for i in range(10):
        writer.add(i, np.arange(i, 40_000 + i))
    assert writer.close()[:3] == (10, 400_000, 5)
    reader = token_files.FileReader(path)
    seen = []
    original = reader.frame
    reader.frame = lambda number: seen.append(number) or original(number)
    found = {int(reader.docs[p]): ids for inside, parts in reader.by_frame(np.array([3])) for p, ids in zip(inside, parts)}
    assert found[3].tolist() == list(range(3, 40_003)) and seen == [1]
    with open(path, "r+b") as target:
        target.seek(int(reader.places[1]) + 50)
        target.write(b"\x00\x01\x02\x03")
    with pytest.raises(Exception):
        token_files.read_documents(path, [3])
    assert token_files.read_documents(path, [0])[0].tolist() == list(range(40_000))
    assert os.path.getsize(path)
