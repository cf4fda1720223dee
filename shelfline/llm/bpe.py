"""Byte-pair encoding in batched numpy merge rounds, and decoding by one gather.

Words of a batch are found on an array of code points, reduced to distinct ones, and kept in one
flat array of symbols. In a round every adjacent pair inside a word is looked up by binary search
among the sorted pair keys, and each unfinished word merges its pair of lowest rank: all its
occurrences from the left if no merge of the product has a lower rank, else the leftmost alone;
so the order is that of the priority queue of the usual encoder. Finished words leave the array.

Texts with characters past the Latin blocks, or with the text of a special token, are cut into
words by the tokenizer file's own normaliser and splitter; everything after that is the same.

Defined results: a null or empty text has no tokens and decodes to ""; equal texts give equal ids;
ids below zero or past the vocabulary are an error in ``decode_batch``; very long texts and words
are encoded whole; an empty table gives an empty result; other columns are not read, whatever their names.
"""

import hashlib
import json
import os
import re

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from shelfline.llm.common import _MULTIPLIER, _powers, byte_batches, mix, ship

CACHED_WORDS = 1 << 21  # distinct words a worker remembers before it starts anew
BATCH_CHARS = 2 << 20
LAST_FAST = 0x24F
_NONE, _LETTER, _DIGIT, _OTHER = 0, 1, 2, 3


def _byte_names():
    """The printable stand-ins of all bytes in byte-level vocabularies, by their published rule."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    names, spare = {}, 256
    for byte in range(256):
        names[byte] = chr(byte) if byte in shown else chr(spare)
        spare += byte not in shown
    return names


def _classes():
    import regex

    table = np.full(LAST_FAST + 1, _OTHER, np.uint8)
    for code in range(LAST_FAST + 1):
        if regex.match(r"\s", chr(code)) or chr(code) in "\t\n\v\f\r \x85\xa0":
            table[code] = _NONE
        elif regex.match(r"\p{L}", chr(code)):
            table[code] = _LETTER
        elif regex.match(r"\p{N}", chr(code)):
            table[code] = _DIGIT
    return table


class Encoder:
    """Encodes and decodes as the tokenizer file says, without adding special tokens."""

    def __init__(self, path):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as source:
            spec = json.load(source)
        vocab = spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"]
        self.special = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.special_split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.special_test = re.compile("|".join(map(re.escape, self.special)))
        self.tokenizer = Tokenizer.from_file(path)
        names = _byte_names()
        self.byte_of = {name: byte for byte, name in names.items()}
        self.inner = np.array([vocab[names[b]] for b in range(256)], np.int64)
        self.final = np.array([vocab[names[b] + suffix] for b in range(256)], np.int64)
        self.size = max([*vocab.values(), *self.special.values()]) + 1
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        left = np.array([vocab[a] for a, _ in merges], np.int64)
        right = np.array([vocab[b] for _, b in merges], np.int64)
        product = np.array([vocab[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges))
        order = np.argsort(left * self.size + right, kind="stable")
        self.keys = (left * self.size + right)[order].astype(np.uint32 if self.size < 1 << 16 else np.int64)
        self.ranks = rank[order]
        self.product = product
        lowest = np.full(self.size, len(merges))
        np.minimum.at(lowest, left, rank)
        np.minimum.at(lowest, right, rank)
        self.safe = lowest[product] > rank
        self.never = len(merges)
        tokens = [""] * self.size
        for token, i in [*vocab.items(), *self.special.items()]:
            tokens[i] = token
        spaced = [(token + " ").encode() for token in tokens]
        self.token_bytes = np.frombuffer(b"".join(spaced), np.uint8)
        self.token_length = np.array([len(t) for t in spaced])
        self.token_start = np.cumsum(self.token_length) - self.token_length
        self.classes = _classes()
        self._forget()

    def _forget(self):
        self.known = np.empty(0, np.uint64)  # sorted hashes of words
        self.known_at = np.empty(0, np.int64)
        self.known_n = np.empty(0, np.int64)
        self.known_ids = np.empty(0, np.int32)

    def _ranks(self, left, right):
        """Ranks of pairs of symbols, ``never`` for those that do not merge."""
        pairs = (left * self.size + right).astype(self.keys.dtype)
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], self.never)

    def encode_words(self, words):
        """Ids of distinct words given as bytes: (flat ids, ids per word)."""
        counts = np.array([len(w) for w in words], np.int64)
        raw = np.frombuffer(b"".join(words), np.uint8)
        symbols = self.inner[raw]
        ends = np.cumsum(counts) - 1
        symbols[ends] = self.final[raw[ends]]
        word = np.repeat(np.arange(len(words)), counts)
        ranks = np.full(len(symbols), self.never)  # of the pair that begins at each symbol
        inside = np.flatnonzero(word[:-1] == word[1:])
        ranks[inside] = self._ranks(symbols[inside], symbols[inside + 1])
        done_symbols, done_words = [], []
        while len(symbols):
            first = np.flatnonzero(np.concatenate([[True], word[:-1] != word[1:]]))
            best = np.repeat(np.minimum.reduceat(ranks, first), np.diff(np.append(first, len(symbols))))
            active = best < self.never
            if not active.all():
                done_symbols.append(symbols[~active])
                done_words.append(word[~active])
                symbols, word, ranks, best = symbols[active], word[active], ranks[active], best[active]
                if not len(symbols):
                    break
            chosen = np.flatnonzero(ranks == best)
            run = np.flatnonzero(np.concatenate([[True], np.diff(chosen) > 1]))
            place = np.arange(len(chosen)) - np.repeat(run, np.diff(np.append(run, len(chosen))))
            leftmost = np.concatenate([[True], np.diff(word[chosen]) > 0])
            chosen = chosen[np.where(self.safe[best[chosen]], place % 2 == 0, leftmost)]
            symbols[chosen] = self.product[best[chosen]]
            stay = np.ones(len(symbols), bool)
            stay[chosen + 1] = False
            symbols, word, ranks = symbols[stay], word[stay], ranks[stay]
            merged = chosen - np.arange(len(chosen))
            ranks[merged] = self.never
            padded = np.append(word, -1)
            for at in (merged[padded[merged + 1] == word[merged]], merged[merged > 0] - 1):
                at = at[padded[at + 1] == word[at]]
                ranks[at] = self._ranks(symbols[at], symbols[at + 1])
        flat = np.concatenate(done_symbols) if done_symbols else np.empty(0, np.int64)
        owner = np.concatenate(done_words) if done_words else np.empty(0, np.int64)
        order = np.argsort(owner, kind="stable")
        return flat[order].astype(np.int32), np.bincount(owner, minlength=len(words))

    def _fast_tokens(self, joined):
        """(starts, stops) of the words of a lower-cased text with Latin characters only, or None."""
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        if len(codes) and codes.max() > LAST_FAST:
            return None
        kinds = self.classes[codes]
        change = np.concatenate([[True], kinds[1:] != kinds[:-1]]) if len(kinds) else np.empty(0, bool)
        begin = (change | (kinds == _DIGIT)) & (kinds != _NONE)
        quotes = np.flatnonzero((codes == 39) & begin)
        if len(quotes):
            padded = np.concatenate([codes, [0, 0, 0]])
            next1, next2 = padded[quotes + 1], padded[quotes + 2]
            one = np.isin(next1, [ord(c) for c in "stmd"])
            two = np.zeros(len(quotes), bool)
            for a, b in ("re", "ve", "ll"):
                two |= (next1 == ord(a)) & (next2 == ord(b))
            begin = np.append(begin, [False, False, False])
            kinds_after = np.append(kinds, [_NONE, _NONE, _NONE])
            for hit, size in ((quotes[one], 2), (quotes[two & ~one], 3)):
                begin[hit + 1] = False
                begin[hit + size] = kinds_after[hit + size] != _NONE
            begin = begin[: len(kinds)]
        starts = np.flatnonzero(begin)
        stop = np.append(starts[1:], len(kinds))
        space = np.flatnonzero(kinds == _NONE)
        if len(space) and len(starts):
            at = np.searchsorted(space, starts)
            stop = np.minimum(stop, np.append(space, len(kinds))[at])
        return codes, starts, stop

    def _slow_words(self, text):
        """Word bytes (or the id of a special token) by the file's own normaliser and splitter."""
        words = []
        for part in self.special_split.split(text):
            if part in self.special:
                words.append(self.special[part])
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
                words += [bytes(self.byte_of[c] for c in piece) for piece, _ in pieces]
        return words

    def _encode_slow(self, text):
        words = self._slow_words(text)
        distinct = list(dict.fromkeys(w for w in words if isinstance(w, bytes)))
        flat, counts = self.encode_words(distinct)
        cut = np.split(flat, np.cumsum(counts)[:-1]) if distinct else []
        ids = dict(zip(distinct, cut))
        parts = [ids[w] if isinstance(w, bytes) else np.array([w], np.int32) for w in words]
        return np.concatenate(parts) if parts else np.empty(0, np.int32)

    def _learn(self, hashes, words):
        flat, counts = self.encode_words(words)
        begins = len(self.known_ids) + np.cumsum(counts) - counts
        at = np.searchsorted(self.known, hashes)
        self.known_at = np.insert(self.known_at, at, begins)
        self.known_n = np.insert(self.known_n, at, counts)
        self.known_ids = np.concatenate([self.known_ids, flat])
        self.known = np.insert(self.known, at, hashes)

    def _encode_fast(self, lowered):
        """(flat ids, ids per text) of lower-cased Latin texts."""
        joined = "\n".join(lowered) + "\n"
        codes, starts, stops = self._fast_tokens(joined)
        ends = np.cumsum([len(t) + 1 for t in lowered])
        if not len(starts):
            return np.empty(0, np.int32), np.zeros(len(lowered), np.int64)
        lengths = stops - starts
        first = np.cumsum(lengths) - lengths
        place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        letters = codes[place + np.repeat(starts, lengths)].astype(np.uint64)
        values = mix((letters + np.uint64(1)) * _MULTIPLIER) * _powers(int(lengths.max()))[place]
        hashes = mix(np.add.reduceat(values, first) + lengths.astype(np.uint64))
        distinct, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        if len(self.known):
            new = self.known[np.minimum(at, len(self.known) - 1)] != distinct
        if new.any():
            if len(self.known) + int(new.sum()) > CACHED_WORDS:
                self._forget()
                new[:] = True
            spots = where[new]
            words = [joined[a:b].encode("utf-8") for a, b in zip(starts[spots].tolist(), stops[spots].tolist())]
            self._learn(distinct[new], words)
            at = np.searchsorted(self.known, distinct)
        token_at, token_n = self.known_at[at][inverse], self.known_n[at][inverse]
        total = np.cumsum(token_n)
        take = np.arange(int(total[-1])) + np.repeat(token_at - (total - token_n), token_n)
        words_before = np.searchsorted(starts, ends)
        tokens_before = np.concatenate([[0], total])[words_before]
        return self.known_ids[take], np.diff(np.concatenate([[0], tokens_before]))

    def encode_batch(self, texts):
        """(flat ids int32, ids per text) of texts; None counts as empty."""
        texts = ["" if text is None else text for text in texts]
        lowered = [text.lower() for text in texts]
        slow = np.array([self.special_test.search(t) is not None or not _latin(low) for t, low in zip(texts, lowered)], bool)
        flat, counts = self._encode_fast([low for low, s in zip(lowered, slow) if not s])
        if not slow.any():
            return flat, counts
        quick = iter(np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else [])
        parts = [self._encode_slow(text) if s else next(quick) for text, s in zip(texts, slow)]
        return np.concatenate(parts).astype(np.int32), np.array([len(p) for p in parts], np.int64)

    def decode_batch(self, flat, counts):
        """Texts of ids: the tokens of each text joined by blanks, as decoding without a decoder does."""
        flat = np.asarray(flat, np.int64)
        if len(flat) and (flat.min() < 0 or flat.max() >= self.size):
            raise ValueError("an id outside the vocabulary")
        lengths = self.token_length[flat]
        total = np.cumsum(lengths)
        size = int(total[-1]) if len(total) else 0
        take = np.arange(size) + np.repeat(self.token_start[flat] - (total - lengths), lengths)
        joined = self.token_bytes[take].tobytes()
        ends = np.concatenate([[0], total])[np.cumsum(counts)]
        begins = np.concatenate([[0], ends[:-1]])
        return [joined[a : max(a, b - 1)].decode("utf-8") for a, b in zip(begins.tolist(), ends.tolist())]


_FAR = re.compile(f"[^\x00-{chr(LAST_FAST)}]")


def _latin(text):
    try:
        text.encode("latin-1")
        return True
    except UnicodeEncodeError:
        return _FAR.search(text) is None


_ENCODERS = {}


def encoder(path):
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def tokenizer_path(name="word_bpe_49k.json"):
    """Place of a public tokenizer file; every machine has the files installed."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def encode_frames(batches, path, column="text"):
    """Pandas batches with the ids of ``column``: yields (batch, flat ids, ids per row)."""
    coder = encoder(path)
    for frame in byte_batches(batches, column, BATCH_CHARS):
        flat, counts = coder.encode_batch(frame[column])
        yield frame, flat, counts


def encode(docs, path, id_col="doc_id", text_col="text"):
    """Rows (doc_id, ids array<int>) of every row."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for frame, flat, counts in encode_frames(batches, path):
            ids = np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": ids})

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInPandas(run, f"doc_id {kind}, ids array<int>")


def decode(encoded, path):
    """Rows (doc_id, text) of rows (doc_id, ids array<int>); null ids decode to an empty text."""
    ship(encoded.sparkSession)
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        coder = encoder(path)
        for frame in batches:
            ids = [np.empty(0, np.int64) if x is None else np.asarray(x, np.int64) for x in frame["ids"]]
            flat = np.concatenate(ids) if ids else np.empty(0, np.int64)
            yield pd.DataFrame({"doc_id": frame["doc_id"], "text": coder.decode_batch(flat, [len(x) for x in ids])})

    return encoded.mapInPandas(run, f"doc_id {kind}, text string")


def round_trip(docs, path, id_col="doc_id", text_col="text"):
    """Per row: n_tokens, SHA-256 of the ids as little-endian 32-bit integers and of the decoded text."""
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        coder = encoder(path)
        for frame, flat, counts in encode_frames(batches, path):
            raw = flat.astype("<u4").tobytes()
            ends = np.cumsum(counts).tolist()
            texts = coder.decode_batch(flat, counts)
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"],
                    "n_tokens": counts.astype(np.int64),
                    "ids_sha256": [hashlib.sha256(raw[4 * (e - n) : 4 * e]).hexdigest() for e, n in zip(ends, counts.tolist())],
                    "decoded_sha256": [hashlib.sha256(text.encode()).hexdigest() for text in texts],
                }
            )

    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInPandas(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
