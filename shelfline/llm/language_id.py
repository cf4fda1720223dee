"""Language of a text by cross-parsing: the language that needs the fewest phrases wins.

Per language a suffix automaton of a bounded sample of labelled text recognises every substring of
it. A text is parsed from left to right into the longest phrases the automaton knows; few long
phrases mean a familiar language. Phrase counts are normalised by length and by the sample's size:
``phrases * log2(sample length) / characters`` estimates the cross entropy in bits per character.

Automata are dense tables over a small alphabet (the characters common in the samples, one class
for white space, one for all others). Texts are cut into blocks of ``BLOCK`` characters, at which
a phrase ends; all blocks of a batch step through all automata together, one character at a time,
so a long text costs no more per character than a short one and whole texts are read.

Defined results: a null text or one without letters (``str.isalpha``; other numerals are none) is ``und``
with score 0; ties go to the first language in alphabetical order; rows without a language or text
teach nothing; without any labelled rows every text is ``und``; equal texts get equal results; an empty
table gives an empty result; rows without an id are like others; ids and other columns, whatever their
names, are never looked at, except that the caller's ``held_out`` rows do not teach.
"""

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.llm.common import byte_batches, ship, stage

SAMPLE_CHARS = 120_000  # of labelled text per language
SAMPLE_ROWS = 200  # different labelled texts per language at most; with SAMPLE_CHARS the bound of what reaches the driver
LONG_CHARS = 4_000  # longer labelled texts teach only where shorter ones do not fill the sample
ALPHABET = 48
BLOCK = 1024
BATCH_CHARS = 4 << 20
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")  # a superset: digits of other kinds are told apart by has_letter


def has_letter(text):
    return any(found.group().isalpha() for found in LETTER.finditer(text))


class Automaton:
    """Suffix automaton of a sequence of symbols as a table: next state, or 0 where none."""

    def __init__(self, symbols, n_symbols):
        limit = 2 * len(symbols) + 2
        step = np.zeros((limit, n_symbols), np.int32)
        length, link = [0, 0], [0, 0]
        rows = [None, {}]  # state 1 is the start
        last = 1
        for symbol in symbols:
            new = len(rows)
            rows.append({})
            length.append(length[last] + 1)
            link.append(1)
            p = last
            while p and symbol not in rows[p]:
                rows[p][symbol] = new
                p = link[p]
            if p:
                q = rows[p][symbol]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    copy = len(rows)
                    rows.append(dict(rows[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p and rows[p].get(symbol) == q:
                        rows[p][symbol] = copy
                        p = link[p]
                    link[q] = link[new] = copy
            last = new
        for state, moves in enumerate(rows):
            for symbol, target in (moves or {}).items():
                step[state, symbol] = target
        self.step = step[: len(rows)]


class Parser:
    """Phrase counts of texts against all languages of a sample {language: text}."""

    def __init__(self, samples):
        self.languages = sorted(samples)
        common = Counter("".join(samples.values()).lower())
        common = Counter({c: n for c, n in common.items() if not c.isspace()})
        letters = sorted(c for c, _ in sorted(common.items(), key=lambda item: (-item[1], item[0]))[: ALPHABET - 2])
        self.code = np.ones(0x110000, np.uint8)  # 0 white space, 1 any other character
        for code in (*range(9, 14), 32, 0x85, 0xA0, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x3000):
            self.code[code] = 0
        for i, letter in enumerate(letters):
            self.code[ord(letter)] = i + 2
        self.n_symbols = len(letters) + 2
        tables, self.bits, self.start, offset = [], [], [], 0
        for language in self.languages:
            symbols = self.encode(samples[language])
            table = Automaton(symbols.tolist(), self.n_symbols).step
            tables.append(np.where(table > 0, table + offset, 0))
            self.start.append(1 + offset)
            self.bits.append(np.log2(max(len(symbols), 2)))
            offset += len(table)
        self.step = np.concatenate(tables).ravel().astype(np.int32) if tables else np.zeros(0, np.int32)

    def encode(self, text):
        return self.code[np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)]

    def phrases(self, texts):
        """Array (texts, languages) of phrase counts and the length of each text in symbols."""
        coded = [self.encode(text) for text in texts]
        sizes = np.array([len(c) for c in coded], np.int64)
        owner = np.repeat(np.arange(len(texts)), -(-sizes // BLOCK))
        if not len(owner):
            return np.zeros((len(texts), len(self.languages))), sizes
        blocks = np.concatenate([[0], np.cumsum(-(-sizes // BLOCK))])
        number = np.arange(len(owner)) - blocks[owner]
        lengths = np.minimum(sizes[owner] - number * BLOCK, BLOCK)
        begins = (np.cumsum(sizes) - sizes)[owner] + number * BLOCK
        order = np.argsort(-lengths, kind="stable")
        lengths, begins, owner = lengths[order], begins[order], owner[order]
        flat = np.concatenate(coded).astype(np.int32)
        start = np.array(self.start, np.int32)[:, None] * self.n_symbols
        state = np.repeat(start, len(owner), axis=1)
        counts = np.ones((len(self.languages), len(owner)), np.int32)
        width = self.n_symbols
        for at in range(int(lengths[0])):
            active = int(np.searchsorted(-lengths, -at, side="left"))
            symbol = flat[begins[:active] + at]
            now = state[:, :active]
            then = self.step[now + symbol]
            broken = then == 0
            if at:
                counts[:, :active] += broken
            fresh = self.step[start + symbol]  # 0, from where nothing leads on, after a symbol unseen there
            state[:, :active] = np.where(broken, fresh, then) * width
        total = np.stack([np.bincount(owner, row, len(texts)) for row in counts], axis=1)
        return total, sizes

    def predict(self, texts):
        """(language, score) of each text; the score is one less the ratio of best to second best."""
        known = [text if text is not None and has_letter(text) else None for text in texts]
        usable = [i for i, text in enumerate(known) if text is not None]
        languages, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if usable and self.languages:
            counts, sizes = self.phrases([known[i] for i in usable])
            entropy = counts * np.array(self.bits) / sizes[:, None]
            best = entropy.argmin(axis=1)
            ranked = np.sort(entropy, axis=1)
            gap = 1 - ranked[:, 0] / ranked[:, 1] if len(self.languages) > 1 else np.ones(len(usable))
            for i, language, score in zip(usable, best, gap):
                languages[i], scores[i] = self.languages[language], min(max(float(score), 0.0), 1.0)
        return languages, scores


def teaching_samples(docs, text_col, lang_col, held_out):
    """{language: text} of at most SAMPLE_ROWS different texts and SAMPLE_CHARS characters per language.

    Texts are chosen by a hash of language and text, the lowest first, texts of over LONG_CHARS after all
    others; they are taken whole until the sample is full. Copies of a text count once, whatever their
    number and ids. The choice is made on hashes alone, with a partial top list in each task; only the
    chosen texts are fetched, so SAMPLE_ROWS rows per language reach the driver at most.
    """
    text = F.col(text_col)
    rows = docs.where(F.col(lang_col).isNotNull() & text.isNotNull() & ~held_out).select(
        F.col(lang_col).cast("string").alias("lang"),
        (F.length(text) > LONG_CHARS).alias("long"),
        F.xxhash64(F.col(lang_col).cast("string"), text, F.lit("teach")).alias("order"),
        F.substring(text, 1, SAMPLE_CHARS).alias("text"),
    )
    keys = ["lang", "long", "order"]
    place = F.row_number().over(Window.partitionBy("lang").orderBy("long", "order"))
    chosen = rows.select(*keys).distinct().withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS).drop("place")
    fetched = rows.join(F.broadcast(stage(chosen, "teaching-rows")), keys).groupBy(*keys).agg(F.min("text").alias("text"))
    samples = {}
    for row in sorted(fetched.collect(), key=lambda r: (r["lang"], r["long"], r["order"])):
        before = samples.get(row["lang"], "")
        if len(before) < SAMPLE_CHARS:
            samples[row["lang"]] = (before + "\n" + row["text"])[:SAMPLE_CHARS]
    return samples


_PARSERS = {}


def parser(samples):
    key = tuple(sorted(samples.items()))
    if key not in _PARSERS:
        _PARSERS.clear()
        _PARSERS[key] = Parser(samples)
    return _PARSERS[key]


def identify(docs, id_col="doc_id", text_col="text", lang_col="lang", held_out=None):
    """Per row: doc_id, held_out, lang_pred, score. ``held_out`` marks rows that do not teach."""
    spark = docs.sparkSession
    ship(spark)
    held_out = F.lit(False) if held_out is None else held_out
    shared = spark.sparkContext.broadcast(teaching_samples(docs, text_col, lang_col, held_out))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        model = parser(shared.value)
        for frame in byte_batches(batches, "text", BATCH_CHARS):
            languages, scores = model.predict(list(frame["text"]))
            yield pd.DataFrame(
                {"doc_id": frame["doc_id"], "held_out": frame["held_out"], "lang_pred": languages, "score": scores}
            )

    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text")
    )
    return slim.mapInPandas(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")
