"""Secrets in texts: base patterns, and credentials whose parts only count together.

Every text is scanned once for strong parts (assignments, access identifiers, long hexadecimal
runs) and weak parts (40-character keys without a name, URLs). Parts are rows. A weak key is
reported as ``secret`` only if an access identifier stands within ``reach`` code points of it in
the same scope, a URL as ``endpoint`` only if a strong part does; so texts without strong parts
need no look at weak ones. Scopes are paragraphs (text between
blank lines). The interval join is done by sorting: per document and scope the nearest
complementary part before and after each weak part decides whether any lies within reach, so a
scope with thousands of parts makes no pairs. Only parts shuffle, never texts.

Defined results: a null or empty text has no parts (the digest of an empty list); equal rows give
equal results; a null id groups with no other row; an empty table gives an empty result; other columns are
not read, whatever their names; of parts equally near either one counts, as only the nearness does; very
long texts are scanned whole.
"""

import bisect
import hashlib
import re

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfline.llm.common import ship

KINDS = ["assign", "access", "hex", "secret", "endpoint"]  # the order of equal starts
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEY = re.compile(r"(?<![A-Za-z0-9+/=])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=])")
ENDPOINT = re.compile(r"https?://[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[A-Za-z0-9._~/-]*)?")
SCOPE_BREAK = re.compile(r"\n[\x20\t]*\n")
NAMES = ("passw", "secret", "token", "api")
REACH = 400

PARTS = "array<struct<kind:int,start:int,end:int,scope:int>>"


def base_spans(text):
    """(kind number, start, end) of the base kinds in the order of start, then kind."""
    spans = []
    lowered = text.lower()
    if any(name in lowered for name in NAMES):
        spans += [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    if "AKIA" in text:
        spans += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda span: (span[1], span[0]))


def weak_spans(text, base):
    """Named-by-nothing keys and URLs, left out where a base span covers their start."""
    spans = [(3, m.start(), m.end()) for m in KEY.finditer(text)]
    if "http" in text:
        spans += [(4, m.start(), m.end()) for m in ENDPOINT.finditer(text)]
    return [s for s in spans if not any(b[1] < s[2] and s[1] < b[2] for b in base)] if base else spans


def as_text(spans):
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for kind, start, end in spans)


def _scan(batches):
    for frame in batches:
        rows = []
        for text in frame["text"]:
            text = text or ""
            base = base_spans(text)
            weak = weak_spans(text, base) if base else []
            scopes = [m.start() for m in SCOPE_BREAK.finditer(text)] if weak else []
            parts = []
            for kind, start, end in base + weak:
                scope = bisect.bisect_left(scopes, start)
                parts.append({"kind": kind, "start": start, "end": end, "scope": scope})
            counts = [sum(1 for s in base if s[0] == k) for k in range(3)]
            digest = hashlib.sha256(as_text(base).encode()).hexdigest()
            rows.append((*counts, digest, parts if weak else None, as_text(base)))
        out = pd.DataFrame(rows, columns=["n_assign", "n_access", "n_hex", "base_sha256", "parts", "base"])
        yield pd.concat([frame[["doc_id", "row_key"]].reset_index(drop=True), out], axis=1)


def scan(docs, id_col="doc_id", text_col="text"):
    """Counts and digest of the base kinds, and all parts of documents that have weak ones."""
    ship(docs.sparkSession)
    slim = docs.select(
        F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.xxhash64(F.col(text_col)).alias("row_key")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return slim.mapInPandas(
        _scan,
        f"doc_id {kind}, row_key long, n_assign long, n_access long, n_hex long, base_sha256 string, "
        f"parts {PARTS}, base string",
    )


def linked_spans(parts, reach=REACH):
    """Of parts (doc_id, row_key, kind, start, end, scope): all base parts and the weak ones with a complement in reach."""
    scope = Window.partitionBy("doc_id", "row_key", "scope").orderBy("start", "kind", "end")
    before = scope.rowsBetween(Window.unboundedPreceding, -1)
    after = scope.rowsBetween(1, Window.unboundedFollowing)
    access = F.col("kind") == 1
    strong = F.col("kind") < 3

    def near(condition):
        last_end = F.max(F.when(condition, F.col("end"))).over(before)
        next_start = F.min(F.when(condition, F.col("start"))).over(after)
        return F.coalesce(F.col("start") - last_end <= reach, F.lit(False)) | F.coalesce(
            next_start - F.col("end") <= reach, F.lit(False)
        )

    reported = F.when(strong, True).when(F.col("kind") == 3, near(access)).otherwise(near(strong))
    return parts.withColumn("__reported", reported).where("__reported").drop("__reported")


def find_secrets(docs, id_col="doc_id", text_col="text", reach=REACH):
    """Per row: counts of base spans, their digest, and ``spans`` with the linked weak parts added."""
    found = scan(docs, id_col, text_col)
    parts = (
        found.where("parts is not null")
        .select("doc_id", "row_key", F.explode(F.array_distinct("parts")).alias("p"))
        .select("doc_id", "row_key", "p.*")
        .distinct()
    )
    name = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("kind") + 1)
    piece = F.concat_ws(":", name, F.col("start").cast("string"), F.col("end").cast("string"))
    linked = (
        linked_spans(parts, reach)
        .groupBy("doc_id", "row_key")
        .agg(F.sort_array(F.collect_list(F.struct("start", "kind", piece.alias("piece")))).alias("all"))
        .select(
            F.col("doc_id").alias("__doc"), F.col("row_key").alias("__key"), F.array_join(F.col("all.piece"), ",").alias("linked")
        )
    )
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & F.col("row_key").eqNullSafe(F.col("__key"))
    return found.join(linked, same, "left").select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.coalesce("linked", "base").alias("spans")
    )
