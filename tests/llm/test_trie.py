import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from shelfline.llm import conversation_trie as T
from shelfline.llm import sequences

SCHEMA = "conv_id long, turn long, role string, text string, depth string, x string, node string, `a.b` string"


def table(spark, rows):
    return spark.createDataFrame([(*row, "d", None, "n", "q") for row in rows], SCHEMA).repartition(3)


def expected(rows):
    """The trie by dictionaries over whole rebuilt conversations."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    for turns in own.values():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, hashlib.md5(f"{len(t[1])}:{t[1]}:{t[2]}".encode()).hexdigest()))
    paths = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        head = own.get(conv - int(math.fmod(conv, 100)), [])[:h]
        paths[conv] = tuple((role, text) for _, role, text in head + own[conv][h:])
    members = defaultdict(list)
    for conv, path in paths.items():
        for depth in range(len(path) + 1):
            members[path[:depth]].append(conv)
    children = Counter(node[:-1] for node in members if node)
    leaves, saved = Counter(), Counter()
    for node, held in members.items():
        for depth in range(len(node) + 1):
            leaves[node[:depth]] += not children[node]
            saved[node[:depth]] += (len(held) - 1) * len(node[-1][1]) if node else 0
    found = Counter()
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if paths[c] == node)
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        found[(min(held), len(node), parent, len(held), children[node], leaves[node], saved[node], digest)] += 1
    return found


def got(spark, rows):
    return T.prefix_trie(*T.shared_heads(T.turns_of(table(spark, rows))))


def dialogues(seed, n=150):
    r = random.Random(seed)
    rows = []
    for conv in r.sample(range(3 * n), n):
        for turn in range(r.randint(1, 9)):
            rows.append((conv, turn, ["user", "assistant"][turn % 2], r.choice(["yes", "no", "é漢😀", "a longer turn"])))
    return rows


AWKWARD = [
    (0, None, None, None),
    (0, 1, "user", ""),
    (0, 1, "user", ""),
    (0, 2, "user", "x" * 100_000),
    (7, 3, None, "one"),
    (7, 3, "", "one"),
    (107, 1, "user", "no conversation 100"),
    (108, 1, "user", "none either"),
    (None, 1, "user", "of no conversation"),
    (-5, 0, "user", "negative"),
    *[(i, 0, "user", "same first turn") for i in range(200, 260)],
]


@pytest.mark.parametrize("rows", [AWKWARD, dialogues(1), dialogues(2, 60), []])
def test_trie_equals_dictionaries(spark, rows, monkeypatch):
    monkeypatch.setattr(T.list_rank, "__defaults__", (T.BASE if len(rows) > 500 else 100,))
    assert Counter(map(tuple, got(spark, rows).collect())) == expected(rows)


def test_one_conversation_of_many_turns(spark):
    rows = [(300, i, "user", f"turn {i % 7}") for i in range(3000)] + [(301, 0, "user", "other")]
    found = got(spark, rows).orderBy(F.desc("depth")).collect()
    deepest = found[0]
    assert (deepest.depth, deepest.n_convs, deepest.n_leaves) == (3000, 1, 1)
    assert sorted({row.depth for row in found}) == list(range(3001))


def test_list_rank_follows_the_links(spark):
    r = random.Random(5)
    order = r.sample(range(10_000), 500)
    rows = [(a, order[i - 1] if i else None, order[i + 1] if i < 499 else None, 1) for i, a in enumerate(order)]
    links = spark.createDataFrame(rows, "arc long, prev long, next long, gap long")
    places = {row.arc: row.place for row in T.list_rank(links, base=20).collect()}
    assert [places[a] for a in order] == list(range(500))


@pytest.mark.parametrize("how", ["sum", "xor"])
def test_running_totals_and_neighbours(spark, how):
    r = random.Random(3)
    rows = [(r.choice([1, 1, 1, 2, 3, None]), i, r.randint(0, 1000)) for i in range(700)]
    df = spark.createDataFrame(rows, "k long, i long, v long").repartition(5)
    placed = sequences.in_order(df, ["k", "i"])
    found = sequences.running(placed, {"t": F.col("v")}, ["k"], how).collect()
    totals, want = {}, {}
    for k, i, v in sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1])):
        totals[k] = totals.get(k, 0) + v if how == "sum" else totals.get(k, 0) ^ v
        want[i] = totals[k]
    assert {row.i: row.t for row in found} == want
    beside = sequences.neighbours(placed, ["i"]).orderBy(sequences.PLACE).collect()
    order = [row.i for row in beside]
    assert [row.after and row.after.i for row in beside] == [*order[1:], None]
    assert [row.before and row.before.i for row in beside] == [None, *order[:-1]]
