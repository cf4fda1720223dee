"""Prefix trie of conversations, with subtree totals by the Euler-tour technique.

A node is a distinct sequence of first turns (role, text) of some conversations, its members; the root
is the empty sequence. Shared prefixes are what a cache of computed prefixes saves.

1. Turns are numbered in order per conversation over a range-partitioned table (``sequences``), so a
   conversation of any length spreads over tasks. A sequence is known by the running XOR of 120-bit
   digests of (number, role, text); a node is a group of equal ones, counted with map-side aggregates.
2. Nodes sorted by parent give each node its first child and its siblings. Every node has an enter and
   an exit arc; the arc after each one is known from these, which links all arcs in one tour.
3. List ranking: in rounds, every arc whose hash is below those of both neighbours leaves the list (a
   third of them, no two adjacent) and its neighbours are linked over it. When at most ``BASE`` arcs
   are left one task numbers them; then the rounds are undone, last first, each arc's place being its
   former neighbour's plus their distance.
4. Arcs sorted by place carry running totals; a subtree's total is the one at the exit arc less the one
   before the enter arc.
5. The members that end at a node are joined in chunks of at most ``CHUNK`` ids; a digest is one pass
   over a node's chunks in order, held one at a time.

Defined results: a null role or text is empty; turns of no conversation (null id) are left out; null
turn numbers come first; turns of equal number are ordered by a digest of role and text, repeated rows
are turns each; an empty table has no node, not even a root; other columns are not read, whatever their
names; texts of any length are digested whole where they are read.
"""

import hashlib

import pandas as pd
from pyspark.sql import functions as F

from shelfline.llm.common import ship, stage
from shelfline.llm.sequences import PART, PLACE, in_order, neighbours, running

BASE = 1 << 14
CHUNK = 4096
KEY = ["depth", "x", "y"]


def turns_of(conversations, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """Rows (conv_id, turn, digest, size) of all turns of a conversation, in place of their texts."""
    role, text = (F.coalesce(F.col(name), F.lit("")) for name in (role_col, text_col))
    digest = F.md5(F.concat_ws(":", F.length(role).cast("string"), role, text))
    rows = conversations.where(F.col(conv_col).isNotNull())
    return rows.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"), F.length(text).cast("long").alias("size"))


def numbered(turns, order):
    """``turns`` in order within their conversations, with their number ``depth`` from 1."""
    return running(in_order(turns, ["conv_id", *order]), {"depth": F.lit(1)}, ["conv_id"])


def _half(hexadecimal, begin):
    return F.conv(F.substring(hexadecimal, begin, 15), 16, 10).cast("long")


def steps_of(rows):
    """Staged rows (conv_id, depth, x, y, px, py, size, last) of numbered turns: one per node and member."""
    mark = F.md5(F.concat_ws(":", F.col("depth").cast("string"), "digest"))
    known = running(rows.withColumn("mark", mark).drop("digest"), {"x": _half("mark", 1), "y": _half("mark", 17)}, ["conv_id"], "xor")
    placed = known.withColumns({"px": F.col("x").bitwiseXOR(_half("mark", 1)), "py": F.col("y").bitwiseXOR(_half("mark", 17))})
    ended = neighbours(placed.drop("mark"), ["conv_id"])
    last = ~F.col("after.conv_id").eqNullSafe(F.col("conv_id"))
    return stage(ended.select("conv_id", *KEY, "px", "py", "size", last.alias("last")), "trie-steps")


def trie_nodes(steps, members):
    """Rows (depth, x, y, px, py, conv_id, n_convs, own) of all nodes; ``own`` is what the node alone saves."""
    found = steps.groupBy(*KEY, "px", "py").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.min("size").alias("size"))
    root = members.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    nowhere = F.lit(None).cast("long")
    root = root.select(F.lit(0).cast("long").alias("depth"), *[F.lit(0).cast("long").alias(c) for c in "xy"], nowhere.alias("px"), nowhere.alias("py"), "conv_id", "n_convs", F.lit(0).cast("long").alias("size"))
    return found.unionByName(root).withColumn("own", (F.col("n_convs") - 1) * F.col("size")).drop("size")


def family(nodes):
    """Staged nodes in sibling order with ``node``, parent, siblings, first and last child, n_children.

    The children of one parent may fill many parts; each part looks its parent up once.
    """
    placed = in_order(nodes, ["depth", "px", "py", "conv_id", "x", "y"])
    beside = neighbours(placed, ["depth", "px", "py", PLACE])

    def sibling(side):
        same = F.lit(True)
        for name in ("depth", "px", "py"):
            same &= F.col(f"{side}.{name}").eqNullSafe(F.col(name))
        return F.when(same, F.col(f"{side}.{PLACE}"))

    beside = beside.select("*", sibling("before").alias("older"), sibling("after").alias("younger")).drop("before", "after")
    wanted = placed.select(PART, "depth", "px", "py").distinct()
    parents = placed.select((F.col("depth") + 1).alias("depth"), F.col("x").alias("px"), F.col("y").alias("py"), F.col(PLACE).alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = wanted.join(parents, ["depth", "px", "py"])
    linked = beside.join(known, [PART, "depth", "px", "py"], "left").drop(PART).withColumnRenamed(PLACE, "node")
    linked = stage(linked, "trie-siblings")
    children = linked.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(
        F.min("node").alias("first"), F.max("node").alias("final"), F.count("*").alias("n_children")
    )
    tree = linked.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0).cast("long")))
    return stage(tree, "trie-family")


def tour(tree):
    """Rows (arc, prev, next, gap): arc 2 n enters node n, arc 2 n + 1 leaves it; ``gap`` is the way from prev."""
    enter, leave = (lambda name: 2 * F.col(name)), (lambda name: 2 * F.col(name) + 1)
    into = F.struct(
        enter("node").alias("arc"),
        F.coalesce(leave("older"), enter("parent")).alias("prev"),
        F.coalesce(enter("first"), leave("node")).alias("next"),
    )
    out = F.struct(
        leave("node").alias("arc"),
        F.coalesce(leave("final"), enter("node")).alias("prev"),
        F.coalesce(enter("younger"), leave("parent")).alias("next"),
    )
    return tree.select(F.inline(F.array(into, out))).withColumn("gap", F.lit(1).cast("long"))


def list_rank(links, base=BASE):
    """Rows (arc, place) of the doubly linked list ``links`` (arc, prev, next, gap); staged."""
    ship(links.sparkSession)
    now, rounds = stage(links, "list"), []
    while now.count() > base:
        def draw(name, turn=len(rounds)):
            return F.xxhash64(name, F.lit(turn))

        goes = F.coalesce((draw("arc") < draw("prev")) & (draw("arc") < draw("next")), F.lit(False)) & F.col("prev").isNotNull() & F.col("next").isNotNull()
        removed = now.where(goes)
        rounds.append(removed.select("arc", "prev", "gap"))
        none = F.lit(None).cast("long")
        stays = now.where(~goes).select("*", none.alias("new_prev"), none.alias("more"), none.alias("new_next"))
        ahead = removed.select(F.col("next").alias("arc"), none.alias("prev"), none.alias("next"), none.alias("gap"), F.col("prev").alias("new_prev"), F.col("gap").alias("more"), none.alias("new_next"))
        behind = removed.select(F.col("prev").alias("arc"), none.alias("prev"), none.alias("next"), none.alias("gap"), none.alias("new_prev"), none.alias("more"), F.col("next").alias("new_next"))
        met = stays.unionByName(ahead).unionByName(behind).groupBy("arc").agg(*[F.max(c).alias(c) for c in ("prev", "next", "gap", "new_prev", "more", "new_next")])
        now = stage(
            met.select("arc", F.coalesce("new_prev", "prev").alias("prev"), F.coalesce("new_next", "next").alias("next"), (F.col("gap") + F.coalesce("more", F.lit(0))).alias("gap")),
            "list",
        )

    def walk(frame):
        after = dict(zip(frame["prev"], zip(frame["arc"], frame["gap"])))
        arcs, places, arc, place = [], [], -1, -1
        while arc in after:
            arc, gap = after[arc]
            place += gap
            arcs.append(arc)
            places.append(place)
        return pd.DataFrame({"arc": arcs, "place": places})

    few = now.select("arc", F.coalesce("prev", F.lit(-1)).alias("prev"), "gap", F.lit(0).alias("one"))
    ranked = stage(few.groupBy("one").applyInPandas(walk, "arc long, place long"), "places")
    for removed in reversed(rounds):
        known = ranked.withColumnsRenamed({"arc": "prev"})
        again = stage(removed.join(known, "prev").select("arc", (F.col("place") + F.col("gap")).alias("place")), "places")
        ranked = ranked.unionByName(again)
    return ranked


def subtree_totals(tree, values):
    """Rows (node, totals): the sum of each named expression of ``tree`` over each node's subtree."""
    places = list_rank(tour(tree))
    weights = tree.select((2 * F.col("node")).alias("arc"), *[value.alias(name) for name, value in values.items()])
    arcs = in_order(places.join(weights, "arc", "left"), ["place"])
    sums = running(arcs, {f"s_{name}": F.coalesce(F.col(name), F.lit(0)) for name in values})
    leaving = F.col("arc") % 2 == 1
    ends = [
        (F.sum(F.when(leaving, F.col(f"s_{name}")).otherwise(-F.col(f"s_{name}"))) + F.max(F.coalesce(F.col(name), F.lit(0)))).alias(name)
        for name in values
    ]
    return sums.groupBy(F.shiftright("arc", 1).alias("node")).agg(*ends)


def end_digests(ends):
    """Rows (depth, x, y, ends_sha256) of rows (depth, x, y, conv_id): SHA-256 of the ids of each node."""
    placed = in_order(ends.select(*KEY, "conv_id"), [*KEY, "conv_id"])
    chunk = F.shiftright(PLACE, CHUNK.bit_length() - 1).alias("chunk")
    ids = F.transform(F.sort_array(F.collect_list("conv_id")), lambda i: i.cast("string"))
    chunks = placed.groupBy(*KEY, chunk).agg(F.array_join(ids, ",").alias("ids"))

    def digest(batches):
        state, at = None, None
        for frame in batches:
            done = []
            for *key, ids in zip(*(frame[name] for name in [*KEY, "ids"])):
                if key == at:
                    state.update(b",")
                else:
                    if at is not None:
                        done.append((*at, state.hexdigest()))
                    at, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=[*KEY, "ends_sha256"])
        if at is not None:
            yield pd.DataFrame([(*at, state.hexdigest())], columns=[*KEY, "ends_sha256"])

    dealt = chunks.repartition(*KEY).sortWithinPartitions(*KEY, "chunk")
    return dealt.mapInPandas(digest, "depth long, x long, y long, ends_sha256 string")


def prefix_trie(turns, members):
    """One row per node of the trie of numbered turns: conv_id, depth, parent_conv_id, counts, saved_tokens, ends_sha256.

    ``turns`` is what :func:`numbered` gives; ``members`` has one row (conv_id) per conversation, those
    without turns included.
    """
    steps = steps_of(turns)
    tree = family(trie_nodes(steps, members))
    leaf = F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long")
    totals = subtree_totals(tree, {"n_leaves": leaf, "saved_tokens": F.col("own")})
    turnless = members.join(steps.select("conv_id").where("depth = 1"), "conv_id", "left_anti")
    zero = F.lit(0).cast("long")
    ends = steps.where("last").select(*KEY, "conv_id").unionByName(turnless.select(*[zero.alias(c) for c in KEY], "conv_id"))
    nobody = F.lit(hashlib.sha256(b"").hexdigest())
    rows = tree.join(totals, "node").join(end_digests(ends), KEY, "left")
    return rows.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256")
    )


def shared_heads(turns, period=100, longest=6):
    """Numbered turns of conversations rebuilt on shared heads, and their members.

    Conversation c begins with the first h turns of conversation ``c - c % period``, h being the
    unsigned crc32 of its decimal id modulo ``longest``; its own turns after its first h follow. The
    remainder of a negative id is negative, as in SQL.
    """
    original = numbered(turns, ["turn", "digest"]).drop(PLACE, PART)
    original = stage(original.withColumn("h", F.crc32(F.col("conv_id").cast("string")) % longest), "turns")
    members = stage(original.select("conv_id", "h").distinct(), "members")
    heads = original.where((F.col("conv_id") % period == 0) & (F.col("depth") < longest))
    heads = heads.select(F.col("conv_id").alias("from_id"), F.col("depth").alias("at"), "digest", "size")
    based = members.withColumn("from_id", F.col("conv_id") - F.col("conv_id") % period)
    shared = based.join(heads, "from_id").where("at <= h").select("conv_id", "at", "digest", "size")
    own = original.where("depth > h").select("conv_id", F.col("depth").alias("at"), "digest", "size")
    return numbered(shared.unionByName(own), ["at"]), members.select("conv_id")
