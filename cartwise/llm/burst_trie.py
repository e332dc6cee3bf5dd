"""Prefix trie of conversations, built as a burst trie (operator 12).

A container holds the suffixes of all conversations below one trie node, its
head. Containers over the limit burst: the longest prefix that all their
suffixes share becomes a chain of nodes, and every next turn id a container of
its own, until all are within the limit. What remains is dealt to tasks by
container, sorted there, and swept into nodes; sums of the burst nodes are added
up from the containers below them.

Equal conversations are one row with their number, so a group of copies neither
fills a container nor has to be burst to its end. A turn id is the MD5 of role
and text, so texts are moved once, to their conversation, and not beyond.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwise.llm.common import hand_back_memory
from cartwise.session import small_side, stage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 8192  # turns (and one for each conversation) of a container that is not burst
_CHUNK = 4096  # neighbouring conversation ids that are joined to one text before they are hashed
_NO_IDS = hashlib.sha256(b"").hexdigest()
_ROWS = 8192  # nodes that a task hands on at once


def conversations(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """One row per conversation: conv_id, ``ids`` (a turn id each) and ``chars`` (code points of each text), by turn.

    A null turn comes first; equal turns are ordered by role and turn id, and
    repeated rows are turns of their own. Null roles and texts are empty. Rows
    without conv_id belong to no conversation and are left out.
    """
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            role_.alias("role"),
            F.unhex(F.md5(F.concat(F.octet_length(role_).cast("string"), F.lit(":"), role_, text_))).alias("id"),
            F.length(text_).cast("long").alias("chars"),
        ).alias("t"),
    )
    return (
        rows.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select("conv_id", F.col("t.id").alias("ids"), F.col("t.chars").alias("chars"))
    )


def with_shared_heads(convs: DataFrame) -> DataFrame:
    """The conversations of the registered query: c begins with turns of conversation c - c % 100.

    With h the CRC-32 of c's decimal text modulo 6: the first h turns of that
    conversation (all, if it has fewer; none, if it does not exist), then c's
    own turns after its first h.
    """
    base = F.col("conv_id") - F.col("conv_id") % 100
    heads = convs.where("conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"),
        F.slice("ids", 1, 5).alias("head_ids"),
        F.slice("chars", 1, 5).alias("head_chars"),
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 6).cast("int")

    def joined(name: str) -> Column:
        own = F.slice(name, F.col("h") + 1, F.greatest(F.size(name) - F.col("h"), F.lit(0)))
        head = F.slice(f"head_{name}", F.lit(1), F.col("h"))
        return F.when(F.col(f"head_{name}").isNull(), own).otherwise(F.concat(head, own)).alias(name)

    return (
        convs.withColumn("base", base).withColumn("h", h).join(heads, "base", "left")
        .select("conv_id", joined("ids"), joined("chars"))
    )


# --- equal conversations -----------------------------------------------------------


def _distinct(convs: DataFrame) -> DataFrame:
    """One row per distinct sequence: smallest conv_id, number ``n``, and the hash of all its conv_ids."""
    keyed = stage(convs.withColumn("key", F.unhex(F.md5(F.array_join(F.transform("ids", F.hex), "")))))
    groups = stage(keyed.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n")))
    # Neighbouring ids become one text before a key's texts meet, so a large group is few rows.
    chunk = F.floor(F.col("conv_id") / _CHUNK)
    texts = (
        keyed.groupBy("key", chunk.alias("chunk"))
        .agg(F.array_join(F.sort_array(F.collect_list("conv_id")), ",").alias("text"))
        .repartition("key")
        .sortWithinPartitions("key", "chunk")
    )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, out = None, None, []

        def frame() -> pa.RecordBatch:
            done = pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in out], pa.binary()), pa.array([s for _, s in out], pa.string())], ["key", "ends"]
            )
            out.clear()
            return done

        for batch in batches:
            for own, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
                if own == key:
                    state.update(b"," + text.encode())
                    continue
                if state is not None:
                    out.append((key, state.hexdigest()))
                key, state = own, hashlib.sha256(text.encode())
            if len(out) >= _ROWS:
                yield frame()
        if state is not None:
            out.append((key, state.hexdigest()))
            yield frame()

    ends = texts.select("key", "text").mapInArrow(hashed, "key binary, ends string")
    return keyed.join(groups, ["key", "conv_id"]).join(ends, "key").select("conv_id", "n", "ids", "chars", "ends")


# --- bursting ----------------------------------------------------------------------


def _shared(a: Column, b: Column) -> Column:
    """How many elements two arrays share from the start."""
    differs = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), F.lit(False))
    return F.when(differs > 0, differs - 1).otherwise(F.size(a)).cast("int")


def _rest(name: str) -> Column:
    return F.slice(name, F.col("depth") + 1, F.greatest(F.size(name) - F.col("depth"), F.lit(0)))


def _burst(rows: DataFrame, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Settled containers (rows with ``box``, ``depth``, ``trail``), and the burst ones (a row each)."""
    live = stage(
        rows.withColumns({
            "box": F.lit(b""),  # what identifies the container
            "depth": F.lit(0),  # turns before its head
            "trail": F.array().cast("array<binary>"),  # burst containers above it
        })
    )
    settled, burst = [], []
    while True:
        big = stage(
            live.groupBy("box")
            .agg(F.sum(F.size("ids") - F.col("depth") + 1).alias("size"), F.min("conv_id").alias("conv_id"))
            .where(F.col("size") > limit)
            .select("box", "conv_id")
        )
        if big.isEmpty():
            return [*settled, live], burst
        few = small_side(big.select("box"))
        settled.append(live.join(few, "box", "left_anti"))
        # One suffix stands for its container: what all share with it they share with each other.
        one = stage(
            live.join(small_side(big), ["box", "conv_id"]).select("box", _rest("ids").alias("one"))
        )
        split = live.join(small_side(one), "box").withColumn("same", _shared(_rest("ids"), F.col("one"))).drop("one")
        split = stage(split)
        common = stage(split.groupBy("box").agg(F.min("same").alias("same")))
        split = (
            split.drop("same").join(small_side(common), "box")
            .withColumn("fork", F.col("depth") + F.col("same"))
            .withColumn("turn", F.get("ids", F.col("fork")))  # null where the conversation ends at the fork
        )
        split = stage(split)
        first = F.min_by(F.slice("chars", F.greatest(F.col("depth"), F.lit(1)), F.lit(1) + F.col("fork") - F.greatest(F.col("depth"), F.lit(1))), "conv_id")
        burst.append(
            stage(
                split.groupBy("box", "turn")  # first by turn: a container may hold most of all rows
                .agg(
                    F.sum("n").alias("n"), F.min("conv_id").alias("conv_id"), F.max("ends").alias("ends"),
                    F.first("trail").alias("trail"), F.first("depth").alias("depth"), F.first("fork").alias("fork"),
                    first.alias("chars"),
                )
                .groupBy("box")
                .agg(
                    F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"),
                    F.max(F.when(F.col("turn").isNull(), F.col("ends"))).alias("ends"),
                    F.count("turn").alias("n_children"), F.first("trail").alias("trail"),
                    F.first("depth").alias("depth"), F.first("fork").alias("fork"), F.first("chars").alias("chars"),
                )
            )
        )
        live = stage(
            split.where("turn IS NOT NULL").select(
                "conv_id", "n", "ids", "chars", "ends",
                F.unhex(F.md5(F.concat("box", F.col("fork").cast("string").cast("binary"), "turn"))).alias("box"),
                (F.col("fork") + 1).alias("depth"),
                F.concat("trail", F.array("box")).alias("trail"),
            )
        )


# --- sweeping ----------------------------------------------------------------------

_NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
    "ends_sha256 string, trail array<binary>"
)


def _sweep_one(depth: int, rows: list[tuple]) -> list[list]:
    """Nodes of a container: [conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends], its head first.

    ``rows`` are (suffix, chars from the head's own turn on, n, conv_id, ends).
    """
    rows.sort(key=lambda r: r[0])
    nodes = [[rows[0][3], depth, -1, 0, 0, 0, 0, None]]
    sizes = [rows[0][1][0]]
    path, before = [0], []
    for suffix, chars, n, conv, ends in rows:
        same = 0
        for a, b in zip(before, suffix):
            if a != b:
                break
            same += 1
        del path[same + 1 :]
        for k in range(same, len(suffix)):
            nodes[path[-1]][4] += 1
            nodes.append([conv, depth + k + 1, path[-1], 0, 0, 0, 0, None])
            sizes.append(chars[k + 1])
            path.append(len(nodes) - 1)
        for i in path:
            node = nodes[i]
            node[3] += n
            node[0] = min(node[0], conv)
        nodes[path[-1]][7] = ends
        before = suffix
    for node, size in zip(reversed(nodes), reversed(sizes), strict=True):  # children stand after their parents
        node[5] += not node[4]
        node[6] += (node[3] - 1) * size
        if node[2] >= 0:
            nodes[node[2]][5] += node[5]
            nodes[node[2]][6] += node[6]
    for node in reversed(nodes):
        node[2] = nodes[node[2]][0] if node[2] >= 0 else None
    return nodes


def _sweep(settled: DataFrame) -> DataFrame:
    """Nodes of all settled containers; ``trail`` is null but for heads."""

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box, held, trail, out = None, [], None, []

        def finish() -> None:
            if held:
                nodes = _sweep_one(held[0][0], [r[1:] for r in held])
                out.extend((*node, trail if k == 0 else None) for k, node in enumerate(nodes))
                held.clear()

        def frame() -> pa.RecordBatch:
            columns = list(zip(*out))
            kinds = [pa.int64()] * 7 + [pa.string(), pa.list_(pa.binary())]
            names = [c.split()[0] for c in _NODES.split(", ")]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in batches:
            for row in batch.to_pylist():
                if row["box"] != box:
                    finish()
                    box, trail = row["box"], row["trail"]
                    if len(out) >= _ROWS:
                        yield frame()
                d = row["depth"]
                own = row["chars"][d - 1 :] if d else [0, *row["chars"]]  # the root has no turn of its own
                held.append((d, row["ids"][d:], own, row["n"], row["conv_id"], row["ends"]))
        finish()
        if out:
            yield frame()
        hand_back_memory()

    dealt = settled.repartition("box").sortWithinPartitions("box")
    return dealt.mapInArrow(sweep, _NODES)


def prefix_trie(convs: DataFrame, limit: int = LIMIT) -> DataFrame:
    """All nodes of the trie of ``convs`` (conv_id, ids, chars as ``conversations`` returns them; conv_ids distinct).

    A node is a distinct sequence of first turns, from the root of depth 0 on.
    Columns: conv_id (smallest member), depth, parent_conv_id (null at the
    root), n_convs, n_children, n_leaves (childless nodes of its subtree, itself
    included), saved_tokens (over its subtree: members less one times code
    points of the node's last text) and ends_sha256 (of the comma-joined
    conv_ids that end at the node, ascending). An empty table has no nodes. A
    conversation without turns ends at the root.

    A task sweeps containers of at most ``limit`` turns each. A round bursts all
    containers over it at once, chains of shared turns in one step; rounds end
    after as many forks as lie above ``limit`` turns.
    """
    settled, burst = _burst(stage(_distinct(convs)), limit)
    rows = settled[0]
    for other in settled[1:]:
        rows = rows.unionByName(other)
    names = [c.split()[0] for c in _NODES.split(", ")][:-1]
    nodes = stage(_sweep(rows))
    if not burst:
        return nodes.select(names)
    upper = burst[0]
    for other in burst[1:]:
        upper = upper.unionByName(other)
    # The head's chars stand first, a root has none: one for every node from the head to the fork.
    upper = stage(
        upper.withColumn("chars", F.when(F.col("depth") == 0, F.concat(F.array(F.lit(0).cast("long")), "chars")).otherwise(F.col("chars")))
        .withColumn("leaf", F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long"))
        .withColumn("own", (F.col("n_convs") - 1) * F.aggregate("chars", F.lit(0).cast("long"), lambda s, c: s + c))
    )
    heads = nodes.where("size(trail) > 0")
    below = (
        heads.select(F.explode("trail").alias("box"), F.col("n_leaves").alias("leaves"), F.col("saved_tokens").alias("saved"))
        .unionByName(upper.select(F.explode("trail").alias("box"), F.col("leaf").alias("leaves"), F.col("own").alias("saved")))
        .unionByName(upper.select("box", F.col("leaf").alias("leaves"), F.lit(0).cast("long").alias("saved")))
        .groupBy("box")
        .agg(F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("below"))
    )
    parents = stage(upper.select(F.col("box").alias("parent"), F.col("conv_id").alias("parent_conv_id")))
    parent = F.element_at("trail", -1)
    inner = (
        upper.join(below, "box")
        .withColumn("parent", F.when(F.size("trail") > 0, parent))
        .join(small_side(parents), "parent", "left")
        .select("*", F.posexplode("chars").alias("place", "size"))
    )
    upward = Window.partitionBy("box").orderBy(F.desc("place"))  # a box's rows are a chain of turns of one conversation
    at_fork = F.col("depth") + F.col("place") == F.col("fork")
    chain = inner.select(
        "conv_id",
        (F.col("depth") + F.col("place")).cast("long").alias("depth"),
        F.when(F.col("place") == 0, F.col("parent_conv_id")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(at_fork, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        (F.col("below") + (F.col("n_convs") - 1) * F.sum("size").over(upward)).alias("saved_tokens"),
        F.when(at_fork, F.col("ends")).alias("ends_sha256"),
    )
    placed = (
        heads.drop("parent_conv_id").withColumn("parent", parent).join(small_side(parents), "parent").select(names)
    )
    inside = nodes.where("trail IS NULL").select(names)
    return chain.unionByName(placed).unionByName(inside)


def with_hashes(nodes: DataFrame) -> DataFrame:
    """A node at which no conversation ends has the hash of the empty text."""
    return nodes.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_IDS)))
