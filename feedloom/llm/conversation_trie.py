"""A trie of the turns that conversations begin with, and what a shared prefix cache saves.

Conversations are sequences of turns; equal sequences are one. Sequences are sorted and
dealt into shards, ranges of that order, so that a subtree lies in one shard or spreads over
neighbours. A shard writes its trie as balanced parentheses:

* the excess (open ones so far) with its range over blocks and, in a tree, over groups of blocks;
  ``findclose`` looks for the first place back at the excess before a node opened, which ends its subtree;
* the rank of ``()`` pairs counts leaves in a subtree;
* cumulative arrays over the nodes in order give conversations and saved tokens of a subtree.

Only the prefixes of a shard's first and last sequence, its spines, can go on in another shard.
Their counts are partial: equal spine nodes are added up, and what spine nodes themselves add to
the nodes above them is summed along each spine, counted once per node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from feedloom.functions.frames import written
from feedloom.llm.common import word_count

_BLOCK = 64
_SEQUENCE = "turns"

_SHARD_ROWS = T.StructType(
    [
        T.StructField("path", T.LongType()),  # of a spine, null for finished nodes
        T.StructField("key", T.BinaryType()),  # of spine nodes
        T.StructField("parent_key", T.BinaryType()),  # where the parent is on a spine
        T.StructField("parent_conv_id", T.LongType()),  # elsewhere
        *[
            T.StructField(c, T.LongType())
            for c in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "words")
        ],
        T.StructField("ends_sha256", T.StringType()),
    ]
)


class Parentheses:
    """Balanced parentheses (+1, -1) with the range of the excess over blocks, in a tree."""

    def __init__(self, steps: np.ndarray):
        self.steps = steps
        excess = np.cumsum(steps)
        blocks = max(1, -(-len(excess) // _BLOCK))
        self.leaves = 1 << (blocks - 1).bit_length()
        grid = np.full(self.leaves * _BLOCK, np.iinfo(np.int32).max, np.int64)
        grid[: len(excess)] = excess
        self.excess = grid
        grid = grid.reshape(-1, _BLOCK)
        low = np.concatenate([np.empty_like(grid[:, 0]), grid.min(axis=1)])
        high = np.concatenate([np.empty_like(grid[:, 0]), grid.max(axis=1)])
        level = self.leaves
        while level > 1:
            half = level // 2
            low[half:level] = np.minimum(low[level : 2 * level : 2], low[level + 1 : 2 * level : 2])
            high[half:level] = np.maximum(high[level : 2 * level : 2], high[level + 1 : 2 * level : 2])
            level = half
        self.low, self.high = low, high
        pair = np.zeros(len(steps) + 1, np.int64)
        pair[2:] = np.cumsum((steps[:-1] > 0) & (steps[1:] < 0))
        self._pairs = pair  # () that end before a place

    def _has(self, node: np.ndarray, target: np.ndarray) -> np.ndarray:
        return (self.low[node] <= target) & (target <= self.high[node])

    def _scan(self, at: np.ndarray, target: np.ndarray, todo: np.ndarray) -> np.ndarray:
        """Move each place in todo on to its target, at most to the end of its block; what is left over."""
        todo = todo[self.excess[at[todo]] != target[todo]]
        while len(todo):
            at[todo] += 1
            todo = todo[at[todo] % _BLOCK != 0]
            todo = todo[self.excess[at[todo]] != target[todo]]
        return todo

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where the parentheses that open at these places close."""
        target = self.excess[opens] - 1
        at = opens + 1
        # the rest of the block; excess moves by one, so it meets every value between its ends
        inside = np.flatnonzero(at % _BLOCK != 0)
        self._scan(at, target, inside)
        far = np.flatnonzero((at % _BLOCK == 0) & ((at >= len(self.excess)) | (self.excess[np.minimum(at, len(self.excess) - 1)] != target)))
        node = self.leaves + at[far] // _BLOCK
        goal = target[far]
        up = np.flatnonzero(~self._has(node, goal))
        while len(up):
            # on to the next block on the right, or out of a right half into what follows it
            node[up] = np.where(node[up] % 2 == 0, node[up] + 1, node[up] // 2 + 1)
            up = up[~self._has(node[up], goal[up])]
        down = np.flatnonzero(node < self.leaves)
        while len(down):
            left = 2 * node[down]
            node[down] = np.where(self._has(left, goal[down]), left, left + 1)
            down = down[node[down] < self.leaves]
        at[far] = (node - self.leaves) * _BLOCK
        self._scan(at, target, far)
        return at

    def leaf_pairs(self, opens: np.ndarray, closes: np.ndarray) -> np.ndarray:
        """Leaves between these places, both included."""
        return self._pairs[closes + 1] - self._pairs[opens]


def sequences(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv_id, turns): every conversation's turns in order, null first, as keys with their words.

    A turn's key is a 128-bit hash of role and text; null role or text counts as empty. Turns of
    equal number are ordered by their key, repeated rows are repeated turns. Rows without a conv_id
    belong to no conversation and are left out. A conversation is one row, of 24 bytes a turn.
    """
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.xxhash64(*said).alias("a"),
            F.xxhash64(F.lit("second"), *said).alias("b"),
            word_count(said[1]).alias("words"),
        ).alias("t"),
    )
    in_order = F.sort_array(F.collect_list("t"))
    bare = F.transform(in_order, lambda t: F.struct(t["a"].alias("a"), t["b"].alias("b"), t["words"].alias("words")))
    return turns.groupBy("conv_id").agg(bare.alias(_SEQUENCE))


def _digest_ends(members: DataFrame) -> DataFrame:
    """(a, b, ends_sha256) per sequence: the hash of its conv_ids, ascending, comma-joined.

    Ids are joined in ranges of 4096 first. The hash reads a sequence's pieces in order as they stream by,
    so no group is held in memory; a SHA-256 has no parts to compute apart.
    """
    pieces = members.groupBy("a", "b", F.shiftright("conv_id", 12).alias("chunk")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids")
    )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            out = []
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "ids"))):
                if now == (a, b):
                    state.update(b"," + ids.encode())
                    continue
                if now:
                    out.append((*now, state.hexdigest()))
                now, state = (a, b), hashlib.sha256(ids.encode())
            if out:
                yield _batch(out, ["a", "b", "ends_sha256"], [pa.int64(), pa.int64(), pa.string()])
        if now:
            out = [(*now, state.hexdigest())]
            yield _batch(out, ["a", "b", "ends_sha256"], [pa.int64(), pa.int64(), pa.string()])

    ordered = pieces.repartition("a", "b").sortWithinPartitions("a", "b", "chunk")
    return ordered.select("a", "b", "ids").mapInArrow(digests, "a long, b long, ends_sha256 string")


def _batch(rows: list[tuple], names: list[str], types: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def _shared(offsets: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common beginning of each sequence and the one before it, 0 for the first."""
    size = np.diff(offsets)
    shared = np.zeros(len(size), np.int64)
    if len(size) < 2:
        return shared
    shared[1:] = np.minimum(size[1:], size[:-1])
    which = np.repeat(np.arange(len(size)), shared)
    step = np.arange(len(which)) - np.repeat(np.cumsum(shared) - shared, shared)
    here, there = offsets[which] + step, offsets[which - 1] + step
    other = np.flatnonzero((a[here] != a[there]) | (b[here] != b[there]))
    if len(other):
        first = np.unique(which[other], return_index=True)
        shared[first[0]] = step[other[first[1]]]
    return shared


def _keys(a: np.ndarray, b: np.ndarray) -> list[bytes]:
    """Keys of all beginnings of one sequence, the empty one first."""
    state = hashlib.blake2b(digest_size=16)
    keys = [state.digest()]
    for part in np.stack([a, b], axis=1):
        state.update(part.tobytes())
        keys.append(state.digest())
    return keys


def _shard_nodes(table: pa.Table, shard: int) -> pa.RecordBatch:
    """All nodes of a shard: sorted, distinct sequences with their smallest conv_id and number of conversations."""
    turns = table.column("turns").combine_chunks()
    offsets = turns.offsets.to_numpy().astype(np.int64)
    flat = turns.values
    a, b, words = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "words"))
    size = np.diff(offsets)
    shared = _shared(offsets, a, b)
    new = size - shared
    # one step per node: back to what is shared, then on to the end; the root around it all
    counts = np.stack([np.concatenate([[0], size[:-1]]) - shared, new], axis=1).ravel()
    counts[0] = 0
    steps = np.repeat(np.tile([-1, 1], len(size)), counts)
    steps = np.concatenate([[1], steps, np.full(size[-1] + 1, -1)])
    tree = Parentheses(steps)
    opens = np.flatnonzero(steps > 0)
    closes = tree.findclose(opens)
    n = len(opens)
    node = np.arange(n)
    after = node + (closes - opens + 1) // 2  # the node after the subtree, in order
    depth = tree.excess[opens] - 1
    base = 1 + np.cumsum(new) - new
    own_words = np.zeros(n, np.int64)
    which = np.repeat(np.arange(len(size)), new)
    own_words[1:] = words[(offsets[:-1] + shared)[which] + np.arange(n - 1) - (base - 1)[which]]

    parent = node - 1
    path = np.zeros(int(size.max(initial=0)) + 1, np.int64)
    ends_at = np.empty(len(size), np.int64)
    first_path = None
    for i, (start, keep, long) in enumerate(zip(base.tolist(), shared.tolist(), size.tolist())):
        if long > keep:
            parent[start] = path[keep]
            path[keep + 1 : long + 1] = np.arange(start, start + long - keep)
        ends_at[i] = path[long]
        if first_path is None:
            first_path = path[: long + 1].copy()
    last_path = path[: int(size[-1]) + 1].copy()

    ends = np.zeros(n, np.int64)
    ends[ends_at] = table.column("n").to_numpy()
    upto = np.concatenate([[0], np.cumsum(ends)])
    n_convs = upto[after] - upto[node]
    least = np.full(n, np.iinfo(np.int64).max)
    least[ends_at] = table.column("conv_id").to_numpy()
    smallest = least.tolist()
    above = parent.tolist()
    for v in range(n - 1, 0, -1):
        if smallest[v] < smallest[above[v]]:
            smallest[above[v]] = smallest[v]
    smallest = np.array(smallest)

    spine = np.zeros(n, bool)
    spine[first_path] = spine[last_path] = True
    saves = np.where(spine, 0, (n_convs - 1) * own_words)
    upto = np.concatenate([[0], np.cumsum(saves)])
    saved = upto[after] - upto[node]
    lone = (after == node + 1) & spine  # childless so far, but not known to be for good
    upto = np.concatenate([[0], np.cumsum(lone)])
    leaves = tree.leaf_pairs(opens, closes) - (upto[after] - upto[node])
    children = np.bincount(parent[1:][~spine[1:]], minlength=n)

    digest = np.full(n, None, object)
    digest[ends_at] = table.column("ends_sha256").to_pylist()
    left = _keys(a[: size[0]], b[: size[0]])
    right = _keys(a[offsets[-2] : offsets[-1]], b[offsets[-2] : offsets[-1]])
    key = dict(zip(first_path.tolist(), left)) | dict(zip(last_path.tolist(), right))

    done = node[~spine]
    fork = int(shared_spine(first_path, last_path))
    known = np.concatenate([first_path, last_path])
    rows = np.concatenate([done, known])
    zero = np.zeros(len(rows), bool)  # the part of the last spine that the first one has told already
    zero[len(done) + len(first_path) : len(done) + len(first_path) + fork] = True
    paths = [None] * len(done) + [2 * shard] * len(first_path) + [2 * shard + 1] * len(last_path)
    own_keys = [None] * len(done) + [key[int(v)] for v in known]
    parent_keys = [key.get(above[v]) if v else None for v in rows.tolist()]
    told = lambda x: np.where(zero, 0, x[rows])
    parent_conv = [None if k is not None or not v else int(smallest[above[v]]) for k, v in zip(parent_keys, rows.tolist())]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(paths, pa.int64()),
            pa.array(own_keys, pa.binary()),
            pa.array(parent_keys, pa.binary()),
            pa.array(parent_conv, pa.int64()),
            *[pa.array(x, pa.int64()) for x in (smallest[rows], depth[rows], told(n_convs), told(children), told(leaves), told(saved), own_words[rows])],
            pa.array(digest[rows].tolist(), pa.string()),
        ],
        names=[f.name for f in _SHARD_ROWS.fields],
    )


def shared_spine(first: np.ndarray, last: np.ndarray) -> int:
    """Nodes that the first and the last spine of a shard share, the root included."""
    n = min(len(first), len(last))
    differ = np.flatnonzero(first[:n] != last[:n])
    return int(differ[0]) if len(differ) else n


def _merged(spines: DataFrame) -> DataFrame:
    """Whole nodes from the spines of all shards."""
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    merged = spines.groupBy("key").agg(
        *[F.sum(c).alias(c) for c in sums],
        F.min("conv_id").alias("conv_id"),
        *[F.max(c).alias(c) for c in ("depth", "words", "parent_key", "ends_sha256")],
        F.min("path").alias("owner"),
    )
    merged = written(merged)
    below = merged.groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("_more"))
    merged = written(
        merged.join(below, "key", "left")
        .withColumn("n_children", F.col("n_children") + F.coalesce("_more", F.lit(0)))
        .drop("_more")
    )
    # What a spine node adds itself, to it and all above it: summed along the spines, once per node.
    adds = merged.select(
        "key",
        "owner",
        ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"),
        (F.col("n_children") == 0).cast("long").alias("own_leaf"),
    )
    mine = F.col("path") == F.col("owner")
    up = Window.partitionBy("path").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    along = spines.select("path", "depth", "key").join(adds, "key").select(
        "key",
        *[F.sum(F.when(mine, F.col(c)).otherwise(0)).over(up).alias(c) for c in ("own_saved", "own_leaf")],
    )
    added = along.groupBy("key").agg(F.sum("own_saved").alias("own_saved"), F.sum("own_leaf").alias("own_leaf"))
    return merged.join(added, "key").select(
        "key",
        "parent_key",
        "conv_id",
        "depth",
        "n_convs",
        "n_children",
        (F.col("n_leaves") + F.col("own_leaf")).alias("n_leaves"),
        (F.col("saved_tokens") + F.col("own_saved")).alias("saved_tokens"),
        "ends_sha256",
    )


def prefix_nodes(rows: DataFrame, turns_per_shard: int = 100_000) -> DataFrame:
    """One row per distinct beginning of the sequences (conv_id, turns), the empty one (root) included.

    conv_id: smallest conversation that starts with it; depth; parent_conv_id (root: null); n_convs:
    conversations that start with it; n_children; n_leaves: childless nodes in its subtree (itself if it
    is one); saved_tokens: over its subtree, (n_convs - 1) times the words of the last turn;
    ends_sha256: hash of the ids that end here, ascending, comma-joined. Conversations without turns end
    at the root. Ids are taken as they are, so an id given twice counts twice; an empty
    table has no nodes. Extra columns are not read. Copies of a sequence are one row before
    the shards are dealt, so a hot conversation or first turn stays small.
    """
    name = [F.xxhash64(_SEQUENCE).alias("a"), F.xxhash64(F.lit("second"), _SEQUENCE).alias("b")]
    named = written(rows.select("conv_id", _SEQUENCE, *name))
    one = named.groupBy("a", "b").agg(
        F.first(_SEQUENCE).alias(_SEQUENCE), F.min("conv_id").alias("conv_id"), F.count("*").alias("n")
    )
    ends = written(_digest_ends(named.select("a", "b", "conv_id")))
    distinct = written(one.join(ends, ["a", "b"]).drop("a", "b"))
    total = distinct.agg(F.sum(F.size(_SEQUENCE) + 1)).first()[0] or 0
    shards = distinct.repartitionByRange(max(1, -(-total // turns_per_shard)), _SEQUENCE)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield _shard_nodes(pa.Table.from_batches(held), TaskContext.get().partitionId())

    nodes = written(shards.sortWithinPartitions(_SEQUENCE).mapInArrow(encoded, _SHARD_ROWS))
    spines = written(_merged(nodes.filter(F.col("path").isNotNull())))
    result = [
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
    ]
    digest: Column = F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")
    tops = spines.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("_top"))
    inner = (
        nodes.filter(F.col("path").isNull())
        .join(tops, "parent_key", "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_top"))
    )
    outer = spines.join(tops.withColumnRenamed("_top", "parent_conv_id"), "parent_key", "left")
    return inner.select(*result, digest).union(outer.select(*result, digest))
