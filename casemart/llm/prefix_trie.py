"""Conversation prefix trie (op 11): what conversations share from their first turn on, in tables of minimal perfect hashes.

1. rebuild: turns are ordered within a conversation (by turn, null first; ties by the SHA-256 of role and text) as digests and
   byte counts, never as texts. Conversations of one group of five lie in one partition, where each takes the first turns of the
   group's first conversation.
2. prefixes: the digest of a prefix is a hash of the shorter prefix's digest and the turn's. Equal conversations become one row.
3. owners: a node belongs to its smallest member. The nodes that a conversation owns are the last of its path, so one depth per
   conversation says which; a leaf belongs to the conversation that ends there.
4. shards: a task takes distinct conversations until their paths have SHARD_NODES entries, enumerates the distinct prefix digests,
   gives each a slot by a minimal perfect hash (every lookup compares the whole digest), scatters the conversations'
   counts into flat arrays by slot, and adds each slot to its parent's, deepest first. It sends one row per node.
5. sums: all figures of a node are sums over conversations (its members; the leaves and distinct nodes that they own), so the rows
   of a node from different shards are added up. A node with any number of members or children, the root included,
   gives one row per shard: no group is collected.
6. ends: ids are sorted by node and number over all tasks, in ranges. A task hashes what lies in its range as a whole; the first and
   the last node of a range send their ids as long strings, which are hashed in order, as a stream.

Null roles and texts are empty. Rows with a null conv_id belong to no conversation and are left out. Repeated rows are turns of
their own. Rebuilt conversations without a turn are members of the root alone. An empty table has no nodes. A text of any length
is one digest; a conversation's digests are held in one row (some 100 bytes per turn in memory). Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casemart.llm.common import mixed, stored

#: Conversations in a group; the number of turns that are taken from its first one is a crc32 modulo TURNS.
GROUP, TURNS = 5, 9
#: Entries of paths in one table.
SHARD_NODES = 400_000
#: Ids in one string of the last step, and rows that a task sends at once.
CHUNK_IDS, SENT_ROWS = 1000, 2000
#: Levels of a perfect hash: each leaves under a half of its keys to the next.
LEVELS = 200

DIGEST = 16
ROOT = hashlib.blake2b(b"root", digest_size=DIGEST).digest()
FIGURES = ["n_convs", "n_children", "n_leaves", "saved_tokens"]

_U = np.uint64


def turn_digest(role: Column, text: Column) -> Column:
    """Half of a SHA-256 of both; the length of the role keeps them apart."""
    return F.substring(F.unhex(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256)), 1, DIGEST)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns, an array of structs (digest, bytes), after each conversation took its first turns from its group's first."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn").alias("turn"), turn_digest(role, text).alias("digest"), F.octet_length(text).cast("long").alias("bytes"))
    group = F.col("conv_id") - F.col("conv_id") % GROUP
    rows = conversations.filter("conv_id IS NOT NULL").select(group.alias("first_id"), "conv_id", turn.alias("turn")).repartition("first_id")
    own = rows.groupBy("first_id", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = own.select("first_id", "conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))
    # At most five rows a group: what is collected again is the conversations of one group.
    groups = own.groupBy("first_id").agg(F.collect_list(F.struct("conv_id", "turns")).alias("all"))
    heads = F.flatten(F.transform(F.filter("all", lambda c: c["conv_id"] == F.col("first_id")), lambda c: F.slice(c["turns"], 1, TURNS)))
    each = groups.select(heads.alias("head"), F.explode("all").alias("own"))
    h = (F.crc32(F.col("own.conv_id").cast("string")) % TURNS).cast("int")
    whole = F.concat(F.slice("head", F.lit(1), h), F.slice("own.turns", h + 1, F.greatest(F.size("own.turns") - h, F.lit(0))))
    return each.select(F.col("own.conv_id").alias("conv_id"), whole.alias("turns"))


def _chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        turns = batch.column("turns")
        at = turns.offsets.to_numpy()
        digests, sizes = turns.values.field("digest").to_pylist(), turns.values.field("bytes").to_numpy()
        paths = []
        for start, stop in zip(at[:-1], at[1:], strict=True):
            path = [ROOT]
            for digest in digests[start:stop]:
                path.append(hashlib.blake2b(path[-1] + digest, digest_size=DIGEST).digest())
            paths.append(path)
        ends = pa.array([path[-1] for path in paths], pa.binary())
        counts = pa.ListArray.from_arrays(pa.array(at - at[0], pa.int32()), pa.array(sizes[at[0] : at[-1]], pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("conv_id"), ends, pa.array(paths, pa.list_(pa.binary())), counts], ["conv_id", "end", "path", "sizes"])


def prefix_paths(turns: DataFrame) -> DataFrame:
    """conv_id, end (the digest of the whole), path (the digests of all prefixes, the empty one first) and sizes (bytes of texts)."""
    return turns.mapInArrow(_chained, "conv_id long, end binary, path array<binary>, sizes array<long>")


def distinct_paths(paths: DataFrame) -> DataFrame:
    """The smallest conv_id, copies, path and sizes of each distinct conversation."""
    alike = [F.max("path").alias("path"), F.min("path").alias("other"), F.max("sizes").alias("sizes")]
    found = paths.groupBy("end").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("copies"), *alike)
    path = F.when(F.col("path") == F.col("other"), F.col("path")).otherwise(F.raise_error(F.lit("two conversations have one digest")))
    return found.select("conv_id", "copies", path.alias("path"), "sizes")


def owned_from(distinct: DataFrame) -> DataFrame:
    """conv_id, depth (of the first node on its path that it owns) and leaf (whether it owns a leaf) of the conversations that own nodes."""
    entries = distinct.select("conv_id", F.size("sizes").alias("length"), F.posexplode("path").alias("depth", "digest"))
    least = [F.min("conv_id").alias("conv_id"), F.max("length").alias("longest"), F.min("depth").alias("depth")]
    owned = entries.groupBy("digest").agg(*least).groupBy("conv_id")
    return owned.agg(F.min("depth").alias("depth"), F.max(F.col("longest") == F.col("depth")).alias("leaf"))


class PerfectHash:
    """Slots 0..n-1 for n distinct digests, as rows of two 64-bit numbers.

    Each level deals the keys that are left to places; a key alone at its place keeps it, the others go to the next
    level. A slot is the number of kept places before it. `slots` compares the digests it is asked for with those in the table.
    """

    def __init__(self, keys: np.ndarray):
        self.levels, self.n = [], len(keys)
        self.keys = np.empty_like(keys)
        left, taken = np.arange(len(keys)), 0
        for seed in range(LEVELS):
            if not len(left):
                break
            places = self._places(keys[left], seed, 2 * len(left))
            counts = np.bincount(places, minlength=2 * len(left))
            ranks = np.where(counts == 1, taken + np.cumsum(counts == 1) - 1, -1)
            found = ranks[places]
            self.keys[found[found >= 0]] = keys[left[found >= 0]]
            self.levels.append(ranks)
            taken += int((counts == 1).sum())
            left = left[found < 0]
        if len(left):
            raise ValueError("two digests are the same")

    @staticmethod
    def _places(keys: np.ndarray, seed: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mixed(keys[:, 0] ^ mixed(keys[:, 1] + _U(seed) * _U(0x9E3779B97F4A7C15))) % _U(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for seed, ranks in enumerate(self.levels):
            found = ranks[self._places(keys[left], seed, len(ranks))]
            out[left[found >= 0]] = found[found >= 0]
            left = left[found < 0]
        if len(left) or not np.array_equal(self.keys[out], keys):
            raise ValueError("a digest is not in the table")
        return out


def _as_numbers(digests: bytes) -> np.ndarray:
    return np.frombuffer(digests, _U).reshape(-1, 2)


def node_table(rows: list[tuple[int, int, list[bytes], np.ndarray, int, bool]]) -> pa.RecordBatch:
    """The nodes of some distinct conversations (conv_id, copies, path, sizes, depth of the first owned node, owns a leaf), with the sums that
    these conversations add to each."""
    conv_id, copies, paths, sizes, owned, leaf = zip(*rows, strict=True)
    length = np.array([len(s) for s in sizes])
    starts = np.concatenate([[0], np.cumsum(length + 1)])
    entries = _as_numbers(b"".join(b"".join(path) for path in paths))
    distinct = _as_numbers(np.unique(np.ascontiguousarray(entries).view(f"V{DIGEST}")).tobytes())
    table = PerfectHash(distinct)
    slot, n = table.slots(entries), table.n
    row_of = np.repeat(np.arange(len(rows)), length + 1)
    depth_at = np.arange(len(entries)) - starts[row_of]
    inner = np.flatnonzero(depth_at > 0)

    depth, parent, weight = np.zeros(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, np.int64)
    depth[slot], parent[slot[inner]], weight[slot[inner]] = depth_at, slot[inner - 1], np.concatenate([*sizes, np.zeros(0, np.int64)])
    if not (np.array_equal(depth[slot], depth_at) and np.array_equal(parent[slot[inner]], slot[inner - 1])):
        raise ValueError("one digest stands for two prefixes")
    least, owners = np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
    members, leaves, children = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
    ends = slot[starts[1:] - 1]
    np.add.at(members, ends, np.array(copies))
    np.add.at(leaves, ends, np.array(leaf, np.int64))
    np.minimum.at(least, ends, np.array(conv_id))
    np.add.at(owners, slot, depth_at >= np.array(owned)[row_of])
    below = parent >= 0
    np.add.at(children, parent[below], owners[below])

    by_depth = np.argsort(-depth, kind="stable")
    turns = np.cumsum(np.bincount(depth.max() - depth[by_depth]))
    levels = [by_depth[a:b] for a, b in zip([0, *turns[:-1]], turns, strict=True)][:-1]
    for level in levels:
        up = parent[level]
        np.add.at(members, up, members[level])
        np.add.at(leaves, up, leaves[level])
        np.minimum.at(least, up, least[level])
    saved = (members - owners) * weight
    for level in levels:
        np.add.at(saved, parent[level], saved[level])

    def digests(at: np.ndarray) -> pa.Array:
        return pa.array([bytes(d) for d in np.ascontiguousarray(table.keys[at]).view(f"V{DIGEST}").reshape(-1)], pa.binary())

    above = pa.array([d if p >= 0 else None for d, p in zip(digests(np.maximum(parent, 0)).to_pylist(), parent, strict=True)], pa.binary())
    columns = [digests(np.arange(n)), above, *(pa.array(x, pa.int64()) for x in (depth, least, members, children, leaves, saved))]
    return pa.RecordBatch.from_arrays(columns, ["digest", "parent", "depth", "conv_id", *FIGURES])


def _tables(batches: Iterator[pa.RecordBatch], shard_nodes: int) -> Iterator[pa.RecordBatch]:
    held, entries = [], 0
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "copies", "path", "sizes", "owned", "leaf")]
        for conv_id, copies, path, sizes, owned, leaf in zip(*columns, strict=True):
            held.append((conv_id, copies, path, np.array(sizes, np.int64), owned, leaf))
            entries += len(sizes) + 1
            if entries >= shard_nodes:
                yield node_table(held)
                held, entries = [], 0
    if held:
        yield node_table(held)


def nodes(distinct: DataFrame, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """digest, parent, depth, conv_id and FIGURES of every node."""
    owned = owned_from(distinct)
    rows = distinct.join(owned, "conv_id", "left").select("conv_id", "copies", "path", "sizes", F.coalesce("depth", F.size("sizes") + 1).alias("owned"), F.coalesce("leaf", F.lit(False)).alias("leaf"))
    shards = rows.mapInArrow(partial(_tables, shard_nodes=shard_nodes), "digest binary, parent binary, depth long, conv_id long, " + ", ".join(f"{c} long" for c in FIGURES))
    one = [F.min("depth").alias("depth"), F.max("depth").alias("deepest"), F.min("parent").alias("parent"), F.max("parent").alias("other")]
    sums = shards.groupBy("digest").agg(F.min("conv_id").alias("conv_id"), *(F.sum(c).alias(c) for c in FIGURES), *one)
    same = (F.col("depth") == F.col("deepest")) & F.col("parent").eqNullSafe(F.col("other"))
    parent = F.when(same, F.col("parent")).otherwise(F.raise_error(F.lit("one digest stands for two prefixes")))
    return sums.select("digest", parent.alias("parent"), "depth", "conv_id", *FIGURES)


END = "end binary, first_id long, ids string, sha string"


def _runs(batches: Iterator[pa.RecordBatch], chunk_ids: int) -> Iterator[pa.RecordBatch]:
    """Of ids sorted by node: the hash of a node's ids if the node lies within this range, else its ids as strings.

    The first and the last node of the range may go on in another one; one of more than chunk_ids ids is sent as strings too.
    """
    rows, held, current, whole = [], [], None, False

    def close(hashed: bool) -> None:
        text = ",".join(map(str, held))
        rows.append((current, held[0], None, hashlib.sha256(text.encode()).hexdigest()) if hashed else (current, held[0], text, None))
        held.clear()

    def flush() -> pa.RecordBatch:
        columns = zip(*rows, strict=True)
        kinds = [pa.binary(), pa.int64(), pa.string(), pa.string()]
        out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["end", "first_id", "ids", "sha"])
        rows.clear()
        return out

    for batch in batches:
        for end, conv_id in zip(batch.column("end").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if end != current:
                if held:
                    close(whole)
                current, whole = end, current is not None
            elif len(held) >= chunk_ids:
                whole = False
                close(whole)
            held.append(conv_id)
            if len(rows) >= SENT_ROWS:
                yield flush()
    if held:
        close(False)
    if rows:
        yield flush()


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of each node from its strings in order; what is held is one state."""
    current, state, done = None, None, []

    def flush() -> pa.RecordBatch:
        columns = list(zip(*done, strict=True))
        out = pa.RecordBatch.from_arrays([pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())], ["end", "sha"])
        done.clear()
        return out

    for batch in batches:
        for end, ids in zip(batch.column("end").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if end == current:
                state.update(b",")
            else:
                if current is not None:
                    done.append((current, state.hexdigest()))
                current, state = end, hashlib.sha256()
            state.update(ids.encode())
        if len(done) >= SENT_ROWS:
            yield flush()
    if current is not None:
        done.append((current, state.hexdigest()))
        yield flush()


def ends_of(paths: DataFrame, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """end and sha, the SHA-256 of the ascending decimal conv_ids (comma-joined) of the conversations that end at a node."""
    ids = paths.select("end", "conv_id").repartitionByRange("end", "conv_id").sortWithinPartitions("end", "conv_id")
    runs = stored(ids.mapInArrow(partial(_runs, chunk_ids=chunk_ids), END), "trie_ends")
    parts = runs.filter("sha IS NULL").select("end", "first_id", "ids").repartition("end").sortWithinPartitions("end", "first_id")
    return runs.filter("sha IS NOT NULL").select("end", "sha").union(parts.select("end", "ids").mapInArrow(_streamed, "end binary, sha string"))


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES, chunk_ids: int = CHUNK_IDS) -> DataFrame:
    """One row per node: its smallest member, depth and parent's smallest member, FIGURES and the hash of the members that end there."""
    paths = stored(prefix_paths(rebuilt(conversations)), "trie_paths")
    every = stored(nodes(stored(distinct_paths(paths), "trie_distinct"), shard_nodes), "trie_nodes")
    parents = every.select(F.col("digest").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    ended = every.join(ends_of(paths, chunk_ids), F.col("digest") == F.col("end"), "left")
    linked = ended.join(parents, F.col("parent") == F.col("up"), "left")
    none = hashlib.sha256(b"").hexdigest()
    return linked.select("conv_id", "depth", "parent_conv_id", *FIGURES, F.coalesce("sha", F.lit(none)).alias("ends_sha256"))
