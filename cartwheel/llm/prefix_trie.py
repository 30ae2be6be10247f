"""Prefix trie of conversations: ternary search trees per range shard, boundary nodes merged.

Turns are dictionary-encoded: a (role, text) pair gets a number. Conversations, as sequences of numbers, are
range-sorted by (sequence, id), so copies of one conversation may lie in several shards. A task cuts its range into
shards of at most ``SHARD_TURNS`` turns and builds a ternary search tree of each: sequences go in by medians, so the
sibling trees are balanced, and a walk over the nodes, children first, sums up members, children, leaves and
savings without recursion. Only nodes on the first or the last path of a shard can go on in another shard; all others are
complete. Boundary nodes are known by a digest of their path, and their parts are merged by grouping: what adds up is
summed, and what counts once a node (being a child, a leaf, one copy that stays) is counted in the shard that owns it and
handed up along that shard's path.

Defined results: rows with a null id are left out; null roles and texts are empty; turns are ordered by number, null
first, and turns of equal number by the digest of role and text; repeated rows are turns of their own; an id without
turns of its own beyond the shared ones is a member all the same; an empty table gives no node; other columns are
ignored whatever their names. One conversation is one record: its turn numbers (8 bytes each) are held at once.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwheel.llm import storage

#: Turns that one ternary search tree holds; a longer conversation has a tree of its own.
SHARD_TURNS = 100_000
#: Turns met in at least this share of all rows are encoded by a broadcast table of at most HOT rows.
HOT = 4096
#: Characters of a piece of a boundary node's list of ids.
CHUNK = 1 << 16
ROWS = 20_000

_FIELDS = [
    ("kind", pa.string(), "string"), ("shard", pa.int64(), "bigint"), ("chain", pa.int32(), "int"),
    ("depth", pa.int64(), "bigint"), ("key", pa.binary(), "binary"), ("parent_key", pa.binary(), "binary"),
    ("chars", pa.int64(), "bigint"), ("conv_id", pa.int64(), "bigint"), ("parent_conv_id", pa.int64(), "bigint"),
    ("n_convs", pa.int64(), "bigint"), ("n_children", pa.int64(), "bigint"), ("n_leaves", pa.int64(), "bigint"),
    ("saved_tokens", pa.int64(), "bigint"), ("ends_sha256", pa.string(), "string"),
    ("first_id", pa.int64(), "bigint"), ("ids", pa.string(), "string")]
_NAMES = [f[0] for f in _FIELDS]
_ARROW = pa.schema([(name, kind) for name, kind, _ in _FIELDS])
_SPARK = ", ".join(f"{name} {kind}" for name, _, kind in _FIELDS)
ROOT_KEY = b"\x00" * 16
NO_IDS = hashlib.sha256(b"").hexdigest()


class TernaryTree:
    """Sequences of turn numbers; node 0 is the root, and parents have lower numbers than their children."""

    def __init__(self):
        self.label, self.parent, self.depth, self.chars = [None], [-1], [0], [0]
        self.low, self.high, self.down = [-1], [-1], [-1]

    def _new(self, label: int, parent: int, chars: int) -> int:
        self.label.append(label)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.chars.append(chars)
        for side in (self.low, self.high, self.down):
            side.append(-1)
        return len(self.label) - 1

    def insert(self, sequence: list[int], chars: list[int]) -> int:
        """The node of the whole sequence."""
        node = 0
        for turn, size in zip(sequence, chars):
            at, side, above = self.down[node], self.down, node
            while at >= 0 and self.label[at] != turn:
                above, side = at, self.low if turn < self.label[at] else self.high
                at = side[at]
            if at < 0:
                at = side[above] = self._new(turn, node, size)
            node = at
        return node

    def path(self, node: int) -> list[int]:
        found = []
        while node >= 0:
            found.append(node)
            node = self.parent[node]
        return found[::-1]


def by_medians(n: int):
    """The numbers below ``n``, each range's median before its halves."""
    waiting = [(0, n)]
    while waiting:
        a, b = waiting.pop()
        if a < b:
            middle = (a + b) // 2
            yield middle
            waiting += [(middle + 1, b), (a, middle)]


def path_keys(tree: TernaryTree, path: list[int]) -> list[bytes]:
    """A digest of the turns down to each node of a path."""
    keys = [ROOT_KEY]
    for node in path[1:]:
        keys.append(hashlib.blake2b(keys[-1] + tree.label[node].to_bytes(8, "little", signed=True), digest_size=16).digest())
    return keys


def shard_rows(shard: int, sequences: list[tuple[list[int], list[int], list[int]]]):
    """Rows of one shard: complete nodes, parts of boundary nodes, and the ids that end at boundary nodes.

    ``sequences``: distinct (turns, characters, ids in ascending order) in ascending order of turns.
    """
    tree = TernaryTree()
    end_of = [0] * len(sequences)
    for i in by_medians(len(sequences)):
        end_of[i] = tree.insert(sequences[i][0], sequences[i][1])
    size = len(tree.label)
    first, last = tree.path(end_of[0]), tree.path(end_of[-1])
    on_border = [False] * size
    for node in (*first, *last):
        on_border[node] = True
    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    ends: list[list[int] | None] = [None] * size
    for (_, _, ids), node in zip(sequences, end_of):
        ends[node] = ids
        members[node], least[node] = len(ids), ids[0]
    for node in range(size - 1, -1, -1):  # children come after their parents
        inner = not on_border[node]
        if inner and not children[node]:
            leaves[node] = 1
        saved[node] += (members[node] - inner) * tree.chars[node]
        up = tree.parent[node]
        if up >= 0:
            members[up] += members[node]
            least[up] = least[node] if least[up] is None else min(least[up], least[node])
            children[up] += inner
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    keys = dict(zip(first, path_keys(tree, first))) | dict(zip(last, path_keys(tree, last)))
    for node in range(size):
        if not on_border[node]:
            up = tree.parent[node]
            yield {"kind": "node", "shard": shard, "depth": tree.depth[node], "parent_key": keys.get(up),
                   "conv_id": least[node], "parent_conv_id": None if up in keys else least[up], "n_convs": members[node],
                   "n_children": children[node], "n_leaves": leaves[node], "saved_tokens": saved[node],
                   "ends_sha256": hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
                   if ends[node] else NO_IDS}
    known = set()
    for chain, path in enumerate((first, last)):
        for node in path:
            again = node in known  # both paths share their upper nodes, whose parts count in the first one
            known.add(node)
            yield {"kind": "border", "shard": shard, "chain": chain, "depth": tree.depth[node], "key": keys[node],
                   "parent_key": keys.get(tree.parent[node]), "chars": tree.chars[node], "conv_id": least[node],
                   "n_convs": 0 if again else members[node], "n_children": 0 if again else children[node],
                   "n_leaves": 0 if again else leaves[node], "saved_tokens": 0 if again else saved[node]}
            if ends[node] and not again:
                yield from _pieces(keys[node], ends[node])


def _pieces(key: bytes, ids: list[int]):
    each = CHUNK // 20
    for at in range(0, len(ids), each):
        yield {"kind": "ids", "key": key, "first_id": ids[at], "ids": ",".join(map(str, ids[at:at + each]))}


def _shards(batches, part: int, limit: int):
    """Rows of all shards of a task's sorted range."""
    held, turns, number = [], 0, 0
    for batch in batches:
        for conv, sequence, chars in zip(batch["conv_id"].to_pylist(), batch["turns"].to_pylist(), batch["chars"].to_pylist()):
            if held and held[-1][0] == sequence:
                held[-1][2].append(conv)
            else:
                held.append((sequence, chars, [conv]))
                turns += len(sequence)
            turns += 1
            if turns >= limit:
                yield from shard_rows((part << 32) + number, held)
                held, turns, number = [], 0, number + 1
    if held:
        yield from shard_rows((part << 32) + number, held)


def _batches(rows):
    held = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_pylist(held, schema=_ARROW)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=_ARROW)


def sequences(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
              text_col: str = "text") -> DataFrame:
    """``conv_id, turns, chars``: each conversation's dictionary numbers and text lengths, in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    spelled = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = storage.written(conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.sha2(spelled, 256).alias("digest"), F.length(text).alias("chars")), "turns")
    met = rows.groupBy("digest").agg(F.count("*").alias("met"))
    words = storage.written(met.select("digest", "met", F.monotonically_increasing_id().alias("number")), "turn-dictionary")
    total = rows.count()
    often = words.where(F.col("met") * HOT >= F.greatest(F.lit(total), F.lit(HOT * 16))).select("digest", "number")
    # at most HOT rows by their share; all others are met too seldom to make a task of the join heavy
    hot = rows.join(F.broadcast(often), "digest")
    cool = rows.join(F.broadcast(often.select("digest")), "digest", "left_anti").join(
        words.select("digest", "number"), "digest")
    every = hot.unionByName(cool)
    turns = F.sort_array(F.collect_list(F.struct("turn", "digest", "number", "chars")))
    return (every.groupBy("conv_id").agg(turns.alias("t"))
            .select("conv_id", F.col("t.number").alias("turns"), F.col("t.chars").alias("chars")))


def shared_starts(own: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """``own`` (of :func:`sequences`) with the first ``crc32(id) % most`` turns of each conversation replaced by those of the
    conversation whose id is the next lower multiple of ``every``."""
    own = storage.written(own, "sequences")
    head = F.crc32(F.col("conv_id").cast("string")) % most
    heads = own.where(F.col("conv_id") % every == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("b_turns"), F.slice("chars", 1, most).alias("b_chars"))
    rows = own.withColumn("head", head.cast("int")).withColumn("base", F.col("conv_id") - F.col("conv_id") % every)

    def rebuilt(name: str):
        start = F.coalesce(F.slice(f"b_{name}", F.lit(1), F.col("head")), F.slice(name, F.lit(1), F.lit(0)))
        return F.concat(start, F.slice(name, F.col("head") + 1, F.greatest(F.size(name), F.lit(1)))).alias(name)

    return rows.join(heads, "base", "left").select("conv_id", rebuilt("turns"), rebuilt("chars"))


def nodes(paths: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row a node of the trie of ``paths`` (``conv_id, turns, chars``, ids unique)."""
    spark = paths.sparkSession

    def build(batches):
        yield from _batches(_shards(batches, TaskContext.get().partitionId(), shard_turns))

    ordered = paths.repartitionByRange(storage.shards(spark), "turns", "conv_id").sortWithinPartitions("turns", "conv_id")
    found = storage.written(ordered.mapInArrow(build, _SPARK), "trie-shards")
    border = found.where("kind = 'border'")
    total = lambda *names: [F.sum(n).alias(n) for n in names]
    place = F.struct("shard", "chain")
    merged = border.groupBy("key").agg(
        F.min("depth").alias("depth"), F.min("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"),
        F.min(place).alias("owner"), *total("n_convs", "n_children", "n_leaves", "saved_tokens"))
    merged = storage.written(merged, "trie-border")
    branches = merged.where(F.col("parent_key").isNotNull()).groupBy(F.col("parent_key").alias("key")).agg(
        F.count("*").alias("more"))
    merged = storage.written(merged.join(branches, "key", "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more"), "trie-branches")
    # what counts once a node is counted in its owner's path and handed up along it
    owned = border.select("shard", "chain", "depth", "key", "chars").join(
        merged.select("key", "owner", (F.col("n_children") == 0).cast("bigint").alias("leaf")), "key")
    mine = F.col("owner") == place
    below = Window.partitionBy("shard", "chain").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    handed = (owned.withColumn("leaf", F.when(mine, F.col("leaf")).otherwise(0))
              .withColumn("kept", F.when(mine, F.col("chars")).otherwise(0))
              .select("key", F.sum("leaf").over(below).alias("leaf"), F.sum("kept").over(below).alias("kept"))
              .groupBy("key").agg(*total("leaf", "kept")))
    listed = found.where("kind = 'ids'").select("key", "first_id", "ids")
    ends = listed.repartition(storage.shards(spark), "key").sortWithinPartitions("key", "first_id").mapInArrow(
        _list_digests, "key binary, ends_sha256 string")
    top = storage.written(
        merged.join(handed, "key").join(ends, "key", "left").select(
            "key", "parent_key", "depth", "conv_id", "n_convs", "n_children", (F.col("n_leaves") + F.col("leaf")).alias("n_leaves"),
            (F.col("saved_tokens") - F.col("kept")).alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(NO_IDS)).alias("ends_sha256")), "trie-top")
    known = top.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("up"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    upper = top.join(known, "parent_key", "left").withColumn("parent_conv_id", F.col("up"))
    inner = found.where("kind = 'node'")
    # a boundary node's children are looked up shard by shard, so the root's many children meet in no one task
    in_shard = border.select("shard", F.col("key").alias("parent_key")).distinct().join(known, "parent_key")
    hanging = (inner.where(F.col("parent_key").isNotNull()).drop("parent_conv_id")
               .join(in_shard, ["shard", "parent_key"]).withColumn("parent_conv_id", F.col("up")))
    return (upper.select(*columns).unionByName(hanging.select(*columns))
            .unionByName(inner.where(F.col("parent_key").isNull()).select(*columns)))


def _list_digests(batches):
    """Digests of the comma-joined pieces of each key, read in order."""
    key, state, done = None, None, []

    def out():
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in done], pa.binary()), pa.array([d for _, d in done], pa.string())], ["key", "ends_sha256"])

    for batch in batches:
        for now, piece in zip(batch["key"].to_pylist(), batch["ids"].to_pylist()):
            if now != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = now, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        if len(done) >= ROWS:
            yield out()
            done = []
    if state is not None:
        done.append((key, state.hexdigest()))
    yield out()


def trie(conversations: DataFrame, shared_every: int = 100, shared_most: int = 6, shard_turns: int = SHARD_TURNS,
         **columns) -> DataFrame:
    """The nodes of the prefix trie of all conversations, rebuilt on their shared starts."""
    return nodes(shared_starts(sequences(conversations, **columns), shared_every, shared_most), shard_turns)
