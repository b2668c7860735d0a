"""The prefix trie of conversations: ternary search trees per range shard, boundary nodes merged afterwards."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from callflow.llm.shared import cells_for, importable
from callflow.session import written

#: A turn in a sequence: 16 bytes of its digest and 4 of the length of its text, big-endian.
UNIT = 20
#: Turns of different sequences in one shard, about.
SHARD_TURNS = 1 << 17
#: Ids of one group of copies that are written together, at most.
ENDS = 1 << 16


def key_of(data: bytes) -> bytes:
    return hashlib.sha256(data).digest()[:16]


def turn_units(role: Column, text: Column) -> Column:
    """A turn as 20 bytes; null is the empty string."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    return F.unhex(F.concat(F.substring(F.sha2(whole, 256), 1, 32), F.lpad(F.hex(F.length(text)), 8, "0")))


def _rebuild(family: int, most: int):
    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, head, now, own, held, size = None, b"", None, bytearray(), [], 0

        def done():
            nonlocal base, head
            first = now - now % family if now >= 0 else now + -now % family
            if first != base:
                base, head = first, b""
            if now == base:
                head = bytes(own[: most * UNIT])
            cut = UNIT * (zlib.crc32(str(now).encode()) % (most + 1))
            whole = head[:cut] + own[cut:]
            own.clear()
            return now, whole

        def flushed():
            nonlocal size
            ids, data = [c for c, _ in held], [s for _, s in held]
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([key_of(s) for s in data], pa.binary()), pa.array(data, pa.binary())],
                names=["conv_id", "key", "sequence"],
            )

        for batch in batches:
            for conversation, unit in zip(batch["conv_id"].to_pylist(), batch["unit"].to_pylist(), strict=True):
                if conversation != now:
                    if now is not None:
                        held.append(done())
                        size += len(held[-1][1])
                        if size > 1 << 22 or len(held) > 1 << 13:
                            yield flushed()
                    now = conversation
                own.extend(unit)
        if now is not None:
            held.append(done())
            yield flushed()

    return rebuild


def rebuilt(conversations: DataFrame, family: int = 100, most: int = 5) -> DataFrame:
    """``(conv_id, key, sequence)`` of every conversation: up to ``most`` turns of the conversation at
    the round id below it (``conv_id - conv_id % family``), as many as a crc32 of its id tells, then
    its own turns after as many.

    Turns go by ``turn`` (null first), equal ones by their digest. A family has at most ``family``
    ids; its turns meet in one task, sorted by Spark, and pass through it one conversation at a time.
    Rows without conv_id belong to no conversation.
    """
    importable(conversations.sparkSession)
    c = F.col("conv_id")
    base = c - c % family
    turns = conversations.where("conv_id IS NOT NULL").select(
        base.alias("base"),
        (c != base).alias("later"),
        c.cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        turn_units(F.col("role"), F.col("text")).alias("unit"),
    )
    ordered = turns.repartition("base").sortWithinPartitions(
        "base", "later", "conv_id", F.col("turn").asc_nulls_first(), "unit"
    )
    return ordered.select("conv_id", "unit").mapInArrow(
        _rebuild(family, most), "conv_id long, key binary, sequence binary"
    )


def _chunks(most: int):
    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        now, ids, out = None, [], []

        def flushed():
            nonlocal out
            columns = list(zip(*out, strict=True))
            out = []
            kinds = [pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=["key", "part", "number", "first", "n", "ids"],
            )

        for batch in batches:
            for key, conversation in zip(batch["key"].to_pylist(), batch["conv_id"].to_pylist(), strict=True):
                if key != now or len(ids) == most:
                    if ids:
                        out.append((now, part, number, ids[0], len(ids), ",".join(map(str, ids)).encode()))
                        number += 1
                    now, ids = key, []
                    if len(out) == 1 << 10:
                        yield flushed()
                ids.append(conversation)
            if len(out) > 16:
                yield flushed()
        if ids:
            out.append((now, part, number, ids[0], len(ids), ",".join(map(str, ids)).encode()))
        if out:
            yield flushed()

    return chunks


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, digest, first, n = None, None, None, 0
    for batch in batches:
        out = []
        columns = (batch[c].to_pylist() for c in ("key", "first", "n", "ids"))
        for key, least, many, ids in zip(*columns, strict=True):
            if key != now:
                if now is not None:
                    out.append((now, first, n, digest.hexdigest()))
                now, digest, first, n = key, hashlib.sha256(), least, 0
            else:
                digest.update(b",")
            digest.update(ids)
            n += many
        if out:
            yield _groups(out)
    if now is not None:
        yield _groups([(now, first, n, digest.hexdigest())])


def _groups(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.binary(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["key", "first", "n", "ends"],
    )


def copies(sequences: DataFrame) -> DataFrame:
    """``(key, first, n, ends)`` of each distinct sequence: its smallest conversation, how many have
    it, and the sha256 of their ids in order.

    Ids are sorted over ranges of (key, id) and joined to strings there, so that a sequence which
    a third of all conversations share is spread; one task then reads its strings in order, a few at a time.
    """
    members = sequences.select("key", "conv_id")
    ranged = members.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    chunks = ranged.mapInArrow(_chunks(ENDS), "key binary, part int, number long, first long, n long, ids binary")
    ordered = chunks.repartition("key").sortWithinPartitions("key", "part", "number")
    return ordered.select("key", "first", "n", "ids").mapInArrow(_hashed, "key binary, first long, n long, ends string")


class TernaryTree:
    """A ternary search tree over sequences of small integers; node 0 is the trie's root.

    ``symbol[v]`` is the last integer of node v's prefix; ``low`` and ``high`` lead to its sisters,
    ``down`` to the first of its children that was met. A node's parent has a smaller number.
    """

    def __init__(self):
        self.symbol, self.low, self.high, self.down = [-1], [0], [0], [0]
        self.parent, self.depth = [0], [0]

    def _new(self, symbol: int, parent: int) -> int:
        self.symbol.append(symbol)
        self.low.append(0)
        self.high.append(0)
        self.down.append(0)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        return len(self.symbol) - 1

    def insert(self, sequence: list[int]) -> int:
        """The node of a sequence, with those on the way to it."""
        symbols, low, high, down = self.symbol, self.low, self.high, self.down
        at = 0
        for symbol in sequence:
            v = down[at]
            if not v:
                v = down[at] = self._new(symbol, at)
            while (other := symbols[v]) != symbol:
                side = low if symbol < other else high
                if not side[v]:
                    side[v] = self._new(symbol, at)
                v = side[v]
            at = v
        return at

    def find(self, sequence: list[int]) -> list[int]:
        """The nodes of a sequence that was inserted, from the root down."""
        out = [0]
        for symbol in sequence:
            v = self.down[out[-1]]
            while self.symbol[v] != symbol:
                v = self.low[v] if symbol < self.symbol[v] else self.high[v]
            out.append(v)
        return out


def median_order(n: int) -> Iterator[int]:
    """0..n-1, the middle first and then the middles of both halves, so that sorted input grows balanced trees."""
    spans = [(0, n)]
    for low, high in spans:
        if low < high:
            middle = (low + high) // 2
            yield middle
            spans += [(low, middle), (middle + 1, high)]


NODES = (
    "part int, open boolean, key binary, parent_key binary, depth long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, tokens long, ends string"
)


def _shard(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part = TaskContext.get().partitionId()
    data, first, n, ends = [], [], [], []
    for batch in batches:
        for name, into in (("sequence", data), ("first", first), ("n", n), ("ends", ends)):
            into += batch[name].to_pylist()
    if not data:
        return
    units = np.frombuffer(b"".join(data), f"S{UNIT}") if any(data) else np.empty(0, f"S{UNIT}")
    # Codes of the shard's turns, in the order of their bytes.
    dictionary, codes = np.unique(units.view(f"V{UNIT}"), return_inverse=True)
    tokens = np.frombuffer(dictionary.tobytes(), np.uint8).reshape(-1, UNIT)[:, 16:].copy().view(">u4").ravel().tolist()
    bounds = np.cumsum([0, *(len(s) // UNIT for s in data)]).tolist()
    codes = codes.tolist()
    tree, ended = TernaryTree(), {}
    for k in median_order(len(data)):
        ended[tree.insert(codes[bounds[k] : bounds[k + 1]])] = k
    size = len(tree.symbol)
    # Nodes on the way to the first and the last sequence may have members in other shards.
    keys: list[bytes | None] = [None] * size
    for k in {0, len(data) - 1}:
        digest = hashlib.sha256()
        for j, v in enumerate(tree.find(codes[bounds[k] : bounds[k + 1]])):
            if j:
                digest.update(data[k][UNIT * (j - 1) : UNIT * j])
            keys[v] = digest.digest()[:16]
    members, least = [0] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    length = [0] + [tokens[s] for s in tree.symbol[1:]]
    parent = tree.parent
    for v in range(size - 1, -1, -1):  # every child before its parent
        if v in ended:
            k = ended[v]
            members[v] += n[k]
            if least[v] is None or first[k] < least[v]:
                least[v] = first[k]
        up, shut = parent[v], keys[v] is None
        if shut:
            if not children[v]:
                leaves[v] = 1
            saved[v] += (members[v] - 1) * length[v]
        if v:
            members[up] += members[v]
            if least[up] is None or least[v] < least[up]:
                least[up] = least[v]
            if shut:  # what open nodes add to others is only known when all shards are
                children[up] += 1
                leaves[up] += leaves[v]
                saved[up] += saved[v]
    empty = hashlib.sha256().hexdigest()
    for begin in range(0, size, 1 << 14):
        some = range(begin, min(size, begin + (1 << 14)))
        columns = [
            [part] * len(some),
            [keys[v] is not None for v in some],
            [keys[v] for v in some],
            [keys[parent[v]] if v else None for v in some],
            [tree.depth[v] for v in some],
            [least[v] for v in some],
            [least[parent[v]] if v and keys[parent[v]] is None else None for v in some],
            [members[v] for v in some],
            [children[v] for v in some],
            [leaves[v] for v in some],
            [saved[v] for v in some],
            [length[v] for v in some],
            [ends[ended[v]] if v in ended else (empty if keys[v] is None else None) for v in some],
        ]
        kinds = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), *[pa.int64()] * 8, pa.string()]
        names = [field.split()[0] for field in NODES.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _merged(nodes: DataFrame) -> DataFrame:
    """The open nodes of all shards, one row each, whole: sums of the shards' closed parts, then sums
    over the open nodes below by pointer jumping, in as many rounds as the depth has binary digits."""
    one = nodes.where("open").groupBy("key").agg(
        F.first("parent_key").alias("parent_key"),
        F.first("depth").alias("depth"),
        F.min("conv_id").alias("conv_id"),
        F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"),
        F.sum("n_leaves").alias("n_leaves"),
        F.sum("saved_tokens").alias("saved_tokens"),
        F.first("tokens").alias("tokens"),
        F.max("ends").alias("ends"),
    )
    one = written(one, "open")
    below = one.groupBy(F.col("parent_key").alias("_up")).agg(F.count(F.lit(1)).alias("_open"))
    one = one.join(below, F.col("key") == F.col("_up"), "left").withColumn(
        "n_children", F.col("n_children") + F.coalesce("_open", F.lit(0))
    )
    one = written(
        one.select(
            "key", "parent_key", "depth", "conv_id", "n_convs", "n_children", "ends",
            (F.col("n_leaves") + (F.col("n_children") == 0).cast("long")).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("tokens")).alias("saved_tokens"),
        ),
        "open",
    )
    deepest = one.agg(F.max("depth")).first()[0] or 0
    sums = one.select("key", F.col("parent_key").alias("jump"), "depth", "n_leaves", "saved_tokens")
    reach = 1
    while reach <= deepest:
        # Each node holds the sums of those below it at less than ``reach``; ``jump`` is ``reach`` above.
        arrived = sums.where("jump IS NOT NULL").groupBy(F.col("jump").alias("_at")).agg(
            F.sum("n_leaves").alias("_leaves"), F.sum("saved_tokens").alias("_saved")
        )
        further = sums.where(F.col("jump").isNotNull() & (F.col("depth") >= 2 * reach))
        stops = sums.select(F.col("key").alias("_stop"), F.col("jump").alias("_next"))
        jumps = further.join(stops, F.col("jump") == F.col("_stop")).select(F.col("key").alias("_from"), "_next")
        sums = written(
            sums.join(arrived, F.col("key") == F.col("_at"), "left")
            .join(jumps, F.col("key") == F.col("_from"), "left")
            .select(
                "key",
                F.col("_next").alias("jump"),
                "depth",
                (F.col("n_leaves") + F.coalesce("_leaves", F.lit(0))).alias("n_leaves"),
                (F.col("saved_tokens") + F.coalesce("_saved", F.lit(0))).alias("saved_tokens"),
            ),
            "sums",
        )
        reach *= 2
    whole = one.drop("n_leaves", "saved_tokens").join(sums.select("key", "n_leaves", "saved_tokens"), "key")
    return written(whole, "merged")


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def trie_nodes(sequences: DataFrame) -> DataFrame:
    """The nodes of the trie of ``sequences(conv_id, key, sequence)``, a table of units of 20 bytes by conversation.

    Equal sequences are counted before anything else. Distinct ones, sorted by their bytes, are dealt
    to shards of some 131 thousand turns; a task codes its shard's turns by their order, grows a
    ternary search tree by inserting medians first, and sums members, leaves and savings from the
    last node to the first. The nodes on the way to a shard's first and last sequence, which other
    shards may share, are open: their sums leave out each other, and are merged over all shards. A
    closed node below an open one takes its parent's smallest member from there, by (shard, key).
    """
    spark = sequences.sparkSession
    counted = written(copies(sequences), "copies")
    held = sequences.select("conv_id", "sequence")
    distinct = counted.join(held, F.col("first") == F.col("conv_id")).select("sequence", "first", "n", "ends")
    distinct = written(distinct, "distinct")
    turns = distinct.agg(F.sum(F.octet_length("sequence") + UNIT)).first()[0] or 0
    shards = cells_for(int(turns) // UNIT, SHARD_TURNS)
    dealt = distinct.repartitionByRange(shards, "sequence").sortWithinPartitions("sequence")
    importable(spark)
    nodes = written(dealt.mapInArrow(_shard, NODES), "nodes")
    merged = _merged(nodes)
    names = merged.select(F.col("key").alias("_key"), F.col("conv_id").alias("_parent"))
    copied = nodes.where("open").select("part", F.col("key").alias("_key")).join(names, "_key")
    shut = nodes.where("NOT open")
    inner = shut.where("parent_key IS NULL")
    outer = shut.where("parent_key IS NOT NULL").alias("o").join(
        copied.withColumnRenamed("part", "_part"),
        (F.col("part") == F.col("_part")) & (F.col("parent_key") == F.col("_key")),
    )
    outer = outer.withColumn("parent_conv_id", F.col("_parent"))
    opened = merged.join(names, F.col("parent_key") == F.col("_key"), "left").withColumn("parent_conv_id", F.col("_parent"))
    empty = F.lit(hashlib.sha256().hexdigest())
    tables = [t.withColumn("ends_sha256", F.coalesce("ends", empty)).select(*RESULT) for t in (inner, outer, opened)]
    return tables[0].unionByName(tables[1]).unionByName(tables[2])


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations (see ``rebuilt``), the empty one included.

    conv_id (the smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves (childless
    nodes at or below), saved_tokens (code points that sharing the prefix saves, at or below) and
    ends_sha256 (of the ids of the conversations that end here). Null roles and texts are empty, a
    null turn is first, equal turn numbers go by digest, repeated rows are turns of their own, rows
    without conv_id are left out; other columns are not read. No conversations give no rows. A
    conversation passes through one task as 20 bytes a turn, whatever its texts' lengths.
    """
    return trie_nodes(written(rebuilt(conversations), "rebuilt"))
