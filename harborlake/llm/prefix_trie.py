"""The trie of conversation prefixes, as a burst trie over sorted containers.

A turn is known by a fingerprint of its role and text (128 bits), a conversation by the fingerprints of its turns in order, which
compare as bytes. Equal conversations are one sequence with several members. Then

* sequences stand in containers under trie heads, at first all of them under the root. A container of more than ``limit`` sequences
  bursts: its head becomes a node of the upper trie, and its sequences move to containers by their next turn. Each round counts several
  levels at once, only in containers that are still too large, with map-side sums, until none is. ``limit`` grows with the input so
  that there are at most ``MOST_HEADS`` heads; these alone are known to all tasks and to the driver;
* containers are dealt out, sorted by sequence, and swept: a node is opened where a sequence leaves the one before it and closed
  when no later one shares it, with all sums of its subtree known by then. A task holds the nodes of one container at a time;
* the upper trie is put together from the sums of containers and of conversations that end at a head.

The members that end at a node are sorted over the whole cluster, packed into texts of at most ``PACK`` members, and digested from
these, so a conversation that a third of all rows repeat is a few rows of the task that digests it, and never in memory at once.

Turns are ordered by ``turn``, missing ones first, then by fingerprint, so repeated rows are turns of their own and ties do not depend
on partitions. A missing role or text is empty; rows without a conv_id belong to no conversation and are left out. Texts, however
long, never leave the task that reads them; of a conversation, 24 bytes a turn stand in one row. An empty table has no nodes, not
even a root; columns besides conv_id, turn, role and text are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain, groupby
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from harborlake.llm.common import stored

TURN = 16  # bytes of a turn's fingerprint
LIMIT = 256  # sequences of a container, at least
MOST_HEADS = 50_000  # of the upper trie: heads of one level hold different sequences, more than the limit each
LEVELS = 4  # that are counted in the first round; twice as many in each further one
PACK = 65_536
NOTHING = hashlib.sha256(b"").hexdigest()

_PREFIX = [("node", pa.binary()), ("parent", pa.binary()), ("depth", pa.int64()), ("chars", pa.int64())]
_PACK = [("sequence", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string())]
_MEMBERS = [("sequence", pa.binary()), ("n_members", pa.int64()), ("conv_id", pa.int64()), ("ends_sha256", pa.string())]
_NODE = [
    ("parent", pa.binary()),  # the head above the root of a container, else null
    *[(c, pa.int64()) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
    ("ends_sha256", pa.string()),
]
_SEQUENCE = "turns binary, chars binary, n_members long, conv_id long, ends_sha256 string"
_SQL = {pa.binary(): "binary", pa.int64(): "long", pa.string(): "string"}


def _ddl(columns: list[tuple]) -> str:
    return ", ".join(f"{name} {_SQL[kind]}" for name, kind in columns)


def _batch(rows: list, columns: list[tuple]) -> pa.RecordBatch:
    by_column = zip(*rows) if rows else [[] for _ in columns]
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, kind) in zip(by_column, columns)], [name for name, _ in columns])


def head_of(turns: bytes) -> bytes:
    """The name of the node that the turns lead to."""
    return hashlib.blake2b(turns, digest_size=16).digest()


def sequences(conversations: DataFrame, *, shared_turns: Column | None = None, most: int = 5, share: int = 100) -> DataFrame:
    """(conv_id, turns binary, chars binary): fingerprints and lengths of the turns of each conversation, in order.

    With ``shared_turns``, that many first turns (``most`` at most) are taken from the conversation whose conv_id is the next multiple of ``share``
    below (all it has if it has fewer, none if there is no such conversation), and follow on with the conversation's own turns
    after as many. Conversations of one multiple are dealt out together, so this needs no join.
    """
    text, role = (F.coalesce(F.col(c), F.lit("")) for c in ("text", "role"))
    marked = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.xxhash64(role, text).alias("a"),
            F.xxhash64(F.lit("turn"), text, role).alias("b"),
            F.char_length(text).alias("n"),
        ).alias("turn"),
    )
    origin = F.col("conv_id") - F.pmod("conv_id", F.lit(share))
    by = marked.withColumn("origin", origin).repartition("origin")
    whole = by.groupBy("origin", "conv_id").agg(F.array_sort(F.collect_list("turn")).alias("own"))
    if shared_turns is not None:
        given = F.max(F.when(F.col("conv_id") == F.col("origin"), F.slice("own", 1, most))).over(Window.partitionBy("origin"))
        whole = whole.withColumn("given", given).withColumn("h", shared_turns.cast("int"))
        none = F.slice("own", 1, 0)
        first = F.when(F.col("given").isNotNull(), F.slice("given", F.lit(1), F.col("h"))).otherwise(none)
        own = F.slice("own", F.col("h") + 1, F.greatest(F.size("own") - F.col("h"), F.lit(0)))
        whole = whole.select("conv_id", F.concat(first, own).alias("own"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("own")
            ends = np.cumsum(pa.compute.list_value_length(column).to_numpy(zero_copy_only=False))
            turns = column.flatten()
            prints = np.stack([turns.field(c).to_numpy(zero_copy_only=False) for c in ("a", "b")], axis=1).astype(">i8")
            chars = turns.field("n").to_numpy(zero_copy_only=False).astype("<i8")
            cuts = list(zip([0, *ends[:-1]], ends))
            columns = [[x[i:j].tobytes() for i, j in cuts] for x in (prints, chars)]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *[pa.array(c, pa.binary()) for c in columns]], ["conv_id", "turns", "chars"])

    return whole.select("conv_id", "own").mapInArrow(packed, "conv_id long, turns binary, chars binary")


def _packs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (sequence, conv_id) in order; ids of one sequence that follow each other become one text."""
    sequence, ids, done = None, [], []
    for batch in batches:
        for found, conv_id in zip(batch.column("sequence").to_pylist(), batch.column("conv_id").to_pylist()):
            if found != sequence or len(ids) == PACK:
                if ids:
                    done.append((sequence, ids[0], len(ids), ",".join(map(str, ids))))
                sequence, ids = found, []
            ids.append(conv_id)
        yield _batch(done, _PACK)
        done = []
    if ids:
        yield _batch([(sequence, ids[0], len(ids), ",".join(map(str, ids)))], _PACK)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs in order to one row per sequence: members, smallest conv_id, digest of all ids."""
    sequence, state, n, smallest, done = None, None, 0, 0, []
    for batch in batches:
        for found, first, count, ids in zip(*(batch.column(c).to_pylist() for c, _ in _PACK)):
            if found == sequence:
                state.update(b"," + ids.encode())
                n += count
                continue
            if sequence is not None:
                done.append((sequence, n, smallest, state.hexdigest()))
            sequence, state, n, smallest = found, hashlib.sha256(ids.encode()), count, first
        yield _batch(done, _MEMBERS)
        done = []
    if sequence is not None:
        yield _batch([(sequence, n, smallest, state.hexdigest())], _MEMBERS)


def distinct_sequences(rebuilt: DataFrame) -> DataFrame:
    """(turns, chars, n_members, conv_id, ends_sha256) per distinct sequence of turns."""
    # A hash orders sequences of any length as well as they would themselves.
    named = rebuilt.select(F.unhex(F.md5("turns")).alias("sequence"), "conv_id")
    packs = named.repartitionByRange("sequence", "conv_id").sortWithinPartitions("sequence", "conv_id").mapInArrow(
        _packs, _ddl(_PACK)
    )
    members = packs.repartition("sequence").sortWithinPartitions("sequence", "first").mapInArrow(
        _digested, _ddl(_MEMBERS)
    )
    return rebuilt.join(members.drop("sequence"), "conv_id").select("turns", "chars", "n_members", "conv_id", "ends_sha256")


class Head(NamedTuple):
    """Where a node of the upper trie stands, and how many characters its last turn has."""

    depth: int
    parent: bytes | None
    chars: int


def burst(found: DataFrame, limit: int) -> dict[bytes, Head]:
    """Heads whose containers burst: nodes through which more than ``limit`` sequences go, and the root.

    Their number is bounded by the sum of all lengths over ``limit``.
    """
    heads, level, levels = {head_of(b""): Head(0, None, 0)}, 0, LEVELS
    newest = set(heads)
    while newest:

        def prefixes(batches: Iterator[pa.RecordBatch], level=level, levels=levels, newest=newest) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for turns, chars in zip(batch.column("turns").to_pylist(), batch.column("chars").to_pylist()):
                    parent, depth = head_of(turns[: level * TURN]), len(turns) // TURN
                    if depth <= level or parent not in newest:
                        continue
                    state, sizes = hashlib.blake2b(turns[: level * TURN], digest_size=16), np.frombuffer(chars, "<i8")
                    for at in range(level, min(level + levels, depth)):
                        state.update(turns[at * TURN : at * TURN + TURN])
                        node = state.copy().digest()
                        out.append((node, parent, at + 1, int(sizes[at])))
                        parent = node
                yield _batch(out, _PREFIX)

        columns = [name for name, _ in _PREFIX]
        counted = found.select("turns", "chars").mapInArrow(prefixes, _ddl(_PREFIX)).groupBy(*columns).agg(F.count("*").alias("n"))
        large = counted.where(F.col("n") > limit).collect()  # on each level, fewer than there are sequences / limit
        heads |= {bytes(r.node): Head(r.depth, bytes(r.parent), r.chars) for r in large}
        level += levels
        levels *= 2
        newest = {bytes(r.node) for r in large if r.depth == level}
    return heads


def contained(found: DataFrame, heads: dict[bytes, Head]) -> DataFrame:
    """Sequences with the head below which they stand, its depth, and their container: the node of the next turn, null where they end at the head."""
    names = set(heads)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for turns in batch.column("turns").to_pylist():
                state, head, node, at = hashlib.blake2b(digest_size=16), None, head_of(b""), 0
                while node in names:
                    head, node = node, None
                    if at == len(turns):
                        break
                    state.update(turns[at : at + TURN])
                    node, at = state.copy().digest(), at + TURN
                out.append((head, heads[head].depth, node))
            placed = _batch(out, [("head", pa.binary()), ("above", pa.int64()), ("container", pa.binary())])
            yield pa.RecordBatch.from_arrays([*placed.columns, *batch.columns], [*placed.schema.names, *batch.schema.names])

    return found.mapInArrow(assigned, f"head binary, above long, container binary, {_SEQUENCE}")


class Open:
    """A node whose subtree is being read."""

    __slots__ = ("below", "chars", "conv_id", "depth", "ends", "n_children", "n_convs", "n_leaves", "saved")

    def __init__(self, depth: int, chars: int):
        self.depth, self.chars, self.conv_id, self.ends = depth, chars, None, NOTHING
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.below: list[int] = []  # rows of the children, which get their parent's conv_id from it

    def take(self, conv_id: int, n_convs: int) -> None:
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)
        self.n_convs += n_convs

    def close(self, up: Open | None) -> None:
        """Complete the sums of a node without further children, and add them to its parent's."""
        self.saved += (self.n_convs - 1) * self.chars
        self.n_leaves = self.n_leaves if self.n_children else 1
        if up is not None:
            up.take(self.conv_id, self.n_convs)
            up.n_children += 1
            up.n_leaves += self.n_leaves
            up.saved += self.saved

    def row(self, parent: bytes | None) -> list:
        return [parent, self.conv_id, self.depth, None, self.n_convs, self.n_children, self.n_leaves, self.saved, self.ends]


def sweep(sequences_of_one: Iterator[tuple], head: bytes, above: int) -> list[list]:
    """Nodes of one container below ``head`` from its sorted (turns, chars, n_members, conv_id, ends_sha256)."""
    rows: list[list] = []
    stack: list[Open] = []
    before = b""

    def close(depth: int) -> None:
        while stack and stack[-1].depth > depth:
            node = stack.pop()
            node.close(stack[-1] if stack else None)
            for at in node.below:
                rows[at][3] = node.conv_id
            if stack:
                stack[-1].below.append(len(rows))
            rows.append(node.row(None if stack else head))

    for turns, chars, n_members, conv_id, ends in sequences_of_one:
        common = above
        while common * TURN < len(before) and before[common * TURN : common * TURN + TURN] == turns[common * TURN : common * TURN + TURN]:
            common += 1
        close(common)
        sizes = np.frombuffer(chars, "<i8")
        stack.extend(Open(depth + 1, int(sizes[depth])) for depth in range(common, len(sizes)))
        stack[-1].take(conv_id, n_members)
        stack[-1].ends = ends
        before = turns
    close(above)
    return rows


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ("container", "head", "above", "turns", "chars", "n_members", "conv_id", "ends_sha256")
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns)))
    done: list[list] = []
    for _, group in groupby(rows, key=lambda row: row[:3]):
        first = next(group)
        done += sweep((row[3:] for row in chain([first], group)), first[1], first[2])
        if len(done) >= 4096:
            yield _batch(done, _NODE)
            done = []
    if done:
        yield _batch(done, _NODE)


def upper_trie(heads: dict[bytes, Head], below: list, ends: list) -> list[list]:
    """Nodes of the heads, given sums of the containers below each, and what ends at them."""
    nodes = {name: Open(head.depth, head.chars) for name, head in heads.items()}
    for r in below:
        node = nodes[bytes(r.parent)]
        node.take(r.conv_id, r.n_convs)
        node.n_children, node.n_leaves, node.saved = r.n_children, r.n_leaves, r.saved_tokens
    for r in ends:
        node = nodes[bytes(r.head)]
        node.take(r.conv_id, r.n_members)
        node.ends = r.ends_sha256
    rows = {}
    for name in sorted(nodes, key=lambda name: -heads[name].depth):
        nodes[name].close(nodes.get(heads[name].parent))
    for name, node in nodes.items():
        rows[name] = [name, *node.row(None)[1:]]
        parent = nodes.get(heads[name].parent)
        rows[name][3] = parent.conv_id if parent else None
    return list(rows.values())


def prefix_trie(rebuilt: DataFrame, *, limit: int = LIMIT) -> DataFrame:
    """One row per node of the trie of all sequences (conv_id, turns, chars), see ``sequences``.

    conv_id is the smallest member, n_convs counts members, n_leaves childless nodes of the subtree, saved_tokens sums
    (n_convs - 1) times the characters of the last turn over the subtree, ends_sha256 digests the conv_ids that end there.
    """
    found = stored(distinct_sequences(stored(rebuilt, "conversations")), "sequences")
    total = found.agg(F.sum(F.octet_length("turns"))).first()[0]
    if total is None:
        return found.sparkSession.createDataFrame([], _ddl(_NODE)).drop("parent")
    heads = burst(found, max(limit, -(-total // TURN // MOST_HEADS)))
    placed = stored(contained(found, heads), "containers")
    ordered = placed.where("container is not null").repartition("container").sortWithinPartitions("container", "turns")
    nodes = stored(ordered.mapInArrow(_swept, _ddl(_NODE)), "nodes")
    below = nodes.where("parent is not null").groupBy("parent").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "saved_tokens")], F.count("*").alias("n_children")
    )
    ends = placed.where("container is null").select("head", "n_members", "conv_id", "ends_sha256")
    upper = found.sparkSession.createDataFrame(upper_trie(heads, below.collect(), ends.collect()), _ddl(_NODE))  # one row a head
    of = F.broadcast(upper.select(F.col("parent"), F.col("conv_id").alias("of")))
    nodes = nodes.join(of, "parent", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of")).drop("of")
    return nodes.unionByName(upper).drop("parent")
