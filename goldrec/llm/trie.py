"""Prefix trie of conversations by truncation peeling.

A conversation is a path: one 16-byte digest for each turn, one after another. Conversations that
are equal in full are one path with a count. Paths are sorted, so everything below a node stands
together, and a task peels what it holds: it descends along a path to its deepest node, and when
the next path leaves that branch it strips the last turn, merges the node into the one above, with
conversations that end there, and goes on stripping up to the turn that both paths share. A node is
found, counted and summed over its subtree when it is stripped, in the same pass.

The paths are dealt to tasks by ranges, so a first turn that a third of all conversations share is
spread. Only prefixes of the first and last path of a task can have more rows elsewhere. Such nodes
survive with what was merged into them and are grouped by path and peeled again, by fewer tasks in
each round and by one in the last: a round leaves at most two paths a task. Rounds don't grow with
the depth of the trie.

Turns are ordered by number, null first, ties by the digest of role and text. Null roles and texts
are empty. Rows without conv_id belong to no conversation and take no part. Repeated rows are turns
like any other. Other columns are ignored. An empty table has no nodes, not even a root. A very
long text costs its digest only; a conversation is one row of 16 bytes a turn. Node ids and turns are
compared by SHA-256 (turns by 128 bits of it).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import written

WIDTH = 16
#: Conversation ids whose members are joined to one piece of text; paths of a task, at least and at most.
CHUNK, FEWEST, MOST = 4_096, 4_096, 500_000
SHARED, FAMILY = 9, 5

NODE = "node string, parent string, depth long, conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends string"
PATH = "path binary, sizes array<long>, convs long, least long, children long, leaves long, saved long, ends string"


def own_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order: array of (key, bytes)."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    marked = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    key = F.substring(F.sha2(marked, 256), 1, 2 * WIDTH)
    turn = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn", key.alias("key"),
                    F.octet_length(text).cast("long").alias("bytes"))
    return (
        conversations.where("conv_id is not null")
        .groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        .select("conv_id", F.transform("turns", lambda t: F.struct(t["key"], t["bytes"])).alias("turns"))
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Every conversation, its first turns replaced by those of the first one of its family of five."""
    own = own_turns(conversations)
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("family"), F.slice("turns", 1, SHARED - 1).alias("head"))
    shared = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")
    head = F.coalesce(F.slice("head", 1, shared), F.filter("turns", lambda _: F.lit(False)))
    tail = F.slice("turns", shared + 1, F.greatest(F.size("turns") - shared, F.lit(0)))
    return own.join(heads, family == heads.family, "left").select("conv_id", F.concat(head, tail).alias("turns"))


def member_digests(members: DataFrame) -> DataFrame:
    """path_id and the SHA-256 of its conv_ids, ascending and comma-joined.

    Ids are joined for each range of CHUNK ids first, in many tasks for a path with many members;
    the pieces are then hashed one after another, without holding them together.
    """
    pieces = members.groupBy("path_id", F.floor(F.col("conv_id") / CHUNK).alias("place")).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, digest = None, None
        for batch in batches:
            names, digests = [], []
            for p, ids in zip(batch.column("path_id").to_pylist(), batch.column("ids").to_pylist()):
                if p != path:
                    if path is not None:
                        names.append(path)
                        digests.append(digest.hexdigest())
                    path, digest = p, hashlib.sha256(ids.encode())
                else:
                    digest.update(b"," + ids.encode())
            yield pa.RecordBatch.from_pydict({"path_id": pa.array(names, pa.string()), "ends": pa.array(digests, pa.string())})
        if path is not None:
            yield pa.RecordBatch.from_pydict({"path_id": [path], "ends": [digest.hexdigest()]})

    in_order = pieces.repartition("path_id").sortWithinPartitions("path_id", "place")
    return in_order.select("path_id", "ids").mapInArrow(run, "path_id string, ends string")


def paths(conversations: DataFrame) -> DataFrame:
    """One row for each distinct conversation: its path, and who ends there."""
    rows = written(conversations.select(
        "conv_id", F.unhex(F.array_join("turns.key", "")).alias("path"), F.col("turns.bytes").alias("sizes"),
    ).withColumn("path_id", F.sha2("path", 256)), "conversations")
    distinct = rows.groupBy("path_id", "path", "sizes").agg(
        F.count(F.lit(1)).alias("convs"), F.min("conv_id").alias("least"))
    zero = F.lit(0).cast("long")
    ended = distinct.join(member_digests(rows.select("path_id", "conv_id")), "path_id")
    return ended.select("path", "sizes", "convs", "least", zero.alias("children"), zero.alias("leaves"), zero.alias("saved"), "ends")


@dataclass
class Open:
    """A node that is still open, with what was merged into it so far."""

    name: hashlib._Hash
    size: int
    convs: int = 0
    least: int | None = None
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: str | None = None

    def add(self, convs: int, least: int | None, children: int, leaves: int, saved: int) -> None:
        self.convs += convs
        self.children += children
        self.leaves += leaves
        self.saved += saved
        if least is not None:
            self.least = least if self.least is None else min(self.least, least)


class Peeler:
    """Peels sorted paths; nodes that other tasks may share survive, unless it is the last round."""

    def __init__(self, last: bool):
        self.last, self.stack, self.path, self.sizes = last, [], b"", []
        self.first = 0  # open nodes up to this depth are prefixes of the first path
        self.done: list[tuple] = []
        self.left: list[tuple] = []

    def shared(self, path: bytes) -> int:
        """Turns that the path has in common with the one before."""
        n, most = 0, min(len(path), len(self.path))
        while n < most and path[n:n + WIDTH] == self.path[n:n + WIDTH]:
            n += WIDTH
        return n // WIDTH

    def strip(self, survives: bool) -> None:
        """Close the deepest open node, merge it into the one above."""
        node, depth = self.stack.pop(), len(self.stack) - 1
        if survives:
            if node.convs or node.children:
                self.left.append((self.path[:(depth + 1) * WIDTH], self.sizes[:depth + 1], node.convs, node.least,
                                  node.children, node.leaves, node.saved, node.ends))
            return
        leaves = node.leaves if node.children else 1
        saved = node.saved + (node.convs - 1) * node.size
        above = self.stack[-1] if self.stack else None
        self.done.append((node.name.hexdigest(), above and above.name.hexdigest(), depth + 1, node.least, node.convs, node.children,
                          leaves, saved, node.ends or hashlib.sha256(b"").hexdigest()))
        if above:
            above.add(node.convs, node.least, 1, leaves, saved)

    def take(self, path: bytes, sizes: list[int], convs: int, least: int | None, children: int, leaves: int, saved: int, ends: str | None) -> None:
        common = self.shared(path)
        start = not self.stack
        while len(self.stack) - 1 > common:
            self.strip(not self.last and len(self.stack) - 1 <= self.first)
        if start:
            self.stack.append(Open(hashlib.sha256(), 0))
        else:
            self.first = min(self.first, common)
        self.path, self.sizes = path, sizes
        for depth in range(len(self.stack) - 1, len(sizes)):
            name = self.stack[-1].name.copy()
            name.update(path[depth * WIDTH:(depth + 1) * WIDTH])
            self.stack.append(Open(name, sizes[depth]))
        if start:
            self.first = len(sizes)
        self.stack[-1].add(convs, least, children, leaves, saved)
        self.stack[-1].ends = ends or self.stack[-1].ends

    def finish(self) -> None:
        while self.stack:
            self.strip(not self.last)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (column.split() for column in schema.split(", "))])


def peel(rows: DataFrame, last: bool) -> DataFrame:
    """Nodes (``done``) and surviving paths (``left``) of a round; one of the two is null in each row."""
    done, left = (pa.struct(list(_arrow(s))) for s in (NODE, PATH))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        peeler = Peeler(last)

        def found() -> pa.RecordBatch:
            nodes = [dict(zip(done.names, x)) for x in peeler.done] + [None] * len(peeler.left)
            paths_ = [None] * len(peeler.done) + [dict(zip(left.names, x)) for x in peeler.left]
            peeler.done, peeler.left = [], []
            return pa.RecordBatch.from_arrays([pa.array(nodes, done), pa.array(paths_, left)], names=["done", "left"])

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in left.names)):
                peeler.take(*row)
            yield found()
        peeler.finish()
        yield found()

    kinds = f"done struct<{NODE.replace(' ', ':').replace(',:', ',')}>, left struct<{PATH.replace(' ', ':').replace(',:', ',')}>"
    return rows.sortWithinPartitions("path").mapInArrow(run, kinds)


def trie(conversations: DataFrame, fewest: int = FEWEST) -> DataFrame:
    """Every node of conversations given as (conv_id, turns: array of (key, bytes)).

    node, parent (digests of the path), depth, conv_id (smallest member), n_convs, n_children,
    n_leaves, saved_tokens, ends (digest of the members that end there).
    """
    spark = conversations.sparkSession
    rows, nodes, tasks = written(paths(conversations), "paths"), None, None
    while tasks != 1:
        count = rows.count()
        usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
        wanted = max(-(-count // MOST), min(-(-count // fewest), usual), 1)
        tasks = wanted if tasks is None else max(1, min(wanted, tasks // 2))
        dealt = rows.repartitionByRange(tasks, "path") if tasks > 1 else rows.repartition(1)
        round_ = written(peel(dealt, tasks == 1), "peeled")
        found = round_.where("done is not null").select("done.*")
        nodes = found if nodes is None else nodes.unionByName(found)
        merged = [F.sum("convs"), F.min("least"), F.sum("children"), F.sum("leaves"), F.sum("saved"), F.max("ends")]
        rows = round_.where("left is not null").select("left.*").groupBy("path", "sizes").agg(*merged).toDF(*rows.columns)
    return nodes


def prefix_nodes(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations, each with its parent's smallest member."""
    nodes = trie(rebuilt(conversations))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))

    def number(name: str) -> Column:
        return F.col(name).cast("long")

    return nodes.join(above, "parent", "left").select(
        *[number(c) for c in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")],
        F.col("ends").alias("ends_sha256"))
