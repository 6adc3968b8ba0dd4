"""N-gram Jaccard join by vertical partitioning of the global n-gram order.

A document is its set of word shingles. Two documents link if their sets' Jaccard similarity is at
least ``percent``. All shingles have one order: by hash, but the frequent ones last, rarest first.
A linked pair shares a shingle in both leading parts of that order, so only those meet:

1. ``profile`` reads every text once: the size and digest of its set, and frequent shingles.
   Documents with equal sets become one; the least id stands for them.
2. ``leading`` emits each set's leading part, ``shared`` keeps shingles met twice. Rows are
   range-partitioned by shingle and document, so a frequent shingle is spread over tasks.
3. Shingles with the same documents are one group. Small groups give candidate pairs, with the
   number of leading shingles they share; pairs that share too few for a link are left out.
   Large groups are compared in blocks inside the tasks, and give a forest of links.
4. ``overlaps`` cuts the order into fragments, counts a candidate pair's overlap in each fragment
   separately, and sums per pair.
5. Links give the components.

Frequent shingles only change the order, not the links: those found ``OFTEN`` times among some
thousand documents, at most ``MAX_FREQUENT`` of them, go to every task.

A null or blank text has no shingles and links with nothing. A row without an id stays alone, with
no component. Rows with the same id are one node; of rows tied as the least of a component there is only
its id. A very long text is one set, made from a megabyte of words at a time. An empty table gives no rows.
Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import written
from goldrec.llm.components import components
from goldrec.llm.shingles import U, parts, shingle_sets

WORDS, PERCENT = 5, 80
FRAGMENT_BITS = 2
BLOCK_SHINGLES, OFTEN, MAX_FREQUENT = 2_000_000, 3, 131_072
LARGE, BLOCK = 64, 512


def leading_size(n: int, percent: int = PERCENT) -> int:
    """So many of n shingles, the first by order, hold one of every linked document's."""
    return n - -(-percent * n // 100) + 1


def profile(documents: DataFrame) -> DataFrame:
    """Rows of two kinds: doc_id, n, d1, d2 for each document; token, times for frequent shingles."""

    def frequent(sets: dict):
        if sets:
            tokens, times = np.unique(np.concatenate(list(sets.values())), return_counts=True)
            often = times >= OFTEN
            tokens, times = tokens[often].view(np.int64), times[often]
            none = pa.nulls(len(tokens), pa.int64())
            yield pa.RecordBatch.from_arrays([none, none, none, none, pa.array(tokens), pa.array(times, pa.int64())], names=names)

    names = ["doc_id", "n", "d1", "d2", "token", "times"]

    def run(batches):
        sets, size = {}, 0
        for batch in parts(batches):
            digests = np.zeros((batch.num_rows, 2), np.int64)
            found = shingle_sets(batch.column("text"), WORDS)
            for i, tokens in enumerate(found):
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                digests[i] = np.frombuffer(digest, np.int64)
                if digest not in sets and len(tokens):
                    sets[digest] = tokens
                    size += len(tokens)
                if size >= BLOCK_SHINGLES:
                    yield from frequent(sets)
                    sets, size = {}, 0
            none = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([len(x) for x in found], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]),
                 none, none], names=names)
        yield from frequent(sets)

    return documents.select("doc_id", "text").mapInArrow(run, ", ".join(f"{c} long" for c in names))


def leading(documents: DataFrame, frequent: np.ndarray) -> DataFrame:
    """token, doc_id: each set's leading part. ``frequent`` holds the last shingles of the order, rarest first."""
    order = np.argsort(frequent)
    shared = documents.sparkSession.sparkContext.broadcast((frequent[order], order))

    def run(batches):
        late, rank = shared.value
        for batch in parts(batches):
            tokens, ids, seen = [], [], set()
            for doc_id, found in zip(batch.column("doc_id").to_pylist(), shingle_sets(batch.column("text"), WORDS)):
                if doc_id is None or not len(found):
                    continue
                own = found.tobytes()
                if (len(found), hash(own)) in seen:  # copies within the batch; others are dropped after the shuffle
                    continue
                seen.add((len(found), hash(own)))
                size = leading_size(len(found))
                at = np.searchsorted(late, found)
                at[at == len(late)] = 0
                often = late[at] == found if len(late) else np.zeros(len(found), bool)
                early = found[~often][:size]
                if len(early) < size:
                    last = found[often]
                    early = np.concatenate([early, last[np.argsort(rank[at[often]])][:size - len(early)]])
                tokens.append(early)
                ids.append(np.full(len(early), doc_id, np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens).view(np.int64)), pa.array(np.concatenate(ids))], names=["token", "doc_id"])

    return documents.select("doc_id", "text").mapInArrow(run, "token long, doc_id long")


def shared(rows: DataFrame) -> DataFrame:
    """The rows whose token isn't alone, from rows of token and doc_id.

    Sorted ranges are read in order, so only neighbours are compared. The first and last token of
    a range may go on in another one and stay; the count that follows drops them.
    """
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(n, "token", "doc_id").sortWithinPartitions("token", "doc_id")

    def run(batches):
        held = None  # the last row of the batch before, and whether its token has been met twice
        for batch in batches:
            token, doc = batch.column("token").to_numpy(), batch.column("doc_id").to_numpy()
            if not len(token):
                continue
            first = held is None
            if not first:
                token, doc = np.concatenate([held[0], token]), np.concatenate([held[1], doc])
            keep = np.zeros(len(token), bool)
            same = token[1:] == token[:-1]
            keep[1:] |= same
            keep[:-1] |= same
            keep[0] |= held[2] if not first else True
            held = token[-1:], doc[-1:], bool(keep[-1])
            yield pa.RecordBatch.from_arrays([pa.array(token[:-1][keep[:-1]]), pa.array(doc[:-1][keep[:-1]])], names=["token", "doc_id"])
        if held is not None:
            yield pa.RecordBatch.from_arrays([pa.array(held[0]), pa.array(held[1])], names=["token", "doc_id"])

    return ordered.mapInArrow(run, "token long, doc_id long")


def tails(documents: DataFrame) -> DataFrame:
    """doc_id, n, fragments: per fragment of the hash order, the set's shingles as 6-byte numbers in order."""

    def run(batches):
        for batch in parts(batches):
            out = []
            for found in shingle_sets(batch.column("text"), WORDS):
                edges = np.searchsorted(found >> U(64 - FRAGMENT_BITS), np.arange((1 << FRAGMENT_BITS) + 1, dtype=U))
                short = ((found << U(FRAGMENT_BITS)) >> U(16)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
                out.append([short[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").cast(pa.int64()), pa.array([sum(map(len, x)) // 6 for x in out], pa.int64()), pa.array(out, pa.list_(pa.binary()))],
                names=["doc_id", "n", "fragments"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, fragments array<binary>")


def _numbers(tail: bytes) -> np.ndarray:
    short = np.frombuffer(tail, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(short), 8), np.uint8)
    wide[:, 2:] = short
    return wide.view(">u8").ravel().astype(np.int64)


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b, na, nb, overlap: per fragment the shingles a pair shares, summed per pair."""
    one = sets.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.posexplode("fragments").alias("fragment", "left"))
    other = sets.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.posexplode("fragments").alias("fragment", "right"))
    met = pairs.select("a", "b").join(one, "a").join(other, ["b", "fragment"]).select("a", "b", "na", "nb", "left", "right")

    def run(batches):
        for batch in batches:
            count = [len(np.intersect1d(_numbers(x), _numbers(y), assume_unique=True))
                     for x, y in zip(batch.column("left").to_pylist(), batch.column("right").to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("a", "b", "na", "nb")), pa.array(count, pa.int64())],
                                             names=["a", "b", "na", "nb", "part"])

    partial = met.mapInArrow(run, "a long, b long, na long, nb long, part long")
    return partial.groupBy("a", "b", "na", "nb").agg(F.sum("part").alias("overlap"))


def linked(overlap, n: int, m: int, percent: int = PERCENT):
    return 100 * overlap >= percent * (n + m - overlap)


def _forest(ids: np.ndarray, sets: list[np.ndarray], first: int) -> list[tuple[int, int]]:
    """Links that connect the linked documents; ids before ``first`` and the others are two blocks (0: one)."""
    order = np.zeros(0, np.int64)
    for at in range(0, len(sets), 32):  # sets of a group are much alike, so little is held at once
        order = np.unique(np.concatenate([order, *sets[at:at + 32]]))
    sizes = np.array([len(s) for s in sets], np.int64)
    shared_count = np.zeros((len(ids), len(ids)), np.int32)
    for at in range(0, len(order), 4096):  # a slice of the shingles at a time
        low, high = order[at], order[min(at + 4096, len(order)) - 1]
        table = np.zeros((len(ids), 4096), np.float32)
        for i, s in enumerate(sets):
            part = s[np.searchsorted(s, low):np.searchsorted(s, high, "right")]
            table[i, np.searchsorted(order[at:at + 4096], part)] = 1
        shared_count += (table @ table.T).astype(np.int32)
    is_linked = linked(shared_count.astype(np.int64), sizes[:, None], sizes[None, :])
    if first:
        is_linked[:first, :first] = is_linked[first:, first:] = False
    root = list(range(len(ids)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(np.triu(is_linked, 1))):
        if (p := find(i)) != (q := find(j)):
            root[p] = q
            out.append((int(ids[i]), int(ids[j])))
    return out


def block_links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: links among the documents of each group (gid, size, doc_id), compared in blocks."""
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.select("gid", "doc_id", blocks.alias("blocks"), F.pmod(F.xxhash64("doc_id"), blocks).cast("int").alias("own"))
    meets = placed.select("gid", "doc_id", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    meets = meets.select("gid", "doc_id", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))

    def run(rows):
        rows = rows.sort_by("own")
        own, ids = rows.column("own").to_numpy(), rows.column("doc_id").to_numpy()
        column = rows.column("fragments")
        sets_ = [np.concatenate([_numbers(f) + (k << 48) for k, f in enumerate(column[i].as_py())]) for i in range(len(column))]
        found = _forest(ids, sets_, int((own != own[-1]).sum()))
        return pa.table({"a": pa.array([x[0] for x in found], pa.int64()), "b": pa.array([x[1] for x in found], pa.int64())})

    return meets.join(sets, "doc_id").groupBy("gid", "i", "j").applyInArrow(run, "a long, b long")


def join(documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(members, links): doc_id, n_shingles, stands_for per row, and the links a, b between those that stand for others."""
    seen = written(profile(documents), "profile")
    sets = seen.where("token is null").select("doc_id", "n", "d1", "d2")
    found = (seen.where("token is not null").groupBy("token").agg(F.sum("times").alias("times"))
             .orderBy(F.desc("times"), "token").limit(MAX_FREQUENT).orderBy("times", "token").toArrow())
    frequent = found.column("token").to_numpy().astype(np.int64).view(U)

    # written, so that the join has plain shuffles on both sides and a large group of copies is split
    least = written(sets.where("n > 0 and doc_id is not null").groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("least")), "least")
    members = written(sets.join(least, ["n", "d1", "d2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("stands_for")), "members")
    standing = members.where("doc_id = stands_for and n_shingles > 0").select("doc_id", F.col("n_shingles").alias("n")).distinct()

    met = written(shared(leading(documents, frequent)).join(standing, "doc_id").distinct(), "met")
    tokens = met.groupBy("token").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("doc_id")).alias("x"), F.sum(F.shiftright(F.xxhash64("doc_id", F.lit(1)), 32)).alias("y"))
    groups = tokens.where("size > 1").groupBy("size", "x", "y").agg(F.min("token").alias("gid"), F.count("*").alias("times"))
    grouped = written(met.join(groups.select("gid", "size", "times"), F.col("token") == F.col("gid")).drop("token"), "groups")

    small = grouped.where(F.col("size") <= LARGE)
    one = small.select("gid", "times", F.col("doc_id").alias("a"), F.col("n").alias("na"))
    other = small.select("gid", F.col("doc_id").alias("b"), F.col("n").alias("nb"))
    larger, both = F.greatest("na", "nb"), F.col("na") + F.col("nb")
    fits = 100 * F.least("na", "nb") >= PERCENT * larger
    # a link overlaps by `need`, and what is behind the leading part of the larger set can't give more than its size
    need = F.ceil(PERCENT * both / (100 + PERCENT) - 1e-9)
    behind = F.ceil(PERCENT * larger / 100 - 1e-9) - 1
    pairs = (one.join(other, "gid").where((F.col("a") < F.col("b")) & fits)
             .groupBy("a", "b", "na", "nb").agg(F.sum("times").alias("times")).where(F.col("times") >= need - behind))
    pairs = written(pairs, "pairs")
    large = grouped.where(F.col("size") > LARGE).select("gid", "size", "doc_id")

    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).unionByName(
        large.select("doc_id")).distinct()
    texts = tails(documents.join(wanted, "doc_id", "left_semi")).dropDuplicates(["doc_id"])
    cut = written(texts, "sets")
    links = overlaps(pairs, cut).where(linked(F.col("overlap"), F.col("na"), F.col("nb"))).select("a", "b")
    return members, links.unionByName(block_links(large, cut))


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id per row: the least id that links lead to."""
    members, links = join(documents)
    found = components(links)
    return members.join(found, F.col("stands_for") == F.col("node"), "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "stands_for").alias("component_id"))
