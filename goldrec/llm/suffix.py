"""Removal of repeated byte strings by distributed prefix doubling over sampled positions.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document of
smaller id, or before in the same one. As in building a suffix array by prefix doubling, positions
carry the rank of what follows them; Spark sorts positions by their ranks at growing lengths, and
a position leaves as soon as it is unique or its rank spans the whole length. Ranks are hashes,
which stay comparable between documents without a numbering of all positions.

Sorting every position would move many times the corpus, so positions are sampled first: every
string of ``length`` bytes has one anchor, chosen by content (see ``anchors``), and equal strings
have it at the same place. The rounds:

1. Rank by the anchor's k-gram and, beside it, by all that the anchor's strings cover. Spark sorts
   (k-gram, cover, document) in ranges; a k-gram in one place only is unique and leaves. Of equal
   covers all but the first are settled: their strings start earlier. The first ones stay open if
   their k-gram has other covers.
2. Open anchors take their cover along and are sorted by (k-gram, document); each string gets the
   pair of ranks of its two halves, and is settled where the pair has been met. A k-gram with very
   many open covers is spread by the string ranks instead, with the least document kept per rank.
3. Repeats within one document are found in its own task.

Null texts are empty. A row without an id comes after all others. Rows that share an id aren't
earlier than each other; what is found in one is kept for its own text, by a digest beside the id; rows
equal in id and text tie, and none is cut for the other. A very long text is read a megabyte at a time. An
empty table gives no rows. The report ignores other columns, ``deduplicated`` keeps them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.anchors import Strings
from goldrec.llm.common import written
from goldrec.llm.shingles import U, buffers, mix

LENGTH = 100
#: Bytes looked at together, and open covers of a k-gram compared in one task.
PIECE, CROWD = 1 << 20, 4_096
LAST = 2**63 - 1


class Piece:
    """Texts that lie one behind another, or a part of a long one; places are offsets in ``data``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, first: int, shift: int, length: int):
        self.data, self.offsets, self.first, self.shift = data, offsets, first, shift
        self.strings = Strings(data, offsets, length)
        self.begin, self.end, self.h, self.c = self.strings.runs()  # indexes of strings, ends included

    @property
    def text(self) -> np.ndarray:
        return self.strings.text[self.begin] + self.first

    @property
    def key(self) -> np.ndarray:
        """One number for k-gram and cover."""
        return mix(self.h * U(0x9E3779B97F4A7C15) + self.c)


def pieces(texts: pa.Array, length: int, most: int):
    """All texts in pieces of about ``most`` bytes; a longer text is cut so that no string is lost."""
    data, offsets = buffers(texts)
    i, n = 0, len(offsets) - 1
    while i < n:
        if offsets[i + 1] - offsets[i] > most:
            for at in range(int(offsets[i]), int(offsets[i + 1]) - length + 1, most):
                part = data[at:min(at + most + length - 1, int(offsets[i + 1]))]
                yield Piece(part, np.array([0, len(part)]), i, at - int(offsets[i]), length)
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        j = min(j, n)
        yield Piece(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], i, 0, length)
        i = j


def anchor_rows(documents: DataFrame, length: int, most: int) -> DataFrame:
    """h, c, doc, digest: each document's anchors, equal ones once."""

    def run(batches):
        for batch in batches:
            ids, digests = batch.column("doc").to_numpy(), batch.column("digest").to_numpy()
            for piece in pieces(batch.column("text"), length, most):
                text, h, c = piece.text, piece.h, piece.c.view(np.int64)
                if len(h):
                    _, once = np.unique(piece.key * U(31) + mix(text.astype(U)), return_index=True)
                    yield pa.RecordBatch.from_arrays([pa.array(h[once].view(np.int64)), pa.array(c[once]), pa.array(ids[text[once]]), pa.array(digests[text[once]])],
                                                     names=["h", "c", "doc", "digest"])

    return documents.select("doc", "digest", "text").mapInArrow(run, "h long, c long, doc long, digest long")


def ranked(rows: DataFrame) -> DataFrame:
    """doc, digest, h, c, open: anchors met elsewhere. False for settled ones, true where strings must be compared.

    Rows come sorted by k-gram, cover and document, in ranges, so a frequent k-gram is spread over
    tasks. A cover is settled if one document with it is of smaller id, not of the same. What a range's ends can't tell stays open, which is always right.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "h", "c", "doc", "digest").sortWithinPartitions("h", "c", "doc", "digest")

    def batch_of(rows_, is_open):
        return pa.RecordBatch.from_arrays([*(pa.array(rows_[x]) for x in ("doc", "digest", "h", "c")), pa.array(np.full(len(rows_), is_open))],
                                          names=["doc", "digest", "h", "c", "open"])

    def run(batches):
        least = None  # the first document of the cover of the row before
        last, held, crowded = None, None, True  # the row before; a k-gram's only first so far; has its k-gram more
        for batch in batches:
            rows_ = np.empty(batch.num_rows, [("h", np.int64), ("c", np.int64), ("doc", np.int64), ("digest", np.int64)])
            for name in rows_.dtype.names:
                rows_[name] = batch.column(name).to_numpy()
            again = np.zeros(len(rows_), bool)  # parts of a long text may each have an anchor
            again[1:] = rows_[1:] == rows_[:-1]
            if last is not None and len(rows_):
                again[0] = rows_[0] == last
            rows_ = rows_[~again]
            if not len(rows_):
                continue
            h, c = rows_["h"], rows_["c"]
            new_h = np.ones(len(h), bool)
            new_h[1:] = h[1:] != h[:-1]
            new_c = new_h.copy()
            new_c[1:] |= c[1:] != c[:-1]
            if last is not None and last["h"] == h[0]:
                new_h[0], new_c[0] = False, last["c"] != c[0]
            elif last is not None:
                held, crowded = None, False  # the k-gram before had one cover alone
            begin = np.maximum.accumulate(np.where(new_c, np.arange(len(h)), -1))
            lowest = np.where(begin < 0, least if least is not None else 0, rows_["doc"][np.maximum(begin, 0)])
            least = lowest[-1]
            settled = rows_[~new_c & (rows_["doc"] > lowest)]
            if len(settled):
                yield batch_of(settled, False)
            same_id = rows_[~new_c & (rows_["doc"] == lowest)]  # other texts of the first id may differ from other covers
            if len(same_id):
                yield batch_of(same_id, True)
            group = np.cumsum(new_h)  # 0: goes on from the batch before
            if last is not None and not new_h[0]:
                group_of_last = 0
            else:
                group_of_last = None
            firsts = np.flatnonzero(new_c)
            counts = np.bincount(group[firsts], minlength=group[-1] + 1)
            before = np.zeros(len(counts), np.int64)
            if group_of_last == 0:
                before[0] = 2 if crowded else (1 if held is not None else 0)
            elif last is None:
                before[group[0]] = 2  # may have begun in the range before
            total = counts + before
            out = firsts[total[group[firsts]] > 1]
            if held is not None and total[0] > 1 and group_of_last == 0:
                yield batch_of(held, True)
                held = None
            end = group[-1]
            crowded = bool(total[end] > 1)
            if not crowded and counts[end] == 1:
                held = rows_[firsts[-1:]]
            if len(out):
                yield batch_of(rows_[out], True)
            last = rows_[-1]
        if held is not None:
            yield batch_of(held, True)  # may go on in the next range

    return ordered.mapInArrow(run, "doc long, digest long, h long, c long, open boolean")


def covers(documents: DataFrame, length: int, most: int) -> DataFrame:
    """h, doc, digest, at, n, cover: the strings of a document's open anchors (``wanted``: their numbers)."""

    def run(batches):
        for batch in batches:
            ids, digests, wanted = batch.column("doc").to_numpy(), batch.column("digest").to_numpy(), batch.column("wanted").to_pylist()
            for piece in pieces(batch.column("text"), length, most):
                text = piece.text
                if not len(text):
                    continue
                numbers = (piece.h ^ piece.c).view(np.int64)
                want = np.zeros(len(text), bool)
                edges = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
                for a, b in zip(edges, np.append(edges[1:], len(text))):
                    want[a:b] = np.isin(numbers[a:b], np.array(wanted[text[a]], np.int64))
                at = np.flatnonzero(want)
                if not len(at):
                    continue
                start, stop = piece.strings.start[piece.begin[at]], piece.strings.start[piece.end[at]]
                inside = start - piece.offsets[piece.strings.text[piece.begin[at]]] + piece.shift
                cover = [piece.data[a:b + length].tobytes() for a, b in zip(start, stop)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(piece.h[at].view(np.int64)), pa.array(ids[text[at]]), pa.array(digests[text[at]]), pa.array(inside), pa.array(stop - start + 1), pa.array(cover, pa.binary())],
                    names=["h", "doc", "digest", "at", "n", "cover"])

    return documents.select("doc", "digest", "text", "wanted").mapInArrow(run, "h long, doc long, digest long, at long, n long, cover binary")


def _string_ranks(cover: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A rank for every string of the covers, and the cover each is of."""
    lengths = np.array([len(x) for x in cover.to_pylist()], np.int64)
    data = np.frombuffer(b"".join(cover.to_pylist()), np.uint8)
    strings = Strings(data, np.append(0, np.cumsum(lengths)), length)
    return strings.keys(strings.start), strings.text


def _spans(docs: np.ndarray, digests: np.ndarray, starts: np.ndarray) -> pa.RecordBatch:
    """doc, digest, first, last: runs of neighbouring places."""
    fresh = np.ones(len(docs), bool)
    fresh[1:] = (docs[1:] != docs[:-1]) | (digests[1:] != digests[:-1]) | (starts[1:] != starts[:-1] + 1)
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(docs)) - 1
    return pa.RecordBatch.from_arrays([pa.array(docs[first]), pa.array(digests[first]), pa.array(starts[first]), pa.array(starts[last])],
                                      names=["doc", "digest", "first", "last"])


def met_strings(rows: DataFrame, length: int) -> DataFrame:
    """doc, digest, first, last: strings of the covers that an earlier document has under the same k-gram."""
    ordered = rows.repartition("h").sortWithinPartitions("h", "doc", "digest", "at")

    def run(batches):
        seen, owner, held = np.zeros(0, U), np.zeros(0, np.int64), None
        for batch in batches:
            if not batch.num_rows:
                continue
            h, doc, digest, at = (batch.column(x).to_numpy() for x in ("h", "doc", "digest", "at"))
            rank, of = _string_ranks(batch.column("cover"), length)
            # only strings of the k-gram that goes on from the batch before can be known already
            same = mix(h.view(U))[of] + rank
            own = doc[of]
            start = at[of] + np.arange(len(of)) - np.searchsorted(of, of)
            old = len(seen) if held == h[0] else 0
            ranks, owners = np.concatenate([seen[:old], same]), np.concatenate([owner[:old], own])
            order = np.argsort(ranks, kind="stable")  # equal ranks stay in the order of documents
            begins = np.ones(len(order), bool)
            begins[1:] = ranks[order[1:]] != ranks[order[:-1]]
            least = np.empty(len(order), np.int64)
            least[order] = owners[order[np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))]]
            dup = np.flatnonzero(least[old:] < own)
            if len(dup):
                yield _spans(own[dup], digest[of][dup], start[dup])
            end = h[-1]
            keep = np.concatenate([np.full(old, end == h[0]), h[of] == end])
            first_of = np.zeros(len(order), bool)
            first_of[order[begins]] = True
            seen, owner, held = ranks[keep & first_of], owners[keep & first_of], end

    return ordered.select("h", "doc", "digest", "at", "cover").mapInArrow(run, "doc long, digest long, first long, last long")


def crowded_strings(rows: DataFrame, length: int) -> DataFrame:
    """As met_strings, for k-grams with very many covers: one row per string, spread by its rank."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                rank, of = _string_ranks(batch.column("cover"), length)
                start = batch.column("at").to_numpy()[of] + np.arange(len(of)) - np.searchsorted(of, of)
                yield pa.RecordBatch.from_arrays([pa.array(rank.view(np.int64)), *(pa.array(batch.column(x).to_numpy()[of]) for x in ("doc", "digest")), pa.array(start)],
                                                 names=["rank", "doc", "digest", "at"])

    strings = rows.select("doc", "digest", "at", "cover").mapInArrow(run, "rank long, doc long, digest long, at long")
    least = strings.groupBy("rank").agg(F.min("doc").alias("least"))
    return strings.join(least, "rank").where("doc > least").select("doc", "digest", F.col("at").alias("first"), F.col("at").alias("last"))


def _remove(texts: pa.Array, settled: list, spans: list, length: int, most: int):
    """For each text its bytes and which of them go."""
    data, offsets = buffers(texts)
    change = np.zeros(len(data) + 1, np.int32)  # +1 where removal begins, -1 where it ends
    repeated: dict[int, list] = {}

    def drop(first: np.ndarray, last: np.ndarray) -> None:
        np.add.at(change, first, 1)
        np.add.at(change, last + length, -1)

    long_ = set(np.flatnonzero(np.diff(offsets) > most).tolist())
    for piece in pieces(texts, length, most):
        if not len(piece.begin):
            continue
        text, strings = piece.text, piece.strings
        base = int(offsets[piece.first]) + piece.shift
        first, last = strings.start[piece.begin] + base, strings.start[piece.end] + base
        numbers = (piece.h ^ piece.c).view(np.int64)
        gone = np.zeros(len(text), bool)
        edges = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
        for a, b in zip(edges, np.append(edges[1:], len(text))):
            if settled[text[a]]:
                gone[a:b] = np.isin(numbers[a:b], np.array(settled[text[a]], np.int64))
        drop(first[gone], last[gone])
        # strings that may repeat in their own document: those of k-grams that do
        mine = mix(text.astype(U)) + piece.h
        _, back, count = np.unique(mine, return_inverse=True, return_counts=True)
        maybe = np.flatnonzero((count[back] > 1) | (piece.first in long_))
        if len(maybe):
            n = piece.end[maybe] - piece.begin[maybe] + 1
            at = np.repeat(piece.begin[maybe], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            rank, place = strings.keys(strings.start[at]), strings.start[at]
            if piece.first in long_:
                repeated.setdefault(piece.first, []).append((rank, place + base))
            else:
                _later(mix(strings.text[at].astype(U)) * U(3) + rank, place + base, drop)
    for parts in repeated.values():
        _later(np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts]), drop)
    for i, found in enumerate(spans):
        for s in found or ():
            change[offsets[i] + s["first"]] += 1
            change[offsets[i] + s["last"] + length] -= 1
    return data, offsets, np.cumsum(change[:-1]) > 0


def _later(rank: np.ndarray, place: np.ndarray, drop) -> None:
    """Drops strings whose rank has been met at a smaller place; places are in order."""
    order = np.argsort(rank, kind="stable")
    again = order[1:][rank[order[1:]] == rank[order[:-1]]]
    drop(place[again], place[again])


def judged(documents: DataFrame, length: int = LENGTH, most: int = PIECE) -> DataFrame:
    """Each row as struct ``row``, with n_bytes, n_removed, n_spans and kept, the bytes that stay."""
    rows = documents.select(F.struct(*documents.columns).alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"),
                            F.xxhash64("text").alias("digest"))
    own = ["doc", "digest"]  # of a row; equal rows share what is found
    texts = rows.select(*own, "row.text")
    known = written(ranked(anchor_rows(texts, length, most)), "ranks")

    number = F.col("h").bitwiseXOR(F.col("c"))
    wanted = known.where("open").groupBy(*own).agg(F.collect_set(number).alias("wanted"))
    open_ = written(covers(texts.join(wanted, own), length, most), "covers")
    # written, so that its length is known before the joins: few k-grams have so many covers
    crowds = written(open_.groupBy("h").count().where(F.col("count") > CROWD).select("h"), "crowds")
    met = met_strings(open_.join(crowds, "h", "left_anti"), length).unionByName(
        crowded_strings(open_.join(crowds, "h", "left_semi"), length))

    notes = (
        known.where("not open").select(*own, number.alias("settled"), F.lit(None).cast("struct<first:bigint,last:bigint>").alias("span"))
        .unionByName(met.select(*own, F.lit(None).cast("long").alias("settled"), F.struct("first", "last").alias("span")))
        .groupBy(*own).agg(F.collect_set("settled").alias("settled"), F.collect_set("span").alias("spans"))
    )
    joined = rows.join(notes, own, "left").select(
        "row", F.coalesce("settled", F.array()).alias("settled"), F.coalesce("spans", F.array()).alias("spans"))
    schema = joined.select("row", *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")], F.lit(b"").alias("kept")).schema

    def run(batches):
        for batch in batches:
            step = 500
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                data, offsets, gone = _remove(pc.struct_field(part.column("row"), "text"), part.column("settled").to_pylist(), part.column("spans").to_pylist(), length, most)
                begins = gone.copy()
                begins[1:] &= ~gone[:-1]
                inner = offsets[:-1][offsets[:-1] < len(data)]
                begins[inner] = gone[inner]
                sums = [np.append(0, np.cumsum(x)) for x in (gone, begins)]
                removed, spans = (s[offsets[1:]] - s[offsets[:-1]] for s in sums)
                left = [data[a:b][~gone[a:b]].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(np.diff(offsets)), pa.array(removed.astype(np.int64)), pa.array(spans.astype(np.int64)), pa.array(left, pa.binary())],
                    names=["row", "n_bytes", "n_removed", "n_spans", "kept"])

    return joined.mapInArrow(run, schema)


def without_repeats(documents: DataFrame, length: int = LENGTH, most: int = PIECE) -> DataFrame:
    """The rows with n_bytes, n_removed, n_spans and kept."""
    return judged(documents, length, most).select("row.*", "n_bytes", "n_removed", "n_spans", "kept")


def deduplicated(documents: DataFrame) -> DataFrame:
    """The rows with the text that stays, and n_chars counted anew. Bytes of cut code points go too."""
    names = documents.columns
    schema = documents.withColumn("text", F.lit("")).select(*names).schema
    rows = judged(documents).select(F.col("row").dropFields("text").alias("row"), "kept")

    def run(batches):
        for batch in batches:
            row = batch.column("row")
            texts = [kept.decode("utf-8", "ignore") for kept in batch.column("kept").to_pylist()]
            new = {"text": pa.array(texts, pa.string())}
            if "n_chars" in names:
                new["n_chars"] = pa.array([len(t) for t in texts], pc.struct_field(row, "n_chars").type)
            yield pa.RecordBatch.from_arrays([new[c] if c in new else pc.struct_field(row, c) for c in names], names=names)

    return rows.mapInArrow(run, schema)


def repeat_report(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return without_repeats(documents.select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
