"""Alignment of two tokenizers over the same text by galloping intersection.

Both token sequences of a text cover the same bytes, so each is a rising list of end offsets. The
shorter list drives: every 64th of its ends is looked up in the longer one by doubling steps and a
binary search between the last two, and the ends between start from the place of the one before them.
Ends that are in both lists cut the tokens into groups; differences of the ranks found tell which
tokens a token overlaps. All texts of a slice are laid end to end, so one search serves them all.

A long text is cut where a letter, one space and a letter follow each other. No token of either
vocabulary has a space behind a letter (looked up in the vocabularies; without that, nothing is
cut), so the pieces' tokens are the text's. Each sequence stands for a space and the text.

How often a pair of ids ends together in the corpus is counted per task and summed. Of two tokens
that end together one is a suffix of the other, so there are at most as many pairs as suffixes of the
entries of both vocabularies; the counts are sent to every task under that bound.

Null and empty texts, and texts whose tokens don't spell the text again, have no tokens. Repeated
rows and ids each keep their row; ties between pair counts all count as the highest. Other columns
are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from goldrec.llm.common import written

#: Characters of a piece of a long text, of a slice of texts; ends between two that are looked up anew.
PIECE, SLICE, STRIDE = 65_536, 1_000_000, 64
GAP = re.compile("[A-Za-z] [A-Za-z]")
#: Letters and blanks that every version of Unicode classes alike.
PLAIN = re.compile(r"[\t\n\r\x20-\x7e¡-ɏ]*")


def first_at_least(values: np.ndarray, ends: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Index of the first of the rising ``ends`` that is >= each value, which is at ``start`` or later."""
    padded = np.append(ends, np.iinfo(np.int64).max)
    low, high, step = start.copy(), start.copy(), 1
    todo = np.flatnonzero(padded[low] < values)
    while len(todo):
        low[todo] = high[todo] + 1
        high[todo] = np.minimum(high[todo] + step, len(ends))
        step *= 2
        todo = todo[padded[high[todo]] < values[todo]]
    todo = np.flatnonzero(low < high)
    while len(todo):
        middle = (low[todo] + high[todo]) // 2
        less = padded[middle] < values[todo]
        low[todo] = np.where(less, middle + 1, low[todo])
        high[todo] = np.where(less, high[todo], middle)
        todo = todo[low[todo] < high[todo]]
    return low


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Rank in ``long`` of each of ``short``: how many of its ends are smaller."""
    marks = first_at_least(short[::STRIDE], long, np.zeros(-(-len(short) // STRIDE), np.int64))
    return first_at_least(short, long, np.repeat(marks, STRIDE)[:len(short)])


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes in a and in b of the ends that both have."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    rank = gallop(short, long)
    at = np.flatnonzero(np.append(long, -1)[rank] == short)
    return (at, rank[at]) if short is a else (rank[at], at)


def overlaps(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first and the last token of b that each token of a overlaps, from its ends' ranks."""
    rank = gallop(a, b)
    behind = rank + (np.append(b, -1)[rank] == a)
    return np.append(0, behind[:-1]), rank


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if printable, else 256 and up."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [x for x in range(256) if x not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Pair:
    """The two tokenizers: ids of texts, and the bytes of each id."""

    def __init__(self, json_path: str, model_path: str, pattern: str):
        with open(json_path, encoding="utf-8") as file:
            described = json.load(file)
        letters, vocabulary = _byte_letters(), described["model"]["vocab"]
        special = {t["content"] for t in described["added_tokens"]}
        words = {i: bytes(map(letters.__getitem__, w)) for w, i in vocabulary.items() if w not in special}
        self.bytes_a = [words.get(i, b"") for i in range(max(words) + 1)]
        self.tokenizer = Tokenizer.from_file(json_path)
        self.tokenizer.encode_special_tokens = True
        merges = described["model"]["merges"]
        joined = [m.replace(" ", "") if isinstance(m, str) else "".join(m) for m in merges]
        # merges in the order of ids: then the faster library gives the same ids
        ranked = [vocabulary[w] for w in joined] == sorted(words)[len(words) - len(joined):]
        self.encoding = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks={w: i for i, w in words.items()}, special_tokens={}) if ranked else None
        self.model = model = sentencepiece.SentencePieceProcessor(model_file=model_path)
        pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.cuts = not any(re.search(rb"[A-Za-z] ", w) for w in (*self.bytes_a, *self.bytes_b))
        self.lengths = [np.array([len(w) for w in words_], np.int64) for words_ in (self.bytes_a, self.bytes_b)]
        if len(self.bytes_a) * len(self.bytes_b) >= 2**32:
            raise ValueError("a pair of ids must fit 32 bits")
        # an id as text, with the mark behind it: within a group, at its end
        self.marked = [b"%d%s" % (i, m) for i in range(len(self.bytes_a)) for m in (b",", b"|")]
        self.base = len(self.marked)
        self.marked += [b"%d%s" % (i, m) for i in range(len(self.bytes_b)) for m in (b",", b";")]

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        if self.encoding:
            return [self.encoding.encode_ordinary(t) if PLAIN.fullmatch(t) else self._encode(t) for t in texts]
        return [self._encode(t) for t in texts]

    def _encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def pieces(self, text: str) -> Iterator[str]:
        """The text in pieces, without the space that comes before each."""
        at = 0
        while self.cuts and len(text) - at > PIECE:
            gap = GAP.search(text, at + PIECE)
            if not gap:
                break
            yield text[at:gap.start() + 1]
            at = gap.start() + 2
        yield text[at:]


@lru_cache(maxsize=2)
def tokenizers(json_path: str, model_path: str, pattern: str) -> Pair:
    return Pair(json_path, model_path, pattern)


def _flat(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


class Slice:
    """Some texts, laid end to end: ids and ends of both sequences, what they share, and each text's part."""

    def __init__(self, texts: list[str | None], pair: Pair):
        self.pair = pair
        pieces = [list(pair.pieces(t)) if t else [] for t in texts]
        flat = [p for ps in pieces for p in ps]
        of = np.repeat(np.arange(len(texts)), [len(ps) for ps in pieces])
        a, b = pair.encode_a([" " + p for p in flat]), pair.model.encode(flat, num_threads=1) if flat else []
        whole = [(" " + p).encode() for p in flat]
        spelt = [all(b"".join(map(words.__getitem__, ids)) == w for ids, words in ((x, pair.bytes_a), (y, pair.bytes_b)))
                 for x, y, w in zip(a, b, whole)]
        lost = set(of[~np.array(spelt, bool)].tolist())
        kept = [i for i in range(len(flat)) if int(of[i]) not in lost]
        self.a, self.b = _flat([a[i] for i in kept]), _flat([b[i] for i in kept])
        self.ends_a, self.ends_b = (np.cumsum(n[ids]) for n, ids in zip(pair.lengths, (self.a, self.b)))
        self.at_a, self.at_b = common_ends(self.ends_a, self.ends_b)
        size = np.bincount(of[kept], [len(whole[i]) for i in kept], len(texts)).astype(np.int64) if kept else np.zeros(len(texts), np.int64)
        until = np.cumsum(size)
        # of each text: where its tokens and groups begin, and behind the last text
        self.from_a, self.from_b, self.from_group = (
            np.append(0, np.searchsorted(ends, until, "right")) for ends in (self.ends_a, self.ends_b, self.ends_a[self.at_a]))

    def links(self) -> np.ndarray:
        """Of each common end: the two ids as one number."""
        return self.a[self.at_a] * len(self.pair.bytes_b) + self.b[self.at_b]

    def group_digests(self) -> list[str]:
        """Digests of the ids of all groups, written out; empty for a text without tokens."""
        cut_a, cut_b = np.zeros(len(self.a), np.int64), np.zeros(len(self.b), np.int64)
        cut_a[self.at_a], cut_b[self.at_b] = 1, 1
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        order = np.empty(len(self.a) + len(self.b), np.int64)
        order[np.arange(len(self.a)) + np.append(0, self.at_b + 1)[group_a]] = 2 * self.a + cut_a
        order[np.arange(len(self.b)) + (self.at_a + 1)[group_b]] = self.pair.base + 2 * self.b + cut_b
        starts = (self.from_a + self.from_b).tolist()
        mark = self.pair.marked.__getitem__
        return [hashlib.sha256(b"".join(map(mark, order[x:y].tolist()))[:-1]).hexdigest() if y > x else "" for x, y in zip(starts, starts[1:])]


def _slices(texts: list[str | None]) -> Iterator[list[str | None]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text or "")
        if size >= SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def _binary(values: np.ndarray, starts: np.ndarray) -> list[bytes]:
    return [values[x:y].tobytes() for x, y in zip(starts.tolist(), starts[1:].tolist())]


def align(documents: DataFrame, json_path: str, model_path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, the ids a and b, where each group ends (a_until, b_until: tokens before its end), and the
    first and last token of b that each token of a overlaps (b_first, b_last)."""
    names = ["a", "b", "a_until", "b_until", "b_first", "b_last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(json_path, model_path, pattern)
        for batch in batches:
            rows: dict[str, list] = {n: [] for n in names}
            for texts in _slices(batch.column("text").to_pylist()):
                s = Slice(texts, pair)
                first, last = overlaps(s.ends_a, s.ends_b)
                for i in range(len(texts)):
                    x, y, (g, h) = s.from_a[i:i + 2], s.from_b[i:i + 2], s.from_group[i:i + 2]
                    for name, part in zip(names, (
                        s.a[x[0]:x[1]], s.b[y[0]:y[1]], s.at_a[g:h] + 1 - x[0], s.at_b[g:h] + 1 - y[0],
                        first[x[0]:x[1]] - y[0], last[x[0]:x[1]] - y[0],
                    )):
                        rows[name].append(part.astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(rows[n], pa.list_(pa.int32())) for n in names]], ["doc_id", *names])

    texts = documents.select("doc_id", "text")
    return texts.mapInArrow(run, texts.select("doc_id", *[F.array(F.lit(0)).alias(n) for n in names]).schema)


def _linked(documents: DataFrame, json_path: str, model_path: str, pattern: str) -> DataFrame:
    """Per row its counts, the digest of its groups, and its links: pairs and how often, as packed 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = tokenizers(json_path, model_path, pattern)
        for batch in batches:
            n_a, n_b, n_groups, digests, pairs, times = [], [], [], [], [], []
            for texts in _slices(batch.column("text").to_pylist()):
                s = Slice(texts, pair)
                n_a += np.diff(s.from_a).tolist()
                n_b += np.diff(s.from_b).tolist()
                n_groups += np.diff(s.from_group).tolist()
                digests += s.group_digests()
                of = np.repeat(np.arange(len(texts)), np.diff(s.from_group))
                both, n = np.unique(of * 2**32 + s.links(), return_counts=True)
                starts = np.searchsorted(both, np.arange(len(texts) + 1) * 2**32)
                pairs += _binary((both % 2**32).astype("<u4"), starts)
                times += _binary(n.astype("<u4"), starts)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array(x, pa.int64()) for x in (n_a, n_b, n_groups)], pa.array(digests, pa.string()),
                 pa.array(pairs, pa.binary()), pa.array(times, pa.binary())],
                names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    texts = documents.select("doc_id", "text")
    number, packed = F.lit(0).cast("long"), F.lit(b"")
    schema = texts.select("doc_id", number.alias("n_a"), number.alias("n_b"), number.alias("n_groups"), F.lit("").alias("groups_sha256"),
                          packed.alias("pairs"), packed.alias("times")).schema
    return texts.mapInArrow(run, schema)


def pair_counts(linked: DataFrame) -> DataFrame:
    """pair, n: links of the corpus by pair of ids. Each task sums its own first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, sums = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            new = np.frombuffer(b"".join(batch.column("pairs").to_pylist()), "<u4").astype(np.int64)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4")
            pairs, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            sums = np.bincount(place, np.concatenate([sums, times]), len(pairs)).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"pair": pairs, "n": sums})

    return linked.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def alignment_digests(documents: DataFrame, json_path: str, model_path: str, pattern: str) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    spark = documents.sparkSession
    linked = written(_linked(documents, json_path, model_path, pattern), "linked")
    counts = pair_counts(linked).toArrow().sort_by("pair")
    pair, n = (counts.column(c).to_numpy().astype(np.int64) for c in ("pair", "n"))
    b = pair % len(tokenizers(json_path, model_path, pattern).bytes_b)
    highest = np.zeros(int(b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, b, n)
    known = spark.sparkContext.broadcast((pair, n, n == highest[b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = known.value
        for batch in batches:
            found = []
            for pairs, times in zip(batch.column("pairs").to_pylist(), batch.column("times").to_pylist()):
                at, often = np.searchsorted(pair, np.frombuffer(pairs, "<u4")), np.frombuffer(times, "<u4").astype(np.int64)
                found.append((int(often[best[at]].sum()), int((often * n[at]).sum())))
            n_best, count_sum = (pa.array([x[i] for x in found], pa.int64()) for i in (0, 1))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")], batch.column("n_groups"), n_best, count_sum, batch.column("groups_sha256")],
                names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    kept = linked.select("doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times")
    schema = linked.select("doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), F.col("n_groups").alias("n_best"),
                           F.col("n_groups").alias("count_sum"), "groups_sha256").schema
    return kept.mapInArrow(run, schema)
