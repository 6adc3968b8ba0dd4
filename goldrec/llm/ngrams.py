"""Quality by the perplexity of an interpolated modified Kneser-Ney model of five bytes.

Trusted texts (quality 1, not toxic) are read as bytes, none folded, and their 5-grams are counted by language;
lower orders count continuations. Counts, discounts and back-off weights are tables that grow with the text, sharded
by language and n-gram, and stay on the cluster: scoring joins them, order by order, with the 5-grams that the
corpus has. What a document costs is the sum over its bytes, so the joins run over the distinct 5-grams of
a block of documents and not over those of each one:

1. documents are dealt into blocks of one language and about ``BLOCK`` bytes; a block gives its distinct
   5-grams, with their counts in texts to learn from;
2. counts of all blocks are summed, five orders of shares and back-off weights come from joins, and each 5-gram
   of the corpus gets its cost by its language's model; those that are measured, that of all languages too;
3. costs are joined back to the blocks that have the 5-gram, and go to them.

Texts travel compressed, once in 1. and once in 3. A fifth of a language's trusted documents, by a hash of their id, is
not learned but measured: a model knows what it has learned too well to say what is usual. With fewer than ``LEAST`` of
these, all are learned and measured.

Thresholds, short texts, languages with few trusted documents, null and empty texts, repeated rows, other columns, empty
tables and missing labels are treated as in ``quality``. A very long text is alone in what is looked at, a megabyte at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import written
from goldrec.llm.quality import ALL, LEAST, QUANTILE, discounted, verdicts
from goldrec.llm.shingles import STEP, parts

ORDER = 5
BITS, BEGIN = 9, 256  # a symbol is a byte, or stands before the text
#: Bytes of text of a block, which is one group of a task.
BLOCK = 16 << 20
#: Of so many trusted documents one is measured and not learned.
HELD_OUT = 5
#: Entries that a block's counts have before they are summed.
PENDING = 1 << 21


def grams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each byte a number: its symbol lowest, those of the four before it above."""
    place = np.arange(len(data)) - np.repeat(offsets[:-1], np.diff(offsets))
    out = data.astype(np.int64)
    for back in range(1, ORDER):
        symbol = np.full(len(data), BEGIN, np.int64)
        symbol[back:] = data[:-back]
        symbol[place < back] = BEGIN
        out |= symbol << (BITS * back)
    return out


def pieces(data: np.ndarray, offsets: np.ndarray):
    """Grams of STEP bytes at a time, and where each text begins among them (and the last ends)."""
    for at in range(0, len(data), STEP):
        end, begin = min(at + STEP, len(data)), max(0, at - ORDER + 1)
        yield grams(data[begin:end], np.clip(offsets, begin, end) - begin)[at - begin:], np.clip(offsets, at, end) - at


def _packed(rows: DataFrame) -> DataFrame:
    """The rows with their text compressed, and its length; null texts stay null."""
    others = [c for c in rows.columns if c != "text"]

    def run(batches):
        codec = pa.Codec("zstd")
        for batch in parts(batches):
            texts = batch.column("text")
            zipped = pa.array([codec.compress(x.as_buffer(), asbytes=True) if x.is_valid else None for x in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), pc.binary_length(texts).cast(pa.int32()), zipped], names=[*others, "size", "zipped"])

    schema = rows.select(*others, F.lit(0).cast("int").alias("size"), F.lit(b"").alias("zipped")).schema
    for field in schema.fields[-2:]:
        field.nullable = True
    return rows.mapInArrow(run, schema)


def _unpacked(docs: pa.Table) -> tuple[bytes, np.ndarray]:
    codec = pa.Codec("zstd")
    sizes = docs["size"].fill_null(0).to_numpy().astype(np.int64)
    data = b"".join(codec.decompress(z, int(n), asbytes=True) for z, n in zip(docs["zipped"].to_pylist(), sizes) if n)
    return data, np.append(0, np.cumsum(sizes))


def _marked(docs: pa.Table, known: pa.Table, name: str) -> np.ndarray:
    """Which rows have an id that is marked so."""
    return pc.is_in(docs["doc_id"], value_set=known["doc_id"].filter(known[name]).combine_chunks()).to_numpy(zero_copy_only=False).astype(bool)


def _counts(docs: pa.Table, known: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct grams, how often they are in texts to learn from, and whether they are in measured ones."""
    text, offsets = _unpacked(docs)
    mark = _marked(docs, known, "learn") + 2 * _marked(docs, known, "measure")
    found, times, pending = [], [], 0

    def summed():
        keys, inverse = np.unique(np.concatenate([np.zeros(0, np.int64), *found]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([np.zeros(0), *times]), len(keys))

    for gram, edges in pieces(np.frombuffer(text, np.uint8), offsets):
        keys, n = np.unique(gram * 4 + np.repeat(mark, np.diff(edges)), return_counts=True)
        found.append(keys)
        times.append(n)
        pending += len(keys)
        if pending > PENDING:
            keys, n = summed()
            found, times, pending = [keys], [n], 0
    keys, n = summed()
    gram, inverse = np.unique(keys >> 2, return_inverse=True)
    return gram, np.bincount(inverse, n * (keys & 1), len(gram)).astype(np.int64), np.bincount(inverse, keys >> 1 & 1, len(gram)) > 0


def block_grams(docs: DataFrame, known: DataFrame) -> DataFrame:
    """model, gram, n, measured, block: the distinct grams of each block."""

    def run(key, left, right):
        gram, n, measured = _counts(left, right)
        model = left["model"][0].as_py() if left.num_rows else 0
        return pa.table([pa.array(np.full(len(gram), model, np.int32)), pa.array(gram), pa.array(n), pa.array(measured),
                         pa.array(np.full(len(gram), key[0].as_py(), np.int32))], names=["model", "gram", "n", "measured", "block"])

    return docs.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(run, "model int, gram long, n long, measured boolean, block int")


def lower(gram: Column | str, order: int) -> Column:
    """The last ``order`` symbols."""
    gram = F.col(gram) if isinstance(gram, str) else gram
    return gram.bitwiseAND(F.lit((1 << BITS * order) - 1).cast("long"))


def probabilities(counts: DataFrame, asked: DataFrame) -> DataFrame:
    """lang, gram, p for the distinct (lang, gram) of ``asked``; counts has lang, gram, n > 0.

    Shares of seen n-grams and back-off weights of seen contexts are joined, from one symbol up to ORDER.
    """
    seen, wanted = {ORDER: counts}, {ORDER: asked}
    for k in range(ORDER - 1, 0, -1):
        # lower orders count in how many contexts an n-gram has been seen
        seen[k] = written(seen[k + 1].groupBy("lang", lower("gram", k).alias("gram")).agg(F.count("*").alias("n")), "seen")
        wanted[k] = written(wanted[k + 1].select("lang", lower("gram", k).alias("gram")).distinct(), "wanted")
    below = None
    for k in range(1, ORDER + 1):
        own, back = discounted(seen[k].withColumn("context", F.shiftright("gram", BITS)), ["context"])
        rows = wanted[k].withColumn("context", F.shiftright("gram", BITS)).withColumn("rest", lower("gram", k - 1))
        rows = rows.join(own.select("lang", "gram", "own").hint("merge"), ["lang", "gram"], "left")
        rows = rows.join(back.hint("merge"), ["lang", "context"], "left")
        if below is None:
            rows = rows.withColumn("p", F.lit(1 / (BEGIN + 1)))
        else:
            rows = rows.join(below.withColumnRenamed("gram", "rest").hint("merge"), ["lang", "rest"])
        below = written(rows.select("lang", "gram", (F.coalesce("own", F.lit(0.0)) + F.coalesce("back", F.lit(1.0)) * F.col("p")).alias("p")), "shares")
    return below


def block_costs(found: DataFrame) -> DataFrame:
    """block, gram, cost, pooled from model, gram, n, measured, blocks: what each gram of a block costs.

    Model 0 is that of all languages; ``pooled`` is the cost by it, for grams of measured documents.
    """
    learned = found.where("n > 0")
    every = learned.groupBy("gram").agg(F.sum("n").alias("n")).select(F.lit(0).alias("lang"), "gram", "n")
    counts = written(learned.where("model != 0").select(F.col("model").alias("lang"), "gram", "n").unionByName(every), "counts")
    asked = found.select(F.col("model").alias("lang"), "gram")
    shared = found.where("measured and model != 0").select(F.lit(0).alias("lang"), "gram")
    p = probabilities(counts, asked.unionByName(shared).distinct())
    p = p.select(F.col("lang").alias("model"), "gram", (-F.log("p")).cast("float").alias("cost"))
    pooled = p.where("model = 0").select("gram", F.col("cost").alias("pooled"))
    rows = found.join(p.hint("merge"), ["model", "gram"]).join(pooled.hint("merge"), "gram", "left")
    return rows.select(F.explode("blocks").alias("block"), "gram", "cost", "pooled")


def scored(docs: DataFrame, known: DataFrame, costs: DataFrame, texts: bool) -> DataFrame:
    """The rows with n_symbols, cost, pooled and whether they are measured; with ``texts``, their text too."""
    right = costs.withColumn("doc_id", F.lit(None).cast(known.schema["doc_id"].dataType)).withColumn("measure", F.lit(False)).unionByName(
        known.where("measure").select("block", "doc_id", "measure"), allowMissingColumns=True)
    others = [c for c in docs.columns if c not in ("block", "model", "doc_id", "size", "zipped")]
    extra = "n_symbols long, cost double, pooled double, measured boolean" + (", text string" if texts else "")
    schema = docs.select(*others, F.from_json(F.lit("{}"), extra).alias("x")).select(*others, "x.*").schema

    def run(left, right):
        text, offsets = _unpacked(left)
        table = right.filter(pc.is_valid(right["gram"]))
        gram = table["gram"].to_numpy()
        order = np.argsort(gram)
        gram = gram[order]
        prices = [table[c].fill_null(0).to_numpy()[order].astype(np.float64) for c in ("cost", "pooled")]
        total = np.zeros((2, left.num_rows))
        for wanted, edges in pieces(np.frombuffer(text, np.uint8), offsets):
            at = np.searchsorted(gram, wanted)
            if not np.array_equal(gram.take(at, mode="clip"), wanted):
                raise ValueError("a 5-gram of this block has no cost")
            for k, price in enumerate(prices):
                sums = np.append(0, np.cumsum(price[at]))
                total[k] += sums[edges[1:]] - sums[edges[:-1]]
        columns = [*(left[c] for c in others), pa.array(np.diff(offsets)), *(pa.array(x) for x in total), pa.array(_marked(left, right, "measure"))]
        if texts:
            valid = left["size"].is_valid().to_pylist()
            columns.append(pa.array([text[a:b] if v else None for a, b, v in zip(offsets[:-1], offsets[1:], valid)], pa.binary()).cast(pa.string()))
        return pa.table(columns, names=schema.names)

    return docs.groupBy("block").cogroup(right.groupBy("block")).applyInArrow(run, schema)


def judge(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE, texts: bool = True) -> DataFrame:
    """The rows of ``documents`` as struct ``row``, without text if not ``texts``, with perplexity, threshold and kept."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id", F.lit(True).alias("good")).distinct()
    held = F.pmod(F.xxhash64("doc_id"), F.lit(HELD_OUT)) == 0
    size, dealt = F.octet_length("text").cast("long"), F.xxhash64("doc_id", "text")
    # the labels grow with the documents: a merge join at every size, so the plan doesn't turn at some
    sizes = documents.select("doc_id", "lang", size.alias("size"), dealt.alias("dealt")).where("size > 0").join(good.hint("merge"), "doc_id", "left")
    sizes = written(sizes.withColumn("held", held), "sizes")
    stats = sizes.groupBy("lang").agg(F.sum("size").alias("size"), F.count_if("good").alias("good"), F.count_if(F.col("good") & F.col("held")).alias("held")).collect()
    own = {r["lang"]: r for r in stats if r["good"] >= LEAST and r["lang"] not in (None, ALL)}
    rest = [r for r in stats if r["lang"] not in own]
    models, base = {}, 0
    for model, (lang, rows) in enumerate([(ALL, rest), *((lang, [own[lang]]) for lang in sorted(own))]):
        blocks = max(1, -(-sum(r["size"] for r in rows) // BLOCK))
        models[lang] = F.struct(F.lit(model).alias("model"), F.lit(base).alias("base"), F.lit(blocks).alias("blocks"),
                                F.lit(sum(r["held"] for r in rows) >= LEAST).alias("held"))
        base += blocks
    model_lang = F.when(F.col("lang").isin(list(own)), F.col("lang")).otherwise(ALL)
    plan = F.element_at(F.create_map(*[x for lang, found in models.items() for x in (F.lit(lang), found)]), model_lang)
    block = (plan["base"] + F.pmod(F.col("dealt"), plan["blocks"])).cast("int")
    known = sizes.where("good").select(block.alias("block"), "doc_id", (~plan["held"] | ~F.col("held")).alias("learn"), (~plan["held"] | F.col("held")).alias("measure")).distinct()

    others = F.struct(*[F.col(f"`{c}`") for c in documents.columns if c != "text"])
    rows = documents.select(others.alias("rest"), "doc_id", "text", model_lang.alias("model_lang"), plan["model"].alias("model"), "lang", dealt.alias("dealt"))
    rows = rows.withColumn("block", block).drop("dealt", "lang")
    found = block_grams(_packed(rows.drop("rest", "model_lang").where(F.length("text") > 0)), known)
    found = found.groupBy("model", "gram").agg(F.sum("n").alias("n"), F.max("measured").alias("measured"), F.collect_list("block").alias("blocks"))
    costs = block_costs(written(found, "grams"))
    out = written(scored(_packed(rows), known, costs, texts), "costs")
    row = F.struct(*[F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in documents.columns if texts or c != "text"])
    measured = out.where("measured and n_symbols > 0")
    both = measured.where(F.col("model_lang") != ALL).select("model_lang", "n_symbols", "cost").unionByName(
        measured.select(F.lit(ALL).alias("model_lang"), "n_symbols", F.col("pooled").alias("cost")))
    return verdicts(out.select(row.alias("row"), "model_lang", "n_symbols", "cost"), both, quantile)


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept per row."""
    return judge(documents.select("doc_id", "lang", "text"), labels, texts=False).select(
        "row.doc_id", "row.lang", "perplexity", "threshold", "kept")
