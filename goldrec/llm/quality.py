"""Quality by the perplexity of an interpolated modified Kneser-Ney model of trusted text.

Texts are read as symbols, 64 classes of bytes, so a model of three symbols has a size bound
whatever the corpus. Trigrams of all trusted documents (quality 1, not toxic) are counted by
language; continuation counts, discounts and back-off weights come from joins of the count tables,
sharded by language and context. Every document's perplexity is compared with its language's
threshold, a quantile over the trusted documents of that language; above it is rejected.

The joins end at the model. A document's own trigrams aren't joined with it: that table would be
several times the corpus, and the models, at most 64**3 numbers for each language and as many for
all together, can be read by every task instead; a task holds ``HELD`` of them at a time.

A short text says little, so ``PRIOR`` symbols of its language's mean count along. Any number of
languages have a model of their own: those with ``LEAST`` trusted documents. Rows of all others, and
those without a language, take the model, mean and threshold of all languages, found by scoring the
trusted documents of every language with that model. A null or empty text has no perplexity and is rejected.
Without any trusted document nothing but those is rejected. Rows repeat as they come; other
columns stay, whatever their names. A very long text is read a megabyte at a time. An empty table gives no rows,
and without labels nothing is trusted.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import written
from goldrec.llm.shingles import STEP, buffers, parts

SYMBOLS = 64
BEGIN = SYMBOLS - 1
QUANTILE, PRIOR = 0.995, 100
LEAST = 20
#: Languages filled at once on the driver, and models that a task holds.
FILLED, HELD = 16, 32
ALL = ""  # the model of all languages together


def _classes() -> np.ndarray:
    table = np.full(256, 61, np.uint8)  # other bytes
    table[ord("a"):ord("z") + 1] = np.arange(26)
    table[ord("A"):ord("Z") + 1] = 26
    table[ord("0"):ord("9") + 1] = 27
    table[32], table[10] = 28, 29
    for i, mark in enumerate(".,!?|*$&%#'\"-:;("):
        table[ord(mark)] = 30 + i
    table[128:] = 46 + np.arange(128) % 15  # parts of letters beyond ASCII
    return table


CLASSES = _classes()


def trigrams(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A number below SYMBOLS**3 for each byte: its class after those of the two bytes before."""
    symbol = CLASSES[data].astype(np.int32)
    one, two = np.full(len(data), BEGIN, np.int32), np.full(len(data), BEGIN, np.int32)
    one[1:], two[2:] = symbol[:-1], symbol[:-2]
    starts = offsets[:-1][np.diff(offsets) > 0]
    one[starts] = two[starts] = BEGIN
    second = offsets[:-1][np.diff(offsets) > 1] + 1
    two[second] = BEGIN
    return (two * SYMBOLS + one) * SYMBOLS + symbol


def trigram_counts(trusted: DataFrame) -> DataFrame:
    """lang, a, b, c, n over all trusted rows, and the same for all languages."""

    def run(batches):
        for batch in parts(batches):
            langs = np.array(batch.column("lang").to_pylist(), object)
            for lang in set(langs):
                data, offsets = buffers(batch.column("text").filter(pa.array(langs == lang)))
                count = np.bincount(trigrams(data, offsets), minlength=SYMBOLS**3)
                gram = np.flatnonzero(count)
                symbols = gram // SYMBOLS**2, gram // SYMBOLS % SYMBOLS, gram % SYMBOLS
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(gram), pa.string()), *(pa.array(x, pa.int32()) for x in symbols), pa.array(count[gram], pa.int64())],
                    names=["lang", "a", "b", "c", "n"])

    both = trusted.select("lang", "text").mapInArrow(run, "lang string, a int, b int, c int, n long")
    both = written(both.groupBy("lang", "a", "b", "c").agg(F.sum("n").alias("n")), "trigrams")
    every = both.groupBy("a", "b", "c").agg(F.sum("n").alias("n")).select(F.lit(ALL).alias("lang"), "a", "b", "c", "n")
    return both.where(F.col("lang") != ALL).unionByName(every)


def discounted(counts: DataFrame, context: list[str]) -> tuple[DataFrame, DataFrame]:
    """Discounted shares (own) of each n-gram in its context, and the weight left to the lower order."""
    times = [F.sum((F.col("n") == k).cast("double")).alias(f"n{k}") for k in (1, 2, 3, 4)]
    few = counts.groupBy("lang").agg(*times)
    y = F.try_divide(F.col("n1"), F.col("n1") + 2 * F.col("n2"))
    # counts that no n-gram has leave the usual half of a count
    d = [F.coalesce(k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}")), F.lit(0.5)) for k in (1, 2, 3)]
    d = [F.greatest(F.lit(0.05), F.least(x, F.lit(k - 0.05))) for k, x in zip((1, 2, 3), d)]
    few = few.select(F.col("lang"), *[x.alias(f"d{k}") for k, x in zip((1, 2, 3), d)])
    taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
    marked = counts.join(F.broadcast(few), "lang").withColumn("taken", taken)  # few has a row for each language
    totals = marked.groupBy("lang", *context).agg(F.sum("n").alias("total"), F.sum("taken").alias("left"))
    own = marked.join(totals, ["lang", *context]).withColumn("own", (F.col("n") - F.col("taken")) / F.col("total"))
    return own.drop("taken", "total", "left", "d1", "d2", "d3", "n"), totals.select("lang", *context, (F.col("left") / F.col("total")).alias("back"))


class Model:
    """Negative log probabilities of all trigrams by language, filled from the tables of seen ones."""

    def __init__(self, langs: list[str]):
        self.langs = langs
        self.cost = np.empty((len(langs), SYMBOLS**3), np.float32)

    def fill(self, at: int, langs: list[str], tables: list[pa.Table]) -> None:
        """Rows ``at`` and after, for ``langs``."""
        seen3, back3, seen2, back2, seen1, back1 = tables

        def keys(table, *names):
            place = pc.index_in(table["lang"], pa.array(langs, pa.string()))
            return tuple(x.to_numpy() for x in (place, *(table[name] for name in names)))

        p1 = np.full((len(langs), SYMBOLS), 1 / SYMBOLS)
        p1[keys(back1)] *= back1["back"].to_numpy()[:, None]
        p1[keys(seen1, "c")] += seen1["own"].to_numpy()
        p2 = np.repeat(p1[:, None, :], SYMBOLS, axis=1)
        p2[keys(back2, "b")] *= back2["back"].to_numpy()[:, None]
        p2[keys(seen2, "b", "c")] += seen2["own"].to_numpy()
        p3 = np.repeat(p2[:, None, :, :], SYMBOLS, axis=1)
        p3[keys(back3, "a", "b")] *= back3["back"].to_numpy()[:, None]
        p3[keys(seen3, "a", "b", "c")] += seen3["own"].to_numpy()
        self.cost[at:at + len(langs)] = -np.log(p3.reshape(len(langs), SYMBOLS**3))

    def shared(self, context) -> dict:
        """A broadcast for each language, so that a task reads those of its rows only."""
        return {lang: context.broadcast(self.cost[i]) for i, lang in enumerate(self.langs)}


def fit(trusted: DataFrame) -> Model:
    """The model of all trusted rows (lang, text). The tables reach the driver FILLED languages at a time."""
    counts = trigram_counts(trusted)
    # lower orders count in how many contexts an n-gram has been seen
    pairs = counts.groupBy("lang", "b", "c").agg(F.count("*").alias("n"))
    singles = pairs.groupBy("lang", "c").agg(F.count("*").alias("n"))
    tables = [written(t, "model") for table, context in ((counts, ["a", "b"]), (pairs, ["b"]), (singles, [])) for t in discounted(table, context)]
    model = Model(sorted(r["lang"] for r in tables[-1].select("lang").collect()))
    for at in range(0, len(model.langs), FILLED):
        langs = model.langs[at:at + FILLED]
        model.fill(at, langs, [t.where(F.col("lang").isin(langs)).toArrow() for t in tables])
    return model


def costs(documents: DataFrame, shared: dict, keep: list[str], inside: str | None = None, pooled: bool = False) -> DataFrame:
    """The columns ``keep`` with n_symbols and cost, the sum of negative log probabilities.

    Reads model_lang and the text, which may stand inside a kept struct, so that it is sent once.
    With ``pooled`` there is also the cost by the model of all languages.
    """
    rows = documents.select(*keep, *([] if inside else ["text"]), F.col("model_lang").alias("model"))
    names = ["cost", "pooled"] if pooled else ["cost"]
    schema = rows.select(*keep, F.lit(0).cast("long").alias("n_symbols"), *(F.lit(0.0).alias(x) for x in names)).schema

    def run(batches):
        held: dict = {}  # the last ones used

        def table(lang):
            found = held.pop(lang, None)
            if found is None:
                if len(held) >= HELD:
                    old = next(iter(held))
                    del held[old]
                    vars(shared[old]).pop("_value", None)  # can be read again
                found = shared[lang].value
            held[lang] = found
            return found

        for batch in parts(batches):
            data, offsets = buffers(pc.struct_field(batch.column(inside), "text") if inside else batch.column("text"))
            own = np.array([x if x in shared else ALL for x in batch.column("model").to_pylist()], object)
            total = np.zeros((len(names), batch.num_rows))
            i = 0
            while i < batch.num_rows and shared:
                j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + STEP, "right")) - 1)
                for at in range(int(offsets[i]), int(offsets[j]), STEP):  # a very long text is alone, in several parts
                    end = min(at + STEP, int(offsets[j]))
                    back = min(2, at - int(offsets[i]))
                    inner = np.clip(offsets[i:j + 1], at - back, end) - (at - back)
                    gram = trigrams(data[at - back:end], inner)[back:]
                    edges = np.append(0, np.cumsum(np.diff(np.clip(offsets[i:j + 1], at, end))))
                    cost = np.empty(len(gram), np.float32)
                    for row in np.argsort(own[i:j], kind="stable"):
                        a, b = edges[row], edges[row + 1]
                        np.take(table(own[i + row]), gram[a:b], out=cost[a:b], mode="clip")
                    for k, values in enumerate([cost, table(ALL)[gram]] if pooled else [cost]):
                        sums = np.append(0, np.cumsum(values, dtype=np.float64))
                        total[k, i:j] += sums[edges[1:]] - sums[edges[:-1]]
                i = j
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.diff(offsets)), *(pa.array(x) for x in total)], names=[*keep, "n_symbols", *names])

    return rows.mapInArrow(run, schema)


def judge(documents: DataFrame, labels: DataFrame, quantile: float = QUANTILE) -> DataFrame:
    """The rows of ``documents`` as struct ``row``, with perplexity, threshold and kept."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select("doc_id").distinct()
    # the labels grow with the documents: a merge join at every size, so the plan doesn't turn at some
    good = good.hint("merge")
    filled = documents.where(F.length("text") > 0)
    listed = filled.where(F.col("lang") != ALL).select("doc_id", "lang").join(good, "doc_id", "left_semi").groupBy("lang").count()
    langs = [r["lang"] for r in listed.where(F.col("count") >= LEAST).select("lang").collect()]
    model_lang = F.when(F.col("lang").isin(langs), F.col("lang")).otherwise(ALL)
    trusted = filled.select("doc_id", "lang", "text").join(good, "doc_id", "left_semi")
    shared = fit(trusted.withColumn("lang", model_lang)).shared(documents.sparkSession.sparkContext)

    rows = documents.select(F.struct(*documents.columns).alias("row"), model_lang.alias("model_lang"))
    scored = costs(rows, shared, ["row", "model_lang"], inside="row")
    figures = documents.select("doc_id", "text", model_lang.alias("model_lang"))
    figures = written(costs(figures, shared, ["doc_id", "model_lang"], pooled=True).where("n_symbols > 0"), "costs")
    known = figures.join(good, "doc_id", "left_semi")
    both = known.where(F.col("model_lang") != ALL).select("model_lang", "n_symbols", "cost").unionByName(
        known.select(F.lit(ALL).alias("model_lang"), "n_symbols", F.col("pooled").alias("cost")))
    return verdicts(scored, both, quantile)


def verdicts(scored: DataFrame, both: DataFrame, quantile: float) -> DataFrame:
    """row, perplexity, threshold, kept from row, model_lang, n_symbols, cost; mean and threshold of a model are those of its rows in ``both``."""
    means = {r["model_lang"]: r["mean"] for r in both.groupBy("model_lang").agg(
        (F.sum("cost") / F.sum("n_symbols")).alias("mean")).collect()}  # one for each model
    if not means:
        return scored.select("row", F.lit(None).cast("double").alias("perplexity"), F.lit(None).cast("double").alias("threshold"),
                             (F.col("n_symbols") > 0).alias("kept"))
    # in line and not joined, so that the quantiles are combined before their shuffle
    mean = F.create_map(*[F.lit(x) for pair in means.items() for x in pair])
    shrunk = F.exp((F.col("cost") + PRIOR * F.col("mean")) / (F.col("n_symbols") + PRIOR))
    limits = (both.withColumn("mean", F.try_element_at(mean, F.col("model_lang"))).where("mean is not null")
              .groupBy("model_lang").agg(F.percentile_approx(shrunk, quantile, 10_000).alias("threshold")))
    found = {r["model_lang"]: (means[r["model_lang"]], r["threshold"]) for r in limits.collect()}
    pick = F.create_map(*[x for lang, (m, t) in found.items() for x in (F.lit(lang), F.struct(F.lit(m).alias("mean"), F.lit(t).alias("threshold")))])
    own = F.coalesce(F.try_element_at(pick, F.col("model_lang")), F.try_element_at(pick, F.lit(ALL)))
    scored = scored.withColumn("own", own).withColumn("mean", F.col("own.mean"))
    perplexity = F.when(F.col("n_symbols") > 0, shrunk)
    return scored.select("row", perplexity.alias("perplexity"), F.col("own.threshold").alias("threshold"),
                         F.coalesce(perplexity <= F.col("own.threshold"), F.lit(False)).alias("kept"))


def quality_report(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, perplexity, threshold, kept per row."""
    return judge(documents.select("doc_id", "lang", "text"), labels).select(
        "row.doc_id", "row.lang", "perplexity", "threshold", "kept")
