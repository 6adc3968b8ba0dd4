"""Toxicity by gradient-boosted trees over dense features, with isotonic calibration.

Features of a whole text: how dense words of a given lexicon and of a learned one are, how far the
learned ones lean to toxic texts, how many of them stand next to a second-person word, capitals,
shouted words, punctuation, words with digits or marks inside letters, and length. Words are also
looked up as they read without such disguise (digits and marks for letters, dots between letters,
letters drawn out).

The learned lexicon holds words and beginnings of words that labelled toxic texts have more often
than others, by log odds that are Z standard errors above 0. A text's own words would make it look
better than it is, so the labelled texts are cut in two halves and the features for fitting use the
lexicon of the other half; all other texts get the lexicon of both. Trees are fitted on most of the
labelled texts, and the calibration on the rest of them.

Labels are learned from rows whose crc32 of the id leaves no remainder 0 by HELD_OUT; at most about
FIT_ROWS of them, taken by a hash of the id, are the model's bounded sample, one text for each id and
each text once. Everything else covers all rows. Null texts are empty; an empty text has a score like any other (all its
features are 0). Ids without a label, null labels and null ids teach nothing. An id with several labels counts
as toxic if one of them is. Without both kinds of labels every score is the share of toxic ones, or 0 without
any. Repeated rows repeat; other columns are ignored; an empty table gives no rows. Very long texts
are read once, from end to end.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldrec.llm.common import written

HELD_OUT = 5
FIT_ROWS, LEXICON, Z, SUPPORT = 20_000, 4_000, 4.0, 4
TREES, DEPTH, STEP = 30, 3, 0.2
NEAR = 5  # words between a second-person word and a hit
STEMS = (4, 5, 6)

#: Insults in four languages.
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb loser losers scum trash pathetic worthless disgusting clown imbecile jerk fool
freak garbage filthy ugly coward bastard bitch whore slut asshole shit fuck fucking hate kill
idiotisch dumm blöd arschloch scheisse scheiße abschaum trottel depp hure wertlos ekelhaft verlierer
idiote imbécile stupide connard salaud pute merde ordure minable crétin débile dégoûtant
idiota estúpido estúpida imbécil basura escoria puta mierda asqueroso patético perdedor tonto
""".split())
#: Words of the second person in four languages.
YOU = frozenset("you your yours yourself u ur du dich dir dein deine euch ihr tu te toi ton ta tes vous votre vos usted ustedes tú ti tus vosotros".split())

WORD = re.compile(r"[^\W\d_]+")
#: From the start of a run without blanks, never giving back: linear in the text.
DISGUISED = re.compile(r"(?<![\w@$!*.\-])(?:[@$\d]++[^\W\d_]|[^\W\d_]++[\d@$!*.\-_]++[^\W\d_])[\w@$!*.\-]*+")
DRAWN = re.compile(r"([^\W\d_])\1\1+")
PLAIN = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})

FEATURES = ("given", "learned", "highest", "lean", "hits", "near_you", "you", "capitals", "shouted", "marks", "calls", "disguised", "uncovered", "drawn", "words")


def _kinds() -> np.ndarray:
    """Class of each byte: 1 capital, 2 small letter, 3 exclamation or question mark, 4 other mark, 0 else."""
    kind = np.zeros(256, np.uint8)
    kind[33:48] = kind[58:65] = kind[91:97] = kind[123:127] = 4
    kind[ord("A"):ord("Z") + 1], kind[ord("a"):ord("z") + 1] = 1, 2
    kind[[ord("!"), ord("?")]] = 3
    return kind


KINDS = _kinds()


def units(words: set[str]) -> set[str]:
    """What the learned lexicon may hold: words, and beginnings of longer words (marked by ^)."""
    return words | {"^" + w[:n] for w in words for n in STEMS if len(w) > n}


def uncovered(text: str) -> list[str]:
    """Words as they read without digits, marks and drawn-out letters in them."""
    found = [m.lower().translate(PLAIN) for m in DISGUISED.findall(text)]
    drawn = [DRAWN.sub(r"\1", m.group().lower()) for m in WORD.finditer(text) if DRAWN.search(m.group())] if DRAWN.search(text) else []
    return found + drawn


class Lexicon:
    """Log odds of units, and what a word must be or begin with to have any."""

    def __init__(self, odds: dict[str, float]):
        self.odds = odds
        self.whole = INSULTS | {u for u in odds if u[0] != "^"}
        self.starts = {u[1:1 + STEMS[0]] for u in odds if u[0] == "^"}

    def weight(self, word: str) -> float:
        begun = [self.odds.get("^" + word[:n], 0.0) for n in STEMS if len(word) > n]
        return max(self.odds.get(word, 0.0), *begun) if begun else self.odds.get(word, 0.0)

    def weights(self, words: set[str]) -> dict[str, float]:
        """Weight of each word that is an insult or has odds."""
        begun = [w for w in words if w[:STEMS[0]] in self.starts]
        found = {w: self.weight(w) for w in (self.whole & words).union(begun)}
        return {w: x for w, x in found.items() if x or w in INSULTS}


def features(text: str, lexicon: Lexicon) -> list[float]:
    """FEATURES of a whole text."""
    cased = WORD.findall(text)
    if not cased:
        return [0.0] * len(FEATURES)
    words = [w.lower() for w in cased]
    distinct = set(words)
    weight = lexicon.weights(distinct)
    places = [i for i, w in enumerate(words) if w in weight] if weight else []
    you = [i for i, w in enumerate(words) if w in YOU] if YOU & distinct else []
    hidden = uncovered(text)
    shown = lexicon.weights(set(hidden))
    weights = [weight[words[i]] for i in places] + [shown[w] for w in hidden if w in shown]
    n_shown = len(weights) - len(places)
    near = 0
    if you and places:
        at = np.array(you)
        right = np.searchsorted(at, places)
        gap = np.minimum(np.abs(at[np.minimum(right, len(at) - 1)] - places), np.abs(at[np.maximum(right - 1, 0)] - places))
        near = int((gap <= NEAR).sum())
    kind = np.bincount(KINDS[np.frombuffer(text.encode(), np.uint8)], minlength=5)
    n, size = len(words), max(1, len(text))
    return [
        sum(words[i] in INSULTS for i in places) / n,
        sum(weight[words[i]] > 0 for i in places) / n,
        max(weights, default=0.0),
        sum(weights) / n,
        math.log1p(len(weights)),
        near / n,
        len(you) / n,
        float(kind[1] / max(1, kind[1] + kind[2])),
        len([w for w in cased if w.isupper() and len(w) > 2]) / n,
        float((kind[3] + kind[4]) / size),
        float(kind[3] / size),
        len(hidden) / n,
        n_shown / n,
        len(DRAWN.findall(text)) / n,
        math.log1p(n),
    ]


def held_out() -> Column:
    """Whether a row's label may not be learned from."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % HELD_OUT == 0, F.lit(False))


def fitting_rows(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """toxic, text, half and part of the sample: at most about ``rows`` labelled ids, each text once."""
    known = labels.where("toxic is not null and doc_id is not null").where(~held_out())
    by_id = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, rows / max(1, by_id.count()))
    taken = by_id.where(F.pmod(F.xxhash64("doc_id"), F.lit(2**20)) < F.lit(math.ceil(share * 2**20)))
    texts = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    one = texts.join(F.broadcast(taken), "doc_id").groupBy("doc_id").agg(  # as many rows as the sample has
        F.max("toxic").alias("toxic"), F.min("text").alias("text"))
    digest = F.xxhash64("text")
    return one.groupBy("text").agg(F.max("toxic").alias("toxic")).select(
        F.col("toxic").cast("double").alias("toxic"), "text",
        F.pmod(digest, F.lit(2)).cast("int").alias("half"), F.pmod(F.shiftright(digest, 8), F.lit(4)).cast("int").alias("part"))


def lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """The learned lexicons of half 0, of half 1 and of both: unit to log odds, the LEXICON surest ones."""
    groups = "half int, unit string, toxic long, clean long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for toxic, text, half in zip(*(batch.column(c).to_pylist() for c in ("toxic", "text", "half"))):
                found = units({w.lower() for w in WORD.findall(text)}) | {""}  # "": the texts
                counts[toxic > 0].update((half, u) for u in found)
            keys = list(counts[0].keys() | counts[1].keys())
            yield pa.RecordBatch.from_pydict({
                "half": pa.array([k[0] for k in keys], pa.int32()), "unit": pa.array([k[1] for k in keys], pa.string()),
                "toxic": pa.array([counts[1][k] for k in keys], pa.int64()), "clean": pa.array([counts[0][k] for k in keys], pa.int64())})

    counted = written(sample.select("toxic", "text", "half").mapInArrow(run, groups).groupBy("half", "unit").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "units")
    both = counted.groupBy("unit").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    return [_surest(counts) for counts in (*[counted.where(F.col("half") == h) for h in (0, 1)], both)]


def _surest(counts: DataFrame) -> dict[str, float]:
    total = counts.where("unit = ''").agg(F.sum("toxic"), F.sum("clean")).first()
    n_toxic, n_clean = (float(x or 0) for x in total)
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    odds = F.log(toxic / (n_toxic + 1)) - F.log(clean / (n_clean + 1))
    scored = counts.where(F.col("unit") != "").where(F.col("toxic") >= SUPPORT).select(
        "unit", odds.alias("odds"), (odds / F.sqrt(1 / toxic + 1 / clean)).alias("z")).where(F.col("z") >= Z)
    best = scored.orderBy(F.desc("z"), "unit").limit(LEXICON).collect()  # bounded by LEXICON
    return {r["unit"]: r["odds"] for r in best}


def with_features(rows: DataFrame, chosen: list[dict[str, float]], which: str | None = None) -> DataFrame:
    """Adds ``features`` in place of text. ``which`` names the column with the number of the row's lexicon."""
    kept = [c for c in rows.columns if c != "text"]
    known = rows.sparkSession.sparkContext.broadcast(chosen)  # at most LEXICON entries each

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = [Lexicon(odds) for odds in known.value]
        for batch in batches:
            texts = batch.column("text").to_pylist()
            numbers = batch.column(which).to_pylist() if which else [0] * len(texts)
            found = [features(t or "", lexicon[i]) for t, i in zip(texts, numbers)]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(found, pa.list_(pa.float64()))], names=[*kept, "features"])

    schema = rows.select(*kept, F.array(F.lit(0.0)).alias("features")).schema
    return rows.mapInArrow(run, schema).withColumn("features", array_to_vector("features"))


@dataclass
class Model:
    """Lexicon, trees and calibration; ``share`` is the score where there are no trees."""

    lexicon: dict[str, float]
    share: float
    trees: object = None
    curve: object = None

    def score(self, rows: DataFrame) -> DataFrame:
        """Adds ``score`` (0 to 1) in place of text."""
        if self.trees is None:
            return rows.drop("text").withColumn("score", F.lit(self.share))
        found = self._margin(with_features(rows, [self.lexicon]))
        if self.curve is None:
            return found.withColumnRenamed("raw", "score")
        return self.curve.transform(found).withColumnRenamed("prediction", "score").drop("raw")

    def _margin(self, rows: DataFrame) -> DataFrame:
        scored = self.trees.transform(rows)
        return scored.withColumn("raw", vector_to_array("probability")[1]).drop("features", "probability", "rawPrediction", "prediction")


def both_kinds(rows: DataFrame) -> tuple[int, int]:
    found = rows.agg(F.count_if(F.col("toxic") == 0), F.count_if(F.col("toxic") > 0)).first()
    return found[0], found[1]


def fit(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Model:
    sample = written(fitting_rows(documents, labels, rows), "sample")
    clean, toxic = both_kinds(sample)
    if not clean or not toxic:
        return Model({}, toxic / max(1, clean + toxic))
    first, second, both = lexicons(sample)
    # half 0 is seen with the lexicon of half 1, and the other way round
    seen = written(with_features(sample, [second, first], "half").withColumn("features", vector_to_array("features")), "features")
    seen = seen.withColumn("features", array_to_vector("features"))
    fitted, held = seen.where("part > 0"), seen.where("part = 0")
    calibrated = all(both_kinds(held)) and all(both_kinds(fitted))
    trees = GBTClassifier(labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=1).fit(
        (fitted if calibrated else seen).repartition(4, "half", "part"))
    model = Model(both, toxic / (clean + toxic), trees)
    if calibrated:
        model.curve = IsotonicRegression(featuresCol="raw", labelCol="toxic").fit(model._margin(held).select("raw", "toxic"))
    return model


def toxicity(documents: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    texts = documents.select("doc_id", held_out().alias("held_out"), "text")
    scored = fit(documents, labels, rows).score(texts)
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
