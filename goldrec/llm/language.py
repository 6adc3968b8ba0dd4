"""Language identification by words, backing off to character n-grams.

A known word counts its log frequency in each language. An unseen word is cut into character
n-grams of the padded word, the longest first: the first length of which at least half of the
n-grams are known gives the word's score, the mean of their log frequencies.

The classifier is fitted on about ``fit_rows`` of the labelled rows, chosen by the hash of their
text, and keeps at most ``max_words`` words and ``max_grams`` n-grams of each language, the most
frequent there, and is sent to every task. Every row is then predicted.

A null text, or one without a letter, is ``und`` with score 0. Without any labelled row everything
is ``und``. Ties go to the language that comes first by code point. Repeated rows each get their
row; other columns are ignored. A very long text is counted word by word. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = re.compile(r"[^\W\d_]+")
#: Letters with the marks that some scripts set on them; texts without such marks don't need it.
MARKED, HIGH = regex.compile(r"\p{L}[\p{L}\p{M}]*"), re.compile("[\u0300-\U0010ffff]")
LONGEST = 5
FIT_ROWS, MAX_WORDS, MAX_GRAMS = 20_000, 20_000, 20_000
UNKNOWN = "und"


def words_of(text: str) -> Counter:
    text = text.lower()
    seen = Counter((MARKED if HIGH.search(text) else WORD).findall(text))
    for w in [w for w in seen if not w.isalpha() and not any(c.isalpha() for c in w)]:
        del seen[w]  # raised digits and fractions are no letters
    return seen


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} " if n > 1 else word
    return [padded[i:i + n] for i in range(len(padded) - n + 1)]


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from fitting: the remainder of its id's checksum by 4 is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def unit_counts(labelled: DataFrame) -> DataFrame:
    """lang, kind (0 for words, else the n-gram length), unit, n."""

    def run(batches):
        for batch in batches:
            words = defaultdict(Counter)
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words[lang].update(words_of(text))
            for lang, seen in words.items():
                grams = Counter()
                for word, n in seen.items():
                    for size in range(1, LONGEST + 1):
                        for gram in grams_of(word, size):
                            grams[gram] += n
                units = [(0, w, n) for w, n in seen.items()] + [(len(g), g, n) for g, n in grams.items()]
                if units:
                    kinds, names, counts = zip(*units)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(units)), pa.array(kinds, pa.int32()), pa.array(names), pa.array(counts, pa.int64())],
                        names=["lang", "kind", "unit", "n"])

    return (labelled.select("lang", "text").mapInArrow(run, "lang string, kind int, unit string, n long")
            .groupBy("lang", "kind", "unit").agg(F.sum("n").alias("n")))


class Model:
    """Log frequencies by word and n-gram, one number per language."""

    def __init__(self, rows: list[tuple[str, int, str, int]]):
        self.langs = sorted({r[0] for r in rows})
        place = {lang: i for i, lang in enumerate(self.langs)}
        self.units: dict[int, dict[str, int]] = defaultdict(dict)
        for _, kind, unit, _ in rows:
            self.units[kind].setdefault(unit, len(self.units[kind]))
        self.logs = {kind: np.full((len(units), len(self.langs)), 0.5) for kind, units in self.units.items()}
        for lang, kind, unit, n in rows:
            self.logs[kind][self.units[kind][unit], place[lang]] += n
        for kind, table in self.logs.items():
            self.logs[kind] = np.log(table / table.sum(axis=0)).astype(np.float32)

    def word(self, word: str) -> np.ndarray:
        known = self.units[0].get(word) if 0 in self.units else None
        if known is not None:
            return self.logs[0][known]
        for n in range(min(LONGEST, len(word) + 2), 0, -1):
            grams, table = grams_of(word, n), self.units.get(n, {})
            found = [table[g] for g in grams if g in table]
            if found and 2 * len(found) >= len(grams):
                return self.logs[n][found].mean(axis=0)
        return np.zeros(len(self.langs), np.float32)


class Scorer:
    """Scores texts, remembering the words it has met: at most ``keep`` of them."""

    def __init__(self, model: Model, keep: int = 400_000):
        self.model, self.keep = model, keep
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.model.langs)), np.float32)

    def place(self, word: str) -> int:
        at = self.index.get(word)
        if at is None:
            at = len(self.index)
            if at == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[at] = self.model.word(word)
            self.index[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        seen = words_of(text or "")
        if not seen or not self.model.langs:
            return UNKNOWN, 0.0
        if len(self.index) > self.keep:
            self.forget()
        total = np.zeros(len(self.model.langs))
        items = list(seen.items())
        for i in range(0, len(items), self.keep // 4):
            part = items[i:i + self.keep // 4]
            if len(self.index) + len(part) > 2 * self.keep:
                self.forget()
            total += np.array([n for _, n in part], float) @ self.table_rows([w for w, _ in part])
        odds = np.exp(total - total.max())
        best = int(np.argmax(odds))
        return self.model.langs[best], float(odds[best] / odds.sum())

    def table_rows(self, words: list[str]) -> np.ndarray:
        places = [self.place(w) for w in words]
        return self.table[places]


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, max_words: int = MAX_WORDS, max_grams: int = MAX_GRAMS) -> Model:
    """A model from the columns text and lang. What reaches the driver is bounded by the parameters."""
    usable = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    share = min(1.0, fit_rows / max(1, usable.select("lang").count()))
    if share < 1:
        usable = usable.where(F.pmod(F.xxhash64("text"), F.lit(1_000_000)) < round(share * 1_000_000))
    counts = unit_counts(usable)
    often = Window.partitionBy("lang", F.col("kind") > 0).orderBy(F.desc("n"), "kind", "unit")
    most = F.when(F.col("kind") > 0, max_grams).otherwise(max_words)
    top = counts.where((F.col("n") > 1) | (F.col("kind") == 1)).withColumn("nth", F.row_number().over(often)).where(F.col("nth") <= most)
    kept = counts.join(top.select("kind", "unit").distinct(), ["kind", "unit"])
    found = kept.select("lang", "kind", "unit", "n").orderBy("kind", "unit", "lang").toArrow()
    return Model(list(zip(*(found.column(c).to_pylist() for c in found.column_names))))


def predict(documents: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Adds lang_pred and score to the columns ``keep``. Only the text is looked at."""
    rows = documents.select(*keep, "text")
    schema = rows.select(*keep, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in batches:
            found = [scorer.predict(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in keep), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return rows.mapInArrow(run, schema)


def identify(documents: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: fitted on the rows that aren't held out."""
    rows = documents.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text", "lang")
    return predict(rows, fit(rows.where(~F.col("held_out"))), ["doc_id", "held_out"])
