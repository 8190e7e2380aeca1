"""Language of texts by words, and by shorter and shorter character n-grams for words not known.

A word that training has seen scores the logarithm of its frequency in each language. Any other word is
scored by the n-grams of the longest length of which the model knows at least one, from ``LONGEST`` down
to single letters. A text has the language with the largest mean over its words.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmill.llm.tables import Carried, documents, slices
from starmill.sources.shared import Scratch

LONGEST = 5
# Training reads about so many documents of each language, whole; chosen by a hash of doc_id.
SAMPLE_PER_LANGUAGE = 2_000
# Entries of the model per language and kind (words, n-grams of each length).
ENTRIES = 10_000
# A word or n-gram has to occur so often to be an entry.
LEAST_COUNT = 2
# Log frequency of what a language never had, below the rarest entry it could have had.
UNSEEN = -1.0
# Words whose scores a task remembers.
REMEMBERED_WORDS = 400_000
# How fast certainty grows with the number of words.
WORDS_OF_EVIDENCE = 20

LETTERS = regex.compile(r"\p{L}+")
NONE = "und"


def words_of(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def grams_of(word: str, n: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + n] for i in range(len(padded) - n + 1)] if n > 1 else list(word)


def bucket(column: str, of: int) -> Column:
    """crc32 of a column as text, modulo ``of``; -1 for NULL."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % of, F.lit(-1))


def sample_per_class(rows: DataFrame, label: str, about: int) -> DataFrame:
    """About ``about`` rows of each value of ``label``, chosen by a hash of ``doc_id`` and evenly.

    Rows of a value with no more than ``about`` are all kept. ``rows`` has ``doc_id`` and ``label``.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("_rows"))
    shares = {r[label]: min(1.0, about / r["_rows"]) for r in counts.collect()}
    if not shares:
        return rows
    share = F.lit(0.0)
    for value, part in shares.items():
        share = F.when(F.col(label) == F.lit(value), F.lit(part)).otherwise(share)
    spread = F.pmod(F.xxhash64(F.lit("sample"), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    return rows.where(spread < share)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words (length 0) and n-grams per language; kinds and languages of one task."""
    counts: dict[tuple[str, int], Counter[str]] = defaultdict(Counter)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            words = Counter(words_of(text))
            counts[lang, 0].update(words)
            for word, times in words.items():
                for n in range(1, LONGEST + 1):
                    own = counts[lang, n]
                    for gram in grams_of(word, n):
                        own[gram] += times
    for (lang, n), found in counts.items():
        entries = list(found.items())
        for at in range(0, len(entries), 50_000):
            keys, times = zip(*entries[at:at + 50_000])
            yield pa.RecordBatch.from_pydict({
                "lang": pa.array([lang] * len(keys), pa.string()), "n": pa.array([n] * len(keys), pa.int32()),
                "entry": pa.array(keys, pa.string()), "times": pa.array(times, pa.int64())})


class LanguageModel:
    """Log frequencies per language of words and n-grams; unknown in a language means its floor."""

    def __init__(self, counts: dict[int, dict[str, dict[str, int]]]):
        """``counts``: by length (0: words), then language, then entry."""
        self.languages = sorted({lang for by_lang in counts.values() for lang in by_lang})
        self.rows: dict[int, dict[str, int]] = {}
        self.scores: dict[int, np.ndarray] = {}
        for n, by_lang in counts.items():
            totals = {lang: sum(found.values()) for lang, found in by_lang.items()}
            floors = np.asarray([UNSEEN - np.log(max(totals.get(lang, 0), 10)) for lang in self.languages])
            entries = sorted({entry for found in by_lang.values() for entry in found})
            rows = {entry: row for row, entry in enumerate(entries)}
            scores = np.tile(floors, (len(rows), 1))
            for column, lang in enumerate(self.languages):
                for entry, times in by_lang.get(lang, {}).items():
                    scores[rows[entry], column] = np.log(times / totals[lang])
            self.rows[n], self.scores[n] = rows, scores.astype(np.float32)
        self._known: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.languages)), dtype=np.float32)

    def score_words(self, words: list[str]) -> np.ndarray:
        """Log frequencies of words, a row each: their own, or the mean over their longest known n-grams."""
        found = np.zeros((len(words), len(self.languages)), dtype=np.float32)
        own = self.rows.get(0, {})
        hits: dict[int, tuple[list[int], list[int], list[int]]] = {
            n: ([], [], []) for n in self.rows}  # places in words, numbers of hits, rows hit
        for place, word in enumerate(words):
            row = own.get(word)
            if row is not None:
                for held, value in zip(hits[0], (place, 1, row)):
                    held.append(value)
                continue
            for n in range(LONGEST, 0, -1):
                known = self.rows.get(n)
                rows = [known[gram] for gram in grams_of(word, n) if gram in known] if known else None
                if rows:
                    places, numbers, flat = hits[n]
                    places.append(place)
                    numbers.append(len(rows))
                    flat += rows
                    break
        for n, (places, numbers, flat) in hits.items():
            if places:
                begins = np.cumsum(numbers) - numbers
                found[places] = (np.add.reduceat(self.scores[n][flat], begins, axis=0)
                                 / np.asarray(numbers, dtype=np.float32)[:, None])
        return found

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """Language and how sure it is, 0 to 1, of each text; ``und`` without letters or learned languages."""
        split = [words_of(text) for text in texts]
        if not self.languages:
            return [(NONE, 0.0)] * len(texts)
        if len(self._known) > REMEMBERED_WORDS:
            self._known.clear()
            self._scores = self._scores[:0]
        new = list(set().union(*split).difference(self._known))
        self._known.update(zip(new, range(len(self._known), len(self._known) + len(new))))
        self._scores = np.concatenate([self._scores, self.score_words(new)])
        results = []
        for words in split:
            if not words:
                results.append((NONE, 0.0))
                continue
            at = np.fromiter(map(self._known.__getitem__, words), dtype=np.int64, count=len(words))
            mean = self._scores[at].mean(axis=0, dtype=np.float64) * min(len(words), WORDS_OF_EVIDENCE)
            odds = np.exp(mean - mean.max())
            best = int(odds.argmax())
            results.append((self.languages[best], float(odds[best] / odds.sum())))
        return results


def learn(labelled: DataFrame, about: int = SAMPLE_PER_LANGUAGE, entries: int = ENTRIES,
          scratch: Scratch | None = None) -> LanguageModel:
    """A model from ``doc_id``, ``text``, ``lang`` of a bounded sample of each language's documents.

    Rows with NULL in ``lang`` or ``text`` teach nothing. The driver gets at most ``entries`` words and
    n-grams of each length per language.
    """
    rows = labelled.where("lang IS NOT NULL AND text IS NOT NULL")
    sample = sample_per_class(rows, "lang", about).select("lang", "text")
    scratch = scratch or Scratch(labelled.sparkSession, "language")
    counted = scratch.table(sample.mapInArrow(_counted, "lang string, n int, entry string, times long")
                            .groupBy("lang", "n", "entry").agg(F.sum("times").alias("times"))
                            .where(F.col("times") >= LEAST_COUNT))
    # The count that an entry needs to be among the first: from a histogram, without sorting a language
    # in one task. Entries with equal counts stay or go together.
    sizes = counted.groupBy("lang", "n", "times").agg(F.count("*").alias("entries"))
    histograms: dict[tuple[str, int], list[tuple[int, int]]] = defaultdict(list)
    for row in sizes.collect():
        histograms[row["lang"], row["n"]].append((row["times"], row["entries"]))
    least = F.lit(None).cast("long")
    for (lang, n), found in histograms.items():
        held, bound = 0, None
        for times, number in sorted(found, reverse=True):
            if held and held + number > entries:
                break
            held, bound = held + number, times
        least = F.when((F.col("lang") == lang) & (F.col("n") == n), F.lit(bound)).otherwise(least)
    counts: dict[int, dict[str, dict[str, int]]] = defaultdict(lambda: defaultdict(dict))
    for row in counted.where(F.col("times") >= least).collect():
        counts[row["n"]][row["lang"]][row["entry"]] = row["times"]
    return LanguageModel({n: dict(found) for n, found in counts.items()})


def _predicted(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = model.value
        for whole in batches:
            for batch in slices(whole, "text"):
                found = learned.predict([text or "" for text in batch.column("text").to_pylist()])
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                    "lang_pred": pa.array([f[0] for f in found], pa.string()),
                    "score": pa.array([f[1] for f in found], pa.float64())})
    return run


def identify(docs: DataFrame, model: LanguageModel, held_out: Column | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of each row, from the whole text alone.

    NULL texts and texts without a letter are ``und`` with score 0. Every row has one result row, also
    rows that share a ``doc_id`` or have none. Other columns are not looked at. An empty table gives an
    empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = (F.lit(False) if held_out is None else held_out).alias("held_out")
    table = Carried(docs.sparkSession, model)
    return docs.select("doc_id", held, "text").mapInArrow(
        _predicted(table), f"doc_id {kind}, held_out boolean, lang_pred string, score double")


# One fold in four is not learned from.
FOLDS, HELD_OUT = 4, 2


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = bucket("doc_id", FOLDS) == HELD_OUT
    return identify(docs, learn(docs.where(~held).select("doc_id", "text", "lang")), held)


QUERIES = {"op2_language_id": op2_language_id}
ORACLE: dict[str, str] = {}
