"""Toxicity of texts by a bidirectional gated recurrent network with attention, trained in numpy.

A word enters as its own vector and as the mean of vectors of its byte n-grams, so that spellings never
seen in training have a meaning too. Two gated recurrent units read a window of words, one from each end;
attention weighs the words' states, and their weighted mean gives the window's score. Windows overlap by
half and cover the whole text; a document scores as its worst window. Training looks at the worst window of
each document, clean or toxic, and at some others of clean ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from starmill.llm.language import bucket, sample_per_class
from starmill.llm.tables import Carried, documents, released, slices, text_of
from starmill.sources.tables import read_table

WINDOW, STRIDE = 24, 12
HIDDEN, WORD_SIZE, GRAM_SIZE = 8, 8, 8
GRAM_BUCKETS = 1 << 15
GRAM_LENGTHS = (3, 4, 5, 6)
# The words with vectors of their own: those in most documents of the sample.
VOCABULARY = 8_000
LEAST_DOCUMENTS = 3
# Training reads about so many labelled documents of each class, whole; chosen by a hash of doc_id.
SAMPLE_PER_CLASS = 800
EPOCHS, BATCH, RATE = 6, 256, 0.015
# A small sample is gone through more often, for so many steps, and its toxic windows are repeated until they
# are this share.
LEAST_STEPS, TOXIC_SHARE = 120, 0.12
# Epochs before which the worst windows are looked up anew.
LOOKUPS = (1, 3)
SEED = 11
THRESHOLD = 0.7
# Bytes of text whose windows are scored together, and windows that go through the network at once.
TEXT_AT_A_TIME = 2 << 20
WINDOWS_AT_A_TIME = 4096
# Words whose vectors are put together at once.
WORDS_AT_A_TIME = 8192

LETTERS = re.compile(r"[^\W\d_]+")


class Numbering(dict):
    """Numbers words in the order they come, from 1; 0 is padding."""

    def __missing__(self, word: str) -> int:
        self[word] = found = len(self) + 1
        return found


def windows_of(texts: Sequence[str], numbering: Numbering) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of all overlapping windows of all texts, and the text each window is of."""
    rows, owners = [], []
    for owner, text in enumerate(texts):
        words = np.fromiter(map(numbering.__getitem__, LETTERS.findall(text.lower())), dtype=np.int32)
        if not len(words):
            continue
        if len(words) <= WINDOW:
            padded = np.zeros((1, WINDOW), dtype=np.int32)
            padded[0, :len(words)] = words
            rows.append(padded)
        else:
            begins = np.arange(0, len(words) - WINDOW + STRIDE, STRIDE)
            begins[-1] = len(words) - WINDOW
            rows.append(words[begins[:, None] + np.arange(WINDOW)])
        owners.append(np.full(len(rows[-1]), owner))
    if not rows:
        return np.zeros((0, WINDOW), dtype=np.int32), np.zeros(0, dtype=np.int64)
    return np.concatenate(rows), np.concatenate(owners)


def grams_of(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte n-grams of every word with its borders, and where each word's begin."""
    raw = [f"^{word}$".encode() for word in words]
    sizes = np.asarray([len(w) for w in raw])
    letters = np.frombuffer(b"".join(raw), dtype=np.uint8).astype(np.uint64)
    word_of = np.repeat(np.arange(len(raw)), sizes)
    found, owner = [], []
    for n in GRAM_LENGTHS:
        number = len(letters) - n + 1
        if number <= 0:
            continue
        inside = np.flatnonzero(word_of[:number] == word_of[n - 1:])
        value = np.full(len(inside), n, dtype=np.uint64)
        for i in range(n):
            value = (value * np.uint64(0x100000001B3)) ^ letters[inside + i]
        found.append(((value * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)) % np.uint64(GRAM_BUCKETS))
        owner.append(word_of[inside])
    found, owner = np.concatenate(found).astype(np.int32), np.concatenate(owner)
    order = np.argsort(owner, kind="stable")
    counts = np.bincount(owner, minlength=len(raw))  # every word with its borders has a 3-gram
    return found[order], np.concatenate([[0], np.cumsum(counts)[:-1]])


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Words:
    """The different words of some texts, as the network takes them in. Row 0 is padding."""

    known: np.ndarray  # row in the table of word vectors
    grams: np.ndarray
    begins: np.ndarray

    @classmethod
    def of(cls, words: Sequence[str], vocabulary: dict[str, int]) -> Words:
        known = np.asarray([0, *[vocabulary.get(w, 0) for w in words]], dtype=np.int32)
        grams, begins = grams_of(words) if len(words) else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        return cls(known, grams, begins)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(np.append(self.begins, len(self.grams)))


class Network:
    """Parameters and passes of the network; directions are 0 (forward) and 1 (backward)."""

    def __init__(self, vocabulary: dict[str, int], seed: int = SEED):
        random = np.random.default_rng(seed)
        size, h = WORD_SIZE + GRAM_SIZE, HIDDEN

        def normal(*shape, scale):
            return (random.standard_normal(shape) * scale).astype(np.float32)

        self.vocabulary = vocabulary
        self.p = {"word": normal(len(vocabulary) + 1, WORD_SIZE, scale=0.1),
                  "gram": normal(GRAM_BUCKETS, GRAM_SIZE, scale=0.1),
                  "attend": normal(2 * h, scale=0.3), "out": normal(2 * h, scale=0.3),
                  "bias": np.zeros(1, dtype=np.float32)}
        for d in (0, 1):
            self.p[f"in{d}"] = normal(size, 3 * h, scale=size ** -0.5)
            self.p[f"rec{d}"] = normal(h, 3 * h, scale=h ** -0.5)
            self.p[f"add{d}"] = np.zeros(3 * h, dtype=np.float32)

    def inputs(self, words: Words) -> np.ndarray:
        """Vectors of the words."""
        found = np.zeros((len(words.known), WORD_SIZE + GRAM_SIZE), dtype=np.float32)
        found[:, :WORD_SIZE] = self.p["word"][words.known]
        for at in range(0, len(words.begins), WORDS_AT_A_TIME):
            begins = words.begins[at:at + WORDS_AT_A_TIME]
            end = words.begins[at + WORDS_AT_A_TIME] if at + WORDS_AT_A_TIME < len(words.begins) else len(words.grams)
            found[at + 1:at + 1 + len(begins), WORD_SIZE:] = np.add.reduceat(
                self.p["gram"][words.grams[begins[0]:end]], begins - begins[0], axis=0)
        if len(words.grams):
            found[1:, WORD_SIZE:] /= words.counts[:, None]
        return found

    def forward(self, rows: np.ndarray, vectors: np.ndarray, keep: list | None = None) -> np.ndarray:
        """Logits of windows; with ``keep`` also what the backward pass needs."""
        h, (number, length) = HIDDEN, rows.shape
        mask = (rows > 0).astype(np.float32)
        attention = np.zeros((number, length), dtype=np.float32)
        value = np.zeros((number, length), dtype=np.float32)
        for d in (0, 1):
            projected = vectors @ self.p[f"in{d}"] + self.p[f"add{d}"]
            u = self.p[f"rec{d}"]
            u_gates, u_new = np.ascontiguousarray(u[:, :2 * h]), np.ascontiguousarray(u[:, 2 * h:])
            part = slice(d * h, (d + 1) * h)
            looks = np.stack([self.p["attend"][part], self.p["out"][part]], axis=1)
            state = np.zeros((number, h), dtype=np.float32)
            for t in range(length) if d == 0 else range(length - 1, -1, -1):
                a = projected[rows[:, t]]
                gates = sigmoid(a[:, :2 * h] + state @ u_gates)
                z, r = gates[:, :h], gates[:, h:]
                back = state @ u_new
                new = np.tanh(a[:, 2 * h:] + r * back)
                m = mask[:, t, None]
                after = state + m * (1 - z) * (new - state)
                if keep is not None:
                    keep.append((d, t, state, z, r, back, new, after))
                state = after
                seen = state @ looks
                attention[:, t] += seen[:, 0]
                value[:, t] += seen[:, 1]
        attention = np.where(mask > 0, attention, -np.inf)
        weight = np.exp(attention - attention.max(axis=1, keepdims=True))
        weight /= weight.sum(axis=1, keepdims=True)
        if keep is not None:
            keep.append((mask, weight, value))
        return (weight * value).sum(axis=1) + self.p["bias"][0]

    def gradients(self, rows: np.ndarray, words: Words, targets: np.ndarray) -> dict:
        """Gradients of the logistic loss."""
        h, keep = HIDDEN, []
        vectors = self.inputs(words)
        logits = self.forward(rows, vectors, keep)
        mask, weight, value = keep.pop()
        g = {name: np.zeros_like(p) for name, p in self.p.items()}
        d_logit = ((sigmoid(logits) - targets) / len(targets)).astype(np.float32)
        g["bias"][0] = d_logit.sum()
        d_value = d_logit[:, None] * weight
        d_attention = d_value * (value - (weight * value).sum(axis=1, keepdims=True))
        d_vectors = np.zeros_like(vectors)
        order = np.argsort(rows, axis=None, kind="stable")
        present, begins = np.unique(rows.ravel()[order], return_index=True)
        for d in (1, 0):
            part = slice(d * h, (d + 1) * h)
            u = self.p[f"rec{d}"]
            d_state = np.zeros((len(rows), h), dtype=np.float32)
            d_steps = np.zeros((*rows.shape, 3 * h), dtype=np.float32)
            for _, t, state, z, r, back, new, after in reversed([k for k in keep if k[0] == d]):
                g["attend"][part] += d_attention[:, t] @ after
                g["out"][part] += d_value[:, t] @ after
                total = (d_state + d_attention[:, t, None] * self.p["attend"][part]
                         + d_value[:, t, None] * self.p["out"][part])
                m = mask[:, t, None]
                d_new = total * m * (1 - z) * (1 - new ** 2)
                d_z = total * m * (state - new) * z * (1 - z)
                d_r = d_new * back * r * (1 - r)
                d_gates = np.concatenate([d_z, d_r], axis=1)
                d_back = d_new * r
                g[f"rec{d}"][:, :2 * h] += state.T @ d_gates
                g[f"rec{d}"][:, 2 * h:] += state.T @ d_back
                d_state = total * (1 - m * (1 - z)) + d_gates @ u[:, :2 * h].T + d_back @ u[:, 2 * h:].T
                d_steps[:, t, :2 * h], d_steps[:, t, 2 * h:] = d_gates, d_new
            d_projected = np.zeros((len(vectors), 3 * h), dtype=np.float32)
            d_projected[present] = np.add.reduceat(d_steps.reshape(-1, 3 * h)[order], begins, axis=0)
            g[f"add{d}"] = d_projected.sum(axis=0)
            g[f"in{d}"] = vectors.T @ d_projected
            d_vectors += d_projected @ self.p[f"in{d}"].T
        np.add.at(g["word"], words.known, d_vectors[:, :WORD_SIZE])
        g["word"][0] = 0
        if len(words.grams):
            counts = words.counts
            np.add.at(g["gram"], words.grams, np.repeat(d_vectors[1:, WORD_SIZE:] / counts[:, None], counts, axis=0))
        return g

    def scores(self, texts: Sequence[str]) -> np.ndarray:
        """The worst window of each text, 0 to 1; 0 without words."""
        numbering = Numbering()
        rows, owners = windows_of(texts, numbering)
        found = np.zeros(len(texts))
        if len(rows):
            vectors = self.inputs(Words.of(list(numbering), self.vocabulary))
            logits = np.concatenate([self.forward(rows[at:at + WINDOWS_AT_A_TIME], vectors)
                                     for at in range(0, len(rows), WINDOWS_AT_A_TIME)])
            np.maximum.at(found, owners, sigmoid(logits.astype(np.float64)))
        return found


def _pairs(member: np.ndarray, feature: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different (document, feature) pairs."""
    size = int(feature.max(initial=0)) + 1
    found = np.unique(member * size + feature)
    return found // size, found % size


def _rated(hits: np.ndarray, misses: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Smoothed log odds of features in so many toxic and clean documents; 0 for those in one only."""
    rate = (hits + 1) / (toxic.sum() + 2) / ((misses + 1) / ((~toxic).sum() + 2))
    return (np.log(rate) * (hits + misses > 1)).astype(np.float32)


def _log_odds(member: np.ndarray, feature: np.ndarray, toxic: np.ndarray, size: int) -> np.ndarray:
    """Log odds of features from the (document, feature) pairs in which they occur."""
    member, feature = _pairs(member, feature)
    bad = toxic[member]
    return _rated(np.bincount(feature[bad], minlength=size), np.bincount(feature[~bad], minlength=size), toxic)


def _gram_log_odds(words: Words, member: np.ndarray, word: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Log odds of n-grams from the (document, word) pairs, document by document."""
    hits = np.zeros((2, GRAM_BUCKETS), dtype=np.int64)
    ends = words.begins + words.counts
    for part in np.split(np.arange(len(member)), np.flatnonzero(np.diff(member)) + 1):
        if len(part):
            own = word[part] - 1
            found = [words.grams[b:e] for b, e in zip(words.begins[own], ends[own])]
            hits[int(toxic[member[part[0]]]), np.unique(np.concatenate(found))] += 1
    return _rated(hits[1], hits[0], toxic)


def train(texts: Sequence[str], labels: Sequence[int], seed: int = SEED) -> Network:
    """A network from labelled texts. Without texts of both classes it tells nothing apart."""
    toxic = np.asarray(labels, dtype=bool)
    numbering = Numbering()
    rows, owners = windows_of(texts, numbering)
    names = list(numbering)
    flat, of = rows.ravel(), np.repeat(owners, WINDOW)
    member, word = of[flat > 0], flat[flat > 0].astype(np.int64)
    in_document, different = _pairs(member, word)
    documents_with = np.bincount(different, minlength=len(names) + 1)
    frequent = sorted((-documents_with[i + 1], w) for i, w in enumerate(names)
                      if documents_with[i + 1] >= LEAST_DOCUMENTS)[:VOCABULARY]
    vocabulary = {w: row + 1 for row, (_, w) in enumerate(frequent)}
    network = Network(vocabulary, seed)
    if not toxic.any() or toxic.all() or not len(rows):
        network.p["out"][:] = 0
        network.p["bias"][0] = -4.0
        return network
    words = Words.of(names, vocabulary)
    # The first component of each vector starts as the log odds of what it stands for.
    known = words.known[word]
    network.p["word"][:, 0] = 0.5 * _log_odds(member[known > 0], known[known > 0], toxic, len(vocabulary) + 1)
    network.p["gram"][:, 0] = _gram_log_odds(words, in_document, different, toxic)

    random = np.random.default_rng(seed)
    mean = {n: np.zeros_like(p) for n, p in network.p.items()}
    square = {n: np.zeros_like(p) for n, p in network.p.items()}
    hint = network.inputs(words)[:, [0, WORD_SIZE]].sum(axis=1)
    score = np.sort(hint[rows], axis=1)[:, -3:].sum(axis=1)
    starts = np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]])
    step, epochs, epoch = 0, EPOCHS, 0
    while epoch < epochs:
        # The worst window of every document, by the hints first and then by the network itself.
        if epoch in [round(at * epochs / EPOCHS) for at in LOOKUPS]:
            vectors = network.inputs(words)
            score = np.concatenate([network.forward(rows[i:i + WINDOWS_AT_A_TIME], vectors)
                                    for i in range(0, len(rows), WINDOWS_AT_A_TIME)])
        best = np.maximum.reduceat(score, starts)
        top = np.flatnonzero(score >= np.repeat(best, np.diff(np.r_[starts, len(rows)])))
        worst = top[np.unique(owners[top], return_index=True)[1]]
        clean = np.flatnonzero(~toxic[owners])
        others = random.choice(clean, size=min(len(clean), 3 * len(worst)), replace=False)
        bad = worst[toxic[owners[worst]]]
        again = max(0, -(-int(TOXIC_SHARE * (len(worst) + len(others))) // max(len(bad), 1)) - 1)
        chosen = random.permutation(np.concatenate([worst, others, np.repeat(bad, again)]))
        epochs = max(EPOCHS, -(-LEAST_STEPS // -(-len(chosen) // BATCH)))
        for begin in range(0, len(chosen), BATCH):
            batch = chosen[begin:begin + BATCH]
            used, local = np.unique(rows[batch], return_inverse=True)
            if used[0] != 0:
                used, local = np.r_[0, used], local + 1
            own = Words.of([names[i - 1] for i in used[1:]], vocabulary)
            g = network.gradients(local.reshape(len(batch), WINDOW), own,
                                  toxic[owners[batch]].astype(np.float32))
            step += 1
            rate = RATE * (1 - epoch / epochs) + RATE / 20
            for n, p in network.p.items():
                mean[n] += 0.1 * (g[n] - mean[n])
                square[n] += 0.01 * (g[n] ** 2 - square[n])
                p -= rate * (mean[n] / (1 - 0.9 ** step)) / (np.sqrt(square[n] / (1 - 0.99 ** step)) + 1e-6)
        epoch += 1
    return network


def learn(docs: DataFrame, labels: DataFrame, about: int = SAMPLE_PER_CLASS) -> Network:
    """A network from a bounded sample of ``labels`` (doc_id, toxic) and the whole texts of its documents.

    Rows with a NULL label or text teach nothing; several labels of a document count as the worst.
    """
    known = (labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id")
             .agg(F.max("toxic").alias("toxic")))
    # Of bounded size: about twice SAMPLE_PER_CLASS ids.
    sample = F.broadcast(sample_per_class(known, "toxic", about))
    rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(sample, "doc_id").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return train([r["text"] for r in rows], [int(r["toxic"] > 0) for r in rows])


def _scored(network, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = network.value
        for whole in batches:
            for batch in slices(whole, "text", TEXT_AT_A_TIME):
                scores = model.scores(batch.column("text").to_pylist())
                columns = {n: batch.column(n) for n in batch.schema.names if n != "text"}
                yield pa.RecordBatch.from_pydict({
                    **columns, "score": pa.array(scores, pa.float64()),
                    "predicted": pa.array((scores >= threshold).astype(np.int32))})
    return run


def score_toxicity(docs: DataFrame, network: Network, held_out=None, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (0 to 1) and ``predicted`` of each row, from its whole text.

    NULL texts and texts without a letter score 0. Every row has one result row, also rows that share a
    ``doc_id`` or have none; other columns are not looked at. An empty table gives an empty result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    held = (F.lit(False) if held_out is None else held_out).alias("held_out")
    model = Carried(docs.sparkSession, network)
    return docs.select("doc_id", held, text_of().alias("text")).mapInArrow(
        released(_scored(model, threshold)), f"doc_id {kind}, held_out boolean, score double, predicted int")


def without_toxic(docs: DataFrame, network: Network, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``; see ``score_toxicity``."""
    model = Carried(docs.sparkSession, network)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learned = model.value
        for whole in batches:
            for batch in slices(whole, "text", TEXT_AT_A_TIME):
                scores = learned.scores([t or "" for t in batch.column("text").to_pylist()])
                yield batch.filter(pa.array(scores < threshold))

    return docs.mapInArrow(released(run), docs.schema)


# One fold in three is not learned from.
FOLDS, HELD_OUT = 3, 1


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held = bucket("doc_id", FOLDS) == HELD_OUT
    labels = read_table(spark, sf_dir, "labels").where(~held)
    return score_toxicity(docs, learn(docs, labels), held)


QUERIES = {"op6_toxicity": op6_toxicity}
ORACLE: dict[str, str] = {}
