"""A quality classifier on averaged subword embeddings with a softmax output, trained by stochastic gradient descent."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyworks.llm.words import encoded, mixed, slices, words_of

BUCKETS = 1 << 13
DIMENSIONS = 12
GRAMS = (2, 3, 4)

# At most so many labelled rows are collected for training, those of smallest hash.
TRAINING_ROWS = 6000
EPOCHS, LEAST_STEPS = 10, 1500  # few rows are gone through more often
BATCH = 32
RATE = 0.15

# Distinct words whose sums a Python worker keeps.
WORDS_KEPT = 400_000

# The bucket of a word that stands right behind itself; words and n-grams never hash to it.
# It counts as often as a word has n-grams or so.
REPEATED, REPEATED_COUNT = 0, 8

_NEXT = np.uint64(0x2545F4914F6CDD1D)
_WORD_SALT = np.uint64(0x51ED270B7F4A7C15)


def held_out(doc_id: Column) -> Column:
    """Rows that no label is learned from: crc32 of the id as text has remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def features(words: list[bytes], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """For each word its own bucket and those of its character n-grams, with marks at both ends: (index of the word, bucket)."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    marked = [f"<{w.decode(errors='replace')}>" for w in words]
    joined = np.frombuffer(("".join(marked) + "\0" * max(GRAMS)).encode("utf-32-le"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, marked), np.int64, len(words))
    ends = np.cumsum(lengths)
    word = np.repeat(np.arange(len(words)), lengths)
    left = ends[word] - np.arange(len(word))  # characters from here to the word's end
    codes = joined[: len(word)].copy()
    owners, found = [], []
    for n in range(2, max(GRAMS) + 1):
        codes = codes * _NEXT + joined[n - 1 : n - 1 + len(word)]
        if n in GRAMS:
            whole = left >= n
            owners.append(word[whole])
            found.append(mixed(codes[whole] + np.uint64(n << 40)))
    # The word itself: a polynomial of its characters with odd powers, taken back to its start.
    power = np.cumprod(np.full(len(word), _NEXT, np.uint64))
    back = np.cumprod(np.full(len(word), pow(int(_NEXT), -1, 1 << 64), np.uint64))
    starts = ends - lengths
    own = np.add.reduceat(joined[: len(word)] * power, starts) * back[starts]
    owners.append(np.arange(len(words)))
    found.append(mixed(own + _WORD_SALT))
    return np.concatenate(owners), (np.concatenate(found) % np.uint64(buckets - 1)).astype(np.int64) + 1


def bag(text: bytes, buckets: int) -> np.ndarray:
    """The mean of the one-hot features of all words of a text; zeros without words."""
    words = words_of(text)
    _, found = features(words, buckets)
    counts = np.bincount(found, minlength=buckets)
    counts[REPEATED] = REPEATED_COUNT * sum(map(eq, words, words[1:]))
    return (counts / max(1, counts.sum())).astype(np.float32)


@dataclass
class Model:
    vectors: np.ndarray  # buckets x dimensions
    output: np.ndarray  # dimensions x 2
    bias: np.ndarray  # 2

    def logits(self) -> tuple[np.ndarray, float]:
        """What each bucket adds to the log odds of label 1, and the bias: averages are linear."""
        return self.vectors @ (self.output[:, 1] - self.output[:, 0]), float(self.bias[1] - self.bias[0])


class SparseBags:
    """Bags with their non-zero shares only; rows that are asked for come as an array, so that all never do."""

    def __init__(self, places: pa.ChunkedArray, shares: pa.ChunkedArray, buckets: int):
        self.rows = [(p.values.to_numpy(), s.values.to_numpy()) for p, s in zip(places, shares)]
        self.shape = len(self.rows), buckets

    def __getitem__(self, numbers: np.ndarray) -> np.ndarray:
        asked = np.zeros((len(numbers), self.shape[1]), np.float32)
        for i, number in enumerate(numbers):
            places, shares = self.rows[number]
            asked[i, places] = shares
        return asked


def train(bags: np.ndarray | SparseBags, labels: np.ndarray, seed: int = 7) -> Model:
    """Stochastic gradient descent with per-parameter rates on the softmax loss of averaged vectors."""
    rng = np.random.default_rng(seed)
    n, buckets = bags.shape
    model = Model(
        rng.uniform(-1, 1, (buckets, DIMENSIONS)).astype(np.float32) / DIMENSIONS,
        rng.uniform(-1, 1, (DIMENSIONS, 2)).astype(np.float32) / DIMENSIONS,
        np.zeros(2, np.float32),
    )
    squares = [np.full_like(x, 1e-8) for x in (model.vectors, model.output, model.bias)]
    target = np.eye(2, dtype=np.float32)[labels]
    for epoch in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // n))):
        order = rng.permutation(n)
        for at in range(0, n, BATCH):
            rows = order[at : at + BATCH]
            x = bags[rows]
            hidden = x @ model.vectors
            z = hidden @ model.output + model.bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - target[rows]) / len(rows)
            steps = (x.T @ (error @ model.output.T), hidden.T @ error, error.sum(axis=0))
            for value, square, step in zip((model.vectors, model.output, model.bias), squares, steps):
                square += step * step
                value -= RATE * step / np.sqrt(square)
    return model


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", most_rows: int = TRAINING_ROWS, buckets: int = BUCKETS) -> Model | None:
    """A model from the labelled rows of ``docs`` that are not held out; None if there are none.

    At most ``most_rows`` labels are used, those whose id has the smallest hash, so that
    training has a bound at any size. Bags are made of whole texts in the tasks; the driver gets one bag, of at
    most ``buckets`` numbers, for each id. Of an id with several texts the smallest bag is taken.
    """
    chosen = (
        labels.select(F.col("doc_id").cast("long"), label).where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.min(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                places, shares = [], []
                for text in encoded(part):
                    dense = bag(text, buckets)
                    places.append(np.flatnonzero(dense))
                    shares.append(dense[places[-1]])
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        "label": part.column("label"),
                        "places": pa.array(places, pa.list_(pa.int32())),
                        "shares": pa.array(shares, pa.list_(pa.float32())),
                    }
                )

    asked = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "label")
    found = asked.mapInArrow(run, "doc_id long, label int, places array<int>, shares array<float>")
    rows = found.groupBy("doc_id", "label").agg(F.min(F.struct("places", "shares")).alias("bag")).select("doc_id", "label", "bag.*").toArrow()
    if not rows.num_rows:
        return None
    rows = rows.sort_by([("doc_id", "ascending")])
    model = train(SparseBags(rows.column("places"), rows.column("shares"), buckets), rows.column("label").to_numpy())
    del rows
    pa.default_memory_pool().release_unused()
    return model


class WordScores:
    """Sums over the features of each distinct word, so that a document takes two sums over its words."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights
        self.forget()

    def forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.sums = np.empty(0)
        self.counts = np.empty(0)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the sum of its features' weights and their number."""
        split = [words_of(t) for t in texts]
        used = set().union(*split)
        if len(self.place) + len(used) > WORDS_KEPT:
            self.forget()
        new = list(used.difference(self.place))
        owner, found = features(new, len(self.weights))
        self.place.update(zip(new, range(len(self.sums), len(self.sums) + len(new))))
        self.sums = np.append(self.sums, np.bincount(owner, self.weights[found], len(new)))
        self.counts = np.append(self.counts, np.bincount(owner, minlength=len(new)))
        order: list[int] = []
        for words in split:
            order += map(self.place.__getitem__, words)
        at = np.array(order, np.int64)
        ends = np.cumsum([len(w) for w in split])
        same = REPEATED_COUNT * np.array([sum(map(eq, words, words[1:])) for words in split], np.int64)
        sums = np.append(0, np.cumsum(self.sums[at]))
        counts = np.append(0, np.cumsum(self.counts[at]))
        starts = np.append(0, ends[:-1])
        return sums[ends] - sums[starts] + same * self.weights[REPEATED], counts[ends] - counts[starts] + same


def _scorer(model: Model | None) -> Callable[[], Callable[[list[bytes]], np.ndarray]]:
    """Makes, in a task, a function from texts to scores."""
    weights, bias = model.logits() if model else (np.zeros(2), 0.0)
    weights = weights.astype(np.float64)

    def start() -> Callable[[list[bytes]], np.ndarray]:
        words = WordScores(weights)

        def scores(texts: list[bytes]) -> np.ndarray:
            sums, counts = words.of(texts)
            z = sums / np.maximum(counts, 1) + bias
            return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

        return scores

    return start


def score_documents(docs: DataFrame, model: Model | None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of each row of ``docs(doc_id, text)``.

    ``score`` is the softmax probability of label 1 and reads the whole text, nothing else.
    Null and empty texts get what the bias says; without a model all scores are 0.5, and 0.5 counts as label 1.
    Very long texts are read whole, a slice of texts at a time. Repeated rows and null ids stay, other columns are not read, an empty table gives an empty result.
    """
    start = _scorer(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = start()
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_pydict({"doc_id": part.column("doc_id"), "score": pa.array(scores(encoded(part)))})

    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


def accepted(docs: DataFrame, model: Model | None, least: float = 0.5) -> DataFrame:
    """Those rows of ``docs`` with a score of ``least`` or more, with all their columns.

    Without a model, so without a usable label, that is all rows at a ``least`` of 0.5 or under. Null and empty texts
    go by the model's bias; repeated rows stay or go alike.
    """
    start = _scorer(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = start()
        for batch in batches:
            for part in slices(batch):
                yield part.filter(pa.array(scores(encoded(part)) >= least))

    return docs.mapInArrow(run, docs.schema)
