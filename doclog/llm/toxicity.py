"""Toxicity by a factorization machine over hashed terms.

A text's terms are its words (A-Z lowered, split at ASCII characters other than
letters and digits) and the first four, five and six bytes of longer words, so
that unseen forms of a seen stem count too. Terms are hashed into a fixed number
of buckets; the machine has a weight and a short vector for each bucket that
tells the classes apart in training, and a pair of terms adds the product of
their vectors: an insult next to a mention of a group can weigh more than both.

Cases: null and empty texts have no terms and get the intercept's score; equal
texts get equal scores; rows with a null label are not learnt from, of several
labels of a document the largest counts; without both classes in training every
score is the share of toxic rows, 0 if there is none.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import ALNUM, Words, chunks, fold, received, send, table, texts

# Labelled documents that a model is fitted on, about (drawn by a hash of the id).
TRAINING_ROWS = 16_000
BUCKET_BITS = 20
STEMS = (4, 5, 6)
# Training documents that must hold a bucket for it to have a weight and a vector.
LEAST_ROWS = 4
FACTORS = 8
# Chi-square from which a term is fitted in the first step.
PLAIN = 4
# Lengths at which vectors start, and what terms of the second step pay in each step
# for a weight and for a vector.
START, LATE_START, WEIGHT_COST, VECTOR_COST = 0.02, 0.01, 1e-2, 1e-3
# Late terms of a document with more terms than this share the pull of so many, as
# all of them move at once.
PULLS = 64


def term_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every term, repeats included."""
    shift = np.uint64(64 - BUCKET_BITS)
    size = words.end - words.start
    rows, buckets = [words.row], [words.hashes() >> shift]
    for stem in STEMS:
        longer = size > stem
        rows.append(words.row[longer])
        buckets.append(words.hashes(longest=stem)[longer] >> shift)
    return np.concatenate(rows), np.concatenate(buckets).astype(np.int64)


class FactorizationMachine:
    """Logistic second-order machine on sets of features."""

    def __init__(self, slots: np.ndarray, bias: float, w: np.ndarray, v: np.ndarray) -> None:
        self.slots, self.bias, self.w, self.v = slots, bias, w, v

    @classmethod
    def fit(
        cls,
        rows: list[np.ndarray],
        labels: np.ndarray,
        epochs: int = 15,
        late_epochs: int = 8,
        rate: float = 0.1,
        seed: int = 7,
    ) -> FactorizationMachine:
        """``rows`` are the distinct buckets of each document."""
        size = 1 << BUCKET_BITS
        n, positive = len(labels), int(labels.sum())
        slots = np.full(size, -1, np.int32)
        if not 0 < positive < n:
            share = positive / n if n else 0.0
            bias = float(np.log((share + 1e-9) / (1 - share + 1e-9)))
            return cls(slots, bias, np.zeros(1, np.float32), np.zeros((1, FACTORS), np.float32))
        counts = np.array([len(r) for r in rows])
        flat, row_of = np.concatenate(rows), np.repeat(np.arange(n), counts)
        seen = np.bincount(flat, minlength=size).astype(float)
        toxic = np.bincount(flat, weights=labels[row_of], minlength=size)
        spread = seen * (1 - seen / n) * (positive / n) * (1 - positive / n) + 1e-9
        score = (toxic - seen * positive / n) ** 2 / spread
        buckets = np.flatnonzero(seen >= LEAST_ROWS)
        buckets = buckets[np.argsort(-score[buckets], kind="stable")]
        first, m = int((score[buckets] > PLAIN).sum()), len(buckets)
        slots[buckets] = np.arange(m, dtype=np.int32)
        slot = slots[flat]
        late = np.arange(m) >= first
        draw = np.random.default_rng(seed)
        # a weight and a vector in each row
        own = draw.normal(0, np.where(late, LATE_START, START)[:, None], (m, FACTORS + 1))
        own[:, 0] = 0
        length = np.linalg.norm(own[:, 1:], axis=1)
        past = np.full(own.shape, 1e-2)
        bias, past_bias = float(np.log(positive / (n - positive))), 1e-2
        for end, passes in ((first, epochs), (m, late_epochs)):
            held = (slot >= 0) & (slot < end)
            given, start = slot[held], np.searchsorted(row_of[held], np.arange(n + 1))
            for _ in range(passes):
                order = draw.permutation(n)
                for at in range(0, n, 256):
                    chosen = order[at : at + 256]
                    sizes = start[chosen + 1] - start[chosen]
                    row = np.repeat(np.arange(len(chosen)), sizes)
                    inner = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                    met, f = np.unique(given[np.repeat(start[chosen], sizes) + inner], return_inverse=True)
                    x = own[met]
                    z, sums = cls._sums(bias, x[:, 0], x[:, 1:], row, f, len(chosen))
                    g = 1 / (1 + np.exp(-z)) - labels[chosen]
                    past_bias += float(g.mean()) ** 2
                    bias -= rate * float(g.mean()) / np.sqrt(past_bias)
                    calm = np.minimum(PULLS / np.maximum(sizes, 1), 1)
                    pull = np.where(late[met][f], (g * calm)[row], g[row])
                    pulls = [pull, *(pull * (sums[row, k] - x[f, k + 1]) for k in range(FACTORS))]
                    step = np.stack([np.bincount(f, p, len(met)) for p in pulls], 1) / len(chosen)
                    past[met] += step**2
                    pace = rate / np.sqrt(past[met])
                    own[met] = cls._shrunk(x - pace * step, pace, late[met])
        # vectors of late terms that training has not lengthened stand for nothing
        own[late & (np.linalg.norm(own[:, 1:], axis=1) <= length), 1:] = 0
        used = np.flatnonzero(own.any(axis=1))
        slots[buckets] = -1
        slots[buckets[used]] = np.arange(len(used), dtype=np.int32)
        if not len(used):
            own, used = np.zeros((1, FACTORS + 1)), np.zeros(1, int)
        kept = own[used].astype(np.float32)
        return cls(slots, bias, kept[:, 0], kept[:, 1:])

    @staticmethod
    def _shrunk(x: np.ndarray, pace: np.ndarray, late: np.ndarray) -> np.ndarray:
        """Draw weights and vectors of late terms to zero: each by its cost, at its pace."""
        w, v, some = x[late, 0], x[late, 1:], pace[late]
        x[late, 0] = np.sign(w) * np.maximum(np.abs(w) - some[:, 0] * WEIGHT_COST, 0)
        length = np.maximum(np.linalg.norm(v, axis=1), 1e-9)
        x[late, 1:] = v * np.maximum(1 - some[:, 1:].mean(1) * VECTOR_COST / length, 0)[:, None]
        return x

    @staticmethod
    def _sums(bias, w, v, row, f, n):
        sums = np.stack([np.bincount(row, weights=v[f, k], minlength=n) for k in range(v.shape[1])], 1)
        squares = np.bincount(row, weights=(v[f].astype(float) ** 2).sum(1), minlength=n)
        z = bias + np.bincount(row, weights=w[f], minlength=n) + ((sums**2).sum(1) - squares) / 2
        return np.clip(z, -30, 30), sums

    def scores(self, words: Words) -> np.ndarray:
        row, bucket = term_buckets(words)
        f = self.slots[bucket]
        row, f = row[f >= 0], f[f >= 0]
        pairs = np.unique(row * len(self.w) + f)
        row, f = pairs // len(self.w), pairs % len(self.w)
        z, _ = self._sums(self.bias, self.w, self.v, row, f, words.rows)
        return 1 / (1 + np.exp(-z))

    def dumped(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, slots=self.slots, bias=self.bias, w=self.w, v=self.v)
        return out.getvalue()

    @classmethod
    def loaded(cls, data: bytes) -> FactorizationMachine:
        x = np.load(io.BytesIO(data))
        return cls(x["slots"], float(x["bias"]), x["w"], x["v"])


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    label: str = "toxic",
    training_rows: int = TRAINING_ROWS,
) -> FactorizationMachine:
    """Fit a machine on about ``training_rows`` labelled documents, whole texts.

    The labels drawn, bounded by that parameter, are sent to the scan of the
    documents. One task gathers the drawn documents' buckets and fits.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(F.col(key).alias("_key")).agg(F.max(label).alias("_toxic"))
    n = known.count()
    drawn = F.pmod(F.xxhash64("_key"), F.lit(1_000_003)) < 1_000_003 * training_rows / max(n, 1)
    sample = (
        docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
        .join(F.broadcast(known.where(drawn)), "_key")
        .select("_text", F.col("_toxic").cast("double"), F.xxhash64("_key", "_text").alias("_order"))
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[np.ndarray] = []
        labels: list[np.ndarray] = []
        for batch in batches:
            data, offsets = texts(batch.column(0))
            labels.append(batch.column(1).to_numpy())
            for a, b in chunks(offsets):
                part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                words = Words(part, off, ALNUM, lower=True)
                row, bucket = term_buckets(words)
                pairs = np.unique((row << BUCKET_BITS) | bucket)
                ends = np.searchsorted(pairs >> BUCKET_BITS, np.arange(1, words.rows))
                own = (pairs & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
                rows.extend(np.split(own, ends))
        known = np.concatenate(labels) if labels else np.zeros(0)
        model = FactorizationMachine.fit(rows, known)
        yield pa.RecordBatch.from_arrays([pa.array([model.dumped()], pa.binary())], names=["model"])

    # the order of rows decides how the fit goes: make it one of the rows' own
    fitted = sample.repartition(1).sortWithinPartitions("_order").mapInArrow(fit, "model binary")
    found = fitted.first()
    if found is None:  # no labelled rows, so no task
        return FactorizationMachine.fit([], np.zeros(0))
    return FactorizationMachine.loaded(bytes(found.model))


def score_toxicity(
    docs: DataFrame, model: FactorizationMachine, text: str = "text", name: str = "score"
) -> DataFrame:
    """Add a score, in place of a column of its name if there is one.

    One narrow stage; the model has at most 2**BUCKET_BITS buckets, some 40 MB.
    """
    docs = docs.drop(name)
    schema = docs.withColumn(name, F.lit(0.0)).schema
    names, position = schema.names, docs.columns.index(text)
    sent = send(docs.sparkSession.sparkContext, model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = received(sent)
        for batch in batches:
            data, offsets = texts(batch.column(position))
            out = np.zeros(len(batch))
            for a, b in chunks(offsets):
                part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                out[a:b] = machine.scores(Words(part, off, ALNUM, lower=True))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=names)

    return docs.mapInArrow(score, schema)


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    model = train_toxicity(docs, labels.where(fold("doc_id", 5) != 0))
    marked = docs.select("doc_id", "text", (fold("doc_id", 5) == 0).alias("held_out"))
    scored = score_toxicity(marked, model)
    return scored.select(
        "doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
