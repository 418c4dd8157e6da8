"""Language of texts by prediction by partial matching over bytes.

Each language has a tree of byte contexts of up to three bytes with the counts
of the bytes that followed. A byte's code length under a language is that of its
longest context in the tree that has seen it, plus the escapes of the longer
contexts (escape method C: of a context seen n times with d different
successors, d / (n + d) is the escape's share). The counts are frozen after
training; the language that codes a text in the fewest bits is predicted.

Cases: null texts and texts without a letter are ``und`` with score 0; so is
every text if no training row has a language; of equal code lengths the first
language in order of names wins; equal texts get equal results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import LOWER, chunks, fold, received, send, table, texts

# Training texts per language, about (rows are drawn by a hash of their text).
SAMPLE_PER_LANGUAGE = 3000
# Runs of four bytes that training saw less often are left out of the trees.
LEAST_COUNT = 2


def _windows(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """At each byte, the byte and the three before it in its row, as 32 bits.

    Before a row's first byte stand zero bytes.
    """
    low = LOWER[data].astype(np.uint32)
    out = low.copy()
    for back in (1, 2, 3):
        part = np.zeros(len(low), np.uint32)
        part[back:] = low[:-back] if back < len(low) else 0
        for k in range(back):  # the bytes whose context would reach into another row
            at = offsets[:-1] + k
            part[at[at < offsets[1:]]] = 0
        out |= part << np.uint32(8 * back)
    return out


def count_windows(docs: DataFrame, text: str, language: str) -> DataFrame:
    """Counts of runs of four bytes by language, summed in the tasks first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column(1).to_pylist(), dtype=object)
            data, offsets = texts(batch.column(0))
            if not len(data):
                continue
            grams = _windows(data, offsets)
            row_name = np.repeat(np.arange(len(names)), np.diff(offsets))
            unique, code = np.unique(names.astype(str), return_inverse=True)
            for k, name in enumerate(unique):
                found, n = np.unique(grams[code[row_name] == k], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(found)), pa.array(found.astype(np.int64)), pa.array(n)],
                    names=["lang", "gram", "n"],
                )

    counted = docs.select(text, F.col(language).alias("lang")).mapInArrow(
        count, "lang string, gram bigint, n bigint"
    )
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Frozen statistics of all languages and the code lengths they give."""

    ORDER = 3

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> None:
        self.languages = sorted(counts)
        width = len(self.languages)
        # order -1: all bytes alike
        self.keys: list[np.ndarray] = []
        self.bits: list[np.ndarray] = []
        self.contexts: list[np.ndarray] = []
        self.escapes: list[np.ndarray] = []
        for order in range(self.ORDER + 1):
            mask = np.uint64((1 << (8 * (order + 1))) - 1)
            by_language = []
            for name in self.languages:
                grams, n = counts[name]
                keys, place = np.unique(grams & mask, return_inverse=True)
                by_language.append((keys, np.bincount(place, weights=n)))
            keys = np.unique(np.concatenate([k for k, _ in by_language]))
            contexts = np.unique(keys >> np.uint64(8))
            below = self._bits_below(order, keys)
            bits = np.empty((len(keys), width), np.float32)
            escapes = np.zeros((len(contexts), width), np.float32)
            for k, (own, n) in enumerate(by_language):
                at = np.searchsorted(contexts, own >> np.uint64(8))
                total = np.bincount(at, weights=n, minlength=len(contexts))
                kinds = np.bincount(at, minlength=len(contexts))
                seen = total > 0
                escapes[seen, k] = -np.log2(kinds[seen] / (total[seen] + kinds[seen]))
                bits[:, k] = escapes[np.searchsorted(contexts, keys >> np.uint64(8)), k]
                bits[:, k] += below[:, k]
                where = np.searchsorted(keys, own)
                bits[where, k] = -np.log2(n / (total[at] + kinds[at]))
            self.keys.append(keys)
            self.bits.append(bits)
            self.contexts.append(contexts)
            self.escapes.append(escapes)
        self._index()

    def _index(self) -> None:
        """A table from a hash of a run of four bytes to its place among the keys."""
        top = self.keys[self.ORDER].astype(np.uint32)
        self.top = top
        self.shift = np.uint32(32 - max(8, int(np.ceil(np.log2(len(top) * 8 + 1)))))
        self.slots = np.zeros(1 << (32 - int(self.shift)), np.int32)
        self.slots[self._slot(top)] = np.arange(len(top), dtype=np.int32)

    def _slot(self, grams: np.ndarray) -> np.ndarray:
        return (grams * np.uint32(0x9E3779B1)) >> self.shift

    def _bits_below(self, order: int, keys: np.ndarray) -> np.ndarray:
        """Code lengths of the last bytes of keys in contexts one byte shorter."""
        width = len(self.languages)
        if order == 0:
            return np.full((len(keys), width), 8.0, np.float32)
        return self._bits(order - 1, keys & np.uint64((1 << (8 * order)) - 1))

    def _bits(self, order: int, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys[order], keys), len(self.keys[order]) - 1)
        out = self.bits[order][at]
        new = np.flatnonzero(self.keys[order][at] != keys)
        if len(new):
            ctx = keys[new] >> np.uint64(8)
            c = np.minimum(np.searchsorted(self.contexts[order], ctx), len(self.contexts[order]) - 1)
            known = (self.contexts[order][c] == ctx)[:, None]
            out[new] = np.where(known, self.escapes[order][c], 0) + self._bits_below(order, keys[new])
        return out

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row under each language."""
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        if not len(data):
            return out
        grams = _windows(data, offsets)
        at = self.slots[self._slot(grams)]
        bits = self.bits[self.ORDER][at]
        other = np.flatnonzero(self.top[at] != grams)
        if len(other):
            bits[other] = self._bits(self.ORDER, grams[other].astype(np.uint64))
        full = np.flatnonzero(np.diff(offsets) > 0)
        out[full] = np.add.reduceat(bits, offsets[full], axis=0, dtype=np.float64)
        return out


def train_language_model(
    docs: DataFrame,
    text: str = "text",
    language: str = "lang",
    per_language: int = SAMPLE_PER_LANGUAGE,
) -> ContextTrees | None:
    """Fit trees on about ``per_language`` whole texts of each language.

    The bound keeps what reaches the driver small: counts of runs of bytes of
    that many texts. None if there is no text with a language.
    """
    known = docs.where(F.col(language).isNotNull() & (F.length(text) > 0))
    sizes = {r[0]: r[1] for r in known.groupBy(language).count().collect()}
    if not sizes:
        return None
    share = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, per_language / n)])
    drawn = F.pmod(F.xxhash64(text), F.lit(1_000_003)) < share[F.col(language)] * 1_000_003
    counts = count_windows(known.where(drawn), text, language)
    rows = counts.where(F.col("n") >= LEAST_COUNT).toPandas()
    if not len(rows):
        rows = counts.toPandas()
    if not len(rows):
        return None
    return ContextTrees(
        {
            name: (part["gram"].to_numpy(np.uint64), part["n"].to_numpy(np.float64))
            for name, part in rows.groupby("lang")
        }
    )


def identify_language(docs: DataFrame, model: ContextTrees | None, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the language's share by its code length.

    Columns of these names are replaced.

    One narrow stage; the model, bounded by its training sample, is broadcast.
    """
    docs = docs.drop("lang_pred", "score")
    has_letter = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0)})
    sent = send(docs.sparkSession.sparkContext, model)
    columns = docs.columns
    marked = docs.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "__llm_letter": has_letter})
    position = columns.index(text)
    schema = marked.drop("__llm_letter").schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = received(sent)
        names = np.array([*trees.languages, "und"], dtype=object)
        for batch in batches:
            data, offsets = texts(batch.column(position))
            letter = batch.column(len(columns) + 2).to_numpy(zero_copy_only=False)
            best = np.full(len(batch), len(names) - 1)
            share = np.zeros(len(batch))
            for a, b in chunks(offsets):
                bits = trees.code_lengths(
                    data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                )
                best[a:b] = bits.argmin(axis=1)
                worse = bits - bits.min(axis=1, keepdims=True)
                share[a:b] = 1 / np.exp2(-np.minimum(worse, 1000)).sum(axis=1)
            best[~letter], share[~letter] = len(names) - 1, 0
            arrays = [batch.column(i) for i in range(len(columns))]
            arrays += [pa.array(names[best].tolist(), pa.string()), pa.array(share)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "lang_pred", "score"])

    return marked.mapInArrow(score, schema)


@query("op8_language_id")
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    training = docs.where(fold("doc_id", 5) != 0).select("text", "lang")
    model = train_language_model(training)
    marked = docs.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "text")
    return identify_language(marked, model).drop("text")
