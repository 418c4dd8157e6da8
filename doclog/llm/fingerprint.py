"""Document fingerprints by one-permutation MinHash.

A text's shingles (five consecutive words; all words of a shorter text) are
hashed once. The top bits of a hash name one of 512 bins and each bin keeps its
least hash; an empty bin borrows from a bin that a fixed random sequence of its
own finds first (optimal densification). The low four bits of each bin are
packed. Two fingerprints agree by chance in a sixteenth of their bins, which the
likeness takes off.

Cases: null, empty and wordless texts have the empty fingerprint, which is like
itself (1) and like no other (0); equal texts have equal fingerprints; ids that
repeat are ordered by text, null ids come last.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import ALNUM, Words, chunks, gram_hashes, mixed, table, texts

BINS, BIN_BITS, LOW_BITS, SHINGLE = 512, 9, 4, 5
ROWS_PER_RANGE = 20_000
_TRIES = 4096


def _borrow_from(attempt: int) -> np.ndarray:
    """The bin that each bin looks at in its given attempt."""
    seeds = np.arange(BINS, dtype=np.uint64) * np.uint64(_TRIES) + np.uint64(attempt)
    return (mixed(seeds + np.uint64(0x51ED)) >> np.uint64(64 - BIN_BITS)).astype(np.int64)


def fingerprints(column: pa.Array) -> np.ndarray:
    """Packed fingerprints, a row of bytes each; the last byte tells if there are words."""
    data, offsets = texts(column)
    out = np.zeros((len(column), BINS * LOW_BITS // 8 + 1), np.uint8)
    for a, b in chunks(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        words = Words(part, off, ALNUM, lower=True)
        if not len(words):
            continue
        grams, first = gram_hashes(words, words.hashes(), SHINGLE)
        place = words.row[first] * BINS + (grams >> np.uint64(64 - BIN_BITS)).astype(np.int64)
        # sort by bin and hash at once; the low bits of the hash stay whole
        value = grams & np.uint64((1 << 40) - 1)
        for lo in range(0, b - a, 4096):  # 24 bits hold 4,096 rows of bins and more
            own = (place >= lo * BINS) & (place < (lo + 4096) * BINS)
            n = min(4096, b - a - lo)
            key = np.sort(((place[own] - lo * BINS).astype(np.uint64) << np.uint64(40)) | value[own])
            bins = (key >> np.uint64(40)).astype(np.int64)
            least = np.ones(len(bins), bool)
            least[1:] = bins[1:] != bins[:-1]
            low = np.zeros(n * BINS, np.uint8)
            full = np.zeros(n * BINS, bool)
            low[bins[least]] = (key[least] & np.uint64((1 << LOW_BITS) - 1)).astype(np.uint8)
            full[bins[least]] = True
            low, full = low.reshape(n, BINS), full.reshape(n, BINS)
            _densify(low, full)
            packed = (low[:, 0::2] << 4) | low[:, 1::2]
            out[a + lo : a + lo + n, :-1] = packed
            out[a + lo : a + lo + n, -1] = full.any(axis=1)
    return out


def _densify(low: np.ndarray, full: np.ndarray) -> None:
    count = full.sum(axis=1)
    single = np.flatnonzero(count == 1)  # one value for all bins, whatever the sequence
    low[single] = low[single, full[single].argmax(axis=1)][:, None]
    row, bin_ = np.nonzero(~full & (count > 1)[:, None])
    source = full.copy()
    for attempt in range(_TRIES):
        if not len(row):
            return
        look = _borrow_from(attempt)[bin_]
        found = source[row, look]
        low[row[found], bin_[found]] = low[row[found], look[found]]
        row, bin_ = row[~found], bin_[~found]
    for r, b in zip(row.tolist(), bin_.tolist(), strict=True):  # hardly ever: the next full bin
        low[r, b] = low[r, (b + int(np.roll(source[r], -b).argmax())) % BINS]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Estimated share of common shingles of fingerprints, row by row, from 0 to 1."""
    x = a[:, :-1] ^ b[:, :-1]
    same = ((x & 15 == 0).sum(axis=1) + (x >> 4 == 0).sum(axis=1)) / BINS
    chance = 1 / (1 << LOW_BITS)
    out = np.clip((same - chance) / (1 - chance), 0, 1)
    wordy_a, wordy_b = a[:, -1] > 0, b[:, -1] > 0
    return np.where(wordy_a & wordy_b, out, (wordy_a == wordy_b).astype(float))


def as_text(prints: np.ndarray) -> list[str]:
    return [p[:-1].tobytes().hex() if p[-1] else "" for p in prints]


def fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """Add, or replace, the fingerprint of a text, in hexadecimal. One narrow stage."""
    docs = docs.drop(name)
    schema = docs.withColumn(name, F.lit("")).schema
    names, position = schema.names, docs.columns.index(text)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array(as_text(fingerprints(batch.column(position))), pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=names)

    return docs.mapInArrow(add, schema)


_LAST = -(1 << 63)


def _ranges(docs: DataFrame, rows_per_range: int) -> np.ndarray:
    """Upper bounds, in rising order, of ranges of ids with about as many rows each."""
    n = docs.count()
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), n // rows_per_range)
    shares = ", ".join(str(k / parts) for k in range(1, parts))
    if not n or parts < 2:
        return np.zeros(0, np.int64)
    found = docs.selectExpr(f"percentile_approx(_id, array({shares}), {max(10 * parts, 1000)}) AS x")
    return np.unique(np.array(found.first().x, np.int64))


def with_next(
    docs: DataFrame,
    work,
    schema: str,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Apply ``work(texts, next_texts)`` along descending ids, the first after the last.

    ``docs`` has ``doc_id`` and ``text``. Documents move once, to ranges of ids
    of a bounded number of rows. Each range's first document is sent to the one
    before as well, so every document meets the next in its own task.
    """
    rows = docs.select(F.coalesce("doc_id", F.lit(_LAST)).alias("_id"), "doc_id", "text")
    bounds = _ranges(rows.select("_id"), rows_per_range)
    top = len(bounds)

    def numbered(ids: np.ndarray) -> np.ndarray:
        return top - np.searchsorted(bounds, ids, side="left")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbered(batch.column(0).to_numpy())), batch.column(0)], names=["r", "h"]
            )

    # the greatest id of each range: as many rows as there are ranges
    heads = sorted(
        rows.select("_id").mapInArrow(number, "r bigint, h bigint").groupBy("r").agg(F.max("h"))
        .toPandas().itertuples(index=False, name=None)
    )
    before = {heads[k][1]: heads[k - 1][0] for k in range(len(heads))}

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["r", "guard", "_id", "doc_id", "text"]
        for batch in batches:
            ids = batch.column(0).to_numpy()
            r, no = pa.array(numbered(ids)), pa.array(np.zeros(len(ids), bool))
            yield pa.RecordBatch.from_arrays([r, no, *batch.columns], names=names)
            at = [i for i, x in enumerate(ids.tolist()) if x in before]
            if at:
                part = batch.take(pa.array(at))
                r = pa.array([before[x] for x in part.column(0).to_pylist()], pa.int64())
                yes = pa.array(np.ones(len(at), bool))
                yield pa.RecordBatch.from_arrays([r, yes, *part.columns], names=names)

    dealt = rows.mapInArrow(
        deal, "r bigint, guard boolean, _id bigint, doc_id bigint, text string"
    )
    parts = max(len(heads), 1)
    ordered = dealt.repartitionByRange(parts, "r").sortWithinPartitions(
        "r", "guard", F.desc("_id"), F.asc_nulls_first("text")
    )

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row so far, which waits for the next
        for batch in batches:
            batch = batch.select(["r", "guard", "doc_id", "text"])
            if held is not None:
                batch = pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
            held = batch.slice(len(batch) - 1)
            guard = batch.column(1).to_numpy(zero_copy_only=False)[:-1]
            if len(guard):
                yield work(batch.column(2)[:-1], batch.column(3), ~guard)
        # what is left is a guard

    return ordered.mapInArrow(follow, schema)


_RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def _compare(ids: pa.Array, column: pa.Array, real: np.ndarray) -> pa.RecordBatch:
    """Rows for all texts but the last; ``real`` marks those that are no guards."""
    whole = [x or "" for x in column.to_pylist()]
    prints = fingerprints(pa.array(whole, pa.string()))
    edited = []
    for text, following in zip(whole, whole[1:]):
        cut = len(text) // 3
        edited.append(text[: len(text) - cut] + following[:cut])
    changed = fingerprints(pa.array(edited, pa.string()))
    mask = np.flatnonzero(real)
    shas = [hashlib.sha256(edited[i].encode()).hexdigest() for i in mask]
    return pa.RecordBatch.from_arrays(
        [
            ids.take(pa.array(mask)),
            pa.array([len(whole[i]) for i in mask], pa.int64()),
            pa.array(shas, pa.string()),
            pa.array(as_text(prints[mask]), pa.string()),
            pa.array(as_text(changed[mask]), pa.string()),
            pa.array(likeness(prints[:-1], changed)[mask]),
            pa.array(likeness(prints[:-1], prints[1:])[mask]),
        ],
        names=[c.split()[0] for c in _RESULT.split(", ")],
    )


@query("op3_fingerprints")
def op3_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return with_next(docs, _compare, _RESULT)
