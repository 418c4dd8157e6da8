"""Exact removal of repeated word windows, by super-k-mers.

A window is ``window`` consecutive words of a document. Its minimiser is the
least hash among its runs of ``gram`` words, so equal windows have equal
minimisers. Consecutive windows with one minimiser are a super-k-mer.

1. Minimisers are counted over all documents; one that occurs in a single
   super-k-mer, and there at one place, cannot stand for a repeated window.
2. The other super-k-mers travel, each as one packed string (its words joined by
   single spaces), to the bucket of their minimiser. Of equal strings in a batch
   the first travels; the windows of the others are repeats.
3. Super-k-mers are counted per minimiser. Those of a frequent one are cut into
   windows, which travel by a hash of their own words instead, the earliest of each
   batch alone; so no bucket grows with the share of documents that have a phrase.
4. In its bucket each window's words are compared as text, and all windows but
   the earliest of each word sequence are repeats.
5. Words covered by repeats are removed from their documents.

"Earliest" is by document id, then start; null ids come last. Cases: null,
empty and short texts have no windows and stay; rows with equal ids are one
document for that order but are handled row by row (windows with the same id
and start in two rows are both kept); a window may repeat within its document.
Other columns are carried along.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import NOT_BLANK, Words, chunks, run_hashes, saved, table, texts

# A per-row side table is sent to the scan up to this size, else joined.
SENT_BYTES = 64 << 20
# A minimiser of more super-k-mers is frequent; lists of so many are sent to all tasks.
FREQUENT, SENT_MINIMISERS = 1000, 1 << 20
_NULL_LAST = (1 << 63) - 1
_PAIR = np.dtype([("key", "<i8"), ("h", "<u8")])
_RANGE = np.dtype([("key", "<i8"), ("start", "<u4"), ("n", "<u4")])


class Runs:
    """The super-k-mers of some rows: row, first window, number of windows, minimiser.

    ``within`` marks those in which the minimiser stands at several places, so
    that one of their windows may repeat another.
    """

    def __init__(self, words: Words, window: int, gram: int) -> None:
        hashes = words.hashes()
        enough = words.count >= window
        if not enough.any():
            self.row = self.first = self.n = np.zeros(0, np.int64)
            self.minimiser, self.within = np.zeros(0, np.uint64), np.zeros(0, bool)
            return
        grams = least = run_hashes(hashes, gram)
        width, have = window - gram + 1, 1
        while have < width:  # least over ever wider ranges of starts
            step = min(have, width - have)
            least = np.minimum(least[: len(least) - step], least[step:])
            have += step
        start = np.arange(len(least))
        valid = words.row[: len(least)] == words.row[window - 1 : window - 1 + len(least)]
        start = start[valid]
        value = least[valid]
        row = words.row[start]
        new = np.ones(len(start), bool)
        new[1:] = (value[1:] != value[:-1]) | (row[1:] != row[:-1])
        at = np.flatnonzero(new)
        self.row, self.minimiser = row[at], value[at]
        self.first = start[at]
        self.n = np.diff(np.append(at, len(start)))
        span = self.n + width - 1  # of starts of runs of words in a super-k-mer
        begin = np.cumsum(span) - span
        places = np.repeat(self.first - begin, span) + np.arange(int(span.sum()))
        same = grams[places] == np.repeat(self.minimiser, span)
        count = np.add.reduceat(same, begin, dtype=np.int64) if len(begin) else span
        self.within = (self.n > 1) & (count > 1)


def _pieces(column: pa.Array) -> Iterator[tuple[int, Words]]:
    data, offsets = texts(column)
    for a, b in chunks(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        yield a, Words(part, off, NOT_BLANK, lower=False)


def _spaced(words: Words) -> tuple[bytes, np.ndarray]:
    """All words, each followed by one space, and where each starts (and the end)."""
    size = words.end - words.start
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size + 1, out=at[1:])
    keep = np.zeros(len(words.data) + 1, bool)
    keep[words.end] = True
    inside = NOT_BLANK[words.padded[: len(keep)]]
    # neighbouring rows can end and start without a blank between them
    touching = inside[words.end] & (words.end < len(words.data))
    if touching.any():
        out = np.full(int(at[-1]), 0x20, np.uint8)
        source = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        out[np.repeat(at[:-1], size) + source] = words.data[np.repeat(words.start, size) + source]
        return out.tobytes(), at
    keep[: len(words.data)] |= inside[: len(words.data)]
    out = words.padded[: len(keep)][keep].copy()
    out[at[1:] - 1] = 0x20
    return out.tobytes(), at


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _packed(rows: np.ndarray, by: str, buckets: int) -> pa.RecordBatch:
    """Rows dealt by a field's top bits, packed to one binary value per bucket."""
    part = rows[by].view(np.uint64) // np.uint64((1 << 64) // buckets + 1)
    order = np.argsort(part, kind="stable")
    own, start = np.unique(part[order], return_index=True)
    blobs = [x.tobytes() for x in np.split(rows[order], start[1:])] if len(own) else []
    return pa.RecordBatch.from_arrays(
        [pa.array(own.astype(np.int32)), pa.array(blobs, pa.binary())], names=["bucket", "data"]
    )


def _by_bucket(
    batches: Iterator[pa.RecordBatch], kind: np.dtype
) -> Iterator[np.ndarray]:
    """All rows of each bucket; the input is sorted by bucket."""
    at, held = None, []
    for batch in batches:
        for bucket, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if bucket != at and held:
                yield np.concatenate(held)
                held = []
            at = bucket
            held.append(np.frombuffer(data, kind))
    if held:
        yield np.concatenate(held)


def _dealt(packed: DataFrame) -> DataFrame:
    return packed.repartition(_parts(packed), "bucket").sortWithinPartitions("bucket")


def _grouped(rows: np.ndarray, field: str | None) -> pa.RecordBatch:
    """One row per key with its rows (or a field of them) packed."""
    rows = rows[np.argsort(rows["key"], kind="stable")]
    keys, start = np.unique(rows["key"], return_index=True)
    values = np.ascontiguousarray(rows[field]) if field else rows
    blobs = [x.tobytes() for x in np.split(values, start[1:])]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys), pa.array(blobs, pa.binary())], names=["__llm_key", "__llm_data"]
    )


def _joined(docs: DataFrame, side: DataFrame, how: str) -> DataFrame:
    """Join a packed side table, of measured size, by row key."""
    size = side.agg(F.sum(F.octet_length("__llm_data") + 40)).first()[0] or 0
    return docs.join(F.broadcast(side) if size <= SENT_BYTES else side, "__llm_key", how)


def _shared_minimisers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """``_key, _data``: low halves of the minimisers that a row shares, or has twice."""
    buckets = 8 * _parts(docs)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, held = batch.column(0).to_numpy(), []
            for a, words in _pieces(batch.column(1)):
                runs = Runs(words, window, gram)
                part = np.empty(len(runs.row), _PAIR)
                part["key"], part["h"] = keys[a + runs.row], runs.minimiser
                held += [part, part[runs.within]]
            if held:
                yield _packed(_marked(np.concatenate(held)), "h", buckets)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches, _PAIR):
            rows = rows[np.argsort(rows["h"], kind="stable")]
            same = rows["h"][1:] == rows["h"][:-1]
            twice = np.zeros(len(rows), bool)
            twice[1:] |= same
            twice[:-1] |= same
            found = rows[twice]
            if len(found):
                yield _packed(found, "key", buckets)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches, _PAIR):
            low = np.empty(len(rows), np.dtype([("key", "<i8"), ("h", "<u4")]))
            low["key"], low["h"] = rows["key"], (rows["h"] & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            yield _grouped(np.unique(low), "h")

    packed = docs.select("__llm_key", "text").mapInArrow(post, "bucket int, data binary")
    found = _dealt(packed).mapInArrow(meet, "bucket int, data binary")
    return _dealt(found).mapInArrow(gather, "__llm_key bigint, __llm_data binary")


def _marked(rows: np.ndarray) -> np.ndarray:
    """Pairs of a batch; of one that occurs several times, two are enough."""
    rows = rows[np.lexsort((rows["key"], rows["h"]))]
    if len(rows) < 3:
        return rows
    third = np.zeros(len(rows), bool)
    third[2:] = (rows[2:] == rows[:-2])
    return rows[~third]


def _super_kmers(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Packed strings of super-k-mers whose minimiser is shared.

    ``h, doc, start, key, s``; ``s`` is null where an equal string of an earlier
    place is in the batch, and all windows (``n``) are repeats.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, docs_ = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            shared = batch.column(3).to_pylist()
            rows: list[tuple] = []
            for a, words in _pieces(batch.column(2)):
                runs = Runs(words, window, gram)
                text, at = _spaced(words)
                low = (runs.minimiser & np.uint64(0xFFFFFFFF)).astype(np.uint32)
                bounds = np.searchsorted(runs.row, np.arange(words.rows + 1))
                keep = np.zeros(len(low), bool)
                for r in range(words.rows):
                    x, y = bounds[r], bounds[r + 1]
                    if y > x and shared[a + r]:
                        keep[x:y] = np.isin(low[x:y], np.frombuffer(shared[a + r], np.uint32))
                chosen = np.flatnonzero(keep)
                first, n, row = runs.first[chosen], runs.n[chosen], runs.row[chosen]
                begin, end = at[first], at[first + n + window - 1] - 1
                start = first - words.first[row]
                for k in range(len(chosen)):
                    r = a + row[k]
                    s = text[begin[k] : end[k]]
                    rows.append((docs_[r], start[k], s, runs.minimiser[chosen[k]], keys[r], n[k]))
            rows.sort(key=lambda x: (x[0], x[1]))
            seen: dict[bytes, tuple] = {}
            for i, x in enumerate(rows):
                before = seen.setdefault(x[2], x)
                if before[0] != x[0] or before[1] != x[1]:
                    # needs no comparing: dealt by its row
                    rows[i] = (x[0], x[1], None, np.int64(x[4]).view(np.uint64), *x[4:])
            if rows:
                doc, start, s, h, key, n = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array(h, np.uint64).view(np.int64)),
                        pa.array(np.array(doc, np.int64)),
                        pa.array(np.array(start, np.int64)),
                        pa.array(np.array(key, np.int64)),
                        pa.array(np.array(n, np.int64)),
                        pa.array(s, pa.binary()),
                    ],
                    names=["h", "doc", "start", "key", "n", "s"],
                )

    columns = docs.select("__llm_key", F.coalesce("_doc", F.lit(_NULL_LAST)).alias("_doc"), "text", "__llm_data")
    return columns.mapInArrow(
        pack, "h bigint, doc bigint, start bigint, key bigint, n bigint, s binary"
    )


def _dealt_again(super_kmers: DataFrame, window: int) -> DataFrame:
    """The same, with the super-k-mers of frequent minimisers cut into windows.

    ``h`` of a window is a hash of its words, so each has a bucket of its own.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            rows.sort(key=lambda x: (x[1], x[2]))
            seen: dict[bytes, tuple] = {}
            out: list[tuple] = []
            for _, doc, start, key, n, s in rows:
                begins, ends = _word_bounds(s)
                for i in range(n):
                    w = s[begins[i] : ends[i + window - 1]]
                    place = seen.setdefault(w, (doc, start + i))
                    if place == (doc, start + i):
                        h = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little", signed=True)
                        out.append((h, doc, start + i, key, 1, w))
                    elif out and out[-1][5] is None and out[-1][3] == key and out[-1][2] + out[-1][4] == start + i:
                        out[-1] = (*out[-1][:4], out[-1][4] + 1, None)
                    else:
                        out.append((key, doc, start + i, key, 1, None))
            if out:
                columns = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, batch.schema, strict=True)],
                    names=batch.schema.names,
                )

    often = super_kmers.where("s IS NOT NULL").groupBy("h").count().where(F.col("count") > FREQUENT)
    often = saved(often.select("h"))
    n = often.count()
    if not n:
        return super_kmers
    often = F.broadcast(often) if n <= SENT_MINIMISERS else often
    compared = super_kmers.where("s IS NOT NULL")
    windows = compared.join(often, "h", "left_semi").mapInArrow(cut, super_kmers.schema)
    rest = compared.join(often, "h", "left_anti").unionByName(super_kmers.where("s IS NULL"))
    return rest.unionByName(windows)


def _word_bounds(s: bytes) -> tuple[list[int], list[int]]:
    ends = [i for i, c in enumerate(s) if c == 32]
    return [0, *(e + 1 for e in ends)], [*ends, len(s)]


def _repeated(super_kmers: DataFrame, window: int) -> DataFrame:
    """``_key, _data``: packed ranges of windows that repeat an earlier one."""
    buckets = 8 * _parts(super_kmers)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, group, out = None, [], []

        def flush() -> pa.RecordBatch:
            rows = np.array(out, _RANGE)
            out.clear()
            return _packed(rows, "key", buckets)

        for batch in batches:
            for h, doc, start, key, n, s in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if s is None:
                    out.append((key, start, n))
                    continue
                if h != at:
                    _windows(group, window, out)
                    at, group = h, []
                group.append((doc, start, key, n, s))
            if len(out) > 500_000:
                yield flush()
        _windows(group, window, out)
        if out:
            yield flush()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_bucket(batches, _RANGE):
            yield _grouped(rows, None)

    dealt = super_kmers.repartition(_parts(super_kmers), "h").sortWithinPartitions("h", "doc", "start")
    found = dealt.mapInArrow(compare, "bucket int, data binary")
    return _dealt(found).mapInArrow(gather, "__llm_key bigint, __llm_data binary")


def _windows(group: list[tuple], window: int, out: list[tuple]) -> None:
    """Add the repeats among the windows of one minimiser, given in order of place."""
    whole: dict[bytes, tuple] = {}
    seen: dict[bytes, tuple] = {}
    for doc, start, key, n, s in group:
        place = whole.setdefault(s, (doc, start))
        if place != (doc, start):
            out.append((key, start, n))
            continue
        begins, ends = _word_bounds(s)
        since = -1
        for i in range(n):
            w = s[begins[i] : ends[i + window - 1]]
            place = seen.setdefault(w, (doc, start + i))
            if place != (doc, start + i):
                if since < 0:
                    since = i
            elif since >= 0:
                out.append((key, start + since, i - since))
                since = -1
        if since >= 0:
            out.append((key, start + since, n - since))


def remove_repeats(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20, gram: int = 6
) -> DataFrame:
    """Add ``n_words``, ``n_removed`` and ``kept_text`` (kept words, single spaces).

    Columns of these names are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text")
    row_key = F.xxhash64(F.col(doc_id), F.col(text)).alias("__llm_key")
    given = docs.columns
    keyed = docs.select(row_key, F.col(doc_id).cast("bigint").alias("_doc"), F.col(text).alias("text"))
    shared = saved(_shared_minimisers(keyed, window, gram))
    marked = _joined(keyed, shared, "inner")
    super_kmers = saved(_super_kmers(marked, window, gram))
    repeats = saved(_repeated(_dealt_again(super_kmers, window), window))
    out = _joined(docs.withColumn("__llm_key", row_key), repeats, "left").select(*given, "__llm_data")
    position = given.index(text)
    schema = docs.selectExpr("*", "0L AS n_words", "0L AS n_removed", "'' AS kept_text").schema

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ranges = batch.column(len(given)).to_pylist()
            n_words, n_removed = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            kept: list[bytes] = []
            for a, words in _pieces(batch.column(position)):
                spaced, at = _spaced(words)
                n_words[a : a + words.rows] = words.count
                for r in range(words.rows):
                    x, y = words.first[r], words.first[r + 1]
                    own = spaced[at[x] : max(at[x], at[y] - 1)]
                    if ranges[a + r]:
                        change = np.zeros(int(y - x) + 1, np.int64)
                        found = np.frombuffer(ranges[a + r], _RANGE)
                        start, n = found["start"].astype(np.int64), found["n"].astype(np.int64)
                        np.add.at(change, start, 1)
                        np.add.at(change, start + n + window - 1, -1)
                        stay = np.cumsum(change)[:-1] == 0
                        n_removed[a + r] = len(stay) - stay.sum()
                        raw = np.frombuffer(spaced[at[x] : at[y]], np.uint8)
                        own = raw[np.repeat(stay, np.diff(at[x : y + 1]))].tobytes()[:-1]
                    kept.append(own)
            arrays = [batch.column(i) for i in range(len(given))]
            arrays += [pa.array(n_words), pa.array(n_removed)]
            arrays.append(pa.array(kept, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return out.mapInArrow(remove, schema)


@query("op6_substring_dedup")
def op6_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )
