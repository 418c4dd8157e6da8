"""Alignment of two tokenizers' ids over the same bytes, with corpus-wide pair counts.

Each text is encoded twice. Where a token of either ends at the same byte, the two
are linked, and these places cut the text into groups of tokens.

* The ids of each document are written out once, two bytes an id.
* Every task aligns its documents and adds up its distinct id pairs. The distinct
  pairs of all tasks are dealt into buckets by their hash, and each bucket gets a
  minimal perfect hash: bit vectors in which a pair that is alone in its slot has
  its bit, levels of them for the rest, and ranks of bits as places.
* The tasks' sums go through their bucket's hash into dense vectors of counts,
  which are added up in a tree: a fixed number of vectors a node, as many levels
  as it takes. Each place keeps its pair, so a pair that is not in the table is
  told apart.
* A second pass aligns the documents again from their ids and looks the counts
  up. The most frequent pairs, a bounded number, are sent to the tasks under one
  perfect hash; occurrences of the others are joined with the table.

Cases: null texts, empty texts, and texts that either tokenizer does not give back
byte for byte have no tokens: zeros and an empty ``groups_sha256``. Equal texts and
equal ids are separate documents; an empty table gives no rows; of pairs that are
equally frequent for their second id each counts as best.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .packing import _PLAIN, _fast_encoding
from .registry import query
from .shared import chunks, mixed, received, scratch, send, table

# Pairs in one bucket of the table, about; a bucket's vector takes 8 bytes a pair.
BUCKET_PAIRS = 1 << 16
# Vectors, or tasks' sums, that a node of the tree adds up.
FAN_IN = 32
# Pairs sent to all tasks at most (some 16 bytes each).
MAX_SENT = 1 << 21
# Distinct pairs that a task holds before it gives out its sums.
HELD_PAIRS = 1 << 20
# Text that is encoded at once, and ids that are aligned at once.
CHUNK_BYTES = 1 << 18


def _saved(df: DataFrame) -> DataFrame:
    """Written to scratch space and read again, in small files."""
    path = scratch(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def byte_level_entries(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary file."""
    from tokenizers import Tokenizer

    # the vocabulary writes printable bytes as themselves, others from U+0100 on
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}
    tokenizer = Tokenizer.from_file(path)
    special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
    entries = [b""] * tokenizer.get_vocab_size()
    for entry, i in tokenizer.get_vocab().items():
        entries[i] = entry.encode() if entry in special else bytes(byte_of[c] for c in entry)
    return entries


def piece_entries(path: str) -> list[bytes]:
    """The bytes of each id of a piece vocabulary with byte fallback."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    entries = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        whole = model.is_byte(i)
        entries.append(bytes([int(piece[3:-1], 16)]) if whole else piece.replace("▁", " ").encode())
    return entries


class TwoTokenizers:
    """Encodes texts under both vocabularies and checks them byte for byte.

    ``ranks`` is the first vocabulary for a faster library, which takes texts of
    characters that both libraries split alike (None: not used).
    """

    def __init__(self, first: str, ranks: str | None, pattern: str, second: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self._path, self._slow = first, None
        self._fast = _fast_encoding(ranks, pattern) if ranks else None
        self._second = SentencePieceProcessor(model_file=second)

    def _first(self, text: str) -> np.ndarray:
        if self._fast and _PLAIN.fullmatch(text):
            return self._fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        if self._slow is None:
            from tokenizers import Tokenizer

            self._slow = Tokenizer.from_file(self._path)
            self._slow.encode_special_tokens = True
        return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str], a_bytes: list[bytes], b_bytes: list[bytes]) -> list[tuple[bytes, bytes]]:
        """The ids of each text under both, two bytes an id, or nothing."""
        out = []
        for text, b in zip(texts, self._second.encode(texts, num_threads=1), strict=True):
            raw = b" " + text.encode()
            if text and raw == b"".join(map(b_bytes.__getitem__, b)):
                a = self._first(" " + text)
                if raw == b"".join(map(a_bytes.__getitem__, a.tolist())):
                    out.append((a.astype("<u2").tobytes(), np.array(b, "<u2").tobytes()))
                    continue
            out.append((b"", b""))
        return out


def encoded(docs: DataFrame, files: tuple, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, a, b``: the ids of each text under both, as bytes."""
    kind = docs.schema[doc_id].dataType.simpleString()
    sent = send(docs.sparkSession.sparkContext, (byte_level_entries(files[0]), piece_entries(files[3])))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, entries = TwoTokenizers(*files), received(sent)
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy()
            for lo, hi in chunks(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), CHUNK_BYTES):
                part = batch.slice(lo, hi - lo)
                found = both.encode([t or "" for t in part.column(1).to_pylist()], *entries)
                blobs = [pa.array([ids[side] for ids in found], pa.binary()) for side in (0, 1)]
                yield pa.RecordBatch.from_arrays([part.column(0), *blobs], names=["doc_id", "a", "b"])

    return docs.select(doc_id, text).mapInArrow(encode, f"doc_id {kind}, a binary, b binary")


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of bounded size, by the bytes of their ids ``a``."""
    for batch in batches:
        sizes = pc.binary_length(batch.column("a")).to_numpy()
        for lo, hi in chunks(np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), CHUNK_BYTES):
            yield batch.slice(lo, hi - lo)


def _ids(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a column of blobs, and where each row's start."""
    blobs = column.to_pylist()
    sizes = np.array([len(x) // 2 for x in blobs], np.int64)
    return np.frombuffer(b"".join(blobs), "<u2").astype(np.int64), np.concatenate([[0], np.cumsum(sizes)])


class Aligned:
    """The links of some documents, from their ids and the lengths of ids in bytes.

    Rows follow one another and have as many bytes under both, so one running sum
    of lengths serves all of them.
    """

    def __init__(self, a: pa.Array, b: pa.Array, a_size: np.ndarray, b_size: np.ndarray) -> None:
        self.a, self.a_first = _ids(a)
        self.b, self.b_first = _ids(b)
        a_end, b_end = np.cumsum(a_size[self.a]), np.cumsum(b_size[self.b])
        at = np.searchsorted(b_end, a_end)
        inside = np.flatnonzero(at < len(b_end))
        self.a_at = inside[b_end[at[inside]] == a_end[inside]]
        self.b_at = at[self.a_at]
        self.pair = self.a[self.a_at] * len(b_size) + self.b[self.b_at]
        # all ends of rows are links, so a row's links follow one another too
        self.first = np.searchsorted(self.a_at, self.a_first)
        self.row = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def digests(self, names: list[str], n_a: int, n_b: int) -> list[str]:
        """The hash of each row's groups; ``names`` are of both ids with either mark behind."""
        na, nb = len(self.a), len(self.b)
        group_a = np.searchsorted(self.a_at, np.arange(na))
        group_b = np.searchsorted(self.b_at, np.arange(nb))
        a_past = np.concatenate([[0], self.a_at + 1])
        b_past = np.concatenate([[0], self.b_at + 1])
        text = np.empty(na + nb, np.int64)
        a_mark, b_mark = np.zeros(na, np.int64), np.zeros(nb, np.int64)
        a_mark[self.a_at] = n_a
        b_mark[self.b_at] = n_b
        text[np.arange(na) + b_past[group_a]] = self.a + a_mark
        text[np.arange(nb) + a_past[group_b + 1]] = 2 * n_a + self.b + b_mark
        edges = (self.a_first + self.b_first).tolist()
        out = []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            line = "".join(map(names.__getitem__, text[lo:hi].tolist()))
            out.append(hashlib.sha256(line[:-1].encode()).hexdigest() if line else "")
        return out


class PerfectHash:
    """Numbers distinct 64-bit keys from 0 without gaps, in some four bits a key.

    Each level has two slots a key; a key alone in its slot stays there, the others
    go on to the next level. A key's number is the rank of its bit. Another key gets
    some number or -1, so a caller keeps the keys by number to tell it.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.words: list[np.ndarray] = []
        self.ranks: list[np.ndarray] = []
        left, base = keys.astype(np.uint64), 0
        while len(left):
            slots = -(-2 * len(left) // 64) * 64
            slot = self._slot(left, len(self.words), slots)
            alone = np.bincount(slot, minlength=slots) == 1
            words = np.packbits(alone, bitorder="little").view("<u8")
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.ranks.append(base + np.cumsum(ones) - ones)
            base += int(ones.sum())
            left = left[~alone[slot]]
        self.size = base

    @staticmethod
    def _slot(keys: np.ndarray, level: int, slots: int) -> np.ndarray:
        seed = np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64)
        return (mixed(keys + seed) % np.uint64(slots)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        which = np.arange(len(keys))
        for level, (words, ranks) in enumerate(zip(self.words, self.ranks, strict=True)):
            slot = self._slot(keys[which], level, len(words) * 64)
            word, bit = words[slot >> 6], (slot & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word[hit] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[which[hit]] = ranks[slot[hit] >> 6] + below
            which = which[~hit]
            if not len(which):
                break
        return out


class PairTable:
    """Pairs under their perfect hash, with one count each."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray | None = None) -> None:
        self.hash = PerfectHash(pairs)
        place = self.hash.find(pairs)
        self.pairs = np.zeros(len(pairs), np.int64)
        self.pairs[place] = pairs
        self.counts = np.zeros(len(pairs), np.int64)
        if counts is not None:
            self.counts[place] = counts

    def find(self, pairs: np.ndarray) -> np.ndarray:
        """The place of each pair, -1 for those that are not in the table."""
        place = self.hash.find(pairs)
        if len(self.pairs):
            place[self.pairs[place] != pairs] = -1
        return place


def _task_sums(ids: DataFrame, a_size: np.ndarray, b_size: np.ndarray) -> DataFrame:
    """``task, pair, n`` of each task's documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        pairs, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(pairs), task, np.int64)), pa.array(pairs), pa.array(sums)],
                names=["task", "pair", "n"],
            )

        for batch in _parts(batches):
            new, n = np.unique(Aligned(batch.column(0), batch.column(1), a_size, b_size).pair, return_counts=True)
            both, place = np.unique(np.concatenate([pairs, new]), return_inverse=True)
            total = np.zeros(len(both), np.int64)
            np.add.at(total, place, np.concatenate([sums, n]))
            pairs, sums = both, total
            if len(pairs) > HELD_PAIRS:
                yield out()
                pairs, sums = pairs[:0], sums[:0]
        yield out()

    return ids.select("a", "b").mapInArrow(count, "task bigint, pair bigint, n bigint")


def pair_counts(ids: DataFrame, a_size: np.ndarray, b_size: np.ndarray) -> tuple[DataFrame, int]:
    """``pair, n`` over all documents, and the number of pairs."""
    sums = _saved(_task_sums(ids, a_size, b_size))
    pairs = _saved(sums.select("pair").distinct())
    size = pairs.count()
    tasks = (sums.agg(F.max("task")).first()[0] or 0) + 1
    bucket = F.pmod(F.xxhash64("pair"), F.lit(max(1, -(-size // BUCKET_PAIRS))).cast("bigint"))

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        blob = cloudpickle.dumps(PairTable(rows["pair"].to_numpy()))
        return pd.DataFrame({"bucket": [rows["bucket"].iloc[0]], "blob": [blob]})

    hashes = pairs.withColumn("bucket", bucket).groupBy("bucket").applyInPandas(build, "bucket bigint, blob binary")
    hashes = _saved(hashes)
    nodes = -(-tasks // FAN_IN)

    def dense(rows: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({"bucket": [], "node": [], "vector": []})
        held = pickle.loads(own["blob"].iloc[0])
        vector = np.zeros(len(held.pairs), np.int64)
        place = held.find(rows["pair"].to_numpy())
        if (place < 0).any():
            raise ValueError("a pair is missing in the table of pairs")
        np.add.at(vector, place, rows["n"].to_numpy())
        one = rows.iloc[0]
        return pd.DataFrame({"bucket": [one["bucket"]], "node": [one["node"]], "vector": [vector.tobytes()]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.frombuffer(rows["vector"].iloc[0], np.int64).copy()
        for other in rows["vector"].iloc[1:]:
            total += np.frombuffer(other, np.int64)
        one = rows.iloc[0]
        return pd.DataFrame({"bucket": [one["bucket"]], "node": [one["node"]], "vector": [total.tobytes()]})

    kind = "bucket bigint, node bigint, vector binary"
    node = F.floor(F.col("task") / FAN_IN).alias("node")
    dealt = sums.select(bucket.alias("bucket"), node, "pair", "n").groupBy("bucket", "node")
    spread = hashes.select("bucket", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(nodes - 1).cast("bigint"))).alias("node"), "blob")
    vectors = dealt.cogroup(spread.groupBy("bucket", "node")).applyInPandas(dense, kind)
    while nodes > 1:
        nodes = -(-nodes // FAN_IN)
        vectors = vectors.withColumn("node", F.floor(F.col("node") / FAN_IN))
        vectors = vectors.groupBy("bucket", "node").applyInPandas(add, kind)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = [pa.array(pickle.loads(blob).pairs), pa.array(np.frombuffer(vector, np.int64))]
                yield pa.RecordBatch.from_arrays(found, names=["pair", "n"])

    joined = hashes.join(vectors, "bucket").select("blob", "vector")
    return _saved(joined.mapInArrow(listed, "pair bigint, n bigint")), size


def _frequent(counts: DataFrame, size: int) -> tuple[PairTable, int]:
    """The most frequent pairs, MAX_SENT at most, and the least count that they have."""
    least = 0
    if size > MAX_SENT:
        # by powers of two of the count, which are 63 at most
        power = F.floor(F.log2("n")).alias("power")
        found = {r.power: r["count"] for r in counts.groupBy(power).count().collect()}
        top, total = 64, 0
        while top and total + found.get(top - 1, 0) <= MAX_SENT:
            top -= 1
            total += found.get(top, 0)
        least = 1 << top
    rows = counts.where(F.col("n") >= least).toArrow()
    return PairTable(rows["pair"].to_numpy(), rows["n"].to_numpy()), least


def align(docs: DataFrame, files: tuple, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """A row for each document: its tokens, groups and links, and sums over the links' counts.

    ``files`` are the arguments of :class:`TwoTokenizers`.
    """
    spark = docs.sparkSession
    a_size = np.array([len(x) for x in byte_level_entries(files[0])], np.int64)
    b_size = np.array([len(x) for x in piece_entries(files[3])], np.int64)
    n_a, n_b = len(a_size), len(b_size)
    ids = _saved(encoded(docs, files, doc_id, text))
    counts, size = pair_counts(ids, a_size, b_size)
    best = np.zeros(n_b, np.int64)
    second = F.pmod(F.col("pair"), F.lit(n_b)).alias("b")
    for row in counts.groupBy(second).agg(F.max("n").alias("n")).collect():  # a row for each id at most
        best[row.b] = row.n
    known, least = _frequent(counts, size)
    sent = send(spark.sparkContext, (known, best, a_size, b_size))
    kind = ids.schema["doc_id"].dataType.simpleString()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = f"doc_id {kind}, " + ", ".join(f"{n} bigint" for n in names) + ", groups_sha256 string"
    rest_type = np.dtype([("pair", "<i8"), ("k", "<i8")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, highest, a_len, b_len = received(sent)
        marks = [[f"{i}{mark}" for i in range(n)] for n, end in ((n_a, "|"), (n_b, ";")) for mark in (",", end)]
        text_of = [x for part in marks for x in part]
        for batch in _parts(batches):
            at = Aligned(batch.column(1), batch.column(2), a_len, b_len)
            n = len(batch)
            place = pairs.find(at.pair)
            here = place >= 0
            count = pairs.counts[place[here]]
            top = count == highest[at.pair[here] % n_b]
            total = np.zeros(n, np.int64)
            np.add.at(total, at.row[here], count)
            links = np.diff(at.first)
            sums = [
                np.diff(at.a_first), np.diff(at.b_first), links, links,
                np.bincount(at.row[here][top], minlength=n), total,
            ]
            rows, others = at.row[~here], at.pair[~here]
            order = np.lexsort((others, rows))
            rows, others = rows[order], others[order]
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (others[1:] != others[:-1])
            first = np.flatnonzero(new)
            rest = np.empty(len(first), rest_type)
            rest["pair"], rest["k"] = others[first], np.diff(np.append(first, len(rows)))
            bounds = np.searchsorted(rows[first], np.arange(1, n))
            blobs = [x.tobytes() for x in np.split(rest, bounds)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), *[pa.array(x.astype(np.int64)) for x in sums],
                    pa.array(at.digests(text_of, n_a, n_b), pa.string()), pa.array(blobs, pa.binary()),
                ],
                names=["doc_id", *names, "groups_sha256", "rest"],
            )

    found = ids.mapInArrow(measure, f"{schema}, rest binary")
    if not least:
        return found.drop("rest")

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            rest = np.frombuffer(b"".join(blobs), rest_type)
            of = np.repeat(batch.column(0).to_numpy(), [len(x) // rest_type.itemsize for x in blobs])
            columns = [pa.array(of), pa.array(rest["pair"].copy()), pa.array(rest["k"].copy())]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "pair", "k"])

    # pairs that were not sent are rare ones, so none of them is a hot key
    found = _saved(found.withColumn("row", F.monotonically_increasing_id()))
    rest = found.select("row", "rest").mapInArrow(unpack, "row bigint, pair bigint, k bigint")
    highest = F.pmod(F.col("pair"), F.lit(n_b)).cast("int")
    tops = spark.createDataFrame(pd.DataFrame({"b": np.arange(n_b), "top": best}), "b int, top bigint")
    rare = counts.where(F.col("n") < least).withColumn("b", highest).join(F.broadcast(tops), "b")
    rest = rest.join(rare, "pair").groupBy("row").agg(
        F.sum(F.when(F.col("n") == F.col("top"), F.col("k")).otherwise(0)).alias("more_best"),
        F.sum(F.col("k") * F.col("n")).alias("more_sum"),
    )
    more = {"n_best": "more_best", "count_sum": "more_sum"}
    return found.join(rest, "row", "left").select(
        "doc_id",
        *[F.expr(f"{n} + coalesce({more[n]}, 0L)").alias(n) if n in more else n for n in names],
        "groups_sha256",
    )


def public_files() -> tuple:
    """Arguments of TwoTokenizers for the public vocabularies."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("piece_bpe_32k.model"),
    )


@query("op11_alignment")
def op11_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align(table(spark, folder, "documents"), public_files())
