"""Helpers of the operators in this folder: bytes to words, hashes, scratch tables.

Texts are handled as the UTF-8 bytes of an Arrow column. All separators used
here are ASCII, so words are found byte by byte without decoding. Word hashes
have 64 bits; two given words share one with probability 2**-64.
"""

from __future__ import annotations

import ctypes
import functools
import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, SparkContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows are worked on in pieces of about this many bytes, so that arrays stay small.
CHUNK_BYTES = 1 << 20

_M1 = np.uint64(0x9E3779B97F4A7C15)
_M2 = np.uint64(0xBF58476D1CE4E5B9)
_M3 = np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], dtype=np.uint64)

# blanks split words: 0x20 and 0x09 to 0x0D
NOT_BLANK = np.ones(256, dtype=bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
# digits, small letters and all bytes of non-ASCII characters make words
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def scratch(spark: SparkSession) -> str:
    """A new folder name in the space named by ``spark.checkpoint.dir``.

    A session without that setting gets a folder of its own, which only a local
    one, whose executors share the driver's disk, may use.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("Set spark.checkpoint.dir to a folder shared by the cluster")
        shared = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Write a frame to scratch space and read it back: its lineage ends there."""
    spark, path = df.sparkSession, scratch(df.sparkSession)
    # nobody waits for the file that marks success: readers start after the write
    df.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame) -> DataFrame:
    """The rows in an eighth of the shuffle partitions, two for each core at least.

    For side tables of ids and counts: each partition becomes a file, and on a
    local disk Hadoop starts three processes for a file. While a process starts
    it shares its JVM's memory, which is counted twice by who sums the memory of
    all processes of an executor.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(parts // 8, 2 * spark.sparkContext.defaultParallelism))


def send(context: SparkContext, value: object) -> Broadcast:
    """Broadcast a value together with the code of its class. The caller bounds its size."""
    return context.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> object:
    return pickle.loads(sent.value)


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(work: Work) -> Work:
    """The same work, after which the worker gives back the memory that it holds free.

    Workers live on from task to task; without that, each keeps the most that
    any of its tasks has needed.
    """

    @functools.wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from work(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
        if trim is not None:
            trim(0)

    return run


def fold(id_column: str, folds: int):
    """The remainder of crc32 of an id's text."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % folds


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a text column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]], off - off[0]


def chunks(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text is a range of its own."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values so that each of their bits depends on all."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


class Words:
    """The words of some rows: byte ranges, row numbers, and hashes.

    ``data`` are the (lower-cased) bytes, ``first`` has for each row the number
    of its first word, with one more entry at the end.
    """

    def __init__(
        self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, lower: bool
    ) -> None:
        n = len(data)
        padded = np.zeros(n + 8, dtype=np.uint8)
        padded[:n] = LOWER[data] if lower else data
        self.data, self.padded = padded[:n], padded
        word = inside[self.data]
        edge = offsets[:-1][offsets[:-1] < n]
        before = np.empty(n, dtype=bool)
        before[1:] = word[:-1]
        before[edge] = False
        after = np.empty(n, dtype=bool)
        after[:-1] = word[1:]
        if n:
            after[n - 1] = False
            after[edge[edge > 0] - 1] = False
        self.start = np.flatnonzero(word & ~before)
        self.end = np.flatnonzero(word & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.rows = len(offsets) - 1
        self.count = np.diff(self.first)
        self.row = np.repeat(np.arange(self.rows), self.count)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, longest: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first ``longest`` bytes."""
        size = self.end - self.start
        if longest is not None:
            size = np.minimum(size, longest)
        eights = np.ndarray(
            (len(self.padded) - 7,), dtype="<u8", buffer=self.padded, strides=(1,)
        )
        h = mixed(size.astype(np.uint64) * _M1 + np.uint64(1))
        at, left, which = self.start, size, None
        while len(left):
            part = eights[at] & _MASKS[np.minimum(left, 8)]
            if which is None:
                h = (h ^ part) * _M1
                h ^= h >> np.uint64(32)
            else:
                g = (h[which] ^ part) * _M1
                h[which] = g ^ (g >> np.uint64(32))
            more = np.flatnonzero(left > 8)
            which = more if which is None else which[more]
            at, left = at[more] + 8, left[more] - 8
        return mixed(h)

    def text(self, word: int) -> str:
        return bytes(self.data[self.start[word] : self.end[word]]).decode()


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words, across row ends too; at least ``n`` are given."""
    m = len(hashes) - n + 1
    g = hashes[:m].copy()
    for j in range(1, n):
        g = g * _M1 + hashes[j : m + j]
        g ^= g >> np.uint64(29)
    return mixed(g)


def gram_hashes(words: Words, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``n`` words, and the numbers of their first words.

    A row with fewer words, but not none, has one run: all its words.
    """
    m = len(hashes)
    grams, at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if m >= n:
        at = np.flatnonzero(words.row[: m - n + 1] == words.row[n - 1 :])
        grams = run_hashes(hashes, n)[at]
    short = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(short):
        extra = np.empty(len(short), np.uint64)
        for k in range(1, n):
            of = np.flatnonzero(words.count[short] == k)
            first = words.first[short[of]]
            g = hashes[first]
            for j in range(1, k):
                g = g * _M1 + hashes[first + j]
                g ^= g >> np.uint64(29)
            extra[of] = mixed(g + np.uint64(k))
        grams = np.concatenate([grams, extra])
        at = np.concatenate([at, words.first[short]])
        order = np.argsort(at, kind="stable")
        grams, at = grams[order], at[order]
    return grams, at


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


