"""Packing of token sequences by minimum bin slack.

Each document's tokens are cut into full windows and one shorter rest. All
pieces of one length are alike to the packer, so it works on the number of
pieces by length, a histogram of bounded size:

* the longest length left starts a window;
* a bitset holds which fill levels the lengths left can reach (bit s is set if
  some multiset of them sums to s), one shifted OR per use of a length;
* the level closest to the window's capacity is taken and the counts of lengths
  that reach it are found by going back through the bitsets;
* the pattern is repeated for as long as the counts last.

Each pattern uses up at least one length or halves its count, so there are a few
thousand at most, whatever the number of pieces. Then every piece gets its rank
among those of its length, and arithmetic tells its sequence and offset.

Cases: null and empty texts are one end token; equal texts, and rows with equal
ids, are packed separately; an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .registry import query
from .shared import saved, table

WINDOW, END_ID = 2048, 1
# Pieces that one task ranks at most.
RANKED_AT_ONCE = 4096

# Texts of these characters only are split alike by both libraries, which share
# the vocabulary; the faster one takes them. Tests compare the two.
_PLAIN = re.compile("[\\x00-\\u024f\\u2010-\\u2027\\u2030-\\u205e\\u20ac]*")


class TokenCounter:
    """Ids of texts under the vocabulary file, an end id after each.

    ``ranks`` is the same vocabulary for the faster library (None: not used),
    ``special`` the texts that the file reads as single ids.
    """

    def __init__(
        self, path: str, ranks: str | None, pattern: str, special: tuple[str, ...], end: int
    ) -> None:
        self.path, self.special, self.end = path, special, np.uint32(end)
        self._slow, self.fast = None, _fast_encoding(ranks, pattern) if ranks else None

    def ids(self, text: str) -> np.ndarray:
        if self.fast and _PLAIN.fullmatch(text) and not any(s in text for s in self.special):
            found = self.fast.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
        else:
            if self._slow is None:
                from tokenizers import Tokenizer

                self._slow = Tokenizer.from_file(self.path)
            found = np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)
        return np.append(found.astype("<u4", copy=False), self.end)


def _fast_encoding(path: str, pattern: str):
    """Built once in each Python worker: the library keeps encodings by name."""
    import base64

    import tiktoken
    from tiktoken.registry import ENCODINGS

    if path not in ENCODINGS:
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        ENCODINGS[path] = tiktoken.Encoding(
            path, pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
        )
    return ENCODINGS[path]


def pack_lengths(counts: np.ndarray, capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns (repeats, {length: uses}) that use up ``counts`` pieces of each length."""
    left = {n: int(c) for n, c in enumerate(counts.tolist()) if n and c}
    patterns = []
    full = (1 << (capacity + 1)) - 1
    while left:
        lengths = sorted(left, reverse=True)
        start = lengths[0]
        room = capacity - start
        # reachable levels after each (length, power of two of uses): bitsets for going back
        reach, steps = 1, []
        goal = 1 << room
        for n in lengths:
            most = min(left[n] - (n == start), room // n)
            uses = 1
            while most > 0 and not reach & goal:
                k = min(uses, most)
                steps.append((n, k, reach))
                reach |= (reach << (n * k)) & full & ((1 << (room + 1)) - 1)
                most -= k
                uses *= 2
            if reach & goal:
                break
        level = reach.bit_length() - 1
        chosen = {start: 1}
        for n, k, before in reversed(steps):
            if not before >> level & 1:
                chosen[n] = chosen.get(n, 0) + k
                level -= n * k
        repeats = min(left[n] // k for n, k in chosen.items())
        patterns.append((repeats, chosen))
        for n, k in chosen.items():
            left[n] -= k * repeats
            if not left[n]:
                del left[n]
    return patterns


def _plan(patterns: list[tuple[int, dict[int, int]]]) -> pd.DataFrame:
    """Per length and range of ranks: the first sequence, uses per sequence, and offset."""
    rows, used, sequence = [], {}, 0
    for repeats, chosen in patterns:
        offset = 0
        for n in sorted(chosen, reverse=True):
            k, first = chosen[n], used.get(n, 0)
            rows.append((n, first, first + k * repeats, sequence, k, offset))
            used[n] = first + k * repeats
            offset += n * k
        sequence += repeats
    names = ["length", "lo", "hi", "sequence", "uses", "base"]
    return pd.DataFrame(rows, columns=names)


def tokenized_pieces(
    docs: DataFrame, counter_args: tuple, window: int, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens`` and ``row``, of full windows and rests."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TokenCounter(*counter_args)
        for batch in batches:
            source, start, length, crc, total = [], [], [], [], []
            for i, value in enumerate(batch.column(1)):
                ids = counter.ids(value.as_py() or "")
                raw = memoryview(ids).cast("B")
                for at in range(0, len(ids), window):
                    end = min(at + window, len(ids))
                    source.append(i)
                    start.append(at)
                    length.append(end - at)
                    crc.append(zlib.crc32(raw[4 * at : 4 * end]))
                    total.append(len(ids))
            columns = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(source, pa.int64())), *columns],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return docs.select(doc_id, text).mapInArrow(
        cut,
        f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint",
    )


def pack(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces of known ``length``.

    The histogram of lengths, at most ``window`` rows, is packed on the driver.
    Pieces of a length are ranked in buckets of a bounded number of rows.
    """
    pieces = saved(pieces.withColumn("_row", F.monotonically_increasing_id()))
    found = pieces.groupBy("length").count().collect()
    counts = np.zeros(window + 1, np.int64)
    for row in found:
        counts[row["length"]] = row["count"]
    plan = _plan(pack_lengths(counts, window))
    split = {n: -(-int(c) // RANKED_AT_ONCE) for n, c in enumerate(counts.tolist()) if c > RANKED_AT_ONCE}
    buckets = F.lit(1)
    if split:
        of = F.create_map(*[F.lit(x) for pair in split.items() for x in pair])
        buckets = F.coalesce(of[F.col("length").cast("int")], F.lit(1))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("_row"), buckets))
    sizes = dealt.groupBy("length", "_bucket").count()
    before = W.partitionBy("length").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    sizes = sizes.select(
        "length", "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before")
    )
    rank = F.row_number().over(W.partitionBy("length", "_bucket").orderBy("_row")) - 1
    ranked = (
        dealt.withColumn("_rank", rank)
        .join(sizes, ["length", "_bucket"])
        .withColumn("_rank", F.col("_rank") + F.col("_before"))
    )
    starts = {n: part for n, part in plan.groupby("length")}
    columns = [c for c in pieces.columns if c != "_row"]
    schema = pieces.drop("_row").selectExpr("*", "0L AS sequence_id", "0L AS offset").schema
    place = columns.index("length")

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column(place).to_numpy()
            ranks = batch.column(len(columns)).to_numpy()
            sequence, offset = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            for n in np.unique(lengths).tolist():
                own, part = np.flatnonzero(lengths == n), starts[n]
                at = np.searchsorted(part["hi"].to_numpy(), ranks[own], side="right")
                inner = ranks[own] - part["lo"].to_numpy()[at]
                uses = part["uses"].to_numpy()[at]
                sequence[own] = part["sequence"].to_numpy()[at] + inner // uses
                offset[own] = part["base"].to_numpy()[at] + inner % uses * n
            arrays = [batch.column(i) for i in range(len(columns))]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(sequence), pa.array(offset)], names=schema.names
            )

    return ranked.select(*columns, "_rank").mapInArrow(seat, schema)


def public_vocabulary() -> tuple:
    """Arguments of TokenCounter for the public byte-level vocabulary."""
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    special = tuple(
        t.content for t in Tokenizer.from_file(path).get_added_tokens_decoder().values()
    )
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return path, ranks, public_tokenizers.PATTERN, special, END_ID


@query("op2_packing")
def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pack(tokenized_pieces(docs, public_vocabulary(), WINDOW))
