"""Spelling variants: words one edit apart, found in a trie of letter-group counts.

The letters are dealt to a few groups of about equal use. A word's place in the
trie is the list of its counts by group, one level a group; words of equal counts
share a leaf. One inserted, deleted or replaced letter raises one count by one at
most and lowers one by one at most, so a search goes down depth-first with a
budget of one surplus and one deficit and turns back where either is overspent.
Words of the leaves it reaches are compared letter by letter.

The trie is cut for Spark: a node with more than a set number of words is opened,
and every closed node below an open one is a shard of its own. A word is stored in
its own shard and visits the shards that its budget reaches and that come later in
order, so each pair meets in one task. Open nodes are few by construction
(``MAX_SHARDS``), whatever the number of words.

Cases: null texts have no words and equal rows count as often as they occur; a
null id is written ``null``; of near words used equally often the first in order
of code points is the form; words without a near word have ``n_near`` 0, no form
and are their own root; tables without words give no rows. Counts above 255 of a
group are held as 255, which never hides a pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import saved, table

GROUPS = 12
# A shard has this many words at least before its node is opened, and more where
# the words would otherwise make more than MAX_SHARDS shards of that size.
SHARD_WORDS, MAX_SHARDS = 8192, 4096
# Pairs of a subtree's words and the queries alive there that are compared at once.
LEAF_PAIRS = 2048
# Words up to this length are compared as rows of a matrix.
MATRIX_WIDTH = 40
_BLOCK = 1 << 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Fixed values of the contract: one run in 199 loses a letter, words have six
# letters and five occurrences, a form is five times as common.
NOISE, LEAST_LETTERS, LEAST_SEEN, FORM_FACTOR = 199, 6, 5, 5


def count_words(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    noise: int = NOISE,
    letters: int = LEAST_LETTERS,
    seen: int = LEAST_SEEN,
) -> DataFrame:
    """``word, n``: runs of letters with some letters deleted by the rule of ``noise``.

    Words are counted in each task before they are shuffled, so a word that makes
    up a third of all texts leaves each task as one row.
    """
    small = F.translate(F.col(text), _UPPER, _LOWER)
    name = F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))
    runs = docs.select(
        name.alias("name"),
        F.explode(F.regexp_extract_all(small, F.lit("[a-zÀ-ÿ]+"), F.lit(0))).alias("run"),
    )
    size, run = F.length("run"), F.col("run")
    runs = runs.where(size >= letters)
    h = F.crc32(F.concat("name", F.lit(":"), "run").cast("binary"))
    at = (h % size).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, size))
    words = runs.select(F.when(h % noise == 0, shorter).otherwise(run).alias("word"))
    counted = words.where(F.length("word") >= letters).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= seen)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """The group of each of 256 letters, so that groups are used about equally."""
    used = words.select(F.explode(F.split("word", "")).alias("c")).groupBy("c").count().collect()
    load, group = [0] * groups, np.zeros(256, np.uint8)
    for row in sorted(used, key=lambda r: (-r["count"], r.c)):
        if row.c:
            at = load.index(min(load))
            group[ord(row.c)] = at
            load[at] += row["count"]
    return group


class Lexicon:
    """Words as letters (one byte each) and their counts by letter group."""

    def __init__(self, words: pa.Array, group: np.ndarray, groups: int) -> None:
        self.letters = [w.encode("latin-1") for w in words.to_pylist()]
        self.size = np.array([len(w) for w in self.letters], np.int64)
        data = np.frombuffer(b"".join(self.letters), np.uint8)
        row = np.repeat(np.arange(len(self.letters)), self.size)
        cells = np.bincount(row * groups + group[data], minlength=len(self.letters) * groups)
        self.counts = np.minimum(cells, 255).astype(np.int16).reshape(-1, groups)
        self._data, self._row = data, row

    def __len__(self) -> int:
        return len(self.letters)

    def matrix(self, width: int) -> np.ndarray:
        """The first ``width`` letters of each word, zeros behind its end."""
        out = np.zeros((len(self), width), np.uint8)
        start = np.cumsum(self.size) - self.size
        place = np.arange(len(self._data)) - np.repeat(start, self.size)
        inside = place < width
        out[self._row[inside], place[inside]] = self._data[inside]
        return out


def _spent(change: np.ndarray, budget: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which queries may take a step by ``change``, and what they have left.

    ``budget`` holds a surplus in bit 0 and a deficit in bit 1.
    """
    cost = np.where(change == 1, 1, np.where(change == -1, 2, 0)).astype(np.uint8)
    ok = (np.abs(change) <= 1) & ((budget & cost) == cost)
    return ok, budget - cost


def reachable(counts: np.ndarray, opened: set[bytes]) -> Iterator[tuple[bytes, np.ndarray]]:
    """The shards each row may have near words in: ``shard, rows``, depth first."""
    stack = [(b"", np.arange(len(counts)), np.full(len(counts), 3, np.uint8))]
    while stack:
        node, alive, budget = stack.pop()
        if node not in opened or len(node) == counts.shape[1]:
            yield node, alive
            continue
        own = counts[alive, len(node)]
        values = np.unique(own)
        values = np.unique(np.concatenate([values - 1, values, values + 1]))
        for value in values[(values >= 0) & (values <= 255)]:
            ok, left = _spent(value - own, budget)
            if ok.any():
                stack.append((node + bytes([value]), alive[ok], left[ok]))


class CountTrie:
    """The words of a shard in the order of their counts; a node is a range of them."""

    def __init__(self, words: Lexicon) -> None:
        self.words = words
        self.order = np.lexsort(words.counts.T[::-1])
        self.counts = words.counts[self.order]
        self.matrix = words.matrix(MATRIX_WIDTH)

    def near(self, queries: Lexicon) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query and a word of the trie that are one edit apart."""
        depth_of_leaf = self.counts.shape[1]
        matrix = queries.matrix(MATRIX_WIDTH)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        n_waiting = 0

        def settle() -> None:
            if waiting:
                q, w = (np.concatenate(x) for x in zip(*waiting, strict=True))
                found.append(self._verified(queries, matrix, q, w))
                waiting.clear()

        stack = [(0, len(self.counts), 0, np.arange(len(queries)), np.full(len(queries), 3, np.uint8))]
        while stack:
            lo, hi, depth, alive, budget = stack.pop()
            if depth == depth_of_leaf and (hi - lo) * len(alive) > LEAF_PAIRS:
                found.append(self._alike(queries, alive, self.order[lo:hi]))
            elif depth == depth_of_leaf or (hi - lo) * len(alive) <= LEAF_PAIRS:
                step = self.counts[None, lo:hi, depth:] - queries.counts[alive, None, depth:]
                up, down = np.maximum(step, 0).sum(2), np.maximum(-step, 0).sum(2)
                q, w = np.nonzero((up <= (budget & 1)[:, None]) & (down <= (budget >> 1)[:, None]))
                waiting.append((alive[q], self.order[lo + w]))
                n_waiting += len(q)
                if n_waiting >= _BLOCK:
                    settle()
                    n_waiting = 0
            else:
                level = self.counts[lo:hi, depth]
                edges = np.concatenate([[0], np.flatnonzero(np.diff(level)) + 1, [hi - lo]])
                own = queries.counts[alive, depth]
                for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    ok, left = _spent(level[a] - own, budget)
                    if ok.any():
                        stack.append((lo + a, lo + b, depth + 1, alive[ok], left[ok]))
        settle()
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        q, w = zip(*found, strict=True)
        return np.concatenate(q), np.concatenate(w)

    def _verified(
        self, queries: Lexicon, matrix: np.ndarray, q: np.ndarray, w: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Of candidate pairs those one edit apart."""
        n, m = queries.size[q], self.words.size[w]
        near = np.abs(n - m) <= 1
        q, w, n, m = q[near], w[near], n[near], m[near]
        fits = np.maximum(n, m) <= MATRIX_WIDTH
        good = np.zeros(len(q), bool)
        for i in np.flatnonzero(~fits).tolist():
            good[i] = one_edit(queries.letters[q[i]], self.words.letters[w[i]])
        at = np.flatnonzero(fits)
        a, b = matrix[q[at]], self.matrix[w[at]]
        short = (n[at] < m[at])[:, None]
        long, other = np.where(short, b, a), np.where(short, a, b)
        differ = long != other
        first = differ.argmax(1)
        same = n[at] == m[at]
        replaced = same & (differ.sum(1) == 1)
        # a longer word without the letter where the two first differ is the other
        moved = long[:, 1:] != other[:, :-1]
        moved &= np.arange(MATRIX_WIDTH - 1)[None, :] >= first[:, None]
        good[at] = replaced | (~same & ~moved.any(1))
        return q[good], w[good]

    def _alike(
        self, queries: Lexicon, alive: np.ndarray, leaf: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """The same for a large leaf, by looking up words without one letter each.

        Time goes with the letters of both sides, not with the pairs of them.
        """
        whole = {self.words.letters[w]: w for w in leaf.tolist()}
        without: dict[tuple[int, bytes], list[int]] = {}
        cut: dict[bytes, set[int]] = {}
        for w in leaf.tolist():
            word = self.words.letters[w]
            for i in range(len(word)):
                rest = word[:i] + word[i + 1 :]
                without.setdefault((i, rest), []).append(w)
                cut.setdefault(rest, set()).add(w)
        q_out: list[int] = []
        w_out: list[int] = []
        for q in alive.tolist():
            word = queries.letters[q]
            hits = set(cut.get(word, ()))
            for i in range(len(word)):
                rest = word[:i] + word[i + 1 :]
                hits.update(without.get((i, rest), ()))
                if rest in whole:
                    hits.add(whole[rest])
            hits.discard(whole.get(word, -1))
            q_out += [q] * len(hits)
            w_out += sorted(hits)
        return np.array(q_out, np.int64), np.array(w_out, np.int64)


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether one inserted, deleted or replaced letter makes ``b`` of ``a``."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1 or a == b:
        return False
    i = 0
    while i < len(b) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == (b[i + 1 :] if len(a) == len(b) else b[i:])


def near_words(words: DataFrame, groups: int = GROUPS) -> DataFrame:
    """``word, n, near, near_n`` for each word and each word one edit from it.

    ``words`` has distinct words ``word`` of letters up to U+00FF and counts ``n``;
    it is read several times.
    """
    total = words.count()
    least = max(SHARD_WORDS, -(-total // MAX_SHARDS))
    group = letter_groups(words, groups)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Lexicon(batch.column(0), group, groups).counts.astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.tobytes() for row in counts], pa.binary())], names=["place"]
            )

    opened: set[bytes] = set()
    if total > least:
        places = words.select("word").mapInArrow(place, "place binary")
        alike = places.groupBy("place").agg(F.count("*").alias("n"))
        depth = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("depth")
        nodes = alike.select("place", "n", depth).select(
            F.substring("place", F.lit(1), F.col("depth")).alias("node"), "n"
        )
        nodes = nodes.groupBy("node").agg(F.sum("n").alias("n")).where(F.col("n") > least)
        # at most ``groups`` nodes above each of MAX_SHARDS lots of words
        opened = {bytes(row.node) for row in nodes.select("node").collect()}

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Lexicon(batch.column(0), group, groups).counts
            shards: list[bytes] = []
            rows: list[np.ndarray] = []
            home: list[bytes] = [b""] * len(batch)
            reached = list(reachable(counts, opened))
            for shard, which in reached:
                own = (counts[which, : len(shard)] == np.frombuffer(shard, np.uint8)).all(1)
                for i in which[own].tolist():
                    home[i] = shard
            for shard, which in reached:
                later = np.array([home[i] <= shard for i in which.tolist()], bool)
                rows.append(which[later])
                shards += [shard] * int(later.sum())
            at = np.concatenate(rows) if rows else np.zeros(0, np.int64)
            visits = [home[i] != shard for i, shard in zip(at.tolist(), shards, strict=True)]
            taken = pa.array(at)
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.binary()), pa.array(visits, pa.bool_()),
                 batch.column(0).take(taken), batch.column(1).take(taken)],
                names=["shard", "visits", "word", "n"],
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, parts, trie, stored = None, [], None, None

        def rows(q: pa.RecordBatch, w: pa.Table, i: np.ndarray, j: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(i), _BLOCK):
                a, b = pa.array(i[at : at + _BLOCK]), pa.array(j[at : at + _BLOCK])
                columns = [q.column("word").take(a), q.column("n").take(a),
                           w.column("word").take(b), w.column("n").take(b)]
                columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
                yield pa.RecordBatch.from_arrays(columns, names=["word", "n", "near", "near_n"])

        def closed() -> Iterator[pa.RecordBatch]:
            """All words of a shard are here: build its trie and search it with them."""
            nonlocal trie, stored, parts
            if parts:
                stored = pa.Table.from_batches(parts).combine_chunks()
                own = Lexicon(stored.column("word"), group, groups)
                trie, parts = CountTrie(own), []
                for lo in range(0, len(own), SHARD_WORDS):
                    some = stored.slice(lo, SHARD_WORDS)
                    i, j = trie.near(Lexicon(some.column("word"), group, groups))
                    once = lo + i < j
                    yield from rows(some, stored, i[once], j[once])

        for batch in batches:
            shards, visits = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            edges = [0] + [
                k for k in range(1, len(shards))
                if shards[k] != shards[k - 1] or visits[k] != visits[k - 1]
            ] + [len(shards)]
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if shards[lo] != current:
                    yield from closed()
                    current, trie, stored = shards[lo], None, None
                if not visits[lo]:
                    parts.append(part)
                    continue
                yield from closed()
                if trie is not None:
                    i, j = trie.near(Lexicon(part.column(2), group, groups))
                    yield from rows(part, stored, i, j)
        yield from closed()

    met = words.select("word", "n").mapInArrow(visit, "shard binary, visits boolean, word string, n bigint")
    met = met.repartition("shard").sortWithinPartitions("shard", "visits")
    pairs = met.mapInArrow(meet, "word string, n bigint, near string, near_n bigint")
    ways = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"),
                 F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return pairs.select(F.inline(ways))


def spelling_forms(words: DataFrame, factor: int = FORM_FACTOR, groups: int = GROUPS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of distinct words with their counts."""
    words = saved(words.select("word", "n"))
    near = near_words(words, groups)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    near = near.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    joined = words.join(near, "word", "left")
    takes = -F.col("best.less") >= factor * F.col("n")
    formed = saved(
        joined.select(
            "word", F.when(takes, F.col("best.form")).alias("form"), "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(takes, -F.col("best.less")).alias("form_n"),
        )
    )
    # a form is ``factor`` times as common, so chains are short; their length doubles each step
    most = words.agg(F.max("n")).first()[0] or 1
    steps = math.log(max(most, factor), factor) if factor > 1 else 64
    roots = formed.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps + 1))):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        roots = saved(
            roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        )
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


@query("op13_spelling")
def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return spelling_forms(count_words(docs))
