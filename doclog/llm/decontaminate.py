"""Benchmark passages in documents, found with a generalised suffix automaton.

The automaton accepts every run of consecutive words of every test item. A
document is streamed through it word by word; the length of the longest run
that ends at a word is known at each step, so any match of at least the window's
length is seen where it ends, whatever its place in the item.

Cases: null or wordless texts have no words and no hits; an item of fewer words
than the window is one window; an item without words, or a null one, never
occurs; equal items are all reported; rows with equal ids are judged one by one;
other columns are carried along. An empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import ALNUM, Words, Work, chunks, released, table, texts

# Items are joined to automata of this many bytes of text at most, each of which
# is sent to all tasks; a larger benchmark makes more passes within each task.
BLOCK_BYTES = 1 << 20
# Documents that are searched at once.
ROWS_AT_ONCE = 1000
# A benchmark is a test set: more text than this is taken for a mistake.
MAX_BENCHMARK_BYTES = 256 << 20


class SuffixAutomaton:
    """All runs of consecutive words of some items, as a minimal automaton."""

    def __init__(self, items: list[tuple[str, list[int]]], window: int) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.window = [-1], [0], window
        for _, words in items:
            last = 0
            for word in words:
                last = self._extend(last, word)
        states = len(self.next)
        # the ancestor that stands for the last `window` words of a longer match
        self.at_window = [0] * states
        for state in sorted(range(1, states), key=self.length.__getitem__):
            above = self.link[state]
            if self.length[state] >= window:
                short = self.length[above] < window
                self.at_window[state] = state if short else self.at_window[above]
        self.owners: dict[int, list[str]] = {}
        # items that are shorter than the window, at the state of their whole text
        self.whole: dict[int, list[tuple[int, str]]] = {}
        for item, words in items:
            if len(words) < window:
                if words:
                    state = 0
                    for word in words:
                        state = self.next[state][word]
                    self.whole.setdefault(state, []).append((len(words), item))
                continue
            state = 0
            for i, word in enumerate(words):
                state = self.next[state][word]
                if i + 1 >= window:
                    own = self.owners.setdefault(self.at_window[state], [])
                    if not own or own[-1] != item:
                        own.append(item)
        # nearest state on the way up, itself included, where a short item ends
        self.short = [-1] * states
        for state in sorted(range(1, states), key=self.length.__getitem__):
            self.short[state] = state if state in self.whole else self.short[self.link[state]]

    def _extend(self, last: int, word: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if word in nxt[last]:
            state = nxt[last][word]
            if length[state] == length[last] + 1:
                return state
            return self._split(last, word, state)
        new = len(nxt)
        nxt.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and word not in nxt[p]:
            nxt[p][word] = new
            p = link[p]
        if p >= 0:
            state = nxt[p][word]
            link[new] = state if length[state] == length[p] + 1 else self._split(p, word, state)
        return new

    def _split(self, p: int, word: int, state: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        copy = len(nxt)
        nxt.append(dict(nxt[state]))
        length.append(length[p] + 1)
        link.append(link[state])
        link[state] = copy
        while p >= 0 and nxt[p].get(word) == state:
            nxt[p][word] = copy
            p = link[p]
        return copy

    def scan(self, words: list[int], at: int, spans: list, found: set[str]) -> None:
        """Add the hit spans [start, end) of a run that starts at word ``at``, and items."""
        nxt, link, length, window = self.next, self.link, self.length, self.window
        state = match = 0
        for i, word in enumerate(words, at + 1):
            while state and word not in nxt[state]:
                state = link[state]
                match = length[state]
            if word in nxt[state]:
                state = nxt[state][word]
                match += 1
            size = 0
            if match >= window:
                size = match
                found.update(self.owners.get(self.at_window[state], ()))
            short = self.short[state]
            while short > 0:
                for n, item in self.whole[short]:
                    if n <= match:
                        size = max(size, n)
                        found.add(item)
                short = self.short[link[short]]
            if size:
                start = i - size
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i))


class Matcher:
    """An automaton with the vocabulary of its items."""

    def __init__(self, items: list[tuple[str, str]], window: int) -> None:
        data, offsets = texts(pa.array([text for _, text in items], pa.string()))
        words = Words(data, offsets, ALNUM, lower=True)
        self.vocabulary, ids = np.unique(words.hashes(), return_inverse=True)
        first, ids = words.first, ids.tolist()
        listed = [(item, ids[first[k] : first[k + 1]]) for k, (item, _) in enumerate(items)]
        sizes = [min(len(w), window) for _, w in listed if w]
        self.least = min(sizes, default=0)
        self.automaton = SuffixAutomaton(listed, window)

    def hits(self, words: Words) -> dict[int, tuple[list, set[str]]]:
        """Of rows with hits: spans of words, counted from the row's first, and items."""
        if not self.least or not len(words):
            return {}
        hashes = words.hashes()
        place = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        known = self.vocabulary[place] == hashes
        # runs of known words within a row; others cannot be part of a match
        new_row = np.zeros(len(words), bool)
        new_row[words.first[:-1][words.first[:-1] < len(words)]] = True
        start = known & new_row
        start[1:] |= known[1:] & ~known[:-1]
        first = np.flatnonzero(start)
        stop = np.flatnonzero(start | ~known)
        end = np.append(stop, len(words))[np.searchsorted(stop, first, side="right")]
        long = end - first >= self.least
        out: dict[int, tuple[list, set[str]]] = {}
        for a, b in zip(first[long].tolist(), end[long].tolist(), strict=True):
            row = int(words.row[a])
            spans, found = out.get(row) or ([], set())
            self.automaton.scan(place[a:b].tolist(), a - int(words.first[row]), spans, found)
            if spans:
                out[row] = (spans, found)
        return out


SPANS = "array<struct<start:bigint,end:bigint,from_byte:bigint,to_byte:bigint>>"


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[str, str]]]:
    chosen = benchmark.select(
        F.col(item_id).cast("string").alias("item"), F.col(text).alias("text")
    ).where("text IS NOT NULL AND item IS NOT NULL")
    size = chosen.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    if size > MAX_BENCHMARK_BYTES:
        raise ValueError(f"The benchmark has {size} bytes, more than {MAX_BENCHMARK_BYTES}")
    block, held = [], 0
    for row in chosen.toLocalIterator():
        n = len(row.text.encode())
        if block and held + n > BLOCK_BYTES:
            yield block
            block, held = [], 0
        block.append((row.item, row.text))
        held += n
    if block:
        yield block


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = 10,
    names: tuple[str, str, str] = ("n_words", "leaks", "leaked_items"),
) -> DataFrame:
    """Add ``n_words``, ``leaks`` (merged spans of hit words) and ``leaked_items``.

    The columns added go by ``names``, and replace any that are there already.

    One narrow stage: the benchmark, of checked size, goes to the tasks in
    blocks, and each block's automaton adds to the spans of those before.
    """
    out, scan = _scans(docs, benchmark, text, item_id, item_text, window, names)
    return out.mapInArrow(scan, out.schema)


def _scans(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str,
    item_id: str,
    item_text: str,
    window: int,
    names: tuple[str, str, str],
) -> tuple[DataFrame, Work]:
    """``find_leaks`` but for its last block, and the work that is left of it."""
    docs = docs.drop(*names)
    empty = (F.lit(0).cast("bigint"), F.lit(None).cast(SPANS), F.lit(None).cast("array<string>"))
    out = docs.select("*", *[c.alias(name) for c, name in zip(empty, names, strict=True)])
    schema, sc = out.schema, docs.sparkSession.sparkContext
    position = docs.columns.index(text)

    works = []
    for items in list(_blocks(benchmark, item_id, item_text)) or [[]]:
        sent = sc.broadcast(items)

        @released
        def scan(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, window)
            for batch in batches:
                for at in range(0, len(batch), ROWS_AT_ONCE):
                    yield _scanned(batch.slice(at, ROWS_AT_ONCE), position, matcher)

        works.append(scan)
    for work in works[:-1]:
        out = out.mapInArrow(work, schema)
    return out, works[-1]


def _scanned(batch: pa.RecordBatch, position: int, matcher: Matcher) -> pa.RecordBatch:
    data, offsets = texts(batch.column(position))
    k = len(batch.schema.names) - 3
    n_words = np.zeros(len(batch), np.int64)
    spans: list = batch.column(k + 1).to_pylist()
    items: list = batch.column(k + 2).to_pylist()
    for a, b in chunks(offsets):
        words = Words(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], ALNUM, True)
        n_words[a:b] = words.count
        for row, (found, names) in matcher.hits(words).items():
            first, origin = words.first[row], offsets[a + row] - offsets[a]
            merged = sorted([(s["start"], s["end"]) for s in spans[a + row] or []] + found)
            joined: list[list[int]] = []
            for s, e in merged:
                if joined and joined[-1][1] >= s:
                    joined[-1][1] = max(joined[-1][1], e)
                else:
                    joined.append([s, e])
            spans[a + row] = [
                {
                    "start": s,
                    "end": e,
                    "from_byte": int(words.start[first + s] - origin),
                    "to_byte": int(words.end[first + e - 1] - origin),
                }
                for s, e in joined
            ]
            items[a + row] = sorted({*(items[a + row] or []), *names})
    columns = [batch.column(i) for i in range(k)]
    columns += [
        pa.array(n_words),
        pa.array(spans, batch.schema.field(k + 1).type),
        pa.array(items, batch.schema.field(k + 2).type),
    ]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def remove_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    window: int = 10,
    max_coverage: float = 0.5,
    **names: str,
) -> DataFrame:
    """Cut the matched spans from texts; drop documents of which more is covered.

    A document whose hit words are more than ``max_coverage`` of its words goes
    as a whole. Columns, and rows without a hit, stay as they are.
    """
    own = ("__llm_n_words", "__llm_leaks", "__llm_items")
    options = {"item_id": "item_id", "item_text": "text", **names}
    docs = docs.drop(*own)
    found, scan = _scans(docs, benchmark, text, window=window, names=own, **options)
    position, columns = docs.columns.index(text), docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # in the worker that finds the spans: a second one would hold the texts once more
        for batch in scan(batches):
            arrays = [batch.column(i) for i in range(len(columns))]
            words, found = (batch.column(len(columns) + i).to_pylist() for i in (0, 1))
            if any(found):
                new = arrays[position].to_pylist()
                stays = []
                for i, spans in enumerate(found):
                    spans = spans or []
                    stays.append(sum(s["end"] - s["start"] for s in spans) <= words[i] * max_coverage)
                    if spans:
                        raw, parts, at = new[i].encode(), [], 0
                        for s in spans:
                            parts.append(raw[at : s["from_byte"]])
                            at = s["to_byte"]
                        new[i] = b"".join([*parts, raw[at:]]).decode()
                arrays[position] = pa.array(new, arrays[position].type)
                batch = pa.RecordBatch.from_arrays(arrays, names=columns).filter(pa.array(stays))
                arrays = batch.columns
            yield pa.RecordBatch.from_arrays(arrays, names=columns)

    return found.mapInArrow(cut, docs.schema)


_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\\x{80}-\\x{10FFFF}]+')"""


@query(
    "op5_decontamination",
    f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
    windows AS (
      SELECT DISTINCT item, n, w[i:i + n - 1] AS words FROM (
        SELECT item, w, least(len(w), 10) AS n, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM b WHERE len(w) > 0)),
    places AS (
      SELECT doc_id, n, i, w[i:i + n - 1] AS words FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows))),
    hits AS (SELECT doc_id, places.n, i, item FROM places JOIN windows USING (n, words)),
    covered AS (SELECT doc_id, count(DISTINCT spot) AS k FROM (
      SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hits) GROUP BY doc_id),
    items AS (SELECT doc_id, count(DISTINCT item) AS k,
      string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM hits GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.k, 0) AS n_hit,
      coalesce(items.k, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
      covered.k IS NOT NULL AS contaminated
    FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
)
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, folder, "benchmark"), window=10)
    items = F.coalesce("leaked_items", F.array().cast("array<string>"))
    return found.select(
        "doc_id",
        "n_words",
        F.aggregate(
            F.coalesce("leaks", F.array().cast(SPANS)),
            F.lit(0).cast("bigint"),
            lambda s, x: s + x.end - x.start,
        ).alias("n_hit"),
        F.size(items).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        F.col("leaks").isNotNull().alias("contaminated"),
    )
