"""Near copies, repeated passages and benchmark passages against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest

from doclog.llm import decontaminate, ngram_join, repeats, shared
from doclog.llm.components import components

from .helpers import BLANK_WORD, PLAIN_WORD, frame, lower, texts


def _component_of(rows, n, num):
    sets = []
    for _, text in rows:
        w = BLANK_WORD.findall(lower(text))
        sets.append({tuple(w[i : i + n]) for i in range(max(len(w) - n + 1, 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            same_id = rows[i][0] is not None and rows[i][0] == rows[j][0]
            alike = a and b and 100 * len(a & b) >= num * len(a | b)
            known = rows[i][0] is not None and rows[j][0] is not None
            if known and (alike or (same_id and a and b)):
                parent[root(i)] = root(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(least.get(root(i), doc), doc)
    return [(doc, len(s)) for (doc, _), s in zip(rows, sets, strict=True)], [
        least.get(root(i)) for i in range(len(rows))
    ]


@pytest.mark.parametrize(("seed", "n", "num", "block"), [(1, 4, 85, 1000), (2, 5, 80, 12)])
def test_ngram_join(spark, monkeypatch, seed, n, num, block):
    if block < 1000:
        monkeypatch.setattr(ngram_join, "LEAST_FREQUENT", 4)
    rows = texts(seed, 160)
    found = ngram_join.join_ngrams(frame(spark, rows), n, num, block=block).collect()
    heads, parts = _component_of(rows, n, num)
    wanted = [(d, k, c) for (d, k), c in zip(heads, parts, strict=True) if d is not None]
    got = [tuple(r) for r in found if r.doc_id is not None]
    assert sorted(got) == sorted(wanted)
    # a row without an id ties nothing, but has the component of an equal set
    nameless = [c for (d, _), c in zip(heads, parts, strict=True) if d is None]
    assert len([r for r in found if r.doc_id is None]) == len(nameless)


@pytest.mark.parametrize("sent", [0, 1 << 18])
def test_components_of_scattered_links(spark, monkeypatch, sent):
    import doclog.llm.components as module

    monkeypatch.setattr(module, "MAX_SENT_ROOTS", sent)
    monkeypatch.setattr(module, "LINKS_AT_ONCE", 300)
    draw = random.Random(4)
    links = [(i, i + 1) for i in range(1000, 3000)]  # a chain in order
    links += [(5000, 5001 + i) for i in range(800)]  # a hub
    links += [(draw.randrange(10000, 11000), draw.randrange(10000, 11000)) for _ in range(600)]
    links += [(-7, 10**15), (10**15, 3), (4, 4)]
    draw.shuffle(links)
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in links:
        a, b = root(u), root(v)
        parent[max(a, b)] = min(a, b)
    frame = spark.createDataFrame(links, "u long, v long").repartition(9)
    found = {r.id: r.component for r in components(frame).collect()}
    assert found == {x: root(x) for x in parent if root(x) != x}


def test_components_write_few_files(spark, monkeypatch):
    """Side tables have few files, whatever the shuffle partitions; few ties need one task."""
    import doclog.llm.components as module

    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    written = []

    def counted(df):
        out = shared.saved(df)
        written.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(module, "saved", counted)
    draw = random.Random(8)
    links = [(i, i + 1) for i in range(600)] + [(2000 + 2 * i, 2001 + 2 * i) for i in range(300)]
    draw.shuffle(links)
    rows = spark.createDataFrame(links, "u long, v long").repartition(9)
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        found = {r.id: r.component for r in components(rows).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found == {i: 0 for i in range(1, 601)} | {2001 + 2 * i: 2000 + 2 * i for i in range(300)}
    most = max(64 // 8, 2 * spark.sparkContext.defaultParallelism)
    # links, ties, roots of ties; roots sent up, all roots, least ids
    assert len(written) == 6 and max(written[1:]) <= most and written[2] == 1


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    found = components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.id: r.component for r in found} == {
        **{i: 0 for i in range(1, 51)}, **{100 + i: 100 for i in range(1, 40)}
    }


def _kept(rows, window):
    listed = [(d if d is not None else 1 << 62, BLANK_WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in listed:
        for i in range(len(w) - window + 1):
            key = tuple(w[i : i + window])
            first[key] = min(first.get(key, (1 << 63, 0)), (d, i))
    out = []
    for (doc, _), (d, w) in zip(rows, listed, strict=True):
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i : i + window])] < (d, i):
                gone.update(range(i, i + window))
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("sent_bytes", [64 << 20, -1])
def test_repeats(spark, monkeypatch, sent_bytes):
    monkeypatch.setattr(repeats, "SENT_BYTES", sent_bytes)
    rows = texts(3, 120)
    docs = frame(spark, rows).selectExpr("*", "1 AS __key", "'x' AS kept_text", "2 AS start")
    found = repeats.remove_repeats(docs)
    assert found.columns == ["doc_id", "text", "__key", "start", "n_words", "n_removed", "kept_text"]
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert sorted(got, key=repr) == sorted(_kept(rows, 20), key=repr)


@pytest.mark.parametrize("sent", [1 << 20, -1])
def test_repeats_of_frequent_minimisers(spark, monkeypatch, sent):
    monkeypatch.setattr(repeats, "FREQUENT", 3)
    monkeypatch.setattr(repeats, "SENT_MINIMISERS", sent)
    rows = texts(3, 120)
    found = repeats.remove_repeats(frame(spark, rows))
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert sorted(got, key=repr) == sorted(_kept(rows, 20), key=repr)


def test_stock_line_fills_no_bucket(spark, monkeypatch):
    monkeypatch.setattr(repeats, "FREQUENT", 50)
    line = " ".join(f"stock{i}" for i in range(8))
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(20)) + f" {line} " + " ".join(f"v{i}x{j}" for j in range(20))) for i in range(400)]
    keyed = frame(spark, rows).selectExpr("xxhash64(doc_id, text) AS __llm_key", "doc_id AS _doc", "text")
    shared = repeats._shared_minimisers(keyed, 20, 6)
    packed = repeats.saved(repeats._super_kmers(keyed.join(shared, "__llm_key"), 20, 6))
    assert max(r["count"] for r in packed.groupBy("h").count().collect()) > 100
    again = repeats._dealt_again(packed, 20)
    assert max(r["count"] for r in again.groupBy("h").count().collect()) <= 50
    assert again.agg({"n": "sum"}).first() == packed.agg({"n": "sum"}).first()


def test_windows_repeat_within_one_run(spark):
    rows = [(1, "a " * 21), (2, "b c " * 30), (3, " ".join(f"u{i}" for i in range(40)) + " z" * 50)]
    found = repeats.remove_repeats(frame(spark, rows))
    got = [tuple(r) for r in found.select("doc_id", "n_words", "n_removed", "kept_text").collect()]
    assert sorted(got) == sorted(_kept(rows, 20))


def _leaks(rows, items, window):
    out = []
    for doc, text in rows:
        w = PLAIN_WORD.findall(lower(text))
        hit, names = set(), set()
        for item, value in items:
            own = PLAIN_WORD.findall(lower(value))
            size = min(len(own), window)
            windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if size else set()
            for i in range(len(w) - size + 1 if size else 0):
                if tuple(w[i : i + size]) in windows:
                    hit.update(range(i, i + size))
                    names.add(str(item))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(names), digest, bool(hit)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 150])
def test_decontamination(spark, monkeypatch, tmp_path, block_bytes):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block_bytes)
    rows = texts(4, 80, words=60)
    long = [t for _, t in rows if t and len(BLANK_WORD.findall(t)) > 25]
    items = [(i, t[:120]) for i, t in enumerate(long[:6])]
    items += [(20, "w1 W2"), (21, ""), (22, None), (23, "w1, w2."), (24, " ".join(["a"] * 12))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    got = [tuple(r) for r in decontaminate.op5_decontamination(spark, str(tmp_path)).collect()]
    assert sorted(got, key=repr) == sorted(_leaks(rows, items, 10), key=repr)


def test_leaks_are_cut(spark):
    words = [f"q{i}" for i in range(12)]
    clean = " ".join(f"z{i}" for i in range(30))
    rows = [(1, f"{clean} {' '.join(words)}, {clean}"), (2, " ".join(words)), (3, clean), (4, None)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = frame(spark, rows).selectExpr("*", "5 AS n_words")
    found = decontaminate.remove_leaks(docs, bench)
    assert found.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_words) for r in found.collect()}
    assert got == {1: (f"{clean} , {clean}", 5), 3: (clean, 5), 4: (None, 5)}


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    items = spark.createDataFrame([], "item_id long, text string")
    assert ngram_join.join_ngrams(empty).collect() == []
    assert repeats.remove_repeats(empty).collect() == []
    assert decontaminate.find_leaks(empty, items).collect() == []
    one = frame(spark, [(1, "a b c")])
    assert decontaminate.find_leaks(one, items).first().leaks is None
