"""Packing, archives, personal data and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from doclog.llm import packing, pii, warc
from doclog.llm.registry import QUERIES

from .helpers import frame, texts

TABLES = "/root/testdata/sf0.001"


def _vocabulary():
    return packing.public_vocabulary()


def test_both_libraries_give_the_same_ids():
    path, ranks, pattern, special, end = _vocabulary()
    fast = packing.TokenCounter(path, ranks, pattern, special, end)
    slow = packing.TokenCounter(path, None, pattern, (), end)
    chars = [*range(0x250), *range(0x2010, 0x2028), *range(0x2030, 0x205F), 0x20AC]
    draw = random.Random(1)
    rows = ["", "<|endoftext|> x", "日本語 x", "é"]
    rows += [f"{draw.choice('x1 ')}{chr(c)}1{chr(c)}{chr(c)} {chr(draw.choice(chars))}'s" for c in chars]
    rows += ["".join(map(chr, draw.choices(chars, k=20))) for _ in range(2000)]
    for text in rows:
        assert fast.ids(text).tolist() == slow.ids(text).tolist()


@pytest.mark.parametrize("lengths", [[], [700] * 10, [2048] * 3 + [1], list(range(1, 2049)) * 3])
def test_patterns_use_up_all_lengths(lengths):
    counts = np.bincount(lengths, minlength=2049) if lengths else np.zeros(2049, int)
    used = np.zeros(2049, int)
    windows = 0
    for repeats, chosen in packing.pack_lengths(counts, 2048):
        assert sum(n * k for n, k in chosen.items()) <= 2048
        for n, k in chosen.items():
            used[n] += repeats * k
        windows += repeats
    assert (used[1:] == counts[1:]).all()
    if len(lengths) > 100:
        assert windows <= sum(lengths) / 2048 + 3


def test_window_is_filled_as_well_as_any_subset_could():
    draw = random.Random(3)
    for _ in range(50):
        lengths = [draw.randrange(1, 60) for _ in range(9)]
        counts = np.bincount(lengths, minlength=101)
        first = packing.pack_lengths(counts, 100)[0][1]
        start = max(lengths)
        rest = sorted(lengths)
        rest.remove(start)
        sums = {start}
        for n in rest:
            sums |= {s + n for s in sums if s + n <= 100}
        assert sum(n * k for n, k in first.items()) == max(sums)


@pytest.mark.parametrize("ranked", [4096, 5])
def test_packing(spark, monkeypatch, tmp_path, ranked):
    monkeypatch.setattr(packing, "RANKED_AT_ONCE", ranked)
    rows = texts(7, 60)
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op2_packing"](spark, str(tmp_path)).collect()
    counter = packing.TokenCounter(*_vocabulary())
    wanted = []
    for doc, text in rows:
        ids = counter.ids(text or "")
        for at in range(0, len(ids), 2048):
            piece = ids[at : at + 2048]
            wanted.append((doc, at, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
    got = [(r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    by = {}
    for r in found:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= sum(r.length for r in found) / 2048 + 2
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(packing.tokenized_pieces(empty, _vocabulary(), 2048)).collect() == []


PAGES = [
    (1, "http://a.com/", "x"), (2, "http://b.a.com/q?1", "x"), (3, None, None), (4, "", ""),
    (5, "http://a.com/", "é\r\n\r\nWARC/1.1\r\n\r\n"), (6, "https://A.com:8080/z\n", ""),
    (None, "http://n.org", "x"), (7, "http://a.com/", "%0A"), (8, "not a url", "x" * 100000),
    (9, "http://[bad", "y"), (10, "http://a.com", "y"), (10, "http://a.com", "y"),
]


@pytest.mark.parametrize(("least", "files", "lines"), [(0, 2, 2), (2, 2000, 1000)])
def test_archives(spark, least, files, lines):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    path = warc.write_archives(pages, least, files)
    blocks = warc.build_index(spark, path, lines)
    found = warc.read_records(spark, path, warc.index_entries(blocks)).collect()
    last = {}
    for page, _, html in PAGES:
        if page is not None:
            last[html or ""] = max(last.get(html or "", 0), page)
    wanted = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        to = last[html or ""] if len(raw) >= least and last[html or ""] != page else None
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        wanted.append((page, len(raw), digest, "revisit" if to else "response", to, None if to else raw))
    got = [(*tuple(r)[:5], None if r.payload is None else bytes(r.payload)) for r in found]
    assert sorted(got, key=repr) == sorted(wanted, key=repr)
    at = warc.lookup(blocks, ["http://a.com", "http://nowhere.org/"])
    assert sorted(r.page_id for r in at.collect()) == [1, 5, 7, 10, 10]


def test_archives_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = warc.write_archives(pages)
    blocks = warc.build_index(spark, path)
    assert warc.read_records(spark, path, warc.index_entries(blocks)).collect() == []


RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def _base(text: str) -> list[str]:
    out = []
    for k, (kind, rule) in enumerate(RULES.items()):
        for m in re.finditer(rule, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = (
                kind == "email"
                or (kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")))
                or (kind == "card" and 14 <= len(digits) <= 19 and _luhn(digits))
                or (kind == "phone" and 10 <= len(digits) <= 15)
            )
            if fits:
                out.append((m.start(), k, f"{kind}:{m.start()}:{m.end()}"))
    return [x[2] for x in sorted(out)]


@pytest.fixture(scope="module")
def private(spark, tmp_path_factory):
    draw = random.Random(5)
    parts = [*"01234567890123456789012345678901234567890123456789", *"  ..--@@++()ab_%é\n", "1.2.3.4"]
    parts += ["4337166598464399", "+1 (743) 555-3824", "x@y.zz", "4111 1111 1111 1111", "@b.c", "😀"]
    rows = [(i, "".join(draw.choices(parts, k=draw.choice([3, 10, 40, 200])))) for i in range(500)]
    rows += [
        (900, None), (901, ""), (902, "7" * 2000 + " a@b.c"), (903, "x" * 900 + "@" + "y." * 900 + "z"),
        (904, "1 " * 2000), (905, "1.2.3.4" * 300), (906, "+1 (743) 555-3824 " * 200), (0, rows[0][1]),
    ]
    path = str(tmp_path_factory.mktemp("private"))
    frame(spark, rows).write.parquet(f"{path}/documents.parquet")
    return rows, path


def test_personal_data(spark, private):
    rows, path = private
    found = {}
    for r in QUERIES["op9_pii"](spark, path).collect():
        found.setdefault(r.doc_id, []).append(r)
    for doc, text in rows:
        r, base = found[doc].pop(), _base(text or "")
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        counts = [sum(s.startswith(kind) for s in base) for kind in RULES]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        spans = r.spans.split(",") if r.spans else []
        assert set(base) <= set(spans)
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def _card(draw):
    body = "4" + "".join(draw.choices("0123456789", k=14))
    return next(body + c for c in "0123456789" if _luhn(body + c))


def _planted(draw, i):
    """A text with a base span, or with one thing that the rules miss: text, start, end, whether it is data."""
    words = draw.choices("the order was sent to them on monday with much thanks from all".split(), k=12)
    ip = [str(draw.randrange(1, 255)) for _ in range(4)]
    a, b, c = draw.randrange(200, 999), draw.randrange(200, 999), draw.randrange(1000, 9999)
    name, card = f"{draw.choice('abc')}{draw.choice(words)}.{c}", _card(draw)
    wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
    fours = [card[k : k + 4] for k in range(0, 16, 4)]
    kinds = [
        (f"{name}@mail.example.com", None), (".".join(ip), None), (card, None), (f"+1 ({a}) {b}-{c}", None),
        (f"{name} [at] mail.example.com", True), (f"{name}(at)shop.org", True), ("[.]".join(ip), True),
        (".".join(fours), True), ("/".join(fours), True), (f"1 ({a}) {b}-{c}", True), (f"001 {a} {b} {c}", True),
        (wrong, False), ("/".join([wrong[:4], wrong[4:8], wrong[8:12], wrong[12:]]), False), (",".join(ip), False),
        ("[.]".join([*ip[:3], "999"]), False), (f"{a}-{b}", False), (f"{c}{a}{b}7", False), (f"{name}@host", False),
    ]
    what, data = kinds[i % len(kinds)]
    before = " ".join(words[:6]) + " "
    return before + what + " " + " ".join(words[6:]), len(before), len(before) + len(what), data


def test_trees_add_data_written_otherwise(spark):
    draw = random.Random(8)
    cases = [_planted(draw, i) for i in range(1800)]
    docs = frame(spark, list(enumerate(x[0] for x in cases)))
    found = pii.find_personal_data(docs).where("NOT base").withColumnRenamed("key", "k")
    found = found.join(docs.selectExpr("doc_id", "xxhash64(text) AS k"), "k").collect()
    got = {(r.doc_id, r.start, r.end) for r in found}
    wanted = {(i, a, b) for i, (_, a, b, data) in enumerate(cases) if data}
    assert len(got & wanted) >= 0.9 * len(wanted)
    assert len(got & wanted) >= 0.95 * len(got)


def test_redaction(spark, private):
    rows, _ = private
    docs = frame(spark, rows).selectExpr("*", "1 AS _key", "2 AS start")
    found = pii.redact(docs)
    assert found.columns == docs.columns and found.count() == len(rows)
    one = frame(spark, [(1, "call +1 (743) 555-3824 or a.b@c.org now"), (2, "no data 12"), (3, None)])
    got = {r.doc_id: r.text for r in pii.redact(one).collect()}
    assert got == {1: "call [phone] or [email] now", 2: "no data 12", 3: None}


def test_native_only(spark, private):
    plan = QUERIES["op9_pii"](spark, private[1])._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_trees_and_sql_agree(spark):
    draw = np.random.default_rng(2)
    x = draw.integers(0, 6, (200, len(pii.FEATURES)))
    x = np.unique(x, axis=0)
    n = np.full(len(x), 10.0)
    trees = pii.BoostedTrees(x, n, np.where(x[:, 1] > 2, 9.0, 1.0))
    rows = spark.createDataFrame([tuple(map(int, r)) for r in x], list(pii.FEATURES))
    got = [r[0] for r in rows.coalesce(1).selectExpr(trees.sql()).collect()]
    assert np.allclose(got, trees.fitted)
    assert ((trees.fitted > 0.5) == (x[:, 1] > 2)).all()


def test_near_copies_go_row_by_row(spark):
    rows = texts(6, 120)
    rows += [(5, "one two three four five six"), (5, rows[7][1]), (None, rows[9][1]), (None, None)]
    docs = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "n long, doc_id long, text string")
    docs = docs.coalesce(1).sortWithinPartitions("n")
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    part = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                part = [part[j] if p == part[i] else p for p in part]
    groups = {}
    for i, p in enumerate(part):
        groups.setdefault(p, []).append(i)
    wanted = {min(g, key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i)) for g in groups.values()}
    kept = corpus_pipeline.drop_near_copies(spark, docs, TABLES).collect()
    assert {r.n for r in kept} == wanted and len(kept) == len(wanted) < len(rows)


def test_the_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{TABLES}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_pipeline(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_join", "decontamination", "pii", "packing"
    ]
    odd = docs.limit(3).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "CAST(NULL AS STRING) AS text", "lang", "source", "n_chars")
    given = docs.union(odd).selectExpr("*", "1 AS score", "2 AS leaks", "3 AS _key")
    kept = [given.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        given = corpus_pipeline.saved(stage(spark, given, TABLES))
        assert given.columns == [*docs.columns, "score", "leaks", "_key"]
        assert given.where("doc_id IS NULL").count() == 3
        kept.append(given.count())
    assert kept == sorted(kept, reverse=True) and kept[2] < kept[1] < kept[0]
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").where("toxic = 1")
    toxic = labels.join(given, "doc_id").count()
    assert toxic < 0.5 * labels.count()
    assert given.where("text RLIKE '[a-z]+[.][0-9]+@mail[0-9]'").count() == 0
    packed = corpus_pipeline.pack_sequences(spark, given, TABLES)
    assert packed.select("doc_id").distinct().count() == given.select("doc_id").distinct().count()
