"""Spelling variants against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from doclog.llm import spelling

from .helpers import frame

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def _near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = (a, b) if len(a) > len(b) else (b, a)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def _plain(rows, noise=199, letters=6, seen=5):
    counts = Counter()
    for doc, text in rows:
        for run in RUN.findall(text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= letters and n >= seen}
    form, near_of = {}, {}
    for w, n in words.items():
        near_of[w] = [v for v in words if _near(v, w)]
        if near_of[w]:
            top = min(near_of[w], key=lambda v: (-words[v], v))
            if words[top] >= 5 * n:
                form[w] = top
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near_of[w]), words.get(form.get(w))))
    return sorted(out)


def _rows(seed, n=120):
    draw = random.Random(seed)
    stems = ["".join(draw.choice("abcdeé") for _ in range(draw.choice([6, 7, 8, 9]))) for _ in range(25)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(60):
            w = stems[min(int(draw.expovariate(0.25)), 24)]
            while draw.random() < 0.25:
                k = draw.randrange(len(w))
                w = w[:k] + draw.choice(["", draw.choice("abÀ÷"), w[k] + "b"]) + w[k + 1 :]
            words.append(w.upper() if draw.random() < 0.1 else w)
        rows.append((i, draw.choice([" ", "-", "1", "_"]).join(words)))
    long = "x" * 300 + "y" * 30
    rows += [(None, "abcdef " * 40), (500, None), (501, ""), rows[0], rows[0]]
    rows += [(502, "chainsawed " * 5 + "chainsaweds " * 26 + "chainsawedss " * 140)]
    rows += [(600, f"{long} {long}z {long[1:]} " * 6 + f"{long} " * 50)]
    return rows


@pytest.mark.parametrize(("seed", "shard", "leaf"), [(1, 8192, 2048), (2, 10, 8), (3, 3, 1), (4, 25, 10**6)])
def test_against_brute_force(spark, monkeypatch, seed, shard, leaf):
    monkeypatch.setattr(spelling, "SHARD_WORDS", shard)
    monkeypatch.setattr(spelling, "LEAF_PAIRS", leaf)
    rows = _rows(seed)
    docs = frame(spark, rows)
    wanted = _plain(rows)
    assert sum(r[4] for r in wanted) > 50 and any(r[1] and r[2] != r[1] for r in wanted)
    found = spelling.spelling_forms(spelling.count_words(docs)).collect()
    assert sorted(tuple(r) for r in found) == wanted


def test_leaves_of_equal_counts(spark, monkeypatch):
    # one group: all words of a length share a leaf, which is searched by words without a letter
    monkeypatch.setattr(spelling, "LEAF_PAIRS", 1)
    rows = _rows(5, 60)
    found = spelling.spelling_forms(spelling.count_words(frame(spark, rows)), groups=1).collect()
    assert sorted(tuple(r) for r in found) == _plain(rows)


def test_no_words(spark):
    docs = spark.createDataFrame([(1, None), (2, "a b c")], "doc_id long, text string")
    for some in (docs, docs.limit(0)):
        assert spelling.spelling_forms(spelling.count_words(some)).collect() == []


def test_extra_columns(spark):
    rows = [(i, "wordsmith wordsmyth") for i in range(9)]
    docs = frame(spark, rows).selectExpr("*", "1 AS word", "2 AS n", "'x' AS run", "3 AS name")
    found = spelling.spelling_forms(spelling.count_words(docs)).collect()
    assert sorted(tuple(r) for r in found) == _plain(rows)
