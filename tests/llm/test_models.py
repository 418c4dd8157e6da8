"""Toxicity, language, fingerprints and language-model scores."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from doclog.llm import fingerprint, language, lm, toxicity
from doclog.llm.registry import QUERIES
from doclog.llm.shared import NOT_BLANK, Words, gram_hashes, table
from doclog.llm.shared import texts as bytes_of

from .helpers import BLANK_WORD, frame, lower, texts

TABLES = "/root/testdata/sf0.01"


def _held_out(doc_id: int, folds: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % folds


def test_words_and_runs():
    rows = ["The cat  sat", None, "", " a", "é b", "one two three four five", "x" * 100]
    data, offsets = bytes_of(pa.array(rows))
    words = Words(data, offsets, NOT_BLANK, lower=True)
    listed = [words.text(i) for i in range(len(words))]
    assert listed == [w for t in rows for w in BLANK_WORD.findall(lower(t))]
    grams, first = gram_hashes(words, words.hashes(), 4)
    assert words.row[first].tolist() == [0, 3, 4, 5, 5, 6]
    assert len(set(grams.tolist())) == 6


def test_toxicity_on_held_out_rows(spark):
    found = QUERIES["op1_toxicity"](spark, TABLES)
    labels = table(spark, TABLES, "labels").select("doc_id", "toxic")
    rows = found.join(labels, "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.85
    for r in found.collect():
        assert 0 <= r.score <= 1
        assert r.held_out == (_held_out(r.doc_id, 5) == 0)


def test_toxicity_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "fine words"), (4, "vile words"), (5, "vile " * 50000)]
    docs = frame(spark, rows).selectExpr("*", "7 AS _text", "'s' AS score")
    no_labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, no_labels)
    scored = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert all(s < 1e-6 for s in scored.values())
    many = [(i, f"vile w{i % 7}" if i % 3 else f"kind w{i % 7}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i, _ in many] + [(0, None)], "doc_id long, toxic int")
    model = toxicity.train_toxicity(frame(spark, many), labels)
    scored = {r.doc_id: r.score for r in toxicity.score_toxicity(docs, model).collect()}
    assert scored[4] > 0.5 and scored[5] > 0.5
    assert scored[1] == scored[2] and scored[3] < 0.7


def test_interactions_are_learnt():
    draw = np.random.default_rng(0)
    x = draw.integers(0, 2, (4000, 6))
    labels = (x[:, 0] & x[:, 1]).astype(float)
    rows = [np.flatnonzero(r) + 10 for r in x]
    model = toxicity.FactorizationMachine.fit(rows, labels, epochs=40)
    index = model.slots[np.concatenate(rows)]
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    z, _ = model._sums(model.bias, model.w, model.v, row[index >= 0], index[index >= 0], len(rows))
    assert ((z > 0) == (labels > 0)).mean() > 0.99


def _machine_scores(model, rows):
    """Scores by a loop over all pairs of terms."""
    out = []
    for row in rows:
        f = [i for i in model.slots[row] if i >= 0]
        z = model.bias + sum(float(model.w[i]) for i in f)
        z += sum(float(model.v[i] @ model.v[j]) for k, i in enumerate(f) for j in f[:k])
        out.append(1 / (1 + math.exp(-max(-30, min(30, z)))))
    return np.array(out)


def test_pairs_of_plain_terms_are_learnt():
    # each of two words is as common in both classes; only the pair tells them apart
    draw = np.random.default_rng(1)
    a, b = draw.integers(0, 2, (2, 8000))
    labels = (a == b).astype(float)
    rows = [np.unique([10 + i, 20 + j, *(100 + draw.integers(0, 400, 12))]) for i, j in zip(a, b, strict=True)]
    model = toxicity.FactorizationMachine.fit(rows[:6000], labels[:6000])
    assert ((_machine_scores(model, rows[6000:]) > 0.5) == labels[6000:]).mean() > 0.95


def test_toxicity_scores_are_those_of_all_pairs():
    held = ["kind words", "vile words here", "", "Vile vile people, kind place", "w1 w2 w3 vile"] * 40
    data, offsets = bytes_of(pa.array(held))
    words = Words(data, offsets, toxicity.ALNUM, lower=True)
    row, bucket = toxicity.term_buckets(words)
    rows = [np.unique(bucket[row == i]) for i in range(len(held))]
    model = toxicity.FactorizationMachine.fit(rows, np.array([float("vile" in t.lower()) for t in held]))
    assert np.allclose(model.scores(words), _machine_scores(model, rows), atol=1e-6)


def test_language_on_held_out_rows(spark):
    found = QUERIES["op8_language_id"](spark, TABLES)
    truth = table(spark, TABLES, "documents").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").where("held_out AND lang IS NOT NULL").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_code_lengths_are_those_of_the_trees():
    counts = {}
    for name, text in (("aa", "the then there " * 4), ("bb", "der die das dem " * 4)):
        data, offsets = bytes_of(pa.array([text]))
        grams, n = np.unique(language._windows(data, offsets), return_counts=True)
        counts[name] = (grams.astype(np.uint64), n.astype(float))
    trees = language.ContextTrees(counts)

    def bits(name: str, text: str) -> float:
        seen = [Counter() for _ in range(4)]
        for g, n in zip(*counts[name], strict=True):
            raw = int(g).to_bytes(4, "big")
            for order in range(4):
                seen[order][raw[3 - order :]] += n
        total = 0.0
        padded = b"\0\0\0" + text.lower().encode()
        for i in range(3, len(padded)):
            for order in (3, 2, 1, 0, -1):
                if order < 0:
                    total += 8
                    break
                context = padded[i - order : i]
                after = {k: v for k, v in seen[order].items() if k[:-1] == context}
                n, d = sum(after.values()), len(after)
                own = after.get(padded[i - order : i + 1], 0)
                if own:
                    total -= math.log2(own / (n + d))
                    break
                if n:
                    total -= math.log2(d / (n + d))
        return total

    rows = ["the dem", "Xyz der", "é", "the " * 30]
    data, offsets = bytes_of(pa.array(rows))
    found = trees.code_lengths(data, offsets)
    wanted = [[bits(name, t) for name in trees.languages] for t in rows]
    assert np.allclose(found, wanted, rtol=1e-4)


def test_language_of_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "der die das"), (5, "the " * 60000)]
    docs = frame(spark, rows).selectExpr("*", "'k' AS lang", "1 AS score")
    training = spark.createDataFrame(
        [("the then there " * 9, "en"), ("der die das dem " * 9, "de"), ("x", None)], "text string, lang string"
    )
    model = language.train_language_model(training)
    found = {r.doc_id: r for r in language.identify_language(docs, model).collect()}
    assert [found[i].lang_pred for i in range(1, 6)] == ["und", "und", "und", "de", "en"]
    assert [found[i].score for i in (1, 2, 3)] == [0, 0, 0]
    none = language.train_language_model(training.where("lang IS NULL"))
    assert {r.lang_pred for r in language.identify_language(docs, none).collect()} == {"und"}


def test_fingerprints(spark, tmp_path):
    rows = [r for r in texts(5, 60) if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in QUERIES["op3_fingerprints"](spark, str(tmp_path)).collect()}
    order = sorted(rows, reverse=True)
    assert len(found) == len(rows)
    prints = {}
    for k, (doc, text) in enumerate(order):
        text, following = text or "", order[(k + 1) % len(order)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        r = found[doc]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert prints.setdefault(edited, r.edited_fingerprint) == r.edited_fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if edited == text:
            assert r.near_edited == 1


def test_likeness_is_close_to_jaccard():
    words = [f"v{i}" for i in range(1000)]
    a = " ".join(words)
    for share in (0.2, 0.5, 0.9):
        k = int(1000 * share)
        b = " ".join(words[:k] + [f"u{i}" for i in range(1000 - k)])
        prints = fingerprint.fingerprints(pa.array([a, b]))
        common = k - 4
        wanted = common / (2 * 996 - common)
        assert abs(fingerprint.likeness(prints[:1], prints[1:])[0] - wanted) < 0.1


@pytest.mark.parametrize("rows", [[], [(5, "one")], [(1, None), (None, "a b"), (1, None), (1, "c")]])
def test_fingerprints_of_few_rows(spark, tmp_path, rows):
    frame(spark, rows, 1).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op3_fingerprints"](spark, str(tmp_path)).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in rows)


@pytest.mark.parametrize("sent_words", [1 << 19, 40])
def test_base_scores(spark, monkeypatch, tmp_path, sent_words):
    monkeypatch.setattr(lm, "SENT_WORDS", sent_words)
    rows = [r for r in texts(6, 60) if r[0] is not None]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = QUERIES["op10_lm_scoring"](spark, str(tmp_path)).collect()
    tokens = [(d, [*BLANK_WORD.findall(lower(t)), None]) for d, t in rows]
    counts: Counter = Counter()
    for d, own in tokens:
        if _held_out(d, 7) != 2:
            counts.update(own)
    total, kinds = sum(counts.values()), len(counts)
    wanted = []
    for d, own in tokens:
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in own)
        known = sum(counts[w] > 0 for w in own)
        wanted.append((d, _held_out(d, 7) == 2, len(own), known, total, round(base, 5)))
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found]
    assert sorted(got) == sorted(wanted)
    assert all(r.score < 0 for r in found)


def test_model_is_normalised_and_helps():
    draw = np.random.default_rng(1)
    token = np.tile([2, 3, 4, 5], 4000)
    one, two = np.roll(token, 1), np.roll(token, 2)
    share = np.bincount(token, minlength=6) + 1.0
    model = lm.LogBilinear(share / share.sum())
    state: dict = {}
    for _ in range(3):
        model.fit(token, one, two, state, draw)
    model.freeze()
    every = np.arange(6)
    for a, b in ((2, 5), (1, 1), (4, 3)):
        p = 10 ** model.log10(every, np.full(6, a), np.full(6, b))
        assert abs(p.sum() - 1) < 1e-4
    assert model.log10(token, one, two).mean() > np.log10(share / share.sum())[token].mean() + 0.3


@pytest.mark.parametrize("own_words", [1 << 15, 8])
def test_every_word_has_vectors(spark, monkeypatch, own_words):
    # beyond the most frequent words, entries are shared by hash
    monkeypatch.setattr(lm, "OWN_WORDS", own_words)
    draw = np.random.default_rng(4)
    pairs = [(f"a{i}", f"b{i}") for i in range(1000)]
    order = np.concatenate([draw.permutation(1000) for _ in range(50)])
    lines = [" ".join(w for i in part for w in pairs[i]) for part in np.split(order, 500)]
    training = frame(spark, list(enumerate(lines)), 1)
    docs = [(i, " ".join(pairs[i])) for i in range(1000)]
    docs += [(1000 + i, f"a{i} b{(i + 1) % 1000}") for i in range(1000)]
    score = {r.doc_id: r.score for r in lm.score_texts(frame(spark, docs), training).collect()}
    better = [score[i] > score[1000 + i] + 0.1 for i in range(1000)]
    assert np.mean(better) > 0.9


def test_two_levels_are_normalised():
    draw = np.random.default_rng(2)
    share = np.sort(1 / np.arange(1, 3001))[::-1]
    share /= share.sum()
    model = lm.LogBilinear(share)
    assert len(model.size) < 500 and model.size.sum() == 3000 and (model.size > 1).any()
    token = np.minimum(np.searchsorted(np.cumsum(share), draw.random(20000)), 2999)
    model.fit(token, np.roll(token, 1), np.roll(token, 2), {}, draw)
    model.freeze()
    for a, b in ((2, 2990), (700, 1), (1500, 1501)):
        p = 10 ** model.log10(np.arange(3000), np.full(3000, a), np.full(3000, b))
        assert abs(p.sum() - 1) < 1e-4


def test_log_probabilities_against_a_plain_loop():
    draw = np.random.default_rng(3)
    share = 1 / np.arange(1, 401)
    model = lm.LogBilinear(share / share.sum())
    token = np.minimum(draw.pareto(1, 9000).astype(int), 399)
    model.fit(token, np.roll(token, 1), np.roll(token, 2), {}, draw)
    names = ("context", "near", "far", "target", "bias", "own_target", "own_bias", "of")
    context, near, far, target, bias, own_target, own_bias, of = (getattr(model, x).copy() for x in names)
    model.freeze()
    token, one, two = draw.integers(0, 400, (3, 60))
    for w, a, b, found in zip(token, one, two, model.log10(token, one, two), strict=True):
        h = context[a] @ near + context[b] @ far
        by_class = [math.exp(h @ t + x) for t, x in zip(target, bias, strict=True)]
        inner = {v: math.exp(h @ own_target[v] + own_bias[v]) for v in range(400) if of[v] == of[w]}
        p = by_class[of[w]] / sum(by_class) * inner[w] / sum(inner.values())
        assert abs(found - math.log10(p)) < 1e-3


def test_counts_of_shared_entries(spark):
    names = np.arange(1, 100, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    often = np.arange(99, 0, -1)
    rest = [(int(h), int(h) % 5 + 1) for h in (names[:40] + np.uint64(3)).view(np.int64)]
    total, kinds = lm._entry_counts(10, names, often, spark.createDataFrame(rest, "h long, c long"))
    wanted: Counter = Counter()
    number: Counter = Counter()
    for h, c in [*zip(names[10:].tolist(), often[10:].tolist(), strict=True), *rest]:
        wanted[h % lm.SHARED] += c
        number[h % lm.SHARED] += 1
    assert dict(wanted) == {e: n for e, n in enumerate(total.tolist()) if n}
    assert dict(number) == {e: n for e, n in enumerate(kinds.tolist()) if n}


def test_scores_without_training_rows(spark):
    docs = frame(spark, [(1, "a b"), (2, None)]).selectExpr("*", "3 AS score")
    found = lm.score_texts(docs, docs.where("false"))
    assert found.columns == ["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    assert {(r.doc_id, r.n_tokens, r.n_known, r.base_score) for r in found.collect()} == {
        (1, 3, 0, 0.0), (2, 1, 0, 0.0)
    }
