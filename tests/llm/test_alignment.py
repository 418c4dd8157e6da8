"""Alignment of two tokenizers against a plain loop over tokens."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from doclog.llm import alignment

from .helpers import frame, texts


def _plain(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    a_bytes = alignment.byte_level_entries(public_tokenizers.path("byte_bpe_50k.json"))

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    found, pairs = [], Counter()
    for doc, text in rows:
        raw = (" " + text).encode() if text else b""
        a = first.encode(" " + text, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if b"".join(a_bytes[i] for i in a) != raw or b"".join(piece(i) for i in b) != raw:
            a, b = [], []
        a_end, b_end, at = {}, {}, 0
        for k, i in enumerate(a):
            at += len(a_bytes[i])
            a_end[at] = k
        at = 0
        for k, i in enumerate(b):
            at += len(piece(i))
            b_end[at] = k
        groups, links, i, j = [], [], 0, 0
        for end in sorted(a_end.keys() & b_end.keys()):
            groups.append((a[i : a_end[end] + 1], b[j : b_end[end] + 1]))
            i, j = a_end[end] + 1, b_end[end] + 1
            links.append((a[i - 1], b[j - 1]))
        pairs.update(links)
        found.append((doc, a, b, groups, links))
    most = Counter()
    for (_, b), n in pairs.items():
        most[b] = max(most[b], n)
    out = []
    for doc, a, b, groups, links in found:
        line = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append(
            (
                doc, len(a), len(b), len(groups), len(links),
                sum(pairs[x] == most[x[1]] for x in links), sum(pairs[x] for x in links),
                hashlib.sha256(line.encode()).hexdigest() if line else "",
            )
        )
    return out


ODD = [
    "<|endoftext|> and <s>", "a▁b", "tab\tand  two\r\n\n", "日本語 \U0001f600 क्ष", "\x00nul", " ", "\n",
    "<0x0A> text", "café naïve   x", "A" * 3000, "é ​ ﻿", "1234567890 " * 50, " �",
]


@pytest.mark.parametrize(("sent", "bucket", "fan"), [(1 << 21, 1 << 16, 32), (40, 50, 2), (0, 7, 3)])
def test_against_plain_loop(spark, monkeypatch, sent, bucket, fan):
    monkeypatch.setattr(alignment, "MAX_SENT", sent)
    monkeypatch.setattr(alignment, "BUCKET_PAIRS", bucket)
    monkeypatch.setattr(alignment, "FAN_IN", fan)
    monkeypatch.setattr(alignment, "HELD_PAIRS", 60 if fan == 2 else 1 << 20)
    monkeypatch.setattr(alignment, "CHUNK_BYTES", 500)
    rows = texts(3, 40) + [(1000 + i, t) for i, t in enumerate(ODD)]
    found = alignment.align(frame(spark, rows, parts=7), alignment.public_files())
    assert found.columns[:4] == ["doc_id", "n_a", "n_b", "n_groups"]
    key = lambda r: tuple((x is not None, x or 0) if i == 0 else x for i, x in enumerate(r))
    wanted = sorted(_plain(rows), key=key)
    assert sum(r[1] == 0 for r in wanted) >= 3 and sum(0 < r[5] < r[4] for r in wanted) > 5
    assert sorted((tuple(r) for r in found.collect()), key=key) == wanted


def test_no_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    found = alignment.align(docs, alignment.public_files()).collect()
    assert sorted(tuple(r) for r in found) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    assert alignment.align(docs.limit(0), alignment.public_files()).collect() == []


def test_perfect_hash():
    draw = random.Random(1)
    keys = np.array(sorted({draw.randrange(2**40) for _ in range(20000)}), np.int64)
    made = alignment.PairTable(keys, keys * 3)
    place = made.find(keys)
    assert sorted(place.tolist()) == list(range(len(keys)))
    assert (made.counts[place] == keys * 3).all()
    others = np.setdiff1d(np.arange(5000), keys)
    assert (made.find(others) == -1).all()
    bits = sum(w.nbytes for w in made.hash.words) * 8
    assert bits / len(keys) < 5
    assert alignment.PairTable(keys[:0]).find(keys[:3]).tolist() == [-1] * 3
