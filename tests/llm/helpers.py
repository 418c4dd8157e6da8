"""Small tables, and the rules of the operators written out plainly."""

from __future__ import annotations

import random
import re

BLANK_WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text: str | None) -> str:
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def texts(seed: int, n: int, words: int = 200) -> list[tuple[int | None, str | None]]:
    """Documents with passages in common, near and exact copies, and odd cases."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)] + ["ééé", "x" * 40]
    pick = lambda k: [draw.choice(vocabulary) for _ in range(k)]
    passages = [pick(draw.choice([15, 20, 25, 60])) for _ in range(8)]
    rows: list[tuple[int | None, str | None]] = []
    for i in range(n):
        kind = draw.random()
        if rows and kind < 0.3:
            own = BLANK_WORD.findall(rows[draw.randrange(len(rows))][1])
            for _ in range(draw.choice([0, 1, 2, 4])):
                if own:
                    own[draw.randrange(len(own))] = draw.choice(vocabulary)
        else:
            own = []
            for _ in range(draw.choice([0, 1, 2, 3])):
                own += draw.choice(passages) if draw.random() < 0.5 else pick(draw.choice([1, 8, 30]))
        if draw.random() < 0.05:
            own = ["a"] * draw.choice([5, 19, 20, 45])
        gaps = [draw.choice([" ", " ", "\n", "  ", "\t"]) for _ in own]
        text = "".join(w + g for w, g in zip(own, gaps, strict=True))
        rows.append((i * 7 % n, text.upper() if draw.random() < 0.1 else text))
    rows += [(900, None), (901, ""), (902, " \n"), (None, rows[3][1]), (3, rows[5][1])]
    rows += [rows[0], (903, " ".join(pick(6000)))]
    return rows


def frame(spark, rows, parts: int = 3):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
