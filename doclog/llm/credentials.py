"""Secrets in texts, with weak candidates linked by what stands near them.

Three rules (assign, access, hex) give the base spans: a pattern each and a least
length. Besides them, texts have parts of credentials that are too common to be
reported alone: identifiers (a user, a client id, a short access key), weak secrets
(a short password, a bare token of mixed letters and digits) and endpoints (an
address with a scheme or a port, a named host). A weak part is reported only where
its complement stands in the same scope, a paragraph, and no more than ``REACH``
characters away:

* an identifier: with a secret, weak or base;
* a weak secret: with an identifier, a base access key, or an endpoint;
* an endpoint: with an identifier and with a secret.

The complements are found by an interval join: the parts of a chunk of texts are
put on one axis, scope after scope, sorted by start with the running maximum of
their ends, and each weak part is widened by the reach and looked up by bisection.
No pair of parts is made. All parts of a text are in its row, so nothing is
shuffled, and copies of a text are as many rows.

Cases: null and empty texts have no spans; long texts are searched whole; a weak
span that touches a base span is not added, and of weak spans that overlap the
first stays (of equal starts the longest, then the first kind); equal rows and
equal ids are separate; an empty table gives no rows.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import table

KINDS = ("assign", "access", "hex", "identifier", "secret", "endpoint")
ASSIGN, ACCESS, HEX, IDENTIFIER, SECRET, ENDPOINT = range(6)
REACH = 200

# The rules' patterns and least lengths.
_ASSIGN = re.compile(
    r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
_ACCESS = re.compile("AKIA[A-Z0-9]+")
_HEX = re.compile("(?<![0-9a-f])[0-9a-f]{16,}")
LEAST_ASSIGN, LEAST_ACCESS = 12, 18

# Parts of credentials that mean little alone.
_GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
_WEAK_IDENTIFIER = re.compile(
    r"(?<![A-Za-z0-9])(?:"
    rf"(?ai:user(?:_?name|_?id)?|login|account(?:_?id)?|client_?id|(?:access_?)?key_?id|uid){_GIVEN}"
    r"[A-Za-z0-9@._+-]{3,}|(?:AKIA|ASIA|AROA|AIDA)[A-Z0-9]{8,})"
)
_WEAK_SECRET = re.compile(
    r"(?<![A-Za-z0-9])"
    rf"(?ai:password|passwd|passphrase|pass|pwd|pin|secret(?:_?key)?|token|api_?key|private_?key|auth){_GIVEN}"
    r"""[^\s"',;]{4,}"""
)
_BARE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}")
_ENDPOINT = re.compile(
    r"(?<![A-Za-z0-9.-])(?:"
    rf"(?ai:host(?:_?name)?|server|endpoint|database|dsn){_GIVEN}[A-Za-z0-9._:/-]{{3,}}"
    r"""|[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s"'<>]+"""
    r"|[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++:[0-9]{2,5}(?![0-9]))"
)
# An address with a user and a password in it has all three parts.
_SIGNED = re.compile(r"""://([^\s"'<>/:@]+):([^\s"'<>/@]+)@([^\s"'<>/@]+)""")
_BREAK = re.compile(r"\n[ \t\r]*\n")

Part = tuple[int, int, int]


def base_spans(text: str) -> list[Part]:
    """``kind, start, end`` of the three rules."""
    found = [
        (ASSIGN, *m.span()) for m in _ASSIGN.finditer(text) if m.end(1) - m.start(1) >= LEAST_ASSIGN
    ]
    if "AKIA" in text:
        found += [
            (ACCESS, *m.span()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS
        ]
    found += [(HEX, *m.span()) for m in _HEX.finditer(text)]
    return found


def _mixed(token: str) -> bool:
    """Whether a bare token has small and capital letters and digits, not as a name would."""
    return (
        any(c.islower() for c in token)
        and any(c.isupper() for c in token)
        and sum(c.isdigit() for c in token) >= 2
        and len(set(token)) >= 12
    )


def weak_parts(text: str, secret_known: bool = True) -> list[Part]:
    """``kind, start, end`` of identifiers, weak secrets and endpoints; they may overlap.

    Every link has a secret at one end, so a text without one, weak or base
    (``secret_known``), has no parts.
    """
    given = ":" in text or "=" in text
    found = [(SECRET, *m.span()) for m in _BARE.finditer(text) if _mixed(m[0])]
    if given:
        found += [(SECRET, *m.span()) for m in _WEAK_SECRET.finditer(text)]
        for m in _SIGNED.finditer(text):
            found += [(IDENTIFIER, *m.span(1)), (SECRET, *m.span(2)), (ENDPOINT, *m.span(3))]
    if found or secret_known:
        found += [(IDENTIFIER, *m.span()) for m in _WEAK_IDENTIFIER.finditer(text)]
        if given:
            found += [(ENDPOINT, *m.span()) for m in _ENDPOINT.finditer(text)]
    return found


class Intervals:
    """Spans on one axis; tells which other spans come within reach of one of them."""

    def __init__(self, start: np.ndarray, end: np.ndarray) -> None:
        order = np.argsort(start, kind="stable")
        self.start, self.end = start[order], np.maximum.accumulate(end[order])

    def near(self, start: np.ndarray, end: np.ndarray, reach: int) -> np.ndarray:
        behind = np.searchsorted(self.start, end + reach, side="right")
        out = behind > 0
        out[out] = self.end[behind[out] - 1] >= start[out] - reach
        return out


def linked(kind: np.ndarray, scope: np.ndarray, start: np.ndarray, end: np.ndarray, reach: int) -> np.ndarray:
    """Which parts have the complements that they need; base spans need none."""
    # scopes are further apart than any reach
    stride = (int(end.max()) if len(end) else 0) + 2 * reach + 1
    lo, hi = scope * stride + start, scope * stride + end

    def has(kinds: tuple[int, ...]) -> np.ndarray:
        own = np.isin(kind, kinds)
        return Intervals(lo[own], hi[own]).near(lo, hi, reach)

    name, secret, place = has((ACCESS, IDENTIFIER)), has((ASSIGN, HEX, SECRET)), has((ENDPOINT,))
    return np.select(
        [kind == IDENTIFIER, kind == SECRET, kind == ENDPOINT], [secret, name | place, name & secret], True
    )


def _kept(parts: list[Part]) -> list[tuple[int, int, int, bool]]:
    """Base spans, and the weak ones that touch none of them nor an earlier weak one."""
    base = sorted((start, end) for kind, start, end in parts if kind <= HEX)
    starts = [s for s, _ in base]
    furthest, reach = [], -1
    for _, end in base:
        reach = max(reach, end)
        furthest.append(reach)
    out = [(kind, start, end, True) for kind, start, end in parts if kind <= HEX]
    last = -1
    for start, less, kind in sorted((s, -e, k) for k, s, e in parts if k > HEX):
        before = bisect_right(starts, -less - 1)
        if start >= last and not (before and furthest[before - 1] > start):
            out.append((kind, start, -less, False))
            last = -less
    return sorted(out, key=lambda x: (x[1], x[0]))


def find_credentials(docs: DataFrame, text: str = "text", reach: int = REACH, name: str = "spans") -> DataFrame:
    """Add ``name``: an array of ``kind, start, end, base`` by start and kind, in code points."""
    kind = "array<struct<kind:int,start:bigint,end:bigint,base:boolean>>"
    schema = docs.select("*", F.lit(None).cast(kind).alias(name)).schema
    position = docs.columns.index(text)
    span_type = pa.list_(
        pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())])
    )

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts: list[list[Part]] = []
            flat: list[tuple[int, int, int, int]] = []  # scope, kind, start, end
            scope = 0
            for value in batch.column(position):
                words = value.as_py() or ""
                own = base_spans(words)
                weak = weak_parts(words, any(kind != ACCESS for kind, _, _ in own))
                if weak:
                    own += weak
                    breaks = [m.start() for m in _BREAK.finditer(words)]
                    flat += [(scope + bisect_right(breaks, s), k, s, e) for k, s, e in own]
                    scope += len(breaks) + 1
                parts.append(own)
            rows = [[dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in _kept(p)]
                    for p in _complete(parts, flat, reach)]
            spans = pa.array(rows, span_type)
            yield pa.RecordBatch.from_arrays([*batch.columns, spans], names=schema.names)

    return docs.mapInArrow(find, schema)


def _complete(
    parts: list[list[Part]], flat: list[tuple[int, int, int, int]], reach: int
) -> Iterator[list[Part]]:
    """The parts of each row without weak ones that lack their complement.

    ``flat`` lists the parts of the rows that have weak ones, in order, with scopes.
    """
    scope, kind, start, end = np.array(flat, np.int64).reshape(-1, 4).T
    keeps = iter(linked(kind, scope, start, end, reach).tolist())
    for own in parts:
        if any(k > HEX for k, _, _ in own):
            own = [part for part in own if next(keeps)]
        yield own


def _line(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


@query("op12_credentials")
def op12_credentials(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = find_credentials(docs)
    base = F.filter("spans", lambda s: s["base"])

    def n(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    return found.select(
        "doc_id",
        *[n(kind).alias(f"n_{KINDS[kind]}") for kind in (ASSIGN, ACCESS, HEX)],
        F.sha2(_line(base), 256).alias("base_sha256"),
        _line(F.col("spans")).alias("spans"),
    )
