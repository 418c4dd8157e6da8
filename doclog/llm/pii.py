"""Personal data by candidate generation and boosted trees, in native expressions.

Four rules (email, ip, card, phone) give the base spans: a pattern each and a
test of what it matched. Four wide generators give candidates as well, which may
overlap. Boosted trees learn, by format and context, which candidates are the same
data written otherwise: a phone number without its plus sign, an address with
``[at]``, a card with dots, an ip with ``[.]``. What they learn from is made of the
table itself: base spans written in such ways are positives; base spans spoilt
(a wrong check digit, a part above 255, no domain), base spans of another kind and
candidates that fail in the same ways are negatives. They are fitted on the texts of
one half by hash; on those of the other the least share is found down to which enough
of the examples are positives. Candidates that reach it are added where they touch
no base span; of added spans that overlap the first stays.

Patterns are written so that the regular-expression engine neither recurses nor
starts anew at each character of a long run. Matches are numbered, and positions
are running sums of the lengths of gaps and matches; that, and everything per
span, runs on small rows, once per distinct text.

Cases: null and empty texts have no spans; equal texts have equal spans; long
texts are searched whole; of a kind without base spans in either half, or if no
threshold reaches the wanted precision, nothing is added.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .registry import query
from .shared import saved, table

KINDS = ("email", "ip", "card", "phone")
# The rules' patterns, in forms that match alike in linear time.
_LOCAL = "A-Za-z0-9._%+-"
_EMAIL = (
    rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@(?=[A-Za-z0-9-]++\.[A-Za-z0-9-])"
    r"[A-Za-z0-9-](?:[A-Za-z0-9.-](?<!\.\.))*(?<!\.)"
)
_IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
_CARD = r"[0-9](?:[0-9\x20-](?<![\x20-][\x20-]))+(?<=[0-9])"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# The generators: other separators, other or no marks.
_OPEN = r"\x00-\x20@<>,;:\x22\x27()\[\]"
_WIDE = {
    "email": (
        rf"(?:\G|(?<![^{_OPEN}]))[^{_OPEN}]++(?:@|\x20?[\[(](?:at|AT)[\])]\x20?)[^{_OPEN}]++"
        rf"(?:\x20?[\[(](?:dot|DOT)[\])]\x20?[^{_OPEN}]++){{0,3}}+"
    ),
    "ip": r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\]|,)[0-9]{1,3}){3}(?![0-9])",
    "card": r"[0-9](?:[0-9\x20./_-](?<![\x20./_-][\x20./_-]))+(?<=[0-9])",
    "phone": r"[+(0-9][\x20()./0-9-]*[0-9]",
}
_BASE = {"email": _EMAIL, "ip": _IP, "card": _CARD, "phone": _PHONE}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"
_IP_SHAPE = r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"
_CUES = "(?i)(mail|contact|write|phone|tel|call|mobile|fax|card|visa|credit|account|host|server|addr|ip)"

FEATURES = ("kind", "digits", "size", "groups", "before", "after", "cue", "dots", "fits", "form")
ROUNDS, DEPTH, RATE = 20, 4, 0.3
PRECISION = 0.95


def _matches(text: str, kind: int, wide: bool, pattern: str, gate: Column) -> Column:
    """Matches of a pattern with the length of the gap before each and what is around."""
    # zipped first: what stands inside a lambda is computed anew for each element
    zipped = F.expr(
        f"arrays_zip(regexp_extract_all({text}, r'{pattern}', 0), split({text}, r'{pattern}', -1), "
        f"slice(split({text}, r'{pattern}', -1), 2, 2147483647))"
    )
    rows = F.transform(
        F.filter(zipped, lambda x: x["0"].isNotNull()),
        lambda x, i: F.struct(
            F.lit(kind).alias("kind"),
            F.lit(wide).alias("wide"),
            i.alias("i"),
            F.length(x["1"]).alias("gap"),
            x["0"].alias("m"),
            F.right(x["1"], F.lit(24)).alias("left"),
            F.left(x["2"], F.lit(1)).alias("right"),
        ),
    )
    return F.when(gate, rows).otherwise(F.array().cast(
        "array<struct<kind:int,wide:boolean,i:int,gap:int,m:string,left:string,right:string>>"
    ))


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        doubled = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, doubled).otherwise(d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), add) % 10 == 0


def _passes(kind: Column, m: Column) -> Column:
    """Whether a match passes its kind's rule, also as a whole match of it."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    return (
        F.when(kind == 0, m.rlike(rf"^(?:{_EMAIL})$"))
        .when(kind == 1, m.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == 2, F.when(n.between(14, 19) & m.rlike(r"^[0-9\x20-]+$"), _luhn(digits)).otherwise(False))
        .otherwise(n.between(10, 15) & m.rlike(rf"^(?:{_PHONE})$"))
    )


def _spans(docs: DataFrame, text: str) -> DataFrame:
    """All matches of each distinct text: ``key, kind, wide, start, end, m, left, right, ok``."""
    t = F.col(text)
    at, digit = t.contains("@") | t.rlike(r"[\[(](at|AT)[\])]"), t.rlike("[0-9]")
    quoted = "`" + text.replace("`", "``") + "`"
    found = [
        _matches(quoted, k, wide, patterns[kind], at if kind == "email" else digit)
        for k, kind in enumerate(KINDS)
        for wide, patterns in ((False, _BASE), (True, _WIDE))
    ]
    rows = docs.where(at | digit).select(
        F.xxhash64(t).alias("key"), F.inline(F.flatten(F.array(*found)))
    )
    # copies of a text give the same rows: one of each goes on, dropped before the shuffle
    order = W.partitionBy("key", "kind", "wide").orderBy("i")
    gaps = F.sum("gap").over(order.rowsBetween(W.unboundedPreceding, 0))
    past = F.coalesce(F.sum(F.length("m")).over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    rows = rows.dropDuplicates(["key", "kind", "wide", "i"]).withColumn("start", gaps + past)
    rows = rows.withColumn("end", F.col("start") + F.length("m"))
    n = F.length(F.regexp_replace("m", "[^0-9]", ""))
    likely = (
        F.when(F.col("kind") == 2, n.between(13, 19))
        .when(F.col("kind") == 3, n.between(7, 15))
        .otherwise(True)
    )
    rows = rows.where(~F.col("wide") | likely)
    return rows.select(
        "key", "kind", "wide", "start", "end", "m", "left", "right",
        _passes(F.col("kind"), F.col("m")).alias("ok"),
    ).where("wide OR ok")


def _features() -> dict[str, Column]:
    m = F.col("m")

    def side(c: Column) -> Column:
        return (
            F.when(c == "", 0).when(c.rlike(r"\s"), 1).when(c.rlike(r"[\p{L}0-9]"), 2).otherwise(3)
        )

    return {
        "digits": F.least(F.length(F.regexp_replace(m, "[^0-9]", "")), F.lit(20)),
        "size": F.least(F.length(m), F.lit(60)).cast("int"),
        "groups": F.least(F.size(F.split(m, "[^0-9]+", -1)), F.lit(10)),
        "before": side(F.right("left", F.lit(1))),
        "after": side(F.col("right")),
        "cue": F.col("left").rlike(_CUES).cast("int"),
        "dots": F.least(F.length(m) - F.length(F.replace(m, F.lit("."), F.lit(""))), F.lit(6)),
        "fits": _fits(F.col("kind"), m).cast("int"),
        "form": (
            F.when(m.rlike("^[0-9]+$"), 0)
            .when(m.rlike(_IP_SHAPE), 1)
            .when(m.contains(","), 2)
            .when(m.rlike(r"[/_]"), 3)
            .otherwise(4)
        ),
    }


def _fits(kind: Column, m: Column) -> Column:
    """Whether a candidate fits its kind, however it is written."""
    digits = F.regexp_replace(m, "[^0-9]", "")
    n = F.length(digits)
    dotted = F.regexp_replace(m, r"\[\.\]|,", ".")
    return (
        F.when(kind == 0, m.rlike(r"(?:\.|[\[(](?:dot|DOT)[\])]\x20?)[A-Za-z]{2,}$"))
        .when(kind == 1, dotted.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$"))
        .when(kind == 2, F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
        .otherwise(n.between(10, 15))
    )


def _examples(candidates: DataFrame) -> DataFrame:
    """Candidates and rewritten base spans with a ``label``; ``plain``: as the rules have them.

    Candidates that may be data written otherwise have no label and are left out.
    """
    kind, m = F.col("kind"), F.col("m")
    digits = F.regexp_replace(m, "[^0-9]", "")
    bare = F.replace(m, F.lit("+"), F.lit(""))
    last = (F.right(digits, F.lit(1)).cast("int") + 1) % 10
    spoilt = F.concat(F.left(digits, F.length(digits) - 1), last.cast("string"))

    def example(of: int, text: Column, label: int, left: Column | None = None) -> Column:
        left = F.col("left") if left is None else left
        return F.struct(F.lit(of).alias("kind"), text.alias("m"), left.alias("left"), F.lit(label).alias("label"))

    def put(text: Column, old: str, new: str) -> Column:
        return F.replace(text, F.lit(old), F.lit(new))

    def fours(text: Column, mark: str) -> Column:
        return F.regexp_replace(text, "([0-9]{4})(?=[0-9])", f"$1{mark}")

    email = [
        *[example(0, put(m, "@", mark), 1) for mark in ("[at]", "(at)", " [at] ", " (at) ")],
        *[
            example(0, F.regexp_replace(put(m, "@", mark), r"\.([A-Za-z]+)$", f"{dot}$1"), 1)
            for mark, dot in ((" [at] ", " [dot] "), ("(at)", "(dot)"))
        ],
        *[example(0, F.regexp_replace(m, "@([A-Za-z0-9-]+).*$", f"{mark}$1"), 0) for mark in ("@", " (at) ")],
    ]
    wrong = F.regexp_replace(m, "[0-9]+$", "999")
    ip = [
        example(1, put(m, ".", "[.]"), 1), example(1, put(m, ".", ","), 0),
        example(1, wrong, 0), example(1, put(wrong, ".", "[.]"), 0), example(3, m, 0),
    ]
    card = [
        example(2, fours(number, mark), label)
        for number, label in ((digits, 1), (spoilt, 0)) for mark in (".", "/", "_")
    ]
    card += [example(2, spoilt, 0), example(3, digits, 0)]
    phone = [
        example(3, bare, 1), example(3, F.concat(F.lit("00"), bare), 1),
        *[example(3, F.regexp_replace(bare, r"[\x20().-]+", mark), 1) for mark in (".", "/", "-", " ")],
        # a run of digits is a number of some kind, unless a word says that it is a phone's
        example(3, digits, 1, F.lit("tel ")), example(3, digits, 0, F.lit("n ")),
        example(3, F.left(bare, F.lit(9)), 0),
    ]
    made = F.when(kind == 0, F.array(*email)).when(kind == 1, F.array(*ip))
    made = made.when(kind == 2, F.array(*card)).otherwise(F.array(*phone))
    n = F.length(digits)
    written = (
        F.when(kind == 0, True)
        .when(kind == 1, m.rlike(r"\[\.\]|,"))
        .when(kind == 2, _fits(kind, m))
        .otherwise(n.between(10, 15) & ~m.rlike(_IP_SHAPE) & ~(F.when(n >= 14, _luhn(digits)).otherwise(False)))
    )
    half = F.pmod("key", F.lit(2)).alias("half")
    given = candidates.where(F.col("ok") | ~written).select(
        "kind", "m", "left", "right", half, F.col("ok").cast("int").alias("label"), F.col("ok").alias("plain")
    )
    rewritten = candidates.where("ok").select(F.inline(made), "right", half, F.lit(False).alias("plain"))
    return given.unionByName(rewritten)


class BoostedTrees:
    """Logistic gradient boosting on rows with counts; trees become SQL."""

    def __init__(self, x: np.ndarray, n: np.ndarray, positive: np.ndarray) -> None:
        """``x``: distinct feature rows; ``n`` candidates each, ``positive`` of which pass."""
        share = (positive.sum() + 1) / (n.sum() + 2)
        self.start = float(np.log(share / (1 - share)))
        self.trees: list = []
        z = np.full(len(x), self.start)
        for _ in range(ROUNDS):
            p = 1 / (1 + np.exp(-z))
            grad, hess = positive - n * p, n * p * (1 - p)
            tree = self._grow(x, grad, hess, np.arange(len(x)), DEPTH)
            self.trees.append(tree)
            z += self._value(tree, x)
        self.fitted = 1 / (1 + np.exp(-z))

    def shares(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.start + sum(self._value(t, x) for t in self.trees))))

    def _grow(self, x, grad, hess, rows, depth):
        g, h = grad[rows].sum(), hess[rows].sum()
        best, split = 1e-6, None
        for f in range(x.shape[1]) if depth else ():
            values, place = np.unique(x[rows, f], return_inverse=True)
            gl = np.cumsum(np.bincount(place, grad[rows]))[:-1]
            hl = np.cumsum(np.bincount(place, hess[rows]))[:-1]
            if not len(gl):
                continue
            gain = gl**2 / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g**2 / (h + 1)
            k = int(gain.argmax())
            if gain[k] > best:
                best, split = gain[k], (f, int(values[k]))
        if split is None:
            return float(RATE * g / (h + 1))
        low = x[rows, split[0]] <= split[1]
        return (
            *split,
            self._grow(x, grad, hess, rows[low], depth - 1),
            self._grow(x, grad, hess, rows[~low], depth - 1),
        )

    def _value(self, tree, x: np.ndarray) -> np.ndarray:
        if isinstance(tree, float):
            return np.full(len(x), tree)
        f, cut, low, high = tree
        return np.where(x[:, f] <= cut, self._value(low, x), self._value(high, x))

    def sql(self) -> str:
        def text(tree) -> str:
            if isinstance(tree, float):
                return f"{tree!r}D"
            f, cut, low, high = tree
            return f"CASE WHEN {FEATURES[f]} <= {cut} THEN {text(low)} ELSE {text(high)} END"

        total = " + ".join([f"{self.start!r}D", *(text(t) for t in self.trees)])
        return f"1D / (1D + EXP(-({total})))"


def _thresholds(kinds, share, n, positive, precision: float) -> list[float]:
    """Per kind the least share down to which enough of the candidates pass (2: none)."""
    out = []
    for kind in range(len(KINDS)):
        own = np.flatnonzero(kinds == kind)
        own = own[np.argsort(-share[own], kind="stable")]
        good = np.cumsum(positive[own]) >= precision * np.cumsum(n[own])
        # rows of equal share stand or fall together
        last = np.append(share[own][1:] != share[own][:-1], True) if len(own) else np.zeros(0, bool)
        fit = np.flatnonzero(good & last)
        out.append(float(share[own][fit[-1]]) - 1e-9 if len(fit) else 2.0)
    return out


def find_personal_data(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> DataFrame:
    """``key, kind, start, end, base`` of each distinct text; ``key`` is its xxhash64."""
    spans = saved(_spans(docs, text))
    candidates = spans.where("wide").withColumns(_features())
    # features are small whole numbers, so their combinations are few whatever the table
    cells = [*FEATURES, "half", "plain"]
    counted = _examples(spans.where("wide")).withColumns(_features()).groupBy(*cells).agg(
        F.count("*").alias("n"), F.sum("label").alias("k")
    )
    rows = counted.orderBy(*cells).collect()
    base = spans.where("NOT wide").select("key", "kind", "start", "end", F.lit(True).alias("base"))
    x = np.array([[row[f] for f in FEATURES] for row in rows]).reshape(-1, len(FEATURES))
    n, k = np.array([row.n for row in rows], float), np.array([row.k for row in rows], float)
    fit = np.array([row.half == 0 for row in rows], bool)
    # plain base spans teach, but do not decide from where on spans are added
    held = np.array([row.half == 1 and not row.plain for row in rows], bool)
    if not fit.any() or not held.any():
        return base
    trees = BoostedTrees(x[fit], n[fit], k[fit])
    least = _thresholds(x[held, 0], trees.shares(x[held]), n[held], k[held], precision)
    wanted = F.element_at(F.array(*[F.lit(v) for v in least]), F.col("kind") + 1)
    added = candidates.where(F.expr(trees.sql()) >= wanted)
    added = added.select("key", "kind", "start", "end", F.lit(False).alias("base"))
    both = base.union(added)
    place = W.partitionBy("key").orderBy("start", F.desc("base"), F.desc("end"), "kind")
    behind = place.rowsBetween(W.unboundedPreceding, -1)
    ahead = place.rowsBetween(1, W.unboundedFollowing)
    base_end = F.max(F.when(F.col("base"), F.col("end"))).over(behind)
    base_start = F.min(F.when(F.col("base"), F.col("start"))).over(ahead)
    both = both.withColumns({"_before": base_end, "_next": base_start}).where(
        "base OR (coalesce(_before, 0) <= start AND coalesce(_next, end) >= end)"
    )
    both = both.withColumn("_before", F.max("end").over(behind))
    return both.where("base OR coalesce(_before, 0) <= start").select(*base.columns)


def redact(docs: DataFrame, text: str = "text", precision: float = PRECISION) -> DataFrame:
    """Put ``[kind]`` in place of spans; overlapping ones become one, named by the first."""
    spans = find_personal_data(docs, text, precision)
    place = W.partitionBy("key").orderBy("start", F.desc("end"), "kind")
    reach = F.coalesce(F.max("end").over(place.rowsBetween(W.unboundedPreceding, -1)), F.lit(-1))
    isle = F.sum(F.col("_new").cast("int")).over(place.rowsBetween(W.unboundedPreceding, 0))
    isles = spans.withColumn("_new", F.col("start") >= reach).withColumn("_isle", isle)
    merged = isles.groupBy("key", "_isle").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", "start").alias("kind")
    )
    listed = merged.groupBy("key").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("__llm_spans")
    )
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])
    spans_, t = F.col("__llm_spans"), F.col(text)

    def piece(s: Column, i: Column) -> Column:
        since = F.when(i == 0, 0).otherwise(F.get(spans_, i - 1)["end"])
        return F.concat(
            F.substring(t, since + 1, (s["start"] - since).cast("int")),
            F.element_at(names, s["kind"] + 1),
        )

    last = F.element_at(spans_, -1)["end"]
    whole = F.concat(
        F.array_join(F.transform(spans_, piece), ""),
        F.substring(t, last + 1, F.length(t) - last.cast("int")),
    )
    joined = docs.withColumn("__llm_key", F.xxhash64(t)).join(
        listed.withColumnRenamed("key", "__llm_key"), "__llm_key", "left"
    )
    changed = F.when(spans_.isNull(), t).otherwise(whole)
    return joined.select(*[changed.alias(c) if c == text else c for c in docs.columns])


def _line(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
        ),
        ",",
    )


@query("op9_pii")
def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    spans = find_personal_data(docs)
    one = F.struct("start", "kind", "end")
    found = spans.groupBy("key").agg(
        *[
            F.sum((F.col("base") & (F.col("kind") == k)).cast("bigint")).alias(f"n_{kind}")
            for k, kind in enumerate(KINDS)
        ],
        F.sort_array(F.collect_list(F.when(F.col("base"), one))).alias("_base"),
        F.sort_array(F.collect_list(one)).alias("_all"),
    )
    joined = docs.select("doc_id", F.xxhash64("text").alias("key")).join(found, "key", "left")
    return joined.select(
        "doc_id",
        *[F.coalesce(f"n_{kind}", F.lit(0)).cast("bigint").alias(f"n_{kind}") for kind in KINDS],
        F.sha2(F.coalesce(_line(F.col("_base")), F.lit("")), 256).alias("base_sha256"),
        F.coalesce(_line(F.col("_all")), F.lit("")).alias("spans"),
    )
