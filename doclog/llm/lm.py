"""Language-model scores by a log-bilinear model, and smoothed word counts.

Tokens are a text's words (A-Z lowered, split at blanks) and one end. Counts are
those of all training documents, of all their words. The model has a fixed number
of entries: the end, the most frequent words, and entries that all other words
share by their hash, so each word has a vector and the model does not grow. It
predicts a token's vector from those of the two tokens before it, each through a
matrix of its own.

Entries of like frequency form classes; the most frequent ones are classes of
their own. An entry has the probability of its class times its own within the
class. Either is the exponential of the product of the predicted vector with the
class's or entry's own, plus a bias, over the sum of those of all classes, or of
all entries of the class; both sums are made for each token. A word has the
probability of its entry times its smoothed share of the counts of all words of
that entry.

The model is fitted with noise-contrastive estimation: classes are told from
noise drawn by frequency, entries from noise drawn within their class. Each task
fits its own share of all training documents, from the same start; the means of
what they find are the next start, weighted by their tokens, and for an entry's
own vectors by how often they met it. A first round takes one document in eight,
the last takes all.

Cases: null, empty and blank texts are the end alone; without training documents
there is no end in the counts, every base score is 0 and the model is uniform;
rows with equal ids are scored one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .registry import query
from .shared import NOT_BLANK, Words, chunks, fold, received, saved, send, table, texts

END = 0
# Entries of the model: the most frequent words, and those shared by hash.
OWN_WORDS, SHARED = 1 << 15, 1 << 14
# Words whose counts are sent to all tasks; the counts of the rest are joined.
SENT_WORDS = 1 << 19
SIZE, NOISE, BATCH, RATE = 12, 32, 4096, 0.15
# Entries that are classes of their own, and noise entries for one in a class.
ALONE, INNER_NOISE = 64, 2
FIRST_SHARE = 8
# Parts that the entries travel in, rows of sums made at once, and the largest
# product of vectors that counts.
PARTS, SUM_ROWS, LARGEST = 64, 512, 60


class WordIndex:
    """Places of word hashes in a list, by open slots and a search for the rest."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sorted = np.sort(hashes)
        self.order = np.argsort(hashes, kind="stable")
        bits = max(8, int(np.ceil(np.log2(4 * len(hashes) + 1))))
        self.shift = np.uint64(64 - bits)
        self.slots = np.zeros(1 << bits, np.int32)
        self.slots[(self.sorted >> self.shift).astype(np.int64)] = np.arange(len(hashes))

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each hash in the list given first, -1 for none."""
        if not len(self.sorted):
            return np.full(len(hashes), -1)
        at = self.slots[(hashes >> self.shift).astype(np.int64)]
        other = np.flatnonzero(self.sorted[at] != hashes)
        if len(other):
            near = np.searchsorted(self.sorted, hashes[other])
            at[other] = np.minimum(near, len(self.sorted) - 1)
        return np.where(self.sorted[at] == hashes, self.order[at], -1)


def _pieces(column: pa.Array) -> Iterator[tuple[int, Words]]:
    data, offsets = texts(column)
    for a, b in chunks(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        yield a, Words(part, off, NOT_BLANK, lower=True)


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``h, c``: the number of each word, by its hash, in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [words.hashes() for _, words in _pieces(batch.column(0))]
            if found:
                h, c = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(c)], names=["h", "c"]
                )

    counted = docs.select(text).mapInArrow(count, "h bigint, c bigint")
    return counted.groupBy("h").agg(F.sum("c").alias("c"))


def _tokens(
    words: Words, hashes: np.ndarray, place: np.ndarray, own: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Model entries of all rows, an end after each, and the two before each.

    ``place`` is where the word index has the words' hashes; its first ``own`` words
    have entries of their own.
    """
    shared = (hashes & np.uint64(SHARED - 1)).astype(np.int64) + own + 1
    place = np.where((place >= 0) & (place < own), place + 1, shared)
    ends = words.first[1:] + np.arange(words.rows)
    token = np.empty(len(place) + words.rows, np.int64)
    inner = np.ones(len(token), bool)
    inner[ends] = False
    token[inner], token[ends] = place, END
    starts = np.concatenate([[0], ends[:-1] + 1])
    one, two = np.full(len(token), END), np.full(len(token), END)
    one[1:], two[2:] = token[:-1], token[:-2]
    one[starts] = two[starts] = END
    second = starts[ends > starts] + 1
    two[second] = END
    return token, one, two


def _sums(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places in an index, in order, and the sum of the rows at each."""
    if not len(index):
        return index, values
    order = np.argsort(index)
    index = index[order]
    first = np.flatnonzero(np.concatenate([[True], index[1:] != index[:-1]]))
    return index[first], np.add.reduceat(values[order], first, axis=0)


def _log_shares(h: np.ndarray, vectors: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """For each row, the chosen vector's logarithm in the normalised exponentials of all products."""
    z = h @ vectors.T
    np.clip(z, -LARGEST, LARGEST, out=z)
    own = z[np.arange(len(z)), chosen]
    np.exp(z, out=z)
    return own - np.log(z.sum(axis=1))


class LogBilinear:
    """Vectors of classes and entries, a matrix for each place before, and biases."""

    NAMES = ("target", "near", "far", "bias")
    OWN = ("context", "own_target", "own_bias")

    def __init__(self, share: np.ndarray) -> None:
        """``share``: each entry's share of all training tokens; the rarer ones come later."""
        n, draw = len(share), np.random.default_rng(11)
        # a class has about 1 / sqrt(share) entries, so both sums of a token are short
        label = np.arange(n)
        label[ALONE:] = ALONE + np.cumsum(np.sqrt(share[ALONE:])).astype(np.int64)
        _, first, inverse, size = np.unique(
            label, return_index=True, return_inverse=True, return_counts=True
        )
        self.of, self.first, self.size = inverse.astype(np.int32), first, size
        k = len(size)
        self.share = np.bincount(inverse, share, k)
        self.target = draw.normal(0, 0.05, (k, SIZE)).astype(np.float32)
        self.near, self.far = np.eye(SIZE, dtype=np.float32) * 0.7, np.eye(SIZE, dtype=np.float32) * 0.5
        self.bias = np.log(self.share).astype(np.float32)
        self.context, self.own_target = np.zeros((2, n, SIZE), np.float32)
        self.own_bias = np.log(share / self.share[inverse]).astype(np.float32)

    def flat(self) -> np.ndarray:
        return np.concatenate([getattr(self, name).ravel() for name in self.NAMES]).astype(float)

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for name in self.NAMES:
            old = getattr(self, name)
            setattr(self, name, flat[at : at + old.size].reshape(old.shape).astype(np.float32))
            at += old.size

    def own(self) -> np.ndarray:
        """What entries have of their own, a row for each."""
        return np.column_stack([getattr(self, name) for name in self.OWN])

    def load_own(self, first: int, rows: np.ndarray) -> None:
        part = slice(first, first + len(rows))
        self.context[part], self.own_target[part] = rows[:, :SIZE], rows[:, SIZE : 2 * SIZE]
        self.own_bias[part] = rows[:, 2 * SIZE]

    def fit(self, token: np.ndarray, one: np.ndarray, two: np.ndarray, state: dict, draw) -> None:
        """One pass of noise-contrastive estimation over tokens, in batches."""
        n = len(self.share)
        log_noise = np.log(NOISE * self.share).astype(np.float32)
        cumulative = np.cumsum(self.share)
        if "met" not in state:
            state["met"] = np.zeros(len(self.of), np.float32)
            state |= {name: np.ones(len(self.of), np.float32) for name in self.OWN}
            state |= {name: np.full_like(getattr(self, name), 1e-6) for name in self.NAMES}

        order = draw.permutation(len(token))
        for at in range(0, len(token), BATCH):
            chosen = order[at : at + BATCH]
            w, a, b = token[chosen], one[chosen], two[chosen]
            cw, m = self.of[w], np.float32(len(chosen))
            va, vb = self.context[a], self.context[b]
            predicted = va @ self.near + vb @ self.far
            noise = np.minimum(np.searchsorted(cumulative, draw.random(NOISE)), n - 1)
            tw, tn = self.target[cw], self.target[noise]
            real = (predicted * tw).sum(1) + self.bias[cw] - log_noise[cw]
            fake = predicted @ tn.T + self.bias[noise] - log_noise[noise]
            # gradients of the logistic loss: tokens are 1, noise is 0
            g, f = self._pulls(real, fake)
            d_predicted = g[:, None] * tw + f @ tn
            inner = np.flatnonzero(self.size[cw] > 1)
            if len(inner):
                d_predicted[inner] += self._fit_inner(w[inner], cw[inner], predicted[inner], state, draw)
            self._step_at("near", slice(None), va.T @ d_predicted / m, state)
            self._step_at("far", slice(None), vb.T @ d_predicted / m, state)
            # each class's vector is drawn to (or pushed from) what was predicted
            rows = np.empty((len(w) + NOISE, SIZE + 1), np.float32)
            np.multiply(predicted, g[:, None], out=rows[: len(w), :SIZE])
            rows[len(w) :, :SIZE], rows[: len(w), SIZE], rows[len(w) :, SIZE] = f.T @ predicted, g, f.sum(0)
            classes, step = _sums(np.concatenate([cw, noise]), rows)
            step /= m
            self._step_at("target", classes, step[:, :SIZE], state)
            self._step_at("bias", classes, step[:, SIZE], state)
            back = np.empty((2 * len(w), SIZE), np.float32)
            np.matmul(d_predicted, self.near.T, out=back[: len(w)])
            np.matmul(d_predicted, self.far.T, out=back[len(w) :])
            self._step_rows("context", *_sums(np.concatenate([a, b]), back), state)

    @staticmethod
    def _pulls(real: np.ndarray, fake: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How far tokens are from 1, and noise (with a minus) from 0."""
        np.clip(real, -30, 30, out=real)
        np.clip(fake, -30, 30, out=fake)
        np.exp(real, out=real)
        np.exp(np.negative(fake, out=fake), out=fake)
        return 1 / (1 + real), -1 / (1 + fake)

    def _fit_inner(self, w: np.ndarray, cw: np.ndarray, h: np.ndarray, state: dict, draw) -> np.ndarray:
        """Tell entries from others of their class; the gradients of what was predicted."""
        size = self.size[cw]
        spread = (draw.random((INNER_NOISE, len(w)), np.float32) * size).astype(np.int64)
        # a float32 draw just below 1 times the size may round up to it
        noise = self.first[cw] + np.minimum(spread, size - 1)
        log_noise = np.log(INNER_NOISE / size).astype(np.float32)
        tw, tn = self.own_target[w], self.own_target[noise]
        real = (h * tw).sum(1) + self.own_bias[w] - log_noise
        fake = (tn * h).sum(2) + self.own_bias[noise] - log_noise
        g, f = self._pulls(real, fake)
        where = np.concatenate([w, noise.ravel()])
        pull = np.concatenate([g, f.ravel()])
        rows = np.empty((len(where), SIZE + 2), np.float32)
        np.multiply(h, pull.reshape(-1, len(w), 1), out=rows.reshape(-1, len(w), SIZE + 2)[:, :, :SIZE])
        rows[:, SIZE] = pull
        rows[: len(w), SIZE + 1], rows[len(w) :, SIZE + 1] = 1, 1 / INNER_NOISE
        entries, step = _sums(where, rows)
        self._step_rows("own_target", entries, step[:, :SIZE], state)
        self._step_at("own_bias", entries, step[:, SIZE], state)
        state["met"][entries] += step[:, SIZE + 1]
        return g[:, None] * tw + (f[:, :, None] * tn).sum(0)

    def _step_at(self, name: str, where, step: np.ndarray, state: dict) -> None:
        """Add a step, over the root of the squares of all steps so far."""
        past = state[name][where] + step * step
        state[name][where] = past
        getattr(self, name)[where] += RATE * step / np.sqrt(past)

    def _step_rows(self, name: str, where: np.ndarray, step: np.ndarray, state: dict) -> None:
        """The same with one mean square for each vector."""
        past = state[name][where] + np.einsum("ij,ij->i", step, step) / SIZE
        state[name][where] = past
        getattr(self, name)[where] += step * (RATE / np.sqrt(past))[:, None]

    def freeze(self) -> None:
        """What scoring needs: vectors through their matrices, and biases as one more place."""
        self.a, self.b = self.context @ self.near, self.context @ self.far
        self.q = np.column_stack([self.target, self.bias])
        self.own_q = np.column_stack([self.own_target, self.own_bias])
        for name in ("target", "bias", *self.OWN):
            delattr(self, name)

    def log10(self, token: np.ndarray, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """Normalised log-probabilities of tokens after two others."""
        out = np.empty(len(token))
        cw = self.of[token]
        h = np.ones((len(token), SIZE + 1), np.float32)
        h[:, :SIZE] = self.a[one] + self.b[two]
        for at in range(0, len(token), SUM_ROWS):
            part = slice(at, at + SUM_ROWS)
            out[part] = _log_shares(h[part], self.q, cw[part])
        inner = np.flatnonzero(self.size[cw] > 1)
        inner = inner[np.argsort(cw[inner], kind="stable")]
        classes, start = np.unique(cw[inner], return_index=True)
        for k, where in zip(classes, np.split(inner, start[1:]), strict=False):
            first = self.first[k]
            vectors = self.own_q[first : first + self.size[k]]
            for at in range(0, len(where), SUM_ROWS):
                some = where[at : at + SUM_ROWS]
                out[some] += _log_shares(h[some], vectors, token[some] - first)
        return out / np.log(10)


def _fit_round(docs: DataFrame, model: LogBilinear, index: WordIndex) -> LogBilinear:
    """Fit in each task and average, in parts of entries, before the driver gets the means.

    Parts below 0 hold what all tasks fit, the others how far entries were moved:
    half floats, and how often each entry was met.
    """
    sent = send(docs.sparkSession.sparkContext, (model, index))
    entries, own_words = len(model.of), len(model.of) - 1 - SHARED
    each = -(-entries // PARTS)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (own, words_of), state, n = received(sent), {}, 0
        start, draw = own.own(), np.random.default_rng(5)
        for batch in batches:
            held = []
            for _, words in _pieces(batch.column(0)):
                hashes = words.hashes()
                held.append(_tokens(words, hashes, words_of.find(hashes), own_words))
            for k in range(0, len(held), 4):
                token, one, two = (np.concatenate(x) for x in zip(*held[k : k + 4], strict=True))
                own.fit(token, one, two, state, draw)
                n += len(token)
        if n:
            moved = (own.own() - start).astype(np.float16)
            parts = [(-1 - TaskContext.get().partitionId() % 8, (own.flat() * n).tobytes(), b"", n)]
            for k in range(0, entries, each):
                met = state["met"][k : k + each]
                parts.append((k // each, moved[k : k + each].tobytes(), met.tobytes(), 0))
            yield _rows(parts)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, list] = {}
        for batch in batches:
            for part, data, met, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                held = total.setdefault(part, [0.0, 0.0, 0])
                if part < 0:
                    held[0], held[2] = held[0] + np.frombuffer(data), held[2] + n
                else:
                    met = np.frombuffer(met, np.float32).astype(float)
                    rows = np.frombuffer(data, np.float16).reshape(len(met), -1)
                    held[0], held[1] = held[0] + rows * met[:, None], held[1] + met
        for part, (held, met, n) in total.items():
            if part >= 0:
                held = (held / np.maximum(met, 1e-9)[:, None]).astype(np.float32)
            yield _rows([(part, held.tobytes(), b"", n)])

    def _rows(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64())
        columns = [pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=["part", "data", "met", "n"])

    kind = "part int, data binary, met binary, n bigint"
    fitted = docs.select("text").mapInArrow(fit, kind)
    flat, n, start = 0.0, 0, model.own()
    # at most PARTS + 8 rows, together as large as the model
    for row in fitted.repartition(PARTS, "part").mapInArrow(add, kind).toLocalIterator():
        if row.part < 0:
            flat, n = flat + np.frombuffer(row.data), n + row.n
        else:
            rows = np.frombuffer(row.data, np.float32).reshape(-1, start.shape[1])
            first = row.part * each
            model.load_own(first, start[first : first + len(rows)] + rows)
    sent.unpersist()
    if n:
        model.load(flat / n)
    return model


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """The hashes and numbers of the most frequent words, at most SENT_WORDS, and the rest."""
    level = F.floor(F.log2("c") * 8)
    # the numbers are below 2^63, so there are at most 504 levels
    least, listed = 504, 0
    for row in counts.groupBy(level.alias("l")).count().orderBy(F.desc("l")).collect():
        listed += row["count"]
        if listed > SENT_WORDS:
            break
        least = row["l"]
    found = counts.where(level >= least).toArrow()
    h, c = found["h"].to_numpy(), found["c"].to_numpy()
    order = np.lexsort((h, -c))
    return h[order].view(np.uint64), c[order], counts.where(level < least)


def _entry_counts(own: int, names: np.ndarray, often: np.ndarray, rare: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """All counts of the words of each shared entry, and how many words it has."""
    place = (names[own:] & np.uint64(SHARED - 1)).astype(np.int64)
    total = np.bincount(place, often[own:], SHARED).astype(np.int64)
    kinds = np.bincount(place, minlength=SHARED)
    by_entry = rare.groupBy(F.col("h").bitwiseAND(F.lit(SHARED - 1)).alias("e"))
    rows = by_entry.agg(F.sum("c").alias("c"), F.count("*").alias("n")).toArrow()
    at = rows["e"].to_numpy()
    total[at] += rows["c"].to_numpy()
    kinds[at] += rows["n"].to_numpy()
    return total, kinds


def score_texts(docs: DataFrame, training: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_tokens, n_known, train_tokens, base_score`` and ``score`` to ``docs``.

    Log-probabilities are to the base 10. Columns of these names are replaced;
    the text goes.
    """
    spark = docs.sparkSession
    docs = docs.drop("n_tokens", "n_known", "train_tokens", "base_score", "score")
    training = training.select(F.col(text).alias("text"))
    counts = saved(word_counts(training))
    ends = training.count()
    totals = counts.agg(F.count("*"), F.coalesce(F.sum("c"), F.lit(0))).first()
    kinds, total = totals[0] + (ends > 0), totals[1] + ends
    names, often, rare = _most_frequent(counts)
    index, own = WordIndex(names), min(len(names), OWN_WORDS)
    in_entry, entry_kinds = _entry_counts(own, names, often, rare)
    share = np.concatenate([[ends], often[:own], in_entry]) + 1.0
    model = LogBilinear(share / share.sum())
    if ends:
        short = WordIndex(names[:own])
        some = F.pmod(F.xxhash64("text"), F.lit(FIRST_SHARE)) == 0
        model = _fit_round(training.where(some), model, short)
        model = _fit_round(training, model, short)
    model.freeze()
    log_count = np.log10(often + 1.0)
    # a word of a shared entry has its smoothed share of all that have the entry
    log_all = np.concatenate([np.zeros(own + 1), np.log10(in_entry + entry_kinds + 1.0)])
    sent = send(spark.sparkContext, (model, index, log_count, log_all))
    given, position = docs.columns, docs.columns.index(text)
    measured = docs.selectExpr(
        "*", "0L AS n_tokens", "0L AS n_known", "0D AS __llm_own_logs", "0D AS __llm_shared_logs",
        "0D AS __llm_model_log",
        "CAST(NULL AS BINARY) AS __llm_rest",
    ).drop(text)
    names_out = measured.columns
    rest_type = np.dtype([("h", "<i8"), ("k", "<i4")])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted, all_words, logs_of, all_of = received(sent)
        for batch in batches:
            parts: list[tuple] = []
            blobs: list[bytes] = []
            for _, words in _pieces(batch.column(position)):
                hashes = words.hashes()
                place = all_words.find(hashes)
                token, one, two = _tokens(words, hashes, place, own)
                row = np.repeat(np.arange(words.rows), words.count + 1)
                known = place >= 0
                row_of, logs = words.row[known], logs_of[place[known]]
                shown = place[known] < own
                sums = [
                    words.count + 1,
                    np.bincount(row_of, minlength=words.rows),
                    np.bincount(row_of[shown], logs[shown], words.rows),
                    np.bincount(row_of[~shown], logs[~shown], words.rows),
                    np.bincount(row, fitted.log10(token, one, two) - all_of[token], words.rows),
                ]
                parts.append(sums)
                far_row, far = words.row[~known], hashes[~known]
                order = np.lexsort((far, far_row))
                far_row, far = far_row[order], far[order]
                new = np.ones(len(far), bool)
                new[1:] = (far[1:] != far[:-1]) | (far_row[1:] != far_row[:-1])
                at = np.flatnonzero(new)
                rest = np.empty(len(at), rest_type)
                rest["h"], rest["k"] = far[at].view(np.int64), np.diff(np.append(at, len(far)))
                bounds = np.searchsorted(far_row[at], np.arange(1, words.rows))
                blobs += [x.tobytes() for x in np.split(rest, bounds)]
            if parts:
                sums = [np.concatenate(x) for x in zip(*parts, strict=True)]
                arrays = [c for i, c in enumerate(batch.columns) if i != position]
                arrays += [pa.array(x.astype(np.int64)) for x in sums[:2]]
                arrays += [pa.array(x.astype(float)) for x in sums[2:]]
                yield pa.RecordBatch.from_arrays(
                    [*arrays, pa.array(blobs, pa.binary())], names=names_out
                )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = batch.column(1).to_pylist()
            rest = np.frombuffer(b"".join(blobs), rest_type)
            size = [len(x) // rest_type.itemsize for x in blobs]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(batch.column(0).to_numpy(), size)),
                    pa.array(rest["h"].copy()),
                    pa.array(rest["k"].copy()),
                ],
                names=["__llm_row", "h", "k"],
            )

    found = docs.mapInArrow(measure, measured.schema)
    found = saved(found.withColumn("__llm_row", F.monotonically_increasing_id()))
    rest = found.select("__llm_row", "__llm_rest").mapInArrow(unpack, "__llm_row bigint, h bigint, k int")
    # words beyond the list that was sent, with their counts if training has them
    rest = rest.join(rare, "h").groupBy("__llm_row").agg(
        F.sum("k").alias("__llm_known_rest"),
        F.sum(F.col("k") * F.log10(F.col("c") + 1.0)).alias("__llm_rest_logs"),
    )
    out = found.drop("__llm_rest").join(rest, "__llm_row", "left")
    shared_logs = F.col("__llm_shared_logs") + F.coalesce("__llm_rest_logs", F.lit(0.0))
    base = F.col("__llm_own_logs") + shared_logs + float(np.log10(ends + 1.0))
    base -= F.col("n_tokens") * float(np.log10(total + kinds + 1.0))
    return out.select(
        *[c for c in given if c != text],
        "n_tokens",
        (F.col("n_known") + F.coalesce("__llm_known_rest", F.lit(0)) + int(ends > 0)).alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        base.alias("base_score"),
        (F.col("__llm_model_log") + shared_logs).alias("score"),
    )


@query("op10_lm_scoring")
def op10_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = fold("doc_id", 7) == 2
    marked = docs.select("doc_id", held_out.alias("held_out"), "text")
    return score_texts(marked, docs.where(~held_out))
