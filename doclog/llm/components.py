"""Connected components of links between integer ids, on frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import gathered, mixed, released, saved

# Links that a task connects at once; more are connected in lots.
LINKS_AT_ONCE = 1 << 22
# Ties between tasks' roots that go to one task of the next level, about.
TIES_A_TASK = 1 << 16
# Roots that are sent to the ids' rows, 16 bytes each; more are joined, in SALTS lots.
MAX_SENT_ROOTS, SALTS = 1 << 18, 16


def local_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every id of some links, and the root of its component among them.

    The root is the id that comes first by a hash, so that of the ids on the
    border of several tasks' components a share falls away each time, whatever
    the order of the ids along a chain.
    """
    ids, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    order = np.argsort(mixed(ids.view(np.uint64)), kind="stable")
    rank = np.empty(len(ids), np.int64)
    rank[order] = np.arange(len(ids))
    a, b = rank[place[: len(u)]], rank[place[len(u) :]]
    label = np.arange(len(ids))
    while True:
        # the roots of the two ends of a link are tied, then all go to their roots' roots
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return ids, ids[order[label[rank]]]
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            further = label[label]
            if (further == label).all():
                break
            label = further


@released
def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def roots() -> pa.RecordBatch:
        links = [np.concatenate([h[k] for h in held]) if held else np.zeros(0, np.int64) for k in (0, 1)]
        return pa.RecordBatch.from_arrays([pa.array(x) for x in local_roots(*links)], names=["id", "root"])

    for batch in batches:
        held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
        size += len(batch)
        if size >= LINKS_AT_ONCE:
            yield roots()
            held, size = [], 0
    yield roots()


def _with_root_of(rows: DataFrame, key: str, roots: DataFrame, value: str) -> DataFrame:
    """Add ``value`` of ``roots`` (one row a ``key``), null where there is none.

    A root may be that of most rows: it is sent to them, or its row is copied
    for as many lots of them.
    """
    if roots.count() <= MAX_SENT_ROOTS:
        return rows.join(F.broadcast(roots), key, "left")
    lots = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    dealt = rows.withColumn("__lot", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    return dealt.join(roots.withColumn("__lot", lots), [key, "__lot"], "left").drop("__lot")


def _rooted(links: DataFrame) -> DataFrame:
    """``id, root`` for every id in ``links`` (``u``, ``v``): one root a component.

    The tasks of a level are as many as its ties call for; a level of one task
    leaves no ties.
    """
    levels, edges, alone = [], links.select("u", "v"), False
    while True:
        forest = saved(edges.mapInArrow(_forest, "id bigint, root bigint"))
        # an id that several tasks have met ties their roots
        first = forest.groupBy("id").agg(F.min(F.struct(F.xxhash64("root"), "root"))["root"].alias("top"))
        levels.append(first)
        if alone:
            break
        ties = forest.join(first, "id").where("root <> top")
        edges = saved(gathered(ties.select(F.col("root").alias("u"), F.col("top").alias("v")).distinct()))
        left = edges.count()
        if not left:
            break
        alone = left <= min(TIES_A_TASK, LINKS_AT_ONCE)
        edges = edges.coalesce(-(-left // TIES_A_TASK))
    found = levels.pop().withColumnRenamed("top", "root")
    while levels:
        upper = saved(gathered(found)).select(F.col("id").alias("top"), "root")
        found = _with_root_of(levels.pop(), "top", upper, "root")
        found = found.select("id", F.coalesce("root", "top").alias("root"))
    return found


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id in ``links`` (``u``, ``v``) but the components' least.

    Each task connects its own links; what is left are ties between the roots of
    tasks that have met the same id, which are far fewer, and are connected in the
    same way until there are none. No neighbourhood is gathered, and each level is
    written out, which cuts the lineage. Null ids and links of an id to itself are
    ignored.
    """
    known = links.where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    rooted = saved(gathered(_rooted(known)))
    least = rooted.groupBy("root").agg(F.min("id").alias("component"))
    found = _with_root_of(rooted, "root", saved(gathered(least)), "component")
    return found.where("id <> component").select("id", "component")
