"""A corpus pipeline of five stages, each written and read again by the next.

Toxic documents go; of each group of near copies one document stays; benchmark
passages are cut out, and documents that mostly consist of them go; personal
data is replaced by the names of its kinds; what is left is packed into token
sequences. Rows with null or empty texts pass through the first four stages. An
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from doclog.llm.decontaminate import remove_leaks
from doclog.llm.ngram_join import MAX_SENT_IDS, join_ngrams
from doclog.llm.packing import WINDOW, pack, public_vocabulary, tokenized_pieces
from doclog.llm.pii import redact
from doclog.llm.shared import saved, table
from doclog.llm.toxicity import score_toxicity, train_toxicity


def _measured(docs: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with the length of the text as it is now."""
    if "n_chars" in columns:
        docs = docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return docs.select(*columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half."""
    model = train_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = score_toxicity(docs, model, name="__llm_score")
    return scored.where("__llm_score < 0.5").select(*docs.columns)


def _by_row(rows: DataFrame, name: str) -> DataFrame:
    """A side of few rows, sent to the other if it is small."""
    few = rows.select(name).distinct()
    return F.broadcast(few) if few.count() <= MAX_SENT_IDS else few


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows alike in 80 % of their runs of five words, the one with the least id.

    It is decided row by row: rows with equal ids and unlike texts all stay, and of
    equal ids the first row as read. Rows without an id come last. Rows without
    words are like no other and stay.
    """
    rows = saved(docs.withColumn("__llm_row", F.monotonically_increasing_id()))
    found = join_ngrams(rows.select(F.col("__llm_row").alias("doc_id"), "text"), n=5, num=80)
    found = saved(found.select(F.col("doc_id").alias("__llm_row"), F.col("component_id").alias("part")))
    copies = found.where("__llm_row <> part")
    members = copies.union(copies.select("part", "part").distinct())
    ids = rows.select("__llm_row", "doc_id").join(_by_row(members, "__llm_row"), "__llm_row", "left_semi")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "__llm_row")
    members = saved(members.join(ids, "__llm_row").select("part", "__llm_row", order.alias("place")))
    # the least of each group is found before any row of it is shuffled
    first = members.groupBy("part").agg(F.min("place")["__llm_row"].alias("__llm_row"))
    gone = saved(members.join(first.select("__llm_row"), "__llm_row", "left_anti").select("__llm_row"))
    return rows.join(_by_row(gone, "__llm_row"), "__llm_row", "left_anti").select(*docs.columns)


def cut_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with test items."""
    kept = remove_leaks(docs, table(spark, sf_dir, "benchmark"), window=10)
    return _measured(kept, docs.columns)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the names of kinds in place of personal data."""
    return _measured(redact(docs), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of a document, with its sequence and place there."""
    return pack(tokenized_pieces(docs, public_vocabulary(), WINDOW))


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_join", drop_near_copies),
    ("decontamination", cut_benchmark),
    ("pii", hide_personal_data),
    ("packing", pack_sequences),
]

# Learnt models and token ids are beyond SQL; tests compare each stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir))
    return docs
