"""Batch queries: scans, decoders, inference, the encoder, offsets and appends."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.offsets import (
    Offset,
    offset_from_json,
    offset_struct,
    offset_to_json,
)
from ..operators import (
    array_results,
    decode_lenient,
    decode_strict,
    encode_documents,
    infer_majority_schema,
)
from ..sources import (
    append_collection,
    decode_results,
    infer_log_schema,
    latest_offset,
    messages,
    offset_bounds,
    query_results,
    read_collection,
    read_log,
)
from ..sources.storage import scratch_folder
from .inputs import (
    DOC,
    DOC_EDGES,
    DOC_KINDS,
    DOC_NESTED,
    DOC_RECORD,
    EVENT_LOG_OF_TWO_SQL,
    EVENT_LOG_SQL,
    derived,
    derived_sql,
    event_log,
    stored_log,
    stored_log_of_two,
)
from .registry import query, table

ID = ["event_id"]

# ------------------------------------------------------------------ scans


@query(
    "collection_scan",
    "SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
)
def collection_scan(spark: SparkSession, folder: str) -> DataFrame:
    collection = table(spark, folder, "events").select(F.col("props").alias("doc"))
    return decode_results(collection)


@query(
    "collection_query_scan",
    """SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
    WHERE CAST(json_extract(props, '$.k') AS BIGINT) >= 50""",
)
def collection_query_scan(spark: SparkSession, folder: str) -> DataFrame:
    text = """SELECT props AS doc FROM {collection}
        WHERE CAST(get_json_object(props, '$.k') AS BIGINT) >= 50"""
    results = query_results(spark, text, table(spark, folder, "events"))
    return decode_results(results, "k BIGINT")


@query(
    "collection_query_rows",
    """SELECT event_type, count(*) AS n, max(user_id) AS last_user
    FROM events GROUP BY event_type""",
)
def collection_query_rows(spark: SparkSession, folder: str) -> DataFrame:
    text = """SELECT event_type, count(*) AS n, max(user_id) AS last_user
        FROM {collection} GROUP BY event_type"""
    results = query_results(spark, text, table(spark, folder, "events"))
    return decode_results(results, "event_type STRING, n BIGINT, last_user BIGINT")


@query(
    "project_rename",
    "SELECT o_orderkey, o_totalprice AS number FROM orders",
)
def project_rename(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").drop("o_orderdate")
    schema = "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE"
    rows = decode_strict(encode_documents(orders), schema)
    return rows.select("o_orderkey", "o_totalprice").withColumnRenamed("o_totalprice", "number")


_ELEMENTS = """SELECT event_id, unnest(CASE WHEN json_type(doc) = 'ARRAY'
    THEN json_extract(doc, '$[*]') ELSE [CAST(doc AS json)] END) AS v FROM d"""


@query(
    "explode_array_results",
    f"""WITH d AS ({derived_sql(DOC)}), e AS ({_ELEMENTS})
    SELECT event_id, CAST(json_extract_string(v, '$.k') AS VARCHAR) AS k,
      json_type(v) = 'OBJECT' AS is_object FROM e""",
)
def explode_array_results(spark: SparkSession, folder: str) -> DataFrame:
    results = array_results(derived(spark, folder, DOC), keep=ID)
    k = F.try_variant_get("result", "$.k", "variant")
    return results.select(
        "event_id",
        # numbers keep the text they have in the document, 2.0 as well
        F.when(F.schema_of_variant(k).like("DECIMAL%"), k.cast("double").cast("string"))
        .otherwise(k.cast("string"))
        .alias("k"),
        F.try_variant_get("result", "$", "struct<>").isNotNull().alias("is_object"),
    )


# --------------------------------------------------------------- decoders


def _nulls_apart(rows: DataFrame, name: str, other: object) -> DataFrame:
    """Show a null of column ``name`` as a flag, with ``other`` in its place."""
    column = F.col(name)
    return rows.withColumns(
        {f"{name}_is_null": column.isNull(), name: F.coalesce(column, F.lit(other))}
    )


def _nulls_apart_sql(sql: str, name: str, other: str) -> str:
    return f"""SELECT * REPLACE (coalesce({name}, {other}) AS {name}),
      {name} IS NULL AS {name}_is_null FROM ({sql})"""


def _strict_sql(doc: str, kinds: str, value: str) -> str:
    return f"""WITH d AS ({derived_sql(doc)}), e AS ({_ELEMENTS}),
    f AS (SELECT event_id, json_type(v, '$.k') AS ty, json_extract_string(v, '$.k') AS s FROM e)
    SELECT event_id, {value} AS k FROM f WHERE {kinds}"""


def _lenient_sql(doc: str, value: str) -> str:
    return f"""WITH d AS ({derived_sql(doc)}), f AS (SELECT event_id,
      json_type(doc, '$.k') AS ty, json_extract_string(doc, '$.k') AS s FROM d)
    SELECT event_id, CASE ty WHEN 'NULL' THEN NULL ELSE {value} END AS k
    FROM f WHERE ty IS NOT NULL"""


_STRICT_LONG = (
    """ty IN ('NULL', 'UBIGINT', 'BIGINT')
       OR (ty = 'DOUBLE' AND CAST(s AS DOUBLE) = floor(CAST(s AS DOUBLE)))""",
    "CAST(CAST(s AS DOUBLE) AS BIGINT)",
)
_LENIENT_WHOLE = """CASE WHEN ty = 'BOOLEAN' THEN CAST(s = 'true' AS {type})
    ELSE coalesce(CAST(trunc(try_cast(s AS DOUBLE)) AS {type}), 0) END"""
_LENIENT_REAL = """CASE WHEN ty = 'BOOLEAN' THEN CAST(s = 'true' AS {type})
    ELSE coalesce(try_cast(s AS {type}), 0) END"""


@query(
    "decode_strict",
    _nulls_apart_sql(_strict_sql(DOC, *_STRICT_LONG), "k", "0"),
)
def decode_strict_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_strict(derived(spark, folder, DOC), "k BIGINT", keep=ID)
    return _nulls_apart(rows, "k", 0)


@query(
    "decode_strict_string",
    _strict_sql(DOC_KINDS, "ty IN ('NULL', 'VARCHAR')", "s"),
)
def decode_strict_string(spark: SparkSession, folder: str) -> DataFrame:
    return decode_strict(derived(spark, folder, DOC_KINDS), "k STRING", keep=ID)


@query(
    "decode_strict_double",
    _strict_sql(
        DOC_KINDS, "ty IN ('NULL', 'UBIGINT', 'BIGINT', 'DOUBLE')", "CAST(s AS DOUBLE)"
    ),
)
def decode_strict_double(spark: SparkSession, folder: str) -> DataFrame:
    return decode_strict(derived(spark, folder, DOC_KINDS), "k DOUBLE", keep=ID)


@query(
    "decode_strict_float",
    _strict_sql(DOC_KINDS, "ty IN ('NULL', 'UBIGINT', 'BIGINT', 'DOUBLE')", "CAST(s AS FLOAT)")
)
def decode_strict_float(spark: SparkSession, folder: str) -> DataFrame:
    return decode_strict(derived(spark, folder, DOC_KINDS), "k FLOAT", keep=ID)


@query(
    "decode_strict_boolean",
    _nulls_apart_sql(
        _strict_sql(DOC_KINDS, "ty IN ('NULL', 'BOOLEAN')", "CAST(s AS BOOLEAN)"), "k", "FALSE"
    ),
)
def decode_strict_boolean(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_strict(derived(spark, folder, DOC_KINDS), "k BOOLEAN", keep=ID)
    return _nulls_apart(rows, "k", False)


@query(
    "decode_lenient",
    _nulls_apart_sql(_lenient_sql(DOC, _LENIENT_WHOLE.format(type="BIGINT")), "k", "0"),
)
def decode_lenient_long(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_lenient(derived(spark, folder, DOC), "k BIGINT", "doc", keep=ID)
    return _nulls_apart(rows, "k", 0)


@query(
    "decode_lenient_integer",
    _nulls_apart_sql(_lenient_sql(DOC_KINDS, _LENIENT_WHOLE.format(type="INTEGER")), "k", "0"),
)
def decode_lenient_integer(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_lenient(derived(spark, folder, DOC_KINDS), "k INT", "doc", keep=ID)
    return _nulls_apart(rows, "k", 0)


@query(
    "decode_lenient_string",
    _lenient_sql(DOC_KINDS, "CASE WHEN ty IN ('OBJECT', 'ARRAY') THEN '' ELSE s END"),
)
def decode_lenient_string(spark: SparkSession, folder: str) -> DataFrame:
    return decode_lenient(derived(spark, folder, DOC_KINDS), "k STRING", "doc", keep=ID)


@query(
    "decode_lenient_double",
    _lenient_sql(DOC_KINDS, _LENIENT_REAL.format(type="DOUBLE")),
)
def decode_lenient_double(spark: SparkSession, folder: str) -> DataFrame:
    return decode_lenient(derived(spark, folder, DOC_KINDS), "k DOUBLE", "doc", keep=ID)


@query(
    "decode_lenient_float",
    _lenient_sql(DOC_KINDS, _LENIENT_REAL.format(type="FLOAT")),
)
def decode_lenient_float(spark: SparkSession, folder: str) -> DataFrame:
    return decode_lenient(derived(spark, folder, DOC_KINDS), "k FLOAT", "doc", keep=ID)


@query(
    "decode_lenient_boolean",
    _nulls_apart_sql(
        _lenient_sql(
            DOC_KINDS,
            """CASE WHEN ty IN ('BOOLEAN', 'VARCHAR') THEN s = 'true'
               WHEN ty IN ('UBIGINT', 'BIGINT') THEN CAST(s AS BIGINT) <> 0 ELSE FALSE END""",
        ),
        "k",
        "FALSE",
    ),
)
def decode_lenient_boolean(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_lenient(derived(spark, folder, DOC_KINDS), "k BOOLEAN", "doc", keep=ID)
    return _nulls_apart(rows, "k", False)


@query(
    "decode_edge_numbers",
    f"""WITH d AS ({derived_sql(DOC_EDGES)}), f AS (SELECT event_id,
      json_extract_string(doc, '$.whole') AS w, json_extract_string(doc, '$.real') AS r FROM d)
    SELECT event_id, coalesce(try_cast(CASE WHEN w SIMILAR TO '-?[0-9]+' THEN w END AS BIGINT),
      CAST(CAST(w AS DOUBLE) AS BIGINT)) AS whole, CAST(r AS DOUBLE) AS "real" FROM f""",
)
def decode_edge_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return decode_strict(derived(spark, folder, DOC_EDGES), "whole BIGINT, real DOUBLE", keep=ID)


_RECORD = "id BIGINT, type STRING, user BIGINT"


def _record_sql(kept: str) -> str:
    return f"""WITH d AS ({derived_sql(DOC_RECORD)}), f AS (SELECT event_id,
      json_type(doc, '$.id') AS t1, json_type(doc, '$.type') AS t2,
      json_type(doc, '$.user') AS t3, json_extract_string(doc, '$.id') AS id,
      json_extract_string(doc, '$.type') AS type, json_extract_string(doc, '$.user') AS user
      FROM d)
    SELECT event_id, CAST(id AS BIGINT) AS id, type, CAST(f.user AS BIGINT) AS user
    FROM f WHERE {kept}"""


@query(
    "drop_incomplete_strict",
    _record_sql(
        """t1 IN ('UBIGINT', 'BIGINT', 'NULL') AND t2 IN ('VARCHAR', 'NULL')
           AND t3 IN ('UBIGINT', 'BIGINT', 'NULL')"""
    ),
)
def drop_incomplete_strict(spark: SparkSession, folder: str) -> DataFrame:
    return decode_strict(derived(spark, folder, DOC_RECORD), _RECORD, keep=ID)


@query(
    "drop_incomplete_lenient",
    _record_sql("t1 IS NOT NULL AND t2 IS NOT NULL AND t3 IS NOT NULL"),
)
def drop_incomplete_lenient(spark: SparkSession, folder: str) -> DataFrame:
    return decode_lenient(derived(spark, folder, DOC_RECORD), _RECORD, "doc", keep=ID)


_NESTED = "o STRUCT<p: STRING, q: BIGINT>, a ARRAY<BIGINT>"


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(
        "event_id",
        F.col("o").isNull().alias("o_is_null"),
        F.col("o.p").alias("o_p"),
        F.col("o.q").alias("o_q"),
        F.array_join("a", ",", "null").alias("a"),
    )


_WHOLE = """(json_type({0}) IN ('UBIGINT', 'BIGINT') OR (json_type({0}) = 'DOUBLE'
    AND CAST(json_extract_string({0}, '$') AS DOUBLE)
        = floor(CAST(json_extract_string({0}, '$') AS DOUBLE))))"""
_AS_LONG = "CAST(CAST(json_extract_string({0}, '$') AS DOUBLE) AS BIGINT)"


@query(
    "decode_strict_nested",
    _nulls_apart_sql(
        f"""WITH d AS ({derived_sql(DOC_NESTED)}), e AS ({_ELEMENTS}), f AS (SELECT event_id,
          json_extract(v, '$.o') AS o, json_extract(v, '$.o.p') AS p, json_extract(v, '$.o.q') AS q,
          json_extract(v, '$.a') AS a FROM e)
        SELECT event_id, json_type(o) = 'NULL' AS o_is_null,
          CASE WHEN json_type(p) = 'VARCHAR' THEN json_extract_string(p, '$') END AS o_p,
          CASE WHEN {_WHOLE.format('q')} THEN {_AS_LONG.format('q')} END AS o_q,
          CASE WHEN json_type(a) = 'ARRAY' THEN array_to_string(list_transform(
            json_extract(a, '$[*]'), lambda x: coalesce(CASE WHEN {_WHOLE.format('x')}
            THEN CAST({_AS_LONG.format('x')} AS VARCHAR) END, 'null')), ',') END AS a
        FROM f WHERE json_type(o) IN ('NULL', 'OBJECT') AND json_type(a) IN ('NULL', 'ARRAY')""",
        "o_q",
        "0",
    ),
)
def decode_strict_nested(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_strict(derived(spark, folder, DOC_NESTED), _NESTED, keep=ID)
    return _nulls_apart(_flat(rows), "o_q", 0)


_TO_LONG = """CASE json_type({0}) WHEN 'NULL' THEN NULL
    WHEN 'BOOLEAN' THEN CAST(json_extract_string({0}, '$') = 'true' AS BIGINT)
    WHEN 'OBJECT' THEN 0 WHEN 'ARRAY' THEN 0
    ELSE coalesce(CAST(trunc(try_cast(json_extract_string({0}, '$') AS DOUBLE)) AS BIGINT), 0)
    END"""


@query(
    "decode_lenient_nested",
    _nulls_apart_sql(
        f"""WITH d AS ({derived_sql(DOC_NESTED)}), f AS (SELECT event_id,
          json_extract(doc, '$.o') AS o, json_extract(doc, '$.o.p') AS p,
          json_extract(doc, '$.o.q') AS q, json_extract(doc, '$.a') AS a FROM d)
        SELECT event_id, json_type(o) <> 'OBJECT' AS o_is_null,
          CASE WHEN json_type(p) = 'NULL' THEN NULL WHEN json_type(p) IN ('OBJECT', 'ARRAY') THEN ''
            ELSE json_extract_string(p, '$') END AS o_p,
          CASE WHEN q IS NOT NULL THEN {_TO_LONG.format('q')} END AS o_q,
          CASE WHEN json_type(a) = 'ARRAY' THEN array_to_string(list_transform(
            json_extract(a, '$[*]'),
            lambda x: coalesce(CAST({_TO_LONG.format('x')} AS VARCHAR), 'null')), ',') END AS a
        FROM f WHERE o IS NOT NULL AND a IS NOT NULL""",
        "o_q",
        "0",
    ),
)
def decode_lenient_nested(spark: SparkSession, folder: str) -> DataFrame:
    rows = decode_lenient(derived(spark, folder, DOC_NESTED), _NESTED, "doc", keep=ID)
    return _nulls_apart(_flat(rows), "o_q", 0)


# -------------------------------------------------------------- inference


@query(
    "infer_majority_schema",
    f"""WITH d AS ({derived_sql(DOC)}),
    sample AS (SELECT * FROM d ORDER BY event_id LIMIT 50),
    votes AS (SELECT event_id, json_type(doc, CASE WHEN json_type(doc) = 'ARRAY'
        THEN '$[0].k' ELSE '$.k' END) AS ty, json_type(doc, '$.j') AS tj FROM sample),
    named AS (SELECT event_id, CASE WHEN tj IS NOT NULL THEN 'j BIGINT'
        ELSE 'k ' || CASE WHEN ty IN ('VARCHAR', 'NULL') THEN 'STRING'
          WHEN ty IN ('UBIGINT', 'BIGINT') THEN 'BIGINT' ELSE ty END END AS found FROM votes),
    winner AS (SELECT found FROM named WHERE found IS NOT NULL
        GROUP BY found ORDER BY count(*) DESC, min(event_id) LIMIT 1),
    e AS ({_ELEMENTS})
    SELECT event_id, found AS inferred, json_extract_string(v, '$.k') AS k FROM e, winner
    WHERE found = 'k STRING' AND json_type(v, '$.k') IN ('VARCHAR', 'NULL')""",
)
def infer_majority(spark: SparkSession, folder: str) -> DataFrame:
    docs = derived(spark, folder, DOC)
    schema = infer_majority_schema(docs.orderBy("event_id"))
    rows = decode_strict(docs, schema, keep=ID)
    return rows.withColumn("inferred", F.lit(_ddl(schema)))


def _ddl(schema) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString().upper()}" for f in schema.fields)


@query(
    "infer_first_message_schema",
    f"""WITH log AS ({EVENT_LOG_SQL}), first AS (SELECT CASE WHEN json_type(text, '$.k') IN
        ('UBIGINT', 'BIGINT') THEN 'k BIGINT' END AS found FROM log
        WHERE length(trim(text)) > 0 ORDER BY ledger_id, entry_id, partition_index LIMIT 1)
    SELECT ledger_id, entry_id, found AS inferred,
      CAST(json_extract(text, '$.k') AS BIGINT) AS k
    FROM log, first WHERE length(trim(text)) > 0""",
)
def infer_first_message(spark: SparkSession, folder: str) -> DataFrame:
    options = stored_log(spark, folder)
    schema = infer_log_schema(spark, options)
    rows = read_log(spark, options, schema, keep=["ledger_id", "entry_id"])
    return rows.withColumn("inferred", F.lit(_ddl(schema)))


# ---------------------------------------------------------------- encoder


@query(
    "encode_rows",
    """SELECT doc_id, CAST(to_json({'doc_id': doc_id, 'text': text, 'lang': lang,
      'source': source, 'n_chars': n_chars}) AS VARCHAR) AS doc FROM documents""",
)
def encode_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return encode_documents(rows, keep=["doc_id"])


@query(
    "encode_nonfinite",
    """SELECT p_partkey, CASE WHEN p_partkey % 7 IN (0, 1, 2) THEN NULL
      ELSE p_retailprice END AS price, p_partkey % 7 IN (0, 1, 2) AS wrote_null FROM part""",
)
def encode_nonfinite(spark: SparkSession, folder: str) -> DataFrame:
    price = F.expr(
        """CASE p_partkey % 7 WHEN 0 THEN DOUBLE('NaN') WHEN 1 THEN DOUBLE('Infinity')
           WHEN 2 THEN DOUBLE('-Infinity') ELSE p_retailprice END"""
    )
    rows = table(spark, folder, "part").select("p_partkey", price.alias("price"))
    encoded = encode_documents(rows).withColumn("wrote_null", F.col("doc").endswith('"price":null}'))
    return decode_strict(encoded, "p_partkey BIGINT, price DOUBLE", keep=["wrote_null"])


@query(
    "encode_nested",
    """SELECT vec_id, i AS position, embedding[i] AS x, label FROM (SELECT vec_id, label,
      embedding, CAST(unnest(range(1, len(embedding) + 1)) AS BIGINT) AS i FROM embeddings)""",
)
def encode_nested(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.struct("embedding", "label").alias("body")
    )
    schema = "vec_id BIGINT, body STRUCT<embedding: ARRAY<FLOAT>, label: INT>"
    back = decode_lenient(encode_documents(rows), schema, "doc")
    return back.select(
        "vec_id", F.posexplode("body.embedding").alias("i", "x"), F.col("body.label").alias("label")
    ).select("vec_id", (F.col("i") + 1).cast("bigint").alias("position"), "x", "label")


# ---------------------------------------------------------------- offsets


_OFFSET = {"last_ledger_id": "bigint", "last_entry_id": "bigint", "last_partition_index": "int"}


@query(
    "log_offsets",
    f"""WITH log AS ({EVENT_LOG_SQL}), a AS (SELECT * FROM log ORDER BY ledger_id, entry_id,
      partition_index LIMIT 1), z AS (SELECT * FROM log ORDER BY ledger_id DESC, entry_id DESC,
      partition_index DESC LIMIT 1)
    SELECT a.ledger_id AS first_ledger_id, a.entry_id AS first_entry_id,
      a.partition_index AS first_partition_index, z.ledger_id AS last_ledger_id,
      z.entry_id AS last_entry_id, z.partition_index AS last_partition_index FROM a, z""",
)
def log_offsets(spark: SparkSession, folder: str) -> DataFrame:
    options = stored_log(spark, folder)
    last = latest_offset(spark, options)
    names = [f"last_{name}" for name in Offset._fields]
    first = offset_bounds(messages(spark, options)).drop(*names)
    return first.withColumns({n: F.lit(v).cast(_OFFSET[n]) for n, v in zip(names, last)})


# A start inside the first ledger; the end is the last message.
_START = Offset(0, 499, 0)


@query(
    "log_range_scan",
    f"""WITH log AS ({EVENT_LOG_SQL})
    SELECT ledger_id, entry_id, CAST(json_extract(text, '$.k') AS BIGINT) AS k FROM log
    WHERE (ledger_id, entry_id, partition_index) > {tuple(_START)}""",
)
def log_range_scan(spark: SparkSession, folder: str) -> DataFrame:
    options = stored_log(spark, folder)
    end = latest_offset(spark, options)
    return read_log(spark, options, "k BIGINT", _START, end, keep=["ledger_id", "entry_id"])


# Both ends are inside a ledger that two writers share.
_BETWEEN = Offset(0, 99, 1), Offset(5, 250, 0)


@query(
    "log_range_of_two_writers",
    f"""WITH log AS ({EVENT_LOG_OF_TWO_SQL})
    SELECT partition_index, ledger_id, entry_id, CAST(json_extract(text, '$.k') AS BIGINT) AS k
    FROM log WHERE (ledger_id, entry_id, partition_index) > {tuple(_BETWEEN[0])}
      AND (ledger_id < {_BETWEEN[1].ledger_id} OR (ledger_id = {_BETWEEN[1].ledger_id}
        AND (entry_id < {_BETWEEN[1].entry_id} OR (entry_id = {_BETWEEN[1].entry_id}
          AND partition_index <= {_BETWEEN[1].partition_index}))))""",
)
def log_range_of_two_writers(spark: SparkSession, folder: str) -> DataFrame:
    options = stored_log_of_two(spark, folder)
    keep = ["partition_index", "ledger_id", "entry_id"]
    return read_log(spark, options, "k BIGINT", *_BETWEEN, keep=keep)


@query(
    "log_offset_json",
    f"""WITH log AS ({EVENT_LOG_SQL})
    SELECT CAST(to_json({{'ledgerId': ledger_id, 'entryId': entry_id,
      'partitionIndex': partition_index}}) AS VARCHAR) AS text, TRUE AS same FROM log""",
)
def log_offset_json(spark: SparkSession, folder: str) -> DataFrame:
    ids = [F.col(c) for c in ("ledger_id", "entry_id", "partition_index")]
    texts = event_log(spark, folder).select(*ids, offset_to_json(*ids).alias("text"))
    same = offset_from_json(F.col("text")) == offset_struct()
    return texts.select("text", same.alias("same"))


# ---------------------------------------------------------------- appends


def _scratch_collection(spark: SparkSession, name: str, **more: object) -> dict[str, object]:
    return {"regionUrl": scratch_folder(spark), "fabric": "_system", "collection": name, **more}


_CUSTOMER = "c_custkey BIGINT, c_name STRING, origin STRING"


@query(
    "keyed_append_new_only",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'stored'
      ELSE 'batch' END AS origin FROM customer""",
)
def keyed_append_new_only(spark: SparkSession, folder: str) -> DataFrame:
    options = _scratch_collection(spark, "customers", primaryKey="c_custkey", batchSize=10000)
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    stored = customers.where("c_mktsegment = 'BUILDING'").withColumn("origin", F.lit("stored"))
    append_collection(stored, options)
    append_collection(customers.withColumn("origin", F.lit("batch")), options)
    return read_collection(spark, options, _CUSTOMER)


@query(
    "keyed_append_in_folders",
    """SELECT c_custkey, c_name, CASE WHEN c_mktsegment = 'BUILDING' THEN 'stored'
      ELSE 'batch' END AS origin FROM customer""",
)
def keyed_append_in_folders(spark: SparkSession, folder: str) -> DataFrame:
    options = _scratch_collection(spark, "customers", primaryKey="c_custkey", keyBuckets=8)
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    stored = customers.where("c_mktsegment = 'BUILDING'").withColumn("origin", F.lit("stored"))
    append_collection(stored, options)
    append_collection(customers.withColumn("origin", F.lit("batch")), options)
    return read_collection(spark, options, _CUSTOMER)


@query(
    "keyed_append_two_writers",
    "SELECT c_custkey, c_name FROM customer",
)
def keyed_append_two_writers(spark: SparkSession, folder: str) -> DataFrame:
    """Two appends at the same time, each of two thirds of the customers."""
    options = _scratch_collection(spark, "customers", primaryKey="c_custkey")
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_mktsegment")
    parts = [customers.where(f"c_custkey % 3 <> {i}") for i in (0, 1)]
    with ThreadPoolExecutor(len(parts)) as pool:
        list(pool.map(lambda rows: append_collection(rows, options), parts))
    return read_collection(spark, options, "c_custkey BIGINT, c_name STRING")


@query(
    "keyed_append_dedupe",
    """SELECT CAST(json_extract(doc, '$.o_custkey') AS BIGINT) AS o_custkey,
      CAST(json_extract(doc, '$.o_orderkey') AS BIGINT) AS o_orderkey,
      json_extract_string(doc, '$.o_orderpriority') AS o_orderpriority
    FROM (SELECT min(CAST(to_json({'o_custkey': o_custkey, 'o_orderpriority': o_orderpriority,
        'o_orderkey': o_orderkey}) AS VARCHAR)) AS doc FROM orders GROUP BY o_custkey)""",
)
def keyed_append_dedupe(spark: SparkSession, folder: str) -> DataFrame:
    options = _scratch_collection(spark, "orders", primaryKey="o_custkey")
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderpriority", "o_orderkey")
    append_collection(orders, options)
    schema = "o_custkey BIGINT, o_orderkey BIGINT, o_orderpriority STRING"
    return read_collection(spark, options, schema)


@query(
    "collection_append_roundtrip",
    """SELECT p_retailprice AS number, p_name, CAST(p_size AS BIGINT) AS p_size,
      TRUE AS random_in_range FROM part""",
)
def collection_append_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    options = _scratch_collection(spark, "parts", batchSize=1000)
    parts = table(spark, folder, "part").select("p_retailprice", "p_name", "p_size")
    renamed = parts.withColumnRenamed("p_retailprice", "number")
    append_collection(renamed.withColumn("randomNumber", F.rand()), options)
    back = read_collection(spark, options)
    in_range_ = (F.col("randomNumber") >= 0) & (F.col("randomNumber") < 1)
    return back.select("number", "p_name", "p_size", in_range_.alias("random_in_range"))
