"""The decoders against the table of cases and against a model in plain Python."""

from __future__ import annotations

import json
import random

import pytest

from doclog import array_results, decode_lenient, decode_strict
from doclog.operators import decode

DROP = "drop"

# document, then what strict and lenient give for Long, String and Double
CASES = [
    ('{"k":69}', 69, 69, DROP, "69", 69.0, 69.0),
    ('{"k":null}', None, None, None, None, None, None),
    ("{}", DROP, DROP, DROP, DROP, DROP, DROP),
    ('{"k":"12"}', DROP, 12, "12", "12", DROP, 12.0),
    ('{"k":"abc"}', DROP, 0, "abc", "abc", DROP, 0.0),
    ('{"k":1.9}', DROP, 1, DROP, "1.9", 1.9, 1.9),
    ('{"k":2.0}', 2, 2, DROP, "2.0", 2.0, 2.0),
    ('{"k":true}', DROP, 1, DROP, "true", DROP, 1.0),
    ('{"k":{"x":1}}', DROP, 0, DROP, "", DROP, 0.0),
    ("7", DROP, DROP, DROP, DROP, DROP, DROP),
    # beyond the table: numbers in other forms, and texts that look like them
    ('{"k":-1.9}', DROP, -1, DROP, "-1.9", -1.9, -1.9),
    ('{"k":1e3}', 1000, 1000, DROP, "1000.0", 1000.0, 1000.0),
    ('{"k":100.0}', 100, 100, DROP, "100.0", 100.0, 100.0),
    ('{"k":9223372036854775807}', 2**63 - 1, 2**63 - 1, DROP, "9223372036854775807",
     float(2**63 - 1), float(2**63 - 1)),
    ('{"k":9223372036854775808}', DROP, None, DROP, "9223372036854775808",
     float(2**63), float(2**63)),
    ('{"k":1234567890123456789.5}', DROP, 1234567890123456789, DROP, "1.23456789012345677E18",
     1234567890123456789.5, 1234567890123456789.5),
    ('{"k":1e300}', DROP, None, DROP, "1.0E300", 1e300, 1e300),
    ('{"k":[1]}', DROP, 0, DROP, "", DROP, 0.0),
    ('{"k":[]}', DROP, 0, DROP, "", DROP, 0.0),
    ('{"k":"1.9"}', DROP, 1, "1.9", "1.9", DROP, 1.9),
    ('{"k":" 12 "}', DROP, 12, " 12 ", " 12 ", DROP, 12.0),
    ('{"k":"1e3"}', DROP, 1000, "1e3", "1e3", DROP, 1000.0),
    ('{"k":"inf"}', DROP, 0, "inf", "inf", DROP, 0.0),
    ('{"k":""}', DROP, 0, "", "", DROP, 0.0),
    ('{"k":1,"k":2}', 2, 2, DROP, "2", 2.0, 2.0),
    ('{"K":1}', DROP, DROP, DROP, DROP, DROP, DROP),
    ('{"j":1,"k":5,"l":{"k":6}}', 5, 5, DROP, "5", 5.0, 5.0),
]


def frame(spark, docs):
    return spark.createDataFrame(list(enumerate(docs)), "i int, doc string").coalesce(1)


def strict(spark, docs, type_):
    found = {}
    for row in decode_strict(frame(spark, docs), f"k {type_}", keep=["i"]).collect():
        found.setdefault(row.i, []).append(row.k)
    return [found.get(i, []) for i in range(len(docs))]


def lenient(spark, docs, type_):
    rows = decode_lenient(frame(spark, docs), f"k {type_}", "doc", keep=["i"]).collect()
    found = {row.i: row.k for row in rows}
    assert len(found) == len(rows)
    return [found.get(i, DROP) for i in range(len(docs))]


@pytest.fixture(autouse=True, params=[0, decode.DIRECT_FROM], ids=["by_type", "as_variants"])
def both_ways(request, monkeypatch):
    """Narrow schemas read by type, as wide ones are, and as variants."""
    monkeypatch.setattr(decode, "DIRECT_FROM", request.param)


@pytest.mark.parametrize("at, type_", [(1, "BIGINT"), (3, "STRING"), (5, "DOUBLE")])
def test_table_of_cases(spark, at, type_):
    docs = [c[0] for c in CASES]
    assert strict(spark, docs, type_) == [[] if c[at] == DROP else [c[at]] for c in CASES]
    assert lenient(spark, docs, type_) == [c[at + 1] for c in CASES]


def test_boolean(spark):
    docs = ['{"k":true}', '{"k":false}', '{"k":null}', '{"k":"true"}', '{"k":"True"}',
            '{"k":"x"}', '{"k":1}', '{"k":0}', '{"k":1.5}', '{"k":{}}', '{"k":[true]}', "{}"]
    assert strict(spark, docs, "BOOLEAN") == [[True], [False], [None]] + [[]] * 9
    assert lenient(spark, docs, "BOOLEAN") == [
        True, False, None, True, False, False, True, False, False, False, False, DROP]


def test_integer_is_lenient_only(spark):
    docs = ['{"k":1}', '{"k":null}', '{"k":"3000000000"}', '{"k":3000000000}', '{"k":-2.7}']
    assert strict(spark, docs, "INT") == [[]] * 5
    assert lenient(spark, docs, "INT") == [1, None, 0, None, -2]


def test_float(spark):
    docs = ['{"k":1.5}', '{"k":"1.5"}', '{"k":1e300}', '{"k":true}']
    assert strict(spark, docs, "FLOAT") == [[1.5], [], [float("inf")], []]
    assert lenient(spark, docs, "FLOAT") == [1.5, 1.5, float("inf"), 1.0]


def test_void(spark):
    docs = ['{"k":1}', '{"k":null}', "{}"]
    assert strict(spark, docs, "VOID") == [[], [None], []]
    assert lenient(spark, docs, "VOID") == [None, None, DROP]


@pytest.mark.parametrize("type_", ["DATE", "DECIMAL(5,2)", "MAP<STRING,STRING>", "SMALLINT"])
def test_types_without_a_rule(spark, type_):
    assert strict(spark, ['{"k":1}', '{"k":null}'], type_) == [[], []]
    assert lenient(spark, ['{"k":null}', "{}"], type_) == [None, DROP]
    with pytest.raises(Exception, match="Unsupported data type"):
        lenient(spark, ['{"k":1}'], type_)


def test_arrays_of_documents(spark):
    docs = ['[{"k":1},{"k":2}]', '[1,{"k":3}]', "[]", "[[{\"k\":4}]]", '[null,{"k":null}]']
    assert strict(spark, docs, "BIGINT") == [[1, 2], [3], [], [], [None]]
    assert lenient(spark, docs, "BIGINT") == [DROP] * 5
    results = array_results(frame(spark, docs + ["7", '{"k":1}']), keep=["i"])
    assert [r.i for r in results.orderBy("i").collect()] == [0, 0, 1, 1, 3, 4, 4, 5, 6]


@pytest.mark.parametrize("text", ["not json", '{"k":1', "{'k':1}", '{"k":NaN}', '{"k":01}', "[1,"])
def test_text_that_is_not_json_raises(spark, text):
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        strict(spark, ['{"k":1}', text], "BIGINT")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        lenient(spark, ['{"k":1}', text], "BIGINT")


def test_blank_messages_are_dropped(spark):
    assert lenient(spark, ["", " \t\r\n", '{"k":1}'], "BIGINT") == [DROP, DROP, 1]
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        strict(spark, [""], "BIGINT")


def test_nulls_in_place_of_documents(spark):
    assert strict(spark, [None, '{"k":1}'], "BIGINT") == [[], [1]]
    assert lenient(spark, [None, '{"k":1}'], "BIGINT") == [DROP, 1]


def test_bytes_that_are_not_utf8(spark):
    rows = spark.createDataFrame([(bytearray(b'{"k":"a\xffb"}'),)], "payload binary")
    assert decode_lenient(rows, "k STRING").first().k == "a�b"


def test_awkward_names(spark):
    names = ["a.b", "it's", 'say "x"', "x[0]", "$", " ", "e?", "both ' and \"", "ß", "a`b"]
    doc = json.dumps({n: i for i, n in enumerate(names)}, ensure_ascii=False)
    ddl = ", ".join("`" + n.replace("`", "``") + "` BIGINT" for n in names)
    assert list(decode_strict(frame(spark, [doc]), ddl).first()) == list(range(len(names)))
    assert list(decode_lenient(frame(spark, [doc]), ddl, "doc").first()) == list(range(len(names)))


@pytest.mark.parametrize("decode", [decode_strict, decode_lenient])
def test_names_that_differ_in_case_only(spark, decode):
    from pyspark.sql.types import LongType, StructField, StructType

    schema = StructType([StructField(n, LongType()) for n in ("k", "K", "j")])
    docs = ['{"k":1,"K":2,"j":3}', '{"K":4,"j":null,"k":5}', '{"k":6,"j":7}']
    rows = decode(frame(spark, docs), schema, "doc").collect()
    assert sorted(map(tuple, rows), key=repr) == [(1, 2, 3), (5, 4, None)]


@pytest.mark.parametrize("decode", [decode_strict, decode_lenient])
def test_any_column_can_be_carried(spark, decode):
    docs = frame(spark, ['{"k":1,"s":"x"}', '{"k":null,"s":"y"}']).selectExpr(
        "doc", "i AS result", "i + 10 AS `_t0`", "i + 20 AS `a.b`")
    rows = decode(docs, "k BIGINT, s STRING", "doc", keep=["result", "_t0", "a.b", "doc"]).collect()
    assert sorted(tuple(r)[:3] + tuple(r)[4:] for r in rows) == [
        (0, 10, 20, 1, "x"), (1, 11, 21, None, "y")]


def test_the_record_of_malformed_text_is_a_field_like_any(spark):
    docs = frame(spark, ['{"_corrupt_record":"a","k":1}'])
    schema = "_corrupt_record STRING, k BIGINT"
    assert tuple(decode_strict(docs, schema).first()) == ("a", 1)
    assert tuple(decode_lenient(docs, schema, "doc").first()) == ("a", 1)


# enough numbers for them to be read directly, and a field named twice
REPEATED = [
    ('{"a":1,"b":2,"c":3}', (1, 2, 3), (1, 2, 3)),
    ('{"a":1,"b":2,"c":3,"a":4}', (4, 2, 3), (4, 2, 3)),
    ('{"a":1,"b":2,"c":3,"a":null}', (None, 2, 3), (None, 2, 3)),
    ('{"a":null,"b":2,"c":3,"a":5}', (5, 2, 3), (5, 2, 3)),
    ('{"a":1,"b":2,"c":3,"a":"6"}', None, (6, 2, 3)),
    ('{"a":1,"b":2,"c":3,"a":"x"}', None, (0, 2, 3)),
    ('{"a":"x","b":2,"c":3,"a":7}', (7, 2, 3), (7, 2, 3)),
    ('{"a":8.0,"b":2,"c":3}', (8, 2, 3), (8, 2, 3)),
    ('{"a":1,"b":2,"c":3,"d":{"a":"y"}}', (1, 2, 3), (1, 2, 3)),
]


def test_repeated_names_read_directly(spark):
    docs, schema = frame(spark, [c[0] for c in REPEATED]), "a BIGINT, b BIGINT, c BIGINT"
    got = {r.i: tuple(r)[1:] for r in decode_strict(docs, schema, keep=["i"]).collect()}
    assert got == {i: c[1] for i, c in enumerate(REPEATED) if c[1]}
    got = {r.i: tuple(r)[1:] for r in decode_lenient(docs, schema, "doc", keep=["i"]).collect()}
    assert got == {i: c[2] for i, c in enumerate(REPEATED)}


@pytest.mark.parametrize("decode", [decode_strict, decode_lenient])
@pytest.mark.parametrize("tail", ['"d":tru}', '"d":01}', '"d":1', '"d":"x', '"d":{"e":1}', '"d":NaN}'])
def test_text_that_is_malformed_after_all_fields_raises(spark, decode, tail):
    docs = frame(spark, ['{"a":1,"b":2,"c":3}', '{"a":1,"b":2,"c":3,' + tail])
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        decode(docs, "a BIGINT, b BIGINT, c BIGINT", "doc").collect()


def test_empty_schema_keeps_every_row(spark):
    from pyspark.sql.types import StructType

    docs = frame(spark, ['{"k":1}', "7", "[1,2]"])
    assert decode_strict(docs, StructType()).count() == 4
    assert decode_lenient(docs, StructType(), "doc").count() == 3


def test_deep_and_wide_schemas(spark):
    depth, value = 12, {"v": 1}
    ddl = "v BIGINT"
    for _ in range(depth):
        value, ddl = {"v": value}, f"v STRUCT<{ddl.replace(' ', ': ', 1)}>"
    row = decode_strict(frame(spark, [json.dumps(value)]), ddl).first()
    for _ in range(depth):
        row = row.v
    assert row.v == 1
    wide = {f"f{i}": i for i in range(300)}
    ddl = ", ".join(f"{n} BIGINT" for n in wide)
    for rows in (
        decode_strict(frame(spark, [json.dumps(wide)]), ddl),
        decode_lenient(frame(spark, [json.dumps(wide)]), ddl, "doc"),
    ):
        assert rows.first().asDict() == wide


# ------------------------------------------------------- a model, row by row

# what is read directly differs: the last has no text, the one before one number only
SCHEMAS = [
    "n BIGINT, s STRING, b BOOLEAN, d DOUBLE, a ARRAY<BIGINT>, "
    "o STRUCT<p: STRING, q: STRUCT<r: BIGINT, t: ARRAY<STRING>>>, "
    "x ARRAY<STRUCT<y: BIGINT, z: BOOLEAN>>",
    "n BIGINT, s STRING, o STRUCT<p: STRING, q: STRUCT<t: ARRAY<STRING>>>",
    "n BIGINT, b BOOLEAN, d DOUBLE, a ARRAY<ARRAY<DOUBLE>>, "
    "o STRUCT<p: DOUBLE, q: STRUCT<r: BIGINT, t: ARRAY<BOOLEAN>>>, "
    "x ARRAY<STRUCT<y: BIGINT, z: ARRAY<BIGINT>>>",
]


def java_double(value: float) -> str:
    return repr(float(value))  # equal for the plain numbers used below


def model_strict(value, data_type):
    """(fits, value) of one value under the strict rule."""
    name = data_type.typeName()
    if value is None:
        return True, None
    if name == "string":
        return isinstance(value, str), value
    if name == "boolean":
        return isinstance(value, bool), value
    if name in ("double", "long"):
        number = isinstance(value, (int, float)) and not isinstance(value, bool)
        if name == "double":
            return number, float(value) if number else None
        whole = number and float(value).is_integer()
        return whole, int(value) if whole else None
    if name == "array":
        if not isinstance(value, list):
            return False, None
        parts = [model_strict(v, data_type.elementType) for v in value]
        return True, [v if fits else None for fits, v in parts]
    if not isinstance(value, dict):
        return False, None
    parts = [model_strict(value.get(f.name), f.dataType) for f in data_type.fields]
    return True, tuple(v if fits else None for fits, v in parts)


def model_lenient(value, data_type):
    name = data_type.typeName()
    if value is None:
        return None
    if name == "array":
        if not isinstance(value, list):
            return None
        return [model_lenient(v, data_type.elementType) for v in value]
    if name == "struct":
        if not isinstance(value, dict):
            return None
        return tuple(model_lenient(value.get(f.name), f.dataType) for f in data_type.fields)
    nested = isinstance(value, (list, dict))
    if name == "string":
        if isinstance(value, bool):
            return "true" if value else "false"
        return "" if nested else java_double(value) if isinstance(value, float) else str(value)
    if name == "boolean":
        if isinstance(value, str):
            return value == "true"
        return bool(value) if isinstance(value, (bool, int)) else False
    if nested:
        return 0
    try:
        number = float(value)
    except ValueError:
        number = 0.0
    return number if name == "double" else int(number)


def random_value(rng, depth):
    kind = rng.randrange(9 if depth else 7)
    if kind == 0:
        return None
    if kind == 1:
        return rng.randrange(-50, 50)
    if kind == 2:
        return rng.randrange(-400, 400) / 8
    if kind == 3:
        return rng.random() < 0.5
    if kind in (4, 5):
        return rng.choice(["", "a", "12", "-3.5", "true", "false", "é", "1x"])
    if kind == 6:
        return float(rng.randrange(5))
    if kind == 7:
        return [random_value(rng, depth - 1) for _ in range(rng.randrange(4))]
    names = rng.sample(["p", "q", "r", "t", "y", "z", "w"], rng.randrange(5))
    return {n: random_value(rng, depth - 1) for n in names}


def likely_value(rng, name):
    """Mostly a value of the right shape, so that rows survive the drop rules."""
    if rng.random() < 0.12:
        return random_value(rng, 3)
    return {
        "n": lambda: rng.randrange(100),
        "s": lambda: rng.choice(["u", "", "7"]),
        "b": lambda: rng.random() < 0.5,
        "d": lambda: rng.randrange(100) / 4,
        "a": lambda: [random_value(rng, 1) for _ in range(rng.randrange(4))],
        "o": lambda: {"p": random_value(rng, 1), "q": {
            "r": random_value(rng, 1), "t": [random_value(rng, 1) for _ in range(2)]}},
        "x": lambda: [{"y": random_value(rng, 1), "z": random_value(rng, 1)}, random_value(rng, 1)],
    }[name]()


def plain(value):
    if isinstance(value, tuple):
        return tuple(plain(v) for v in value)
    return [plain(v) for v in value] if isinstance(value, list) else value


@pytest.mark.parametrize("schema", SCHEMAS)
def test_random_documents_against_the_model(spark, schema):
    from pyspark.sql.types import StructType

    rng = random.Random(1)
    values = []
    for _ in range(600):
        doc = {n: likely_value(rng, n) for n in "nsbdaox" if rng.random() < 0.98}
        values.append(doc)
    docs = frame(spark, [json.dumps(v) for v in values])
    fields = StructType.fromDDL(schema).fields

    wanted_strict, wanted_lenient = {}, {}
    for i, doc in enumerate(values):
        if all(f.name in doc for f in fields):
            wanted_lenient[i] = tuple(model_lenient(doc[f.name], f.dataType) for f in fields)
            parts = [model_strict(doc[f.name], f.dataType) for f in fields]
            if all(fits for fits, _ in parts):
                wanted_strict[i] = tuple(v for _, v in parts)
    assert 100 < len(wanted_strict) < len(wanted_lenient) < 600

    got = {r[0]: plain(tuple(r)[1:]) for r in decode_strict(docs, schema, keep=["i"]).collect()}
    assert got == wanted_strict
    got = {r[0]: plain(tuple(r)[1:]) for r in
           decode_lenient(docs, schema, "doc", keep=["i"]).collect()}
    assert got == wanted_lenient


EDGE_VALUES = [
    "-0.0", "-0", "0.0", "1e400", "-1E400", "1e-400", "-0e5", "9223372036854775807",
    "9223372036854775808", "-9223372036854775808", "-9223372036854775809",
    "12345678901234567890123456789012345678901", "0.12345678901234567890", "1e5", "2.0", "1.50",
    '"NaN"', '"1e400"', '"Infinity"', '"\\"Infinity\\""', '"-0.0"', '"a\\u00e9\\n\\"b"', '""',
    '"12345678901234567890"', "true", "null", "[1]", "{}",
]


@pytest.mark.parametrize("decode", [decode_strict, decode_lenient])
@pytest.mark.parametrize("kind", ["BIGINT", "DOUBLE", "FLOAT", "BOOLEAN", "STRING", "ARRAY<DOUBLE>"])
def test_one_answer_whatever_else_the_schema_has(spark, decode, kind):
    docs = [
        (i, f'{{"k":{value},' + ",".join(f'"f{j}":{j}' for j in range(11)) + "}")
        for i, value in enumerate(EDGE_VALUES)
    ]
    df = spark.createDataFrame(docs, "i int, doc string")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    variants = df.selectExpr("i", "parse_json(doc) AS doc")
    answers = []
    for more in (0, 2, 11):
        schema = ", ".join([f"k {kind}", *(f"f{j} DOUBLE" for j in range(more))])
        for frame in (df, variants):
            rows = decode(frame, schema, "doc", keep=["i"]).select("i", "k").collect()
            answers.append({r.i: repr(r.k) for r in rows})
    assert all(answer == answers[0] for answer in answers), [
        (EDGE_VALUES[i], [a.get(i, "dropped") for a in answers])
        for i in range(len(docs))
        if len({a.get(i, "dropped") for a in answers}) > 1
    ]


@pytest.mark.parametrize("schema", ["k BIGINT", "k BIGINT, j STRING", "k STRING"])
@pytest.mark.parametrize("text", ['{"k":1,"j":"a"}{"k":2}', '{"k":1,"j":"a"} x', '{"k":1,"j":"a"},{"k":2}', '{"k":1'])
def test_strict_refuses_text_after_a_document(spark, schema, text):
    df = spark.createDataFrame([(text,)], "doc string")
    with pytest.raises(Exception, match="MALFORMED"):
        decode_strict(df, schema).collect()
    with pytest.raises(Exception, match="MALFORMED"):
        array_results(df).collect()


def test_strict_takes_blanks_after_a_document(spark):
    df = spark.createDataFrame([(' {"k":1,"j":"a"} \n\t',), (None,)], "doc string")
    assert [r.k for r in decode_strict(df, "k BIGINT").collect()] == [1]
