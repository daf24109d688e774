"""JSON of unknown shape."""

from __future__ import annotations

import pytest
from pyspark.sql.types import ArrayType, BooleanType, DecimalType, DoubleType, LongType, StringType, StructField, StructType

from strata.operators.variant import found_json_schema, json_text_counts, json_unpack

ROWS = [
    (1, '{"a": 1, "l": [{"x": 1, "y": "u", "z": {"w": [1, 2]}}, {"x": 2.5}], "s": {"p": true, "q r": null, "we`ird OBJECT<": 3}}'),
    (2, '{"a": "t", "l": [], "extra": 1}'),
    (3, '{"a": '),
    (4, None),
    (5, "[1, 2]"),
    (6, ""),
    (7, '{"a": {"b": [1]}, "l": "no array"}'),
    (8, '{"l": [5, null, {"y": "v"}]}'),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(ROWS, "id int, j string").repartition(3)


def test_schema_is_found_at_every_depth(docs):
    found = found_json_schema(docs.filter("id < 3"), "j", explode="l")
    z = StructType([StructField("w", ArrayType(LongType()))])
    inner = StructType([StructField("x", DoubleType()), StructField("y", StringType()), StructField("z", z)])
    s = StructType([StructField("p", BooleanType()), StructField("q r", StringType()), StructField("we`ird OBJECT<", LongType())])
    assert found == StructType([StructField("a", StringType()), StructField("extra", LongType()), StructField("l", ArrayType(inner)), StructField("s", s)])
    exact = found_json_schema(docs.filter("id < 3"), "j", explode="l", decimals=True)
    assert isinstance(exact["l"].dataType.elementType["x"].dataType, DecimalType)
    assert found_json_schema(docs.filter("id in (3, 4, 5)"), "j") == StructType([])
    assert found_json_schema(docs.limit(0), "j") == StructType([])


def test_unpack_lifts_fields_and_elements(docs):
    out = json_unpack(docs.filter("id <> 8"), "j", keep=["id"], explode="l")
    assert out.columns == ["id", "a", "extra", "l_pos", "l_x", "l_y", "l_z_w", "s_p", "s_q r", "s_we`ird OBJECT<", "broken"]
    rows = sorted((tuple(r) for r in out.collect()), key=lambda r: (r[0], r[3] or 0))
    none = (None,) * 8
    assert rows == [
        (1, "1", None, 0, 1.0, "u", [1, 2], True, None, 3, False),
        (1, "1", None, 1, 2.5, None, None, True, None, 3, False),
        (2, "t", 1, *none[1:], False),
        (3, None, *none, True),
        (4, None, *none, False),
        (5, None, *none, False),
        (6, None, *none, True),
        (7, '{"b":[1]}', *none, False),
    ]


def test_elements_without_a_common_type_are_text(docs):
    rows = json_unpack(docs.filter("id = 8"), "j", explode="l").collect()
    assert [(r.l_pos, r.l) for r in rows] == [(0, "5"), (1, None), (2, '{"y":"v"}')]


def test_values_that_do_not_fit_a_declared_type_are_null(docs):
    declared = StructType([StructField("a", LongType()), StructField("gone", StringType())])
    rows = {r.id: (r.a, r.gone, r.broken) for r in json_unpack(docs, "j", ["id"], declared).collect()}
    assert rows[1] == (1, None, False) and rows[2] == (None, None, False) and rows[3] == (None, None, True)
    for wrong in ("a", "nothing"):
        with pytest.raises(ValueError):
            json_unpack(docs, "j", ["id"], declared, explode=wrong)
    with pytest.raises(ValueError, match="several"):
        json_unpack(docs.withColumnRenamed("id", "a"), "j", ["a"], declared)


def test_text_counts(docs):
    assert tuple(json_text_counts(docs, "j").first()) == (8, 1, 2, 1)
    assert tuple(json_text_counts(docs.limit(0), "j").first()) == (0, 0, 0, 0)
