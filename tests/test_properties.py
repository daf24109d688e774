"""Scalar functions against plain Python models, on generated inputs.

One generated example is a batch of rows evaluated in one Spark job.
"""

from __future__ import annotations

import re
from datetime import datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from strata.functions.text import last_token, normalize_name
from strata.functions.time import timestamp_from_parts

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

words = st.text(alphabet="abcXYZ-.,|( ", min_size=0, max_size=12)
names = st.lists(st.sampled_from(["JAPAN", "NAN", "Nan", "CHINA", "SEA", "guinea-BISSAU", "x", " ", "nan", "ANA"]), max_size=6).map("".join)


def _initcap(text: str) -> str:
    return " ".join(w[:1].upper() + w[1:].lower() for w in text.split(" "))


@SETTINGS
@given(st.lists(st.one_of(st.none(), words), min_size=1, max_size=40), st.sampled_from([", ", ",", "|", "."]))
def test_last_token_is_the_last_split_piece(spark, texts, sep):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.x for r in df.select(last_token("t", sep).alias("x")).collect()]
    assert got == [None if t is None else t.split(sep)[-1] for t in texts]


@SETTINGS
@given(st.lists(st.one_of(st.none(), names), min_size=1, max_size=40))
def test_normalize_name_models(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select(normalize_name("t").alias("fixed"), normalize_name("t", legacy=True).alias("legacy")).collect()
    for t, r in zip(texts, rows):
        if t is None:
            assert (r.fixed, r.legacy) == (None, None)
            continue
        assert r.fixed == _initcap(t.replace("Nan", " ").lower())
        assert r.legacy == _initcap(t.lower().replace("nan", " "))


def _parts_model(y, mo, d, h, mi):
    """The text the parts make (padded to two, cut to two), parsed strictly."""

    def two(v):
        return None if v is None else str(v).rjust(2, "0")[:2]

    date = "-".join(p for p in [None if y is None else str(y), two(mo), two(d)] if p is not None)
    text = f"{date} {two(h) or '00'}:{two(mi) or '00'}"
    if not re.fullmatch(r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}", text):
        return None
    try:
        return datetime.strptime(text, "%Y-%m-%d %H:%M")
    except ValueError:
        return None


parts = st.tuples(
    st.one_of(st.none(), st.integers(1000, 9999)),
    st.one_of(st.none(), st.integers(0, 14)),
    st.one_of(st.none(), st.integers(0, 33)),
    st.one_of(st.none(), st.integers(0, 130)),
    st.one_of(st.none(), st.integers(0, 70)),
)


@SETTINGS
@given(st.lists(parts, min_size=1, max_size=40))
def test_timestamp_from_parts_model(spark, rows):
    df = spark.createDataFrame(rows, "y int, mo int, d int, h int, mi int")
    got = [r.t for r in df.select(timestamp_from_parts("y", "mo", "d", "h", "mi").alias("t")).collect()]
    assert got == [_parts_model(*r) for r in rows]
