"""Property tests: the Spark expressions agree with Python's own int(), float()
and strptime on many generated, mostly near-valid strings.

Limits of the comparison (documented differences, excluded from generation):
underscores in numbers (accepted by Python 3 only), non-ASCII digits and
whitespace, and strptime's space-padded day (`2013-01- 5`).
"""

import re
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripdemand.functions.text import float_value, is_int_text
from tripdemand.functions.time import parse_pickup

WS = st.sampled_from(["", " ", "  ", "\t", "\n", "\r", "\x0b", "\x0c"])
SIGN = st.sampled_from(["", "+", "-"])
DIGITS = st.text(alphabet="0123456789", min_size=0, max_size=4)
NOISE = st.text(alphabet="0123456789+-.eEinfatyINFATY d:x", min_size=0, max_size=8)


@st.composite
def number_text(draw):
    if draw(st.booleans()):
        return draw(NOISE)
    body = draw(st.sampled_from([
        "{i}", "{i}.{f}", ".{f}", "{i}.", "{i}e{s}{x}", "{i}.{f}E{s}{x}", "inf", "Infinity",
        "nan", "NaN", "-inf", "{i}d", "0x{i}"]))
    return (draw(WS) + draw(SIGN) + body.format(i=draw(DIGITS), f=draw(DIGITS), s=draw(SIGN),
                                                x=draw(DIGITS)) + draw(WS))


def py_int_ok(s):
    try:
        int(s)
        return True
    except ValueError:
        return False


def py_float(s):
    try:
        return float(s)
    except ValueError:
        return None


@st.composite
def pickup_text(draw):
    part = lambda lo, hi, width: draw(st.integers(lo, hi)).__format__(f"0{draw(width)}d")
    w12 = st.sampled_from([1, 2])
    year = draw(st.sampled_from(["0000", "2013", "2016", "1999", "201", "20130"]))
    text = (f"{year}-{part(0, 13, w12)}-{part(0, 32, w12)}{draw(st.sampled_from([' ', '  ', chr(9), 'T', '']))}"
            f"{part(0, 25, w12)}:{part(0, 61, w12)}:{part(0, 61, w12)}")
    return text + draw(st.sampled_from(["", "", "", " ", "x", ".5"]))


def py_strptime(s):
    try:
        return dt.datetime.strptime(s, "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None


SETTINGS = settings(max_examples=5, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.large_base_example,
                                           HealthCheck.too_slow, HealthCheck.data_too_large])


@SETTINGS
@given(st.lists(number_text(), min_size=200, max_size=200))
def test_int_and_float_agree_with_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = df.select("v", is_int_text(F.col("v")).alias("i"),
                     float_value(F.col("v")).alias("f")).collect()
    for r in rows:
        assert r.i == py_int_ok(r.v), repr(r.v)
        expected = py_float(r.v)
        if expected is None or r.f is None:
            assert expected is None and r.f is None, repr(r.v)
        elif expected != expected:
            assert r.f != r.f, repr(r.v)
        else:
            assert r.f == expected, repr(r.v)


@SETTINGS
@given(st.lists(pickup_text(), min_size=300, max_size=300))
def test_pickup_agrees_with_strptime(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    rows = df.select("v", parse_pickup(F.col("v")).alias("ts")).collect()
    for r in rows:
        assert r.ts == py_strptime(r.v), repr(r.v)


@st.composite
def trip_line(draw):
    n = draw(st.integers(0, 12))
    fields = [draw(st.text(alphabet="abc019. ", max_size=4)) for _ in range(n)]
    if n >= 2 and draw(st.booleans()):
        fields[1] = draw(pickup_text())
    return draw(WS) + ",".join(fields) + draw(WS)


@SETTINGS
@given(st.lists(trip_line(), min_size=150, max_size=150))
def test_replay_properties(spark, lines):
    """Which lines stay, and what of them: checked message by message, without a second replay."""
    from tripdemand.operators.replay import replay_messages
    marked = [f"{i}#{v.strip()}" for i, v in enumerate(lines)]
    df = spark.createDataFrame([(v,) for v in marked], "value string")
    got = replay_messages(df, "2024-02-01").collect()
    assert len({r.key for r in got}) == len(got)
    by_mark = {int(r.value.split("#")[0]): r.value.split(",") for r in got}
    assert len(by_mark) == len(got)
    for i, line in enumerate(marked):
        fields = line.strip(" \t\n\r\x0b\x0c").split(",")
        pickup = fields[1] if len(fields) > 1 else ""
        stays = " " in pickup and py_strptime(re.sub(":6[01]$", ":59", pickup)) is not None
        assert (i in by_mark) == stays, repr(line)
        if stays:
            new = by_mark[i]
            assert len(new) == min(len(fields), 9) and new[0] == fields[0] and new[2:] == fields[2:9]
            assert new[1].split(" ", 1)[0] == "2024-02-01" and new[1].split(" ")[1] == pickup.split(" ")[1]
