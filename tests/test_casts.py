"""The guarded cast gives what the plain one gives."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import types as T

from millrace.functions.columns import sql_text, sql_try_cast

WORDS = """1 0 -7 +7 007 1.9 1. .5 -.5 1e3 1E-2 1d 1f 1L 0x10 0x1p3 inf -inf +Infinity INFINITY
nan NaN -nan t T true TRUE tRuE y yes Yes 1 f false n no NO 0 on off abc N/A - + +- 1-2 1+ ++1
2147483647 2147483648 -2147483648 -2147483649 9223372036854775807 9223372036854775808 127 128
32768 99999999999999999999999999999999999999999 1,000 1_000 $5 12abc abc12 ١٢ １２ ½ ① e E 1e 1e400""".split()
PADS = ["", " ", "\t", "\n", "\r\n", "\x00", "\x1f", "\x7f", " ", " ", "\x85"]
CORPUS = [a + w + b for w in WORDS for a in PADS[:9] for b in ("", a)] + [
    "", " ", "1 2", "- 1", "tr ue", "''", "\\", "in f",
] + [w + p for w in ("1", "true", "1.5") for p in PADS]
KINDS = [
    T.ByteType(),
    T.ShortType(),
    T.IntegerType(),
    T.LongType(),
    T.FloatType(),
    T.DoubleType(),
    T.DecimalType(10, 2),
    T.DecimalType(38, 0),
    T.BooleanType(),
    T.DateType(),
    T.TimestampNTZType(),
]


def differences(spark, texts, wanted):
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    plain = f"try_cast(s AS {wanted.simpleString()})"
    guarded = sql_try_cast("s", T.StringType(), wanted)
    return [r[0] for r in df.filter(f"NOT (({plain}) <=> ({guarded}))").collect()]


@pytest.mark.parametrize("wanted", KINDS, ids=lambda t: t.simpleString())
def test_same_as_plain_cast(spark, wanted):
    assert differences(spark, CORPUS, wanted) == []


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.text(max_size=6), st.text("0123456789+-.eEinfatruyso \t", max_size=6)), min_size=20),
    st.sampled_from([T.IntegerType(), T.DoubleType(), T.DecimalType(12, 3), T.BooleanType()]),
)
def test_same_on_random_texts(spark, texts, wanted):
    clean = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert differences(spark, clean, wanted) == []


@pytest.mark.parametrize("text", ["it's", "a\\b", "\\'", "x\ny", "`", "é", "%s {0}", ""])
def test_literals(spark, text):
    assert spark.range(1).selectExpr(sql_text(text)).first()[0] == text
