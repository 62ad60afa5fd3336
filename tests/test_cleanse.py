"""Column clean-up on small frames, edge cases included."""

import pytest
from pyspark.sql import functions as F

import millrace as m
from conftest import rows


def test_trim_strips_all_string_columns(spark):
    padded = spark.range(4).selectExpr(
        "concat(repeat(' ', int(id)), 'oak tree') AS species",
        "concat('plot', repeat(' ', int(id))) AS site",
        "id * 2 AS height",
    )
    assert rows(m.trim_whitespace(padded)) == [("oak tree", "plot", 2 * i) for i in range(4)]


def test_trim_keeps_tabs_and_line_ends(spark):
    df = spark.createDataFrame([("\t x \n",)], "a string")
    assert rows(m.trim_whitespace(df)) == [("\t x \n",)]


def test_trim_takes_listed_columns_only_and_none_of_an_empty_list(spark):
    df = spark.createDataFrame([(" a ", " b ")], "a string, b string")
    assert rows(m.trim_whitespace(df, ["b"])) == [(" a ", "b")]
    assert rows(m.trim_whitespace(df, [])) == [(" a ", " b ")]


def test_dotted_column_names(spark):
    df = spark.createDataFrame([(" N/A ", "yes")], "`a.b` string, `c.d` string")
    out = df.transform(m.trim_whitespace).transform(m.standardize_nulls)
    assert rows(m.standardize_boolean(out, ["c.d"])) == [(None, True)]
    assert rows(m.drop_empty_rows(out, ["a.b"])) == []


def test_nested_strings_stay(spark):
    df = spark.createDataFrame([(("  x ",),)], "s struct<v string>")
    assert rows(m.trim_whitespace(df)) == [(("  x ",),)]


def test_null_words_become_null(spark):
    words = ["N/A", "NA", "null", "NULL", "none", "None", "", "-"]
    df = spark.createDataFrame([(w,) for w in words], "a string")
    assert m.standardize_nulls(df).filter("a IS NOT NULL").count() == 0


def test_other_words_stay(spark):
    kept = ["n/a", "Null", "NONE", " NA", "valid", "--"]
    df = spark.createDataFrame([(w,) for w in kept], "a string")
    assert rows(m.standardize_nulls(df)) == sorted([(w,) for w in kept], key=repr)


def test_own_null_words_replace_the_usual_ones(spark):
    df = spark.createDataFrame([("?",), ("NA",)], "a string")
    assert rows(m.standardize_nulls(df, ["?"])) == [("NA",), (None,)]
    assert rows(m.standardize_nulls(df, [])) == [("?",), (None,)]


def test_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`First Name` int, `é-Mail%` int, ` 2nd  id` int")
    assert m.normalize_column_names(df).columns == ["first_name", "__mail_", "2nd__id"]


def test_colliding_names_are_refused(spark):
    df = spark.createDataFrame([(1, 2)], "`First Name` int, first_name int")
    with pytest.raises(ValueError, match="first_name"):
        m.normalize_column_names(df)


@pytest.mark.parametrize(
    ("words", "wanted"),
    [
        (["true", "TRUE", "tRuE", "Y", "y", "Yes", "1"], True),
        (["false", "False", "n", "NO", "no", "0"], False),
        (["", "on", "off", "2", "yes ", "\tno", "truee", "maybe", None], None),
    ],
)
def test_booleans(spark, words, wanted):
    flags = spark.createDataFrame([(w,) for w in words], "flag string")
    assert {f for (f,) in rows(m.standardize_boolean(flags, ["flag"]))} == {wanted}


def test_booleans_from_other_types(spark):
    df = spark.createDataFrame([(True, 0), (False, 1), (None, 7)], "b boolean, i int")
    got = m.standardize_boolean(df, ["b", "i"])
    assert rows(got) == sorted([(True, False), (False, True), (None, None)], key=repr)


def test_empty_rows_go_only_when_all_columns_are_null(spark):
    df = spark.createDataFrame(
        [(1, None, None), (2, "x", None), (3, None, float("nan"))], "i int, a string, b double"
    )
    assert [r[0] for r in m.drop_empty_rows(df, ["a", "b"]).orderBy("i").collect()] == [2, 3]
    with pytest.raises(ValueError):
        m.drop_empty_rows(df, [])


def test_derived_partitions(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-03-09 17:00:00' AS t")
    assert rows(m.derive_partitions(df, "t")) == [(df.first()[0], 2024, 3)]
    named = m.derive_partitions(df, "t", {"y": "year", "q": "quarter", "d": "day", "h": "hour"})
    assert rows(named.drop("t")) == [(2024, 1, 9, 17)]
    with pytest.raises(ValueError, match="exist"):
        m.derive_partitions(df.withColumn("Year", F.lit(1)), "t")
    with pytest.raises(ValueError, match="unknown"):
        m.derive_partitions(df, "t", ["fortnight"])


def test_cleanup_is_idempotent(spark):
    df = spark.createDataFrame([(" N/A ", "x"), ("-", " y "), (None, "NA")], "`A b` string, c string")

    def chain(d):
        d = d.transform(m.trim_whitespace).transform(m.standardize_nulls)
        return d.transform(m.normalize_column_names)

    once = chain(df)
    twice = chain(once)
    assert once.columns == twice.columns
    assert rows(once) == rows(twice)


def test_cleanup_runs_on_a_stream(spark, tmp_path):
    """Operators that hold no action work unchanged on a streaming DataFrame."""
    spark.createDataFrame([(" NA ",), (" b ",)], "a string").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("a string").parquet(str(tmp_path / "in"))
    out = stream.transform(m.trim_whitespace).transform(m.standardize_nulls)
    out = m.drop_empty_rows(out, ["a"])
    running = (
        out.writeStream.format("memory")
        .queryName("cleaned")
        .option("checkpointLocation", str(tmp_path / "marks"))
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination(60)
    assert rows(spark.table("cleaned")) == [("b",)]
