"""Casts, conformity and label checks on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from winnowmill.errors import InvalidInput
from winnowmill.functions import typing
from winnowmill.operators import schema


def values(spark, texts, expression):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression("t")).collect()]


def test_integer_accepts_whole_numbers_only(spark):
    texts = ["7", "1.0", "0.8", " 12 ", "9007199254740993", "1e3", "NaN", "x", "", None, "99999999999999999999", "1.0d"]
    expected = [7, 1, None, 12, 9007199254740993, 1000, None, None, None, None, None, None]
    assert values(spark, texts, typing.cast_integer) == expected


def test_float_accepts_integers(spark):
    assert values(spark, ["1", "1.5", ".5", "-2.", "x", "1.0d", None], typing.cast_float) == [1.0, 1.5, 0.5, -2.0, None, None, None]


def test_boolean_words(spark):
    texts = ["true", "T", "Yes", "1", "1.0", "FALSE", "f", "no", "0", "0.0", "y", "2", None]
    assert values(spark, texts, typing.cast_boolean) == [True] * 5 + [False] * 5 + [None] * 3


def test_datetime_patterns_and_short_epochs(spark):
    texts = ["0", "3600", "1999", "03/17/2016", "Mar 17 2016", "20160317", "17.3.", "2016-03-17"]
    form = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    got = values(spark, texts, lambda c: form(typing.cast_datetime(c, ["MM/dd/yyyy", "MMM d yyyy", "yyyyMMdd"])))
    day = "2016-03-17 00:00:00"
    assert got == ["1970-01-01 00:00:00", "1970-01-01 01:00:00", "1970-01-01 00:33:19", day, day, day, None, day]


def test_datetime_text_and_epoch(spark):
    texts = ["2019-06-05 04:03:02 -0800", "2019-06-05T04:03:02.25Z", "2018-10-07", "1538903411", "1538903411.5", "soon", "7", None]
    got = values(spark, texts, lambda c: F.date_format(typing.cast_datetime(c), "yyyy-MM-dd HH:mm:ss.SS"))
    assert got == [
        "2019-06-05 12:03:02.00",
        "2019-06-05 04:03:02.25",
        "2018-10-07 00:00:00.00",
        "2018-10-07 09:10:11.00",
        "2018-10-07 09:10:11.50",
        None,
        "1970-01-01 00:00:07.00",
        None,
    ]


def test_uuid_spellings(spark):
    hexa = "0123456789abcdef0123456789ABCDEF"
    texts = [hexa, "{" + hexa + "}", "urn:uuid:01234567-89ab-cdef-0123-456789abcdef", hexa[:-1], hexa[:-1] + "g", "", None]
    assert values(spark, texts, typing.well_formed_uuid) == [True, True, True, False, False, False, False]


def test_image_extension(spark):
    texts = ["a/b.JPG", "b.jpeg", "c.Png", "d.gif", ".png", "a.png/file", None]
    assert values(spark, texts, typing.image_extension) == [".jpeg", ".jpeg", ".png", None, None, None, None]


def test_missing_and_blank(spark):
    df = spark.createDataFrame([("None", 1.0), ("NULL", float("nan")), ("", 0.0), ("NONE", None), (None, 2.0)], "t string, x double")
    got = df.select(typing.is_missing(df, "t"), typing.is_missing(df, "x"), typing.is_blank(df, "t"), typing.is_blank(df, "x")).collect()
    assert [tuple(r) for r in got] == [
        (True, False, False, False),
        (True, True, False, True),
        (False, False, True, False),
        (False, True, False, True),
        (True, False, True, False),
    ]


def test_isoformat_has_fractions_only_where_needed(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 2, 3, 4, 5), dt.date(2024, 1, 2)), (dt.datetime(2024, 1, 2, 3, 4, 5, 60), None)], "t timestamp, d date"
    )
    assert [tuple(r) for r in schema.isoformat_temporal(df).collect()] == [
        ("2024-01-02T03:04:05", "2024-01-02"),
        ("2024-01-02T03:04:05.000060", None),
    ]


def test_override_forms_and_errors():
    assert schema.normalize_overrides([{"name": "a", "column_type": "float"}]) == [("a", "float")]
    legacy = {"a": {"data_type": "string", "feature_type": "filepath"}, "b": {"data_type": "float", "feature_type": "datetime"}}
    assert schema.normalize_overrides(legacy) == [("a", "image_external"), ("b", "datetime")]
    for bad in ("x", [{"name": "a"}], [{"name": "a", "column_type": "decimal"}], {"a": {"data_type": "float", "feature_type": "categorical"}}):
        with pytest.raises(InvalidInput):
            schema.normalize_overrides(bad)


def test_conformity_counts(spark):
    df = spark.createDataFrame([("1",), ("0.5",), (None,), ("x",)], "a string")
    row = schema.type_conformity(df, [{"name": "a", "column_type": "integer"}]).first()
    assert (row.n_rows, row.n_null, row.n_invalid) == (4, 1, 2)


def test_label_checks(spark):
    df = spark.createDataFrame([("a", "x,y", 1.0)] * 5 + [("b", "x,", 2.0)] * 5 + [("c", None, 3.0)], "one string, many string, num double")
    assert schema.label_diversity(df, "one").first() == (3, 2, True)
    assert schema.multilabel_validity(df, "many").first() == (11, 5, False)
    assert schema.validate_label_column(df, "one", "multi-class").first().problem is None
    assert "list of labels" in schema.validate_label_column(df, "many", "multi-label").first().problem
    assert schema.validate_label_column(df.where("one = 'a'"), "one", "multi-class").first().problem.startswith("fewer than 2 unique")
    assert schema.validate_label_column(df, None, "unsupervised").first().problem is None
    for label, task in (("nope", "multi-class"), ("num", "multi-class"), ("one", "regression"), ("one", "ranking")):
        with pytest.raises(InvalidInput):
            schema.validate_label_column(df, label, task)


def test_profile_forms_agree(spark):
    df = spark.createDataFrame([("a" * 100, "x"), ("a" * 100, None), ("b", "y")], "long string, short string")
    exact = {r.column_name: tuple(r)[1:] for r in schema.profile_columns(df).collect()}
    assert exact == {"long": (3, 0, 2, 67.0), "short": (3, 1, 2, 1.0)}
    assert {r.column_name: tuple(r)[1:] for r in schema.profile_columns(df, exact=False).collect()} == exact


def test_feature_and_text_choice(spark):
    df = spark.createDataFrame([("long text here", "s", 1)], "a string, b string, n int")
    assert schema.select_features(df, "n").columns == ["a", "b", "n"]
    assert schema.select_features(df, "n", ["b"]).columns == ["b", "n"]
    assert schema.select_text_column(df).first().text == "long text here"
    for call in (
        lambda: schema.select_features(df, "n", ["n"]),
        lambda: schema.select_features(df, "n", ["a"], "text"),
        lambda: schema.select_text_column(df, modality="tabular"),
        lambda: schema.guess_text_column(df.select("n")),
    ):
        with pytest.raises(InvalidInput):
            call()
