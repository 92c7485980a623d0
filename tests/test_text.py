"""Prompts, regular expressions, vocabularies, label lists."""

import csv
import difflib
import io
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from winnowmill.errors import InvalidInput
from winnowmill.functions import matching, text


def apply(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r[0] for r in df.select("i", expression("t").alias("o")).orderBy("i").select("o").collect()]


def test_prompt_reads_like_python(spark):
    rows = [(1e7, True, 3, None), (1.5e-5, False, 4, "x"), (1e16, None, 5, "{b}"), (123456789.125, True, 6, "z"), (-2.5e20, True, 7, ""), (1e100, True, 8, "e"), (float("inf"), True, 9, "i"), (0.1, False, 0, "ü")]
    df = spark.createDataFrame(rows, "f double, b boolean, i int, s string")
    got = [r[0] for r in df.orderBy("i").select(text.render_prompt(df, "{f}|{b}|{i}|{{}}|{s}")).collect()]
    assert got == ["{f}|{b}|{i}|{{}}|{s}".format(f=f, b=b, i=i, s=s) for f, b, i, s in sorted(rows, key=lambda r: r[2])]


def test_template_style_and_prefix(spark):
    df = spark.createDataFrame([("v",)], "name string")
    assert df.select(text.render_prompt(df, "$name ${name}s $$1", "template")).first()[0] == "v vs $1"
    prefix = text.options_prefix(["a", "{name}"])
    assert df.select(text.render_prompt(df, "Q {name}", prefix=prefix)).first()[0] == (
        "Your answer must exactly match one of the following values: [a, {name}].\nQ v"
    )
    assert text.options_prefix(None) == ""


def test_prompt_errors(spark):
    df = spark.createDataFrame([("v",)], "name string")
    for prompt, style in (("", "format"), ("{nope}", "format"), ("{}", "format"), ("{name:3d}", "format"), ("$1", "template"), ("x", "other")):
        with pytest.raises(InvalidInput):
            text.render_prompt(df, prompt, style)


PATTERNS = [r"\w+ is", r"(?P<a_b>\d+)-(?:x)", r"(a)|b", r"^x.*$", r"é+", r"(?i)YES", r"(?P<q>['\"]).*?(?P=q)"]
TEXTS = ["the Antwort über is 12-x", "b a", "x\ny", "x end\n", "yes 'quoted' text", "", "éé b", "٣-x"]


@pytest.mark.parametrize("pattern", PATTERNS)
def test_extraction_matches_python(spark, pattern):
    expected = [(re.findall(pattern, t) or [None])[0] for t in TEXTS]
    assert apply(spark, TEXTS, lambda c: text.regex_extract_first(c, pattern)) == expected


@pytest.mark.parametrize(
    "pairs",
    [("a", "$1"), [(r"(\w)(\w)", r"\2\1"), ("x", "\\\\")], [(r"(?P<n>\d)", r"<\g<n>>"), (r"\s", r"\n")], [(r"(b)", r"\g<1>!")]],
)
def test_replacement_matches_python(spark, pairs):
    def python(t):
        for p, r in [pairs] if isinstance(pairs, tuple) else pairs:
            t = re.sub(p, r, t)
        return t

    assert apply(spark, TEXTS, lambda c: text.process_regex(c, pairs)) == [python(t) for t in TEXTS]


def test_regex_argument_errors():
    for bad in (["a", "b"], [("a",)], [("a", "b", "c")], 5, ("a", 1)):
        with pytest.raises(InvalidInput):
            text.check_regex(bad)
    with pytest.raises(InvalidInput):
        text.regex_extract_first(F.lit("x") if False else "x", "(a)(b)")


def test_null_in_null_out(spark):
    assert apply(spark, [None], lambda c: text.regex_extract_first(c, "a")) == [None]
    assert apply(spark, [None], lambda c: text.constrain_outputs(c, ["No", "None"])) == [None]


def test_constrain(spark):
    options = ["Yes", "No", "Maybe so"]
    texts = ["the answer is YES, or no", "yes", "mayby so", "zzz", "", "(No)"]
    assert apply(spark, texts, lambda c: text.constrain_outputs(c, options)) == ["No", "Yes", "Maybe so", "Maybe so", "Maybe so", "No"]
    assert apply(spark, texts[:2], lambda c: text.constrain_outputs(c, options, canonical=False)) == ["no", "yes"]
    # Earlier options win at the same place, and ties of similarity go to the earlier one.
    assert apply(spark, ["ab"], lambda c: text.constrain_outputs(c, ["a", "ab"])) == ["a"]
    assert apply(spark, ["abc"], lambda c: text.constrain_outputs(c, ["abx", "aby", "other"])) == ["abx"]
    assert apply(spark, ["a+b a.b"], lambda c: text.constrain_outputs(c, ["a+b", "a.b\\E"])) == ["a+b"]
    with pytest.raises(InvalidInput):
        text.constrain_outputs("t", [])


def test_constrain_per_row(spark):
    rows = [("take A or b", ["a", "B"]), ("x*y", ["x*y", "z"]), ("nothing", ["p", "q"]), ("any", [])]
    df = spark.createDataFrame(rows, "t string, o array<string>")
    assert [r[0] for r in df.select(text.constrain_outputs("t", F.col("o"))).collect()] == ["B", "x*y", "q", None]


def test_similarity_counts_matching_blocks(spark):
    rows = [("abcd", "bcde", 0.75), ("", "", 1.0), ("a", "", 0.0), ("kitten", "sitting", 8 / 13), (None, "a", None), ("a", None, None)]
    df = spark.createDataFrame(rows * 3, "a string, b string, want double")
    for r in df.withColumn("got", text.similarity_ratio("a", "b")).collect():
        assert r.got == pytest.approx(r.want) if r.want is not None else r.got is None


def test_matching_blocks_equal_the_standard_library():
    """On 2,000 pairs, some with characters so frequent in a long text that they start no block."""
    random_ = random.Random(6)
    for _ in range(2000):
        alphabet = random_.choice(["ab", "abc", "abcdefgh", "the quick brown é😀"])
        a, b = ("".join(random_.choice(alphabet) for _ in range(random_.choice([0, 2, 9, 40, 230]))) for _ in range(2))
        b = a[len(a) // 3 :] + b if random_.random() < 0.3 else b
        assert matching.ratio(a, b) == difflib.SequenceMatcher(None, a, b).ratio()


def test_constrain_falls_back_on_matching_blocks(spark):
    random_, rows = random.Random(7), []
    for _ in range(300):
        options = ["".join(random_.choice("abcde ") for _ in range(random_.randint(1, 9))) for _ in range(4)]
        rows.append(("".join(random_.choice("abcdef ") for _ in range(random_.randint(0, 12))), options))
    df = spark.createDataFrame(rows, "t string, o array<string>")
    for r in df.select("t", "o", text.constrain_outputs("t", F.col("o")).alias("got")).collect():
        named = re.findall("|".join(re.escape(o) for o in r.o), r.t, re.I)
        rated = [difflib.SequenceMatcher(None, r.t, o).ratio() for o in r.o]
        best = r.o[rated.index(max(rated))] if max(rated) >= 0.5 else r.o[-1]
        assert r.got == (named[-1] if named else best)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.text(alphabet='ab ,"é', max_size=4), min_size=1, max_size=4), min_size=20, max_size=20))
def test_label_lists_round_trip_through_csv(spark, rows):
    lines = []
    for row in rows:
        out = io.StringIO()
        csv.writer(out, lineterminator="").writerow(row)
        lines.append(out.getvalue())
    expected = [next(csv.reader(io.StringIO(line)), []) for line in lines]
    assert apply(spark, lines, text.split_labels) == expected


def test_http_dates(spark):
    texts = ["Tue, 05 Mar 2024 10:11:12 GMT", "Tue, 5 Mar 2024 10:11:12 UTC", "Tue, 99 Mar 2024 10:11:12 GMT", "2024-03-05", None]
    got = apply(spark, texts, lambda c: F.date_format(text.parse_http_date(c), "yyyy-MM-dd HH:mm:ss"))
    assert got == ["2024-03-05 10:11:12"] * 2 + [None] * 3


def test_format_specifiers(spark):
    df = spark.createDataFrame([(1234567, -5, 2.71828, "naïve", True)], "big long, small int, x double, s string, b boolean")
    prompt = "{big:,}|{small:04d}|{small:>6}|{x:.3f}|{x:10.1f}|{s:8}|{s:^9}|{s:.2s}|{s:->7}|{b:6}|{big!s}|{big:,.1f}"
    row = df.first()
    want = prompt.format(**{**row.asDict(), "b": "True"})
    assert df.select(text.render_prompt(df, prompt)).first()[0] == want
    for bad in ("{s:d}", "{x:d}", "{x!r}", "{x:.2e}", "{x:{big}}"):
        with pytest.raises(InvalidInput):
            text.render_prompt(df, bad)
