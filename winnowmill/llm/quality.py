"""Quality rules as a short-circuit cascade, in DataFrame functions only."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE_CLASS, col, let, stored, unused

REPEAT_WINDOW = 8
SYMBOLS = r"[#*$%&|<>]"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """A text fails if ``scale * feature`` is above ``most * n_words`` or below ``least * n_words``.

    With ``per_word=False`` the bounds are plain numbers. Whole numbers keep the comparison exact.
    """

    name: str
    feature: str
    least: int | None = None
    most: int | None = None
    scale: int = 1
    per_word: bool = True

    def fails(self, feature: Column, n_words: Column) -> Column:
        unit = n_words if self.per_word else F.lit(1)
        value, bad = feature * self.scale, F.lit(False)
        if self.least is not None:
            bad = bad | (value < unit * self.least)
        if self.most is not None:
            bad = bad | (value > unit * self.most)
        return bad


BASE_RULES = (
    Rule("too_few_words", "n_words", least=20, per_word=False),
    Rule("repeated_words", "n_repeat_words", most=30, scale=100),
)
RULES = (
    *BASE_RULES,
    Rule("symbols", "n_symbols", most=40, scale=100),
    Rule("word_length", "word_chars", least=15, most=300, scale=10),
    Rule("duplicate_lines", "n_dup_lines", most=10, scale=100),
)


def words_of(text: Column) -> Column:
    """The words of a text, runs of characters other than white space; none for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"{SPACE_CLASS}+"))


def _repeat_words(words: Column) -> Column:
    """Number of words inside windows of REPEAT_WINDOW words that occur twice or more in the text.

    Windows are compared by a 64-bit hash. Texts without a repeated window, nearly all, end there.
    """

    def covered(windows: Column) -> Column:
        ranked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def positions(s: Column) -> Column:
            def seen_beside(x: Column, j: Column) -> Column:
                # get() of a negative or too large index is null.
                beside = (F.get(s, j - 1)["h"] == x["h"], F.get(s, j + 1)["h"] == x["h"])
                return F.when(F.coalesce(beside[0], F.lit(False)) | F.coalesce(beside[1], F.lit(False)), x["i"])

            return F.sort_array(F.filter(F.transform(s, seen_beside), lambda p: p.isNotNull()))

        start = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

        def add(a: Column, p: Column) -> Column:
            end = p + REPEAT_WINDOW
            return F.struct(end.alias("end"), (a["n"] + end - F.greatest(p, a["end"])).alias("n"))

        return F.aggregate(let(ranked, positions), start, add, lambda a: a["n"])

    def windows(hashes: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(hashes) - (REPEAT_WINDOW - 1))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(hashes, i, REPEAT_WINDOW)))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0).cast("bigint")).otherwise(covered(w))

    found = let(let(F.transform(words, lambda w: F.xxhash64(w)), windows), count)
    return F.when(F.size(words) <= REPEAT_WINDOW, F.lit(0).cast("bigint")).otherwise(found)


def feature(name: str, text: Column, words: Column) -> Column:
    """One of FEATURES as a bigint expression over the text and the array of its words."""
    text = F.coalesce(text, F.lit(""))
    if name == "n_words":
        out = F.size(words)
    elif name == "word_chars":
        out = F.length(F.array_join(words, ""))
    elif name == "n_symbols":
        out = F.length(text) - F.length(F.regexp_replace(text, SYMBOLS, ""))
    elif name == "n_dup_lines":
        lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
        repeated = let(lines, lambda ls: F.size(ls) - F.size(F.array_distinct(ls)))
        out = F.when(F.contains(text, F.lit("\n")), repeated).otherwise(0)
    elif name == "n_repeat_words":
        out = _repeat_words(words)
    else:
        raise ValueError(f"unknown feature {name!r}; there are {', '.join(FEATURES)}")
    return out.cast("bigint")


def rank_rules(
    docs: DataFrame, text_col: str, rules: Sequence[Rule] = RULES, sample_rows: int = 1000, seed: int = 7
) -> list[tuple[Rule, float, float]]:
    """Rules by rejection per cost, best first, each with (seconds on the sample, share rejected).

    A seeded random sample of at most ``sample_rows`` rows is stored once, and every rule runs over it.
    Only the order of evaluation depends on this, never a verdict.
    """
    total = docs.count()
    picked = docs.select(col(text_col).alias("text"))
    if total > sample_rows:
        picked = picked.sample(fraction=min(1.0, 1.1 * sample_rows / total), seed=seed).limit(sample_rows)
    sample = stored(picked.select("text", words_of(F.col("text")).alias("words")), "quality-sample")
    sample.agg(F.sum(F.size("words"))).collect()  # opens the files, so that no rule pays for it
    ranked = []
    for rule in rules:
        value = sample.select(
            F.size("words").cast("bigint").alias("n"),
            feature(rule.feature, F.col("text"), F.col("words")).alias("v"),
        )
        began = time.perf_counter()
        row = value.agg(F.count("*").alias("rows"), F.count_if(rule.fails(F.col("v"), F.col("n"))).alias("bad"))
        row = row.first()
        ranked.append((rule, time.perf_counter() - began, row["bad"] / max(1, row["rows"])))
    return sorted(ranked, key=lambda r: (-r[2] / max(r[1], 1e-6), r[1]))


def quality_cascade(
    docs: DataFrame,
    text_col: str = "text",
    rules: Sequence[Rule] = RULES,
    sample_rows: int = 1000,
    complete: bool = False,
) -> DataFrame:
    """All columns of ``docs`` plus the features, ``failed_rule`` and ``kept``.

    ``failed_rule`` is the first rule, in the order that ``rank_rules`` found on a sample, that the text
    fails, null if it passes all; ``kept`` says that it passes all. A feature is computed when the first
    rule that needs it is reached, and once; features of rules that a rejected text never reached are
    null. ``complete=True`` fills them in. One pass, no shuffle, no Python.

    Null and empty texts have no words. Output columns replace input columns of the same name. Rows are
    neither dropped nor merged; an empty table gives an empty one.
    """
    order = [rule for rule, _, _ in rank_rules(docs, text_col, rules, sample_rows)]
    outputs = {*FEATURES, "failed_rule", "kept"}
    # The text under a name of its own: an output column may replace the one that holds it.
    text, words = unused(docs, "__text"), unused(docs, "__words")
    kept = [c for c in docs.columns if c.lower() not in outputs]
    rows = docs.select(*[col(c) for c in kept], col(text_col).alias(text))
    rows = rows.select("*", words_of(F.col(text)).alias(words))
    # The count of words costs nothing once the words are there, and most rules divide by it.
    rows = rows.select("*", feature("n_words", F.col(text), F.col(words)).alias("n_words"))
    rows = rows.withColumn("failed_rule", F.lit(None).cast("string"))
    known = {"n_words"}
    for rule in order:
        if rule.feature not in known:
            known.add(rule.feature)
            value = feature(rule.feature, F.col(text), F.col(words))
            rows = rows.withColumn(rule.feature, F.when(F.col("failed_rule").isNull(), value))
        fails = rule.fails(F.col(rule.feature), F.col("n_words"))
        rows = rows.withColumn(
            "failed_rule", F.coalesce("failed_rule", F.when(fails, F.lit(rule.name)))
        )
    for name in FEATURES:
        value = feature(name, F.col(text), F.col(words))
        if name not in known:
            rows = rows.withColumn(name, value if complete else F.lit(None).cast("bigint"))
        elif complete and name != "n_words":
            rows = rows.withColumn(name, F.coalesce(name, value))
    return rows.select(
        *[col(c) for c in kept], *FEATURES, "failed_rule", F.col("failed_rule").isNull().alias("kept")
    )
