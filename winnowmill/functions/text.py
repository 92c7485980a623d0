"""Prompt templates, regular expressions, closed vocabularies and label lists as expressions."""

from __future__ import annotations

import re
import string
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import InvalidInput
from . import matching

Replacement = tuple[str, str]
RegexSpec = str | Replacement | list[Replacement]


def _as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- prompts -------------------------------------------------------------------------------------


def _float_text(col: Column) -> Column:
    """Spark prints 1.0E7 where prompts are expected to read 10000000.0 (exponents start at 1e16)."""
    size = F.abs(col)
    text = col.cast("string")
    plain = F.format_string("%s", text.try_cast("decimal(38,20)").cast("string"))
    plain = F.regexp_replace(F.regexp_replace(plain, r"0+$", ""), r"\.$", ".0")
    digits = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1).try_cast("int")
    signed = F.concat(F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    long_power = F.concat(F.when(power < 0, "-").otherwise("+"), F.abs(power).cast("string"))
    scientific = F.concat(digits, F.lit("e"), F.when(F.abs(power) > 99, long_power).otherwise(signed))
    return (
        F.when(F.isnan(col), "nan")
        .when(size == float("inf"), F.when(col > 0, "inf").otherwise("-inf"))
        .when(~F.contains(text, F.lit("E")), text)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def text_of(df: DataFrame, name: str) -> Column:
    """A column as it reads inside a prompt: by column type, null as ``None`` (``nan`` for floats)."""
    if name not in df.columns:
        raise InvalidInput(f"prompt names a column that does not exist: {name}")
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return F.coalesce(_float_text(col.cast("double")), F.lit("nan"))
    if isinstance(kind, T.BooleanType):
        return F.when(col, "True").when(~col, "False").otherwise("None")
    return F.coalesce(col.cast("string"), F.lit("None"))


_SPEC = re.compile(r"(?:(.)?([<>^]))?(0)?(\d+)?(,)?(?:\.(\d+))?([dfs])?", re.DOTALL)


def _specified(df: DataFrame, name: str, spec: str) -> Column:
    """A column under a format specifier: fill, alignment, width, thousands, decimals and d, f or s.

    Numbers are right-aligned, texts left-aligned. Decimals round half up on the shortest decimal form.
    """
    hit = _SPEC.fullmatch(spec)
    kind = df.schema[name].dataType if name in df.columns else None
    number = isinstance(kind, T.NumericType)
    if hit is None or (hit[7] in ("d", "f") or hit[5] or hit[3]) and not number:
        raise InvalidInput(f"format specifier {spec!r} does not fit column {name}")
    fill, align, zero, width, thousands, decimals, form = hit.groups()
    whole = isinstance(kind, T.IntegralType)
    if form == "d" and not whole or number and not whole and decimals and form != "f":
        raise InvalidInput(f"format specifier {spec!r} does not fit column {name}")
    plain = text_of(df, name)
    if not number:
        shown = F.substring(plain, 1, int(decimals)) if decimals else plain
    elif form == "f":
        pattern = f"%{thousands or ''}.{decimals or 6}f"
        shown = F.coalesce(F.format_string(pattern, F.col(f"`{name}`").cast("double")), F.lit("None"))
        shown = F.when(F.col(f"`{name}`").isNull(), plain).otherwise(shown)
    elif thousands:
        head, tail = F.substring_index(plain, ".", 1), F.regexp_extract(plain, r"\..*$", 0)
        shown = F.concat(F.regexp_replace(head, r"(?<=\d)(?=(\d{3})+$)", ","), tail)
    else:
        shown = plain
    size = int(width or 0)
    if not size:
        return shown
    room = F.greatest(F.lit(size) - F.length(shown), F.lit(0))
    pad = lambda n: F.repeat(F.lit(fill or ("0" if zero else " ")), n)
    align = align or (">" if number else "<")
    if zero and not fill and number:
        sign = F.regexp_extract(shown, "^-", 0)
        return F.concat(sign, pad(room), F.regexp_replace(shown, "^-", ""))
    left = {"<": F.lit(0), ">": room, "^": F.floor(room / 2).cast("int")}[align]
    return F.concat(pad(left), shown, pad(room - left))


def template_parts(prompt: str, style: str = "format") -> list[tuple[str, str | None, str]]:
    """Triples (literal text, column name or None, format specifier) of a prompt template."""
    if not prompt:
        raise InvalidInput("the prompt must not be empty")
    if style == "format":
        parts = []
        for literal, field, spec, conversion in string.Formatter().parse(prompt):
            if conversion not in (None, "s") or "{" in (spec or ""):
                raise InvalidInput(f"conversions and nested specifiers are not supported: {field}")
            if field == "":
                raise InvalidInput("positional fields are not supported")
            parts.append((literal, field, spec or ""))
        return parts
    if style == "template":
        parts, end = [], 0
        for hit in string.Template.pattern.finditer(prompt):
            literal = prompt[end : hit.start()]
            name = hit.group("named") or hit.group("braced")
            if hit.group("invalid") is not None:
                raise InvalidInput(f"invalid placeholder at character {hit.start()}")
            parts.append((literal, name, "") if name else (literal + "$", None, ""))
            end = hit.end()
        return [*parts, (prompt[end:], None, "")]
    raise InvalidInput(f"unknown template style: {style}")


def render_prompt(df: DataFrame, prompt: str, style: str = "format", prefix: str = "") -> Column:
    """The prompt of each row. ``prefix`` is put in front as it stands, braces and all."""
    pieces: list[Column] = [F.lit(prefix)] if prefix else []
    for literal, name, spec in template_parts(prompt, style):
        if literal:
            pieces.append(F.lit(literal))
        if name is not None:
            pieces.append(_specified(df, name, spec) if spec else text_of(df, name))
    return F.concat(*pieces)


def options_prefix(options: Sequence[str] | None) -> str:
    """Sentence put before a prompt whose answer must be one of ``options``; empty without options."""
    if options is None:
        return ""
    # Fixed value: the wording the answering model is given.
    return f"Your answer must exactly match one of the following values: [{', '.join(options)}].\n"


# --- regular expressions -------------------------------------------------------------------------


def java_pattern(pattern: str) -> str:
    """A Python pattern in Java's dialect: Unicode classes, ``\\n`` as the only line end, group names."""
    compiled = re.compile(pattern)
    if re.search(r"\(\?[aL]", pattern) or "(?(" in pattern:
        raise InvalidInput(f"pattern uses a construct without a Java counterpart: {pattern}")
    names = {name: f"g{number}" for name, number in compiled.groupindex.items()}
    out = re.sub(r"\(\?P<(\w+)>", lambda m: f"(?<{names[m[1]]}>", pattern)
    out = re.sub(r"\(\?P=(\w+)\)", lambda m: rf"\k<{names[m[1]]}>", out)
    out = re.sub(r"(?<!\\)((?:\\\\)*)\\Z", r"\1\\z", out)
    return "(?Ud)" + out


def _java_replacement(pattern: str, replacement: str) -> str:
    names = re.compile(pattern).groupindex
    escapes = {"n": "\n", "t": "\t", "r": "\r", "\\": r"\\"}

    def piece(hit: re.Match) -> str:
        token = hit[0]
        if token == "$":
            return r"\$"
        if hit["group"]:
            name = hit["group"]
            return "${%s}" % f"g{names[name]}" if name in names else f"${name}"
        if hit["digit"]:
            return f"${hit['digit']}"
        return escapes.get(token[1], token)

    return re.sub(r"\$|\\g<(?P<group>\w+)>|\\(?P<digit>[1-9]\d?)|\\.", piece, replacement)


def check_regex(regex: object) -> str | list[Replacement] | None:
    """A regex argument as either one pattern to extract or a list of replacements."""
    if regex is None or regex == "" or regex == []:
        return None
    if isinstance(regex, str):
        return regex
    pairs = [regex] if isinstance(regex, tuple) else regex
    if not isinstance(pairs, list):
        raise InvalidInput("regex must be a pattern, a (pattern, replacement) pair or a list of pairs")
    for pair in pairs:
        if isinstance(pair, str):
            raise InvalidInput("only a single pattern can be used for extraction")
        if not (isinstance(pair, tuple) and len(pair) == 2 and all(isinstance(p, str) for p in pair)):
            raise InvalidInput("every replacement must be a pair (pattern, replacement)")
    return pairs


def regex_extract_first(col: Column | str, pattern: str) -> Column:
    """First match anywhere in the text: its group if the pattern has one, else all of it; else null."""
    groups = re.compile(pattern).groups
    if groups > 1:
        raise InvalidInput("an extraction pattern may have one group at most")
    java, text = java_pattern(pattern), _as_column(col)
    # Both searches end at the first match, where listing all matches would read the whole text.
    return F.when(text.rlike(java), F.regexp_extract(text, java, groups))


def regex_replace_chain(col: Column | str, pairs: Replacement | list[Replacement]) -> Column:
    out = _as_column(col)
    for pattern, replacement in check_regex(pairs) or []:
        out = F.regexp_replace(out, java_pattern(pattern), _java_replacement(pattern, replacement))
    return out


def process_regex(col: Column | str, regex: RegexSpec) -> Column:
    spec = check_regex(regex)
    if spec is None:
        return _as_column(col)
    return regex_extract_first(col, spec) if isinstance(spec, str) else regex_replace_chain(col, spec)


# --- closed vocabularies -------------------------------------------------------------------------


def _quoted(option: Column) -> Column:
    return F.concat(F.lit(r"\Q"), F.regexp_replace(option, r"\\E", r"\\E\\\\E\\Q"), F.lit(r"\E"))


def last_mention(col: Column | str, options: Sequence[str] | Column) -> Column:
    """Last option named in the text, letter case ignored, in the text's own casing; null if none.

    ``options`` is a list for all rows or an array column. Earlier options win over later ones that
    start at the same place.
    """
    if isinstance(options, Column):
        listed = F.array_join(F.transform(options, _quoted), "|")
        pattern = F.concat(F.lit("(?iu)("), listed, F.lit(")"))
        # An empty list would give a pattern that matches everywhere.
        pattern = F.when(F.size(options) > 0, pattern)
    else:
        pattern = F.lit("(?iu)(" + "|".join(re.escape(o) for o in options) + ")")
    return F.try_element_at(F.regexp_extract_all(_as_column(col), pattern, F.lit(1)), F.lit(-1))


def _canonical(found: Column, options: Sequence[str] | Column) -> Column:
    if isinstance(options, Column):
        listed, lowered = options, F.transform(options, F.lower)
    else:
        listed = F.array(*[F.lit(o) for o in options])
        lowered = F.array(*[F.lower(F.lit(o)) for o in options])
    place = F.array_position(lowered, F.lower(found)).cast("int")
    return F.coalesce(F.when(place > 0, F.try_element_at(listed, place)), found)


def _per_pair(function, kind: str):
    """``function`` of two columns, once for each different pair of a batch; null if either is null."""

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for first, second in batches:
            found, out = {}, []
            for a, b in zip(first, second):
                if a is None or b is None:
                    out.append(None)
                    continue
                key = (a, b if isinstance(b, str) else tuple(b))
                if key not in found:
                    found[key] = function(*key)
                out.append(found[key])
            yield pd.Series(out, dtype="float64" if kind == "double" else "object")

    run.__annotations__ = {"batches": Iterator[tuple[pd.Series, pd.Series]], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, returnType=kind)


def similarity_ratio(a: Column | str, b: Column | str) -> Column:
    """Twice the characters in matching blocks over all characters; 1 for equal texts, null if either is null.

    The longest common block is matched first, then what is left of it and right of it. Of several longest
    ones the first in ``a`` counts, then in ``b``. Only unequal texts go to Python, each pair once in a batch.
    """
    a, b = _as_column(a), _as_column(b)
    unequal = _per_pair(matching.ratio, "double")(F.when(a != b, a), b)
    return F.when(a == b, F.lit(1.0)).otherwise(unequal)


def _closest_of(text: str, options: tuple) -> str | None:
    """The most similar option, the earlier of equals; the last if none is half alike or there is none."""
    known = [o for o in options if o is not None]
    rated = [matching.ratio(text, o) for o in known]
    if rated and max(rated) >= 0.5:
        return known[rated.index(max(rated))]
    return options[-1] if options else None


def constrain_outputs(
    col: Column | str,
    options: Sequence[str] | Column,
    canonical: bool = True,
    fallback: bool = True,
) -> Column:
    """Map free text to one of ``options``: last option named, else the most similar one.

    A best similarity under one half gives the last option. ``canonical=False`` keeps the casing of
    the text for named options. Null stays null. Similarity is ``similarity_ratio``.
    """
    if not isinstance(options, Column):
        if not options or not all(isinstance(o, str) for o in options):
            raise InvalidInput("options must be a non-empty list of strings")
    text = _as_column(col)
    found = last_mention(text, options)
    picked = _canonical(found, options) if canonical else found
    if not fallback:
        return picked
    listed = options if isinstance(options, Column) else F.array(*[F.lit(o) for o in options])
    # Texts that name an option are null for the function, so that only the others are rated.
    closest = _per_pair(_closest_of, "string")(F.when(found.isNull(), text), F.when(found.isNull(), listed))
    return F.coalesce(picked, closest)


# --- lists and dates -----------------------------------------------------------------------------


def split_labels(col: Column | str) -> Column:
    """One line of comma-separated values as an array; quotes honoured; null and empty give []."""
    text = _as_column(col)
    line = F.regexp_extract(text, r'^((?:"(?:[^"]|"")*"|[^"\r\n])*)', 1)
    items = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(r',("(?:[^"]|"")*"[^,]*|[^,]*)'), F.lit(1))
    unquoted = F.transform(
        items,
        lambda i: F.when(
            F.startswith(i, F.lit('"')),
            F.concat(
                F.replace(F.regexp_extract(i, r'^"((?:[^"]|"")*)"', 1), F.lit('""'), F.lit('"')),
                F.regexp_extract(i, r'^"(?:[^"]|"")*"(.*)$', 1),
            ),
        ).otherwise(i),
    )
    plain = F.split(text, ",")
    empty = F.array().cast("array<string>")
    return (
        F.when(text.isNull() | (text == ""), empty)
        .when(~text.rlike(r'["\r\n]'), plain)
        .otherwise(unquoted)
    )


def parse_http_date(col: Column | str) -> Column:
    """``Tue, 05 Mar 2024 10:11:12 GMT`` as a timestamp; null if it does not read that way."""
    rest = F.regexp_extract(_as_column(col), r"^\s*(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),\s+(.*)$", 1)
    return F.try_to_timestamp(F.when(rest != "", rest), F.lit("d MMM yyyy HH:mm:ss z"))
