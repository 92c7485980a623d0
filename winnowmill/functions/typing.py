"""Casts with the accepted spellings of each column type, and predicates on single values.

Every cast returns null for a value that does not conform; nothing here raises on dirty data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The accepted boolean spellings and the texts that stand for a missing value.
TRUE_WORDS = ["true", "t", "yes", "1", "1.0"]
FALSE_WORDS = ["false", "f", "no", "0", "0.0"]
MISSING_WORDS = ["None", "none", "null", "NULL"]

_NUMBER = r"^[+-]?(\d+\.?\d*([eE][+-]?\d+)?|\.\d+([eE][+-]?\d+)?|(?i:nan|inf|infinity))$"

COLUMN_TYPES = ("string", "integer", "float", "boolean", "datetime", "image_external")


def _as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _number(text: Column) -> Column:
    """Text as a double. A cast that fails costs an exception inside Spark, so the form is checked first."""
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def cast_integer(col: Column | str) -> Column:
    """Whole numbers only: ``1.0`` is accepted, ``0.8`` is not."""
    text = F.trim(_as_column(col).cast("string"))
    # Up to 18 digits always fit, which covers nearly all data; the rest takes the checked casts.
    plain = F.regexp_extract(text, r"^([+-]?\d{1,18})(\.0*)?$", 1)
    unusual = F.when(text.rlike(r"[eE]|\d{19}|^[+-]?\."), text)
    number = _number(unusual)
    long = F.when(unusual.rlike(r"^[+-]?\d+$"), unusual.try_cast("bigint"))
    return F.when(plain != "", plain.cast("bigint")).otherwise(
        F.coalesce(long, F.when(number == F.floor(number), number.try_cast("bigint")))
    )


def cast_float(col: Column | str) -> Column:
    return _number(F.trim(_as_column(col).cast("string")))


def cast_boolean(col: Column | str) -> Column:
    word = F.lower(F.trim(_as_column(col).cast("string")))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def cast_datetime(col: Column | str, patterns: Sequence[str] = ()) -> Column:
    """Date text in ISO form (optional zone offset), seconds since 1970, or text in one of ``patterns``.

    Digits alone are seconds, however many; a pattern such as ``yyyyMMdd`` or ``MM/dd/yyyy``, tried
    first and in order, reads them, and other forms, as dates.
    """
    text = F.trim(_as_column(col).cast("string"))
    seconds = F.timestamp_micros((text.try_cast("double") * 1_000_000).try_cast("bigint"))
    # "2018-10-07 04:10:11 -0500" -> "2018-10-07 04:10:11-05:00"
    iso = F.regexp_replace(text, r"^(\d+-\d+-\d+[ T]\d\S*)\s*([+-]\d{2}):?(\d{2})$", "$1$2:$3")
    usual = F.when(text.rlike(r"^[+-]?\d+(\.\d*)?([eE]\+?\d+)?$"), seconds).when(
        text.rlike(r"^\d{4}-\d{1,2}"), iso.try_cast("timestamp")
    )
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in patterns], usual)


def cast_to(col: Column | str, column_type: str) -> Column:
    casts = {
        "string": lambda c: _as_column(c).cast("string"),
        "image_external": lambda c: _as_column(c).cast("string"),
        "integer": cast_integer,
        "float": cast_float,
        "boolean": cast_boolean,
        "datetime": cast_datetime,
    }
    return casts[column_type](col)


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, NaN, or one of the texts that stand for null."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        return col.isNull() | F.coalesce(col.isin(MISSING_WORDS), F.lit(False))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def is_blank(df: DataFrame, name: str) -> Column:
    """Null, NaN or the empty text."""
    kind = df.schema[name].dataType
    col = F.col(name)
    if isinstance(kind, T.StringType):
        return col.isNull() | F.coalesce(col == "", F.lit(False))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return col.isNull() | F.isnan(col)
    return col.isNull()


def well_formed_uuid(col: Column | str) -> Column:
    """Canonical, bare, braced and ``urn:uuid:`` spellings of a 128-bit identifier."""
    bare = F.regexp_replace(_as_column(col), "urn:|uuid:", "")
    bare = F.regexp_replace(F.regexp_replace(bare, r"^[{}]+|[{}]+$", ""), "-", "")
    return F.coalesce(bare.rlike("^[0-9a-fA-F]{32}$"), F.lit(False))


def image_extension(col: Column | str) -> Column:
    """Lower-case suffix of a path if it is an accepted image suffix; ``.jpg`` counts as ``.jpeg``."""
    name = F.regexp_extract(_as_column(col), r"([^/\\]*)$", 1)
    suffix = F.lower(F.regexp_extract(name, r".(\.[^.]+)$", 1))
    return F.when(suffix.isin(".jpg", ".jpeg"), ".jpeg").when(suffix == ".png", ".png")


def isoformat(col: Column | str, kind: T.DataType) -> Column:
    """ISO text of a date or timestamp; fractional seconds only where there are any."""
    col = _as_column(col)
    if isinstance(kind, T.DateType):
        return F.date_format(col, "yyyy-MM-dd")
    micros = F.date_format(col, "SSSSSS")
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(micros == "000000", whole).otherwise(F.concat(whole, F.lit("."), micros))


def in_unit_range(col: Column | str) -> Column:
    """Null, or a number between 0 and 1."""
    col = _as_column(col)
    return col.isNull() | (col.between(0, 1) & ~F.isnan(col.cast("double")))
