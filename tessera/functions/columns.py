"""Reusable Column builders.

Every function here returns a ``Column`` built from Spark's own expressions, so
it stays inside whole-stage code generation; none of them is a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Marker used for NULL members of a hashed key, and separator.
NULL_MARKER = "_null_"
KEY_SEPARATOR = "-"


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def quoted(name: str) -> Column:
    """Select a source column whose name holds spaces or punctuation."""
    return F.col(f"`{name}`")


def blank_to_null(c: ColumnOrName) -> Column:
    """``''`` -> NULL (header CSV convention at bronze)."""
    c = _col(c)
    return F.when(c == F.lit(""), F.lit(None).cast("string")).otherwise(c)


def trimmed_or_null(c: ColumnOrName) -> Column:
    """``nullif(trim(c), '')``: padded text trimmed, all-blank text becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def sentinel_to_null(c: ColumnOrName, sentinel: str) -> Column:
    """``nullif(c, sentinel)``, e.g. a masked hospital name."""
    return F.nullif(_col(c), F.lit(sentinel))


def flag(c: ColumnOrName, true_value: str = "Y") -> Column:
    """Two-valued flag from a ``true_value``/NULL source column; NULL -> false."""
    return F.coalesce(_col(c) == F.lit(true_value), F.lit(False))


def digits_only_int(c: ColumnOrName) -> Column:
    """Guarded cast: all-digit text -> int, anything else (masks, blanks) -> NULL.

    ``\\z`` rather than ``$``: Java's ``$`` also matches before a final newline.
    """
    c = _col(c)
    return F.when(c.rlike(r"^\d+\z"), c.cast("int"))


def strict_int(c: ColumnOrName) -> Column:
    """Strict cast under ANSI mode: malformed or blank text raises."""
    return _col(c).cast("int")


def strip_extract_suffix(c: ColumnOrName) -> Column:
    """Remove the ``-d/m/yyyy`` extract-date suffix from a source id."""
    return F.regexp_replace(_col(c), r"-\d{1,2}/\d{1,2}/\d{4}$", "")


def parse_day_first_timestamp(c: ColumnOrName) -> Column:
    """``DD/MM/YYYY HH24:MI:SS`` text -> timestamp; one- or two-digit parts accepted."""
    return F.to_timestamp(_col(c), "d/M/yyyy H:mm:ss")


def split_code_label(c: ColumnOrName, sep: str = ":") -> tuple[Column, Column]:
    """``'4: Fatal'`` -> (4, 'Fatal'): strict int code and trimmed label."""
    c = _col(c)
    code = F.split_part(c, F.lit(sep), F.lit(1)).cast("int")
    label = F.trim(F.split_part(c, F.lit(sep), F.lit(2)))
    return code, label


def pg_initcap(c: ColumnOrName) -> Column:
    """Title case where a word starts after *any* non-alphanumeric character.

    Spark's ``initcap`` starts words after spaces only (``O'halloran``); this
    follows the convention of capitalising after apostrophes, hyphens and
    dots as well (``O'Halloran``). A space is put after every non-alphanumeric
    character, ``initcap`` is applied, and exactly those spaces are removed
    again: built-in expressions only, so it stays in generated code. Text
    made of letters, digits and spaces only (the common case) needs just
    ``initcap``; one regex test routes the rest through the full form.
    """
    c = _col(c)
    spaced = F.regexp_replace(F.lower(c), r"([^\p{L}\p{N}])", "$1 ")
    full = F.regexp_replace(F.initcap(spaced), r"([^\p{L}\p{N}]) ", "$1")
    return F.when(c.rlike(r"[^\p{L}\p{N} ]"), full).otherwise(F.initcap(c))


def decode(c: ColumnOrName, mapping: Sequence[tuple[object, object]], default: object = None) -> Column:
    """Simple CASE: ``case c when k1 then v1 ... [else default] end``."""
    c = _col(c)
    out = None
    for k, v in mapping:
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    if out is None:
        return F.lit(default)
    return out if default is None else out.otherwise(F.lit(default))


def surrogate_key(cols: Iterable[ColumnOrName]) -> Column:
    """Deterministic hex key of several columns.

    ``md5`` of the members cast to text, NULL replaced by a marker *before*
    joining (``concat_ws`` would silently skip NULLs and merge distinct keys),
    joined by ``-``. Any engine with md5 computes the same key, so a fact can
    compute a dimension's key from its own columns without a join.
    """
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_MARKER)) for c in cols]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


def financial_year(d: ColumnOrName, start_month: int = 7) -> Column:
    """Year in which a financial year that starts in ``start_month`` ends."""
    d = _col(d)
    return (F.year(d) + F.when(F.month(d) >= start_month, 1).otherwise(0)).cast("int")


def iso_day_of_week(d: ColumnOrName) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return (F.weekday(_col(d)) + 1).cast("int")
