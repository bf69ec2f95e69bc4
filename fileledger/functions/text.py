"""Times in file names, errors, figures and typed properties."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What marks an error as one of the connection.
CONNECTION_WORDS = ["ssh", "banner", "socket", "connection", "eof", "closed", "timed out", "timeout", "reset", "broken pipe"]


#: A date, and a time that may stand right after it. Groups: year, month, day, the time with its mark, hour, separator, minute, separator, second.
_DASHED = r"(\d{4})-(\d\d)-(\d\d)(T(\d\d)([:-])(\d\d)([:-])(\d\d))?"
_COMPACT = r"(\d{4})(\d\d)(\d\d)(_(\d\d)()(\d\d)()(\d\d))?"


def _moment(name: Column, form: str) -> Column:
    """The time that the first hit of a form says; null if there is none, or if it isn't real: a bad time spoils its date."""
    part = lambda i: F.regexp_extract(name, form, i)
    number = lambda i: F.when(part(4) == "", 0).otherwise(part(i).try_cast("int"))
    year, month, day = (part(i).try_cast("int") for i in (1, 2, 3))
    real = (year > 0) & (part(6) == part(8)) & (number(9) < 60)
    return F.when(real, F.try_make_timestamp_ntz(year, month, day, number(5), number(7), number(9)))


def filename_timestamp(name: Column) -> Column:
    """The time in a file name, as timestamp_ntz; else null.

    A date with dashes comes first, with ``T`` and a time whose two separators are alike, if one follows; then eight
    digits, with ``_`` and six more, if they follow. Year 0 is none.
    """
    return F.coalesce(_moment(name, _DASHED), _moment(name, _COMPACT))


def is_conn_error(error: Column) -> Column:
    """Whether an error is one of the connection; false for null and empty ones."""
    low = F.lower(error)
    any_of = F.lit(False)
    for word in CONNECTION_WORDS:
        any_of = any_of | low.contains(word)
    return F.coalesce(any_of, F.lit(False))


def megabytes(n: Column) -> Column:
    return n / F.lit(1024.0 * 1024.0)


def per_second(amount: Column, seconds: Column) -> Column:
    """0 where no time passed."""
    return F.when(seconds > 0, amount / seconds).otherwise(F.lit(0.0))


def ratio(before: Column, after: Column) -> Column:
    """How many times smaller; null where nothing was sent."""
    return F.when(after > 0, before / after)


def tag_props(values: Column, kinds: Column) -> Column:
    """``map<string, string>`` of values and of their types to ``map<string, struct<t, dt, v>>``.

    Types: ``timestamp`` (t: dt64), ``interval`` in microseconds (td64), a numpy type name (np, with dt), ``boolean``,
    ``bigint``, ``double`` and ``string`` (py); others are kept as text (str).
    """
    plain, numpy = ["boolean", "bigint", "double", "string"], ["int8", "int16", "int32", "int64", "uint8", "uint16", "uint32", "uint64", "float32", "float64", "bool"]

    def one(k: Column, v: Column) -> Column:
        kind = F.try_element_at(kinds, k)
        tag = F.when(kind == "timestamp", "dt64").when(kind == "interval", "td64").when(kind.isin(numpy), "np").when(kind.isin(plain), "py").otherwise("str")
        return F.struct(tag.alias("t"), F.when(tag.isin("np", "py"), kind).alias("dt"), v.alias("v"))

    return F.transform_values(values, one)


def untag_props(props: Column, name: str, kind: str) -> Column:
    """One property as ``kind``, null if it is absent or doesn't cast; intervals are microseconds."""
    return F.try_element_at(props, F.lit(name))["v"].try_cast(kind)


def props_to_json(props: Column) -> Column:
    return F.to_json(props)


def props_from_json(text: Column) -> Column:
    return F.from_json(text, "map<string, struct<t: string, dt: string, v: string>>")


def props_equal(a: Column, b: Column) -> Column:
    """Whether two property maps hold the same entries."""
    return F.array_sort(F.map_entries(a)).eqNullSafe(F.array_sort(F.map_entries(b)))
