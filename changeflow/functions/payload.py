"""Column functions over one JSON payload.

A payload is tokenized once per use: ``from_json`` with a struct of the wanted top-level keys. Scalars are
read as STRING, which keeps ``12.0`` apart from ``12``, and keys whose presence or JSON type matters are read as
VARIANT, which keeps an explicit ``null`` apart from a missing key. A repeated key counts with its last value.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNREADABLE = "unreadable"


def field(key: str) -> Column:
    """A key taken out by ``with_payload``."""
    return F.col(f"_p_{key}")


def with_once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds columns that are costly to compute and looked at by later filters.

    They come out of a generator over one struct. A plain projection would be copied into every filter above it,
    each mention of a column computing it again; filters on a generator's output stay above it.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_payload(df: DataFrame, payload: str, text: Sequence[str] = (), variants: Sequence[str] = ()) -> DataFrame:
    """Adds the given top-level keys as columns, see ``field``; ``field("unreadable")`` holds a payload that is
    no JSON object. The struct comes out of a generator for the same reason as in ``with_once``.
    """
    keys = [*text, *variants, UNREADABLE]
    types = [f"`{k}` string" for k in text] + [f"`{k}` variant" for k in variants] + [f"{UNREADABLE} string"]
    parsed = F.from_json(payload, ", ".join(types), {"columnNameOfCorruptRecord": UNREADABLE})
    return df.select("*", F.inline(F.array(parsed)).alias(*[f"_p_{k}" for k in keys]))


def digits(text: Column, sql_type: str, signed: bool = False) -> Column:
    """The number if the whole text is ASCII digits (with an optional minus if signed), else NULL."""
    pattern = r"\A-?[0-9]+\z" if signed else r"\A[0-9]+\z"
    return F.when(text.rlike(pattern), text.try_cast(sql_type))


def integer_key(text: Column) -> Column:
    """A natural key: optionally signed digits, blanks around and single underscores between them allowed."""
    pattern = r"\A\s*[+-]?[0-9]+(_[0-9]+)*\s*\z"
    return F.when(text.rlike(pattern), F.regexp_replace(text, r"[\s_]", "").try_cast("bigint"))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def has_key(value: Column) -> Column:
    """True if the key of a VARIANT field was there, whatever its value."""
    return value.isNotNull()


def array_length(value: Column) -> Column:
    """Length of a VARIANT field that is a JSON array, 0 for anything else (a string like "[1]" included)."""
    return F.coalesce(F.size(F.try_variant_get(value, "$", "array<variant>")), F.lit(0))


def is_truthy(value: Column) -> Column:
    """False for a missing key and for null, false, 0, "", [] and {}."""
    return F.coalesce(~F.to_json(value).isin("null", "false", "0", "0.0", '""', "[]", "{}"), F.lit(False))


def names_key(payload: Column, key: str) -> Column:
    """True if the payload is an object with this top-level key. A second tokenizing: for rare rows only."""
    return F.coalesce(F.array_contains(F.json_object_keys(payload), key), F.lit(False))


def canonical_json(payload: Column) -> Column:
    """The payload with sorted keys and no blanks; text that is no JSON stays as it is."""
    return F.coalesce(F.to_json(F.try_parse_json(payload)), payload)
