"""Typed, deduplicated view over the raw table: one row per change event."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from changeflow.functions.payload import array_length, blank_to_null, digits, field, has_key, with_payload
from changeflow.functions.times import zoned_timestamp
from changeflow.schemas import STAGING, UNKNOWN_USER

# Keys whose presence or JSON type matters; all others are read as text.
_TYPED_KEYS = ["bot", "minor", "anon", "redirect", "userhidden", "tags"]

# The payload key behind each column.
_KEY_OF = {
    "change_id": "rcid",
    "change_type": "type",
    "namespace_id": "ns",
    "page_title": "title",
    "page_id": "pageid",
    "revision_id": "revid",
    "old_revision_id": "old_revid",
    "user_name": "user",
    "user_id": "userid",
    "change_comment": "comment",
    "changed_at_utc": "timestamp",
    "old_length": "oldlen",
    "new_length": "newlen",
    "is_bot": "bot",
    "is_minor": "minor",
    "is_anonymous": "anon",
    "is_redirect": "redirect",
    "is_user_hidden": "userhidden",
    "is_user_missing": "user",
    "tag_count": "tags",
}


def _projection() -> dict[str, Column]:
    """Output column -> expression over the parsed payload, in output order."""
    stamp = field("timestamp")
    return {
        "change_id": digits(field("rcid"), "bigint"),
        "change_type": blank_to_null(field("type")),
        "namespace_id": digits(field("ns"), "int", signed=True),
        "page_title": blank_to_null(field("title")),
        "page_id": digits(field("pageid"), "bigint"),
        "revision_id": digits(field("revid"), "bigint"),
        "old_revision_id": digits(field("old_revid"), "bigint"),
        "user_name": F.coalesce(blank_to_null(field("user")), F.lit(UNKNOWN_USER)),
        "user_id": digits(field("userid"), "bigint"),
        "change_comment": blank_to_null(field("comment")),
        "changed_at_utc": F.coalesce(zoned_timestamp(stamp), stamp.try_cast("timestamp")),
        "old_length": digits(field("oldlen"), "bigint", signed=True),
        "new_length": digits(field("newlen"), "bigint", signed=True),
        "is_bot": has_key(field("bot")),
        "is_minor": has_key(field("minor")),
        "is_anonymous": has_key(field("anon")),
        "is_redirect": has_key(field("redirect")),
        "is_user_hidden": has_key(field("userhidden")),
        "is_user_missing": blank_to_null(field("user")).isNull(),
        "tag_count": array_length(field("tags")),
    }


def type_records(raw: DataFrame, columns: Sequence[str] | None = None, kept: Sequence[str] = ()) -> DataFrame:
    """Every raw row typed, before deduplication; ``_raw_id`` is kept for it. Only the keys behind ``columns`` (all by
    default) are taken out of the payload."""
    wanted = list(_KEY_OF) if columns is None else [c for c in _KEY_OF if c in columns]
    keys = list(dict.fromkeys(_KEY_OF[c] for c in wanted))
    parsed = with_payload(
        raw, "_raw", text=[k for k in keys if k not in _TYPED_KEYS], variants=[k for k in keys if k in _TYPED_KEYS]
    )
    made = _projection()
    return parsed.select("_raw_id", *[made[c].alias(c) for c in wanted], "_window_start", "_window_end", "_ingested_at", *kept)


def latest_per_key(typed: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row of each key by ``order``; rows without a key count as one key."""
    newest = F.row_number().over(W.partitionBy(key).orderBy(*[F.col(c).desc_nulls_first() for c in order]))
    return typed.withColumn("_position", newest).filter("_position = 1").drop("_position")


def staging(raw: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Lazy view. The payload is parsed first, so the shuffle carries typed columns and no JSON; with ``columns``, only
    their keys are."""
    typed = type_records(raw, None if columns is None else ["change_id", *columns])
    latest = latest_per_key(typed, "change_id", ["_ingested_at", "_raw_id"])
    return latest.select([c for c in STAGING.fieldNames() if c in latest.columns])


def staging_of_unique(raw: DataFrame) -> DataFrame:
    """Typed rows without a shuffle, with ``_raw_id`` and, if raw has it, ``_load_id``, for a raw table that holds every key
    once: there is nothing to deduplicate then but the rows without a typed key."""
    kept = [c for c in ("_load_id",) if c in raw.columns]
    return type_records(raw, kept=kept).select(*STAGING.fieldNames(), "_raw_id", *kept)
