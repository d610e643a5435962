"""Explicit schemas and fixed values shared by all modules. Nothing is ever inferred from data."""

from pyspark.sql import types as T

# At rest the raw table carries, next to its five public columns, the natural key, the event date (its
# partition column) and the page it came from, so that no later job has to parse JSON to find them.
RAW_COLUMNS = ["_raw_id", "_raw", "_window_start", "_window_end", "_ingested_at"]

RAW = T.StructType(
    [
        T.StructField("_raw_id", T.LongType()),
        T.StructField("_raw", T.StringType()),
        T.StructField("_window_start", T.TimestampType()),
        T.StructField("_window_end", T.TimestampType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_key", T.LongType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("_load_id", T.StringType()),
        T.StructField("_event_date", T.DateType()),
    ]
)

ERRORS = T.StructType(
    [
        T.StructField("_error_id", T.LongType()),
        T.StructField("_error_fingerprint", T.StringType()),
        T.StructField("_raw", T.StringType()),
        T.StructField("_error_type", T.StringType()),
        T.StructField("_error_message", T.StringType()),
        T.StructField("_window_start", T.TimestampType()),
        T.StructField("_window_end", T.TimestampType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("_load_id", T.StringType()),
        T.StructField("_window_date", T.DateType()),
    ]
)

STAGING = T.StructType(
    [
        T.StructField("change_id", T.LongType()),
        T.StructField("change_type", T.StringType()),
        T.StructField("namespace_id", T.IntegerType()),
        T.StructField("page_title", T.StringType()),
        T.StructField("page_id", T.LongType()),
        T.StructField("revision_id", T.LongType()),
        T.StructField("old_revision_id", T.LongType()),
        T.StructField("user_name", T.StringType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("change_comment", T.StringType()),
        T.StructField("changed_at_utc", T.TimestampType()),
        T.StructField("old_length", T.LongType()),
        T.StructField("new_length", T.LongType()),
        T.StructField("is_bot", T.BooleanType()),
        T.StructField("is_minor", T.BooleanType()),
        T.StructField("is_anonymous", T.BooleanType()),
        T.StructField("is_redirect", T.BooleanType()),
        T.StructField("is_user_hidden", T.BooleanType()),
        T.StructField("is_user_missing", T.BooleanType()),
        T.StructField("tag_count", T.IntegerType()),
        T.StructField("_window_start", T.TimestampType()),
        T.StructField("_window_end", T.TimestampType()),
        T.StructField("_ingested_at", T.TimestampType()),
    ]
)

RATE = T.DecimalType(20, 4)

MART = T.StructType(
    [
        T.StructField("activity_date", T.DateType()),
        T.StructField("namespace_id", T.IntegerType()),
        T.StructField("namespace_name", T.StringType()),
        T.StructField("total_changes", T.LongType()),
        T.StructField("edit_count", T.LongType()),
        T.StructField("new_page_count", T.LongType()),
        T.StructField("log_count", T.LongType()),
        T.StructField("bot_changes", T.LongType()),
        T.StructField("anonymous_changes", T.LongType()),
        T.StructField("minor_changes", T.LongType()),
        T.StructField("missing_user_changes", T.LongType()),
        T.StructField("unique_users", T.LongType()),
        T.StructField("net_bytes_change", T.LongType()),
        T.StructField("bot_rate", RATE),
        T.StructField("anonymous_rate", RATE),
    ]
)

LOAD_STATS = T.StructType(
    [
        T.StructField("_window_start", T.TimestampType()),
        T.StructField("_window_end", T.TimestampType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("fetched", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("duplicates", T.LongType()),
        T.StructField("quarantined", T.LongType()),
        T.StructField("outside_window", T.LongType()),
        T.StructField("pages", T.LongType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_load_id", T.StringType()),
        T.StructField("_window_date", T.DateType()),
    ]
)

# Pages that a load could not take: with an error, or no page at all. A later landing of the page settles it.
BAD_PAGES = T.StructType(
    [
        T.StructField("_window_start", T.TimestampType()),
        T.StructField("_window_end", T.TimestampType()),
        T.StructField("page_no", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("detail", T.StringType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_load_id", T.StringType()),
    ]
)

# Rows written before a load's own: one per event date with the range of its valid keys (so that an odd key widens
# its own date alone), and one without a date; each holds the first row id handed out and the first one still free
# (a sequence with gaps).
LOADS = T.StructType(
    [
        T.StructField("first_id", T.LongType()),
        T.StructField("next_id", T.LongType()),
        T.StructField("low_key", T.LongType()),
        T.StructField("high_key", T.LongType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("_ingested_at", T.TimestampType()),
        T.StructField("_load_id", T.StringType()),
    ]
)

# Blocks of the Bloom filters of a load's keys, a filter per event date.
KEY_FILTERS = T.StructType(
    [
        T.StructField("level", T.IntegerType()),
        T.StructField("block", T.LongType()),
        T.StructField("bits", T.BinaryType()),
        T.StructField("_load_id", T.StringType()),
        T.StructField("event_date", T.DateType()),
    ]
)

# Intervals of good pages, as each load saw them.
PAGE_LEDGER = T.StructType(
    [
        T.StructField("_window_start", T.TimestampType()),
        T.StructField("_window_end", T.TimestampType()),
        T.StructField("first_page", T.LongType()),
        T.StructField("last_page", T.LongType()),
        T.StructField("has_more", T.BooleanType()),
        T.StructField("_load_id", T.StringType()),
        T.StructField("_window_date", T.DateType()),
    ]
)

# What each load adds to a day: counters, and users as bitmaps over the numbers of the day's dictionary.
DAY_COUNTERS = T.StructType(
    [
        *[f for f in MART.fields if f.name not in ("activity_date", "namespace_name", "unique_users") and f.dataType != RATE],
        T.StructField("activity_date", T.DateType()),
        T.StructField("_load_id", T.StringType()),
    ]
)

DAY_USERS = T.StructType(
    [
        T.StructField("namespace_id", T.IntegerType()),
        T.StructField("bucket", T.LongType()),
        T.StructField("users", T.BinaryType()),
        T.StructField("activity_date", T.DateType()),
        T.StructField("_load_id", T.StringType()),
    ]
)

USER_NUMBERS = T.StructType(
    [
        T.StructField("user_name", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("activity_date", T.DateType()),
    ]
)

# Which loads' additions to a date count; a folded row stands for those that it replaces.
STATE_LOG = T.StructType(
    [
        T.StructField("activity_date", T.DateType()),
        T.StructField("_load_id", T.StringType()),
        T.StructField("replaces", T.ArrayType(T.StringType())),
    ]
)

# Steps of a backfill that are done for a window date, and the digest of the files that had landed for it.
BACKFILL_STEPS = T.StructType(
    [
        T.StructField("window_date", T.DateType()),
        T.StructField("step", T.StringType()),
        T.StructField("digest_rows", T.LongType()),
        T.StructField("digest_sum", T.DecimalType(30, 0)),
        T.StructField("digest_salted_sum", T.DecimalType(30, 0)),
        T.StructField("done_at", T.TimestampType()),
    ]
)

# A landed line: one source page with the window and page number it was fetched for, and perhaps when.
LANDED_LINE = (
    "window_start string, window_end string, page bigint, fetched_at string, "
    "body struct<query: struct<recentchanges: array<string>>, `continue`: variant, error: variant>, "
    "_unreadable string"
)

# ---- fixed values -------------------------------------------------------------------------------

CHANGE_TYPES = ["edit", "new", "log", "categorize", "external"]

NAMESPACE_LABELS = {
    0: "Bài viết",
    1: "Thảo luận",
    2: "Thành viên",
    3: "Thảo luận thành viên",
    4: "Wikipedia",
    5: "Thảo luận Wikipedia",
    6: "Tập tin",
    7: "Thảo luận tập tin",
    10: "Bản mẫu",
    11: "Thảo luận bản mẫu",
    12: "Trợ giúp",
    13: "Thảo luận trợ giúp",
    14: "Thể loại",
    15: "Thảo luận thể loại",
}

UNKNOWN_USER = "unknown"
MESSAGE_LIMIT = 2000
RETENTION_DAYS = 30
MAX_PAGES = 5000
TOP_NAMESPACES = 10
