"""Record validation and routing, in one pass over the payload."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeflow.functions.fingerprints import record_fingerprint
from changeflow.functions.payload import field, integer_key, names_key, with_once, with_payload
from changeflow.functions.times import is_zoneless, zoned_timestamp
from changeflow.schemas import MESSAGE_LIMIT

OK, ERROR, OUTSIDE = "ok", "error", "outside_window"


def _key_message(payload: Column, rcid: Column) -> Column:
    return (
        F.when(field("unreadable").isNotNull(), F.lit("record is not a JSON object"))
        .when(~names_key(payload, "rcid"), F.lit("'rcid'"))
        .when(rcid.isNull(), F.lit("int() argument must be a string, a bytes-like object or a real number, not 'NoneType'"))
        .otherwise(F.concat(F.lit("invalid literal for int() with base 10: '"), rcid, F.lit("'")))
    )


def _time_message(payload: Column, stamp: Column) -> Column:
    return (
        F.when(~names_key(payload, "timestamp"), F.lit("'timestamp'"))
        .when(stamp.isNull(), F.lit("Invalid isoformat string: 'None'"))
        .when(is_zoneless(stamp), F.concat(F.lit("Timestamp has no timezone: "), stamp))
        .otherwise(
            F.concat(F.lit("Invalid isoformat string: '"), F.replace(stamp, F.lit("Z"), F.lit("+00:00")), F.lit("'"))
        )
    )


def classify(records: DataFrame) -> DataFrame:
    """Adds ``_key, event_time, status, error_type, error_message``; the first failing rule names the error.

    Rules in order: the payload is JSON, the natural key is an integer, the event time carries a zone, and the
    event lies in its half-open window. A record outside its window is no error; it is counted and left out.
    """
    raw, start, end = F.col("_raw"), F.col("_window_start"), F.col("_window_end")
    rcid, stamp = field("rcid"), field("timestamp")
    key, when = F.col("_key"), F.col("event_time")
    # text that is no object may still be JSON (a number, a list): only those few are parsed again
    no_json = (F.trim(raw) == "") | (field("unreadable").isNotNull() & F.try_parse_json(raw).isNull())
    error_type = (
        F.when(F.coalesce(F.col("_no_json"), F.lit(True)), F.lit("invalid_record"))
        .when(key.isNull(), F.lit("invalid_natural_key"))
        .when(when.isNull(), F.lit("invalid_timestamp"))
    )
    status = (
        F.when(F.col("error_type").isNotNull(), F.lit(ERROR))
        .when((when >= start) & (when < end), F.lit(OK))
        .otherwise(F.lit(OUTSIDE))
    )
    message = (
        F.when(F.col("error_type") == "invalid_record", F.lit("Unknown validation error"))
        .when(F.col("error_type") == "invalid_natural_key", _key_message(raw, rcid))
        .when(F.col("error_type") == "invalid_timestamp", _time_message(raw, stamp))
    )
    parsed = with_payload(records, "_raw", text=["rcid", "timestamp"])
    return (
        with_once(parsed, {"_no_json": no_json, "_key": integer_key(rcid), "event_time": zoned_timestamp(stamp)})
        .withColumn("error_type", error_type)
        .withColumns({"status": status, "error_message": message})
        .drop("_p_rcid", "_p_timestamp", "_p_unreadable", "_no_json")
    )


def valid_records(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col("status") == OK)


def error_rows(judged: DataFrame) -> DataFrame:
    """Bad records in the shape of the errors table, without ids and not yet deduplicated."""
    return judged.filter(F.col("status") == ERROR).select(
        record_fingerprint(F.col("_raw"), F.col("_window_start"), F.col("_window_end")).alias("_error_fingerprint"),
        *[c for c in judged.columns if c not in ("_key", "event_time", "status", "error_type", "error_message")],
        F.coalesce("error_type", F.lit("invalid_record")).alias("_error_type"),
        F.left(F.coalesce("error_message", F.lit("Unknown validation error")), F.lit(MESSAGE_LIMIT)).alias(
            "_error_message"
        ),
    )
