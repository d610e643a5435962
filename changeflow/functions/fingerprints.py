"""Identity of a bad record."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeflow.functions.payload import canonical_json
from changeflow.functions.times import iso_utc


def record_fingerprint(payload: Column, window_start: Column, window_end: Column) -> Column:
    """SHA-256 over the canonical payload and the window it was delivered for."""
    return F.sha2(F.concat_ws("|", canonical_json(payload), iso_utc(window_start), iso_utc(window_end)), 256)
