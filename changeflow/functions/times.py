"""ISO-8601 text and instants. All texts are read and written in UTC (the session zone is pinned to it)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

_ZONE = r"(Z|[+-]\d{2}(?::?\d{2})?)"
_PLAIN = r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}Z\z"

# Accepted date and clock forms, each with the text that Spark's own cast reads (fixed values).
_FORMS = [
    (r"(\d{4}-\d{2}-\d{2}).(\d{2}:\d{2}:\d{2})", "$1T$2"),
    (r"(\d{4}-\d{2}-\d{2}).(\d{2}:\d{2}:\d{2})[.,](\d+)", "$1T$2.$3"),
    (r"(\d{4}-\d{2}-\d{2}).(\d{2}:\d{2})", "$1T$2:00"),
    (r"(\d{4})(\d{2})(\d{2}).(\d{2})(\d{2})(\d{2})", "$1-$2-$3T$4:$5:$6"),
]


def zoned_timestamp(text: Column) -> Column:
    """The instant named by an ISO-8601 text that carries a zone, else NULL. Zoneless text never passes."""
    instant = F.when(text.rlike(_PLAIN), text.try_cast("timestamp"))
    for form, readable in _FORMS:
        pattern = rf"\A{form}{_ZONE}\z"
        zone = f"${form.count('(') + 1}"
        instant = instant.when(text.rlike(pattern), F.regexp_replace(text, pattern, readable + zone).try_cast("timestamp"))
    return instant


def is_zoneless(text: Column) -> Column:
    """True for a date or a date and time that would be valid but for the missing zone."""
    dated = text.rlike(r"\A\d{4}-\d{2}-\d{2}\z") & text.try_cast("date").isNotNull()
    return dated | zoned_timestamp(F.concat(text, F.lit("Z"))).isNotNull()


def iso_utc(instant: Column) -> Column:
    """``2024-01-01T00:00:00+00:00``; six fraction digits only if the fraction is not zero."""
    whole = F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.when(F.date_trunc("second", instant) == instant, F.lit("")).otherwise(
        F.date_format(instant, ".SSSSSS")
    )
    return F.concat(whole, fraction, F.lit("+00:00"))


def request_time(instant: Column) -> Column:
    """``2024-01-01T00:00:00Z``, the form the source is asked with."""
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")
