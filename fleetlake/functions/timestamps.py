"""ISO-8601 event-time parsing.

Accepted text: ``YYYY-MM-DD`` optionally followed by ``T`` or a space, ``HH:MM``,
optional seconds and fraction, and an optional ``Z`` or ``+HH:MM``/``-HH:MM``
offset. Naive times are UTC (the session zone is UTC); offsets are normalised to
UTC. Anything else (``2024``, ``20240101``, week dates, ``nope``) gives null, which
the contract reports as a violation instead of failing the batch.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the accepted ISO-8601 grammar.
ISO_DATETIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:\d{2})?)?$"


def parse_iso_timestamp(text: Column) -> Column:
    """UTC TIMESTAMP of an ISO-8601 text, or null when the text does not parse
    (including impossible dates such as February 30)."""
    # hour:minute (16 characters) directly followed by a zone gets ":00" seconds (Spark's parser needs them)
    normal = F.when(F.substring(text, 17, 1).isin("Z", "+", "-"), F.concat(F.left(text, F.lit(16)), F.lit(":00"), F.substr(text, F.lit(17)))) \
        .otherwise(text)
    return F.when(text.rlike(ISO_DATETIME), F.try_to_timestamp(normal))


def iso_text(ts: Column) -> Column:
    """ISO-8601 text with microseconds and a ``+00:00`` offset (UTC session)."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))


def alert_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS[.ffffff]+00:00`` -- how the detector prints a UTC time."""
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"),
                    F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(F.lit("")),
                    F.lit("+00:00"))
