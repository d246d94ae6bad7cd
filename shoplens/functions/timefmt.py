"""Time helpers that do not depend on the session time zone.

Epoch milliseconds are turned into wall-clock text in an explicit zone through
TIMESTAMP_NTZ arithmetic, so the same query gives the same dates whatever
``spark.sql.session.timeZone`` the cluster runs with.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ms_from_ntz(col: Column | str) -> Column:
    """Epoch milliseconds of a TIMESTAMP_NTZ read as UTC wall time."""
    return F.timestamp_diff("MILLISECOND", F.expr(EPOCH_NTZ), _c(col).cast("timestamp_ntz"))


def local_ntz(ms: Column | str, zone: str = "UTC") -> Column:
    """Wall-clock time of epoch ms in ``zone``, as TIMESTAMP_NTZ."""
    utc_wall = F.timestamp_add("MILLISECOND", _c(ms), F.expr(EPOCH_NTZ))
    if zone.upper() == "UTC":
        return utc_wall
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall)


def log_date(ms: Column | str, zone: str = "UTC") -> Column:
    """``yyyy-MM-dd`` text of epoch ms in ``zone``."""
    return F.date_format(local_ntz(ms, zone), "yyyy-MM-dd")


def log_hour(ms: Column | str, zone: str = "UTC") -> Column:
    """``HH`` text of epoch ms in ``zone``."""
    return F.date_format(local_ntz(ms, zone), "HH")


def create_date(create_time: Column | str) -> Column:
    """Date part of ``yyyy-MM-dd HH:mm:ss`` text (P2); null-safe."""
    return F.split(_c(create_time), " ").getItem(0)


def create_hour(create_time: Column | str) -> Column:
    """Hour part of ``yyyy-MM-dd HH:mm:ss`` text (P2); null when absent."""
    time_part = F.try_element_at(F.split(_c(create_time), " "), F.lit(2))
    return F.split(time_part, ":").getItem(0)


def minute_bucket(ms: Column | str) -> Column:
    """Epoch minute of epoch ms (integer division, P7)."""
    return F.floor(_c(ms) / F.lit(60000)).cast("long")
