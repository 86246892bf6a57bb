"""Times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _col


# Seconds up to which a timestamp can be held; corrupt records may have more.
MAX_SECONDS = (2**63 - 1) // 1_000_000


def positive_timestamp(epoch_seconds: Column | str) -> Column:
    """Epoch seconds as a timestamp; zero and negative values mean "not set", as do impossible ones."""
    seconds = _col(epoch_seconds)
    return F.when((seconds > 0) & (seconds <= MAX_SECONDS), F.timestamp_seconds(seconds))


def ctime_text(epoch_seconds: Column | str) -> Column:
    """``Thu Jan  1 00:00:00 1970`` in the session time zone, day padded with a space."""
    ts = F.timestamp_seconds(_col(epoch_seconds))
    return F.concat_ws(
        " ",
        F.date_format(ts, "EEE MMM"),
        F.lpad(F.dayofmonth(ts).cast("string"), 2, " "),
        F.date_format(ts, "HH:mm:ss yyyy"),
    )
