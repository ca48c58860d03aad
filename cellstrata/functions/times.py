"""Calendar windows, dataset time and nanosecond words as Column arithmetic (UTC)."""

from __future__ import annotations

import re
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed: date formats of window labels; seconds by which a scale is ahead of UTC, for epochs before 2017.
FORMATS = {"yearly": "yyyy", "monthly": "yyyyMM", "daily": "yyyyMMdd"}
UNITS = {"yearly": "year", "monthly": "month", "daily": "day"}
AHEAD = {"utc": 0, "gps": 18, "tai": 37}
LABEL = re.compile(r"[0-9A-Za-z-]{1,32}")


def parse(text: str) -> datetime:
    """ISO time as UTC; naive times are UTC."""
    found = datetime.fromisoformat(text.replace("Z", "+00:00"))
    return found.replace(tzinfo=UTC) if found.tzinfo is None else found.astimezone(UTC)


def render(when: datetime) -> str:
    return when.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def _known(schedule: str) -> None:
    if schedule not in FORMATS:
        raise ValueError(f"schedule {schedule!r} is not one of {sorted(FORMATS)}")


def label(ts, schedule: str) -> Column:
    _known(schedule)
    return F.date_format(ts, FORMATS[schedule])


def bounds(text, schedule: str) -> tuple[Column, Column]:
    """Start and end (exclusive) of a labelled window."""
    _known(schedule)
    start = F.to_timestamp(text, FORMATS[schedule])
    return start, start + F.expr(f"INTERVAL 1 {UNITS[schedule]}")


def windows_of_span(start, end, schedule: str) -> Column:
    """Labels of all windows that a closed span meets."""
    _known(schedule)
    unit = UNITS[schedule]
    starts = F.sequence(F.date_trunc(unit, start), F.date_trunc(unit, end), F.expr(f"INTERVAL 1 {unit}"))
    return F.transform(starts, lambda t: F.date_format(t, FORMATS[schedule]))


def explicit_windows(spark, windows: list[tuple[str, str, str | None]]) -> DataFrame:
    """label, start, end from declared bounds; a bare instant is a window of one second. Labels must be fit for paths and differ."""
    rows = []
    for name, start, end in windows:
        if not LABEL.fullmatch(name):
            raise ValueError(f"window label {name!r}")
        begin = parse(start)
        until = parse(end) if end else begin + timedelta(seconds=1)
        if until <= begin:
            raise ValueError(f"window {name} ends before it starts")
        rows.append((name, begin, until))
    if len({r[0] for r in rows}) < len(rows):
        raise ValueError("window labels repeat")
    return spark.createDataFrame(rows, "label string, start timestamp, end timestamp")


def in_windows(df: DataFrame, ts: str, windows: DataFrame) -> DataFrame:
    """df with the label of each half-open window that holds ts.

    Windows are dealt over the days they touch, so that the join has a key; it is
    not a nested loop.
    """
    days = windows.withColumn("__day", F.explode(F.sequence(F.to_date("start"), F.to_date(F.col("end") - F.expr("INTERVAL 1 MICROSECOND")))))
    keyed = df.withColumn("__day", F.to_date(ts))
    return keyed.join(days, "__day").where((F.col(ts) >= F.col("start")) & (F.col(ts) < F.col("end"))).drop("__day", "start", "end")


def scale_offset(epoch: str, scale: str) -> int:
    """Seconds from UTC to a scale: counted only for epochs before 2017."""
    return AHEAD[scale] if scale != "utc" and parse(epoch) < datetime(2017, 1, 1, tzinfo=UTC) else 0


def to_nanoseconds(offset, epoch: str, scale: str = "utc", units: str = "seconds") -> Column:
    """Nanoseconds since 1970 (UTC) of a dataset's offset; whole and fractional seconds apart, so that none is lost. Offsets that aren't finite are refused."""
    x = (F.col(offset) if isinstance(offset, str) else offset).cast("double")
    x = x * 86400.0 if units == "days" else x
    checked = F.when(F.isnan(x) | (F.abs(x) == float("inf")), F.raise_error(F.lit("time offset is not finite"))).otherwise(x)
    whole = F.floor(checked)
    base = int(parse(epoch).timestamp()) - scale_offset(epoch, scale)
    return (F.lit(base) + whole) * F.lit(1_000_000_000) + F.rint((checked - whole) * 1e9).cast("long")


def from_datetime(when: datetime, epoch: str, scale: str = "utc", units: str = "seconds") -> float:
    """A dataset's offset of an instant."""
    seconds = (when - parse(epoch)).total_seconds() + scale_offset(epoch, scale)
    return seconds / 86400.0 if units == "days" else seconds


def overlaps(start, end, low, high) -> Column:
    """Whether an envelope meets a half-open window; equal bounds are an instant, null bounds are unknown and match."""
    start, end = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    meets = (start < high) & F.when(start == end, end >= low).otherwise(end > low)
    return start.isNull() | end.isNull() | meets


def time_union(start, end) -> list[Column]:
    """Aggregates: the envelope of spans; those that end before they start don't count."""
    good = F.col(start) <= F.col(end)
    return [F.min(F.when(good, F.col(start))).alias("start"), F.max(F.when(good, F.col(end))).alias("end")]


def micros(ts) -> Column:
    """Microseconds since 1970 (UTC) of an instant; one without a zone is UTC, as the session's."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def envelope_words(start, end) -> Column:
    """A time axis's envelope as two words of nanoseconds; an envelope that ends before it starts is refused."""
    start, end = (F.col(x) if isinstance(x, str) else x for x in (start, end))
    low, high = micros(start) * 1000, micros(end) * 1000
    return F.struct(low.alias("start"), F.when(high < low, F.raise_error(F.lit("an envelope ends before it starts")).cast("long")).otherwise(high).alias("end"))


def from_words(words) -> tuple[Column, Column]:
    """Instants of an envelope's words, to the microsecond."""
    words = F.col(words) if isinstance(words, str) else words
    return F.timestamp_micros(F.floor(words["start"] / 1000)), F.timestamp_micros(F.floor(words["end"] / 1000))


def within(ts, start: str | None, end: str | None) -> Column:
    """Temporal bounds of a run: half-open, either side may be open."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    good = F.lit(True)
    if start is not None:
        good = good & (ts >= F.lit(parse(start)))
    return good & (ts < F.lit(parse(end))) if end is not None else good
