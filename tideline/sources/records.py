"""Event records as text lines: parsing with rejects, and formatting.

A parser splits a table of lines into records and rejects. A reject keeps its line and the
reason. ``mode="failfast"`` raises on the first bad line instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tideline.schemas import CAR_EVENT, FARE, RIDE

# Time patterns, and the token of each field of a car line.
TIME_PATTERN = "yyyy-MM-dd HH:mm:ss"
CAR_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ssXX"
CAR_TOKENS = 23
CAR_FIELDS = {
    "car_id": 0,
    "id": 1,
    "consumption": 7,
    "speed": 9,
    "throttle": 12,
    "engineload": 19,
    "longitude": 20,
    "latitude": 21,
    "ts": 22,
}


def _tokens(line: Column, separator: str) -> Column:
    """Tokens of a line; empty ones at the end do not count."""
    if len(separator) == 1:
        kept = F.rtrim(line, F.lit(separator))
    else:
        kept = F.regexp_replace(line, f"(?:{separator})+$", "")
    # one character stands for itself, anything longer is a pattern
    return F.split(kept, rf"\Q{separator}\E" if len(separator) == 1 else separator, -1)


def _number(token: Column, kind: T.DataType) -> Column:
    """A float token, where empty stands for zero."""
    zero = F.lit(0).cast(kind)
    return F.when(token == "", zero).otherwise(token.try_cast(kind))


def _field(token: Column, kind: T.DataType, pattern: str = TIME_PATTERN) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.try_to_timestamp(token, F.lit(pattern))
    if isinstance(kind, T.FloatType):
        return _number(token, kind)
    if isinstance(kind, T.StringType):
        return token
    return token.try_cast(kind)


def _split(
    lines: DataFrame,
    line: str,
    tokens: Column,
    count: int,
    fields: dict[str, Column],
    check: Column | None,
    mode: str,
) -> tuple[DataFrame, DataFrame]:
    # Each one-element explode is a fence: what is inside is computed once per line, not
    # again in every expression and filter above it.
    cut = lines.withColumn("_t", F.explode(F.array(tokens)))
    record = F.struct(*[c.alias(n) for n, c in fields.items()])
    read = cut.withColumn("_p", F.explode(F.array(record)))
    broken = F.lit(False)
    for name in fields:
        broken = broken | F.col(f"_p.{name}").isNull()
    size = F.size("_t")
    reason = F.when(size != count, F.concat(F.lit("tokens: "), size.cast("string")))
    if check is not None:
        reason = reason.when(~check, F.lit("unknown event kind"))
    reason = reason.when(broken, F.lit("unreadable field"))
    parsed = read.withColumn("_reason", reason)
    if mode == "failfast":
        message = F.concat(F.lit("bad line ("), F.col("_reason"), F.lit("): "), F.col(line))
        valid = F.when(F.col("_reason").isNull(), F.lit(True)).otherwise(
            F.raise_error(message).cast("boolean")
        )
        parsed = parsed.filter(valid)
    elif mode != "rejects":
        raise ValueError(f"unknown mode: {mode}")
    extra = [name for name in lines.columns if name != line]
    good = parsed.filter(F.col("_reason").isNull()).select(*extra, "_p.*")
    bad = parsed.filter(F.col("_reason").isNotNull()).select(
        *extra, F.col(line).alias("line"), F.col("_reason").alias("reason")
    )
    return good, bad


def _at(index: int) -> Column:
    return F.get(F.col("_t"), F.lit(index))


def parse_rides(
    lines: DataFrame, line: str = "value", mode: str = "rejects"
) -> tuple[DataFrame, DataFrame]:
    """Ride lines: id, START|END, two times (own time first), four coordinates, passengers,
    taxi, driver. Columns beside the line are kept."""
    start = _at(1) == "START"
    own, other = (_field(_at(i), T.TimestampType()) for i in (2, 3))
    special = {
        "is_start": start,
        "start_time": F.when(start, own).otherwise(other),
        "end_time": F.when(start, other).otherwise(own),
    }
    places = [0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    fields = {
        f.name: special.get(f.name, _field(_at(i), f.dataType)) for i, f in zip(places, RIDE)
    }
    kind_known = _at(1).isin("START", "END")
    return _split(lines, line, _tokens(F.col(line), ","), 11, fields, kind_known, mode)


def parse_fares(
    lines: DataFrame, line: str = "value", mode: str = "rejects"
) -> tuple[DataFrame, DataFrame]:
    """Fare lines: ride, taxi, driver, start time, payment type, tip, tolls, total fare."""
    fields = {f.name: _field(_at(i), f.dataType) for i, f in enumerate(FARE)}
    return _split(lines, line, _tokens(F.col(line), ","), 8, fields, None, mode)


def parse_car_events(
    lines: DataFrame, line: str = "value", mode: str = "rejects"
) -> tuple[DataFrame, DataFrame]:
    """Car lines: 23 tokens between commas or semicolons, nine of which are used."""
    fields = {
        f.name: _field(_at(CAR_FIELDS[f.name]), f.dataType, CAR_TIME_PATTERN) for f in CAR_EVENT
    }
    return _split(lines, line, _tokens(F.col(line), r"[,;]\s*"), CAR_TOKENS, fields, None, mode)


def parse_pairs(
    lines: DataFrame,
    value: T.DataType,
    line: str = "value",
    separator: str = ",",
    mode: str = "rejects",
) -> tuple[DataFrame, DataFrame]:
    """Lines "key<separator>number" as (key, number); blanks around the number are allowed."""
    fields = {"key": _at(0), "number": F.trim(_at(1)).try_cast(value)}
    return _split(lines, line, _tokens(F.col(line), separator), 2, fields, None, mode)


def _text(column: Column) -> Column:
    return column.cast("string")


def _time(column: Column) -> Column:
    return F.date_format(column, TIME_PATTERN)


def format_rides(rides: DataFrame, name: str = "value") -> DataFrame:
    """Rides as lines that :func:`parse_rides` reads back."""
    start, end = _time(F.col("start_time")), _time(F.col("end_time"))
    parts = [
        _text(F.col("ride_id")),
        F.when(F.col("is_start"), "START").otherwise("END"),
        F.when(F.col("is_start"), start).otherwise(end),
        F.when(F.col("is_start"), end).otherwise(start),
        *[_text(F.col(f.name)) for f in RIDE.fields[4:]],
    ]
    return rides.select(F.concat_ws(",", *parts).alias(name))


def format_fares(fares: DataFrame, name: str = "value") -> DataFrame:
    """Fares as lines that :func:`parse_fares` reads back."""
    parts = [
        _time(F.col(f.name)) if f.name == "start_time" else _text(F.col(f.name)) for f in FARE
    ]
    return fares.select(F.concat_ws(",", *parts).alias(name))


def format_segments(
    segments: DataFrame, car: str, start: str, name: str = "value"
) -> DataFrame:
    """Segments as "car, start ms, n events, top speed kph, manner"."""
    start_ms = F.unix_millis(F.col(start).cast("timestamp"))
    line = F.concat_ws(
        ", ",
        _text(F.col(car)),
        _text(start_ms),
        F.concat(_text(F.col("length")), F.lit(" events")),
        F.concat(_text(F.col("max_speed")), F.lit(" kph")),
        F.col("manner"),
    )
    return segments.select(line.alias(name))


def format_pairs(pairs: DataFrame, key: str, number: str, name: str = "value") -> DataFrame:
    """Pairs as "(key,number)"."""
    pair = F.concat(F.lit("("), _text(F.col(key)), F.lit(","), _text(F.col(number)), F.lit(")"))
    return pairs.select(pair.alias(name))
