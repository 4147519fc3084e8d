"""Derived columns, flags and predicates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from roadgauge import schemas as S

NULL_POLICIES = ("else_branch", "default", "unknown")


# --- time keys ---------------------------------------------------------------------------

def date_key(ts) -> Column:
    """yyyyMMdd as int, by arithmetic: no text is built per row."""
    ts = _col(ts)
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.day(ts)).cast("int")


def time_key(ts) -> Column:
    """hour * 100 + minute."""
    ts = _col(ts)
    return (F.hour(ts) * 100 + F.minute(ts)).cast("int")


def event_date(ts) -> Column:
    """yyyy-MM-dd text, the partition value of event tables."""
    return F.to_date(_col(ts)).cast("string")


def event_hour(ts) -> Column:
    return F.hour(_col(ts))


def day_number(ts) -> Column:
    """Sunday = 1 ... Saturday = 7."""
    return F.dayofweek(_col(ts))


def day_name(ts) -> Column:
    return F.date_format(_col(ts), "EEEE")


def is_weekend(ts) -> Column:
    return F.weekday(_col(ts)) >= 5


def is_business_hours(ts) -> Column:
    """Hours 9 to 17, both inclusive, so 17:59 counts."""
    return F.hour(_col(ts)).between(9, 17)


# --- categories --------------------------------------------------------------------------

def _category(value: Column, limits, top: str, inclusive: bool, null_policy: str, default) -> Column:
    """First limit the value is under (or at, if inclusive), else ``top``.

    A null value takes the top category ("else_branch"), the category of ``default``
    ("default"), or "UNKNOWN".
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    if null_policy == "default":
        value = F.coalesce(value, F.lit(default))
    tests = [((value <= limit) if inclusive else (value < limit), name) for limit, name in limits]
    if null_policy == "unknown":
        tests.insert(0, (value.isNull(), "UNKNOWN"))
    return reduce(lambda chain, test: chain.when(*test), tests, F).otherwise(top)


def speed_category(speed="speed_mph", null_policy: str = "else_branch") -> Column:
    """0 is STOPPED; negative speeds count as SLOW."""
    speed = _col(speed)
    known = F.coalesce(speed, F.lit(0.0)) if null_policy == "default" else speed
    moving = _category(speed, S.SPEED_LIMITS, "VERY_FAST", False, null_policy, 0.0)
    return F.when(known == 0, "STOPPED").otherwise(moving)


def fuel_status(fuel="fuel_level", null_policy: str = "else_branch") -> Column:
    return _category(_col(fuel), S.FUEL_LIMITS, "GOOD", False, null_policy, 1.0)


def delay_category(delay="delay_minutes", null_policy: str = "else_branch") -> Column:
    return _category(_col(delay), S.DELAY_LIMITS, "SEVERE_DELAY", True, null_policy, 0)


def package_size(weight="package_weight_lbs", null_policy: str = "else_branch") -> Column:
    return _category(_col(weight), S.WEIGHT_LIMITS, "EXTRA_LARGE", False, null_policy, 0.0)


# --- flags -------------------------------------------------------------------------------

def is_moving(status="engine_status") -> Column:
    """Engine on; speed is not looked at."""
    return _col(status) == "ON"


def is_on_time(delay="delay_minutes") -> Column:
    """Null delay stays null."""
    return _col(delay) <= 0


def has_status(name: str, status="event_type") -> Column:
    return _col(status) == name


def is_terminal(status="event_type") -> Column:
    return _col(status).isin(*S.TERMINAL_STATUSES)


# --- predicates --------------------------------------------------------------------------

def gps_faults(fuel_scale: float = 1.0) -> Column:
    """Names of the failed quality rules, joined by commas; empty for a good row.

    ``fuel_scale`` is the full-tank value of the feed: 1 for fractions, 100 for percent.
    """
    rules = {
        "latitude": F.col("latitude").between(-90, 90),
        "longitude": F.col("longitude").between(-180, 180),
        "speed": (F.col("speed_mph") >= 0) & ~F.isnan("speed_mph"),  # NaN is the largest double
        "fuel": F.col("fuel_level").between(0, fuel_scale),
    }
    # a null test result is a failure, as in a WHERE clause
    return F.concat_ws(",", *[F.when(~F.coalesce(ok, F.lit(False)), name) for name, ok in rules.items()])


def gps_valid(fuel_scale: float = 1.0) -> Column:
    return (
        F.col("latitude").between(-90, 90)
        & F.col("longitude").between(-180, 180)
        & (F.col("speed_mph") >= 0) & ~F.isnan("speed_mph")
        & F.col("fuel_level").between(0, fuel_scale)
    )


def in_range(ts, low, high) -> Column:
    """Half-open: low <= ts < high."""
    ts = _col(ts)
    return (ts >= F.lit(low)) & (ts < F.lit(high))


def since_days(day, as_of, days: int) -> Column:
    """Dates from ``days`` before ``as_of`` on."""
    return _col(day) >= F.date_sub(F.lit(as_of).cast("date"), days)


def is_delay_alert() -> Column:
    return F.col("delay_minutes") > S.DELAY_ALERT_MINUTES


def percentage(part, whole) -> Column:
    """part / whole * 100 in doubles, in the order the stored tables use; null for an empty whole."""
    return F.try_divide(_col(part), _col(whole)) * 100


def share(part, whole) -> Column:
    """100 * part / whole with one rounding, for shares shown with two decimals."""
    return F.try_divide(_col(part) * 100.0, _col(whole))


def settled_round(value, digits: int = 2) -> Column:
    """Round a mean of doubles. Their sum differs in its last bits with the task order, which
    would decide values halfway between two results; so those bits are dropped first."""
    return F.round(F.round(_col(value), 9), digits)


def as_decimal(value, precision: int = 5, scale: int = 2) -> Column:
    """Decimal, or null where the value does not fit."""
    return _col(value).try_cast(f"decimal({precision},{scale})")


# --- column sets -------------------------------------------------------------------------

def enrich_gps(df: DataFrame, null_policy: str = "else_branch") -> DataFrame:
    """Stateless GPS enrichment, the same in batch and in a stream."""
    ts = F.col("event_timestamp")
    return df.withColumns({
        "event_date": event_date(ts),
        "event_hour": event_hour(ts),
        "day_of_week": day_number(ts),
        "day_name": day_name(ts),
        "is_weekend": is_weekend(ts),
        "speed_category": speed_category(null_policy=null_policy),
        "fuel_status": fuel_status(null_policy=null_policy),
        "is_moving": is_moving(),
    })


def enrich_deliveries(df: DataFrame, null_policy: str = "else_branch") -> DataFrame:
    """Stateless delivery enrichment, the same in batch and in a stream."""
    ts = F.col("event_timestamp")
    return df.withColumns({
        "event_date": event_date(ts),
        "event_hour": event_hour(ts),
        "day_name": day_name(ts),
        "is_weekend": is_weekend(ts),
        "is_business_hours": is_business_hours(ts),
        "delay_category": delay_category(null_policy=null_policy),
        "package_size": package_size(null_policy=null_policy),
        "is_delivered": has_status("DELIVERED"),
        "is_failed": has_status("FAILED_ATTEMPT"),
        "is_returned": has_status("RETURNED"),
    })


def with_defaults(df: DataFrame, defaults: dict | None = None) -> DataFrame:
    """Fill absent measures: delay, weight and speed 0, fuel 1.0, notes 'Unknown'."""
    known = defaults or {
        "delay_minutes": 0, "package_weight_lbs": 0.0, "speed_mph": 0.0, "fuel_level": 1.0, "notes": "Unknown",
    }
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in known.items() if c in df.columns})


def day_of(date_key) -> Column:
    """The date of a key such as 20240115."""
    return F.to_date(_col(date_key).cast("string"), "yyyyMMdd")


def with_lineage(df: DataFrame, column: str = "processed_at", at=None, version: str | None = None) -> DataFrame:
    """Stamp the load time (injectable for tests) and, if given, a version tag."""
    out = df.withColumn(column, F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))
    return out if version is None else out.withColumn("version_tag", F.lit(version))


def coord_prefix(lat="latitude", lon="longitude") -> Column:
    """First 5 characters of the latitude text and 6 of the longitude text."""
    return F.concat(F.substring(_col(lat).cast("string"), 1, 5), F.substring(_col(lon).cast("string"), 1, 6))


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value
