"""Upsert merge, history tables (SCD type 2) and change detection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from roadgauge.operators import timeline
from roadgauge.operators.quality import keep_first
from roadgauge.session import stage

HISTORY = ("effective_start", "effective_end", "is_current")


def one_per_key(source: DataFrame, keys: list[str], ts: str, then: tuple[str, ...] = ()) -> DataFrame:
    """Latest source row per key, so a join with the target cannot multiply rows.

    At equal times the columns ``then`` decide, such as the processing time, and after them all others.
    """
    rest = [c for c in source.columns if c not in (*keys, ts, *then)]
    return keep_first(source, keys, [F.desc(c) for c in (ts, *then, *rest)])


def upsert(
    target: DataFrame, source: DataFrame, keys: list[str], ts: str, null_policy: str = "keep", loaded_at=None,
    then: tuple[str, ...] = (), only_newer: bool = False,
) -> DataFrame:
    """Update matching keys, insert new ones, keep the rest.

    ``null_policy`` "keep" never lets a source null replace a value; "overwrite" does.
    Columns of either side survive. One full outer join on the key, so the target is
    shuffled once. ``loaded_at`` is stamped on rows the source touched. With ``only_newer`` a stored
    row stays as it is if it is later than the source row by ``ts`` and then by the columns ``then`` (null is earliest).
    """
    if null_policy not in ("keep", "overwrite"):
        raise ValueError("null_policy must be 'keep' or 'overwrite'")
    now = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    new = one_per_key(source, keys, ts, then).drop("loaded_at").withColumn("_touched", F.lit(True)).alias("s")
    old = target.withColumn("_stored", F.lit(True)).alias("t")
    matched = F.col("s._touched").isNotNull()
    order = [c for c in (ts, *then) if c in source.columns and c in target.columns]
    if only_newer and order:
        later = F.struct(*[F.col(f"s.{c}") for c in order]) >= F.struct(*[F.col(f"t.{c}") for c in order])
        matched = matched & (F.col("t._stored").isNull() | later)
    both = old.join(new, keys, "full")

    def value(c: str) -> Column:
        if c not in source.columns:
            return F.col(f"t.{c}")
        if c not in target.columns:
            return F.when(matched, F.col(f"s.{c}"))
        if null_policy == "keep":
            return F.coalesce(F.when(matched, F.col(f"s.{c}")), f"t.{c}")
        return F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    names = [c for c in dict.fromkeys(target.columns + source.columns) if c not in keys and c != "loaded_at"]
    before = F.col("t.loaded_at") if "loaded_at" in target.columns else F.lit(None).cast("timestamp")
    return both.select(
        *keys, *[value(c).alias(c) for c in names], F.when(matched, now).otherwise(before).alias("loaded_at"),
    )


def first_load(source: DataFrame, keys: list[str], ts: str, loaded_at=None, then: tuple[str, ...] = ()) -> DataFrame:
    now = F.current_timestamp() if loaded_at is None else F.lit(loaded_at).cast("timestamp")
    return one_per_key(source, keys, ts, then).withColumn("loaded_at", now)


def updated(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key occurs in the source; duplicates in the source add no rows."""
    return target.join(source.select(*keys), keys, "left_semi")


def unchanged(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key does not occur in the source."""
    return target.join(source.select(*keys), keys, "left_anti")


def inserted(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key is new."""
    return source.join(target.select(*keys), keys, "left_anti")


def row_hash(columns: list[str]) -> Column:
    """64-bit hash of the columns. The hash function skips nulls, so each null is marked."""
    return F.xxhash64(*[part for c in columns for part in (F.col(c).isNull(), F.col(c))])


def changed(current: DataFrame, source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Source rows that are new or differ from the current row in the hash of ``columns``."""
    known = current.select(*keys, row_hash(columns).alias("_known"))
    return (
        source.withColumn("_hash", row_hash(columns))
        .join(known, keys, "left")
        .where(~F.col("_hash").eqNullSafe(F.col("_known")))
        .withColumn("change", F.when(F.col("_known").isNull(), "insert").otherwise("update"))
        .drop("_hash", "_known")
    )


def scd2(
    target: DataFrame | None, source: DataFrame, keys: list[str], ts: str, tracked: list[str] | None = None,
    unit: str = "month",
) -> DataFrame:
    """Keep every version of a row with the time it was valid.

    A version starts at its own event time and ends where the next one starts. Rows that
    change nothing add no version. Several versions of one key in a batch chain up, and a
    late one is put in its place among the stored versions.
    """
    columns = [c for c in source.columns if c != ts]
    tracked = tracked or [c for c in columns if c not in keys]
    start = F.col(ts).cast("timestamp").alias("effective_start")
    incoming = source.select(*columns, start).withColumns({
        "effective_end": F.lit(None).cast("timestamp"), "_source": F.lit(1),
    })
    kept = None
    if target is not None:
        kept = unchanged(target, source, keys)
        touched = updated(target, source, keys).drop("is_current").withColumn("_source", F.lit(0))
        incoming = touched.unionByName(incoming, allowMissingColumns=True)
    # at one start time the source row replaces the stored one
    rest = [F.desc(c) for c in incoming.columns if c not in (*keys, "effective_start", "_source")]
    single = keep_first(incoming, [*keys, "effective_start"], [F.desc("_source"), *rest]).drop("_source")
    # used four times below
    single = stage(single, "versions")
    linked = timeline.with_previous(single, keys, ["effective_start"], tracked, unit=unit)
    same = F.struct(*tracked).eqNullSafe(F.struct(*[F.col(f"previous.{c}").alias(c) for c in tracked]))
    versions = linked.where(F.col("previous").isNull() | ~same).drop("previous")
    chained = timeline.with_next(versions, keys, ["effective_start"], [], unit=unit).withColumn(
        "effective_end", F.coalesce("following.effective_start", "effective_end"),
    ).withColumn("is_current", F.col("effective_end").isNull()).drop("following")
    return chained if kept is None else kept.unionByName(chained, allowMissingColumns=True)


def current_versions(history: DataFrame) -> DataFrame:
    return history.where("is_current")
