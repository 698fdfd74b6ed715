"""Reading a type-2 history as it stood when something happened.

A version holds from its start up to, and without, its end; without an end it is open.
Where versions of a key overlap, the one that started last holds; of versions that start
together the one that ends last, then the greatest by its columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

KEY, START, END, ADDED = "_version_key", "_version_start", "_version_end", "_version"


def attributes_as_of(
    events: DataFrame,
    history: DataFrame,
    key: str,
    time: str,
    add: Sequence[str],
    *,
    history_key: str | None = None,
    start: str = "eff_start_ts",
    end: str | None = "eff_end_ts",
    missing_flag: str | None = None,
    per: str | None = None,
) -> DataFrame:
    """Every event once, with the columns ``add`` of the version that held at its time.

    Events without key or time, before the first version or in a gap have NULL there;
    ``missing_flag`` tells them apart.  Without ``end`` a version holds until the next.

    By default the events are joined on the key with the interval as a condition: the
    history is broadcast if the planner finds it small, and otherwise partitions with
    much of the events are split at run time.  Each event meets all versions of its key,
    so for long histories ``per`` names a unit of time instead (``month``, ``day``): events
    and versions are sorted together within key and unit, and the version that holds when
    a unit begins is handed to it.  Then a key with most of the events is spread over its
    units, and work does not grow with the length of the histories.
    """
    versions = _versions(history, history_key or key, start, end, add)
    found = _joined(events, versions, key, time) if per is None else _sorted(events, versions, key, time, per)
    columns = [F.col(ADDED)[c].alias(c) for c in add]
    flag = [F.col(ADDED).isNull().alias(missing_flag)] if missing_flag else []
    return found.select(*[F.col(f"`{c}`") for c in events.columns], *columns, *flag)


def _versions(history: DataFrame, key: str, start: str, end: str | None, add: Sequence[str]) -> DataFrame:
    """One version for each key and start."""
    until = F.col(end) if end else F.lit(None).cast(history.schema[start].dataType)
    held = F.struct(until.isNull().alias("open"), until.alias("until"), F.struct(*add).alias("added"))
    return (
        history.filter(F.col(key).isNotNull() & F.col(start).isNotNull())
        .groupBy(F.col(key).alias(KEY), F.col(start).alias(START))
        .agg(F.max(held).alias("_held"))
        .select(KEY, START, F.col("_held.until").alias(END), F.col("_held.added").alias(ADDED))
    )


def _joined(events: DataFrame, versions: DataFrame, key: str, time: str) -> DataFrame:
    following = F.lead(START).over(Window.partitionBy(KEY).orderBy(START))
    apart = versions.withColumn(END, F.least(END, following)).filter(F.col(END).isNull() | (F.col(END) > F.col(START)))
    at = F.col(f"`{time}`")
    holds = (at >= F.col(START)) & (F.col(END).isNull() | (at < F.col(END)))
    return events.join(apart, (F.col(f"`{key}`") == F.col(KEY)) & holds, "left")


def _sorted(events: DataFrame, versions: DataFrame, key: str, time: str, per: str) -> DataFrame:
    def unit(column: Column) -> Column:
        return F.date_trunc(per, column).alias("_unit")

    at = F.col(f"`{time}`")
    placed = at.isNotNull() & F.col(f"`{key}`").isNotNull()
    version = F.struct(F.col(START).alias("since"), F.col(END).alias("until"), F.col(ADDED).alias("added"))
    asked = events.filter(placed).select(
        F.col(f"`{key}`").alias(KEY), unit(at), at.cast("timestamp").alias("_at"), F.lit(1).alias("_kind"),
        F.struct("*").alias("_event"), F.lit(None).cast(versions.select(version).schema[0].dataType).alias("_held"),
    )
    begun = versions.select(
        KEY, unit(F.col(START)), F.col(START).cast("timestamp").alias("_at"), F.lit(0).alias("_kind"),
        F.lit(None).cast(asked.schema["_event"].dataType).alias("_event"), version.alias("_held"),
    )
    # Of each unit the last version and whether an event asks: a row for each key and unit.
    units = asked.select(KEY, "_unit", "_held", F.lit(True).alias("_asked")).unionByName(
        begun.select(KEY, "_unit", "_held", F.lit(False).alias("_asked"))
    ).groupBy(KEY, "_unit").agg(F.max_by("_held", "_held.since").alias("_held"), F.max("_asked").alias("_asked"))
    earlier = Window.partitionBy(KEY).orderBy("_unit").rowsBetween(Window.unboundedPreceding, -1)
    handed = (
        units.withColumn("_held", F.last("_held", ignorenulls=True).over(earlier))
        .filter(F.col("_asked") & F.col("_held").isNotNull())
        .select(
            KEY, "_unit", F.lit(None).cast("timestamp").alias("_at"), F.lit(0).alias("_kind"),
            F.lit(None).cast(asked.schema["_event"].dataType).alias("_event"), "_held",
        )
    )
    # NULL, the time of what is handed on, sorts first; a version goes before events of its start.
    so_far = Window.partitionBy(KEY, "_unit").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last("_held", ignorenulls=True).over(so_far)
    met = asked.unionByName(begun).unionByName(handed).withColumn("_held", last).filter(F.col("_kind") == 1)
    until = F.col("_held.until")
    holds = until.isNull() | (F.col("_at") < until)
    found = met.select("_event.*", F.when(holds, F.col("_held.added")).alias(ADDED))
    nowhere = events.filter(~placed).withColumn(ADDED, F.lit(None).cast(found.schema[ADDED].dataType))
    return found.unionByName(nowhere)
