"""Slowly-changing history: one row per version of each key."""

from __future__ import annotations

import json
from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyforge.operators.checks import require_unique
from tallyforge.sources.published import Manifest, PublishedTable
from tallyforge.sources.storage import scratch_space

OPEN, CLOSED = "open", "closed"
LAST_SNAPSHOT, SNAPSHOTS = "last_snapshot", "snapshots"
#: Snapshots whose closed keys readers skip before they are folded into the files.
FOLD_AFTER = 8
VERSION_COLUMNS = ("version_from", "version_to", "version_updated_at", "version_id")


def history_partition(key: str, buckets: int = 16) -> Column:
    """Partition expression: closed versions apart, open ones in buckets by key."""
    bucket = F.lpad(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("string"), len(str(buckets - 1)), "0")
    return F.when(F.col("version_to").isNull(), F.concat(F.lit(f"{OPEN}-"), bucket)).otherwise(CLOSED)


def first_versions(source: DataFrame, key: str, at: datetime) -> DataFrame:
    """An open version of every source row."""
    return source.select("*", *_opened(F.col(key), at))


def next_versions(
    open_versions: DataFrame,
    source: DataFrame,
    key: str,
    check_columns: Sequence[str],
    at: datetime,
    invalidate_deletes: bool = True,
    only_changes: bool = False,
) -> DataFrame:
    """Compare the open versions with the source as of ``at``.

    Yields all open versions, closed where a check column changed (NULL-safe) or, with
    ``invalidate_deletes``, where the key is gone; plus a new open version of every changed
    or new key. With ``only_changes``, versions that stay open are left out. Other columns of an
    unchanged row keep their stored values. One shuffle join.
    """
    columns = [name for name in source.columns]
    old, new = open_versions.alias("old"), source.alias("new")
    old_key, new_key = F.col(f"old.{key}"), F.col(f"new.{key}")
    was, is_now = old_key.isNotNull(), new_key.isNotNull()
    changed = reduce(
        lambda a, b: a | b, (~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_columns)
    )
    closes = was & (~is_now if invalidate_deletes else F.lit(False)) | (was & is_now & changed)
    opens = is_now & (~was | changed)
    instant = _instant(at)

    stored = F.when(
        was & closes if only_changes else was,
        F.struct(
            *(F.col(f"old.{c}").alias(c) for c in columns),
            F.col("old.version_from").alias("version_from"),
            F.when(closes, instant).alias("version_to"),
            F.when(closes, instant).otherwise(F.col("old.version_updated_at")).alias("version_updated_at"),
            F.col("old.version_id").alias("version_id"),
        ),
    )
    fresh = F.when(opens, F.struct(*(F.col(f"new.{c}").alias(c) for c in columns), *_opened(new_key, at)))
    versions = F.filter(F.array(stored, fresh), lambda version: version.isNotNull())
    return old.join(new, old_key == new_key, "full").select(F.inline(versions))


def take_snapshot(
    table: PublishedTable,
    source: DataFrame,
    key: str,
    check_columns: Sequence[str],
    at: datetime,
    invalidate_deletes: bool = True,
) -> None:
    """Bring a published history up to ``at``. Closed versions are never read or rewritten.

    What is written grows with the changes: their versions, and their keys, by which readers leave
    out the versions that were open before. A key that repeats or is NULL in the source is an
    error, and so is a change as of an instant that is not later than the last snapshot's; without
    changes such a replay does nothing. ``insert_snapshot`` takes an extract that lands late.
    """
    spark = table.spark
    with scratch_space(spark) as keep:
        source = _checked(keep(source), key)
        base = table.manifest()
        if base is None:
            return table.replace(first_versions(source, key, at), _noted(None, at))
        late = LAST_SNAPSHOT in base.notes and at <= datetime.fromisoformat(base.notes[LAST_SNAPSHOT])
        open_parts = [part for part in base.files if part.startswith(OPEN)]
        open_versions = table.read(open_parts, base)
        changes = keep(next_versions(open_versions, source, key, check_columns, at, invalidate_deletes, True))
        if changes.isEmpty():
            return None if late else table.replace_partitions(changes, [], base, _noted(base, at))
        if late:
            raise ValueError(f"a snapshot as of {base.notes[LAST_SNAPSHOT]} exists; {at} is not later")
        keyed = _keyed(table, key)
        keyed.merge_on_read(changes, changes, base, OPEN, _noted(base, at))
        if len(base.deletes) + 1 >= FOLD_AFTER:
            keyed.compact()


def history_of_extracts(
    extracts: DataFrame, key: str, check_columns: Sequence[str], at: str, invalidate_deletes: bool = True
) -> DataFrame:
    """The versions that whole extracts give, all at once; ``at`` is a row's extract time.

    A version opens where a key appears, returns or has another check column than in its extract before, and
    closes at the next extract that shows so. Columns come from a version's first extract. Only the list of
    extract times, one row each, is sent to every task; keys are compared within one shuffle by key.
    """
    columns = [name for name in extracts.columns if name != at]
    every = Window.orderBy("_at")
    times = extracts.select(F.col(at).alias("_at")).distinct()
    times = times.select("_at", F.row_number().over(every).alias("_place"), F.lead("_at").over(every).alias("_next"))
    placed = extracts.withColumnRenamed(at, "_at").join(F.broadcast(times), "_at")
    by_time = Window.partitionBy(key).orderBy("_place")
    differs = reduce(lambda a, b: a | b, (~F.col(c).eqNullSafe(F.lag(c).over(by_time)) for c in check_columns))
    before = F.lag("_place").over(by_time)
    gap = before < F.col("_place") - 1 if invalidate_deletes else F.lit(False)
    starts = placed.withColumn("_starts", before.isNull() | gap | differs)
    numbered = starts.withColumn("_version", F.sum(F.col("_starts").cast("int")).over(by_time))
    # Of each version its first row, with the time of its last extract and of what came after.
    spans = numbered.groupBy(key, "_version").agg(
        F.min_by(F.struct(*columns), "_place").alias("first"),
        F.min("_at").alias("version_from"),
        F.max_by("_next", "_place").alias("_gone"),
    )
    if not invalidate_deletes:
        follows = F.lead("version_from").over(Window.partitionBy(key).orderBy("_version"))
        spans = spans.withColumn("_gone", follows)
    closed = spans.withColumn("version_to", F.col("_gone"))
    return closed.select(
        *(F.col(f"first.{c}").alias(c) for c in columns),
        "version_from",
        "version_to",
        F.coalesce("version_to", "version_from").alias("version_updated_at"),
        _version_id(F.col(f"first.{key}"), F.col("version_from")),
    )


def load_extracts(
    table: PublishedTable, extracts: DataFrame, key: str, check_columns: Sequence[str], at: str
) -> None:
    """Publish the history of several dated extracts, in one pass over them; the table must be new."""
    if table.exists():
        raise ValueError(f"{table.path} has a history; use take_snapshot or insert_snapshot")
    spark = table.spark
    with scratch_space(spark) as keep:
        extracts = keep(extracts)
        require_unique(extracts, [key, at])
        if not extracts.filter(F.col(key).isNull() | F.col(at).isNull()).isEmpty():
            raise ValueError(f"{key} or {at} is NULL in the extracts")
        times = [row[0] for row in extracts.select(at).distinct().collect()]
        notes = {SNAPSHOTS: json.dumps(sorted(t.isoformat() for t in times))}
        if times:
            notes[LAST_SNAPSHOT] = max(times).isoformat()
        _keyed(table, key).replace(history_of_extracts(extracts, key, check_columns, at), notes)


def insert_snapshot(
    table: PublishedTable, source: DataFrame, key: str, check_columns: Sequence[str], at: datetime
) -> None:
    """Work an extract into a published history wherever its time falls; deletions count.

    An extract later than all others is a snapshot. Otherwise it can differ from the extract before
    it in some keys; the histories of these keys are made anew from what each extract showed of
    them, and published in place of theirs. Other keys keep their versions, which already say what the extract shows.
    The same time twice is an error unless it changes nothing.
    """
    base, spark = table.manifest(), table.spark
    times = _times(base)
    if base is None or not times or at > times[-1]:
        return take_snapshot(table, source, key, check_columns, at)
    with scratch_space(spark) as keep:
        source = _checked(keep(source), key)
        stored = table.read(at=base)
        instant = _instant(at)
        covers = (F.col("version_from") <= instant) & (F.col("version_to").isNull() | (F.col("version_to") > instant))
        shown = stored.filter(covers).select(key, *check_columns)
        old, new = shown.alias("old"), source.select(key, *check_columns).alias("new")
        same = reduce(lambda a, b: a & b, (F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in check_columns))
        both = F.col(f"old.{key}").isNotNull() & F.col(f"new.{key}").isNotNull()
        joined = old.join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full").filter(~(both & same))
        touched = keep(joined.select(F.coalesce(f"old.{key}", f"new.{key}").alias(key)))
        if touched.isEmpty():
            known = at in times
            return None if known else table.replace_partitions(stored.limit(0), [], base, _noted(base, at))
        if at in times:
            raise ValueError(f"another extract of {at} is in the history")
        versions = stored.join(touched, key, "left_semi")
        instants = F.array(*(_instant(time) for time in times))
        within = lambda t: (t >= F.col("version_from")) & (F.col("version_to").isNull() | (t < F.col("version_to")))
        columns = source.columns
        seen = versions.select(*columns, F.explode(F.filter(instants, within)).alias("_extract_at"))
        late = source.join(touched, key, "left_semi").select(*columns, instant.alias("_extract_at"))
        # Times at which none of these keys shows still count as extracts, so every time is listed.
        listed = spark.createDataFrame([(time,) for time in sorted([*times, at])], "_extract_at timestamp_ntz")
        blank = listed.select(*(F.lit(None).cast(source.schema[c].dataType).alias(c) for c in columns), "_extract_at")
        rows = seen.unionByName(late).unionByName(blank)
        made = history_of_extracts(rows, key, check_columns, "_extract_at").filter(F.col(key).isNotNull())
        keyed = _keyed(table, key)
        keyed.merge_on_read(keep(made.select(*stored.columns)), touched, base, notes=_noted(base, at))
        if len(base.deletes) + 1 >= FOLD_AFTER:
            keyed.compact()


def _checked(source: DataFrame, key: str) -> DataFrame:
    require_unique(source, [key])
    if not source.filter(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} is NULL in the snapshot source")
    return source


def _keyed(table: PublishedTable, key: str) -> PublishedTable:
    """The table with the history's key, whatever it was opened with."""
    return PublishedTable(
        table.spark, table.path, table.partition, [key], table.ordered_by, table.relation, table.file_rows
    )


def _times(base: Manifest | None) -> list[datetime]:
    """Instants of the extracts that a history was made of."""
    return [] if base is None else [datetime.fromisoformat(t) for t in json.loads(base.notes.get(SNAPSHOTS, "[]"))]


def _noted(base: Manifest | None, at: datetime) -> dict[str, str]:
    times = sorted({*_times(base), at})
    return {LAST_SNAPSHOT: times[-1].isoformat(), SNAPSHOTS: json.dumps([time.isoformat() for time in times])}


def _instant(at: datetime) -> Column:
    return F.lit(at.isoformat(sep=" ")).cast("timestamp_ntz")


def _opened(key: Column, at: datetime) -> list[Column]:
    instant = _instant(at)
    return [
        instant.alias("version_from"),
        F.lit(None).cast("timestamp_ntz").alias("version_to"),
        instant.alias("version_updated_at"),
        _version_id(key, instant),
    ]


def _version_id(key: Column, version_from: Column) -> Column:
    return F.md5(F.concat_ws("|", key.cast("string"), version_from.cast("string"))).alias("version_id")
