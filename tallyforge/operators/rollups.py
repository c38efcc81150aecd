"""Rollups kept up to date from the changes of a published table.

Sums and counts take back the rows that left and add those that came. Smallest and largest values
are merged where rows only came; for keys that lost a row they are worked out again from those keys' rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.sources.published import BROADCAST_KEYS, CHANGE, Manifest, PublishedTable
from tallyforge.sources.storage import scratch_space

#: State columns: the key of a group as text, which is never NULL, and the rows of the group.
KEY, ROWS = "rollup_key", "rollup_rows"
SOURCE_VERSION = "source_version"


class MaintainedRollup:
    """One row per group of ``source``, stored under ``path``.

    ``sums`` are totals of an expression (NULL where it is NULL in all rows), ``least`` and
    ``most`` its smallest and largest value. A version of the source that has expired since the last
    refresh makes a full rebuild.
    """

    def __init__(
        self,
        source: PublishedTable,
        path: str,
        groups: Sequence[str],
        sums: Mapping[str, Column],
        least: Mapping[str, Column] | None = None,
        most: Mapping[str, Column] | None = None,
    ) -> None:
        self.source, self.groups = source, list(groups)
        self.sums, self.least, self.most = dict(sums), dict(least or {}), dict(most or {})
        self.state = PublishedTable(source.spark, path, keys=[KEY])

    def read(self) -> DataFrame:
        """Groups, ``rollup_rows``, sums and extremes."""
        sums = [F.when(F.col(f"_n_{name}") > 0, F.col(name)).alias(name) for name in self.sums]
        return self.state.read().select(*self.groups, ROWS, *sums, *self.least, *self.most)

    def refresh(self) -> None:
        """Bring the rollup up to the source's version; without changes nothing is written."""
        current, stored = self.source.manifest(), self.state.manifest()
        if current is None:
            raise FileNotFoundError(f"{self.source.path} has not been published")
        since = int(stored.notes[SOURCE_VERSION]) if stored else None
        before = self.source.manifest(since) if stored else None
        notes = {SOURCE_VERSION: str(current.version)}
        if before is None:
            rows = self.source.read(at=current).withColumn(CHANGE, F.lit(1).cast("long"))
            return self.state.replace(self._rolled(rows).drop("_lost"), notes)
        if before.version != current.version:
            self._follow(before, current, stored, notes)

    def _follow(self, before: Manifest, current: Manifest, stored: Manifest, notes: dict[str, str]) -> None:
        with scratch_space(self.source.spark) as keep:
            moved = keep(self._rolled(self.source.changes(before, current)))
            touched = moved.count()
            if touched == 0:
                return self.state.replace_partitions(self.state.read(at=stored).limit(0), [], stored, notes)
            few = F.broadcast if touched <= BROADCAST_KEYS else lambda df: df
            old = self.state.read(at=stored).join(few(moved.select(KEY)), KEY, "left_semi").alias("old")
            both = moved.alias("new").join(old, KEY, "left")
            counted = [ROWS, *(name for sum_ in self.sums for name in (sum_, f"_n_{sum_}"))]
            added = [
                (F.coalesce(f"old.{name}", F.lit(0)) + F.coalesce(f"new.{name}", F.lit(0)))
                .cast(stored.schema[name].dataType)
                .alias(name)
                for name in counted
            ]
            ends = [F.least(f"old.{name}", f"new.{name}").alias(name) for name in self.least]
            ends += [F.greatest(f"old.{name}", f"new.{name}").alias(name) for name in self.most]
            merged = both.select(KEY, *(F.col(f"new.{g}").alias(g) for g in self.groups), *added, *ends, "new._lost")
            if ends:
                merged = self._worked_out_again(keep(merged), current, few)
            rows = merged.filter(F.col(ROWS) > 0).select(*stored.schema.names)
            self.state.merge_on_read(keep(rows), moved, stored, notes=notes)

    def _worked_out_again(self, merged: DataFrame, current: Manifest, few) -> DataFrame:
        """The extremes of keys that lost a row, from their rows in the source."""
        lost = merged.filter(F.col("_lost") & (F.col(ROWS) > 0)).select(KEY)
        rows = self.source.read(at=current).withColumn(KEY, self._key()).join(few(lost), KEY, "left_semi")
        fresh = rows.groupBy(KEY).agg(*self._extremes()).alias("fresh")
        names = [*self.least, *self.most]
        joined = merged.alias("merged").join(fresh, KEY, "left")
        kept = [name for name in merged.columns if name not in (KEY, *names)]
        chosen = [F.when(F.col("merged._lost"), F.col(f"fresh.{n}")).otherwise(F.col(f"merged.{n}")).alias(n) for n in names]
        return joined.select(KEY, *(f"merged.{name}" for name in kept), *chosen)

    def _key(self) -> Column:
        return F.to_json(F.struct(*self.groups))

    def _extremes(self) -> list[Column]:
        return [F.min(made).alias(name) for name, made in self.least.items()] + [
            F.max(made).alias(name) for name, made in self.most.items()
        ]

    def _rolled(self, rows: DataFrame) -> DataFrame:
        """Net movement per group of rows with ``CHANGE`` 1 or -1; ``_lost`` where a row left.

        Extremes are those of the rows that came.
        """
        sign = F.col(CHANGE)
        columns = [F.sum(sign).alias(ROWS), F.max(sign < 0).alias("_lost")]
        for name, made in self.sums.items():
            columns.append(F.coalesce(F.sum(made * sign), F.lit(0)).alias(name))
            columns.append(F.coalesce(F.sum(F.when(made.isNotNull(), sign)), F.lit(0)).cast("long").alias(f"_n_{name}"))
        came = lambda make, made: make(F.when(sign > 0, made))
        columns += [came(F.min, made).alias(name) for name, made in self.least.items()]
        columns += [came(F.max, made).alias(name) for name, made in self.most.items()]
        rolled = rows.groupBy(*self.groups).agg(*columns)
        return rolled.withColumn(KEY, self._key())

