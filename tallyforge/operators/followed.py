"""Checks that follow a published table: after a load they read what changed, not the table.

Failing rows are counted over the rows that left and came. Repeated keys change only among the
keys of those rows; these are looked up in the files that hold them, before and after.
Relationships depend on another table as well, so they are checked in full.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.operators.checks import AcceptedValues, Check, NotNull, Relationship, Unique, run_checks
from tallyforge.sources.published import CHANGE, Manifest, PublishedTable
from tallyforge.sources.storage import scratch_space

SOURCE_VERSION = "source_version"


class FollowedChecks:
    """Failure counts of ``checks`` on ``table``, kept under ``path`` from version to version."""

    def __init__(self, name: str, table: PublishedTable, checks: Sequence[Check], path: str) -> None:
        if any(isinstance(check, Relationship) for check in checks):
            raise ValueError("relationships cannot be followed; run them with run_checks")
        self.name, self.table, self.checks = name, table, list(checks)
        self.state = PublishedTable(table.spark, path)

    def read(self) -> DataFrame:
        """The counts as of the last refresh, as ``run_checks`` gives them."""
        return self.state.read()

    def refresh(self) -> None:
        """Bring the counts up to the table's version; in full where the last version seen has expired."""
        current, stored = self.table.manifest(), self.state.manifest()
        if current is None:
            raise FileNotFoundError(f"{self.table.path} has not been published")
        before = self.table.manifest(int(stored.notes[SOURCE_VERSION])) if stored else None
        notes = {SOURCE_VERSION: str(current.version)}
        if before is None:
            found = run_checks({self.name: self.table.read(at=current)}, {self.name: self.checks})
            return self.state.replace(found, notes)
        if before.version == current.version:
            return
        with scratch_space(self.table.spark) as keep:
            moved = keep(self.table.changes(before, current))
            shifts = self._shifts(moved, before, current)
        lines = [row.asDict() for row in self.state.read(at=stored).collect()]  # one per check
        for line in lines:
            line["failures"] += shifts[line["check_name"], line["column_name"]]
        self.state.replace(self.table.spark.createDataFrame(lines, stored.schema), notes)

    def _shifts(self, moved: DataFrame, before: Manifest, current: Manifest) -> dict[tuple[str, str], int]:
        """By how much each check's failures changed."""
        rowwise = [check for check in self.checks if isinstance(check, (NotNull, AcceptedValues))]
        sums = [F.sum(F.when(check.failing(), F.col(CHANGE)).otherwise(0)) for check in rowwise]
        found = moved.agg(F.count(F.lit(1)), *sums).first()
        shifts = {(check.name, check.label): value or 0 for check, value in zip(rowwise, found[1:])}
        for check in self.checks:
            if isinstance(check, Unique):
                touched = moved.select(*check.columns).distinct()
                shifts[check.name, check.label] = (
                    self._repeated(check, touched, current) - self._repeated(check, touched, before) if found[0] else 0
                )
        return shifts

    def _repeated(self, check: Unique, touched: DataFrame, at: Manifest) -> int:
        """How many of the touched keys repeat in a version; only files that hold one are read."""
        keys = list(check.columns)
        held = at.files
        # The files of a NULL, which counts as a value in a combination, are not known.
        if len(keys) == 1 or touched.filter(reduce(Column.__or__, (F.col(f"`{key}`").isNull() for key in keys))).isEmpty():
            names = self.table.files_with(touched, keys, at)
            held = {part: [entry for entry in entries if entry.name in names] for part, entries in at.files.items()}
        rows = self.table.read_files(held, at)
        same = [F.col(f"rows.`{key}`").eqNullSafe(F.col(f"touched.`{key}`")) for key in keys]
        rows = rows.alias("rows").join(touched.alias("touched"), same, "left_semi")
        counted = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
        return counted.filter(check.repeats(F.col("occurrences"))).count()
