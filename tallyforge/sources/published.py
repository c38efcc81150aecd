"""Published Parquet tables: rebuilt, appended to or merged without overwriting in place.

Every write lands in a new directory. A small numbered manifest then lists the files that make
up the table, so a reader sees the state before a publish or after it, and a failed job leaves
nothing visible. Of two runs that start from one version, the later fails.

A table may be split by a partition expression (payments by month, snapshots by open and
closed). With declared keys its rows are sorted by key within a partition, the manifest holds the key
range of every file, and the files carry Bloom filters. There are two ways to merge by key:

* ``upsert`` finds the files that hold a key of the delta and rewrites those (copy on write).
* ``upsert_on_read`` and ``delete_on_read`` write only the delta and its keys; readers leave out
  the rows of older files with these keys, and ``compact`` folds them in (merge on read).

``stage`` writes a version that only its holder can read, for checks to run on; ``publish_staged``
makes it the table's, ``reject`` keeps it apart.

Former versions stay readable until ``expire`` removes them. The manifest is created with a
rename that must refuse an existing target, as HDFS and local file systems do; on an object
store that does not, let one run write a table at a time.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import asdict, dataclass, field
from datetime import UTC, datetime, timedelta
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StringType, StructType

from tallyforge.operators.checks import require_unique
from tallyforge.sources import storage

PART, CHANGE = "part_value", "row_change"
#: Keys up to which they are broadcast to a scan.
BROADCAST_KEYS = 1 << 17
#: Keys of a delta up to which they are literals: compared with every file's range, and with the
#: Bloom filters of its row groups. ``IN`` reaches the filters in lists of ten.
LITERAL_KEYS, LITERAL_LIST = 1000, 10
#: Rows of a keyed table's file at most.
FILE_ROWS = 1 << 22


def month_partition(at: str) -> Column:
    """``yyyy-MM`` of a timestamp column."""
    return F.substring(F.col(at).cast("string"), 1, 7)


@dataclass(frozen=True)
class Bounds:
    """Smallest and largest value per key column; None where unknown or where all are NULL."""

    low: tuple
    high: tuple

    def may_meet(self, other: Bounds) -> bool:
        for low, high, from_, to in zip(self.low, self.high, other.low, other.high):
            if None not in (low, high, from_, to) and (to < low or high < from_):
                return False
        return True


@dataclass(frozen=True)
class Entry:
    """A file of a version: its name under the table, and the version that added it."""

    name: str
    since: int
    rows: int | None = None
    #: Key columns, and the range that the file holds of each.
    keys: tuple[str, ...] | None = None
    bounds: Bounds | None = None
    #: How many files its directory was written with.
    of: int | None = None
    #: Of deleted keys: the prefix of the partitions they are deleted from.
    within: str | None = None

    @staticmethod
    def from_json(body: dict) -> Entry:
        bounds, keys = body["bounds"], body["keys"]
        bounds = bounds and Bounds(tuple(bounds["low"]), tuple(bounds["high"]))
        return Entry(**{**body, "keys": keys and tuple(keys), "bounds": bounds})

    @property
    def directory(self) -> str:
        return self.name.rpartition("/")[0]

    def may_meet(self, keys: Sequence[str], bounds: Bounds | None) -> bool:
        """False when the key range shows that no row has a key within ``bounds``."""
        return bounds is None or self.bounds is None or self.keys != tuple(keys) or self.bounds.may_meet(bounds)


def _bounds_columns(keys: Sequence[str], schema: StructType) -> list[Column]:
    """Aggregates that make Bounds; only for types whose order JSON keeps."""
    ordered = [isinstance(schema[key].dataType, (IntegralType, StringType)) for key in keys]
    bound = lambda make, key, known: make(F.col(f"`{key}`")) if known else F.lit(None)
    return [
        F.array(*(bound(make, key, known).cast("string") for key, known in zip(keys, ordered))).alias(name)
        for name, make in (("low", F.min), ("high", F.max))
    ] + [F.count(F.lit(1)).alias("rows")]


def _bounds_of(row, keys: Sequence[str], schema: StructType) -> Bounds:
    typed = [int if isinstance(schema[key].dataType, IntegralType) else str for key in keys]
    low, high = (tuple(None if v is None else make(v) for make, v in zip(typed, row[name])) for name in ("low", "high"))
    return Bounds(low, high)


@dataclass(frozen=True)
class Manifest:
    version: int
    schema: StructType
    files: dict[str, list[Entry]]
    #: Files of keys whose rows in files of earlier versions no longer count.
    deletes: list[Entry] = field(default_factory=list)
    #: Small facts that belong to a version, such as the instant of a snapshot.
    notes: dict[str, str] = field(default_factory=dict)

    @property
    def entries(self) -> list[Entry]:
        return [entry for entries in self.files.values() for entry in entries]

    @property
    def dirs(self) -> dict[str, list[str]]:
        """Directories with files of each partition, oldest first."""
        return {part: list(dict.fromkeys(e.directory for e in entries)) for part, entries in self.files.items()}

    @property
    def all_dirs(self) -> list[str]:
        return [name for names in self.dirs.values() for name in names]

    def to_json(self) -> dict:
        return {
            "version": self.version,
            "schema": self.schema.jsonValue(),
            "files": {part: [asdict(entry) for entry in entries] for part, entries in self.files.items()},
            "deletes": [asdict(entry) for entry in self.deletes],
            "notes": self.notes,
        }

    @staticmethod
    def from_json(body: dict) -> Manifest:
        files = {part: [Entry.from_json(entry) for entry in entries] for part, entries in body["files"].items()}
        deletes = [Entry.from_json(entry) for entry in body["deletes"]]
        return Manifest(body["version"], StructType.fromJson(body["schema"]), files, deletes, body["notes"])


class PublishedTable:
    """A table under ``path``; ``partition`` is a string expression over its rows, if any.

    Rows for which the expression is NULL share the partition ``none``. ``keys`` are the columns
    upserts go by; files of a table with keys hold at most ``file_rows`` rows. ``ordered_by`` names
    a column in whose order the partition names sort, as months do for their timestamps.
    ``relation`` is the name the table goes by, its path if none is given.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partition: Column | None = None,
        keys: Sequence[str] = (),
        ordered_by: str | None = None,
        relation: str | None = None,
        file_rows: int = FILE_ROWS,
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.ordered_by, self.relation = tuple(keys), ordered_by, relation or self.path
        if partition is not None:
            partition = F.coalesce(F.nullif(partition.cast("string"), F.lit("")), F.lit("none"))
        self.partition, self.file_rows = partition, file_rows

    # Reading

    def manifest(self, version: int | None = None) -> Manifest | None:
        """The newest version's manifest, or that of ``version``; None when there is none."""
        names = [n for n in storage.list_names(self.spark, f"{self.path}/manifests") if n.endswith(".json")]
        if version is not None:
            names = [name for name in names if name == f"{version:010d}.json"]
        if not names:
            return None
        return Manifest.from_json(json.loads(storage.read_text(self.spark, f"{self.path}/manifests/{names[-1]}")))

    def exists(self) -> bool:
        return self.manifest() is not None

    def read(self, partitions: Sequence[str] | None = None, at: Manifest | None = None) -> DataFrame:
        """The rows of the current or a given version, or of the named partitions only."""
        current = at or self.manifest()
        if current is None:
            raise FileNotFoundError(f"{self.path} has not been published")
        chosen = current.files if partitions is None else dict.fromkeys(partitions, ())
        return self.read_files({part: current.files.get(part, []) for part in chosen}, current)

    def read_files(self, files: dict[str, list[Entry]], at: Manifest) -> DataFrame:
        """The rows of some files of a version, less those whose keys later versions deleted.

        Files of one age whose key ranges meet deleted keys are one scan and one anti join with them.
        """
        plain, hidden = [], {}
        for part, entries in files.items():
            for entry in entries:
                later = self._deleted_from(part, entry, at)
                if later:
                    hidden.setdefault(tuple(d.name for d in later), (later, []))[1].append(entry)
                else:
                    plain.append(entry)
        frames = [self._scan(plain, at)] if plain or not hidden else []
        for later, entries in hidden.values():
            left = self._scan(entries, at)
            for keys, gone in self._deleted_keys(later, at):
                left = left.join(gone, keys, "left_anti")
            frames.append(left)
        rows = reduce(DataFrame.unionByName, frames)
        return rows.select(*(f"`{name}`" for name in at.schema.names))

    @staticmethod
    def _deleted_from(part: str, entry: Entry, at: Manifest) -> list[Entry]:
        """Deleted keys that a file of ``part`` may hold rows of."""
        later = [d for d in at.deletes if d.since > entry.since and part.startswith(d.within or "")]
        return later if any(entry.may_meet(d.keys, d.bounds) for d in later) else []

    def _deleted_keys(self, deletes: Sequence[Entry], at: Manifest) -> list[tuple[list[str], DataFrame]]:
        """The deleted keys, by key columns; nearly always there is one set of them."""
        found = []
        for keys in dict.fromkeys(d.keys for d in deletes):
            some = [d for d in deletes if d.keys == keys]
            rows = self.spark.read.schema(StructType([at.schema[key] for key in keys]))
            rows = rows.parquet(*(f"{self.path}/{d.name}" for d in some))
            found.append((list(keys), F.broadcast(rows) if sum(d.rows for d in some) <= BROADCAST_KEYS else rows))
        return found

    def _scan(self, entries: Sequence[Entry], at: Manifest) -> DataFrame:
        """Rows of files as they lie; a directory of which all files are wanted is one path."""
        if not entries:
            return self.spark.createDataFrame([], at.schema)
        wanted = Counter(entry.directory for entry in entries)
        whole = lambda entry: wanted[entry.directory] == entry.of
        paths = dict.fromkeys(entry.directory if whole(entry) else entry.name for entry in entries)
        return self.spark.read.schema(at.schema).parquet(*(f"{self.path}/{path}" for path in paths))

    def changes(self, before: Manifest, after: Manifest) -> DataFrame:
        """Rows that left (``CHANGE`` -1) or came (1) between two versions, as often as they did.

        Only files that one version has and the other has not are read, and of the others the rows whose keys
        were deleted in between. Rows that were merely rewritten cancel out.
        """
        old, new = ({(part, e) for part, entries in m.files.items() for e in entries} for m in (before, after))
        removed, added = _by_part(old - new), _by_part(new - old)
        left, came = self.read_files(removed, before), self.read_files(added, after)
        known = {d.name for d in before.deletes}
        deleted = [d for d in after.deletes if d.name not in known]
        hidden: dict[tuple, set] = {}
        for pair in old & new:
            later = [d for d in self._deleted_from(*pair, after) if d in deleted]
            if later:
                hidden.setdefault(tuple(later), set()).add(pair)
        for later, pairs in hidden.items():
            for keys, gone in self._deleted_keys(later, after):
                rows = self.read_files(_by_part(pairs), before)
                left = left.unionByName(rows.join(gone, keys, "left_semi").select(*(f"`{n}`" for n in rows.columns)))
        signed = left.withColumn(CHANGE, F.lit(-1)).unionByName(came.withColumn(CHANGE, F.lit(1)))
        columns = [f"`{name}`" for name in after.schema.names]
        net = signed.groupBy(*columns).agg(F.sum(CHANGE).alias(CHANGE)).filter(F.col(CHANGE) != 0)
        times = F.array_repeat(F.signum(CHANGE).cast("long"), F.abs(CHANGE).cast("int"))
        return net.select(*columns, F.explode(times).alias(CHANGE))

    def partitions(self) -> list[str]:
        current = self.manifest()
        return sorted(current.files) if current else []

    # Publishing

    def replace(self, df: DataFrame, notes: dict[str, str] | None = None) -> None:
        """Full rebuild."""
        self.publish_staged(self.stage(df), notes)

    def stage(self, df: DataFrame) -> Manifest:
        """Write a full rebuild that no reader of the table sees; ``read(at=...)`` shows it."""
        current = self.manifest()
        version = current.version + 1 if current else 1
        notes = current.notes if current else {}
        return Manifest(version, df.schema, self._write(df, version), [], notes)

    def publish_staged(self, staged: Manifest, notes: dict[str, str] | None = None) -> None:
        """Make a staged version the table's; an error if another run published since."""
        self._commit(Manifest(staged.version, staged.schema, staged.files, [], {**staged.notes, **(notes or {})}))

    def reject(self, staged: Manifest, notes: dict[str, str]) -> None:
        """Keep a staged version apart, with the reason in its notes; the table stays as it is."""
        name = f"{staged.version:010d}-{uuid.uuid4().hex}.json"
        kept = Manifest(staged.version, staged.schema, staged.files, [], {**staged.notes, **notes})
        storage.write_new_text(self.spark, f"{self.path}/rejected/{name}", json.dumps(kept.to_json()))

    def rejected(self) -> list[Manifest]:
        """Rejected versions that have not expired, oldest first."""
        names = [n for n in storage.list_names(self.spark, f"{self.path}/rejected") if n.endswith(".json")]
        texts = (storage.read_text(self.spark, f"{self.path}/rejected/{name}") for name in names)
        return [Manifest.from_json(json.loads(text)) for text in texts]

    def append(self, df: DataFrame) -> None:
        """Add rows as they are; re-read rows become duplicates."""
        current = self.manifest()
        if current is None:
            return self.replace(df)
        self.replace_partitions(df, [], current)

    def replace_partitions(
        self, df: DataFrame, rebuilt: Sequence[str], base: Manifest, notes: dict[str, str] | None = None
    ) -> None:
        """Rebuild the named partitions of version ``base`` from ``df``; append its other rows."""
        self._check_schema(df, base)
        files = {part: entries for part, entries in base.files.items() if part not in rebuilt}
        self._succeed(base, files, self._write(df, base.version + 1), base.deletes, notes)

    # Merging by key

    def upsert(self, delta: DataFrame, keys: Sequence[str], notes: dict[str, str] | None = None) -> None:
        """Replace rows whose key is in ``delta`` and insert the others; rewrites the files that hold the keys.

        NULL keys match nothing and are inserted. A key repeated in ``delta`` is an error.
        """
        current = self.manifest()
        with storage.scratch_space(self.spark) as keep:
            delta = self._checked_delta(delta, keys, current, keep)
            if current is None:
                return self.replace(delta, notes)
            touched = self.files_with(delta, keys, current)
            held = {part: [e for e in entries if e.name in touched] for part, entries in current.files.items()}
            others = {part: [e for e in entries if e.name not in touched] for part, entries in current.files.items()}
            kept = self.read_files(held, current).join(delta.select(*keys), list(keys), "left_anti")
            written = self._write(kept.select(*delta.columns).unionByName(delta), current.version + 1)
            self._succeed(current, others, written, current.deletes, notes)

    def upsert_on_read(self, delta: DataFrame, notes: dict[str, str] | None = None) -> None:
        """The same result as ``upsert`` by the table's keys; writes the delta and its keys, reads no other file."""
        current = self.manifest()
        with storage.scratch_space(self.spark) as keep:
            delta = self._checked_delta(delta, self.keys, current, keep)
            if current is None:
                return self.replace(delta, notes)
            self.merge_on_read(delta, delta, current, notes=notes)

    def delete_on_read(self, gone: DataFrame, notes: dict[str, str] | None = None) -> None:
        """Remove the rows whose key is in ``gone``; writes those keys, reads no other file."""
        current = self.manifest()
        if current is None:
            raise FileNotFoundError(f"{self.path} has not been published")
        if not self.keys:
            raise ValueError("deleting by key needs a table with keys")
        self.merge_on_read(None, gone, current, notes=notes)

    def merge_on_read(
        self,
        added: DataFrame | None,
        gone: DataFrame,
        base: Manifest,
        within: str | None = None,
        notes: dict[str, str] | None = None,
    ) -> None:
        """Publish ``added``, and hide the keys of ``gone`` in all files of ``base``.

        Given a prefix ``within``, they are hidden in the partitions that it starts only.
        """
        version = base.version + 1
        known = reduce(lambda a, b: a & b, (F.col(f"`{key}`").isNotNull() for key in self.keys))
        name = f"deletes/{uuid.uuid4().hex}"
        gone.select(*self.keys).filter(known).distinct().write.parquet(f"{self.path}/{name}")
        schema = StructType([base.schema[key] for key in self.keys])
        keys = self.spark.read.schema(schema).parquet(f"{self.path}/{name}")
        found = keys.agg(*_bounds_columns(self.keys, schema)).first()
        bounds = _bounds_of(found, self.keys, schema)
        entry = Entry(name, version, found["rows"], self.keys, bounds, None, within)
        written = {} if added is None else self._write(added, version)
        self._succeed(base, base.files, written, [*base.deletes, entry] if entry.rows else base.deletes, notes)

    def _checked_delta(self, delta: DataFrame, keys: Sequence[str], current: Manifest | None, keep) -> DataFrame:
        """The delta written out, so that the checks and the merge see the same rows."""
        if not keys:
            raise ValueError("an upsert needs at least one key column")
        delta = keep(delta)
        require_unique(delta, keys)
        if current is not None:
            self._check_schema(delta, current)
        return delta

    def files_with(self, delta: DataFrame, keys: Sequence[str], current: Manifest) -> set[str]:
        """Names of the files that hold a key of ``delta``.

        Key ranges leave the files to search; of those only the keys are read, and of a few keys
        only in row groups whose Bloom filters admit them.
        """
        profile = delta.agg(*_bounds_columns(keys, current.schema)).first()
        if not profile["rows"]:
            return set()
        bounds, few = _bounds_of(profile, keys, current.schema), None
        if profile["rows"] <= LITERAL_KEYS:
            few = [tuple(row) for row in delta.select(*keys).collect()]
        searched = self._candidates(keys, bounds, few, current)
        if not searched:
            return set()
        rows = self._scan(searched, current)
        if few is not None:
            values = sorted({key[0] for key in few if key[0] is not None})
            lists = [values[k : k + LITERAL_LIST] for k in range(0, len(values), LITERAL_LIST)]
            rows = rows.filter(reduce(lambda a, b: a | b, (F.col(f"`{keys[0]}`").isin(some) for some in lists), F.lit(False)))
        wanted = delta.select(*keys)
        if profile["rows"] <= BROADCAST_KEYS:
            wanted = F.broadcast(wanted)
        found = rows.select(*keys, F.col("_metadata.file_path").alias("file")).join(wanted, list(keys), "left_semi")
        return {_under_table(row["file"]) for row in found.select("file").distinct().collect()}

    def _candidates(
        self, keys: Sequence[str], bounds: Bounds, few: Sequence[tuple] | None, current: Manifest
    ) -> list[Entry]:
        """Files whose key range meets the delta's, and given its keys, one of them."""
        found = [entry for entry in current.entries if entry.may_meet(keys, bounds)]
        if few is None or bounds.low[0] is None:
            return found
        first = sorted(key[0] for key in few if key[0] is not None)

        def meets(entry: Entry) -> bool:
            if entry.keys != tuple(keys) or None in (entry.bounds.low[0], entry.bounds.high[0]):
                return True
            return bisect_left(first, entry.bounds.low[0]) < bisect_right(first, entry.bounds.high[0])

        return [entry for entry in found if meets(entry)]

    # Upkeep

    def compact(self, most_dirs: int = 8) -> None:
        """Fold deleted keys into the files that hold them, and join directories of partitions with too many.

        A partition of more than ``most_dirs`` directories is rewritten into one.
        """
        current = self.manifest()
        if current is None:
            return
        many = {part for part, names in current.dirs.items() if len(names) > most_dirs}
        held = self._files_with_deleted(current)
        stale = {part: [e for e in es if part in many or e.name in held] for part, es in current.files.items()}
        if not current.deletes and not any(stale.values()):
            return
        others = {part: [e for e in es if e not in stale[part]] for part, es in current.files.items()}
        written = self._write(self.read_files(stale, current), current.version + 1) if any(stale.values()) else {}
        self._succeed(current, others, written, [], None)

    def _files_with_deleted(self, current: Manifest) -> set[str]:
        """Names of the files with rows that deleted keys hide."""
        groups: dict[tuple, tuple] = {}
        for part, entries in current.files.items():
            for entry in entries:
                later = self._deleted_from(part, entry, current)
                if later:
                    groups.setdefault(tuple(d.name for d in later), (later, []))[1].append(entry)
        found = set()
        for later, entries in groups.values():
            rows = self._scan(entries, current).withColumn("_file", F.col("_metadata.file_path"))
            for keys, gone in self._deleted_keys(later, current):
                hit = rows.select(*keys, "_file").join(gone, keys, "left_semi").select("_file").distinct()
                found |= {_under_table(row["_file"]) for row in hit.collect()}
        return found

    def expire(self, keep: int = 2, min_age: timedelta = timedelta(days=1)) -> None:
        """Delete manifests beyond the newest ``keep``, rejected versions, then data that no manifest names.

        Only what has not changed for ``min_age`` is deleted: a reader of an old version has that long,
        and so has a running write since the last file it finished. Manifests go first, so a crash in
        between leaves unnamed data, which the next call removes.
        """
        if keep < 1:
            raise ValueError("the newest version has to stay")
        before = datetime.now(UTC) - min_age
        manifests = [n for n in storage.list_names(self.spark, f"{self.path}/manifests") if n.endswith(".json")]
        rejected = storage.list_names(self.spark, f"{self.path}/rejected")
        for name in [*(f"manifests/{n}" for n in manifests[:-keep]), *(f"rejected/{n}" for n in rejected)]:
            changed = storage.modified_at(self.spark, f"{self.path}/{name}")
            if changed is not None and changed <= before:
                storage.delete_tree(self.spark, f"{self.path}/{name}")
        named = {entry.name for live in self._live() for entry in [*live.entries, *live.deletes]}
        for folder in ("data", "deletes"):
            for write in storage.list_names(self.spark, f"{self.path}/{folder}"):
                root = f"{folder}/{write}"
                if root in named:
                    continue
                files = storage.files_under(self.spark, f"{self.path}/{root}")
                started = storage.modified_at(self.spark, f"{self.path}/{root}")
                newest = max([*files.values(), *([started] if started else [])])
                if newest > before:
                    continue
                dead = [f"{root}/{name}" for name in files if f"{root}/{name}" not in named]
                for name in dead if len(dead) < len(files) else [root]:
                    storage.delete_tree(self.spark, f"{self.path}/{name}")

    def _live(self) -> Iterable[Manifest]:
        """Every manifest that is left, rejected versions' included."""
        for name in storage.list_names(self.spark, f"{self.path}/manifests"):
            if name.endswith(".json"):
                text = storage.read_text(self.spark, f"{self.path}/manifests/{name}")
                yield Manifest.from_json(json.loads(text))
        yield from self.rejected()

    # Writing

    def _write(self, df: DataFrame, version: int) -> dict[str, list[Entry]]:
        """Write rows to a new directory; returns its files by partition.

        Rows of a table with keys are ranged by partition and key, so each file holds a stretch of
        the keys. The boundaries come from a sample, for which the steps since the last shuffle run twice.
        """
        root = f"data/{uuid.uuid4().hex}"
        cut = df if self.partition is None else df.withColumn(PART, self.partition)
        order = [f"`{name}`" for name in ([] if self.partition is None else [PART]) + list(self.keys)]
        if self.keys:
            cut = cut.repartitionByRange(*order).sortWithinPartitions(*order)
        elif self.partition is not None:
            # Rebalancing by partition value keeps files few and splits an oversized partition.
            cut = cut.hint("rebalance", F.col(PART))
        writer = cut.write.option("parquet.bloom.filter.adaptive.enabled", "true")
        if self.keys:
            writer = writer.option("maxRecordsPerFile", self.file_rows)
        for key in self.keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true")
            # Keys hardly repeat; a column stored as a dictionary would get no filter.
            writer = writer.option(f"parquet.enable.dictionary#{key}", "false")
        if self.partition is not None:
            writer = writer.partitionBy(PART)
        writer.parquet(f"{self.path}/{root}")
        names = [n for n in storage.files_under(self.spark, f"{self.path}/{root}") if n.endswith(".parquet")]
        sizes = Counter(name.rpartition("/")[0] for name in names)
        measured = self._measured(root, df.schema)
        made: dict[str, list[Entry]] = {}
        for name in sorted(names):
            directory = name.rpartition("/")[0]
            # Spark percent-escapes special characters of a value in the directory name.
            part = "all" if self.partition is None else unquote(directory.removeprefix(f"{PART}="))
            rows, bounds = measured.get(f"{root}/{name}", (None, None))
            keys = self.keys if bounds else None
            made.setdefault(part, []).append(Entry(f"{root}/{name}", version, rows, keys, bounds, sizes[directory]))
        return made

    def _measured(self, root: str, schema: StructType) -> dict[str, tuple[int, Bounds]]:
        """Rows and key bounds of every file of a write; only the keys are read."""
        if not self.keys:
            return {}
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{root}")
        files = rows.select(*(f"`{key}`" for key in self.keys), F.col("_metadata.file_path").alias("file"))
        found = files.groupBy("file").agg(*_bounds_columns(self.keys, schema)).collect()
        return {_under_table(row["file"]): (row["rows"], _bounds_of(row, self.keys, schema)) for row in found}

    def _check_schema(self, df: DataFrame, current: Manifest) -> None:
        new = {field.name: field.dataType for field in df.schema}
        old = {field.name: field.dataType for field in current.schema}
        if new != old:
            raise ValueError(f"schema of {self.path} is {old}, new rows have {new}")

    def _succeed(
        self,
        base: Manifest,
        kept: dict[str, list[Entry]],
        written: dict[str, list[Entry]],
        deletes: Sequence[Entry],
        notes: dict[str, str] | None,
    ) -> None:
        """Publish the version after ``base``: some of its files, and new ones."""
        files = {part: [*kept.get(part, []), *written.get(part, [])] for part in [*kept, *written]}
        files = {part: entries for part, entries in files.items() if entries}
        oldest = min((entry.since for entries in files.values() for entry in entries), default=0)
        # Deleted keys older than every file hide nothing.
        live = [entry for entry in deletes if entry.since > oldest]
        self._commit(Manifest(base.version + 1, base.schema, files, live, {**base.notes, **(notes or {})}))

    def _commit(self, made: Manifest) -> None:
        """An error if another run already published the version."""
        path = f"{self.path}/manifests/{made.version:010d}.json"
        storage.write_new_text(self.spark, path, json.dumps(made.to_json()))


def _by_part(pairs: Iterable[tuple[str, Entry]]) -> dict[str, list[Entry]]:
    made: dict[str, list[Entry]] = {}
    for part, entry in sorted(pairs, key=lambda pair: pair[1].name):
        made.setdefault(part, []).append(entry)
    return made


def _under_table(path: str) -> str:
    """The name under its table of a file that ``_metadata.file_path`` gives, which is escaped once more."""
    name = unquote(path)
    return name[name.rindex("/data/") + 1 :]


#: What readers of the ledger see, and what tells its lines apart.
LEDGER_SCHEMA = (
    "relation_name STRING, built_at TIMESTAMP_NTZ, run_id STRING, row_count BIGINT, compliance_owner STRING"
)
LINE_SCHEMA = f"{LEDGER_SCHEMA}, line_id STRING, outcome STRING, failed_checks STRING"
PUBLISHED, REJECTED, AUDIT = "published", "rejected", "audit"


class RejectedBuild(ValueError):
    """A build whose checks failed; the table's last version stays, the ledger has a line."""


class BuildLedger:
    """Lines about audited builds. A line is committed with the version it is about, in that manifest.

    The ledger is a published table itself. Lines are copied to it afterwards; ``settle`` copies
    those that a run did not get to, so reading it never misses one.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.table = spark, PublishedTable(spark, path)

    def settle(self, tables: Sequence[PublishedTable]) -> None:
        """Copy the lines in the tables' manifests that the ledger lacks."""
        held = []
        for table in tables:
            current = table.manifest()
            versions = ([current] if current else []) + table.rejected()
            held += [line for version in versions for line in json.loads(version.notes.get(AUDIT, "[]"))]
        if not held:
            return
        # As many lines as builds that have not been copied, a handful per table.
        known = set()
        if self.table.exists():
            ids = [line["line_id"] for line in held]
            known = {row[0] for row in self.table.read().filter(F.col("line_id").isin(ids)).select("line_id").collect()}
        new = {line["line_id"]: line for line in held if line["line_id"] not in known}
        if new:
            rows = [{**line, "built_at": datetime.fromisoformat(line["built_at"])} for line in new.values()]
            names = [part.split()[0] for part in LINE_SCHEMA.split(", ")]
            self.table.append(self.spark.createDataFrame([tuple(row[n] for n in names) for row in rows], LINE_SCHEMA))

    def lines(self) -> DataFrame:
        """All lines, those about rejected builds too."""
        return self.table.read()

    def builds(self) -> DataFrame:
        """A line per published build."""
        columns = [part.split()[0] for part in LEDGER_SCHEMA.split(", ")]
        return self.table.read().filter(F.col("outcome") == PUBLISHED).select(*columns)


def audited_publish(
    df: DataFrame,
    table: PublishedTable,
    ledger_path: str,
    run_id: str,
    compliance_owner: str = "unassigned",
    failures: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rebuild ``table`` from ``df`` if it passes its checks, with a ledger line; returns the builds.

    The rebuild is staged first. ``failures`` gets the staged rows and returns lines as ``run_checks``
    does; where any has failures the staged version is kept apart with a line that names the
    checks, and RejectedBuild is raised. Otherwise one commit publishes rows and line: a crash leaves both or
    neither. Build times are UTC.

    Rows are counted on the staged files, whose footers hold the counts, rather than while
    writing, where a retried task could be counted twice.
    """
    ledger = BuildLedger(df.sparkSession, ledger_path)
    # Lines of a run that ended between its commit and the copy; the next commit replaces them.
    ledger.settle([table])
    staged = table.stage(df)
    rows = table.read(at=staged)
    failed = []
    if failures is not None:
        # A line per check.
        failed = [f"{r.check_name}({r.column_name})" for r in failures(rows).filter("failures > 0").collect()]
    line = {
        "relation_name": table.relation,
        "built_at": datetime.now(UTC).replace(tzinfo=None).isoformat(sep=" "),
        "run_id": run_id,
        "row_count": rows.count(),
        "compliance_owner": compliance_owner,
        "line_id": uuid.uuid4().hex,
        "outcome": REJECTED if failed else PUBLISHED,
        "failed_checks": ", ".join(sorted(failed)) or None,
    }
    notes = {AUDIT: json.dumps([line])}
    if failed:
        table.reject(staged, notes)
    else:
        table.publish_staged(staged, notes)
    ledger.settle([table])
    if failed:
        raise RejectedBuild(f"{table.relation}: {line['failed_checks']}")
    return ledger.builds()
