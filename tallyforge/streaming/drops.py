"""Loading files as they land: a file stream in micro-batches, each merged into a published table once."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyforge.sources.published import PublishedTable


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """One row per key: the one with the latest ``at``, of equally late ones the largest by its values.

    Rows with a NULL key are kept as they are; a row without a time is older than any other.
    """
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    others = [name for name in df.columns if name not in keys]
    newest = F.max_by(F.struct(*others), F.struct(F.col(at).isNotNull(), at, *others))
    single = df.filter(known).groupBy(*keys).agg(newest.alias("_row"))
    return single.select(*keys, "_row.*").select(*df.columns).unionByName(df.filter(~known))


def merge_batch(
    table: PublishedTable, batch: DataFrame, number: int, stream: str, keys: Sequence[str], at: str, on_read: bool = False
) -> bool:
    """Merge micro-batch ``number`` unless the table already has it; whether it did.

    The number is a note of the version the batch makes, so both become visible in one step and
    a batch that is delivered again, as after a crash, does nothing. With ``on_read`` the merge writes
    only the batch, and the table's upkeep folds it in.
    """
    note, current = f"batch of {stream}", table.manifest()
    if current is not None and int(current.notes.get(note, -1)) >= number:
        return False
    rows, notes = latest_per_key(batch, keys, at), {note: str(number)}
    if on_read:
        table.upsert_on_read(rows, notes)
    else:
        table.upsert(rows, keys, notes)
    return True


def load_drops(
    spark: SparkSession,
    folder: str,
    schema: str | StructType,
    fmt: str,
    stage: Callable[[DataFrame], DataFrame],
    table: PublishedTable,
    checkpoint: str,
    keys: Sequence[str],
    at: str,
    files_per_batch: int = 1000,
    on_read: bool = False,
) -> None:
    """Merge all files that landed in ``folder`` since the last run, then stop.

    ``stage`` turns raw rows into the table's. ``checkpoint`` remembers which files are done and
    names the stream in the table's notes; it stays the same from run to run.
    """
    reader = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_batch)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)

    def merge(batch: DataFrame, number: int) -> None:
        merge_batch(table, stage(batch), number, checkpoint, keys, at, on_read)

    running = (
        reader.load(folder)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
