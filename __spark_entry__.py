"""Registered queries over the driver tables, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegerType

import oracles
from tallyforge.functions.conform import coalesce_region
from tallyforge.functions.measures import (
    bucket_amount,
    days_between,
    is_weekend,
    pct_change,
    period_start,
    safe_divide,
)
from tallyforge.operators.checks import (
    AcceptedValues,
    NotNull,
    Relationship,
    Unique,
    duplicate_audit,
    orphans,
    repeated_keys,
    run_checks,
    unlisted_values,
)
from tallyforge.operators.bitmaps import distinct_bitmaps, distinct_counts
from tallyforge.operators.pivots import distinct_values
from tallyforge.plans import facts, staging
from tallyforge.plans.aggregates import CATEGORIES
from tallyforge.plans.build import build, check_build
from tallyforge.plans.marts import RetailMarts
from tallyforge.plans.quality import ORDER_STATUSES
from tallyforge.settings import Settings
from tallyforge.sources.colocated import ColocatedTables
from tallyforge.sources.driver_tables import DriverTables
from tallyforge.sources.extracts import SplitExtract, read_csv, split_csv
from tallyforge.sources.published import BuildLedger, PublishedTable, RejectedBuild
from tallyforge.sources.storage import scratch_dir
from tallyforge.streaming.incremental import high_water_mark, load, load_keyless, newer_rows

BEFORE_CUTOFF = "paid_at < TIMESTAMP_NTZ '2024-01-16 00:00:00'"
FIRST_SNAPSHOT = datetime(2024, 1, 1)
BETWEEN_SNAPSHOTS = datetime(2024, 1, 15)
SECOND_SNAPSHOT = datetime(2024, 2, 1)
RUN_ID = "registered-query"

Query = Callable[[SparkSession, str], DataFrame]

try:  # These two may be taken out of the repository; everything else stays as it is.
    import corpus_pipeline
    from tallyforge.llm import queries as corpus
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "tallyforge.llm"):
        raise
    corpus = corpus_pipeline = None


def _marts(spark: SparkSession, sf_dir: str, **settings) -> RetailMarts:
    return RetailMarts(DriverTables(spark, sf_dir), Settings(run_id=RUN_ID, **settings))


def _comparable(df: DataFrame) -> DataFrame:
    """Decimals as DOUBLE and integers as BIGINT, the types the SQL side casts to."""
    wide = {DecimalType: "double", IntegerType: "bigint"}
    return df.select(
        *(
            F.col(f"`{field.name}`").cast(wide[type(field.dataType)]).alias(field.name)
            if type(field.dataType) in wide
            else F.col(f"`{field.name}`")
            for field in df.schema
        )
    )


def _model(name: str, **settings) -> Query:
    """A query that is one model of the assembly."""
    return lambda spark, sf_dir: getattr(_marts(spark, sf_dir, **settings), name)()


# Sources and sinks


def scan_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return DriverTables(spark, sf_dir).parquet("orders")


def csv_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as CSV with a header, read back with a declared schema and staged."""
    raw = DriverTables(spark, sf_dir).raw_orders()
    path = scratch_dir(spark)
    raw.write.option("header", True).csv(path)
    return staging.orders(read_csv(spark, path, raw.schema), Settings())


def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = PublishedTable(spark, scratch_dir(spark))
    table.replace(_marts(spark, sf_dir).fct_orders())
    return table.read()


def _order_grain(spark: SparkSession, sf_dir: str) -> tuple[RetailMarts, ColocatedTables]:
    marts, root = _marts(spark, sf_dir), scratch_dir(spark)
    tables = ColocatedTables(spark, root.rpartition("-")[2], "order_id", marts.order_grain_buckets(), root)
    marts.publish_order_grain(tables)
    return marts, tables


def fct_orders_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts, tables = _order_grain(spark, sf_dir)
    return marts.fct_orders_colocated(tables)


def fct_order_items_colocated(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts, tables = _order_grain(spark, sf_dir)
    return marts.fct_order_items_colocated(tables)


def orders_backfill_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(spark, sf_dir).publish_orders_backfill(PublishedTable(spark, scratch_dir(spark)))


def orders_audited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _marts(spark, sf_dir).fct_orders_audited()
    return rows.select("order_id", F.col("loaded_at").isNotNull().alias("is_stamped"), "run_id")


def regulated_sales_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The build ledger after publishing the regulated sales twice, without its clock column."""
    root = scratch_dir(spark)
    table = PublishedTable(spark, f"{root}/regulated_sales", relation="marts.regulated_sales")
    marts = _marts(spark, sf_dir)
    marts.publish_regulated_sales(table, f"{root}/build_ledger")
    return marts.publish_regulated_sales(table, f"{root}/build_ledger").drop("built_at")


def regulated_sales_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger's lines after a build that passes its checks, one that fails them, and one more that passes."""
    root, marts = scratch_dir(spark), _marts(spark, sf_dir)
    table = PublishedTable(spark, f"{root}/regulated_sales", relation="marts.regulated_sales")
    rows, checks = marts.regulated_sales(), (NotNull("order_id"), NotNull("potion_sku"))
    marts.publish_regulated_sales(table, f"{root}/build_ledger", rows, checks)
    orphaned = rows.withColumn("order_id", F.lit(None).cast(rows.schema["order_id"].dataType))
    try:
        marts.publish_regulated_sales(table, f"{root}/build_ledger", orphaned, checks)
    except RejectedBuild:
        marts.publish_regulated_sales(table, f"{root}/build_ledger", table.read(), checks)
    lines = BuildLedger(spark, f"{root}/build_ledger").lines()
    return lines.select("relation_name", "run_id", "row_count", "outcome", "failed_checks")


# Incremental loads


def incremental_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = _marts(spark, sf_dir)
    table = marts.payment_events_table(scratch_dir(spark))
    marts.load_payment_events(table)
    return table.read()


def incremental_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one run reads when the table holds the payments before the cutoff."""
    marts = _marts(spark, sf_dir)
    table = marts.payment_events_table(scratch_dir(spark))
    table.replace(marts.stg_payments().filter(BEFORE_CUTOFF))
    return newer_rows(marts.stg_payments(), "paid_at", high_water_mark(table, "paid_at"))


def _three_runs(spark: SparkSession, sf_dir: str, run) -> DataFrame:
    """The duplicate audit after a first load and two more runs over an unchanged source."""
    marts = _marts(spark, sf_dir)
    table = marts.payment_events_table(scratch_dir(spark))
    audits = []
    for number in (1, 2, 3):
        run(table, marts.stg_payments())
        audits.append(duplicate_audit(table.read(), "payment_id").select(F.lit(number).alias("run"), "*"))
    return audits[0].unionByName(audits[1]).unionByName(audits[2])


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_runs(spark, sf_dir, lambda table, rows: load_keyless(table, rows, "paid_at"))


def incremental_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _three_runs(spark, sf_dir, lambda table, rows: load(table, rows, "paid_at", ["payment_id"]))


def incremental_upsert_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments after a batch that corrects amounts and one that brings newer rows."""
    marts = _marts(spark, sf_dir)
    table = marts.payment_events_table(scratch_dir(spark))
    rows = marts.stg_payments()
    table.replace(rows.filter(BEFORE_CUTOFF))
    corrected = rows.filter(F.col("payment_status") == "failed").withColumn("amount_copper", F.col("amount_copper") + 7)
    table.upsert(corrected, ["payment_id"])
    table.upsert(rows.filter(f"NOT ({BEFORE_CUTOFF})"), ["payment_id"])
    return table.read()


def incremental_merge_on_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches merged on read, then some payments deleted; the first deletions are folded in."""
    marts = _marts(spark, sf_dir)
    table = marts.payment_events_table(scratch_dir(spark))
    rows = marts.stg_payments()
    table.replace(rows.filter(BEFORE_CUTOFF))
    corrected = rows.filter(F.col("payment_status") == "failed").withColumn("amount_copper", F.col("amount_copper") + 7)
    table.upsert_on_read(corrected)
    table.compact()
    table.upsert_on_read(rows.filter(f"NOT ({BEFORE_CUTOFF})"))
    table.delete_on_read(rows.filter("payment_id % 50 = 7"))
    return table.read()


def order_payments_maintained(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payments per order, refreshed from the changes of a correction, a newer batch and deletions."""
    marts, root = _marts(spark, sf_dir), scratch_dir(spark)
    table = marts.payment_events_table(f"{root}/payments")
    rollup = marts.order_payments_rollup(table, f"{root}/rollup")
    rows = marts.stg_payments()
    table.replace(rows.filter(BEFORE_CUTOFF))
    rollup.refresh()
    corrected = rows.filter(F.col("payment_status") == "failed").withColumn("amount_copper", F.col("amount_copper") + 7)
    table.upsert(corrected, ["payment_id"])
    table.upsert_on_read(rows.filter(f"NOT ({BEFORE_CUTOFF})"))
    rollup.refresh()
    table.delete_on_read(rows.filter("payment_id % 50 = 7"))
    rollup.refresh()
    counted = rollup.read().withColumnRenamed("rollup_rows", "payment_attempt_count")
    return facts.with_payment_gold(counted, marts.settings)


def checks_followed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment checks after a batch of repeated payments with an unlisted method."""
    marts, root = _marts(spark, sf_dir), scratch_dir(spark)
    table = marts.payment_events_table(f"{root}/payments")
    checks = marts.payment_checks(table, f"{root}/checks")
    rows = marts.stg_payments()
    table.replace(rows)
    checks.refresh()
    table.append(rows.filter("payment_id % 40 = 1").withColumn("payment_method", F.lit("shells")))
    checks.refresh()
    return checks.read()


def payments_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments landing in three drops, each merged by a run of the file stream."""
    marts, root = _marts(spark, sf_dir), scratch_dir(spark)
    table = marts.payment_events_table(f"{root}/payments")
    raw = marts.raw.table("raw_payments")
    for drop in range(3):
        raw.filter(F.col("payment_id") % 3 == drop).write.mode("append").parquet(f"{root}/landing")
        marts.load_payment_drops(table, f"{root}/landing", f"{root}/checkpoint", on_read=drop == 2)
    return table.read()


DAMAGE = """CASE order_id % 50 WHEN 1 THEN substring_index(line, ',', 6) WHEN 2 THEN concat(line, ',more')
    WHEN 3 THEN concat(substring_index(line, ',', 6), ',much') ELSE line END"""


def _damaged_orders(spark: SparkSession, sf_dir: str) -> SplitExtract:
    """Orders landed as CSV, some lines short, some long, some with text for a number."""
    raw, path = DriverTables(spark, sf_dir).raw_orders(), scratch_dir(spark)
    fields = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in raw.columns)
    lines = raw.select("order_id", F.concat_ws(",", *fields).alias("line"))
    # A separator that no line holds, so that each is written as it is, below a header.
    text = lines.select(F.expr(DAMAGE).alias(",".join(raw.columns)))
    text.write.option("header", True).option("sep", "\x01").option("quote", "").csv(path)
    return split_csv(spark, path, raw.schema)


def quarantined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    aside = _damaged_orders(spark, sf_dir).quarantine
    return aside.select(F.substring_index("line_text", ",", 1).cast("bigint").alias("order_id"), "reason")


def extract_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _damaged_orders(spark, sf_dir).balance()


def staged_undamaged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.orders(_damaged_orders(spark, sf_dir).rows, Settings())


def customers_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct customers by region and quarter from monthly bitmaps, stored in two loads."""
    marts = _marts(spark, sf_dir)
    table = PublishedTable(spark, scratch_dir(spark))
    month = period_start(F.col("ordered_at"), "month").alias("order_month")
    orders = marts.orders_enriched().select("order_id", "customer_id", "shop_region", month)
    for half in (0, 1):
        some = orders.filter(F.col("order_id") % 2 == half)
        table.append(distinct_bitmaps(some, ["shop_region", "order_month"], "customer_id"))
    groups = {"shop_region": F.col("shop_region"), "order_quarter": period_start(F.col("order_month"), "quarter")}
    return distinct_counts(table.read(), groups, "customer_count")


def incremental_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments after refunds land late and a run looks two days behind the mark."""
    marts = _marts(spark, sf_dir)
    table = marts.payment_events_table(scratch_dir(spark))
    table.replace(marts.stg_payments().filter(f"{BEFORE_CUTOFF} AND payment_status <> 'refunded'"))
    marts.load_payment_events(table, lookback=timedelta(days=2))
    return table.read()


class TextTimes(DriverTables):
    """Payments as a feed lands them: times as text in both shapes, some after blanks, some unreadable."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        super().__init__(spark, sf_dir)
        self.path = scratch_dir(spark)
        super().raw_payments().withColumn("paid_at", F.expr(PAID_TEXT)).write.parquet(self.path)

    def raw_payments(self) -> DataFrame:
        return self.spark.read.parquet(self.path)


PAID_TEXT = """CASE WHEN payment_id % 97 = 0 THEN 'n/a'
    ELSE concat(if(payment_id % 5 = 0, '  ', ''), date_format(paid_at,
        if(payment_id % 2 = 0, "yyyy-MM-dd'T'HH:mm:ss'Z'", 'yyyy-MM-dd HH:mm:ss'))) END"""


def incremental_text_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments of a text feed after a first load of the older ones and one run."""
    marts = RetailMarts(TextTimes(spark, sf_dir), Settings(run_id=RUN_ID))
    table = marts.payment_events_table(scratch_dir(spark))
    table.replace(marts.stg_payments().filter(f"{BEFORE_CUTOFF} OR paid_at IS NULL"))
    marts.load_payment_texts(table)
    return table.read()


def incremental_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payments spread over seven months, after corrections in two of them and a move between two."""
    marts = _marts(spark, sf_dir)
    table = marts.payment_events_table(scratch_dir(spark))
    rows = marts.stg_payments().withColumn("paid_at", F.expr("paid_at + make_ym_interval(0, int(payment_id % 7))"))
    table.replace(rows)
    table.upsert(rows.filter("payment_id % 70 IN (1, 3)").withColumn("amount_copper", F.lit(5).cast("bigint")), ["payment_id"])
    moved = F.expr("paid_at + make_ym_interval(0, 1)")
    table.upsert(rows.filter("payment_id % 70 = 2").withColumn("paid_at", moved), ["payment_id"])
    table.compact(1)
    table.expire(1, timedelta(0))
    return table.read()


def _built(name: str) -> Query:
    """The rows of one mart after the full build."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        marts = _marts(spark, sf_dir)
        return build(marts, scratch_dir(spark), FIRST_SNAPSHOT, shelved=True)[name].read()

    return read


# History


def _membership_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = DriverTables(spark, sf_dir)
    marts = RetailMarts(raw)
    table = marts.memberships_history_table(scratch_dir(spark))
    marts.snapshot_memberships(table, FIRST_SNAPSHOT)
    later = staging.guild_memberships(raw.raw_guild_memberships_later())
    marts.snapshot_memberships(table, SECOND_SNAPSHOT, later)
    return table.read()


def scd2_late_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Membership versions of three extracts, of which the middle one lands last."""
    raw = DriverTables(spark, sf_dir)
    marts = RetailMarts(raw)
    table = marts.memberships_history_table(scratch_dir(spark))
    marts.snapshot_memberships(table, FIRST_SNAPSHOT)
    marts.snapshot_memberships(table, SECOND_SNAPSHOT, staging.guild_memberships(raw.raw_guild_memberships_later()))
    middle = marts.stg_guild_memberships().filter("membership_id % 13 <> 0")
    middle = middle.withColumn("tier", F.expr("if(membership_id % 7 = 0, 'archmage', tier)"))
    marts.insert_membership_snapshot(table, BETWEEN_SNAPSHOTS, middle)
    return table.read()


def scd2_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions closed because their key left the source: closed, with no successor."""
    history = _membership_history(spark, sf_dir)
    latest = history.groupBy("membership_id").agg(
        F.count_if(F.col("version_to").isNull()).alias("open_versions"),
        F.count(F.lit(1)).alias("versions"),
        F.max("version_to").alias("closed_at"),
    )
    return latest.filter("open_versions = 0").drop("open_versions")


# Scalar functions


def safe_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    size, minutes = F.col("batch_size"), F.col("brew_duration_minutes")
    return _marts(spark, sf_dir).stg_brew_events().select(
        "brew_id",
        safe_divide(size, minutes).alias("rate"),
        safe_divide(size, minutes, F.lit(0.0)).alias("rate_or_zero"),
    )


def price_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line price against the potion's list price."""
    change = pct_change(F.col("unit_price_copper"), F.col("base_price_copper"))
    return _marts(spark, sf_dir).priced_lines().select("order_item_id", "potion_sku", change.alias("price_change"))


def amount_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(spark, sf_dir).stg_payments().select(
        "payment_id", bucket_amount(F.col("amount_gold"), 10, 40).alias("amount_band")
    )


def membership_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(spark, sf_dir).stg_guild_memberships().select(
        "membership_id", days_between(F.col("valid_from"), F.col("valid_to")).alias("days")
    )


def region_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(spark, sf_dir).orders_enriched().select(
        "order_id", coalesce_region(F.col("shop_region"), F.col("customer_home_region")).alias("region")
    )


def weekend_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _marts(spark, sf_dir).stg_orders()
    return orders.groupBy(is_weekend(F.col("ordered_at")).alias("is_weekend_order")).agg(
        F.count(F.lit(1)).alias("order_count")
    )


def monthly_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = _marts(spark, sf_dir)
    priced = marts.stg_orders().join(marts.order_item_totals(), "order_id", "left")
    return priced.groupBy(period_start(F.col("ordered_at"), "month").alias("order_month")).agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("gross_amount_gold").alias("gross_revenue_gold")
    )


def potion_margin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _marts(spark, sf_dir).dim_potions().select("potion_sku", "unit_margin_copper", "unit_margin_pct")


def customer_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _marts(spark, sf_dir).dim_customers()
    return customers.groupBy("value_segment").agg(F.count(F.lit(1)).alias("customer_count"))


def category_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_values(DriverTables(spark, sf_dir).raw_potions(), "category")


# Checks


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line ids that occur more than once."""
    return repeated_keys(_marts(spark, sf_dir).stg_order_items(), ["order_item_id"])


def check_unique_combo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and potion pairs that occur more than once."""
    return repeated_keys(_marts(spark, sf_dir).stg_order_items(), ["order_id", "potion_sku"])


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = _marts(spark, sf_dir)
    tables = {"orders": marts.stg_orders(), "brews": marts.stg_brew_events()}
    columns = {
        "orders": ("order_id", "ordered_at", "discount_copper"),
        "brews": ("brew_id", "brew_duration_minutes", "quality_check"),
    }
    return run_checks(tables, {table: [NotNull(c) for c in names] for table, names in columns.items()})


def check_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    marts = _marts(spark, sf_dir)
    tables = {"orders": marts.stg_orders(), "potions": marts.stg_potions()}
    return run_checks(
        tables,
        {
            "orders": [AcceptedValues("order_status", ORDER_STATUSES), AcceptedValues("channel", ("in_store",))],
            "potions": [AcceptedValues("category", CATEGORIES)],
        },
    )


def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop ids of orders that are on no shop list, with their order counts."""
    marts = _marts(spark, sf_dir)
    return orphans(marts.stg_orders(), "shop_id", marts.stg_shops(), "shop_id")


def check_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Potion categories missing from the declared list."""
    return unlisted_values(_marts(spark, sf_dir).stg_potions(), "category", CATEGORIES)


def check_negative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composite key and relationship checks that fail on the line table."""
    marts = _marts(spark, sf_dir)
    tables = {"lines": marts.stg_order_items(), "orders": marts.stg_orders(), "shops": marts.stg_shops()}
    checks = {
        "lines": [Unique(("order_id", "potion_sku")), Relationship("order_id", "orders", "order_id")],
        "orders": [Relationship("shop_id", "shops", "shop_id")],
    }
    return run_checks(tables, checks)


def full_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks' results after every mart has been published."""
    marts = _marts(spark, sf_dir)
    return check_build(marts, build(marts, scratch_dir(spark), FIRST_SNAPSHOT, shelved=True))


def audit_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_audit(_marts(spark, sf_dir).stg_order_items(), "order_item_id")


REGISTERED: dict[str, Query] = {
    "scan_orders": scan_orders,
    "csv_orders": csv_orders,
    "published_orders": published_orders,
    "orders_audited": orders_audited,
    "regulated_sales_ledger": regulated_sales_ledger,
    "incremental_full": incremental_full,
    "incremental_delta": incremental_delta,
    "incremental_append": incremental_append,
    "incremental_upsert": incremental_upsert,
    "incremental_upsert_changed": incremental_upsert_changed,
    "incremental_lookback": incremental_lookback,
    "incremental_text_times": incremental_text_times,
    "incremental_months": incremental_months,
    "built_order_items": _built("fct_order_items"),
    "built_backfill": _built("fct_orders_backfill"),
    "built_channel_mix": _built("agg_shop_channel_mix"),
    "scd2_check": _membership_history,
    "scd2_deletes": scd2_deletes,
    "scd2_late_extract": scd2_late_extract,
    "regulated_sales_rejected": regulated_sales_rejected,
    "incremental_merge_on_read": incremental_merge_on_read,
    "order_payments_maintained": order_payments_maintained,
    "checks_followed": checks_followed,
    "payments_stream": payments_stream,
    "quarantined_orders": quarantined_orders,
    "extract_balance": extract_balance,
    "staged_undamaged_orders": staged_undamaged_orders,
    "customers_by_quarter": customers_by_quarter,
    "fct_orders_colocated": fct_orders_colocated,
    "fct_order_items_colocated": fct_order_items_colocated,
    "payment_method_mix_rows": _model("payment_method_mix_rows"),
    "stg_orders": _model("stg_orders"),
    "stg_order_items": _model("stg_order_items"),
    "stg_payments": _model("stg_payments"),
    "stg_parts": _model("stg_potions"),
    "stg_brew_events": _model("stg_brew_events"),
    "stg_ingredients": _model("stg_ingredients"),
    "stg_recipes": _model("stg_potion_ingredients"),
    "stg_shops": _model("stg_shops"),
    "stg_suppliers": _model("stg_suppliers"),
    "stg_customers": _model("stg_customers"),
    "stg_memberships": _model("stg_guild_memberships"),
    "stg_guilds": _model("stg_guilds"),
    "order_item_totals": _model("order_item_totals"),
    "order_payments": _model("order_payments"),
    "orders_enriched": _model("orders_enriched"),
    "fct_orders": _model("fct_orders"),
    "fct_order_items": _model("fct_order_items"),
    "orders_backfill": _model("orders_backfill", run_mode="backfill"),
    "orders_backfill_stored": orders_backfill_stored,
    "regulated_sales": _model("regulated_sales"),
    "brew_yield": _model("brew_yield"),
    "current_membership": _model("current_membership"),
    "customer_activity": _model("customer_activity"),
    "dim_customers": _model("dim_customers"),
    "customer_segments": customer_segments,
    "recipe_cost": _model("recipe_cost"),
    "brew_stats": _model("brew_stats"),
    "dim_parts": _model("dim_potions"),
    "potion_margin": potion_margin,
    "supplier_scorecard": _model("supplier_scorecard"),
    "shop_counts": _model("shop_counts"),
    "revenue_by_region": _model("revenue_by_region"),
    "monthly_revenue": monthly_revenue,
    "category_list": category_list,
    "category_revenue": _model("category_revenue"),
    "spread_order_items": _model("fct_order_items", task_bytes=2000, broadcast_bytes=-1),
    "category_revenue_pivot": _model("category_revenue_pivot"),
    "payment_method_mix": _model("payment_method_mix"),
    "payment_method_mix_dynamic": _model("payment_method_mix_dynamic"),
    "payment_mix_total": _model("payment_mix_total"),
    "channel_mix": _model("channel_mix"),
    "channel_mix_labelled": _model("channel_mix_labelled"),
    "safe_ratio": safe_ratio,
    "pct_change": price_change,
    "amount_buckets": amount_buckets,
    "days_between": membership_days,
    "region_fallback": region_fallback,
    "weekend_orders": weekend_orders,
    "check_unique": check_unique,
    "check_unique_combo": check_unique_combo,
    "check_not_null": check_not_null,
    "check_accepted": check_accepted,
    "check_relationships": check_relationships,
    "check_drift": check_drift,
    "check_negative": check_negative,
    "check_all": _model("check_all"),
    "full_build": full_build,
    "duplicate_audit": audit_lines,
}


def entry(spark: SparkSession, sf_dir: str = "/root/testdata/sf0.001") -> DataFrame:
    """The order fact, over the smallest driver tables unless others are named."""
    return queries()["fct_orders"](spark, sf_dir)


def queries() -> dict[str, Query]:
    def comparable(query: Query) -> Query:
        return lambda spark, sf_dir: _comparable(query(spark, sf_dir))

    found = {name: comparable(query) for name, query in REGISTERED.items()}
    if corpus:
        found |= corpus.QUERIES | {"pipeline": corpus_pipeline.run}
    return found


def oracle_sql() -> dict[str, str]:
    found = oracles.build()
    if corpus:
        found |= corpus.ORACLES
        if corpus_pipeline.ORACLE_SQL:
            found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
