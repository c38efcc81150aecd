"""Raw extract schemas and readers. Types are declared, never inferred."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from tallyforge.sources.storage import materialize

# Timestamps, dates and booleans land as text and are conformed in staging.
SCHEMAS: dict[str, str] = {
    "raw_orders": """order_id STRING, customer_id STRING, shop_id STRING, ordered_at STRING,
        status STRING, channel STRING, discount_copper BIGINT""",
    "raw_order_items": """order_item_id STRING, order_id STRING, potion_sku STRING,
        quantity INT, unit_price_copper BIGINT""",
    "raw_payments": """payment_id STRING, order_id STRING, method STRING, status STRING,
        amount_copper BIGINT, paid_at STRING""",
    "raw_potions": """potion_sku STRING, potion_name STRING, category STRING,
        base_price_copper BIGINT, potency INT, shelf_life_days INT, is_regulated STRING,
        introduced_at STRING""",
    "raw_shops": """shop_id STRING, shop_name STRING, city STRING, region STRING,
        opened_at STRING""",
    "raw_suppliers": """supplier_id STRING, supplier_name STRING, region STRING,
        reliability_rating INT, contracted_since STRING""",
    "raw_ingredients": """ingredient_id STRING, ingredient_name STRING, supplier_id STRING,
        unit STRING, unit_cost_copper BIGINT, is_hazardous STRING, harvest_season STRING""",
    "raw_potion_ingredients": """potion_sku STRING, ingredient_id STRING, quantity INT,
        unit STRING""",
    "raw_brew_events": """brew_id STRING, potion_sku STRING, shop_id STRING,
        cauldron_id STRING, brewed_at STRING, batch_size INT, brew_duration_minutes INT,
        quality_check STRING, brewer_name STRING""",
    "raw_customers": """customer_id STRING, full_name STRING, email STRING,
        home_region STRING, signed_up_at STRING, birth_year INT, favored_discipline STRING""",
    "raw_guilds": "guild_id STRING, guild_name STRING, founded_year INT",
    "raw_guild_memberships": """membership_id STRING, customer_id STRING, guild_id STRING,
        tier STRING, valid_from STRING, valid_to STRING""",
}


def read_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """A CSV extract with a header row; a header that disagrees with the schema is an error."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)


LINE, SOURCE_FILE, REASON = "line_text", "source_file", "reason"


@dataclass(frozen=True)
class SplitExtract:
    """An extract's rows that fit its schema, and the others with file, line and reason."""

    rows: DataFrame
    quarantine: DataFrame

    def balance(self) -> DataFrame:
        """One row: lines read, rows staged and rows set aside, which add up."""
        staged, aside = self.rows.agg(F.count(F.lit(1)).alias("staged")), self.quarantine
        both = staged.unionByName(aside.agg(F.lit(0).cast("long").alias("staged"), F.count(F.lit(1)).alias("quarantined")), True)
        summed = both.agg(F.sum("staged").alias("staged"), F.sum(F.coalesce("quarantined", F.lit(0))).alias("quarantined"))
        return summed.select((F.col("staged") + F.col("quarantined")).alias("lines_read"), "staged", "quarantined")


def split_csv(spark: SparkSession, path: str, schema: str | StructType) -> SplitExtract:
    """Read a CSV extract with a header row; damaged rows go to a quarantine instead of failing the read.

    A row is damaged if it has too few or too many fields or a value that is not of its column's
    type. The header must agree with the schema. Parsed rows are written once, so that both sides
    come from one reading with all columns: a reading of some columns would not see damage in the others.
    """
    declared = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    reader = spark.read.schema(StructType([*declared.fields]).add(LINE, StringType()))
    reader = reader.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
    parsed = reader.option("columnNameOfCorruptRecord", LINE).csv(path)
    kept = materialize(parsed.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE)))
    damaged = F.col(LINE).isNotNull()
    fields = _field_count(F.col(LINE))
    reason = (
        F.when(fields < len(declared), "too few fields")
        .when(fields > len(declared), "too many fields")
        .otherwise("value of another type")
    )
    rows = kept.filter(~damaged).select(*(f"`{name}`" for name in declared.names))
    return SplitExtract(rows, kept.filter(damaged).select(SOURCE_FILE, LINE, reason.alias(REASON)))


def _field_count(line: Column) -> Column:
    """Fields of a CSV line; a comma between quotes is text."""
    bare = F.regexp_replace(line, r'"(?:[^"\\]|\\.)*"', "")
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def read_parquet(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


class ExtractFolder:
    """Raw tables landed as one CSV or Parquet path per table under a folder."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "csv") -> None:
        if fmt not in ("csv", "parquet"):
            raise ValueError(f"unknown extract format {fmt!r}")
        self.spark, self.root, self.fmt = spark, root.rstrip("/"), fmt

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.{self.fmt}"

    def table(self, name: str) -> DataFrame:
        read = read_csv if self.fmt == "csv" else read_parquet
        return read(self.spark, self.path(name), SCHEMAS[name])

    def source_paths(self, name: str) -> list[str]:
        return [self.path(name)]


class CatalogTables:
    """Raw tables registered in a catalog database, or as session views without one."""

    def __init__(self, spark: SparkSession, database: str | None = None) -> None:
        self.spark, self.database = spark, database

    def _name(self, name: str) -> str:
        return f"{self.database}.{name}" if self.database else name

    def table(self, name: str) -> DataFrame:
        return self.spark.table(self._name(name))

    def source_paths(self, name: str) -> list[str]:
        """Where the table is stored; empty for views."""
        described = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self._name(name)}")
        return [row.data_type for row in described.filter("col_name = 'Location'").collect()]
