"""Column functions that turn messy extract text into typed, canonical values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings of each canonical region.
REGION_ALIASES: dict[str, tuple[str, ...]] = {
    "Northern Reaches": ("nr", "northern reaches"),
    "Crystal Vale": ("cv", "crystal vale"),
    "The Marshlands": ("ml", "the marshlands", "marshlands"),
    "Ember Coast": ("ec", "ember coast"),
    "Silverwood": ("sw", "silverwood"),
}

# The accepted spellings of true and false.
TRUE_TOKENS = ("y", "yes", "true", "t", "1")
FALSE_TOKENS = ("n", "no", "false", "f", "0")


def clean_token(text: Column) -> Column:
    """Lowercased text without surrounding spaces."""
    return F.lower(F.trim(text))


def blank_to_null(text: Column) -> Column:
    """Trimmed text; empty or all-space becomes NULL."""
    return F.nullif(F.trim(text), F.lit(""))


def normalize_region(
    text: Column, aliases: Mapping[str, Sequence[str]] = REGION_ALIASES
) -> Column:
    """Canonical region for any accepted spelling, else NULL."""
    token = clean_token(text)
    canonical = F.lit(None).cast("string")
    for region, spellings in aliases.items():
        canonical = F.when(token.isin(*spellings), F.lit(region)).otherwise(canonical)
    return canonical


def to_boolean(text: Column) -> Column:
    """True, false, or NULL when the token is neither."""
    token = clean_token(text)
    return F.when(token.isin(*TRUE_TOKENS), F.lit(True)).when(
        token.isin(*FALSE_TOKENS), F.lit(False)
    )


def parse_source_timestamp(text: Column) -> Column:
    """Wall-clock timestamp from ISO-8601-with-Z or space-separated text, else NULL."""
    spaced = F.replace(F.replace(text, F.lit("T"), F.lit(" ")), F.lit("Z"), F.lit(""))
    return spaced.try_cast("timestamp_ntz")


def parse_source_date(text: Column) -> Column:
    """Date from ``yyyy-MM-dd`` text, else NULL."""
    return F.try_to_date(text, "yyyy-MM-dd")


def coalesce_region(shop_region: Column, customer_region: Column, fallback: str = "unknown") -> Column:
    """The shop's region, else the customer's, else a label."""
    return F.coalesce(shop_region, customer_region, F.lit(fallback))
