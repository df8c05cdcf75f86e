"""Provider and observatory enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marinelake.options import ProviderRule

# The rules become one expression; a larger set belongs in a table with names.
MAX_RULES = 1000


def detected_provider(path: Column, rules: list[ProviderRule]) -> Column:
    """Name of the first rule whose pattern is found in the path."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} provider rules")
    name = F.lit(None).cast("string")
    for rule in reversed(rules):
        name = F.when(path.rlike(rule.path_pattern), rule.name).otherwise(name)
    return name


def _filled(df: DataFrame, supplied: list[str], prefix: str) -> dict[str, Column]:
    return {
        c: F.coalesce(F.col(c), F.col(prefix + c)) if c in df.columns else F.col(prefix + c)
        for c in supplied
    }


def enrich_by_key(df: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Left equi-join that fills columns; a measured value wins over a supplied one.

    ``dimension`` has one row per ``key``; how it is joined follows from its
    measured size.
    """
    supplied = [c for c in dimension.columns if c != key]
    renamed = dimension.select(key, *[F.col(c).alias("_dim_" + c) for c in supplied])
    return (
        df.join(renamed, key, "left")
        .withColumns(_filled(df, supplied, "_dim_"))
        .drop(*["_dim_" + c for c in supplied])
    )


def enrich_provider(
    df: DataFrame,
    providers: DataFrame,
    name: str = "auto",
    rules: list[ProviderRule] | None = None,
    path: str = "source_file",
) -> DataFrame:
    """Add ``provider`` and fill what it supplies; rows without one pass unchanged.

    ``name`` picks one provider; ``auto`` finds it per row from the path.
    """
    provider = detected_provider(F.col(path), rules or []) if name == "auto" else F.lit(name)
    return enrich_by_key(df.withColumn("provider", provider), providers, "provider")


def rules_enrichment(
    df: DataFrame, rules: list[ProviderRule], path: str = "source_file", name: str = "auto"
) -> DataFrame:
    """Enrichment from rules alone: name, fixed coordinates and attributes, without a join.

    ``name`` picks one provider for all rows; ``auto`` finds it from the path. Of two
    rules of one name the first supplies the values, as it is the one that detects.
    """
    provider = detected_provider(F.col(path), rules) if name == "auto" else F.lit(name)
    latitude, longitude = F.lit(None).cast("double"), F.lit(None).cast("double")
    attributes = F.create_map().cast("map<string,string>")
    for rule in reversed(rules):
        chosen = F.col("provider") == rule.name
        latitude = F.when(chosen, F.lit(rule.latitude).cast("double")).otherwise(latitude)
        longitude = F.when(chosen, F.lit(rule.longitude).cast("double")).otherwise(longitude)
        if rule.attributes:
            pairs = [F.lit(x) for item in rule.attributes.items() for x in item]
            attributes = F.when(chosen, F.create_map(*pairs)).otherwise(attributes)
    return df.withColumn("provider", provider).withColumns(
        {
            "latitude": F.coalesce(F.col("latitude"), latitude),
            "longitude": F.coalesce(F.col("longitude"), longitude),
            "attributes": attributes,
        }
    )


def enrich_observatory(
    readings: DataFrame, observatories: DataFrame, key: str = "observatory"
) -> DataFrame:
    """Fill a reading from its observatory and rename its columns.

    ``observatories`` may have a ``column_map MAP<STRING,STRING>`` from raw to
    output names; it is applied to a ``record`` map of the reading.
    """
    joined = enrich_by_key(readings, observatories, key)
    if "record" in joined.columns and "column_map" in joined.columns:
        renamed = F.transform_keys(
            "record", lambda k, _: F.coalesce(F.col("column_map")[k], k)
        )
        joined = joined.withColumn("record", renamed).drop("column_map")
    return joined
