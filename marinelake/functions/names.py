"""Campaign names, file types and output locations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# File suffixes of each family. Anything else is read as CSV.
FILE_TYPES = {
    "archive": [".tar.gz", ".tgz"],
    "nmea": [".txt"],
    "csv": [".csv", ".geocsv"],
    "hex": [".hex"],
    "cnv": [".cnv"],
    "adcp": [".raw"],
    "ad2cp": [".ad2cp"],
}
DEFAULT_FILE_TYPE = "csv"

# Companions of a cast; kept from archives, never parsed as data.
COMPANION_SUFFIXES = [".hdr", ".xmlcon"]

# Limits of a campaign name.
_NAME_MIN, _NAME_MAX = 3, 63


def has_suffix(path: Column, suffixes: list[str]) -> Column:
    name = F.lower(path)
    return reduce(lambda a, b: a | b, [name.endswith(s) for s in suffixes])


def file_type(path: Column) -> Column:
    """Family of a file, from its suffix in any letter case."""
    families = iter(FILE_TYPES.items())
    family, suffixes = next(families)
    routed = F.when(has_suffix(path, suffixes), family)
    for family, suffixes in families:
        routed = routed.when(has_suffix(path, suffixes), family)
    return routed.otherwise(DEFAULT_FILE_TYPE)


def is_companion(path: Column) -> Column:
    return has_suffix(path, COMPANION_SUFFIXES)


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def directory(path: Column) -> Column:
    return F.regexp_replace(path, r"/?[^/]*$", "")


def stem(path: Column) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def campaign_name(text: Column) -> Column:
    """A storage-safe name: lower-case letters, digits and single hyphens."""
    hyphens = F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "-")
    name = F.btrim(F.substring(F.btrim(hyphens, F.lit("-")), 1, _NAME_MAX), F.lit("-"))
    named = F.when(F.length(name) > 0, name).otherwise("default")
    padded = F.rpad(named, F.greatest(F.lit(_NAME_MIN), F.length(named)), F.lit("0"))
    return F.coalesce(padded, F.lit("default"))


def output_path(
    campaign: Column, dataset: Column, day: Column, path: Column, suffix: str = ".parquet"
) -> Column:
    """``campaign/dataset/date/stem.suffix`` of one source file."""
    return F.concat_ws(
        "/",
        campaign_name(campaign),
        dataset,
        F.date_format(day, "yyyy-MM-dd"),
        F.concat(stem(path), F.lit(suffix)),
    )
