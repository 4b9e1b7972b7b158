"""Country and region of an address, from a table of address ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import ip_number
from sluice.operators.joins import band_lookup


def locate(df: DataFrame, ip: Column | str, ranges: DataFrame, cell: int = 1 << 16) -> DataFrame:
    """Add country and region; ``unknown`` when no range holds the address.

    ``ranges`` has ``first_ip`` and ``last_ip`` as numbers that do not overlap.
    """
    numbered = df.withColumn("_ip", ip_number(ip))
    found = band_lookup(numbered, "_ip", ranges, "first_ip", "last_ip", cell, how="left")
    return found.withColumns(
        {c: F.coalesce(c, F.lit("unknown")) for c in ("country", "region")}
    ).drop("_ip", "first_ip", "last_ip")
