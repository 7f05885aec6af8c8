"""Expressions on file names and object keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trendlake.config import UNKNOWN_REGION


def decode_key(key: Column, plus_is_space: bool = True) -> Column:
    """Key without URL escapes; one with broken escapes is kept as it is.

    Upload notices write a space as ``+``; file names reported by Spark keep a real plus.
    """
    escaped = key if plus_is_space else F.replace(key, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(escaped), key)


def region_of_path(path: Column) -> Column:
    """Value of the first ``region=`` folder of a decoded path, else ``unknown``."""
    value = F.regexp_extract(path, r"(?:^|/)region=([^/=]*)", 1)
    return F.when(path.isNotNull() & (value != ""), value).otherwise(F.lit(UNKNOWN_REGION))
