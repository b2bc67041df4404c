from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def tagged_union(frames: Mapping[str, DataFrame], tag_col: str) -> DataFrame:
    """Stack tables by column name with their tag; an absent column gives NULL."""
    tagged = [df.withColumn(tag_col, F.lit(tag)) for tag, df in frames.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
