"""Splitting, counting and routing of addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from queuelens.functions.uris import (
    container_path, quote_path, uri_authority, uri_path, uri_scheme,
)
from queuelens.plans.joins import broadcast_if_small


def uri_split(df: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with scheme, authority, path and the quoted path of ``url``."""
    text = F.col(url)
    return df.withColumns({
        "scheme": uri_scheme(text),
        "authority": uri_authority(text),
        "path": uri_path(text),
        "path_quoted": quote_path(uri_path(text)),
    })


def authority_rollup(df: DataFrame, url: str = "url") -> DataFrame:
    """Rows per scheme and authority."""
    text = F.col(url)
    return df.groupBy(uri_scheme(text).alias("scheme"), uri_authority(text).alias("authority")).agg(
        F.count("*").alias("n")
    )


def scheme_route(df: DataFrame, registry: DataFrame, url: str = "url") -> DataFrame:
    """``df`` with the file system last registered (by ``seq``) for its scheme, or null."""
    table = broadcast_if_small(registry.groupBy(F.col("scheme").alias("__scheme")).agg(
        F.max_by("file_system", "seq").alias("file_system")))
    split = df.withColumn("scheme", uri_scheme(F.col(url)))
    return split.join(table, F.col("scheme") == F.col("__scheme"), "left").drop("__scheme")


def clean_container_path(df: DataFrame, column: str, decode: bool = True) -> DataFrame:
    """``df`` with the containing file of each entry address in ``container``."""
    return df.withColumn("container", container_path(F.col(column), decode))
