"""Intermediate tables in the folder that driver and executors share.

A written table cuts the lineage, outlives a lost executor and is read back
with statistics, so joins on it are planned (and split) from fresh exchanges.
The end of the application deletes them; ``discard`` does so earlier.
"""

from __future__ import annotations

import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame

from ..session import delete, work_dir

_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it again."""
    spark = df.sparkSession
    path = f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _paths[out] = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete materialized tables that no DataFrame still in use reads."""
    for df in tables:
        path = _paths.pop(df, None)
        if path:
            delete(df.sparkSession, path)
