"""Run folders: written steps and cached frames with one owner.

A ``RunFolder`` lives under the shared folder that ``spark.checkpoint.dir``
names.  Its owner closes it: cached frames are released and the folder goes.
"""

from __future__ import annotations

import atexit
import os
import shutil
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

from branchbook.session import ensure_checkpoint_dir


class RunFolder:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/branchbook-run-{uuid.uuid4().hex}"
        self._cached: list[DataFrame] = []
        atexit.register(self._remove)

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """One job; lineage is cut at the table, whose real size the optimizer
        then knows.  The schema is known, so no footers are read."""
        path = f"{self.path}/{name}-{uuid.uuid4().hex}"
        df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def persist(self, df: DataFrame) -> DataFrame:
        self._cached.append(df.persist())
        return df

    def close(self) -> None:
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
        self._remove()
        atexit.unregister(self._remove)

    def _remove(self) -> None:
        """A local or mounted folder is removed; an object store's is left to
        its lifecycle rule."""
        url = urlparse(self.path)
        if url.scheme in ("", "file") and os.path.isdir(url.path):
            shutil.rmtree(url.path, ignore_errors=True)
