"""What several operators of this folder need."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.sources.scratch import scratch_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read from there.

    Later jobs neither recompute it nor depend on the executors that made it.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def fresh(name: str, *frames: DataFrame) -> str:
    """``name``, with underscores added until no frame has such a column (in any case)."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose doc_id and text hash are in ``gone`` (doc_id, mark); null ids count as equal."""
    i, m = fresh("gone_id", docs), fresh("gone_mark", docs)
    listed = gone.select(F.col("doc_id").alias(i), F.col("mark").alias(m)).distinct()
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(i)) & (F.xxhash64(F.col("text").cast("string")) == F.col(m))
    return docs.join(stored(listed, "gone"), same, "left_anti")


def slices(text: str, cut: re.Pattern, size: int) -> Iterator[str]:
    """``text`` in slices of about ``size`` characters, each but the first beginning with a match of ``cut``."""
    at = 0
    while len(text) - at > size:
        found = cut.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.start()
    yield text[at:] if at else text
