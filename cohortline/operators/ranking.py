"""Rows in an order, with each row's place in it, without one task that sees them all."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Written by a task: its number, and its files' if it wrote several.
_PART = r"part-(\d+)-.*-c(\d+)"


def write_ordered(df: DataFrame, path: str, order: Sequence[str]) -> DataFrame:
    """Write ``df`` as Parquet in ascending ``order`` (nulls first) and return it with a
    ``place`` column in front: 0 for the first row, as many more as rows before it.

    The rows are dealt to tasks by ranges of the order and sorted in each; a task's file is a range. A row's
    place is the number of rows in the files before its own, which is one number per file, and its
    position in the file, which the reader knows. So the only thing that is gathered is a count per
    file. Ties of ``order`` go by the other columns that can be compared; equal rows get a place each.
    """
    spark = df.sparkSession
    rest = [f.name for f in df.schema.fields if f.name not in order
            and not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    by = [F.col(f"`{c}`").asc_nulls_first() for c in [*order, *rest]]
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path).select(
        "*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__row"))
    counts = {r["__file"]: r["n"] for r in rows.groupBy("__file").agg(F.count(F.lit(1)).alias("n")).collect()}
    before, offsets = 0, []
    for name in sorted(counts, key=lambda n: tuple(map(int, re.search(_PART, n).groups()))):
        offsets.append((name, before))
        before += counts[name]
    # One row per file of the folder.
    starts = F.broadcast(spark.createDataFrame(offsets, "__of string, __before long"))
    return rows.join(starts, F.col("__file") == F.col("__of")).select(
        (F.col("__before") + F.col("__row")).alias("place"), *df.columns)
