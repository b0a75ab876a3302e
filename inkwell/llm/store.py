"""Tables that cut lineage, written to the folder that all machines share."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a temporary one only in single-machine sessions that name none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), f"inkwell-{spark.sparkContext.applicationId}")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet to the shared folder and reads it back: a lost executor then costs no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/inkwell/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parallelism(spark: SparkSession) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), spark.sparkContext.defaultParallelism)


def spread_by_doc(docs: DataFrame) -> DataFrame:
    """doc_id and text only, whatever further columns a table has; names match in any case."""
    return docs.select(named(docs, "doc_id", "long"), named(docs, "text", "string"))


def column_of(docs: DataFrame, name: str) -> str:
    """A column's name as docs has it, which may differ in case."""
    return next((c for c in docs.columns if c == name), None) or next(c for c in docs.columns if c.lower() == name)


def named(docs: DataFrame, name: str, kind: str) -> Column:
    """A column of a kind by its name in any case. It is taken by the name that docs has: an alias that differs from what was
    asked for only in the table's case is optimised away, and workers would see the table's name."""
    return F.col(f"`{column_of(docs, name)}`").cast(kind).alias(name)


def fresh(docs: DataFrame, name: str) -> str:
    """name, with as many marks behind it as it takes for docs to have no such column."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
