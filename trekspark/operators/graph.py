"""Connected components by label propagation with pointer jumping."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below spark.checkpoint.dir; below a temporary folder only where that is unset, in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="trekspark-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """df written into a scratch folder and read back."""
    path = scratch_folder(df.sparkSession, "rounds")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folders that this process has written.
_made: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Deletes the folders that this process has written so far and says how many; results that still read them must be done."""
    done = len(_made)
    for path in _made[:done]:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    del _made[:done]
    return done


def components(edges: DataFrame, vertices: DataFrame) -> DataFrame:
    """v, label (the smallest vertex that v reaches) for all vertices (v); edges are pairs (a, b) in any direction."""
    both = edges.select(F.col("a").alias("v"), F.col("b").alias("u")).union(edges.select(F.col("b").alias("v"), F.col("a").alias("u"))).filter("v <> u")
    both = written(both)
    labels = written(vertices.select("v").withColumn("label", F.col("v")))
    while True:
        around = both.join(labels.toDF("u", "near"), "u").groupBy("v").agg(F.min("near").alias("near"))
        lower = labels.join(around, "v", "left").select("v", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        moved = written(lower.join(lower.select(F.col("v").alias("label"), F.col("label").alias("next")), "label").select("v", "old", F.least("label", "next").alias("label")))
        labels = moved.select("v", "label")
        if moved.filter("label <> old").isEmpty():
            return labels
