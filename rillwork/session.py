"""Session helpers: reading tables and cutting lineage safely on a cluster."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a dataset folder; file or folder of files."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


_CLEAN = "spark.cleaner.referenceTracking.cleanCheckpoints"


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the session names in spark.checkpoint.dir.

    Only a local session without that setting gets a temporary folder: on a
    cluster a machine-local folder would be lost with its machine.
    """
    sc = spark.sparkContext
    # what no plan refers to any more is deleted, unless the session decides otherwise; read by Spark when it writes a checkpoint
    if not sc._jsc.sc().conf().contains(_CLEAN):
        sc._jsc.sc().conf().set(_CLEAN, "true")
    if sc.getCheckpointDir():
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        sc.setCheckpointDir(named)
    elif sc.master.startswith("local[") or sc.master == "local":
        sc.setCheckpointDir(os.path.join(tempfile.gettempdir(), "rillwork-checkpoints"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def settled(df: DataFrame) -> DataFrame:
    """df, written once to the shared checkpoint folder.

    Later jobs read the files, so partitions, their order and their content are
    the same in each of them, and a lost executor costs no recomputation. The
    files are deleted once nothing refers to them. Uses two calls that Spark keeps
    to itself (internalCreateDataFrame here, the context's own settings in
    ensure_checkpoint_dir): they are there in Spark 3.5 to 4.1, and a test holds them.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    kept = df.checkpoint(eager=True)._jdf
    # without the estimated size of what it was made from: over the rounds of an
    # iteration these estimates multiply to numbers of millions of digits
    plain = spark._jsparkSession.internalCreateDataFrame(kept.queryExecution().toRdd(), kept.schema(), False)
    return DataFrame(plain, spark)


def if_small(df: DataFrame, rows: int = 200_000) -> DataFrame:
    """df, settled and marked for broadcast if it has at most `rows` rows; a larger one is joined as Spark plans it."""
    kept = settled(df)
    return F.broadcast(kept) if kept.limit(rows + 1).count() <= rows else kept


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def spread_out(df: DataFrame, by: str | None = None) -> DataFrame:
    """df over at least as many tasks as there are cores, for work that is heavy per row.

    A large scan has more tasks than that and stays as it is; only a small one,
    which a few tasks would hold, is shuffled; with `by` by the hash of that column
    and in its order, so that every run has the same rows in the same tasks.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    few = lambda: df.repartition(cores, by).sortWithinPartitions(by) if by else df.repartition(cores)
    return few() if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
