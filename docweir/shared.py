"""The folder that driver and executors share, and what is stored there on the way."""

from __future__ import annotations

import uuid
from tempfile import mkdtemp

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session; one is made only where none is configured and all run on one machine."""
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    where = spark.conf.get("spark.checkpoint.dir", None) or (known.get() if known.isDefined() else None)
    if where is None:
        if not context.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        where = f"file://{mkdtemp(prefix='docweir-')}"
    if not known.isDefined():
        context.setCheckpointDir(where)
    return where.rstrip("/")


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, where: str) -> str:
    """A folder's full URI, by which pyarrow finds what Spark means by a path."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    full = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/")
    return f"file://{full.removeprefix('file:')}" if full.startswith("file:/") and not full.startswith("file://") else full


def stored(df: DataFrame) -> DataFrame:
    """df, written to the shared folder once and read from there: its lineage ends here."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
