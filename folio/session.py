"""Session defaults, the shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def get_session(app_name: str = "folio", master: str | None = None, **conf) -> SparkSession:
    """Session with the settings the operators are tuned for; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting (a test) gets a folder of its own; executors of a
    cluster could not share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="folio-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/folio/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, schema: T.StructType | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table.

    Cuts the lineage at a point that outlives executors, fixes values that a
    recomputation could change (range partition numbers), and spares a second
    pass over the input when several aggregates read the same rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(schema or df.schema).parquet(path)


def clear_scratch(spark: SparkSession) -> None:
    """Remove the staged tables of this application, once nothing reads them any more."""
    root = f"{scratch_root(spark)}/folio/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
