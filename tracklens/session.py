"""Session settings the operators rely on."""

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# The skew settings matter for the few joins on raw rows: a hot issue's
# partition is split at run time, also where that costs a further exchange.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and written intermediates.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session may
    fall back to a temporary folder, since executors elsewhere cannot see it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="tracklens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def written(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet in the shared checkpoint folder and go on from there.

    ``by``: a column whose values get folders of their own, read alone where it is filtered.

    Unlike ``checkpoint()``, which computes a frame twice, this runs it once, packs it
    and lets later reads take single columns. A lost executor loses nothing of it.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/{name}-{uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*[by] if by else []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there."""
    return written(df, "cut")


def spread(scan: DataFrame) -> DataFrame:
    """Deal a scan's rows to all cores when it comes in fewer splits than cores.

    For costly work per row on few or unsplittable files. Large tables have more
    splits than cores and are left as they are. Only for plain scans, whose
    number of splits is known without running anything.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
