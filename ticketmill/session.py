"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_local_roots: dict[str, str] = {}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(master)
        .appName("ticketmill")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for a local master that names none."""
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="ticketmill-")
    return _local_roots[context.applicationId]


def stored(spark: SparkSession, path: str) -> bool:
    """Whether a parquet table is stored at ``path``."""
    try:
        spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return False
        raise
    return True


class Workspace:
    """Writes intermediate results as parquet tables in the shared folder and reads them back.

    A written table cuts the lineage of an iterative job, survives the loss of executors, and gives
    the optimizer a true size, so a join is broadcast only if the table really is small.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.base = f"{checkpoint_root(spark)}/ticketmill-{uuid.uuid4().hex}"
        self._written = 0

    def path(self, name: str) -> str:
        self._written += 1
        return f"{self.base}/{self._written:04d}-{name}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)  # the tables of a run stay, so their size counts
        return self.spark.read.schema(df.schema).parquet(path)
