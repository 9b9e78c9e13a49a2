"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def session(app: str = "hotrank", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    ``conf`` overrides them; dots in setting names are written as ``__``. The number of
    shuffle partitions is left to the cluster: AQE merges small ones and splits skewed joins.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        **{name.replace("__", "."): value for name, value in conf.items()},
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


@contextmanager
def adaptive(spark: SparkSession):
    """Adaptive execution for batch work inside a stream, where Spark turns it off.

    Without it every small shuffle of a micro-batch's follow-up runs as many tasks as the
    stream has state partitions. The stream's own plans are made outside and stay without.
    """
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only when it is unset, as in local tests, a temporary one is made and remembered.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder all executors share")
        folder = tempfile.mkdtemp(prefix="hotrank-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read from there ever after."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own below the shared one."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4()}"


def as_table(df: DataFrame, folder: str, *partition_by: str) -> DataFrame:
    """``df`` written to ``folder`` as Parquet, and read back from there."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def send_by_value() -> None:
    """Lets tasks that run Python take this package's functions along.

    Python workers start without the package, and so does the process that prepares stateful
    operators, which does not see files added to the session either.
    """
    import hotrank

    cloudpickle.register_pickle_by_value(hotrank)
