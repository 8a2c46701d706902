"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidewatch", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps and adaptive execution; ``conf`` overrides the rest."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession, prefix: str) -> str:
    """A fresh folder for checkpoints and written tables.

    The cluster names a shared folder in ``spark.checkpoint.dir``; a machine-local
    folder is used only where that setting is absent, as in tests.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        import uuid

        return f"{shared.rstrip('/')}/{prefix}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix=f"{prefix}-")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in a work folder, read back: the plan that made them ends here."""
    path = f"{work_dir(df.sparkSession, name)}/rows"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
