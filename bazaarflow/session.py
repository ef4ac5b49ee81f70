"""Session rules, shared-folder lookup and lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app_name: str = "bazaarflow", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the rules every operator relies on.

    Shuffle width and memory stay with the cluster's own configuration; pass them as
    ``conf`` (dots written as double underscores) where a run needs its own.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_rules(spark: SparkSession) -> SparkSession:
    """Set the run-time rules on a session somebody else built, and give its executors this package."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application, so that functions of it run in their Python workers.

    Nothing is sent where the package was itself given as an archive (``--py-files``).
    """
    context, home = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if getattr(context, "_bazaarflow_shipped", False) or not os.path.isdir(home):
        return
    # The driver serves the archive; executors fetch it from there.
    path = os.path.join(tempfile.mkdtemp(prefix="bazaarflow-"), "bazaarflow.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(home)))
    context.addPyFile(path)
    context._bazaarflow_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only for an unset local session."""
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder all executors can reach")
    path = tempfile.mkdtemp(prefix="bazaarflow-")
    context.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and cut its lineage.

    The result is read back from reliable storage, so it survives lost executors.
    """
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


