"""Session settings and the shared folder used for checkpoints and staged data."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # longer methods are not compiled by the JVM's JIT; expressions one by one are faster than those
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "grainmill", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the library's settings; `settings` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by `spark.checkpoint.dir`.

    Where it is unset: a temporary folder under a local master, else one below the warehouse, which must then
    not be on the driver's own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = own_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def own_folder(spark: SparkSession) -> str:
    """Where intermediate tables go if no shared folder is named."""
    if spark.sparkContext.master.split("[")[0] == "local":
        return tempfile.mkdtemp(prefix="grainmill-")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/grainmill-scratch")
    whole = path.getFileSystem(conf).makeQualified(path).toString()
    if whole.startswith("file:"):
        raise ValueError(f"{whole} is on one machine: name a shared folder in spark.checkpoint.dir")
    return whole


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/grainmill/{name}-{uuid.uuid4().hex}"
