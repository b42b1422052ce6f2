"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


#: Work folder of a local session that names none. Its subfolders have unique names and may be
#: removed when no session runs.
LOCAL_WORK = "/tmp/checkpoints"


def local_session(cores: int | str = 8, app: str = "tallymark", **conf: str) -> SparkSession:
    """A local session for tests and benches. A cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # small data: keep all cores busy; a cluster keeps the 64 MB default or more
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4MB")
        .config("spark.sql.shuffle.partitions", str(cores if cores != "*" else 8))
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Every date in the model is a UTC date, so the session must cut days in UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def work_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: `spark.checkpoint.dir` of the session.

    A local session may go without it and then uses LOCAL_WORK. A cluster may not: a folder
    on one machine would be lost with it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = jsc.get() if jsc.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = LOCAL_WORK
        spark.sparkContext.setCheckpointDir(root)
    elif not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A path under the work folder that nothing else uses."""
    return f"{work_root(spark)}/tallymark/{name}-{uuid.uuid4().hex}"
