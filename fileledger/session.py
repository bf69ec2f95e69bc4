"""A local session with the settings that the library expects."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", name: str = "fileledger", **conf: str) -> SparkSession:
    """A ``local[cores]`` session in UTC; ``conf`` holds further settings, with ``__`` for dots."""
    scratch = os.environ.get("FILELEDGER_SCRATCH") or tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g",
        "spark.local.dir": f"{scratch}/local",
        "spark.sql.warehouse.dir": f"{scratch}/warehouse",
        "spark.checkpoint.dir": f"file://{scratch}/shared",
        "spark.driver.extraJavaOptions": f"-Dderby.system.home={scratch}",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
