"""Where a job may write what it has to read again: the shared folder of the session."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTING = "spark.checkpoint.dir"
_WAREHOUSE = "spark.sql.warehouse.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else one in the session's warehouse.

    On a cluster that has neither set, the warehouse would be a folder of the driver's machine, which
    no other one sees: that is an error. Both must be on storage that all machines share.
    """
    folder = spark.conf.get(_SETTING, None)
    if folder is None:
        warehouse = spark.conf.get(_WAREHOUSE)
        local = warehouse.startswith(("file:", "/"))
        master = spark.sparkContext.master
        if local and not (master == "local" or master.startswith("local[")):
            raise ValueError(f"{_SETTING} must name a folder that all machines share")
        folder = f"{warehouse}/starloom-work"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that nothing else uses (it is not created)."""
    return f"{shared_folder(spark)}/{purpose}-{uuid.uuid4().hex}"
