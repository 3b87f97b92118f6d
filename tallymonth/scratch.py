"""Where intermediate tables go."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _shared_folder(spark: SparkSession) -> str:
    """The folder all machines see: the checkpoint folder. Where driver and executors are one
    process, a folder in the warehouse will do."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def new_directory(spark: SparkSession, purpose: str) -> str:
    """A new directory name in the folder the session shares.

    The session's ``spark.checkpoint.dir`` comes first, then the folder given to
    ``setCheckpointDir``; without either, a cluster is refused, as no other folder is
    known to be shared. Whoever owns that folder clears it: a result may be read long after
    the call that wrote its parts.
    """
    return f"{_shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
