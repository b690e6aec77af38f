"""Folders for tables that a query writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir).

    A local session that names none gets a temporary folder; on a cluster the setting is asked for.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not shared:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        context.setCheckpointDir(Path(tempfile.mkdtemp(prefix="waymark-")).as_uri())
        shared = context.getCheckpointDir()
    return f"{shared}/waymark/{context.applicationId}/{name}-{uuid.uuid4().hex}"
