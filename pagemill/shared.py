"""The folder that driver and executors share."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


@lru_cache(maxsize=1)
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="pagemill-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def shared_dir(spark: SparkSession) -> str:
    """A new path in the folder that the cluster shares (``spark.checkpoint.dir``).

    Where the session names none, a folder of this process serves a local master; on a cluster,
    whose executors would not see it, that is an error.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and the executors share")
    return f"{(base or _own_folder()).rstrip('/')}/pagemill-{uuid.uuid4().hex}"
