"""Config files and logs of the jobs."""

from __future__ import annotations

import json
import logging
from pathlib import Path

from pyspark.sql import SparkSession

from pagemill.functions.pii import install_masking


def load(name: str, spark: SparkSession | None = None, path: str | None = None) -> dict:
    """The job's own config file, with the keys of the file at ``path`` (any file system Spark reads) instead."""
    own = json.loads(Path(__file__).with_name(f"{name}.json").read_text())
    if path is None:
        return own
    given = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if unknown := given.keys() - own.keys():
        raise ValueError(f"{name} has no settings {sorted(unknown)}")
    return own | given


def start(name: str) -> SparkSession:
    """For the command lines: a session, and logs with personal values masked."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    install_masking()
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
