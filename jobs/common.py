"""What the jobs share: sessions of the command line, configuration files read through Spark, a logger."""

from __future__ import annotations

import json
import logging

from pyspark.sql import SparkSession

LOG = logging.getLogger("tessera.jobs")


def session(name: str) -> SparkSession:
    """The session of a command line; a function of a job takes its session from its caller."""
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.python.sql.dataFrameDebugging.enabled", "false").getOrCreate()


def settings(spark: SparkSession, path: str, known: dict) -> dict:
    """A JSON object of any file system over the known settings; an unknown key is an error."""
    given = json.loads("\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()))
    strange = sorted(set(given) - set(known))
    if strange:
        raise ValueError(f"{path}: unknown settings: {', '.join(strange)}")
    return known | given
