"""Sessions, and the package's own code on executors."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession


def build_session(app: str = "seamwright", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings that results rely on: UTC, ANSI casts, adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true", "spark.sql.adaptive.enabled": "true"} | conf
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Sends this package to the Python workers, once per application.

    Where the session's Arrow batches have Spark's default size it makes them smaller, for the whole session: ten thousand
    documents at once would take hundreds of megabytes in each worker.  A session with other sizes keeps them."""
    sc = spark.sparkContext
    for key, default, ours in (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16777216b")):
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, ours)
    if getattr(sc, "_seamwright_shipped", False):
        return spark
    here = Path(__file__).resolve().parent
    target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="seamwright-code-")), "seamwright_code.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(here.rglob("*.py")):
            z.write(p, Path("seamwright") / p.relative_to(here))
    sc.addPyFile(target)
    sc._seamwright_shipped = True
    return spark
