"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# What a job needs from the session; everything else is left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(app: str = "catalith", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


# Folders of local sessions that name none, by application; see ``shared_folder``.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under ``spark.checkpoint.dir``.

    The cluster names that folder and every executor can reach it.  A session that
    names none gets a local one only if it runs in this one process
    (``local[...]``, as in tests); anywhere else that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        context = spark.sparkContext
        if not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = _LOCAL.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="catalith-")
        _LOCAL[context.applicationId] = root
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """The rows as a written table in the shared folder.

    This cuts the lineage, so a lost executor recomputes nothing before it, and
    gives the optimizer the table's true size in place of a guess.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path)
    written.settled_at = path
    return written


def release(*tables: DataFrame) -> None:
    """Remove settled tables that nothing will read any more; other tables stay.

    Only for tables whose readers are all written themselves: a lost executor must not need them.
    """
    for table in tables:
        if path := getattr(table, "settled_at", None):
            spark = table.sparkSession
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(place, True)
