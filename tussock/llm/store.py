"""Shared storage for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    A session on the driver's own machine (``local[...]``) may leave it unset and
    gets a folder of its own; on a cluster an unset folder is an error, since a
    machine-local one would be invisible to the other machines.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tussock-shared-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def whole_row(df: DataFrame) -> Column:
    """All columns of ``df`` as one struct column, so that working columns beside it can't clash with them."""
    return F.struct(*(F.col("`" + c.replace("`", "``") + "`") for c in df.columns))


#: Rows of a narrow stored table (ids, edges, hashes: some 20 bytes a row) up to which it may be broadcast.
BROADCAST_ROWS = 500_000


def sided(table: DataFrame, most: int | None = None) -> DataFrame:
    """``table``, a narrow stored one, marked for broadcast if it has at most ``BROADCAST_ROWS`` rows."""
    return F.broadcast(table) if table.count() <= (BROADCAST_ROWS if most is None else most) else table


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and return it reread.

    Cuts the lineage: later jobs read the files, and a lost executor costs a
    reread. The folder can be deleted once the run's results are written.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tussock-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` returned, once everything made from them is itself stored."""
    for t in tables:
        session = t.sparkSession
        path = session._jvm.org.apache.hadoop.fs.Path(t.stored_at)
        path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
