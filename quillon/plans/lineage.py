"""Cut lineage with tables in the shared checkpoint folder, and join with a size-checked broadcast."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when its measured size stays under this many bytes.
BROADCAST_BYTES = 16 << 20
#: What a row of some numbers takes in the table of a broadcast join, as measured.
ROW_BYTES = 160


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    The session's ``spark.checkpoint.dir`` wins. Only a local master may fall back to a temporary folder, because there
    the driver and the executors are one process.
    """
    sc = spark.sparkContext
    here = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if here:
        return here
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillon-"))
    return sc.getCheckpointDir()


_WRITTEN: list[str] = []


def written() -> list[str]:
    """The tables that ``cut`` has written and ``clear`` has not deleted, in order."""
    return list(_WRITTEN)


def clear(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete the tables that ``cut`` has written, or those of ``paths``; results that still read them must have been written
    first."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for written_path in written() if paths is None else paths:
        _WRITTEN.remove(written_path)
        path = jvm.org.apache.hadoop.fs.Path(written_path)
        path.getFileSystem(conf).delete(path, True)


def cut(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back, so that a lost executor costs no earlier stage.

    The table stays until ``clear``, as lazy results may read it at any time.
    """
    path = f"{shared_dir(df.sparkSession)}/quillon-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _WRITTEN.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def put(spark: SparkSession, name: str, data: bytes) -> str:
    """Write a file in the shared folder; returns its path."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(conf).create(path, True)
    out.write(bytearray(data))
    out.close()
    return path.toString()


def measured_bytes(df: DataFrame, *payload: str) -> int:
    """An estimate of what ``df`` takes when broadcast: ROW_BYTES a row, and the given columns as text."""
    cost = F.lit(ROW_BYTES)
    for c in payload:
        cost = cost + F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0))
    return df.agg(F.sum(cost)).first()[0] or 0


def sized_join(big: DataFrame, small: DataFrame, on, how: str, *payload: str, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Join, broadcasting ``small`` only after measuring it; beyond ``limit`` the join shuffles both sides.

    ``small`` is measured by an action, so cut it first if it is expensive to compute.
    """
    return big.join(F.broadcast(small) if measured_bytes(small, *payload) <= limit else small, on, how)
