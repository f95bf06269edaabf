"""Session helpers: shared folder, lineage cuts and size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_FOLDERS: dict[tuple[str, str], str] = {}
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
ROWS_PER_TASK = 100_000


def checkpoint_folder(spark: SparkSession) -> str:
    """Folder for checkpoints: the session's ``spark.checkpoint.dir``.

    Only a local-master session without that setting (tests) gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = getattr(checkpoint_folder, "_own", None) or tempfile.mkdtemp(prefix="screenwell-")
        checkpoint_folder._own = folder
    return folder


def own_folder(spark: SparkSession) -> str:
    """This application's folder in the shared location; deleted when the driver's program ends,
    if its session still runs then."""
    context = spark.sparkContext
    key = checkpoint_folder(spark), context.applicationId
    if key not in _FOLDERS:
        _FOLDERS[key] = f"{key[0].rstrip('/')}/screenwell-{key[1]}-{uuid.uuid4().hex[:8]}"
        atexit.register(_delete, context, _FOLDERS[key])
    return _FOLDERS[key]


def _delete(context, folder: str) -> None:
    if context._jsc is not None:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The result survives the loss of executors, is read column-wise, and tells the optimizer its
    size, so that small results are broadcast and large ones are not. It lies in ``own_folder``.
    """
    path = f"{own_folder(df.sparkSession)}/cut-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and about ``max_bytes`` bytes.

    Rows and bytes are summed in the tasks, so that each passes on one row, whatever its size.
    """
    size = F.lit(0)
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind.startswith(("array", "map", "struct")):
            column = F.to_json(F.struct(column))
        wide = kind in ("string", "binary") or kind.startswith(("array", "map", "struct"))
        size = size + (F.coalesce(F.octet_length(column), F.lit(0)) if wide else F.lit(8))
    rows, held = df.agg(F.count(F.lit(1)), F.sum(size.cast("long"))).first()
    return rows <= max_rows and (held or 0) <= max_bytes


def broadcast_checked(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only when rows and bytes have been checked; otherwise a shuffle join."""
    return F.broadcast(df) if fits(df, max_rows) else df


def in_tasks(df: DataFrame, *keys: str, least: int = 1, rows: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` over at least ``least`` partitions and one per ``rows`` rows; as it is, without a
    shuffle, when it has as many.

    Files of repetitive columns shrink so far that a split of them is millions of rows. The count of
    a table as read comes from its files' footers.
    """
    wanted = max(least, -(-df.count() // rows))
    return df.repartition(wanted, *keys) if df.rdd.getNumPartitions() < wanted else df


def spread(df: DataFrame, key: str, rows: int = ROWS_PER_TASK) -> DataFrame:
    """Hash-spread a table that was read as fewer partitions than there are cores, or than one per
    ``rows`` rows. Meant for heavy per-row work; a table in enough partitions is returned as it is."""
    return in_tasks(df, key, least=df.sparkSession.sparkContext.defaultParallelism, rows=rows)
