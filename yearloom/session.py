"""Session helpers: building a session for tests and local runs, lineage cuts and
size-checked broadcasts.

Nothing here reaches into Spark internals: a broadcast is granted only after an
explicit, bounded row count (``offset(n).isEmpty()``) or a bound known by
construction, and lineage is cut by writing a table into the checkpoint folder
the session names (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Row bound under which a dimension may be broadcast. A row of a mapping,
# template or unit table is well under 1 KiB, so this keeps a broadcast < ~50 MiB.
DEFAULT_BROADCAST_ROWS = 50_000


def build_session(master: str = "local[8]", app: str = "yearloom", shuffle_partitions: int = 8,
                  extra: dict | None = None, max_partition_bytes: str | None = None) -> SparkSession:
    """A session configured the way the library expects (AQE on, UTC, no UI).

    On a cluster pass the cluster master, a shuffle-partition count sized to the
    partial-aggregate output (groups, not rows: AQE coalesces what is left over)
    and, for very large scans, ``max_partition_bytes`` (e.g. ``"256m"``) so each
    scan task reads a few row groups.
    """
    b = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    if max_partition_bytes:
        b = b.config("spark.sql.files.maxPartitionBytes", max_partition_bytes)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint directory, reading it from the session.

    A cluster must name a shared folder in ``spark.checkpoint.dir``; only a local
    session (tests) gets a private temporary folder when none is configured.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        if not sc.master.startswith("local") and conf_dir.startswith("file:"):
            raise RuntimeError(f"spark.checkpoint.dir is {conf_dir}: a cluster needs a folder that all its machines share")
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3/...) on a cluster")
    path = tempfile.mkdtemp(prefix="yearloom-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, path, ignore_errors=True)  # a local session's own folder
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def materialize(df: DataFrame) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table under the session's
    checkpoint folder and read it back.

    Used for derived tables that are read more than once (distinct unit pairs,
    factor tables, the rolled-up long table), so the fact scan that produced
    them is not repeated and a lost executor does not force recomputation from
    the facts. One write job (``DataFrame.checkpoint`` would compute the plan
    twice unless cached), and the read-back is an ordinary Parquet scan with
    statistics for AQE.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def scratch_dir(spark: SparkSession) -> str:
    """Folder of this application's lineage-cut tables, under the checkpoint
    folder: ``<spark.checkpoint.dir>/yearloom-<application id>``. It can be
    removed as a whole once the application's outputs are written."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/yearloom-{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete this application's lineage-cut tables. Only once nothing will read
    frames built on them any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _sql_literal(v, dtype: str) -> str:
    if v is None:
        return f"CAST(NULL AS {dtype})"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, float):
        return f"CAST('{v!r}' AS {dtype})"
    return f"CAST('{v}' AS {dtype})"


def local_frame(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small literal table (a mapping, template or crosswalk given as rows) as
    a ``VALUES`` relation: it lives in the plan (LocalRelation), needs no Python
    worker to read, and its size is known. ``schema`` is ``"name type, ..."``
    with flat types."""
    parts, depth, cur = [], 0, ""
    for ch in schema:
        depth += ch in "(<"
        depth -= ch in ")>"
        if ch == "," and depth == 0:
            parts.append(cur)
            cur = ""
        else:
            cur += ch
    parts.append(cur)
    fields = [f.strip().split(None, 1) for f in parts]
    names = [n.strip("`") for n, _ in fields]
    types = [t.strip() for _, t in fields]
    if not rows:
        return spark.createDataFrame([], schema)
    body = ", ".join("(" + ", ".join(_sql_literal(v, t) for v, t in zip(r, types)) + ")" for r in rows)
    cols = ", ".join(f"c{i}" for i in range(len(names)))
    select = ", ".join(f"CAST(c{i} AS {t}) AS `{n}`" for i, (n, t) in enumerate(zip(names, types)))
    return spark.sql(f"SELECT {select} FROM VALUES {body} AS t({cols})")


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows. Skips ``max_rows`` rows and
    asks for one more: an incremental take over the partitions. On a scan or a
    written table no more than ``max_rows + 1`` rows are read; a frame with a
    shuffle in it (a ``distinct`` over facts) runs that first, so write it once
    (``materialize``) and check the table."""
    return df.offset(max_rows).isEmpty()


def broadcast_checked(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, known_rows: int | None = None) -> DataFrame:
    """Broadcast hint behind a size check.

    ``known_rows`` is an upper bound proven elsewhere (a driver-side list, a count
    already taken). Otherwise at most ``max_rows + 1`` rows are read to decide;
    beyond the bound the frame is returned unhinted, and the join falls back to a
    shuffle join that AQE may still convert or split for skew at run time.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    return F.broadcast(df) if row_count_at_most(df, max_rows) else df
