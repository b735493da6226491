"""Join helpers: stored dimensions, NULL-safe key joins and lineage cuts.

No join carries a broadcast hint.  Dimensions that are derived by joins are stored
first, so the optimizer knows their size from the files and broadcasts them only
below ``spark.sql.autoBroadcastJoinThreshold``; larger ones are shuffled, and
adaptive execution splits what is skewed.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (the grouping semantics of a
    window partition), keeping the left key columns and the right non-key columns."""
    tmp = {k: f"__r_{k}" for k in keys}
    r = right.select(*[F.col(k).alias(tmp[k]) for k in keys],
                     *[c for c in right.columns if c not in tmp])
    cond = [left[k].eqNullSafe(r[tmp[k]]) for k in keys]
    return left.join(r, cond, how).drop(*tmp.values())


def materialize(df: DataFrame) -> DataFrame:
    """Cut the lineage of a stage read by several later stages: an eager, reliable
    checkpoint into the shared ``spark.checkpoint.dir`` (never a local
    checkpoint, never a machine-local folder on a cluster).  One job computes
    and writes the stage; the result keeps the stage's output partitioning, so
    later aggregates on the same keys need no new shuffle, and a lost executor
    only costs a re-read of the checkpoint files."""
    from pnlflow.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def _scratch(spark: SparkSession) -> str:
    from pnlflow.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark)}/stored-{spark.sparkContext.applicationId}"


def stored(df: DataFrame) -> DataFrame:
    """Write a table that several stages read (a derived dimension, totals by period, allocation
    cells) as Parquet to the shared ``spark.checkpoint.dir`` and read it back: later readers
    prune columns, and its size is known when joins are planned."""
    path = f"{_scratch(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_by_key(df: DataFrame, keys: Sequence[str], **added: Column) -> DataFrame:
    """Store ``df`` bucketed by ``keys``, one file a bucket, as a table below the shared folder: later
    groupings and windows over the keys, or over more columns, run on the files as they lie.
    ``added``: columns computed in that partitioning, for example by a window over the keys."""
    spark = df.sparkSession
    n, name = int(spark.conf.get("spark.sql.shuffle.partitions")), f"{_table_prefix(spark)}{uuid.uuid4().hex}"
    dealt = df.repartition(n, *keys)
    (dealt.withColumns(added) if added else dealt).write.format("parquet").bucketBy(n, *keys).option("path", f"{_scratch(spark)}/{name}").saveAsTable(name)
    return spark.read.table(name)


#: Bytes of input files to a task of an exchange that is sized by its input: columns in files are a
#: fiftieth of what the aggregates hold of them.  Above ``MOST_TASKS`` the session's own setting counts.
TASK_BYTES, MOST_TASKS = 4 << 20, 20_000


def tasks_for(*inputs: DataFrame) -> int:
    """How many tasks an exchange of the rows of ``inputs`` takes, by the bytes of the files they are read
    from (each file once): a task's share, hence its memory, stays the same however large the inputs are.  At least
    one task for each core; what is not read from files has no size."""
    spark = inputs[0].sparkSession
    files, folders = {f for df in inputs for f in df.inputFiles()}, {}
    for f in files:
        folders.setdefault(f.rsplit("/", 1)[0], []).append(unquote(f.rsplit("/", 1)[1]))
    total = 0
    for folder, names in folders.items():
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
        sizes = {s.getPath().getName(): s.getLen() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(path)}
        total += sum(sizes.get(n, 0) for n in names)
    most = max(MOST_TASKS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return min(most, max(spark.sparkContext.defaultParallelism, -(-total // TASK_BYTES)))


def _table_prefix(spark: SparkSession) -> str:
    return "stored_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId.lower()) + "_"


def clear_stored(spark: SparkSession) -> None:
    """Remove all stored tables of this application; call it once its results are written."""
    for t in spark.catalog.listTables(pattern=f"{_table_prefix(spark)}*"):
        spark.sql(f"DROP TABLE IF EXISTS {t.name}")
    path = spark._jvm.org.apache.hadoop.fs.Path(_scratch(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
