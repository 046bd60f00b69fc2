"""Session helpers shared by every operator: the shared folder, lineage cuts and table access."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_dir: str | None = None
_made: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    A cluster names it in ``spark.checkpoint.dir``. Only a single-JVM local session, as in tests, may do without
    and gets a temporary folder; on any other master a missing setting is an error.
    """
    global _local_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if _local_dir is None or not os.path.isdir(_local_dir):
        _local_dir = tempfile.mkdtemp(prefix="terrace-")
    return _local_dir


def cut(df: DataFrame, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    The result has no lineage, survives lost executors and gives later plans true sizes.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/cut-{uuid.uuid4().hex}"
    _made.append(path)
    schema = df.schema
    writer = df.write.option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    back = spark.read.schema(schema).parquet(path)
    return back.select([F.col(_quoted(f.name)) for f in schema.fields])


def cut_bucketed(df: DataFrame, buckets: int, key: str, partition_by: str | None = None, placed: bool = False) -> DataFrame:
    """``cut`` into ``buckets`` files by a hash of ``key``; joins and groupings of such tables on the key need no shuffle.

    ``placed``: the rows come from joins of tables with the same buckets and lie right already. The table's name stays in
    the session's catalogue as long as the result may be used.
    """
    spark = df.sparkSession
    name = f"cut_{uuid.uuid4().hex}"
    writer = (df if placed else df.repartition(buckets, key)).write.bucketBy(buckets, key).sortBy(key)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    _made.append(f"{shared_dir(spark)}/cut-{name[4:]}")
    writer.options(path=_made[-1], compression="zstd").saveAsTable(name)
    return spark.table(name).select(df.columns)


def cut_counting(df: DataFrame, **measures: Column) -> tuple[DataFrame, dict]:
    """``cut`` with aggregates of the rows taken while they are written, so that no further job reads them."""
    seen = Observation()
    out = cut(df.observe(seen, *[m.alias(name) for name, m in measures.items()]))
    return out, seen.get


def drop_cut(df: DataFrame) -> None:
    """Remove the files of a table made by ``cut`` that nothing reads any more."""
    spark = df.sparkSession
    root = shared_dir(spark)
    for name in {f.rsplit("/cut-", 1)[1].split("/", 1)[0] for f in df.inputFiles() if "/cut-" in f}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/cut-{name}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear_cuts(spark: SparkSession) -> None:
    """Remove every table cut so far by this program. For callers that have written their results: frames made before can
    not be read afterwards."""
    while _made:
        path = spark._jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def spread(df: DataFrame) -> DataFrame:
    """The same rows over all cores, where the input has fewer splits than there are cores.

    For scans whose rows take much computing, such as whole texts in one small file; larger inputs stay as they lie.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= cores:
        return df
    return df.repartition(2 * cores)


LOOKUP_ROWS = 200_000
SALTS = 32


def lookup_join(big: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Inner join with a table that is small by its nature, such as one row per group or per target.

    It is broadcast only if it is counted to have at most ``LOOKUP_ROWS`` rows. Beyond that both sides are shuffled, the
    small one repeated for each of ``SALTS`` salts, so that a key with a third of all rows is spread over many tasks.
    """
    if small.limit(LOOKUP_ROWS + 1).count() <= LOOKUP_ROWS:
        return big.join(F.broadcast(small), on)
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return big.withColumn("_salt", F.pmod(F.xxhash64(*big.columns), F.lit(SALTS)).cast("int")).join(salted, [*on, "_salt"]).drop("_salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def full_match(value: Column, pattern: str) -> Column:
    """True where the whole of ``value`` fits ``pattern``; ``\\z`` because Java's ``$`` accepts a final line end."""
    return value.rlike(f"^(?:{pattern})\\z")
