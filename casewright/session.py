"""Session settings and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Report ids and drug names can be very uneven: let the planner split a hot
    # join key even when that costs one more exchange above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Tables in buckets by report also join on report and drug line as they lie.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Tables that are sorted inside their buckets are read, and so joined, in that order.
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    # Staged tables carry results from one job to the next, so a job's shuffle
    # files can go when it ends and not only when the driver's heap is collected.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def build_session(app: str = "casewright", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings the operators count on to an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master, where
    all tasks run on this machine, may fall back to a fresh temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="casewright-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/casewright/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a shared Parquet table and read it back.

    Used where one result feeds several branches: the branches share one
    computation, and a lost executor costs a re-read instead of a re-run.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int | None = None) -> DataFrame:
    """Write ``df`` as a shared table dealt to buckets by its keys and read it back.

    Tables staged with the same keys and number of buckets (if not given, that of
    shuffle partitions) join on these keys without moving rows again. The
    catalog's entry goes at once; only the files are left.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    entry = f"casewright_{name}_{uuid.uuid4().hex[:12]}"
    dealt = df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys)
    dealt.option("path", fresh_path(spark, name)).saveAsTable(entry)
    staged = spark.table(entry)
    spark.sql(f"DROP TABLE {entry}")
    return staged


class Workspace:
    """Staged tables of one piece of work in a folder of their own, deleted together.

    Clear it only when what was read from its tables is written elsewhere: a
    task that is run again reads its inputs again.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.folder = spark, fresh_path(spark, name)
        self.entries: list[str] = []
        self.parts: list[Workspace] = []

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}-{uuid.uuid4().hex[:12]}"

    def at(self, name: str) -> Workspace:
        """A folder in this one, which can also be cleared alone."""
        part = Workspace(self.spark, name)
        part.folder = f"{self.folder}/{name}"
        self.parts.append(part)
        return part

    def inside(self, name: str) -> Workspace:
        return self.at(f"{name}-{uuid.uuid4().hex[:12]}")

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stage_sorted(self, df: DataFrame, name: str, key: str, order: list[str], buckets: int, by: str | None = None, dealt: bool = False) -> DataFrame:
        """A table in buckets by a key, in order inside each; ``by`` cuts it into folders, ``dealt`` says that tasks hold one bucket each.

        Tables of as many buckets join and merge on the key by one scan over
        both, without moving or sorting rows. The catalog's entry goes with the workspace.
        """
        entry, path = f"casewright_{name}_{uuid.uuid4().hex[:12]}", self.path(name)
        rows = (df if dealt else df.repartition(buckets, key)).write.format("parquet").bucketBy(buckets, key).sortBy(*order)
        (rows.partitionBy(by) if by else rows).option("path", path).saveAsTable(entry)
        self.entries.append(entry)
        return self.spark.table(entry)

    def forget(self) -> None:
        """Take the catalog's entries of this folder and those in it away."""
        for part in self.parts:
            part.forget()
        for entry in self.entries:
            self.spark.sql(f"DROP TABLE IF EXISTS {entry}")
        self.entries, self.parts = [], []

    def clear(self) -> None:
        self.forget()
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self.folder)
        folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)
