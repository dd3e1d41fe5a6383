"""Quarterly drops as a file stream into a table of current rows."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from casewright.operators.dedup import latest_quarter
from casewright.operators.standardize import clean_cells

#: Buckets that the rows of one quarter are spread over; a bucket should hold some hundred megabytes.
BUCKETS = 4


class CurrentTable:
    """Rows by quarter and hash of the report id; a delivery rewrites the buckets it touches and no others.

    Under ``target`` lie ``data/version=N/slot=S/`` with the rows that delivery N
    wrote for slot S, and ``pointers/N.json`` with, for every slot, the version that
    holds its rows now. A pointer file is written under another name and renamed
    when its delivery's rows are complete: until then readers use the one before,
    so they never see half a delivery, and a delivery repeated after a failure
    starts from the same pointer as the first time and replaces just its own files.
    Slots are quarters times ``buckets``; only their names reach the driver.
    """

    def __init__(self, spark: SparkSession, target: str, report: str = "primaryid", buckets: int = BUCKETS):
        self.spark, self.target, self.report, self.buckets = spark, target.rstrip("/"), report, buckets
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.target).getFileSystem(spark._jsc.hadoopConfiguration())

    def slot(self) -> Column:
        """Rows that may replace each other share a slot."""
        quarter = F.coalesce(F.regexp_replace(F.col("quarter").cast("string"), "[^A-Za-z0-9]", "_"), F.lit("none"))
        return F.concat(quarter, F.lit("-"), F.pmod(F.xxhash64(F.col(self.report)), F.lit(self.buckets)).cast("string"))

    def versions(self) -> list[int]:
        """Numbers of the complete deliveries."""
        folder = self._path(f"{self.target}/pointers")
        if not self._files.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._files.listStatus(folder)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def pointers(self, before: int | None = None) -> dict[str, int]:
        """Version of every slot after the last delivery, or after the last one before a number."""
        known = [v for v in self.versions() if before is None or v < before]
        if not known:
            return {}
        stream = self._files.open(self._path(f"{self.target}/pointers/{known[-1]}.json"))
        try:
            found = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if (found["report"], found["buckets"]) != (self.report, self.buckets):
            raise ValueError(f"{self.target} is dealt by {found['report']} to {found['buckets']} buckets a quarter")
        return found["slots"]

    def _switch(self, version: int, pointers: dict[str, int]) -> None:
        new, final = (self._path(f"{self.target}/pointers/{n}") for n in (f".{version}.new", f"{version}.json"))
        out = self._files.create(new, True)
        try:
            out.write(json.dumps({"report": self.report, "buckets": self.buckets, "slots": pointers}, sort_keys=True).encode())
        finally:
            out.close()
        self._files.delete(final, False)
        if not self._files.rename(new, final):
            raise OSError(f"could not switch {self.target} to version {version}")

    def _read(self, pointers: dict[str, int], slots: list[str], schema: StructType | None = None) -> DataFrame:
        paths = [f"{self.target}/data/version={pointers[s]}/slot={s}" for s in sorted(slots)]
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(*paths)

    def deliver(self, rows: DataFrame, version: int) -> None:
        """Add a delivery: what it has for a report and quarter replaces what the table had.

        Rows without a report id replace nothing and all stay.
        """
        before = self.pointers(version)
        placed = rows.withColumn("slot", self.slot())
        touched = [r["slot"] for r in placed.select("slot").distinct().collect()]  # quarters times buckets at most
        old = [s for s in touched if s in before]
        current = placed
        if old:
            keyed = F.struct(self.report, "quarter").alias("_key")  # structs join null quarters, too
            renewed = rows.filter(F.col(self.report).isNotNull()).select(keyed).distinct()
            held = self._read(before, old, rows.schema)
            kept = held.withColumn("_key", keyed).join(renewed, "_key", "left_anti").drop("_key")
            current = placed.unionByName(kept.withColumn("slot", self.slot()))
        current.hint("rebalance", "slot").write.mode("overwrite").partitionBy("slot").option("compression", "snappy").parquet(f"{self.target}/data/version={version}")
        self._switch(version, before | dict.fromkeys(touched, version))

    def rows(self) -> DataFrame:
        """All current rows, as they lie: nothing is compared or ranked."""
        pointers = self.pointers()
        if not pointers:
            raise AnalysisException(f"no delivery is complete under {self.target}")
        return self._read(pointers, list(pointers))

    def drop_unused(self, keep: int = 1) -> list[str]:
        """Delete the slot folders that none of the last ``keep`` pointer files names, and older pointer files; their paths."""
        versions = self.versions()
        used = set()
        for version in versions[-keep:]:
            used |= {f"version={v}/slot={s}" for s, v in self.pointers(version + 1).items()}
        gone = []
        data = self._path(f"{self.target}/data")
        for folder in self._files.listStatus(data) if self._files.exists(data) else []:
            name = folder.getPath().getName()
            if int(name.removeprefix("version=")) > versions[-1]:
                continue  # being written
            for slot in self._files.listStatus(folder.getPath()):
                place = f"{name}/{slot.getPath().getName()}"
                if slot.isDirectory() and place not in used:
                    self._files.delete(slot.getPath(), True)
                    gone.append(place)
        for version in versions[:-keep]:
            self._files.delete(self._path(f"{self.target}/pointers/{version}.json"), False)
        return gone


def ingest_stream(
    spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, fmt: str = "parquet",
    report: str = "primaryid", buckets: int = BUCKETS, keep: int | None = None,
) -> StreamingQuery:
    """Clean every newly arrived file and make it part of the current rows under ``target``.

    A target belongs to one checkpoint, whose batches number its deliveries. With
    ``keep``, what none of so many last deliveries needs is deleted after each;
    give readers that began earlier time to end.
    """
    arriving = spark.readStream.schema(schema).format(fmt).load(source)

    def load(batch: DataFrame, number: int) -> None:
        table = CurrentTable(batch.sparkSession, target, report, buckets)
        table.deliver(clean_cells(batch), number)
        if keep:
            table.drop_unused(keep)

    return (
        arriving.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ingested(spark: SparkSession, target: str, report: str = "primaryid", buckets: int = BUCKETS) -> DataFrame:
    """The current rows: what a later delivery has for a report and quarter stands for what earlier ones had."""
    return CurrentTable(spark, target, report, buckets).rows()


def current_reports(spark: SparkSession, target: str, key: str = "primaryid", buckets: int = BUCKETS) -> DataFrame:
    """Newest quarter per key over everything ingested so far."""
    return latest_quarter(ingested(spark, target, buckets=buckets), key)
