"""Sources and sinks: Parquet tables, payload logs, gold labels, versioned snapshots."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.text import split_multi


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: A provider's monthly traffic payload (names as the provider spells them).
PAYLOAD = """SiteName string, SnapshotDate string, EstimatedMonthlyVisits map<string,bigint>,
    Engagments struct<Year:string,Month:string,Visits:string,BounceRate:string,PagePerVisit:string,TimeOnSite:string>,
    GlobalRank struct<Rank:bigint>, CountryRank struct<CountryCode:string,Rank:bigint>,
    TopCountryShares array<struct<CountryCode:string,Value:double>>, TopKeywords array<struct<Name:string,Volume:bigint,EstimatedValue:double,Cpc:double>>"""


def payload_log(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of (domain, payload text); a payload that isn't JSON gives null fields, not an error."""
    return spark.read.schema("id bigint, domain string, payload string").json(path).withColumn("body", F.from_json("payload", PAYLOAD))


def monthly_rows(log: DataFrame) -> DataFrame:
    """One row per month of each payload's visits map; engagement belongs to the newest month only."""
    newest = F.array_max(F.map_keys("body.EstimatedMonthlyVisits"))
    rows = log.select("id", "domain", newest.alias("_new"), "body", F.explode("body.EstimatedMonthlyVisits").alias("_month", "visits"))
    only = lambda c: F.when(F.col("_month") == F.col("_new"), c)
    return rows.select(
        "id", "domain", F.trunc(F.col("_month").try_cast("date"), "MM").alias("month"), "visits", only(F.nullif(F.col("body.GlobalRank.Rank"), F.lit(0))).alias("global_rank"),
        only(F.col("body.Engagments.BounceRate").try_cast("double")).alias("bounce_rate"), only(F.col("body.TopCountryShares")).alias("countries"),
    )


def gold_csv(spark: SparkSession, path: str) -> DataFrame:
    """Gold labels: rows without a numeric id or a label are left out; cells with several values are split."""
    raw = spark.read.csv(path, header=True, encoding="UTF-8")
    rows = raw.withColumn("tool_id", F.col("tool_id").try_cast("bigint")).where("tool_id IS NOT NULL AND trim(primary_leaf_slug) <> ''")
    return rows.withColumns({c: split_multi(c) for c in ("primary_acceptable_alternates", "capabilities_ok", "primary_must_not") if c in raw.columns})


class VersionedStore:
    """Immutable versions of a table below one folder, and a manifest that names the active one.

    A build writes its version first; activation compares the active version it started from and
    publishes the next turn by one rename that must not meet an existing file, so readers see a
    whole version or the one before, and a writer that dies on the way leaves nothing that blocks
    the next (M13, M15).  The rename is atomic on HDFS and other file systems with a name node; on a local disk it
    is a check and a rename; object stores without an atomic rename aren't supported.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._fs_classes = spark._jvm.org.apache.hadoop.fs
        self._path = self._fs_classes.Path
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(self.root).getFileSystem(self._conf)
        self._fs.mkdirs(self._path(self.root))

    def write(self, df: DataFrame) -> str:
        version = uuid.uuid4().hex
        df.write.parquet(f"{self.root}/v-{version}")
        return version

    def _newest(self) -> tuple[int, str | None]:
        turns = [s.getPath() for s in self._fs.listStatus(self._path(self.root)) if s.getPath().getName().startswith("turn-")]
        if not turns:
            return 0, None
        last = max(turns, key=lambda p: p.getName())
        stream = self._fs.open(last)
        try:
            return int(last.getName().split("-")[1]), bytes(stream.readNBytes(32)).decode()
        finally:
            stream.close()

    def active(self) -> str | None:
        return self._newest()[1]

    def activate(self, version: str, expected: str | None) -> bool:
        """Whether the swap took place: not if another version became active since."""
        turn, now = self._newest()
        if now != expected:
            return False
        aside = self._path(f"{self.root}/.next-{uuid.uuid4().hex}")
        stream = self._fs.create(aside, False)
        stream.write(bytearray(version.encode()))
        stream.close()
        sc = self.spark.sparkContext
        rename = getattr(self._fs_classes, "Options$Rename")
        options = sc._gateway.new_array(rename, 1)
        options[0] = rename.NONE
        context = self._fs_classes.FileContext.getFileContext(aside.getFileSystem(self._conf).getUri(), self._conf)
        try:
            context.rename(self._fs.makeQualified(aside), self._fs.makeQualified(self._path(f"{self.root}/turn-{turn + 1:09d}")), options)
        except Exception as e:
            self._fs.delete(aside, False)
            if "exist" in str(e).lower():
                return False
            raise
        return True

    def read(self) -> DataFrame | None:
        version = self.active()
        return None if version is None else self.spark.read.parquet(f"{self.root}/v-{version}")


def report(metrics: DataFrame) -> str:
    """A small report as JSON text; metrics is one row."""
    return json.dumps(metrics.first().asDict(recursive=True), sort_keys=True, default=str)
