"""A point store in date folders: retention drops folders, look-backs open only the days they need.

    <path>/date=YYYY-MM-DD/tier=0/batch=N    points of batch N
    <path>/date=YYYY-MM-DD/tier=1/batch=N    all points of that day up to batch N, one row each

Every row keeps the batch that wrote it as its version, so readers see the same points before, while
and after folders are folded. One writer at a time; any number of readers.
"""

from __future__ import annotations

import datetime as dt
import re
from collections import defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer import schemas as S
from aerometer.operators import points as pt

FRESH, FOLDED = 0, 1
LAYOUT = S.POINT + ", version bigint, date date, tier int, batch bigint"
DAY_US = 86_400_000_000
EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)


def micros(at: dt.datetime) -> int:
    """Microseconds since the epoch; a datetime without a zone is taken as UTC."""
    at = at if at.tzinfo else at.replace(tzinfo=dt.timezone.utc)
    return (at - EPOCH) // dt.timedelta(microseconds=1)


def day_of(us: int) -> dt.date:
    return (EPOCH + dt.timedelta(microseconds=us)).date()


def instant(at: dt.datetime) -> Column:
    """A constant that reaches the scan as a filter."""
    return F.timestamp_micros(F.lit(micros(at)))


def day_column(time: str = "time") -> Column:
    """The UTC day of a time, whatever the session's zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(time) / DAY_US).cast("int"))


class PointStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    # ------------------------------------------------------------------ folders

    def _files(self):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), self.spark._jvm.org.apache.hadoop.fs.Path

    def folders(self) -> dict[dt.date | None, dict[int, list[int]]]:
        """Batches by day and tier, from folder names alone. Points without a time have no day."""
        files, place = self._files()
        held: dict = defaultdict(lambda: {FRESH: [], FOLDED: []})
        for found in files.globStatus(place(f"{self.path}/date=*/tier=*/batch=*")) or []:
            date, tier, batch = re.search(r"date=([^/]+)/tier=(\d)/batch=(\d+)$", found.getPath().toString()).groups()
            held[dt.date.fromisoformat(date) if date[0].isdigit() else None][int(tier)].append(int(batch))
        return dict(held)

    def _drop(self, folder: str) -> None:
        files, place = self._files()
        files.delete(place(f"{self.path}/{folder}"), True)

    def days(self) -> list[dt.date]:
        return sorted(d for d in self.folders() if d)

    # ------------------------------------------------------------------ writing

    def write(self, points: DataFrame, batch_id: int) -> None:
        """Store a batch; writing it again replaces it. Rows are sorted by measurement, field and time inside
        files, so filters on them skip row groups and pages."""
        self._put(points.select(*[F.col(n) for n, _ in S.fields_of(S.POINT)], F.lit(batch_id).cast("long").alias("version"),
                                day_column().alias("date"), F.lit(FRESH).alias("tier"), F.lit(batch_id).cast("long").alias("batch")))

    def _put(self, rows: DataFrame) -> None:
        (rows.hint("rebalance", "date").sortWithinPartitions("date", "tier", "batch", "measurement", "field", "time")
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("date", "tier", "batch").parquet(self.path))

    # ------------------------------------------------------------------ reading

    def stored(self, since: dt.datetime | None = None, until: dt.datetime | None = None,
               measurements: Sequence[str] = ()) -> DataFrame:
        """All stored versions of points with since <= time < until. The bounds are constants on the date folders
        and on the time column, so other days' files are not opened."""
        if not self.folders():
            return self.spark.createDataFrame([], LAYOUT)
        rows = self.spark.read.schema(LAYOUT).parquet(self.path)
        if since is not None:
            rows = rows.where((F.col("date") >= F.lit(day_of(micros(since)))) & (F.col("time") >= instant(since)))
        if until is not None:
            rows = rows.where((F.col("date") <= F.lit(day_of(micros(until)))) & (F.col("time") < instant(until)))
        return rows.where(F.col("measurement").isin(list(measurements))) if measurements else rows

    def read(self, since: dt.datetime | None = None, until: dt.datetime | None = None,
             measurements: Sequence[str] = ()) -> DataFrame:
        """One row per point, the newest version of each."""
        return pt.upsert_view(self.stored(since, until, measurements).drop("date", "tier", "batch"), "version")

    def newest(self) -> dt.datetime | None:
        """The greatest time stored; only the newest day is opened."""
        days = self.days()
        if not days:
            return None
        start = dt.datetime.combine(days[-1], dt.time(), dt.timezone.utc)
        us = self.stored(since=start).agg(F.max(F.unix_micros("time"))).first()[0]
        return EPOCH + dt.timedelta(microseconds=us)

    # ------------------------------------------------------------------ upkeep

    def expire(self, days: int) -> list[dt.date]:
        """Drop the folders of all days that end before `days` before the newest point; no file is read but the
        newest day's. Points of the day on which the limit falls stay until that day has passed."""
        newest = self.newest()
        if newest is None:
            return []
        limit = (newest - dt.timedelta(days=days)).date()
        gone = [d for d in self.days() if d < limit]
        for d in gone:
            self._drop(f"date={d.isoformat()}")
        return gone

    def compact(self, at_least: int = 2) -> list[dt.date]:
        """Fold the days that have at_least batches not yet folded into one folder each.

        First goes what an earlier round has folded: a reader that listed the old folders has had until now
        to finish. A round that fails half way is made good by the next.
        """
        due: dict[dt.date, int] = {}
        for day, tiers in self.folders().items():
            top = max(tiers[FOLDED], default=-1)
            for tier, batches in tiers.items():
                for batch in batches:
                    if batch < top or (batch == top and tier == FRESH):
                        self._drop(f"date={day.isoformat() if day else '__HIVE_DEFAULT_PARTITION__'}/tier={tier}/batch={batch}")
            fresh = [b for b in tiers[FRESH] if b > top]
            if day and len(fresh) >= at_least:
                due[day] = max(fresh)
        if due:
            last = F.create_map(*[F.lit(x) for pair in due.items() for x in pair])
            rows = self.stored().where(F.col("date").isin(list(due))).drop("date", "tier", "batch").withColumn("kept", F.col("version"))
            merged = pt.upsert_view(rows, "version").withColumnRenamed("kept", "version").withColumn("date", day_column())
            self._put(merged.withColumns({"tier": F.lit(FOLDED), "batch": F.element_at(last, F.col("date")).cast("long")})
                      .select(*[n for n, _ in S.fields_of(LAYOUT)]))
        return sorted(due)
