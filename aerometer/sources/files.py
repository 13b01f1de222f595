"""File sources: newest log, the raw archive and the meter CSV tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerometer import schemas as S
from aerometer.functions import scalars as X


def list_files(spark: SparkSession, location: str | list[str], pattern: str | None = None) -> DataFrame:
    """(path, modificationTime, length) of the files below `location`; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(location).select("path", "modificationTime", "length")


def newest_file(files: DataFrame) -> DataFrame:
    """One row: the path changed last, ties by path."""
    return files.agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def newest_log(spark: SparkSession, candidates: str | list[str], pattern: str = "*.log") -> str:
    path = newest_file(list_files(spark, candidates, pattern)).first()["path"]
    if path is None:
        raise FileNotFoundError(f"no {pattern} file below {candidates}")
    return path


def max_cycle_from_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """One row: the highest cycle number found in file names, 0 when none carries one."""
    number = F.regexp_extract(F.col(path), r"cycle-(\d+)\.", 1).try_cast("int")
    return files.agg(F.coalesce(F.max(number), F.lit(0)).alias("max_cycle"))


def cycles_of(files: DataFrame, path: str = "path") -> DataFrame:
    """files with the cycle number in their names; those without one are left out."""
    number = F.regexp_extract(F.col(path), r"cycle-(\d+)\.", 1).try_cast("int")
    return files.withColumn("cycle", number).where("cycle IS NOT NULL")


def resume_point(spark: SparkSession, stores: dict[str, str], pattern: str | None = None) -> dict[str, int]:
    """The highest cycle each store (name to folder) holds by its file names, 0 for one that is empty or not there.
    Folders are listed, no file is read."""
    def highest(location: str) -> int:
        try:
            return max_cycle_from_paths(list_files(spark, location, pattern)).first()["max_cycle"]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return 0

    return {name: highest(location) for name, location in stores.items()}


def files_after(spark: SparkSession, location: str, cycle: int, pattern: str | None = None) -> list[str]:
    """Paths below `location` whose cycle is higher, in its order: what a run that resumes has still to read."""
    listed = cycles_of(list_files(spark, location, pattern))
    return [r.path for r in listed.where(F.col("cycle") > cycle).orderBy("cycle", "path").select("path").collect()]


def read_archive(spark: SparkSession, base: str, schema: str = S.FLIGHT) -> DataFrame:
    """Archive written with `date=`/`hour=` folders; filters on both prune folders."""
    return spark.read.schema(schema + ", date date, hour int").json(base)


def read_plain_archive(spark: SparkSession, base: str, date: str = "*", hour: str = "*",
                       schema: str = S.FLIGHT) -> DataFrame:
    """Archive laid out as base/YYYY-MM-DD/HH/flights_cycle-N.log; give date and hour to read
    only those folders. The path parts come back as columns."""
    raw = spark.read.text(f"{base}/{date}/{hour}/flights_cycle-*.log")
    path = F.col("_metadata.file_path")
    tagged = raw.select(
        "value",
        F.to_date(F.regexp_extract(path, r"/(\d{4}-\d{2}-\d{2})/\d{2}/", 1)).alias("date"),
        F.regexp_extract(path, r"/\d{4}-\d{2}-\d{2}/(\d{2})/", 1).cast("int").alias("hour"),
        F.regexp_extract(path, r"cycle-(\d+)\.", 1).cast("int").alias("file_cycle"))
    # `inline` keeps the parse a step of its own, as in parse_records
    rec = F.from_json("value", S.as_text(schema) + ", _corrupt_record string",
                      {"columnNameOfCorruptRecord": "_corrupt_record"})
    return (tagged.select("date", "hour", "file_cycle", F.inline(F.array(rec))).where(F.col("_corrupt_record").isNull())
            .select(*[X.safe_cast(n, t).alias(n) for n, t in S.fields(schema)], "date", "hour", "file_cycle"))


def read_csv(spark: SparkSession, location: str | list[str], schema: str,
             rename: dict[str, str] | None = None) -> DataFrame:
    """Header CSV files cast field by field: text that does not parse becomes null.

    Columns are found by the header of their own file, so files with extra, missing or reordered
    columns load alike; a column no header names is null. `rename` maps header names to schema names.
    A quoted field may hold commas but no line break.
    """
    lines = spark.read.text(location).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"))
    # the first line of a file's first block; one row per file
    heads = lines.where("block = 0").groupBy("file").agg(F.min_by("value", "line").alias("head"), F.min("line").alias("head_line"))
    width = heads.agg(F.max(F.size(F.split("head", ",")))).first()[0]
    if not width:
        return spark.createDataFrame([], schema)
    columns = [f"c{i}" for i in range(width)]

    def cells(text: str) -> Column:
        row = F.from_csv(text, ", ".join(f"{c} string" for c in columns), {"mode": "PERMISSIVE"})
        return F.array(*[F.trim(row[c]) for c in columns])

    known = F.create_map(*[F.lit(x) for pair in (rename or {"": ""}).items() for x in pair])

    def name_of(head: Column) -> Column:
        plain = F.regexp_replace(head, "^\ufeff", "")
        return F.coalesce(F.try_element_at(known, plain), plain)

    names = F.transform(cells("head"), name_of)
    rows = (lines.join(heads.select("file", "head", "head_line", names.alias("names")), "file")
            .where((F.col("block") > 0) | (F.col("line") != F.col("head_line"))).where(F.trim("value") != "")
            .select("names", cells("value").alias("cells")))
    return rows.select(*[
        X.safe_cast(F.get("cells", F.nullif(F.array_position("names", name), F.lit(0)).cast("int") - 1), type_).alias(name)
        for name, type_ in S.fields(schema)])
