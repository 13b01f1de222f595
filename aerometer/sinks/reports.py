"""Sectioned metric logs: one CSV folder per section, or one text file with headed sections."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The mark of a section's head, and the width it is filled up to.
MARK, FILL, WIDTH = "── SECTION {}: {} ", "─", 62
_MARK = r"^── SECTION (\d+): (.*?) ─*$"


def write_sections(sections: dict[str, DataFrame], path: str) -> None:
    for name, df in sections.items():
        df.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def _csv(*cells: Column) -> Column:
    return F.to_csv(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells)]))


def write_report(spark: SparkSession, path: str, title: str, facts: dict[str, str],
                 sections: dict[str, tuple[DataFrame, Sequence[Column | str]]]) -> None:
    """One text file: the title, `key,value` lines, then each section under its head, with a line of column
    names and its rows in the given order. A name holds no line break; a text cell's line breaks are written
    as spaces, null as nothing.

    Rows are sorted where they are and only the last step gathers them, as one file is asked for: sections
    are the tidy tables of a report.
    """
    head = [title, *(f"{k},{v}" for k, v in facts.items())]
    parts = [spark.createDataFrame([(0, i, 0, line) for i, line in enumerate(head)], "section int, kind int, row long, line string")]
    for n, (name, (df, order)) in enumerate(sections.items(), 1):
        mark = MARK.format(n, name)
        names = spark.range(1).select(_csv(*[F.lit(c) for c in df.columns])).first()[0]
        parts.append(spark.createDataFrame(
            [(n, 0, 0, ""), (n, 1, 0, mark + FILL * max(1, WIDTH - len(mark))), (n, 2, 0, names)], "section int, kind int, row long, line string"))
        cells = [F.regexp_replace(F.col(f"`{c}`").cast("string"), r"[\r\n]+", " ") for c in df.columns]
        rows = df.orderBy(*order).select(_csv(*cells).alias("line")).withColumn("row", F.monotonically_increasing_id())
        parts.append(rows.select(F.lit(n).alias("section"), F.lit(3).alias("kind"), "row", "line"))
    lines = reduce(DataFrame.unionByName, parts)
    lines.coalesce(1).sortWithinPartitions("section", "kind", "row").select("line").write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """section, name, place and cells (map of column to text) of every row of a report, in any number of tasks.

    Only the lines that hold a mark or a section's column names, a few for each section, come to the driver;
    every other line finds its section by its place. Empty texts and nulls are not told apart: both are null.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("id"), F.col("value").alias("line"))
    place = F.struct("block", "id")
    marks = sorted((tuple(r.place), int(re.match(_MARK, r.line)[1]), re.match(_MARK, r.line)[2])
                   for r in lines.where(F.col("line").rlike(_MARK)).select(place.alias("place"), "line").collect())
    if not marks:
        return spark.createDataFrame([], "section int, name string, place struct<block:bigint,id:bigint>, cells map<string,string>")
    at = lambda p: F.struct(F.lit(p[0]).cast("bigint").alias("block"), F.lit(p[1]).cast("bigint").alias("id"))
    number, name = F.lit(None).cast("int"), F.lit(None).cast("string")
    for where, n, title in marks:
        number = F.when(place > at(where), F.lit(n)).otherwise(number)
        name = F.when(place > at(where), F.lit(title)).otherwise(name)
    rows = lines.where(~F.col("line").rlike(_MARK) & (F.trim("line") != "")).select(
        place.alias("place"), "line", number.alias("section"), name.alias("name")).where("section IS NOT NULL")
    heads = rows.groupBy("section").agg(F.min_by("line", "place").alias("head"), F.min("place").alias("head_place"))
    width = heads.agg(F.max(F.size(F.split("head", ",")))).first()[0] or 1

    def cells(c: str) -> Column:
        row = F.from_csv(c, ", ".join(f"c{i} string" for i in range(width)), {"mode": "PERMISSIVE"})
        return F.array(*[row[f"c{i}"] for i in range(width)])

    out = rows.join(F.broadcast(heads), "section").where(F.col("place") > F.col("head_place"))
    named = F.filter(F.arrays_zip(cells("head").alias("k"), cells("line").alias("v")), lambda p: p["k"].isNotNull())
    return out.select("section", "name", "place", F.map_from_entries(named).alias("cells"))


def section(report: DataFrame, name: str, schema: str) -> DataFrame:
    """The rows of one section as typed columns; text that does not parse is null."""
    from aerometer import schemas as S
    from aerometer.functions import scalars as X

    return report.where(F.col("name") == name).select(
        *[X.safe_cast(F.try_element_at("cells", F.lit(c)), t).alias(c) for c, t in S.fields(schema)])
