"""Shared pieces: reading tables, clean text, written intermediates, one-row-per-winner joins."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: What separates words in every operator (fixed by the data contract).
WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Words of a shingle where an operator's contract names no other length.
SHINGLE = 5

_LOCAL: list[str] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def text_of(name: str = "text") -> Column:
    """The text column, null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def lower_az(text: Column) -> Column:
    """A-Z to a-z and no other letter."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The words of a text, in order; none for an empty or blank one."""
    return F.filter(F.split(lower_az(text), WORD_BREAK), lambda w: w != "")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a local master may go without one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="aerometer-llm-"))
    return _LOCAL[0]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table in the shared folder: cuts lineage and outlives lost executors."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def blocks_for(amount: float, each: float) -> int:
    """How many blocks of a given size an amount needs; at least one."""
    return max(1, math.ceil(amount / each))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until none of them is a column of df."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def sortable(df: DataFrame, names: list[str]) -> list[Column]:
    """Columns that Spark can order by."""
    kinds = dict(df.dtypes)
    return [F.col(f"`{n}`") for n in names if not kinds[n].startswith(("map", "variant")) and "map<" not in kinds[n]]


def winning_rows(docs: DataFrame, key: Column, winners: DataFrame) -> DataFrame:
    """The rows of docs that winners (doc_id, key) names, one for each winner, all columns of docs.

    Rows that agree in doc_id and key are one document written twice; the smallest by its other
    columns stays.
    """
    k, wid, wkey, place = free_names(docs, "_key", "_win_id", "_win_key", "_place")
    w = winners.toDF(wid, wkey)
    keyed = docs.withColumn(k, key)
    met = keyed.join(w, (F.col(k) == F.col(wkey)) & F.col("doc_id").eqNullSafe(F.col(wid)), "left_semi")
    others = sortable(docs, [c for c in docs.columns if c not in ("doc_id", "text")])
    order = Window.partitionBy(k, "doc_id").orderBy(*(others or [F.col(k)]))
    return met.withColumn(place, F.row_number().over(order)).where(F.col(place) == 1).select(*docs.columns)
