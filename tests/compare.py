"""Run registered queries on Spark and their SQL on DuckDB and compare them.

Usage: python -m tests.compare [sf_dir] [--sql] [name ...]   (--sql: only queries with a counterpart)
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v + 0.0)
    if v is None or isinstance(v, (bool, int, str)):
        return v
    if hasattr(v, "item"):
        return plain(v.item())
    return str(v)


def kind(type_name: str) -> str:
    t = type_name.lower()
    for word, group in (("bigint", "bigint"), ("int", "int"), ("double", "double"), ("string", "text"),
                        ("varchar", "text"), ("bool", "bool"), ("date", "date"), ("timestamp", "ts")):
        if t.startswith(word):
            return group
    return t


def compare(df, con, sql) -> str:
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    want_types = {c[0]: kind(str(c[1])) for c in rel.description}
    order = sorted(names)
    if sorted(df.columns) != order:
        return f"columns differ: {sorted(df.columns)} / {order}"
    got_types = {n: kind(t) for n, t in df.dtypes}
    off = {n: (got_types[n], want_types[n]) for n in order if got_types[n] != want_types[n]}
    if off:
        return f"types differ: {off}"
    want = sorted((tuple(plain(r[names.index(n)]) for n in order) for r in rel.fetchall()), key=repr)
    got = sorted((tuple(plain(r[n]) for n in order) for r in df.collect()), key=repr)
    if len(want) != len(got):
        return f"rows differ: spark {len(got)} / sql {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"values differ in {order}: spark {g} / sql {w}"
    return ""


def main(argv: list[str]) -> int:
    import __spark_entry__ as e
    from aerometer.session import build_session

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if a != "--sql"]
    spark = build_session(master="local[8]", **{"spark.sql.shuffle.partitions": "8",
                                                "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    queries, sqls = e.queries(), e.oracle_sql()
    bad = 0
    for name, query in queries.items():
        if (names and not any(n in name for n in names)) or ("--sql" in argv and name not in sqls):
            continue
        start = time.time()
        try:
            df = query(spark, sf_dir)
            note = compare(df, con, sqls[name]) if name in sqls else f"rows only: {len(df.collect())}"
            failed = name in sqls and bool(note)
        except Exception as err:  # noqa: BLE001
            note, failed = f"{type(err).__name__}: {str(err)[:600]}", True
        bad += failed
        print(f"{'FAIL' if failed else 'ok  '} {name} {time.time() - start:.1f}s {note}", flush=True)
    print(f"{bad} failed")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
