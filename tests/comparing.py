"""Runs a query in Spark and its SQL in DuckDB over the same tables."""

import math
import os

import duckdb

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return round(value, 6)
    return [plain(v) for v in value] if isinstance(value, (list, tuple)) else value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(str([plain(r[i]) for i in order]) for r in rows)


def both(spark, query, sql):
    """Sorted column names and rows of either side."""
    df = query(spark, SF_DIR)
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    result = con.sql(sql)
    names = [d[0] for d in result.description]
    return (sorted(df.columns), rows_of(df.columns, df.collect())), (sorted(names), rows_of(names, result.fetchall()))
