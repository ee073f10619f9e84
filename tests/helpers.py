"""Builders of flows, and the comparison of queries with SQL."""

import os

from weft.schema import FLOW_DDL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COLUMNS = [c.split()[0] for c in FLOW_DDL.split(", ")]
DEFAULTS = {
    "flow_id": 0, "node_id": 99, "foreign_source": "SomeFs", "foreign_id": "SomeFid", "if_index": 98, "direction": "INGRESS", "application": "SomeApplication",
    "location": "", "protocol": 6, "src_address": "10.0.0.1", "dst_address": "10.0.0.3", "src_hostname": None, "dst_hostname": None, "dscp": 0, "ecn": 0,
    "delta_switched": 1_500_000_000_000, "last_switched": 1_500_000_000_000, "num_bytes": 0, "sampling_interval": 1.0,
}
BASE = 1_500_000_000_000


def flow(**values):
    return tuple({**DEFAULTS, **values}[c] for c in COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), FLOW_DDL)


def rounded(value):
    if isinstance(value, float):
        return float(f"{value:.9g}")
    return value


def table_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted((tuple(rounded(r[i]) for i in order) for r in rows), key=repr)


def same_as_sql(spark, name, query, sql, sf_dir="/root/testdata/sf0.001"):
    import duckdb

    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{sf_dir}/{file}'")
    df = query(spark, sf_dir)
    found = con.execute(sql)
    expected = table_of([d[0] for d in found.description], found.fetchall())
    got = table_of(df.columns, [tuple(r) for r in df.collect()])
    assert got[0] == expected[0], name
    assert got[1] == expected[1], name
