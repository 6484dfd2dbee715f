"""The licence query against its SQL."""

import duckdb

from tessera.llm import license_scan

SF = "/root/testdata/sf0.001"


def test_licence_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{SF}/documents.parquet'")
    df = license_scan.op3_license_scan(spark, SF)
    cur = con.execute(license_scan.ORACLES["op3_license_scan"])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(*names).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
