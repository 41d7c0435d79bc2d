"""The registered queries over the smallest supplied tables, against plain programs and SQL."""

import duckdb
import pytest

from haulmart.llm.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_whole_tables_are_answered(spark, name):
    out = QUERIES[name](spark, SF)
    rows = out.collect()
    if "doc_id" in out.columns and name.split("_")[0] not in ("op1", "op10"):
        assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    if name in ORACLE_SQL:
        con = duckdb.connect()
        for table in ("documents", "conversations"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
        found = con.execute(ORACLE_SQL[name])
        columns = [d[0] for d in found.description]
        assert sorted(columns) == sorted(out.columns)
        want = [dict(zip(columns, r)) for r in found.fetchall()]
        key = lambda r: str(sorted(r.items(), key=lambda x: x[0]))
        assert sorted(map(key, want)) == sorted(key(r.asDict()) for r in rows)
