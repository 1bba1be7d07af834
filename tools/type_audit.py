"""Compare result column types of each query with its DuckDB oracle.

    python tools/type_audit.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

CANON = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP WITH TIME ZONE",
         "boolean": "BOOLEAN", "float": "FLOAT", "smallint": "SMALLINT"}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from marketlake.plans.catalog import ORACLE, QUERIES
    from marketlake.session import build_session
    from tools.check_oracle import TABLES
    spark = build_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    bad = 0
    for name, sql in ORACLE.items():
        df = QUERIES[name](spark, sf_dir)
        st = {f.name: CANON.get(f.dataType.simpleString(), f.dataType.simpleString())
              for f in df.schema.fields}
        rel = con.sql(f"SELECT * FROM ({sql}) LIMIT 0")
        dt = {c: str(t) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (st[c], dt.get(c)) for c in st if st[c] != dt.get(c)}
        if diff:
            bad += 1
            print(name, diff)
    print("queries with type differences:", bad)


if __name__ == "__main__":
    main()
