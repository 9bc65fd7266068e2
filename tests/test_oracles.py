"""Every registered spectrum query against its SQL, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

from hertzmill import catalog


def duck(sf_dir):
    con = duckdb.connect()
    for path in Path(sf_dir).iterdir():
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}{'/*.parquet' if path.is_dir() else ''}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_equals_its_sql(spark, sf_dir, tmp_path, name):
    con = duck(sf_dir)
    catalog.QUERIES[name](spark, sf_dir).write.parquet(str(tmp_path / "out"))
    ours, theirs = con.sql(f"SELECT * FROM '{tmp_path}/out/*.parquet'"), con.sql(catalog.ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    kinds = lambda rel: {c: str(t) for c, t in zip(rel.columns, rel.types)}
    assert kinds(ours) == kinds(theirs)
    listed = ", ".join(f'"{c}"' for c in sorted(ours.columns))
    con.execute(f"CREATE TEMP TABLE a AS SELECT {listed} FROM '{tmp_path}/out/*.parquet'")
    con.execute(f"CREATE TEMP TABLE b AS SELECT {listed} FROM ({catalog.ORACLES[name]})")
    assert con.sql("SELECT * FROM a EXCEPT ALL SELECT * FROM b").fetchall() == []
    assert con.sql("SELECT * FROM b EXCEPT ALL SELECT * FROM a").fetchall() == []
