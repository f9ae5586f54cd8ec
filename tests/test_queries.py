"""A few named queries against their SQL counterparts on the smallest tables.

``tools/compare.py`` does it for all of them.
"""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from lexigrain.plans import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
NAMES = ["dist_topk_other", "rank_conflict_free", "align_unique", "merge_priority", "families", "markup_features", "snapshot_verify", "content_fingerprint"]


@pytest.fixture(scope="module")
def db():
    if not os.path.isdir(SF):
        pytest.skip("no tables")
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "events"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    mine = sorted(repr(tuple(r)) for r in df.select(*columns).collect())
    assert mine == sorted(repr(tuple(r)) for r in cursor.fetchall())


def test_every_query_of_the_library_has_its_sql():
    assert set(ORACLES) == set(QUERIES) and set(ORACLES) <= set(entry.oracle_sql())
