"""Registered queries beside their SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check import rows_of

SF = "/root/testdata/sf0.001"
CHOSEN = [
    "differential_regions", "overlap_join", "overlap_join_left", "count_in_regions", "merge_intervals", "complement", "pileup", "combine_tracks_max",
    "p_adjust_bh", "merge_n_sets", "scan_pwm", "score_quantiles", "multi_model_roc", "spacing_pvalues", "annotate_peaks", "read_gff3",
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", CHOSEN)
def test_same_rows(spark, con, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
