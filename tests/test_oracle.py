"""Registered queries against their DuckDB twins on the smallest tables (the driver runs all of them
at sf0.01; tools/check_oracle.py does the same locally)."""
import math

import duckdb
import pytest

from helpers import SF001

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SUBSET = ["arcsinh", "gate_quantile", "gate_counts", "label_events", "label_composition", "phenotype_strings",
          "search_clusters", "cluster_medians", "channels_by_sample", "desc_remap", "match_metadata", "abundance",
          "bh_adjust", "baseline_cut", "bisect_silhouette", "mean_cutoffs", "compensate", "segment_stats", "bead_smooth",
          "knn", "mem"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 6))
    return repr(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_every_query_has_a_callable_and_most_an_oracle():
    from cytospark.plans.registry import ORACLE, QUERIES
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and set(ORACLE) <= set(QUERIES) <= set(q)
    assert len(ORACLE) >= 0.8 * len(QUERIES)


@pytest.mark.parametrize("name", SUBSET)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    res = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(ocols, res.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["cluster", "phenotype", "n_events"]
