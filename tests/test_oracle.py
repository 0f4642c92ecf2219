"""Spark results equal the DuckDB SQL twins on the smallest fixture."""

import datetime as dt
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
# a cross-section of every operator family; the full list runs in scripts/check_oracle.py
KEYS = ["shipment_totals", "build_order_lines", "build_invoices", "build_ar_ledger", "ar_aging_summary",
        "freight_class", "normalize_timestamps", "range_join_promos", "asof_price", "secondary_rep",
        "score_quantile", "minmax_normalize", "top_n_items_per_customer", "price_walk", "sample_exact_fraction",
        "weighted_sample", "pick_one_active", "spread_dates", "weighted_category", "build_preferences", "contract_prices",
        "build_inventory_snapshot", "build_slotting", "check_unique", "conform_to_schema", "scan_postal_tsv"]


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF)
    s_cols, s_rows = _canon(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(E.oracle_sql()[key])
    d_cols, d_rows = _canon([d[0] for d in res.description], res.fetchall())
    assert s_cols == d_cols
    assert s_rows == d_rows
