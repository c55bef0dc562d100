"""Registered corpus queries: names, columns, one row per input row, and their SQL on the smallest tables."""

import math
import os

import duckdb
import pytest

from tickloom.llm import queries

DATA = os.environ.get("TICKLOOM_TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the driver's tables")
COLUMNS = {
    "op1_quality": "doc_id held_out score predicted", "op3_secrets": "doc_id n_assign n_access n_hex base_sha256 spans", "op4_language": "doc_id held_out lang_pred score",
    "op5_near_duplicates": "doc_id n_shingles component_id kept", "op6_repeated_substrings": "doc_id n_bytes n_removed n_spans kept_sha256", "op7_sentencepiece": "doc_id n_tokens ids_sha256 decoded_sha256",
    "op8_decontamination": "doc_id n_words n_hit n_items items_sha256 contaminated", "op9_toxicity": "doc_id held_out score predicted", "op10_embedding_dedup": "vec_id n_links component_id kept",
}


def plain(v):
    return "null" if v is None or (isinstance(v, float) and math.isnan(v)) else str(v)


def test_names():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 11))
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = queries.queries()[name](spark, DATA)
    rows = df.collect()
    source = "pages" if name.startswith("op2_") else "embeddings" if name.startswith("op10_") else "documents"
    assert len(rows) == con.sql(f"select count(*) from {source}").fetchall()[0][0]
    assert set(COLUMNS.get(name, "").split()) <= set(df.columns)
    if sql := queries.oracle_sql().get(name):
        rel = con.sql(sql)
        cols = sorted(df.columns)
        assert sorted(rel.columns) == cols
        where = [rel.columns.index(c) for c in cols]
        assert sorted(tuple(plain(r[c]) for c in cols) for r in rows) == sorted(tuple(plain(r[i]) for i in where) for r in rel.fetchall())
