"""The operators that SQL can express equal their DuckDB statements on whole tables and on odd rows."""

import hashlib
import os

import duckdb
import pytest

from strata.llm.oracles import SQL
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def _rows(pdf):
    pdf = pdf[sorted(pdf.columns)]
    return sorted(map(tuple, pdf.astype(object).itertuples(index=False)))


def _duck(key, folder):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet/*.parquet')"
                    if os.path.isdir(f"{folder}/{name}.parquet")
                    else f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con.execute(SQL[key]).df()


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("key", sorted(SQL))
def test_whole_tables(spark, key):
    want = _duck(key, SF)
    got = QUERIES[key](spark, SF).select(*want.columns).toPandas()
    assert _rows(got) == _rows(want)


@pytest.mark.parametrize("key", sorted(SQL))
def test_odd_rows(spark, key, odd_rows, tmp_path):
    """Null, empty, blank and one-word texts, copies, near copies and shared passages; ids are unique here."""
    texts = [t for _, t in odd_rows if t is None or len(t) < 50_000]
    passage = " ".join(f"shared{i}" for i in range(70))
    texts += [f"{passage} tail one", f"head two {passage}", f"é {passage}", "漢字 " * 90, "漢字 " * 95 + "x"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [(1, passage), (2, "123 456"), (3, None), (4, ""), (5, texts[0]), (12, "ONE")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, [i % 7 / 8, i % 5 / 9 if i % 50 else None, 0.25], i % 4 if i % 33 else None) for i in range(450)],
                          "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    want = _duck(key, str(tmp_path))
    got = QUERIES[key](spark, str(tmp_path)).select(*want.columns).toPandas()
    assert (len(got) == len(texts) or "doc_id" not in got) and _rows(got) == _rows(want)


def test_empty_text_digest():
    con = duckdb.connect()
    con.execute("CREATE TABLE documents AS SELECT 1::BIGINT AS doc_id, CAST(NULL AS VARCHAR) AS text")
    con.execute("CREATE TABLE benchmark AS SELECT 1::BIGINT AS item_id, CAST(NULL AS VARCHAR) AS text")
    for key in ("op3_suffix_dedup", "op4_substring_dedup"):
        assert con.execute(SQL[key]).df().kept_sha256[0] == hashlib.sha256(b"").hexdigest()
