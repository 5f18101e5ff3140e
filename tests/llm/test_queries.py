"""The registered queries: rows, columns and, where SQL can say it, values."""

import os

import duckdb
import pytest
from conftest import SF_SMALL

import __spark_entry__ as E
from foehn.llm.queries import ORACLE_SQL, QUERIES
from tools.check_oracle import TABLES, rows_of


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{SF_SMALL}/{t}.parquet"):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_all_are_registered():
    assert {f"op{i}" for i in range(1, 14)} == {q.partition("_")[0] for q in QUERIES}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_sql(spark, con, name):
    assert rows_of(QUERIES[name](spark, SF_SMALL).toArrow()) == rows_of(con.execute(ORACLE_SQL[name]).to_arrow_table())


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("op1_kneser_ney", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]),
        ("op2_entropy_mix", ["doc_id", "size", "source_size", "target", "taken"]),
        ("op6_toxicity", ["doc_id", "held_out", "score", "predicted"]),
        ("op11_nb_svm", ["doc_id", "held_out", "score", "predicted"]),
        ("op8_contextual_pii", ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]),
    ],
)
def test_one_row_per_document(spark, name, columns):
    df = QUERIES[name](spark, SF_SMALL)
    assert df.columns[: len(columns)] == columns
    assert df.count() == spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
