from __future__ import annotations

import duckdb
import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tapewell.llm.queries import QUERIES, SQL  # noqa: E402

TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def _plain(rows):
    return sorted(tuple(str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    own = df.select(*columns).collect()
    sql = con.execute(f"SELECT {', '.join(columns)} FROM ({SQL[name]})").fetchall()
    assert own and _plain(own) == _plain(sql)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    from tapewell.session import stage

    counts = [docs.count()]
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        counts.append(docs.count())
    assert counts[1] <= counts[0] and counts[2] < counts[1] and counts[3] < counts[2]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count()
