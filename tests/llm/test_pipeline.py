"""The pipeline against a plain replay of its stages, and the corpus queries against their SQL."""

import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as C
from studytrail.llm import decontaminate, mixing, neardup, quality, queries

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()

if not os.path.isdir(SF):
    pytest.skip("no test tables here", allow_module_level=True)


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def table(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n for n in range(1, 14)} == {int(x[2:].split("_")[0]) for x in names if x.startswith("op")}
    assert set(queries.registry().sql) <= names


@pytest.mark.parametrize("name", sorted(queries.registry().sql))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    want = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(want.columns)
    assert table(map(tuple, df.collect()), df.columns) == table(want.fetchall(), want.columns)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns


def test_pipeline_equals_replay(spark):
    """Each stage's decisions are taken from its operator on the replay's own rows; keeping,
    ordering, copying and encoding are done plainly."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    make = lambda ids: spark.createDataFrame([rows[i] for i in sorted(ids)], docs.schema)
    good = {r.doc_id for r in quality.assessed(docs).collect() if r.kept}
    single = {r.doc_id for r in neardup.near_duplicates(make(good)).collect() if r.kept}
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    clean = single - {r.doc_id for r in decontaminate.leaks(make(single), items).collect()}
    assert rows.keys() > good > single >= clean
    copies = sorted(r.row.doc_id for r in mixing.mixed(make(clean)).collect())
    tokenizer, start, want = Tokenizer.from_file(C.VOCABULARY), 0, []
    for doc_id in copies:
        ids = np.array([*tokenizer.encode(rows[doc_id].text, add_special_tokens=False).ids, 2], "<u4")
        want.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in C.run(spark, SF).collect())
    assert got == want


def test_empty_tables(spark, tmp_path):
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []
