"""The pipeline's stages one by one, and the registered queries."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from sluicegate.llm.queries import ORACLE_SQL, QUERIES
from sluicegate.queries.registry import table
from tests.conftest import SF_DIR
from tests.llm.cases import awkward, document, frame, prose
from tests.llm.test_ngram_join import brute_force
from tests.llm.test_tokens import check_packed

SOME = ["doc_id", "text", "lang", "source", "n_chars"]


def test_names():
    assert [n.partition("_")[0] for n in QUERIES] == [f"op{i}" for i in range(1, 14)]
    assert {*QUERIES, "pipeline"} <= entry_module.queries().keys()
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "benchmark_decontamination", "secret_scans", "packing",
    ]


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, SF_DIR)
    quoted = ", ".join(f'"{c}"' for c in df.columns)
    expected = connection.execute(f"SELECT {quoted} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, expected))


@pytest.fixture
def folder(spark, tmp_path):
    """Tables of a corpus with a row for every stage."""
    item = " ".join(prose(900, 30))
    base = prose(1, 100)
    rows = [document(i, " ".join(prose(i, 60) + (["vile", "rotten", "wretch"] if i % 5 == 0 else []))) for i in range(1000, 1300)]
    rows += [document(20, " ".join(base)), document(21, " ".join([*base[:99], "end"])), document(22, " ".join(base).upper())]
    rows += [document(29, f"so {item} it goes"), document(30, "the password=0123456789abcdefABCD is"), *awkward()]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    labels = [(i, int(i % 5 == 0)) for i in range(1000, 1300)]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return str(tmp_path), rows


def test_stages(spark, folder):
    path, rows = folder
    docs = table(spark, path, "documents")
    columns = docs.columns
    kept = {r[0] for r in rows}
    docs = corpus_pipeline.drop_toxic(spark, docs, path)
    gone = kept - {r.doc_id for r in docs.select("doc_id").collect()}
    assert gone == {i for i in range(1000, 1300) if i % 5 == 0}
    assert docs.columns == columns and docs.count() == len(rows) - 60
    before = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id not in (6, 7, None)]
    docs = corpus_pipeline.drop_near_duplicates(spark, docs, path)
    expected = {i for i, (_, smallest) in brute_force(before).items() if i == smallest}
    ids = sorted((r.doc_id for r in docs.select("doc_id").collect()), key=str)
    assert ids == sorted([*expected, 6, 7, None, None], key=str)
    assert docs.columns == columns and docs.where("doc_id = 7").first().text == "another text of the id"
    docs = corpus_pipeline.drop_leaks(spark, docs, path)
    assert docs.where("doc_id = 29").count() == 0 and docs.count() == len(ids) - 1
    docs = corpus_pipeline.redact(spark, docs, path)
    row = docs.where("doc_id = 30").first()
    assert (row.text, row.n_chars) == ("the [secret] is", 15)
    assert docs.columns == columns and docs.schema["n_chars"].dataType.simpleString() == "bigint"
    pieces = corpus_pipeline.pack_sequences(spark, docs, path).collect()
    check_packed([(r.doc_id, r.text) for r in docs.collect()], pieces, 2048)


def test_run(spark, folder):
    path, _ = folder
    pieces = corpus_pipeline.run(spark, path)
    assert {"doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(pieces.columns)
    assert pieces.where("doc_id IN (21, 22, 1000)").count() == 0
    assert pieces.where("doc_id = 20").count() > 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_run_on_empty_tables(spark, tmp_path):
    frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
