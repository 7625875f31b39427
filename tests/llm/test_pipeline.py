"""The pipeline against plain Python over the same rows, and the registered queries against SQL."""

import os
from pathlib import Path

import duckdb
import pyarrow.parquet as pq
import pytest
from test_lines_language import brute_force as cut_lines
from test_near_dedup import brute_force as groups
from test_packing_rollup import check
from test_search_contamination import brute_hits

import __spark_entry__ as contract
import corpus_pipeline
from lexisift.llm import language
from lexisift.llm.line_dedup import MIN_WORDS

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def test_stages_and_run_equal_plain_python(spark):
    docs = pq.read_table(f"{FOLDER}/documents.parquet").to_pylist()
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    encoders = language.Encoders(language.learn_dictionaries(table.where(language.training_rows())))
    kept = [(d["doc_id"], d["text"]) for d in docs if not encoders.decide(d["text"])[2]]
    assert len(kept) > 0.9 * len(docs)
    cut = cut_lines(kept, MIN_WORDS)
    kept = [(i, text) for i, (_, n, text) in cut.items() if not n or text.strip(" ")]
    alone = {i for i, _, _, own in groups_of(kept) if own}
    kept = [(i, t) for i, t in kept if i in alone]
    items = [(b["item_id"], b["text"]) for b in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    hit = {r[0] for r in brute_hits(kept, items) if r[4]}
    kept = [(i, t) for i, t in kept if i not in hit]
    check(kept, corpus_pipeline.run(spark, FOLDER).collect())


def groups_of(rows):
    """Words as the operator separates them, at any ASCII white space."""
    table = {ord(c): " " for c in "\t\n\v\f\r"}
    return groups([(i, (t or "").translate(table)) for i, t in rows], 5)


def test_stages_keep_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).count() == 0


@pytest.mark.parametrize("name", [n for n in contract.oracle_sql() if n.startswith("op")])
def test_query_against_sql(spark, name):
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    found = contract.queries()[name](spark, FOLDER).toArrow()
    expected = connection.execute(contract.oracle_sql()[name]).to_arrow_table()
    columns = sorted(found.column_names)
    assert columns == sorted(expected.column_names)
    rows = [sorted(str([r[c] for c in columns]) for r in table.to_pylist()) for table in (found, expected)]
    assert rows[0] == rows[1]
