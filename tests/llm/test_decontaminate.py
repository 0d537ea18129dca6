from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pluvio.llm import decontaminate, queries
from tests.llm.conftest import prose, same_rows


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, prose(7, 40)), (2, "one"), (3, ""), (4, None), (5, prose(9, 13)), (5, prose(9, 13)), (6, "ab ab"), (10, prose(1, 14)), (7, "nowhere to be found")]
    return spark.createDataFrame(rows, "item_id bigint, text string")


def test_query_equals_sql_on_awkward_documents(spark, awkward, items, as_tables):
    folder, database = as_tables(documents=awkward, benchmark=items)
    assert same_rows(queries.op10_decontamination(spark, folder), database.sql(queries.OP10_SQL))


def test_blocks_of_items_add_up(spark, awkward, items):
    whole = decontaminate.contamination(awkward, items, as_col="found").select("doc_id", "found.*")
    parts = decontaminate.contamination(awkward, items, as_col="found", block=100).select("doc_id", "found.*")
    assert sorted(map(str, whole.collect())) == sorted(map(str, parts.collect()))


def test_filter_keeps_columns_and_clean_documents(spark, awkward, items, no_docs):
    kept = decontaminate.decontaminate(awkward, items)
    assert kept.columns == awkward.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert 18 not in ids and 14 not in ids and {3, 4, 5, 6, 7, 8, 9}.issubset(ids)
    assert decontaminate.decontaminate(no_docs, items).count() == 0
    assert decontaminate.decontaminate(awkward, items.where(F.lit(False))).count() == awkward.count()


def test_item_without_id_marks_but_is_not_listed(spark):
    docs = spark.createDataFrame([(1, "x y z")], "doc_id bigint, text string")
    items = spark.createDataFrame([(None, "y z")], "item_id bigint, text string")
    found = decontaminate.contamination(docs, items).select("contamination.*").first()
    assert (found.n_words, [(s.first, s.behind) for s in found.spans], found["items"]) == (3, [(1, 3)], [])
