"""Queries over alignments against their SQL on documents that the test tables don't have: empty, short and null texts, no language."""

import duckdb
import pytest

from strandline.plans import catalog

TEXTS = [
    ("some plain text", "en"), ("", "en"), ("", "en"), ("some plain text", "en"), ("...", "en"), ("..", "en"), ("", "de"), (".", "de"), (None, "de"), ("a\U0001f600b", "fr"), ("é...", "fr"),
    ("text of no language", None), ("text of no language", None), ("", None), ("other text of no language", None),
    ("", "es"), ("text against an empty one", "es"), ("", "es"), ("none", "es"), (".", "es"), ("N", "it"), ("", "it"), ("M", "it"),
]


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(i, t, lang) for i, (t, lang) in enumerate(TEXTS)], "doc_id long, text string, lang string").write.parquet(f"{d}/documents.parquet")
    return d


@pytest.mark.parametrize("name", ["quality_cascade", "quality_statistics", "vcf_documents"])
def test_odd_documents(spark, odd, name):
    result = duckdb.connect().execute(catalog.ORACLE[name].replace("FROM documents", f"FROM '{odd}/documents.parquet/*.parquet'"))
    cols = [x[0] for x in result.description]
    got = [tuple(r[c] for c in cols) for r in catalog.QUERIES[name](spark, odd).collect()]
    assert got and sorted(map(str, got)) == sorted(map(str, result.fetchall()))
