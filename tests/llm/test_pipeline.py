import pytest

import corpus_pipeline as cp
from tests.llm.conftest import SCHEMA, corpus, table
from tests.llm.test_decontam import brute as hits
from tests.llm.test_linededup import brute as lines
from tests.llm.test_ngram_join import brute as classes


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """documents and benchmark as tables."""
    d = str(tmp_path_factory.mktemp("sf"))
    rows = corpus(7)
    rows = [(i, t, None if l is None else "en", s, n) for i, t, l, s, n in rows]
    rows.append((900, "123 456 --", "en", "a", 0))
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{d}/documents.parquet")
    text = max((r[1] for r in rows if r[1] and len(r[1]) < 2000), key=len)
    spark.createDataFrame([(1, text), (2, "unseen words here")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_equal_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    cols = docs.columns
    for name, stage in cp.STAGES:
        before = [tuple(r) for r in docs.collect()]
        out = stage(spark, docs, folder)
        if name != "source_mixing":
            assert out.columns == cols and out.dtypes == docs.dtypes
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        after = table(docs)
        if name == "language_id":
            gone = {r[1] for r in before} - {r[1] for r in after}
            assert gone == {None, "", " \t\n ", "123 456 --"}
        elif name == "line_dedup":
            want = {(i, t) for i, _, _, t in lines(before)}
            assert {(r[0], r[1]) for r in after} == want and len(after) == len(before)
            assert any(len(r[1]) == r[4] != len({b[0]: b for b in before}[r[0]][1]) for r in after)
        elif name == "ngram_jaccard_join":
            want = sorted({d for d, _, c in classes(before, 5, 80, 100) if d is not None and d == c})
            assert sorted(r[0] for r in after if r[0] is not None) == want
            assert sum(r[0] is None for r in after) == sum(r[0] is None for r in before)
        elif name == "benchmark_decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            clean = sorted((str(d) for d, _, _, _, bad in hits(before, items) if not bad))
            assert sorted(str(r[0]) for r in after) == clean and len(after) < len(before)
        else:
            assert after and all(0 < r[4] <= 3 * r[1] for r in after)


def test_run_and_extra_columns(spark, folder, wide_docs):
    got = table(cp.run(spark, folder))
    assert got == table(cp.run(spark, folder))
    for _, stage in cp.STAGES[:-1]:
        assert stage(spark, wide_docs, folder).columns == wide_docs.columns


def test_empty_table(spark, folder, no_docs):
    for _, stage in cp.STAGES:
        assert stage(spark, no_docs, folder).count() == 0
