"""The pipeline stage by stage, each against brute force on its own input, and the operators' SQL."""

import brute
import compare
import corpus_pipeline
import pytest

import __spark_entry__ as driver
from plaudit.llm.oracle import LLM_ORACLE
from plaudit.llm.registry import LLM_QUERIES
from plaudit.llm.rows import stored

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stored(stage(spark, docs, SF), "stage")
        out.append((name, docs, after))
        docs = after
    return {name: (before, after) for name, before, after in out}


def table(frame):
    return [tuple(r) for r in frame.select("doc_id", "text").collect()]


def test_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes, name
    assert len(stages) == 5


def test_language(stages):
    before, after = stages["language ID"]
    wanted = {i for i, t in table(before) if any(c.isalpha() for c in t or "")}
    assert sorted(r[0] for r in table(after)) == sorted(wanted)


def test_near_dedup(stages):
    before, after = stages["SimHash near-dedup"]
    rows = table(before)
    assert sorted(r[0] for r in table(after)) == sorted({c for _, _, c in brute.near_copies(rows)})
    assert set(table(after)) <= set(rows)


def test_substring(stages):
    before, after = stages["substring dedup"]
    rows = dict(table(before))
    wanted = {i: (n, g, h) for i, n, g, h in brute.substring(list(rows.items()))}
    got = dict(table(after))
    assert set(got) == {i for i, (n, g, _) in wanted.items() if not g or g < n}
    for i, text in got.items():
        assert text == rows[i] if not wanted[i][1] else brute.sha(text) == wanted[i][2]
    assert after.filter("n_chars <> char_length(text)").join(
        before.filter("n_chars = char_length(text)"), "doc_id", "left_semi").count() == 0


def test_decontamination(stages, spark):
    before, after = stages["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    wanted = {r[0] for r in brute.contamination(table(before), items) if not r[-1]}
    assert {r[0] for r in table(after)} == wanted


def test_packed_documents(stages):
    before, after = stages["packing"]
    assert {r.doc_id for r in after.collect()} == {r[0] for r in table(before)}


def test_run(spark, stages):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = driver.queries()["pipeline"](spark, SF)
    # How pieces are cut may differ with the partitions; what is packed may not.
    total = got.groupBy("doc_id").sum("length").collect()
    assert sorted(map(tuple, total)) == sorted(map(tuple, stages["packing"][1].groupBy("doc_id").sum("length").collect()))
    assert set(names) <= set(got.columns)


def test_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_sql(spark, name):
    assert compare.spark_rows(LLM_QUERIES[name](spark, SF)) == compare.duck_rows(compare.connect(SF), LLM_ORACLE[name])


def test_registered():
    assert {f"op{n}" for n in range(1, 14)} == {name.split("_")[0] for name in LLM_QUERIES}
    assert set(LLM_QUERIES) <= set(driver.queries()) and set(LLM_ORACLE) <= set(driver.oracle_sql())
