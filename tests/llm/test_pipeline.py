"""Every stage against a plain version of itself, on its own input."""

import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from trackspark.llm.langid import LETTER
from trackspark.llm.pii import find_pii

from test_jaccard import brute as components_of
from test_mixing import shared_out
from test_packing import checked

FOLDER = "/root/testdata/sf0.001"
WORDS = r"[^\x20\x09-\x0D]+"


def count(text):
    return len(re.findall(WORDS, text or ""))


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    """Input of every stage, and the last stage's result, written and read as the pipeline does."""
    at = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], FOLDER).write.parquet(f"{at}/{i}")
        seen.append(spark.read.parquet(f"{at}/{i}"))
    return seen


def test_columns_stay(inputs):
    assert all(x.columns == inputs[0].columns for x in inputs[:5])


def test_language_keeps_what_has_letters(inputs):
    before, after = ({r.doc_id: r for r in x.collect()} for x in inputs[:2])
    assert set(after) == {i for i, r in before.items() if r.text and LETTER.search(r.text)}
    assert all(before[i] == r for i, r in after.items())


def test_near_duplicates_keep_the_least_of_each_component(inputs):
    rows = [(r.doc_id, r.text) for r in inputs[1].collect()]
    expected = {i for i, _, component in components_of(rows, 5, 80) if i == component}
    assert sorted(r.doc_id for r in inputs[2].collect()) == sorted(expected)


def test_no_personal_data_is_left(inputs):
    assert sorted(r.doc_id for r in inputs[3].collect()) == sorted(r.doc_id for r in inputs[2].collect())
    assert find_pii(inputs[3]).filter("size(pii) > 0").count() == 0
    assert all(r.n_chars == len(r.text) for r in inputs[3].collect())


def test_mixture_comes_near_its_targets(inputs):
    sizes, taken, longest = {}, {}, {}
    for r in inputs[3].collect():
        sizes[r.source] = sizes.get(r.source, 0) + count(r.text)
        longest[r.source] = max(longest.get(r.source, 0), count(r.text))
    for r in inputs[4].collect():
        taken[r.source] = taken.get(r.source, 0) + count(r.text)
    for source, target in shared_out(sizes).items():
        assert abs(taken.get(source, 0) - target) <= longest[source] / 2 + 1


def test_all_words_are_packed(inputs):
    rows = inputs[5].collect()
    checked(rows, (512, 1024, 2048, 4096, 8192))
    assert sum(r.length for r in rows) == sum(count(r.text) for r in inputs[4].collect())


def test_run_gives_the_last_stage_and_leaves_nothing_else(spark, inputs):
    from urllib.parse import urlparse

    from trackspark.session import shared_dir

    root = Path(urlparse(shared_dir(spark)).path)
    before = {p.name for p in root.iterdir() if p.name.startswith(("stage-", "table-"))}
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, inputs[5].collect()))
    left = {p.name for p in root.iterdir() if p.name.startswith(("stage-", "table-"))} - before
    assert len(left) == 1 and left.pop().startswith("stage-packing")


def test_odd_rows_pass_all_stages(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and clashing columns."""
    base = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(60).select("doc_id", "text", "lang", "source")
    long = "a long text that goes on " * 60_000
    odd = [(None, None, None, None), (None, "no id but words", None, None), (None, "no id but words", None, None), (900, "", "en", "web"), (901, long, None, "web")]
    odd += [(901, "another text of that id", None, None), (902, "mail me a@b.cd", "en", None), (902, "mail me a@b.cd", "en", None), (903, "12 34", "en", "web")]
    docs = base.unionByName(spark.createDataFrame(odd, base.schema))
    for clash in ("position", "pii", "copies", "place", "size", "key"):
        docs = docs.withColumn(clash, F.lit(1))
    docs = docs.withColumn("n.chars", F.lit(None).cast("long"))
    docs.write.parquet(str(tmp_path / "0"))
    seen = [spark.read.parquet(str(tmp_path / "0"))]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES, start=1):
        stage(spark, seen[-1], str(tmp_path)).write.parquet(str(tmp_path / str(i)))
        seen.append(spark.read.parquet(str(tmp_path / str(i))))
    assert all(x.columns == docs.columns for x in seen[:5])
    after = [{(r.doc_id, r.text) for r in x.collect()} for x in seen[:5]]
    kept = {(None, "no id but words"), (901, long), (901, "another text of that id"), (902, "mail me a@b.cd")}
    assert kept <= after[1] and not {(None, None), (900, ""), (903, "12 34")} & after[1]
    assert kept <= after[2] and seen[2].filter("doc_id = 902 or doc_id is null").count() == 2
    assert (902, "mail me [EMAIL]") in after[3]
    assert sum(r.length for r in seen[5].collect()) == sum(count(t) for t in (r.text for r in seen[4].collect()))


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, FOLDER)
        assert out.count() == 0
