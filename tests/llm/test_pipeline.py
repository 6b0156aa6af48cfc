"""The pipeline's stages: their columns, their decisions against plain versions, and odd input."""

import pytest
from test_llm_operators import none, odd, long_text  # noqa: F401
from test_llm_queries import plain_fingerprint, plain_groups

import corpus_pipeline as pipeline
from martloom.llm import toxicity


@pytest.fixture(scope="module")
def passed(spark, sf_dir, tmp_path_factory):
    """Input and output of each stage, written and read again."""
    folder, out = tmp_path_factory.mktemp("stages"), []
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in pipeline.STAGES:
        path = str(folder / name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def test_stages_keep_the_columns(passed):
    assert [n for n, _, _ in passed] == [n for n, _ in pipeline.STAGES]
    for _, before, after in passed[:-1]:
        assert before.columns == after.columns
        assert [t for _, t in before.dtypes] == [t for _, t in after.dtypes]
        assert 0 < after.count() <= before.count()


def test_toxic_documents_go(spark, sf_dir, passed):
    _, before, after = passed[0]
    model = toxicity.fit(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    score = model.scorer()
    want = {r.doc_id for r in before.collect() if score(r.text) < toxicity.THRESHOLD}
    assert {r.doc_id for r in after.collect()} == want


def test_spread_lines_stay_once(passed):
    _, before, after = passed[1]
    rows = sorted(before.collect(), key=lambda r: r.doc_id)
    sites, first = {}, {}
    for r in rows:
        for i, line in enumerate(r.text.split("\n")):
            line = line.strip(" \t\r\f\x0b")
            if len(line.split()) >= 3:
                sites.setdefault(line, set()).add(r.source)
                first.setdefault(line, (r.doc_id, i))
    want = {}
    for r in rows:
        left = [
            raw
            for i, raw in enumerate(r.text.split("\n"))
            for line in [raw.strip(" \t\r\f\x0b")]
            if len(sites.get(line, ())) < 10 or first[line] == (r.doc_id, i)
        ]
        want[r.doc_id] = "\n".join(left)
    got = {r.doc_id: r for r in after.collect()}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for i, r in got.items() if r.text != dict((x.doc_id, x.text) for x in rows)[i])


def test_one_document_of_each_group_stays(passed):
    _, before, after = passed[2]
    fps = {r.doc_id: plain_fingerprint(r.text) for r in before.collect()}
    groups = plain_groups(fps, lambda a, b: (fps[a] ^ fps[b]).bit_count() <= 2)
    assert {r.doc_id for r in after.collect()} == set(groups.values())


def test_mixing_and_encoding(passed):
    _, before, after = passed[3]
    assert {r.doc_id for r in after.collect()} < {r.doc_id for r in before.collect()}
    _, before, after = passed[4]
    assert after.count() == before.count()
    assert all(r.sp_exact and len(r.sp_ids) == r.sp_n for r in after.collect())


def test_run_gives_the_same(spark, sf_dir, passed):
    rows = {(r.doc_id, r.sp_digest) for r in pipeline.run(spark, sf_dir).collect()}
    assert rows == {(r.doc_id, r.sp_digest) for r in passed[-1][2].collect()}


def test_stages_take_odd_rows(spark, sf_dir, odd, none):  # noqa: F811
    for docs in (odd, none):
        for _, stage in pipeline.STAGES:
            assert stage(spark, docs, sf_dir).count() <= docs.count()
