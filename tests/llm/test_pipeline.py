from __future__ import annotations

from collections import Counter

import pytest
from test_jaccard_join import brute_force
from test_lines_and_mixing import kept_lines
from test_packing import check

import corpus_pipeline
from hearthline.llm import mixing, toxicity
from hearthline.llm.common import table

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, small, tmp_path_factory):
    """What each stage is given and returns, written in between as the driver does."""
    docs, out = table(spark, small, "documents"), []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(k))
        stage(spark, docs, small).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((name, docs, after))
        docs = after
    return out


def rows(df):
    return Counter(tuple(r) for r in df.select(*NAMES).collect())


def test_columns_stay(steps):
    for _, _, after in steps[:-1]:
        assert after.columns == NAMES


def test_toxic_documents_go(spark, small, steps):
    _, before, after = steps[0]
    rejected = {r["doc_id"] for r in toxicity.graded(before, table(spark, small, "labels")).where("rejected").collect()}
    assert rows(after) == Counter(r for r in rows(before).elements() if r[0] not in rejected)


def test_common_lines_go(steps):
    _, before, after = steps[1]
    kept = kept_lines([(r[0], r[1]) for r in rows(before).elements()], 10, False)
    want = Counter()
    for doc_id, text, lang, source, n_chars in rows(before).elements():
        new = kept[doc_id, text]
        want[doc_id, new, lang, source, n_chars if new == text else len(new)] += 1
    assert rows(after) == want


def test_one_of_each_group_stays(steps):
    _, before, after = steps[2]
    docs = [(r[0], r[1]) for r in rows(before).elements()]
    stays = {id for id, n, least in brute_force(docs, 5, 80) if not n or id == least}
    assert rows(after) == Counter(r for r in rows(before).elements() if r[0] in stays)


def test_mix_takes_what_the_operator_says(steps):
    _, before, after = steps[3]
    times = {r["id"]: -(-r["taken"] // r["size"]) for r in mixing.mix(before).collect() if r["taken"]}
    want = Counter()
    for r, n in rows(before).items():
        want[r] += n * times.get(r[0], 0)
    assert rows(after) == +want


def test_all_that_is_kept_is_packed(steps):
    _, before, after = steps[4]
    pieces = after.withColumnsRenamed({"doc_id": "id", "doc_tokens": "n_tokens"}).collect()
    check(pieces, [(r[0], r[1]) for r in rows(before).elements()], 1024)


def test_run_is_all_stages(spark, small, steps):
    got = corpus_pipeline.run(spark, small)
    assert got.columns == steps[4][2].columns
    columns = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    assert got.agg({"length": "sum"}).first() == steps[4][2].agg({"length": "sum"}).first()
    assert set(got.columns) >= set(columns)


@pytest.mark.parametrize("stage", [s for _, s in corpus_pipeline.STAGES], ids=[n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_empty_and_awkward_tables(spark, small, stage):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    awkward = [(None, None, None, None, None), (1, "", "en", "a", 0), (2, "x y", "en", None, 3), (2, "x y", "en", None, 3), (3, "w " * 30_000, "en", "b", 60_000)]
    assert stage(spark, spark.createDataFrame([], schema), small).collect() == []
    assert len(stage(spark, spark.createDataFrame(awkward, schema), small).collect()) >= 3
