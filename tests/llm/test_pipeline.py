"""The corpus pipeline: columns, effect of each stage, and its result against the stages by brute force."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_duplicates import brute_groups, brute_lines

from llm.common import shared_folder, stored, table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = table(spark, SF, "documents")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SF), name)
        out.append((name, docs))
    return out


def test_stages_keep_the_columns(steps):
    assert [n for n, _ in steps[1:]] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    for _, docs in steps[:-1]:
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_stage_drops_junk_and_keeps_clean(spark, steps):
    kept = {r["doc_id"] for r in steps[1][1].collect()}
    labels = table(spark, SF, "labels").collect()
    good, bad = [r["doc_id"] in kept for r in labels if r["quality"] == 1], [r["doc_id"] in kept for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.3 * len(bad)


def test_middle_stages_equal_brute_force(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[1][1].collect()]
    lined = sorted((d, k) for d, _, _, k in brute_lines(rows))
    assert sorted((r["doc_id"], r["text"]) for r in steps[2][1].collect()) == lined
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2][1].collect())
    first = sorted(d for d, _, g in brute_groups(lined) if d == g)
    assert sorted(r["doc_id"] for r in steps[3][1].collect()) == first


def test_leaks_go(spark, steps):
    items = [r["text"] for r in table(spark, SF, "benchmark").collect()]
    before, after = steps[3][1].collect(), {r["doc_id"] for r in steps[4][1].collect()}
    for r in before:
        if any(i in r["text"] for i in items):
            assert r["doc_id"] not in after
    assert len(after) > 0.8 * len(before)


def test_run_equals_the_stages(spark, steps):
    found = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(map(tuple, steps[-1][1].collect()), key=repr)


@pytest.mark.parametrize("name", ["quality", "line_dedup", "near_dedup", "decontamination"])
def test_stages_on_odd_rows(spark, odd_docs, no_docs, name):
    """Nulls, empty and very long texts, repeated rows, a null id, and columns with clashing or odd names."""
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = odd_docs.withColumn("a.b", F.lit(1)).withColumn("_row", F.lit("x")).withColumn("class_id", F.lit(2)).withColumn("leaked", F.lit(3))
    found = stored(stage(spark, docs, SF).select(*[f"`{c}`" for c in docs.columns if "." not in c]), "odd")
    assert stage(spark, docs, SF).columns == docs.columns
    rows = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in found.collect())
    given = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in docs.collect())
    if name == "near_dedup":
        # Null text is empty text; 5 and 6 are equal, and 5 is there twice; the null id is in no group.
        assert [(none, i) for none, i, _ in rows] == [(False, i) for i in (0, 2, 3, 4, 5, 7, 8)] + [(True, 0)]
    elif name == "decontamination":
        assert rows == given
    elif name == "line_dedup":
        assert [r[:2] for r in rows] == [r[:2] for r in given] and {r["text"] for r in found.collect() if r["doc_id"] == 0} == {None}
    else:
        assert set(rows) <= set(given)
    assert stage(spark, no_docs, SF).count() == 0


def test_packing_stage_on_odd_rows(spark, odd_docs, no_docs):
    pieces = corpus_pipeline.pack(spark, odd_docs, SF).collect()
    assert {r["doc_id"] for r in pieces} == {r["doc_id"] for r in odd_docs.collect()}
    assert corpus_pipeline.pack(spark, no_docs, SF).count() == 0


def test_scratch_folder_follows_the_session(spark):
    assert shared_folder(spark) == shared_folder(spark)
    spark.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
