"""Odd rows, empty tables and foreign columns in every operator and stage."""

from collections import Counter

import pytest
from compare import difference, duck
from pyspark.sql import functions as F

import corpus_pipeline
from forgelake.llm import (
    decontamination,
    language_id,
    license_scan,
    mixing,
    quality,
    registry,
    simhash,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)

PATH = pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def others(spark, sf_dir):
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("benchmark", "labels", "pages")}


def per_row(others):
    return {
        "suffix_dedup": suffix_dedup.summary,
        "language_id": language_id.identified,
        "token_counts": lambda d: token_counts.token_counts(d, PATH),
        "decontamination": lambda d: decontamination.contamination(d, others["benchmark"]),
        "quality": lambda d: quality.verdicts(d, ["doc_id"]),
        "license_scan": license_scan.scanned,
        "toxicity": lambda d: toxicity.scored(d, others["labels"]),
        "simhash": simhash.groups,
    }


NAMES = ["suffix_dedup", "language_id", "token_counts", "decontamination", "quality", "license_scan", "toxicity", "simhash"]


@pytest.mark.parametrize("name", NAMES)
def test_each_odd_row_gets_a_result(odd, others, name):
    rows = per_row(others)[name](odd).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in odd.select("doc_id").collect())
    again = [tuple(r) for r in rows if r.doc_id == 5]
    assert again[0] == again[1]


@pytest.mark.parametrize("name", NAMES)
def test_an_empty_table_gives_an_empty_result(empty, others, name):
    assert per_row(others)[name](empty).collect() == []


def test_defined_results_of_odd_rows(odd, others):
    def by_id(rows, *columns):
        return {r.doc_id: tuple(r[c] for c in columns) for r in rows.collect() if r.doc_id is not None}

    found = by_id(token_counts.token_counts(odd, PATH), "n_bytes", "n_tokens", "over_limit")
    assert found[1] == found[2] == (0, 0, False) and found[3][1] == 0 and found[6][2]
    found = by_id(language_id.identified(odd), "lang_pred", "score")
    assert found[1] == found[2] == found[3] == found[10] == ("und", 0.0)
    found = by_id(simhash.groups(odd), "fp", "component_id")
    assert found[1] == found[2] == found[3] == (0, 1) and found[4] == found[5] and found[5][1] == 4
    found = by_id(suffix_dedup.summary(odd), "n_bytes", "n_removed")
    assert found[1] == found[2] == (0, 0) and found[6][1] > 0 and found[7][0] - found[7][1] <= 4
    found = by_id(decontamination.contamination(odd, others["benchmark"].limit(0)), "n_hit", "contaminated")
    assert set(found.values()) == {(0, False)}
    found = by_id(quality.verdicts(odd, ["doc_id"]), "n_words", "base_failed", "kept")
    assert found[1] == found[2] == found[3] == (0, True, False)


def test_nothing_to_learn_from(odd, others):
    blind = odd.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in language_id.identified(blind).collect()} == {("und", 0.0)}
    rows = toxicity.scored(odd, others["labels"].limit(0)).collect()
    assert len({r.score for r in rows}) == 1 and {r.n_matches for r in rows} == {0}


def test_pages_may_be_absent(spark, others):
    from forgelake.llm.common import scratch

    path = scratch(spark, "none")
    warc.write_warc(others["pages"].limit(0), path)
    assert warc.revisits(warc.read_warc(spark, path)).collect() == []


def test_mixing_keeps_columns(odd, empty):
    rows = mixing.mixed(odd)
    assert rows.columns == [*[c for c in odd.columns if c != "mean"], "mean", "copy", "place"]
    assert Counter(r.doc_id for r in rows.collect() if r.doc_id == 5)[5] % 2 == 0
    assert mixing.mixed(empty).collect() == []


@pytest.mark.parametrize("stage", [s for s, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_no_rows(spark, odd, empty, sf_dir, stage):
    run = dict(corpus_pipeline.STAGES)[stage]
    out = run(spark, odd, sf_dir)
    assert set(odd.columns) <= set(out.columns)
    if stage != "mixing":
        assert out.columns == odd.columns and out.dtypes == odd.dtypes
    out.collect()
    assert run(spark, empty, sf_dir).collect() == []


def test_one_row_of_a_group_stays(spark, odd, sf_dir):
    rows = dict(corpus_pipeline.STAGES)["simhash_near_dedup"](spark, odd, sf_dir).collect()
    ids = Counter(r.doc_id for r in rows)
    assert ids[5] == 0 and ids[4] == 1 and ids[1] == 1 and ids[2] == ids[3] == 0 and ids[None] == 1


def test_pipeline_is_its_stages(spark, sf_dir, documents):
    expected = documents
    verdict = {r.doc_id for r in quality.verdicts(documents, ["doc_id"]).collect() if r.kept}
    expected = documents.filter(F.col("doc_id").isin(verdict))
    first = {r.component_id for r in simhash.groups(expected).collect()}
    expected = expected.filter(F.col("doc_id").isin(first))
    gone = {r.doc_id: r.n_removed for r in suffix_dedup.summary(expected).collect()}
    expected = suffix_dedup.without_repeats(expected).cache()
    for r in expected.collect():
        assert len(r.text) == r.n_chars and (gone[r.doc_id] > 0 or r.text)
    bad = {r.doc_id for r in decontamination.contamination(expected, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).collect() if r.contaminated}
    expected = mixing.mixed(expected.filter(~F.col("doc_id").isin(bad)) if bad else expected)
    got = corpus_pipeline.run(spark, sf_dir)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    assert difference(registry.QUERIES[name](spark, sf_dir), duck(sf_dir), registry.ORACLES[name]) == ""


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
