"""The tree of merges against plain Python, and rows that may go wrong."""

import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from forgelake.llm import exact_dedup


def plain(rows):
    """(doc_id, keep_id, group_size, text_sha256) of each row, and which ids stay how often."""
    members = defaultdict(list)
    for doc_id, text in rows:
        members[re.sub(r"[\x20\x09-\x0D]+", " ", text or "")].append(doc_id)
    out, stay = Counter(), Counter()
    for text, ids in members.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        stay[keep] += 1
        for i in ids:
            out[i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()] += 1
    return out, stay


def found(docs, rounds=None):
    rows = exact_dedup.groups(docs, ["doc_id"], rounds).collect()
    return Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), Counter(r.doc_id for r in rows if r.kept)


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(odd) == plain(rows)
    assert exact_dedup.groups(empty, ["doc_id"]).collect() == []
    kept = exact_dedup.deduplicated(odd)
    assert kept.columns == odd.columns and Counter(r.doc_id for r in kept.collect()) == plain(rows)[1]
    assert exact_dedup.deduplicated(empty).collect() == []


@pytest.mark.parametrize("rounds", [1, 2, 4])
def test_any_number_of_rounds_with_a_hot_text(spark, rounds):
    rows = [(i, "the  hot\ttext" if i % 3 == 0 else f"text {i % 41}{' ' * (i % 4)}end") for i in range(900, 0, -1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert found(docs, rounds) == plain(rows)


def test_no_node_gets_more_than_its_share(spark):
    """A third of the rows are copies: after the first merge they are a row per node."""
    docs = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("text")
    )
    rows = exact_dedup.digested(docs, ["doc_id"])
    dealt = rows.groupBy(F.pmod(F.xxhash64("number"), F.lit(16))).count().collect()
    assert max(r["count"] for r in dealt) < 2 * 6000 / 16
    tree = exact_dedup.tree_merged(rows, 2)
    assert tree.count() == 4001 and tree.agg(F.sum("copies"), F.max("copies")).first()[:] == (6000, 2000)


def test_each_round_is_one_exchange_and_one_sort(spark, documents):
    rows = exact_dedup.digested(documents, ["doc_id"])
    text = exact_dedup.tree_merged(rows, 3)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == text.count("Sort [") == 4
    assert "Python" not in text


def test_a_second_hash_keeps_texts_apart(spark):
    """Rows whose digests agree and whose lengths do not are not equal."""
    rows = spark.createDataFrame(
        [(1, 0, b"x", 5, 9), (2, 1, b"x", 5, 9), (3, 2, b"x", 6, 9), (4, 3, b"x", 5, 8)],
        "id long, number long, digest binary, n_bytes long, second_hash long",
    )
    got = sorted((r.smallest.id, r.copies) for r in exact_dedup.tree_merged(rows, 1).collect())
    assert got == [(1, 2), (3, 1), (4, 1)]
