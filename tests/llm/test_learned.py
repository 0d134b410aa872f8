"""Operators that learn: held-out accuracy, and exact tests of their parts."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from forgelake.llm import language_id, license_scan, toxicity
from forgelake.llm.id_filter import id_filter, may_hold
from forgelake.llm.linear import FollowTheLeader, Settings, softmax, temperature

MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def medium(spark):
    return spark.read.parquet(f"{MEDIUM}/documents.parquet").cache()


def test_languages_of_held_out_documents(medium):
    rows = language_id.identified(medium).collect()
    lang = {r.doc_id: r.lang for r in medium.collect()}
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_a_prediction_does_not_see_its_label(medium):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    blind = medium.withColumn("lang", F.when(fold != 1, F.col("lang")))
    swapped = medium.withColumn("lang", F.when(fold != 1, F.col("lang")).otherwise("xx"))
    a, b = (sorted(map(tuple, language_id.identified(d).collect())) for d in (blind, swapped))
    assert a == b


def test_the_table_is_not_read_by_one_task(medium, monkeypatch):
    def narrowed(self, n):
        raise AssertionError("coalesce carries its scan into one task")

    monkeypatch.setattr(type(medium), "coalesce", narrowed)
    assert language_id.identified(medium.limit(300)).count() == 300


def test_ngrams_do_not_cross_texts():
    alone = [language_id.vectors([t])[0] for t in ("abc", "", "Zürich", "d")]
    together = language_id.vectors(["abc", "", "Zürich", "d"])
    for (x, v), (y, w) in zip(alone, together):
        assert x.tolist() == y.tolist() and np.allclose(v, w)


def test_regression_is_sparse_and_right():
    r = np.random.default_rng(2)
    rows = []
    for _ in range(1500):
        x = np.sort(r.choice(200, 12, replace=False))
        rows.append((x, np.ones(12), int(sum(x < 20) > sum((x >= 20) & (x < 40)))))
    w = FollowTheLeader(2, 200, Settings(alpha=0.3, l1=6, l2=0.1, epochs=8)).fit(rows[:1000]).weights()
    logits = np.array([v @ w[x] + w[-1] for x, v, _ in rows[1000:]])
    labels = np.array([y for _, _, y in rows[1000:]])
    assert (logits.argmax(1) == labels).mean() > 0.9
    assert (w[40:-1] == 0).mean() > 0.3 and (w[:40] != 0).all()


def test_temperature_cools_what_is_too_sure():
    r = np.random.default_rng(5)
    logits = r.normal(size=(4000, 3))
    labels = np.array([r.choice(3, p=p) for p in softmax(logits)])
    assert temperature(4 * logits, labels) == pytest.approx(4, rel=0.2)


# --- toxicity --------------------------------------------------------------------------------

def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_automaton_accepts_what_is_one_edit_away():
    words, stems = ["idiot", "stupid", "scum", "clown", "losers"], ["lowe", "véqu"]
    automaton = toxicity.compiled(words, stems)
    r = random.Random(8)
    tried = []
    for w in [*words, *stems, "lower"]:
        for _ in range(300):
            v = list(w)
            for _ in range(r.randint(0, 2)):
                i = r.randrange(len(v) + 1)
                v = r.choice([v[:i] + [r.choice("abcdiotuzé")] + v[i:], v[:i] + v[i + 1 :], v[:i] + ["x"] + v[i + 1 :]])
            if v:
                tried.append("".join(v))
    sizes = np.array([len(w) for w in tried])
    codes = np.frombuffer("\n".join(tried).encode("utf-32-le"), np.uint32)
    result, stem = toxicity.matches(automaton, codes, np.r_[0, np.cumsum(sizes + 1)[:-1]], sizes)
    for w, got, begins in zip(tried, result, stem):
        near = any(len(t) >= 5 and distance(w, t) <= 1 for t in words)
        assert got == (2 if w in words else 1 if near else 0)
        assert begins == any(w.startswith(s) for s in stems)


def test_quotations_are_told_from_abuse():
    automaton = toxicity.compiled(["idiot", "stupid"], [])
    name = toxicity.FEATURES.index
    rows = toxicity.features(
        ["you idiot", 'the word "idiot" is rude', "she said idiot", 'he "left" and the idiot "ran"', "idjot stupid", ""], automaton
    )
    assert rows[0][name("exact")] > 0 and rows[0][name("quoted")] == 0
    assert rows[1][name("quoted")] > 0 and rows[1][name("exact")] == 0
    assert rows[2][name("quoted")] > 0
    assert rows[3][name("exact")] > 0
    assert rows[4][name("misspelled")] > 0 and rows[4][name("clustered")] > 0
    assert not rows[5].any()


def test_toxic_documents_of_the_held_out_fold(spark, medium):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.scored(medium, labels).collect() if r.doc_id in truth and r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    found = Counter((truth[r.doc_id], r.predicted) for r in rows)
    # at this size, the words of some languages stand in too few labelled texts
    assert found[0, 1] <= 2 and found[1, 1] >= 0.5 * (found[1, 0] + found[1, 1])


def marked_documents(spark, clean, toxic):
    """Documents and labels; ``toxic`` tells the words that are set into the prose of the n-th toxic text."""
    r = random.Random(11)
    prose = lambda: [r.choice(["river", "garden", "window", "simple", "letter", "number", "yellow", "house"]) for _ in range(30)]
    rows = [(i, " ".join(prose()), 0) for i in range(clean)]
    for i, extra in enumerate(toxic, clean):
        words = prose()
        words[10:10] = extra
        rows.append((i, " ".join(words), 1))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int").repartition(4)
    return df.select("doc_id", "text"), df.select("doc_id", "toxic")


def test_misspelled_terms_are_found_without_a_right_one(spark):
    # edits within the first four letters, so that no stem matches them
    wrong = [w[:k] + c + w[k + 1 :] for w in ("idiot", "stupid", "pathetic") for k in (1, 2, 3) for c in "qxwzkj"]
    toxic = [[wrong[i // 4 % len(wrong)]] if i % 4 == 0 else [("idiot", "stupid", "pathetic")[i % 3]] for i in range(400)]
    docs, labels = marked_documents(spark, 800, toxic)
    got = {r.doc_id: r for r in toxicity.scored(docs, labels).collect()}
    held = [i for i in range(800, 1200) if (i - 800) % 4 == 0 and zlib.crc32(str(i).encode()) % 4 == 2]
    assert len(held) > 10
    assert all(got[i].n_matches == 1 and got[i].predicted == 1 for i in held)
    assert not any(got[i].predicted for i in range(800))


def test_rare_terms_enter_beside_common_ones(spark):
    # "moron" stands in 0.8 % of the toxic texts, always beside three common terms
    common = ["idiot", "stupid", "pathetic"]
    toxic = [[*common, "moron"] if i % 130 == 0 else common for i in range(8000)]
    docs, labels = marked_documents(spark, 8000, toxic)
    alone = spark.createDataFrame([(10_000, "river garden moron window " * 2)], "doc_id long, text string")
    got = {r.doc_id: r for r in toxicity.scored(docs.union(alone), labels).collect()}
    assert got[10_000].n_matches == 2
    assert not any(got[i].n_matches for i in range(8000))


def test_copies_of_a_text_count_once(spark):
    copies = [["quiet", "evening"] for _ in range(60)]
    docs, labels = marked_documents(spark, 800, [["idiot"]] * 200 + copies)
    same = docs.withColumn("text", F.when(F.col("doc_id") < 1000, F.col("text")).otherwise("a quiet evening at home"))
    assert toxicity.lexicon(same, toxicity.labelled(labels))[0] == ["idiot"]


def plain_counts(rows, labels):
    """(a, b) per term over the distinct labelled texts outside the held-out fold."""
    label = {}
    for i, mark in labels:
        label[i] = max(mark, label.get(i, 0))
    texts = {}
    for i, text in rows:
        if i in label and zlib.crc32(str(i).encode()) % 4 != 2:
            texts[text] = max(label[i], texts.get(text, 0))
    counts = Counter()
    for text, mark in texts.items():
        words = {w for w in re.split(r"[\W_]+", text.lower()) if w}
        for term in words | {w[:k] + "*" for w in words for k in toxicity.STEMS if len(w) > k}:
            counts[term, mark] += 1
    return {t: (counts[t, 1], counts[t, 0]) for t, _ in counts}, Counter(texts.values())


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("scouts", [1, 8, 1000])
def test_counts_of_terms_equal_plain_code(spark, medium, monkeypatch, broadcast, scouts):
    monkeypatch.setattr(toxicity, "MAP_BYTES", 1 << 25 if broadcast else -1)
    monkeypatch.setattr(toxicity, "SCOUTS", scouts)
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet").select("doc_id", "toxic")
    # every third row twice, and some labels twice
    docs = medium.select("doc_id", "text").union(medium.filter("doc_id % 3 = 0").select("doc_id", "text"))
    labels = labels.union(labels.filter("doc_id % 5 = 0"))
    known = toxicity.labelled(labels)
    counts, marks = toxicity.term_counts(docs, known)
    want, size = plain_counts([tuple(r) for r in docs.collect()], [tuple(r) for r in labels.collect()])
    got = {r.term: (r.a, r.b) for r in counts.collect()}
    assert all(want[t] == n for t, n in got.items())

    def sure(a, b):
        odds = math.log((a + 0.5) / (size[1] + 1 - a)) - math.log((b + 0.5) / (size[0] + 1 - b))
        base = size[1] / (size[0] + size[1])
        chance = a * math.log(a / (a + b) / base) + (b * math.log(b / (a + b) / (1 - base)) if b else 0) if a else 0
        return a >= toxicity.LEAST_TEXTS and odds - math.sqrt(1 / (a + 0.5) + 1 / (b + 0.5)) >= toxicity.LEAST_LOG_ODDS and (
            chance >= math.log(sum(1 for x, _ in want.values() if x)))

    assert {r.term for r in counts.filter(marks).collect()} == {t for t, (a, b) in want.items() if sure(a, b)} != set()


def test_rows_given_twice_change_no_score(spark):
    docs, labels = marked_documents(spark, 300, [["scum", "idiot"] if i % 2 else ["idiot"] for i in range(150)])
    once = {r.doc_id: r.score for r in toxicity.scored(docs, labels).collect()}
    known = toxicity.labelled(labels)
    twice = docs.union(docs)
    assert toxicity.lexicon(twice, known) == toxicity.lexicon(docs, known)
    assert toxicity.lexicon(docs, known)[0] == ["idiot", "scum"]
    again = {r.doc_id: r.score for r in toxicity.scored(twice, labels.union(labels)).collect()}
    assert all((again[i] >= 0.3) == (s >= 0.3) for i, s in once.items())


def test_short_terms_mark_too(spark):
    docs, labels = marked_documents(spark, 800, [["ugh"]] * 400)
    distinct = docs.withColumn("text", F.concat("text", F.lit(" "), F.col("doc_id").cast("string")))
    got = {r.doc_id: r.predicted for r in toxicity.scored(distinct, labels).collect()}
    held = [i for i in range(800, 1200) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert all(got[i] == 1 for i in held) and not any(got[i] for i in range(800))


def test_a_filter_of_ids_denies_nothing_that_is_in_it(spark):
    ids = spark.range(0, 30_000, 3).select(F.col("id").alias("id"))
    rows = spark.range(60_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("f")).union(
        spark.createDataFrame([(None, "x")], "doc_id long, f string"))
    found = {r.doc_id for r in may_hold(rows, id_filter(ids, "id"), "doc_id").collect()}
    assert set(range(0, 30_000, 3)) <= found and None not in found and len(found) < 10_000 + 200
    assert id_filter(ids, "id").count() <= 512
    assert may_hold(rows, id_filter(ids.limit(0), "id"), "doc_id").isEmpty()


def test_scores_do_not_see_held_out_labels(spark, medium):
    labels = spark.read.parquet(f"{MEDIUM}/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    other = labels.withColumn("toxic", F.when(fold == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = (sorted(map(tuple, toxicity.scored(medium, x).collect())) for x in (labels, other))
    assert a == b


# --- licences --------------------------------------------------------------------------------

#: As they stand in the documents.
LINES = {
    "This work is licensed under the GNU General Public License, version 3.": "GPL",
    "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
    "Released under the MIT License.": "MIT",
    "Licensed under the Apache License, Version 2.0.": "Apache",
}


def test_licences_of_documents(medium):
    docs = {r.doc_id: r.text for r in medium.collect()}
    for r in license_scan.scanned(medium).collect():
        want = sorted({family for line, family in LINES.items() if line in docs[r.doc_id]})
        assert r.licenses == ",".join(want)
        assert r.n_license == sum(line in LINES for line in docs[r.doc_id].split("\n"))
        assert (r.score >= license_scan.LEAST_SCORE) == bool(want)


def test_every_family_is_found_in_other_words(spark, medium):
    rows = [(i, f"Some words before. {t} and some words after it", f) for i, (f, t) in enumerate(
        (f, t) for f, ts in license_scan.TEMPLATES.items() for t in ts
    )]
    rows += [(1000 + i, t, "") for i, t in enumerate(license_scan.OTHER)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    want = {r[0]: r[2] for r in rows}
    both = df.union(medium.select(F.col("doc_id") + 10_000, "text"))
    got = {r.doc_id: r.licenses for r in license_scan.scanned(both).collect()}
    right = [got[i] == want[i] for i in want]
    assert np.mean(right) > 0.9
    assert all(got[i] == "" for i in want if i >= 1000)


#: Notices of two families, and notices that have words of another family in common.
NOTICES = {
    "Licensed under either of the Apache License, Version 2.0 or the MIT license at your option.": "Apache,MIT",
    "Dual licensed under the MIT license and the GNU General Public License, version 3.": "GPL,MIT",
    "It is available under the Apache License, Version 2.0 and also under the MIT license.": "Apache,MIT",
    "You may use it as licensed under the MIT license or licensed under the BSD 3-Clause License.": "BSD,MIT",
    "under the terms of the GNU Lesser General Public License": "LGPL",
    "GNU Affero General Public License as published by the Free Software Foundation": "AGPL",
    "Licensed under CC BY-SA 4.0": "CC-BY-SA",
    "Licensed under the Apache License, Version 2.0.": "Apache",
}


def test_notices_that_name_two_licences(spark, medium):
    rows = list(enumerate(f"The parts were written by many. {t}" for t in NOTICES))
    both = spark.createDataFrame(rows, "doc_id long, text string").union(medium.select(F.col("doc_id") + 10_000, "text"))
    got = {r.doc_id: r for r in license_scan.scanned(both).collect()}
    assert {t: got[i].licenses for i, t in enumerate(NOTICES)} == NOTICES
    assert all(got[i].n_license == 1 for i, _ in rows)
