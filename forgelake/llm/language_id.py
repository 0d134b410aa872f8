"""Language identification from character n-grams.

A text is the relative frequencies of its n-grams of one to three characters, hashed to a fixed
number of buckets and weighted by inverse document frequency over all labelled texts. A sparse
multinomial logistic regression scores the languages, and a temperature fitted on texts outside
its training makes the scores probabilities. Every pass goes through whole texts in arrays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import slices, table, text_or_empty
from forgelake.llm.linear import FollowTheLeader, softmax, temperature

FOLDS, HELD_OUT = 3, 1
ORDERS = (1, 2, 3)
BUCKETS = 1 << 16
#: Labelled texts that the regression is fitted on, over all languages; every fifth calibrates.
SAMPLE_ROWS = 3000
#: Relative frequencies in percent, so that the penalties have a fixed meaning.
SCALE = 100.0
#: N-grams that every text is taken to have besides its own, in no bucket: short texts say less.
PRIOR = 30
UNKNOWN = "und"
SLICE_BYTES = 1 << 20
SLICE_ROWS = 256

LETTER = regex.compile(r"\p{L}")


def fold(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def blocks(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Texts in groups whose arrays stay small: (index of the first, texts)."""
    for first, last in slices(texts, SLICE_BYTES):
        for a in range(first, last, SLICE_ROWS):
            yield a, texts.slice(a, min(SLICE_ROWS, last - a)).to_pylist()


def ngrams(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per order: buckets, whether an n-gram begins there, and where each text begins."""
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    sizes = np.array([len(c) for c in codes])
    starts = np.r_[0, np.cumsum(sizes)][:-1]
    chars = np.concatenate(codes) if len(codes) else np.zeros(0, np.uint32)
    left = np.repeat(starts + sizes, sizes) - np.arange(len(chars))  # characters to the text's end
    padded = np.r_[chars, np.zeros(max(ORDERS), np.uint32)]
    for order in ORDERS:
        code = np.full(len(chars), order, np.uint32)
        for k in range(order):
            code = code * np.uint32(0x01000193) + padded[k : k + len(chars)]
        code = (code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77)
        yield (code >> np.uint32(16)), left >= order, starts


def document_frequency(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Texts that have each bucket, and texts: at most BUCKETS + 1 rows come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, np.int64)
        for batch in batches:
            for _, texts in blocks(batch.column(0)):
                seen = np.zeros((len(texts), BUCKETS), bool)
                for code, valid, starts in ngrams(texts):
                    doc = np.searchsorted(starts, np.arange(len(code)), "right") - 1
                    seen[doc[valid], code[valid]] = True
                total[:-1] += seen.sum(0)
                total[-1] += len(texts)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    rows = docs.select(text_or_empty().alias("text")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(BUCKETS + 1, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        out[row.bucket] = row.n
    return out[:-1], int(out[-1])


def vectors(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """Buckets and their relative frequencies in percent, per text."""
    parts = [(code[valid], np.searchsorted(starts, np.flatnonzero(valid), "right") - 1)
             for code, valid, starts in ngrams(texts)]
    code, doc = (np.concatenate(x) for x in zip(*parts))
    out = []
    for i in range(len(texts)):
        index, times = np.unique(code[doc == i], return_counts=True)
        out.append((index.astype(np.int64), SCALE * times / (times.sum() + PRIOR)))
    return out


def trained(sample: DataFrame, langs: list[str], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Weights (buckets x languages) on relative frequencies, intercepts, temperature."""

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch.column(1)):
                found = vectors(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, len(texts)), batch.column(2).slice(first, len(texts)),
                        pa.array([i.astype(np.int32) for i, _ in found], pa.list_(pa.int32())),
                        pa.array([v.astype(np.float32) for _, v in found], pa.list_(pa.float32())),
                    ],
                    names=["lang", "key", "at", "value"],
                )

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = []
        for batch in batches:
            at, value = batch.column(2), batch.column(3)
            for i, (lang, key) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                index = at[i].values.to_numpy()
                rows.append((key, langs.index(lang), index, value[i].values.to_numpy().astype(float) * idf[index]))
        rows.sort(key=lambda r: r[0])
        kept = [(x, v, y) for k, (_, y, x, v) in enumerate(rows) if k % 5]
        model = FollowTheLeader(len(langs), BUCKETS).fit(kept)
        w = model.weights()
        other = [(x, v, y) for k, (_, y, x, v) in enumerate(rows) if k % 5 == 0]
        logits = np.array([v @ w[x] + w[-1] for x, v, _ in other]).reshape(-1, len(langs))
        t = temperature(logits, np.array([y for _, _, y in other], int))
        out = np.vstack([w[:-1] * idf[:, None], w[-1:]]).astype(np.float32)
        yield pa.RecordBatch.from_arrays(
            [pa.array([out.tobytes()], pa.binary()), pa.array([t], pa.float64())], names=["weights", "temperature"]
        )

    rows = sample.select("lang", text_or_empty().alias("text"), F.xxhash64("doc_id").alias("key"))
    one = rows.mapInArrow(features, "lang string, key long, at array<int>, value array<float>")
    # a shuffle of the drawn rows only: coalesce would read the whole table in one task
    found = one.repartition(1).mapInArrow(train, "weights binary, temperature double").collect()
    if not found:
        return np.zeros((BUCKETS, len(langs)), np.float32), np.zeros(len(langs), np.float32), 1.0
    w = np.frombuffer(bytes(found[0].weights), np.float32).reshape(BUCKETS + 1, len(langs))
    return w[:-1], w[-1], found[0].temperature


def identified(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score per row.

    Learns from rows outside the held-out fold that have a lang and a doc_id: document
    frequencies from all of them, the regression from a sample of about ``sample_rows``, spread
    evenly over the languages. A text that is NULL or has no letter is ``und`` with score 0, as
    is every text if there is nothing to learn from. A NULL doc_id is not held out. Repeated rows
    are scored alike; only doc_id, text and lang are used.
    """
    known = docs.filter((fold() != HELD_OUT) & F.col("lang").isNotNull())
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").collect()}
    langs = list(sizes)
    share = max(sample_rows // max(len(langs), 1), 1)
    wanted = F.lit(0.0)
    for lang in langs:
        wanted = F.when(F.col("lang") == lang, F.lit(min(1.0, share / sizes[lang]))).otherwise(wanted)
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("language sample")), F.lit(1_000_000)) / 1_000_000
    if langs:
        frequency, n = document_frequency(known.select("text"))
        idf = np.log((1 + n) / (1 + frequency)) + 1
        weights, bias, t = trained(known.filter(drawn < wanted), langs, idf)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in blocks(batch.column(2)):
                names, scores = best(texts)
                ids = [batch.column(k).slice(first, len(texts)) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [*ids, pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "held_out", "lang_pred", "score"],
                )

    def best(texts: list[str]) -> tuple[list[str], list[float]]:
        lettered = [LETTER.search(x) is not None for x in texts]
        if not langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        texts = [x if ok else " " for x, ok in zip(texts, lettered)]
        total, count = np.zeros((len(texts), len(langs))), np.zeros(len(texts))
        for code, valid, starts in ngrams(texts):
            part = weights[code]
            part[~valid] = 0
            total += np.add.reduceat(part, starts, axis=0)
            count += np.add.reduceat(valid.astype(np.int64), starts)
        p = softmax((total * (SCALE / (count + PRIOR))[:, None] + bias) / t)
        pick = p.argmax(1)
        return (
            [langs[k] if ok else UNKNOWN for k, ok in zip(pick, lettered)],
            [float(p[i, k]) if ok else 0.0 for i, (k, ok) in enumerate(zip(pick, lettered))],
        )

    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), text_or_empty().alias("text"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identified(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
