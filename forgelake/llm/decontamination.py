"""Benchmark passages in documents, by a prefix-filtered set join with exact verification.

An item's windows are its runs of 13 words. A document that holds a window holds all of the
window's shingles, so one of them is enough to find it: the one that the corpus has least often.

1. Documents are read once. Shingles that the benchmark may have, by a bitmap of fixed size, are
   kept with their place and with the words around them.
2. These rows give the corpus frequency of every benchmark shingle. Each window takes its rarest
   as its prefix; a common phrase in an item thus draws no candidates.
3. Rows join prefixes on the shingle. The window's place follows from the shingle's; it must
   begin and end within the document.
4. The words at that place are compared with the window's words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import binary_parts, slices, stored, table
from forgelake.llm.hashing import mixed, run_hashes, words_of

WINDOW_WORDS = 13
SHINGLE_WORDS = 5
#: Bits of the map of benchmark shingles: 2 MB, whatever the benchmark's size.
MAP_BITS = 24
#: A document is contaminated if at least one in so many of its words is hit.
WORDS_PER_HIT = 20
SLICE_BYTES = 2 << 20

#: Words are digits, letters a-z and all bytes of other characters; capitals count as small.
CLASSES = np.zeros(256, np.uint8)
CLASSES[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
CLASSES[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
CLASSES[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
CLASSES[128:] = np.arange(128, 256)
SPACED = np.where(CLASSES == 0, ord(" "), CLASSES).astype(np.uint8)

HITS = "array<struct<place: int, before: int, shingle: long, around: string>>"


def windows(benchmark: DataFrame, words: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS) -> DataFrame:
    """(item_id, window, size, at, shingle): each window once per shingle in it."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, texts = batch.column(0).to_pylist(), batch.column(1)
            offsets, data = binary_parts(texts)
            of, starts, ends, hashes = words_of(data, offsets.astype(np.int64), CLASSES)
            spaced = SPACED[data[: offsets[-1]]].tobytes()
            rows = []
            for i, item in enumerate(items):
                mine = np.flatnonzero(of == i)
                if not len(mine):
                    continue
                text = [spaced[a:b].decode() for a, b in zip(starts[mine], ends[mine])]
                size = min(words, len(text))
                run = min(shingle, size)
                codes = run_hashes(hashes[mine], run).view(np.int64).tolist()
                for s in range(len(text) - size + 1):
                    window = " ".join(text[s : s + size])
                    rows += [(item, window, size, at, codes[s + at]) for at in range(size - run + 1)]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int64()))],
                    names=["item_id", "window", "size", "at", "shingle"],
                )

    items = benchmark.select(
        F.col("item_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    )
    return items.mapInArrow(cut, "item_id long, window string, size int, at int, shingle long")


def bit_of(shingles: np.ndarray) -> np.ndarray:
    return (mixed(shingles) >> np.uint64(64 - MAP_BITS)).astype(np.int64)


def shingle_map(shingles: DataFrame) -> np.ndarray:
    """Which bits the shingles set; at most 2^MAP_BITS / 64 rows come to the driver."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.unique(bit_of(batch.column(0).to_numpy().view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 6), pa.array(bits & 63)], names=["word", "bit"])

    bits = shingles.select("shingle").mapInArrow(places, "word long, bit long")
    filled = bits.groupBy("word").agg(F.expr("bit_or(shiftleft(1L, cast(bit as int)))").alias("bits"))
    out = np.zeros(1 << (MAP_BITS - 6), np.int64)
    for row in filled.toLocalIterator():
        out[row.word] = row.bits
    return out.view(np.uint64)


def scanned(docs: DataFrame, bits: np.ndarray, sizes: list[int], words: int = WINDOW_WORDS) -> DataFrame:
    """``doc_id, n_words, hits`` per row: places whose shingle the benchmark may have."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last in slices(batch.column(1), SLICE_BYTES):
                yield scan_slice(batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first))

    def scan_slice(ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        offsets, data = binary_parts(texts)
        offsets = offsets.astype(np.int64)
        of, starts, ends, hashes = words_of(data, offsets, CLASSES)
        counts = np.bincount(of, minlength=len(texts))
        begin = np.r_[0, np.cumsum(counts)]
        place, code, run = [], [], []
        for size in sizes:
            codes = run_hashes(hashes, size)
            at = bit_of(codes)
            hit = (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            hit = np.flatnonzero(hit)
            hit = hit[of[hit] == of[hit + size - 1]]
            place.append(hit)
            code.append(codes[hit])
            run.append(np.full(len(hit), size))
        place, code, run = (np.concatenate(x) for x in (place, code, run))
        order = np.argsort(place, kind="stable")
        place, code, run = place[order], code[order], run[order]
        doc = of[place]
        left = np.maximum(place - words + 1, begin[doc])
        right = np.minimum(place + words, begin[doc + 1])
        base = int(offsets[0])
        spaced = SPACED[data[base : int(offsets[-1])]]
        around = [
            b" ".join(spaced[a - base : b - base].tobytes() for a, b in zip(starts[i:j], ends[i:j])).decode()
            for i, j in zip(left, right)
        ]
        hits = pa.StructArray.from_arrays(
            [
                pa.array((place - begin[doc]).astype(np.int32)), pa.array((place - left).astype(np.int32)),
                pa.array(code.view(np.int64)), pa.array(around, pa.string()),
            ],
            names=["place", "before", "shingle", "around"],
        )
        ends_of = np.r_[0, np.cumsum(np.bincount(doc, minlength=len(texts)))].astype(np.int32)
        return pa.RecordBatch.from_arrays(
            [ids, pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(pa.array(ends_of), hits)],
            names=["doc_id", "n_words", "hits"],
        )

    rows = docs.select(
        F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")).alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text"),
    )
    return rows.mapInArrow(scan, f"doc_id struct<doc_id: long, text_hash: long>, n_words long, hits {HITS}")


def contamination(docs: DataFrame, benchmark: DataFrame, words: int = WINDOW_WORDS,
                  shingle: int = SHINGLE_WORDS) -> DataFrame:
    """Per row: doc_id, text_hash, n_words, n_hit, items (ids as strings, ascending), contaminated.

    ``n_hit`` counts the document's words within any occurrence of a window. NULL and empty texts
    have no words; items without words have no window; an item with a NULL id is one item. An
    empty benchmark hits nothing. Repeated rows each get their own result. Only doc_id and text,
    item_id and text are used, whatever other columns are called.
    """
    parts = stored(windows(benchmark, words, shingle), "windows")
    sizes = [r.run for r in parts.select(F.least("size", F.lit(shingle)).alias("run")).distinct().orderBy("run").collect()]
    if not sizes:
        sizes = [shingle]
    found = scanned(docs, shingle_map(parts), sizes, words)
    found = stored(found.withColumn("row", F.monotonically_increasing_id()), "scanned")
    hits = found.select("row", "n_words", F.explode("hits").alias("hit")).select("row", "n_words", "hit.*")
    frequency = hits.groupBy("shingle").agg(F.count("*").alias("times"))
    prefix = (
        parts.select("window", "size", "at", "shingle").distinct().join(frequency, "shingle")
        .groupBy("window", "size")
        .agg(F.min(F.struct("times", "shingle", "at")).alias("rarest"), F.count("*").alias("present"))
        # a window with a shingle that the corpus lacks occurs nowhere
        .filter(F.col("present") == F.col("size") - F.least("size", F.lit(shingle)) + 1)
        .select("window", "size", "rarest.shingle", "rarest.at")
    )
    prefix = stored(prefix, "prefix")
    candidates = hits.join(prefix, "shingle").withColumn("start", F.col("place") - F.col("at"))
    candidates = candidates.filter(
        (F.col("at") <= F.col("before")) & (F.col("start") + F.col("size") <= F.col("n_words"))
    )
    same = F.slice(F.split("around", " "), F.col("before") - F.col("at") + 1, F.col("size"))
    verified = stored(
        candidates.filter(F.array_join(same, " ") == F.col("window")).select("row", "start", "size", "window"), "verified"
    )
    items = stored(
        parts.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "window").distinct(), "items"
    )
    hit_items = (
        verified.select("row", "window").distinct().join(items, "window")
        .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items"))
    )
    spans = verified.groupBy("row").agg(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))).alias("spans")
    )
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("total")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["end"]).alias("end"),
            (acc["total"] + F.greatest(F.lit(0), s["end"] - F.greatest(acc["end"], s["start"]))).alias("total"),
        ),
        lambda acc: acc["total"],
    )
    hit_words = spans.select("row", covered.alias("n_hit"))
    out = found.select("row", "doc_id.*", "n_words").join(hit_words, "row", "left").join(hit_items, "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return out.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ((n_hit > 0) & (WORDS_PER_HIT * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated."""
    bad = contamination(docs, benchmark).filter("contaminated").select("doc_id", "text_hash").distinct()
    bad = stored(bad.select(F.struct("doc_id", "text_hash").alias("bad")), "contaminated")
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.struct(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash")).alias("key"),
    )
    return rows.join(bad, F.col("key").eqNullSafe(F.col("bad")), "left_anti").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


#: The same by joining every window with every run of as many words.
SQL = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least({WINDOW_WORDS}, len(w)) AS size FROM bw WHERE len(w) > 0),
bp AS (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS s FROM bs),
win AS (SELECT DISTINCT item_id, size, array_to_string(list_slice(w, s, s + size - 1), ' ') AS txt FROM bp),
sizes AS (SELECT DISTINCT size FROM win),
dp AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS s
  FROM dw, sizes WHERE len(w) >= size),
runs AS (SELECT doc_id, size, s, array_to_string(list_slice(w, s, s + size - 1), ' ') AS txt FROM dp),
occ AS (
  SELECT r.doc_id, r.s, r.size, i.item_id FROM runs r JOIN win i ON r.size = i.size AND r.txt = i.txt),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(s, s + size)) AS p FROM occ)
  GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n, sha256(string_agg(item, ',' ORDER BY item)) AS h
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
  coalesce(i.n, 0)::BIGINT AS n_items, coalesce(i.h, sha256('')) AS items_sha256,
  coalesce(h.n, 0) > 0 AND {WORDS_PER_HIT} * coalesce(h.n, 0) >= len(d.w) AS contaminated
FROM dw d LEFT JOIN hit h USING (doc_id) LEFT JOIN its i USING (doc_id)
"""
