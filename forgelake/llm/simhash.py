"""SimHash fingerprints, and groups of fingerprints that few bits separate.

Pivot distance tables find the pairs. The Hamming distances of a fingerprint to a number of fixed
reference fingerprints are computed once. By the triangle inequality, fingerprints that differ in
at most ``d`` bits have distances to any reference that differ by at most ``d``; a pair with a
larger difference in any coordinate is discarded, and the survivors are verified bit by bit.

A single distance halves random pairs at best, so it cannot say where in a cluster a pair has to
meet. Bit blocks do: of six blocks at least three are equal if at most three bits differ. Each
fingerprint goes to a bin for each choice of three blocks, and the pivot tables work in the bins.
A bin of very many fingerprints is divided by further blocks of the remaining bits until at most
a few thousand different fingerprints can lie in one, by the number of free bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import document_number, stored, table
from forgelake.llm.components import components

SHINGLE_WORDS = 3
MOST_BITS = 3
PIVOTS = 16
#: Bins with more fingerprints than this are divided.
BIN_ROWS = 4096

CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WHITE = r"[\x20\x09-\x0D]+"


def lower_ascii(text: Column) -> Column:
    # lower() also changes other letters, but is much faster where there are none
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, CAPITALS, CAPITALS.lower()))


def shingle_hashes(words: Column, size: int) -> Column:
    """XXH64, seed 42, of each run of ``size`` words joined by spaces; of all words if fewer."""
    n = F.size(words)
    runs = F.transform(
        F.sequence(F.lit(1), F.greatest(n - size + 1, F.lit(1))),
        lambda i: F.xxhash64(F.concat_ws(" ", *[F.try_element_at(words, i + k) for k in range(size)])),
    )
    none = F.array().cast("array<bigint>")
    return F.when(n == 0, none).when(n < size, F.array(F.xxhash64(F.array_join(words, " ")))).otherwise(runs)


def pivots(count: int = PIVOTS) -> np.ndarray:
    """The reference fingerprints: a fixed random choice."""
    return np.random.default_rng(42).integers(0, 2**63, count, np.uint64) * np.uint64(2) + np.uint64(1)


def majority(hashes: np.ndarray) -> int:
    """A bit is set if more than half of the hashes have it."""
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        block = hashes[first : first + (1 << 16)]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; texts without words have fingerprint 0."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            ends = lists.offsets.to_numpy()
            values = lists.values.to_numpy().view(np.uint64)
            fps = np.fromiter(
                (majority(values[a:b]) if b > a else 0 for a, b in zip(ends, ends[1:])), np.uint64, len(lists)
            )
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], names=["doc_id", "fp"])

    text = lower_ascii(F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long"), text.alias("text"))
    rows = rows.withColumn("words", F.array_remove(F.split("text", WHITE), ""))
    rows = rows.select("doc_id", shingle_hashes(F.col("words"), shingle_words).alias("hashes"))
    return rows.mapInArrow(fold, "doc_id long, fp long")


def with_pivots(fps: DataFrame, count: int = PIVOTS) -> DataFrame:
    """The distance table: (fp, pivots), one byte per reference fingerprint."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        refs = pivots(count)
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            distances = np.bitwise_count(fp[:, None] ^ refs[None, :]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([d.tobytes() for d in distances], pa.binary())], names=["fp", "pivots"]
            )

    return fps.select("fp").mapInArrow(measure, "fp long, pivots binary")


def block_masks(bits: list[int], blocks: int, equal: int) -> list[int]:
    """Masks over each choice of ``equal`` out of ``blocks`` blocks of these bits."""
    cut = [bits[len(bits) * i // blocks : len(bits) * (i + 1) // blocks] for i in range(blocks)]
    return [sum(1 << b for block in choice for b in block) for choice in combinations(cut, equal)]


def binned(rows: DataFrame, masks: dict[int, list[int]]) -> DataFrame:
    """Each row once per bin: (fp, pivots, band, key). ``masks[band]`` divides a former band."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            former = batch.column(2).to_numpy()
            for band in np.unique(former):
                mine = np.flatnonzero(former == band)
                choice = np.array(masks[int(band)], np.uint64)
                fp = batch.column(0).to_numpy()[mine]
                key = fp.view(np.uint64)[:, None] & choice[None, :]
                bands = np.broadcast_to(band * 1000 + np.arange(len(choice)), key.shape)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(fp, len(choice))),
                        batch.column(1).take(pa.array(np.repeat(mine, len(choice)))),
                        pa.array(bands.ravel().astype(np.int32)),
                        pa.array(key.ravel().view(np.int64)),
                    ],
                    names=["fp", "pivots", "band", "key"],
                )

    return rows.select("fp", "pivots", "band").mapInArrow(deal, "fp long, pivots binary, band int, key long")


def links_in_bins(rows: DataFrame, most_bits: int) -> DataFrame:
    """Links (a, b) within each (band, key); joined to a forest, so no more than there are rows."""

    def forest(fp: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label = np.arange(len(fp))
        while True:
            low = np.minimum(label[left], label[right])
            new = label.copy()
            np.minimum.at(new, left, low)
            np.minimum.at(new, right, low)
            new = new[new]
            if (new == label).all():
                break
            label = new
        moved = np.flatnonzero(label != np.arange(len(fp)))
        return fp[moved], fp[label[moved]]

    def linked(band: np.ndarray, key: np.ndarray, fp: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        first = np.r_[True, (band[1:] != band[:-1]) | (key[1:] != key[:-1])]
        group = np.cumsum(first)
        order = np.lexsort((far[:, 0], group))
        group, fp, far = group[order], fp[order], far[order].astype(np.int16)
        left, right, at = [], [], np.arange(len(fp))
        for lag in range(1, len(fp)):
            at = at[at + lag < len(fp)]
            # sorted by the first distance: once it is too large, it stays so
            at = at[(group[at] == group[at + lag]) & (far[at + lag, 0] - far[at, 0] <= most_bits)]
            if not len(at):
                break
            near = at[(np.abs(far[at] - far[at + lag]) <= most_bits).all(axis=1)]
            near = near[np.bitwise_count(fp[near] ^ fp[near + lag]) <= most_bits]
            left.append(near)
            right.append(near + lag)
        if not left:
            return fp[:0], fp[:0]
        return forest(fp, np.concatenate(left), np.concatenate(right))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            rows = rows if rest is None else pa.concat_tables([rest, rows])
            band, key = rows["band"].to_numpy(), rows["key"].to_numpy()
            # the last bin may go on in the next batch
            same = np.flatnonzero((band != band[-1]) | (key != key[-1]))
            cut = int(same[-1]) + 1 if len(same) else 0
            yield from pairs(rows.slice(0, cut))
            rest = rows.slice(cut)
        if rest is not None:
            yield from pairs(rest)

    def pairs(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        if rows.num_rows < 2:
            return
        rows = rows.combine_chunks()
        far = np.frombuffer(b"".join(rows["pivots"].to_pylist()), np.uint8).reshape(rows.num_rows, -1)
        a, b = linked(
            rows["band"].to_numpy(), rows["key"].to_numpy(), rows["fp"].to_numpy().view(np.uint64), far
        )
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    sorted_rows = rows.repartition("band", "key").sortWithinPartitions("band", "key")
    return sorted_rows.mapInArrow(run, "a long, b long")


def near_links(fps: DataFrame, most_bits: int = MOST_BITS, bin_rows: int = BIN_ROWS) -> DataFrame:
    """Links (a, b) that join the same fingerprints as all pairs of at most ``most_bits`` would.

    A bin gives a tree over the fingerprints that its pairs connect, not the pairs themselves, so
    the ends of a link may be further apart than ``most_bits`` (3 or fewer).
    """
    if not 0 <= most_bits <= 3:
        raise ValueError("blocks are laid out for at most 3 bits")
    rows = stored(with_pivots(fps.select("fp").distinct()).withColumn("band", F.lit(0)), "pivots")
    everything = list(range(64))
    coarse = block_masks(everything, 6, 3)
    # of the 31 to 33 bits that a bin leaves free, 5 of 8 blocks are equal again: 12 to 15 stay free
    fine = {
        i: [m | d for d in block_masks([b for b in everything if not m >> b & 1], 8, 5)]
        for i, m in enumerate(coarse)
    }

    def counted(bins: DataFrame) -> DataFrame:
        counts = bins.groupBy("band", "key").agg(F.count("*").alias("n")).filter("n > 1")
        return bins.join(stored(counts, "bins"), ["band", "key"])

    full = counted(binned(rows, {0: coarse}))
    out = stored(links_in_bins(full.filter(F.col("n") <= bin_rows), most_bits).distinct(), "near")
    crowded = stored(full.filter(F.col("n") > bin_rows).select("fp", "pivots", "band"), "crowded")
    if not crowded.isEmpty():
        out = out.union(links_in_bins(counted(binned(crowded, fine)), most_bits))
    return out


def groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs``.

    component_id is the smallest doc_id that can be reached over links, itself included. Equal
    fingerprints are one node, so copies cost no pairs. NULL and empty texts have fingerprint 0
    and link like any other. Repeated rows stay as they are. A NULL doc_id is larger than all
    others: a group has none only if no member has one.
    """
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    near = stored(components(near_links(nodes, most_bits)), "components")
    named = nodes.join(near, F.col("fp") == F.col("node"), "left")
    named = named.withColumn("component", F.coalesce("component", "fp"))
    named = stored(named.select("fp", "first_id", "component"), "named")
    lowest = stored(named.groupBy("component").agg(F.min("first_id").alias("component_id")), "lowest")
    classes = stored(named.join(lowest, "component").select("fp", "component_id"), "classes")
    return rows.join(classes, "fp").select("doc_id", "fp", "component_id")


def deduplicated(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """One row of ``docs`` per group: that of the smallest doc_id, once if it is repeated.

    Rows without a doc_id come after all others, in the order of a hash of their texts.
    """
    rows = docs.select(document_number().alias("number"), F.struct(*docs.columns).alias("row"), "text")
    found = groups(rows.select(F.col("number").alias("doc_id"), "text"), shingle_words, most_bits)
    kept = stored(found.select(F.col("component_id").alias("number")).distinct(), "kept")
    rows = rows.join(kept, "number", "left_semi")
    return rows.groupBy("number").agg(F.min_by("row", F.coalesce("text", F.lit(""))).alias("row")).select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
