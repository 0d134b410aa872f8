"""Repeated strings across a corpus, by a sparse suffix array that is sorted in buckets.

A byte is removed if it lies in a string of ``length`` bytes that also starts earlier: in a
document with a smaller id, or earlier in the same one. The result is exact. What makes it cheap
is that few suffixes need sorting:

1. Of every window of ``length`` bytes, the 24-byte gram with the smallest hash is its anchor.
   Equal windows have equal anchors at equal places, so only anchors' suffixes matter; each stands
   for a run of neighbouring windows. There is about one in forty bytes.
2. Runs are shuffled by their anchor's hash. An anchor that occurs once drops out. Of runs that
   are equal as a whole, all but the first are repeats; copies inside a task are found before the
   shuffle, so that many copies of a text do not meet in one task.
3. What is left are first runs whose anchor occurs in different surroundings, as at the edges of
   a shared passage. Their suffixes are range-partitioned by sampled splitters on their leading
   bytes. Each bucket is sorted by multikey quicksort, once forwards from the anchors and once
   backwards; common-prefix lengths of neighbours then tell which windows are equal.
4. Windows that are first in their bucket may still have an equal across its boundaries, if they
   share their bytes from the anchor on with the bucket's first or last suffix. These suffixes are
   sorted once more, by the bytes before the anchor; windows that also share those are compared
   across buckets. This divides an anchor with very many surroundings, over which the splitters
   spread several buckets.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import NO_ID_FROM, binary_parts, document_number, slices, stored, table, text_or_empty
from forgelake.llm.hashing import INVERSE, mixed, powers, prefix_sums, span_hashes

LENGTH = 100
GRAM = 24
#: Texts are worked on in segments of that size, and their runs gathered over that many bytes.
SEGMENT_BYTES = 1 << 19
GATHER_BYTES = 8 << 20
#: Suffixes in a bucket, about; a row has some 200 bytes.
BUCKET_ROWS = 40_000
#: Below this many rows, a part of the quicksort is sorted by all its tokens at once.
SMALL_SORT = 1024

INDEX = np.uint64((1 << 22) - 1)
DUPLICATE = 255


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` neighbours, from minima within blocks of that width."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onwards = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onwards[: n - width + 1], upto[width - 1 : n])


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, start, windows, anchor's place, anchor's hash, hash of the run), by segments."""
    begin, end = int(offsets[0]), int(offsets[-1])
    ends = np.repeat(offsets[1:], np.diff(offsets))
    for first in range(begin, end - length + 1, SEGMENT_BYTES):
        last = min(first + SEGMENT_BYTES + length - 1, end)
        m = last - first
        sums = prefix_sums(data[first:last])
        grams = mixed((sums[GRAM:] - sums[: m - GRAM + 1]) * powers(INVERSE, m)[: m - GRAM + 1])
        packed = (grams & ~INDEX) | np.arange(len(grams), dtype=np.uint64)
        anchor = (sliding_minimum(packed, length - GRAM + 1) & INDEX).astype(np.int64)
        at = np.arange(len(anchor))
        whole = ends[first - begin : first - begin + len(anchor)] - first - at >= length
        turn = np.r_[True, (anchor[1:] != anchor[:-1]) | ~whole[:-1]] & whole
        start = np.flatnonzero(turn)
        if not len(start):
            continue
        breaks = np.flatnonzero(np.r_[turn[1:] | (whole[:-1] & ~whole[1:]), True] & whole)
        count = breaks - start + 1
        p = anchor[start]
        doc = np.searchsorted(offsets, start + first, "right") - 1
        content = span_hashes(sums, start, start + count - 1 + length)
        content = mixed(content + (p - start).astype(np.uint64) * np.uint64(257) + count.astype(np.uint64))
        yield doc, start + first - offsets[doc], count, p - start, grams[p], content


def packed_run(pos: np.ndarray, count: np.ndarray, place: np.ndarray) -> np.ndarray:
    return (pos.astype(np.int64) << 16) | (count.astype(np.int64) << 8) | place.astype(np.int64)


def unpacked_run(run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return run >> 16, (run >> 8) & 255, run & 255


def all_runs(docs: DataFrame, length: int) -> DataFrame:
    """(gram, content, id, run) of every run; repeats within a batch are marked in ``run``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            offsets, data = binary_parts(batch.column(1))
            offsets = offsets.astype(np.int64)
            for begin, end in slices(batch.column(1), GATHER_BYTES):
                parts = []
                for first, last in slices(batch.column(1).slice(begin, end - begin), SEGMENT_BYTES):
                    first, last = begin + first, begin + last
                    for doc, pos, count, place, gram, content in runs_of(data, offsets[first : last + 1], length):
                        parts.append((ids[first + doc], packed_run(pos, count, place), gram, content))
                if not parts:
                    continue
                number, run, gram, content = (np.concatenate(x) for x in zip(*parts))
                gram, run = without_repeats(gram, content, number, run)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(content.view(np.int64)), pa.array(number), pa.array(run)],
                    names=["gram", "content", "id", "run"],
                )

    def without_repeats(gram, content, number, run):
        order = np.argsort(gram + np.uint64(3) * content, kind="stable")
        g, c = gram[order], content[order]
        again = np.r_[False, (g[1:] == g[:-1]) & (c[1:] == c[:-1])]
        if not again.any():
            return gram, run
        group = np.cumsum(~again)
        several = np.flatnonzero(again | np.r_[again[1:], False])
        rows, group = order[several], group[several]
        inner = np.lexsort((run[rows], number[rows], group))
        rows, group = rows[inner], group[inner]
        first = np.r_[True, group[1:] != group[:-1]]
        head = np.flatnonzero(first)[np.cumsum(first) - 1]
        later = (number[rows] != number[rows[head]]) | (run[rows] != run[rows[head]])
        rows = rows[later]
        gram, run = gram.copy(), run.copy()
        # marked rows need no partner any more: they go anywhere
        gram[rows] = mixed(number[rows].view(np.uint64) * np.uint64(31) + run[rows].view(np.uint64))
        run[rows] |= DUPLICATE
        return gram, run

    rows = docs.select("id", F.col("body").cast("binary").alias("body"))
    return rows.mapInArrow(cut, "gram long, content long, id long, run long")


def sorted_out(runs: DataFrame) -> DataFrame:
    """(id, run, repeat): repeated runs, and first runs whose anchor has different surroundings."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = content = number = run = None  # of the run that leads the current class
        waiting = False  # whether it is the first of its anchor and not yet passed on
        for batch in batches:
            g, c, i, r = (batch.column(k).to_numpy() for k in range(4))
            marked = (r & 255) == DUPLICATE
            yield rows(i[marked], r[marked], True)
            g, c, i, r = g[~marked], c[~marked], i[~marked], r[~marked]
            if not len(g):
                continue
            if gram is None:
                new_gram = np.r_[True, g[1:] != g[:-1]]
                new = new_gram | np.r_[True, c[1:] != c[:-1]]
            else:
                new_gram = np.r_[g[0] != gram, g[1:] != g[:-1]]
                new = new_gram | np.r_[c[0] != content, c[1:] != c[:-1]]
            head = np.maximum.accumulate(np.where(new, np.arange(len(g)), -1))
            lead_i = np.where(head >= 0, i[head], number if number is not None else 0)
            lead_r = np.where(head >= 0, r[head], run if run is not None else 0)
            repeat = ~new & ((i != lead_i) | (r != lead_r))
            yield rows(i[repeat], r[repeat], True)
            leads = np.flatnonzero(new)
            if len(leads):
                first = new_gram[leads]
                if waiting and not first[0]:
                    yield rows(np.array([number]), np.array([run]), False)
                # a lead has company if it is not its anchor's first, or if another follows
                company = ~first
                company[:-1] |= ~first[1:]
                yield rows(i[leads[company]], r[leads[company]], False)
                at = leads[-1]
                gram, content, number, run = g[at], c[at], i[at], r[at]
                waiting = bool(first[-1])
            # without a new lead, the former one goes on as it was

    def rows(i: np.ndarray, r: np.ndarray, repeat: bool) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int64()), pa.array(r, pa.int64()), pa.array(np.full(len(i), repeat))],
            names=["id", "run", "repeat"],
        )

    ordered = runs.repartition("gram").sortWithinPartitions("gram", "content", "id", "run")
    return ordered.mapInArrow(walk, "id long, run long, repeat boolean")


def suffixes(docs: DataFrame, firsts: DataFrame, length: int) -> DataFrame:
    """(right, left, id, run): the bytes from the anchor on, and those before it, backwards."""
    back = length - GRAM

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                body = batch.column(1)[k].as_buffer()
                data = np.frombuffer(body, np.uint8)
                pos, count, place = unpacked_run(np.unique(batch.column(2)[k].values.to_numpy()))
                fits = pos + count - 1 + length <= len(data)
                pos, count, place = pos[fits], count[fits], place[fits]
                if not len(pos):
                    continue
                anchor, end = pos + place, pos + count - 1 + length
                ahead = anchor[:, None] + np.arange(length)
                behind = anchor[:, None] - 1 - np.arange(back)
                right = np.where(ahead < end[:, None], data[np.minimum(ahead, len(data) - 1)], 0)
                left = np.where(behind >= pos[:, None], data[np.maximum(behind, 0)], 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        fixed(right), fixed(left), pa.array(np.full(len(pos), batch.column(0)[k].as_py(), np.int64)),
                        pa.array(packed_run(pos, count, place)),
                    ],
                    names=["right", "left", "id", "run"],
                )

    lists = firsts.groupBy("id").agg(F.collect_list("run").alias("runs"))
    rows = docs.select("id", F.col("body").cast("binary").alias("body")).join(lists, "id").select("id", "body", "runs")
    return rows.mapInArrow(cut, "right binary, left binary, id long, run long")


def fixed(rows: np.ndarray) -> pa.Array:
    """A binary array of rows of equal length."""
    n, width = rows.shape
    return pa.Array.from_buffers(
        pa.binary(), n,
        [None, pa.py_buffer(np.arange(0, (n + 1) * width, width, dtype=np.int32)), pa.py_buffer(rows.astype(np.uint8).tobytes())],
    )


def tokens(rows: np.ndarray) -> np.ndarray:
    """Eight bytes at a time as one number that sorts alike."""
    width = -(-rows.shape[1] // 8) * 8
    padded = np.zeros((len(rows), width), np.uint8)
    padded[:, : rows.shape[1]] = rows
    return padded.view(">u8").astype(np.uint64)


def multikey_quicksort(keys: np.ndarray) -> np.ndarray:
    """The order of the rows: three-way partitions by one token, the next one among equals."""
    order = np.arange(len(keys))
    todo = [(0, len(keys), 0)]
    while todo:
        low, high, depth = todo.pop()
        part = order[low:high]
        if high - low <= SMALL_SORT:
            order[low:high] = part[np.lexsort(keys[part][:, depth:][:, ::-1].T)]
            continue
        token = keys[part, depth]
        some = np.sort(token[:: max(1, len(token) // 99)])
        pivot = some[len(some) // 2]
        less, more = token < pivot, token > pivot
        same = ~less & ~more
        order[low:high] = np.concatenate([part[less], part[same], part[more]])
        a = low + int(less.sum())
        b = a + int(same.sum())
        todo += [(x, y, d) for x, y, d in ((low, a, depth), (a, b, depth + 1), (b, high, depth))
                 if y - x > 1 and d < keys.shape[1]]
    return order


def common_prefixes(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Per place in the order: the bytes shared with the row before; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for a in range(1, len(order), 1 << 15):
        b = min(a + (1 << 15), len(order))
        differ = rows[order[a:b]] != rows[order[a - 1 : b - 1]]
        out[a:b] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return out


def in_row_order(order: np.ndarray, values: np.ndarray) -> np.ndarray:
    out = np.empty_like(values)
    out[order] = values
    return out


def repeated_windows(right: np.ndarray, left: np.ndarray, number: np.ndarray, run: np.ndarray, length: int) -> np.ndarray:
    """``out[row, t]``: the window that begins t bytes before the row's anchor started earlier."""
    pos, count, place = unpacked_run(run)
    back = length - GRAM
    out = np.zeros((len(run), back + 1), bool)
    forwards, backwards = multikey_quicksort(tokens(right)), multikey_quicksort(tokens(left))
    shared_right, shared_left = common_prefixes(right, forwards), common_prefixes(left, backwards)
    # the most that a row shares with any other, on either side
    reach_right = in_row_order(forwards, np.maximum(shared_right, np.r_[shared_right[1:], 0]))
    reach_left = in_row_order(backwards, np.maximum(shared_left, np.r_[shared_left[1:], 0]))
    earlier = np.empty(len(run), np.int64)
    earlier[np.lexsort((pos + place, number))] = np.arange(len(run))
    for t in range(back + 1):
        rows = np.flatnonzero(
            (place - count < t) & (t <= place) & (reach_right >= length - t) & (reach_left >= t)
        )
        if len(rows) < 2:
            continue
        group_right = in_row_order(forwards, np.cumsum(shared_right < length - t))[rows]
        group_left = in_row_order(backwards, np.cumsum(shared_left < t) if t else np.zeros(len(run), np.int64))[rows]
        same = np.lexsort((earlier[rows], group_left, group_right))
        rows, a, b = rows[same], group_right[same], group_left[same]
        out[rows[1:][(a[1:] == a[:-1]) & (b[1:] == b[:-1])], t] = True
    return out


def in_buckets(rows: DataFrame, length: int) -> DataFrame:
    """Repeats found in buckets, as (id, start, windows), and suffixes with windows still open.

    Those have ``right``, ``left`` and ``open``, a byte for each window. A window is open if it is
    its bucket's first and shares its bytes from the anchor on with the bucket's first or last
    suffix: what shares them with a suffix of another bucket shares them with all in between.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        right, left, number, run = gathered(batches, length)
        if not len(run):
            return
        again = repeated_windows(right, left, number, run, length)
        pos, count, place = unpacked_run(run)
        # neighbouring windows of a row as one span; larger t is further left
        padded = np.pad(again, ((0, 0), (1, 1)))
        row, t_first = np.nonzero(padded[:, 1:] & ~padded[:, :-1])
        t_after = np.nonzero(~padded[:, 1:] & padded[:, :-1])[1]
        start = pos[row] + place[row] - (t_after - 1)
        none = pa.nulls(len(row), pa.binary())
        yield batch(number[row], pa.array(start), pa.array(t_after - t_first), pa.nulls(len(row), pa.int64()), none, none, none)
        order = multikey_quicksort(tokens(right))
        reach = np.maximum(*(shared_with(right, right[order[k]]) for k in (0, -1)))
        t = np.arange(length - GRAM + 1)
        still = (place - count)[:, None] < t
        still &= (t <= place[:, None]) & ~again & (reach[:, None] >= length - t)
        rows = np.flatnonzero(still.any(1))
        none = pa.nulls(len(rows), pa.int64())
        yield batch(number[rows], none, none, pa.array(run[rows]), fixed(right[rows]), fixed(left[rows]), fixed(still[rows]))

    def batch(number, *columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(number, pa.int64()), *columns], names=["id", "start", "windows", "run", "right", "left", "open"]
        )

    return rows.mapInArrow(
        sort, "id long, start long, windows long, run long, right binary, left binary, open binary"
    )


def open_windows(rows: DataFrame, length: int) -> DataFrame:
    """(id, start, bytes) of the open windows that may have an equal in another bucket.

    The suffixes are sorted once more, by what lies before their anchors: a window whose bytes
    before the anchor no neighbour shares has no equal anywhere.
    """

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        table = pa.Table.from_batches(held).combine_chunks()
        back = length - GRAM
        right, left = matrix(table["right"].chunk(0), length), matrix(table["left"].chunk(0), back)
        still = matrix(table["open"].chunk(0), back + 1) != 0
        number, (pos, _, place) = table["id"].to_numpy(), unpacked_run(table["run"].to_numpy())
        around = np.concatenate([right[:, :GRAM], left], axis=1)
        order = multikey_quicksort(tokens(around))
        shared = common_prefixes(around, order) - GRAM
        reach = in_row_order(order, np.maximum(shared, np.r_[shared[1:], 0]))
        # only the first and the last may have a closer neighbour in another task
        reach[order[[0, -1]]] = back
        for t in range(back + 1):
            rows = np.flatnonzero(still[:, t] & (reach >= t))
            if len(rows):
                window = np.concatenate([left[rows][:, :t][:, ::-1], right[rows][:, : length - t]], axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number[rows]), pa.array(pos[rows] + place[rows] - t), fixed(window)],
                    names=["id", "start", "bytes"],
                )

    return rows.mapInArrow(sort, "id long, start long, bytes binary")


def gathered(batches: Iterator[pa.RecordBatch], length: int) -> tuple[np.ndarray, ...]:
    """right, left, id and run of a bucket, each occurrence once."""
    held = [b for b in batches if b.num_rows]
    if not held:
        none = np.zeros(0, np.int64)
        return none, none, none, none
    bucket = pa.Table.from_batches(held).combine_chunks()
    right, left = matrix(bucket["right"].chunk(0), length), matrix(bucket["left"].chunk(0), length - GRAM)
    number, run = bucket["id"].to_numpy(), bucket["run"].to_numpy()
    _, one = np.unique(np.rec.fromarrays([number, run]), return_index=True)
    return right[one], left[one], number[one], run[one]


def shared_with(rows: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Bytes at the beginning that each row shares with the given one."""
    differ = rows != row
    return np.where(differ.any(1), differ.argmax(1), rows.shape[1])


def matrix(column: pa.Array, width: int) -> np.ndarray:
    offsets, data = binary_parts(column)
    return data[offsets[0] : offsets[-1]].reshape(-1, width)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(id, spans) from ``docs`` (id, body): byte ranges [from, upto) to remove, maybe overlapping."""
    if not 2 * GRAM <= length <= 2 * GRAM + 200:
        raise ValueError(f"length must be from {2 * GRAM} to {2 * GRAM + 200}")
    found = stored(sorted_out(all_runs(docs, length)), "runs")
    pos = F.shiftright("run", 16)
    count = F.shiftright("run", 8).bitwiseAND(F.lit(255))
    whole = found.filter("repeat").select("id", pos.alias("start"), count.alias("windows"))
    cut = stored(suffixes(docs, found.filter("NOT repeat"), length), "suffixes")
    buckets = max(cut.count() // BUCKET_ROWS + 1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sorted_rows = stored(in_buckets(cut.repartitionByRange(buckets, "right", "left"), length), "buckets")
    inner = sorted_rows.filter("run IS NULL").select("id", "start", "windows")
    edges = sorted_rows.filter("run IS NOT NULL").withColumn("around", F.concat(F.substring("right", 1, GRAM), "left"))
    edges = open_windows(edges.repartitionByRange("around"), length)
    edges = stored(edges, "windows")
    first = stored(edges.groupBy("bytes").agg(F.min(F.struct("id", "start")).alias("first")), "first")
    across = edges.join(first, "bytes").filter(F.struct("id", "start") != F.col("first"))
    spans = whole.union(inner).union(across.select("id", "start", F.lit(1).cast("long")))
    upto = F.col("start") + F.col("windows") - 1 + length
    return spans.groupBy("id").agg(F.collect_list(F.struct("start", upto.alias("upto"))).alias("spans"))


def covered(size: int, starts: np.ndarray, upto: np.ndarray) -> np.ndarray:
    """Which of so many bytes lie in a span."""
    change = np.bincount(np.minimum(starts, size), minlength=size + 1)
    change -= np.bincount(np.minimum(upto, size), minlength=size + 1)
    return np.cumsum(change[:size]) > 0


def told_apart(rows: DataFrame) -> DataFrame:
    """(..., body, id) with an id of its own for each text: spans belong to one text only.

    Where an id stands for several texts, that with the smallest hash keeps it, and the others get
    numbers behind all ids.
    """
    mark = F.xxhash64("body")
    marks = rows.select("id", mark.alias("mark")).groupBy("id").agg(F.min("mark").alias("own"), F.max("mark").alias("last"))
    clashes = stored(marks.filter("own <> last").select(F.col("id").alias("clash"), "own"), "clashes")
    last = F.xxhash64("id", "body").bitwiseAND(F.lit(NO_ID_FROM - 1)) + F.lit(NO_ID_FROM)
    keeps = F.col("own").isNull() | (F.col("own") == mark)
    found = rows.join(clashes, F.col("id") == F.col("clash"), "left")
    return found.withColumn("id", F.when(keeps, F.col("id")).otherwise(last)).select(*rows.columns)


def with_spans(docs: DataFrame, columns: list[str], length: int) -> DataFrame:
    """The columns, ``body`` in bytes and its spans, per row of ``docs``."""
    rows = told_apart(docs.select(*columns, text_or_empty().alias("body"), document_number().alias("id")))
    spans = stored(repeated_spans(rows.select("id", "body"), length), "spans")
    rows = rows.join(spans, "id", "left")
    return rows.select(*columns, F.col("body").cast("binary").alias("body"), "spans.start", "spans.upto")


def marked(batch: pa.RecordBatch, row: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the row and which of them are to go."""
    width = batch.num_columns
    data = np.frombuffer(batch.column(width - 3)[row].as_buffer(), np.uint8)
    starts, upto = batch.column(width - 2)[row], batch.column(width - 1)[row]
    if not starts.is_valid:
        return data, np.zeros(len(data), bool)
    return data, covered(len(data), starts.values.to_numpy(), upto.values.to_numpy())


def summary(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row.

    NULL and empty texts have no bytes; a text shorter than ``length`` keeps all of its own. Rows
    that repeat a doc_id with its text are one document, and each gets its result. Where a doc_id
    stands for different texts they are different documents: that with the smallest hash stands at
    the doc_id, the others come after all rows with an id of their own, in the order of a hash. Rows without a doc_id come after all others, in the order of a hash of their texts, and equal
    texts among them are one document. Only doc_id and text are used.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for k in range(batch.num_rows):
                data, gone = marked(batch, k)
                begins = int((gone & ~np.r_[False, gone[:-1]]).sum())
                rows.append((len(data), int(gone.sum()), begins, hashlib.sha256(data[~gone].tobytes()).hexdigest()))
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *(pa.array(c) for c in zip(*rows))],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
                )

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return with_spans(docs, ["doc_id"], length).mapInArrow(
        digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


def kept_text(data: np.ndarray, gone: np.ndarray) -> str:
    """The text without the characters that are to go with all their bytes."""
    if not gone.any():
        return data.tobytes().decode("utf-8", "replace")
    first = np.flatnonzero((data & 0xC0) != 0x80)
    whole = np.minimum.reduceat(gone, first)
    keep = np.repeat(~whole, np.diff(np.r_[first, len(data)]))
    return data[keep].tobytes().decode("utf-8", "replace")


def without_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` with repeated strings taken out of ``text``; n_chars, if there, follows.

    Characters that a removed range holds only in part stay. A text that loses all of its
    characters goes with its row; NULL and empty texts stay as they are.
    """
    columns = docs.columns
    others = [c for c in columns if c != "text"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, had = [], []
            for k in range(batch.num_rows):
                data, gone = marked(batch, k)
                texts.append(kept_text(data, gone))
                had.append(bool(gone.any()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(had, pa.bool_())],
                names=["rest", "was_null", "text", "changed"],
            )

    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long")) if "doc_id" in columns else docs
    rows = rows.select("doc_id", "text", F.struct(*others).alias("rest"), F.col("text").isNull().alias("was_null"))
    spread = with_spans(rows, ["rest", "was_null"], length)
    kind = spread.schema["rest"].dataType.simpleString()
    out = spread.mapInArrow(cut, f"rest {kind}, was_null boolean, text string, changed boolean")
    out = out.filter("NOT (changed AND text = '')")
    text = F.when(~F.col("was_null"), F.col("text"))
    values = {c: F.col(f"rest.`{c}`") for c in others} | {"text": text}
    if "n_chars" in values:
        values["n_chars"] = F.when(F.col("changed"), F.char_length(text).cast("long")).otherwise(values["n_chars"])
    return out.select(*[values[c].alias(c) for c in columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary(table(spark, sf_dir, "documents"))
