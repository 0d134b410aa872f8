"""Exact token counts at every prefix of a text.

A tokenizer that splits at white space before it merges never forms a token across a space, so
the count of a prefix is the count of the prefix one chunk shorter plus that of its last chunk:
``count[i] = count[i - 1] + tokens(chunk[i])``. The table of these sums answers how long a text
is, where it must be cut to fit a limit, and how many tokens any stretch has, without encoding
it again. Inside a word the same recurrence runs over its letters: ``PieceTable``.

Texts repeat their words, so a worker keeps the counts of the chunks it has met and asks the
library only for new ones. That memory holds a fixed number of entries and starts anew when full.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import slices, table, text_or_empty

LIMIT = 2048
KNOWN_CHUNKS = 400_000
LONGEST_KNOWN = 64
SLICE_BYTES = 4 << 20

_COUNTERS: dict[str, ChunkCounter] = {}

SPACES = str.maketrans("\t\n\r", "   ")


class ChunkCounter:
    """Tokens of chunks without white space, as the library counts them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[str, int] = {"": 0}

    def learn(self, chunks: set[str]) -> dict[str, int]:
        """Counts of all these chunks; short ones are remembered."""
        known = self.known
        new = [c for c in chunks if c not in known]
        got = {c: known[c] for c in chunks if c in known}
        sizes = [len(e) for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        got.update(zip(new, sizes))
        if len(known) + len(new) > KNOWN_CHUNKS:
            known.clear()
            known[""] = 0
        known.update((c, n) for c, n in zip(new, sizes) if len(c) <= LONGEST_KNOWN)
        return got

    def beginning(self, chunk: str, budget: int) -> str:
        """The longest beginning of a chunk that ends where one of its tokens does and keeps the budget.

        A beginning may take other tokens than the chunk begins with, so it is counted itself.
        """
        if budget <= 0:
            return ""
        ends = [end for _, end in self.tokenizer.encode(chunk, add_special_tokens=False).offsets]
        for end in reversed(ends[:budget]):
            if len(self.tokenizer.encode(chunk[:end], add_special_tokens=False)) <= budget:
                return chunk[:end]
        return ""


def counter(path: str) -> ChunkCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = ChunkCounter(path)
    return _COUNTERS[path]


class PrefixTable:
    """Token counts at all prefixes of a text that end where a chunk ends."""

    def __init__(self, chunks: list[str], counts: dict[str, int], counter: ChunkCounter):
        self.chunks, self.counter = chunks, counter
        self.sums = np.cumsum(np.fromiter(map(counts.__getitem__, chunks), np.int64, len(chunks)))

    @property
    def total(self) -> int:
        return int(self.sums[-1]) if len(self.sums) else 0

    def fitting(self, budget: int) -> int:
        """Chunks in the longest prefix of at most that many tokens."""
        return int(np.searchsorted(self.sums, budget, "right"))

    def between(self, first: int, last: int) -> int:
        """Tokens of the chunks from ``first`` up to ``last``."""
        before = int(self.sums[first - 1]) if first else 0
        return (int(self.sums[last - 1]) if last else 0) - before

    def fitting_bytes(self, budget: int) -> int:
        """UTF-8 bytes of that prefix and of what still fits of the chunk behind it."""
        whole = self.fitting(budget)
        text = " ".join(self.chunks[:whole])
        if whole < len(self.chunks):
            begun = self.counter.beginning(self.chunks[whole], budget - (int(self.sums[whole - 1]) if whole else 0))
            if begun:
                text = f"{text} {begun}" if whole else begun
        return len(text.encode())


def chunks_of(text: str) -> list[str]:
    """The text at single white-space characters; empty chunks keep the places."""
    return text.translate(SPACES).split(" ")


def prefix_tables(texts: list[str], path: str) -> list[PrefixTable]:
    split = [chunks_of(t) for t in texts]
    known = counter(path)
    counts = known.learn({c for chunks in split for c in chunks})
    return [PrefixTable(chunks, counts, known) for chunks in split]


class PieceTable:
    """Tokens of every prefix of one word under merge ranks with a mark for the word's end.

    ``last[i]`` is the last token of the first ``i`` letters' encoding. A token can follow
    another if both stay apart when merged together; exactly one token that ends at ``i`` can
    follow what precedes it, so each prefix takes one step from a shorter one.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        self.vocabulary = set(model["vocab"])
        self.end = model.get("end_of_word_suffix") or ""
        self.ranks = {tuple(m): i for i, m in enumerate(model["merges"])}
        self.longest = max(len(t.removesuffix(self.end)) for t in self.vocabulary)
        self.apart: dict[tuple[str, str, bool], bool] = {}

    def merged(self, word: str, ended: bool) -> list[str]:
        parts = list(word)
        if ended and self.end:
            parts[-1] += self.end
        while len(parts) > 1:
            ranked = [(self.ranks.get(pair), i) for i, pair in enumerate(zip(parts, parts[1:]))]
            best = min(((r, i) for r, i in ranked if r is not None), default=None)
            if best is None:
                break
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def can_follow(self, left: str, right: str, ended: bool) -> bool:
        key = (left, right, ended)
        if key not in self.apart:
            whole = [left, right + self.end if ended else right]
            self.apart[key] = self.merged(left + right, ended) == whole
        return self.apart[key]

    def counts(self, word: str) -> list[int]:
        """Tokens of ``word[:i]`` as a whole word, for i from 1 to its length."""
        inner: list[tuple[int, str]] = [(0, "")]
        out = []
        for i in range(1, len(word) + 1):
            for ended in (False, True):
                for size in range(min(i, self.longest), 0, -1):
                    token = word[i - size : i]
                    name = token + self.end if ended else token
                    before, last = inner[i - size]
                    fits = not last and self.merged(token, ended) == [name]
                    if name in self.vocabulary and (fits if not last else self.can_follow(last, token, ended)):
                        break
                else:
                    raise ValueError(f"no token ends at letter {i} of {word!r}")
                if ended:
                    out.append(before + 1)
                else:
                    inner.append((before + 1, token))
        return out


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """Per row: doc_id, n_bytes, n_tokens, over_limit, fit_bytes.

    ``fit_bytes`` is the length of a prefix within the limit: as many whole chunks as fit, and of the
    next what fits up to the end of a token. A NULL
    or empty text has no bytes and no tokens. Repeated rows each get their own result, a NULL
    doc_id stays, further columns are ignored. No row depends on another: there is no shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for first, last in slices(texts, SLICE_BYTES):
                part = texts.slice(first, last - first).to_pylist()
                tables = prefix_tables(part, path)
                totals = [t.total for t in tables]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array([len(t.encode()) for t in part], pa.int64()),
                        pa.array(totals, pa.int64()),
                        pa.array([n > limit for n in totals], pa.bool_()),
                        pa.array(
                            [
                                t.fitting_bytes(limit) if n > limit else len(s.encode())
                                for t, n, s in zip(tables, totals, part)
                            ],
                            pa.int64(),
                        ),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit", "fit_bytes"],
                )

    return docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text")).mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean, fit_bytes long"
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
