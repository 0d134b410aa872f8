"""Toxicity from a learned lexicon, matched through Levenshtein automata.

The lexicon is learned from labelled texts: words, and stems of words, that toxic texts have far
more often than others. It is held as a trie, and the Levenshtein automata of its terms are
intersected with it once: each state of the resulting table is a set of (node of the trie, edits
spent). All words of a batch then walk through the table together, a letter at a time, and nearly
all of them end after two or three letters.

Each match is looked at in its context: whether it stands between quotation marks or behind a
word of saying, and whether other matches are near. A logistic regression over the counts of
exact, misspelled, quoted and clustered matches gives the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import slices, stored, table, text_or_empty
from forgelake.llm.id_filter import id_filter, may_hold

FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.3
#: Labelled rows that the regression is fitted on, of either label.
SAMPLE_ROWS = 3000
#: Lengths of stems; whole words are longer or as long.
STEMS = (4, 5, 6, 7)
#: A term must be in so many toxic texts, and be so much likelier there (log odds).
LEAST_TEXTS = 5
LEAST_LOG_ODDS = 3.0
#: Shorter terms must match exactly, and so must stems: most words are one edit from some stem.
LEAST_LETTERS_FOR_EDIT = 5
WINDOW_WORDS = 8
QUOTE_CHARACTERS = 120
SLICE_BYTES = 1 << 20
#: Of other texts, one in so many is counted first, for all terms. A term that is as common in other
#: texts as in toxic ones stands in 20 times as many as LEAST_LOG_ODDS allows, and in this part of
#: them still in more than twice as many.
SCOUTS = 8
#: Terms that are looked for in all texts are broadcast up to that many bytes, as counted beforehand.
MAP_BYTES = 32 << 20
#: The lexicon's automaton takes some 10 KB a term in every worker; a larger lexicon is refused.
MOST_TERMS = 20_000

#: Marks that open or close a quotation, words that introduce one.
QUOTES = "\"“”„«»"
SAYING = ("said", "says", "quote", "quoted", "called", "sagte", "zitat", "dit", "citation", "dijo", "cita")

FEATURES = ("stem", "exact", "misspelled", "quoted", "clustered", "share")

_LETTERS: list[np.ndarray] = []


def letters() -> np.ndarray:
    """Per code point: 1 for letters, 2 for digits, 3 for quotation marks, 4 for line ends."""
    if not _LETTERS:
        kinds = np.zeros(0x110000, np.uint8)
        kinds[[c for c in range(0x110000) if chr(c).isalpha()]] = 1
        kinds[ord("0") : ord("9") + 1] = 2
        kinds[[ord(c) for c in QUOTES]] = 3
        kinds[ord("\n")] = 4
        _LETTERS.append(kinds)
    return _LETTERS[0]


@dataclass
class Automaton:
    """``table[state, letter]`` is the next state, 0 the dead one, 1 the start.

    ``result[state]`` says what a word that ends there is: 0 nothing, 1 a word with one edit, 2 a
    word of the lexicon; ``stem[state]`` whether it has just passed the end of a stem.
    """

    alphabet: dict[str, int]
    table: np.ndarray
    result: np.ndarray
    stem: np.ndarray


def compiled(words: list[str], stems: list[str], edits: int = 1) -> Automaton:
    """The trie of the terms, intersected with the automata of strings within ``edits`` of them."""
    alphabet = {c: i + 1 for i, c in enumerate(sorted(set("".join([*words, *stems]))))}  # 0: any other
    children: list[dict[int, int]] = [{}]
    is_word, is_stem, budget = [False], [False], [0]

    def add(term: str, flag: list[bool], allowed: int) -> None:
        node = 0
        budget[0] = max(budget[0], allowed)
        for c in term:
            if alphabet[c] not in children[node]:
                children[node][alphabet[c]] = len(children)
                children.append({})
                is_word.append(False)
                is_stem.append(False)
                budget.append(0)
            node = children[node][alphabet[c]]
            budget[node] = max(budget[node], allowed)
        flag[node] = True

    for w in words:
        add(w, is_word, edits if len(w) >= LEAST_LETTERS_FOR_EDIT else 0)
    for s in stems:
        add(s, is_stem, 0)

    def closed(items: dict[int, int]) -> frozenset[tuple[int, int]]:
        """Letters of a term may be left out, at an edit each, as far as a term's budget goes."""
        todo = list(items.items())
        while todo:
            node, spent = todo.pop()
            for child in children[node].values():
                if spent + 1 <= budget[child] and items.get(child, 99) > spent + 1:
                    items[child] = spent + 1
                    todo.append((child, spent + 1))
        return frozenset(items.items())

    def step(state: frozenset, letter: int) -> frozenset:
        out: dict[int, int] = {}
        for node, spent in state:
            ways = [(node, spent + 1)]  # a letter too many
            ways += [(child, spent + (c != letter)) for c, child in children[node].items()]
            for to, cost in ways:
                if cost <= (budget[to] if cost else 99) and out.get(to, 99) > cost:
                    out[to] = cost
        return closed(out)

    start = closed({0: 0})
    numbers, order = {frozenset(): 0, start: 1}, [frozenset(), start]
    rows = [[0] * (len(alphabet) + 1)]
    at = 1
    while at < len(order):
        # letters that continue no term from here lead where an unknown one leads
        row = [0] * (len(alphabet) + 1)
        for letter in [0, *sorted({c for node, _ in order[at] for c in children[node]})]:
            after = step(order[at], letter)
            if after not in numbers:
                numbers[after] = len(order)
                order.append(after)
            if letter:
                row[letter] = numbers[after]
            else:
                row = [numbers[after]] * len(row)
        rows.append(row)
        at += 1

    def end(state: frozenset) -> int:
        best = [spent for node, spent in state if is_word[node] and (spent == 0 or spent <= budget[node])]
        return 0 if not best else 2 if min(best) == 0 else 1

    return Automaton(
        alphabet, np.array(rows, np.int32), np.array([end(s) for s in order], np.uint8),
        np.array([any(is_stem[n] and spent == 0 for n, spent in s) for s in order], bool),
    )


def matches(automaton: Automaton, codes: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per word: 0, 1 or 2 as in ``result``; whether it begins with a stem."""
    classes = np.zeros(0x110000, np.uint16)
    for c, i in automaton.alphabet.items():
        classes[ord(c)] = i
    state = np.ones(len(starts), np.int32)
    stem = np.zeros(len(starts), bool)
    result = np.zeros(len(starts), np.uint8)
    alive = np.arange(len(starts))
    depth = 0
    while len(alive):
        done = sizes[alive] == depth
        result[alive[done]] = automaton.result[state[alive[done]]]
        alive = alive[~done]
        state[alive] = automaton.table[state[alive], classes[codes[starts[alive] + depth]]]
        alive = alive[state[alive] != 0]
        stem[alive] |= automaton.stem[state[alive]]
        depth += 1
    return result, stem


def features(texts: list[str], automaton: Automaton) -> np.ndarray:
    """One row of FEATURES per text."""
    kinds = letters()
    codes = [np.frombuffer(t.lower().encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
    gap = np.array([ord("\n")], np.uint32)
    chars = np.concatenate([x for c in codes for x in (c, gap)]) if texts else gap
    kind = kinds[chars]
    word = (kind == 1) | (kind == 2)
    edge = np.flatnonzero(np.diff(np.r_[False, word, False]))
    starts, sizes = edge[::2], edge[1::2] - edge[::2]
    text_ends = np.cumsum([len(c) + 1 for c in codes])
    of = np.searchsorted(text_ends, starts, "right")
    result, stem = matches(automaton, chars, starts, sizes)
    hit = np.flatnonzero((result > 0) | stem)
    out = np.zeros((len(texts), len(FEATURES)))
    if not len(hit):
        return out
    quoted = in_quotes(chars, kind, starts, sizes, hit)
    place, doc = hit, of[hit]
    near = np.zeros(len(hit), bool)
    close = (np.diff(place) <= WINDOW_WORDS) & (doc[1:] == doc[:-1])
    near[1:] |= close
    near[:-1] |= close
    free = ~quoted
    for column, which in enumerate((
        free & stem[hit] & (result[hit] != 2), free & (result[hit] == 2),
        free & (result[hit] == 1) & ~stem[hit], quoted, free & near,
    )):
        out[:, column] = np.bincount(doc[which], minlength=len(texts))
    words = np.maximum(np.bincount(of, minlength=len(texts)), 1)
    out[:, 5] = 100 * np.bincount(doc[free], minlength=len(texts)) / words
    return np.log1p(out)


def in_quotes(chars, kind, starts, sizes, hit) -> np.ndarray:
    """Whether a match has a quotation mark on either side in its line, or a word of saying before."""
    marks, lines = np.flatnonzero(kind == 3), np.flatnonzero(kind == 4)
    begin, end = starts[hit], starts[hit] + sizes[hit]
    last_line = np.r_[-1, lines][np.searchsorted(lines, begin)]
    next_line = np.r_[lines, len(chars)][np.searchsorted(lines, end)]
    before = np.r_[-1, marks][np.searchsorted(marks, begin)]
    after = np.r_[marks, 2 * len(chars)][np.searchsorted(marks, end)]
    between = (before > last_line) & (after < next_line) & (after - before <= QUOTE_CHARACTERS)
    # an even number of marks in the line before means that the last one closed a quotation
    opened = (np.searchsorted(marks, begin) - np.searchsorted(marks, last_line)) % 2 == 1
    said = np.zeros(len(hit), bool)
    for i, w in enumerate(hit):
        for k in range(max(w - 3, 0), w):
            if starts[k] > last_line[i] and sizes[k] <= 8:
                said[i] |= chars[starts[k] : starts[k] + sizes[k]].tobytes().decode("utf-32-le") in SAYING
    return (between & opened) | said


def fold(column: str = "doc_id") -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary")) % FOLDS


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of all rows to learn from, written."""
    known = labels.filter((fold() != HELD_OUT) & F.col("toxic").isin(0, 1))
    return stored(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "labelled")


def sampled(docs: DataFrame, known: DataFrame, rows: int) -> tuple[DataFrame, dict[int, float]]:
    """(doc_id, text, toxic) of a sample of the labelled rows, and each label's share in it."""
    sizes = {r.toxic: r.n for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, rows / n) for k, n in sizes.items()}
    drawn = F.pmod(F.xxhash64(F.col("doc_id"), F.lit("toxicity sample")), F.lit(1_000_000)) / 1_000_000
    wanted = F.when(F.col("toxic") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0))
    chosen = known.filter(drawn < wanted).withColumnRenamed("doc_id", "id")
    # at most about twice ``rows`` pairs of numbers
    picked = docs.select("doc_id", text_or_empty().alias("text")).join(
        F.broadcast(chosen), F.col("doc_id") == F.col("id")
    )
    return stored(picked.select("doc_id", "text", "toxic"), "sample"), share


def may_be_misspelled(term: str) -> bool:
    """Whether the term is a whole word that is matched with an edit."""
    return not term.endswith("*") and len(term) >= LEAST_LETTERS_FOR_EDIT


def distinct_texts(rows: DataFrame, known: DataFrame) -> DataFrame:
    """(id, mark, toxic): one labelled row for each text, so that copies of a text count once.

    A text counts as toxic if one of its labels says so.
    """
    marks = rows.select("doc_id", "mark").join(known, "doc_id")
    first = marks.groupBy("mark").agg(F.min("doc_id").alias("id"), F.max("toxic").alias("toxic"))
    return stored(first, "texts")


def words_of(text: str) -> Column:
    """The distinct words of a text, between blanks."""
    return F.array_join(F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+")), " ")


def terms_of(words: str) -> Column:
    """Distinct words between blanks and their stems, marked by an asterisk."""
    terms = F.flatten(F.transform(F.split(words, " "), lambda w: F.array(
        F.when(w != "", w), *[F.when(F.char_length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS]
    )))
    return F.array_distinct(F.array_compact(terms))


def marking(a: str, b: str, toxic: int, other: int, tried: int) -> Column:
    """Whether a term in ``a`` of the toxic texts and ``b`` of the others marks toxic ones.

    At the same ``a`` a term that does not mark with ``b`` texts does not with more of them.
    """
    more, less = F.col(a) + 0.5, F.col(b) + 0.5
    odds = F.log(more / (toxic + 1 - F.col(a))) - F.log(less / (other + 1 - F.col(b)))
    # one standard error down, so that rare terms need more of a difference
    sure = odds - F.sqrt(1 / more + 1 / less)
    # Chernoff's bound: of all terms tried, fewer than one passes by chance
    n, base = F.col(a) + F.col(b), toxic / (toxic + other)
    chance = F.col(a) * F.log(F.col(a) / n / base)
    chance += F.when(F.col(b) > 0, F.col(b) * F.log(F.col(b) / n / (1 - base))).otherwise(0.0)
    return (F.col(a) >= LEAST_TEXTS) & (sure >= LEAST_LOG_ODDS) & (chance >= math.log(max(tried, 1)))


def term_counts(docs: DataFrame, known: DataFrame) -> tuple[DataFrame, Column] | None:
    """(term, a, b) of terms that may mark toxic texts, over all labelled rows, and which of them do.

    First the words of toxic texts and of one other text in SCOUTS meet their labels. That gives
    ``a``, and a part of ``b`` by which nearly all terms are too common already: more texts cannot make
    them mark. What is left is counted in all other texts where they lie, and of a text only the
    numbers of such terms that it has move, to meet its label. A fixed-size filter of ids keeps
    unlabelled texts from being looked at.
    """
    text = text_or_empty()
    rows = docs.filter(fold() != HELD_OUT).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")
    )
    texts = distinct_texts(rows, known)
    sizes = texts.agg(
        F.count_if(F.col("toxic") == 1).alias("toxic"), F.count_if(F.col("toxic") == 0).alias("other")
    ).first()
    if not sizes.toxic or not sizes.other:
        return None
    texts = texts.withColumnRenamed("mark", "of")
    others = texts.filter(F.col("toxic") == 0)

    def own(rows: DataFrame, chosen: DataFrame) -> DataFrame:
        return rows.join(chosen, (F.col("doc_id") == F.col("id")) & (F.col("mark") == F.col("of")))

    scouts = texts.filter((F.col("toxic") == 1) | (F.pmod("of", F.lit(SCOUTS)) == 0))
    first = may_hold(rows, id_filter(scouts, "id"), "doc_id").select("doc_id", "mark", words_of("text").alias("words"))
    # repeated rows of a text are one text
    first = own(first, scouts).groupBy("mark", "toxic").agg(F.first("words").alias("words"))
    counted = first.select("toxic", F.explode(terms_of("words")).alias("term")).groupBy("term").agg(
        F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("least")
    )
    counted = stored(counted.filter("a > 0"), "toxic_terms")
    rule = (sizes.toxic, sizes.other, counted.count())
    left = counted.filter(marking("a", "least", *rule))
    left = stored(left.select("term", "a", F.xxhash64("term").alias("number")), "candidates")
    bulk = left.agg(F.sum(F.octet_length("term") + 100).alias("n")).first().n or 0

    found = may_hold(rows, id_filter(others, "id"), "doc_id").select("doc_id", "mark", words_of("text").alias("words"))
    found = found.select("doc_id", "mark", F.explode(terms_of("words")).alias("found"))
    # a map of that many bytes at most; beyond it Spark joins the terms as it sees fit
    wanted = left.select("term", "number")
    found = found.join(F.broadcast(wanted) if bulk <= MAP_BYTES else wanted, F.col("found") == F.col("term"))
    found = own(found.select("doc_id", "mark", "number"), others).select("mark", "number").distinct()
    b = found.groupBy(F.col("number").alias("n_b")).agg(F.count("*").alias("b"))
    counts = left.join(b, F.col("number") == F.col("n_b"), "left").select("term", "a", F.coalesce("b", F.lit(0)).alias("b"))
    return stored(counts, "terms"), marking("a", "b", *rule)


def lexicon(docs: DataFrame, known: DataFrame) -> tuple[list[str], list[str]]:
    """Words and stems that mark toxic texts, counted over all labelled rows."""
    counted = term_counts(docs, known)
    if counted is None:
        return [], []
    counts, marks = counted
    # a row per term that marks toxic texts; no text
    found = [r.term for r in counts.filter(marks).select("term").limit(MOST_TERMS + 1).collect()]
    if len(found) > MOST_TERMS:
        raise ValueError(f"more than {MOST_TERMS} terms mark toxic texts: the automaton would not fit a worker's memory")
    stems: list[str] = []
    taken: set[str] = set()
    for stem in sorted((t[:-1] for t in found if t.endswith("*")), key=lambda t: (len(t), t)):
        if not any(stem[:k] in taken for k in STEMS if k < len(stem)):
            stems.append(stem)
            taken.add(stem)
    # a word that begins with a stem is found by it, but misspellings of the word are not
    words = [
        t for t in sorted(found)
        if not t.endswith("*") and (may_be_misspelled(t) or not any(t[:k] in taken for k in STEMS))
    ]
    return words, stems


def regression(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients and intercept by Newton's method, with a ridge on the coefficients."""
    x = np.c_[x, np.ones(len(x))]
    penalty = ridge * np.r_[np.ones(x.shape[1] - 1), 1e-3]
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = x.T @ (x * (weight * p * (1 - p))[:, None]) + np.diag(penalty)
        step = np.linalg.solve(h, x.T @ (weight * (p - y)) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def scored(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, n_matches per row.

    Learns only from labels of 0 or 1 outside the held-out fold; a doc_id that is labelled twice
    counts as toxic if one label says so. Without any, no text has a match and all score the same.
    NULL and empty texts are scored as texts without a match. A NULL doc_id is not held out.
    """
    known = labelled(labels)
    sample, share = sampled(docs, known, sample_rows)
    words, stems = lexicon(docs, known)
    automaton = compiled(words, stems)
    columns = ", ".join(f"{f} double" for f in FEATURES)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2)
            for first, last in slices(texts, SLICE_BYTES):
                found = features(texts.slice(first, last - first).to_pylist(), automaton)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(first, last - first) for k in (0, 1)), *(pa.array(c) for c in found.T.copy())],
                    names=["doc_id", "mark", *FEATURES],
                )

    # a few numbers per row of the sample
    known = sample.select("doc_id", "toxic", "text").mapInArrow(measure, f"doc_id long, mark int, {columns}").toPandas()
    y = known["mark"].to_numpy()
    weight = np.where(y == 1, 1 / share.get(1, 1.0), 1 / share.get(0, 1.0)) if len(y) else np.zeros(0)
    w = regression(known[list(FEATURES)].to_numpy(float), y, weight)

    held = F.coalesce(fold() == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long"), held.cast("int").alias("mark"), text_or_empty().alias("text"))
    rows = rows.mapInArrow(measure, f"doc_id long, mark int, {columns}")
    logit = sum((F.col(f) * float(c) for f, c in zip(FEATURES, w)), F.lit(float(w[-1])))
    matched = sum((F.exp(f) - 1 for f in ("stem", "exact", "misspelled", "quoted")), F.lit(0.0))
    rows = rows.withColumn("score", 1 / (1 + F.exp(-logit)))
    return rows.select(
        "doc_id", (F.col("mark") == 1).alias("held_out"), "score",
        F.when(F.col("score") >= THRESHOLD, 1).otherwise(0).alias("predicted"),
        F.round(matched).cast("long").alias("n_matches"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
