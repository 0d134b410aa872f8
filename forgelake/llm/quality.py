"""Quality rules: plain limits, then robust multivariate outliers per language and source.

Everything is DataFrame code. One pass over the texts makes a small numeric table; all that
follows reads only that table. Per group the minimum covariance determinant is sought as DetMCD
does: from several fixed starts, take the half of the rows nearest to the centre, estimate mean and
covariance from them, measure all rows again, until no determinant falls any more; the estimate with
the smallest one is used. A row is rejected if its squared Mahalanobis distance is far out. Means and covariances are plain sums, so a group that holds a
third of all rows is added up in every task and only its sums are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import stored, table

LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
#: Share of a group's rows that the estimate rests on.
CORE_SHARE = 0.5
#: The steps end once no logarithm of a determinant changes by more; quantiles are approximate, which
#: lets it waver by a little. A group that still wavers after MOST_STEPS takes what it has then: any
#: step is an estimate from half of its rows.
STABLE = 0.01
MOST_STEPS = 40
#: Rank accuracy of quantiles.
ACCURACY = 10_000
#: Starts of the search: deviations alone, spatial signs, and hyperbolic tangents of the parts.
STARTS = ("0", "1", "2")
#: Repeated windows of a text up to which its places are found by search, not by sorting.
FEW_REPEATS = 64
#: Groups below this size are pooled by language, then all together.
LEAST_GROUP = 200
#: Up to so many groups, tables of a row per group are written as one file: many nearly empty files
#: would look too large to broadcast, and a join by group would bring a heavy one to one task.
FEW_GROUPS = 20_000
#: Fixed value: median of the chi-square distribution with 7 degrees of freedom.
CHI2_MEDIAN = 6.3458
#: Squared distance beyond which a row is rejected: it differs from its group in kind, not in degree.
CUTOFF = 250.0

#: The characters of the contract.
WHITE = r"[\x20\x09-\x0D]+"
NOT_WHITE = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]+"
MARKS = r"[!?\"'()+,\-./:;=@\[\]\\^_`{}~]+"
CAPITALS = r"[A-Z]+"

#: The measured vector, and the least standard deviation that each part is given: clean groups
#: have none of some things, and the first of them should not be infinitely far away.
PARTS = {
    "v_length": ("ln(n_words)", 0.7),
    "v_word": ("ln(word_chars / n_words)", 0.1),
    "v_symbols": ("sqrt(n_symbols / word_chars)", 0.04),
    "v_marks": ("sqrt(n_marks / word_chars)", 0.06),
    "v_capitals": ("sqrt(n_capitals / word_chars)", 0.08),
    "v_repeats": ("sqrt(n_repeat_words / n_words)", 0.15),
    "v_lines": ("sqrt(n_dup_lines / n_lines)", 0.2),
}
NAMES = list(PARTS)
#: The logarithm of an estimate's determinant.
DETERMINANT = " + ".join(f"2 * ln(l_{i}_{i})" for i in range(len(NAMES)))
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def count_of(text: Column, pattern: str) -> Column:
    """Characters that the pattern covers."""
    return (F.char_length(text) - F.char_length(F.regexp_replace(text, pattern, ""))).cast("long")


def window_hashes(words: Column) -> Column:
    """A hash for each window of three words."""
    last = F.size(words) - 2
    hashes = F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))),
        lambda i: F.xxhash64(
            F.try_element_at(words, i), F.try_element_at(words, i + 1), F.try_element_at(words, i + 2)
        ),
    )
    return F.slice(hashes, 1, F.greatest(last, F.lit(0)))


def tail(array: Column) -> Column:
    return F.slice(array, 2, F.greatest(F.size(array), F.lit(1)))


def repeated(order: Column) -> Column:
    """The values that a sorted array has at least twice, found as equal neighbours."""
    twice = F.zip_with(order, tail(order), lambda a, b: F.when(a == b, a))
    return F.array_distinct(F.array_compact(twice))


def repeat_places(hashes: Column, repeats: Column) -> Column:
    """Where these values stand, in ascending order."""
    few = F.filter(
        F.sequence(F.lit(1), F.greatest(F.size(hashes), F.lit(1))),
        lambda i: F.array_contains(repeats, F.try_element_at(hashes, i)),
    )
    # with many repeated values it costs less to sort the hashes with their places
    order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    after = F.zip_with(order, tail(order), lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False)))
    before = F.concat(F.array(F.lit(False)), F.slice(after, 1, F.greatest(F.size(after) - 1, F.lit(0))))
    either = F.zip_with(after, before, lambda a, b: a | b)
    many = F.array_compact(F.zip_with(order, either, lambda o, e: F.when(e, o["i"] + 1)))
    none = F.array().cast("array<int>")
    return (
        F.when(F.size(repeats) == 0, none)
        .when(F.size(repeats) <= FEW_REPEATS, few)
        .otherwise(F.array_sort(many))
    )


def covered_words(places: Column) -> Column:
    """Words under windows of three that start at these places."""
    steps = F.zip_with(places, tail(places), lambda a, b: F.least(F.lit(3), b - a))
    return F.aggregate(steps, F.lit(0), lambda total, step: total + step).cast("long")


def measured(docs: DataFrame, column: str = "text") -> DataFrame:
    """``docs`` with the base columns and the counts behind the vector; NULL text has no words."""
    body = F.coalesce(F.col(column).cast("string"), F.lit(""))
    rows = docs.withColumn("q_text", body)
    rows = rows.withColumn("q_words", F.array_remove(F.split("q_text", WHITE), ""))
    lines = F.filter(F.split("q_text", "\n"), lambda line: F.rlike(line, F.lit(NOT_WHITE)))
    rows = rows.withColumn("q_lines", lines)
    # one step at a time: an expression that is used twice would be evaluated twice
    rows = rows.withColumn("q_hashes", window_hashes(F.col("q_words")))
    # not array_sort, which compares through an expression; hashes are never NULL
    rows = rows.withColumn("q_order", F.sort_array("q_hashes"))
    rows = rows.withColumn("q_repeats", repeated(F.col("q_order")))
    rows = rows.withColumn("q_places", repeat_places(F.col("q_hashes"), F.col("q_repeats")))
    text, words = F.col("q_text"), F.col("q_words")
    return rows.select(
        *docs.columns,
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
        count_of(text, SYMBOLS).alias("n_symbols"),
        (F.size("q_lines") - F.size(F.array_distinct("q_lines"))).cast("long").alias("n_dup_lines"),
        covered_words(F.col("q_places")).alias("n_repeat_words"),
        F.size("q_lines").cast("long").alias("n_lines"),
        count_of(text, MARKS).alias("n_marks"),
        count_of(text, CAPITALS).alias("n_capitals"),
    ).withColumn(
        "base_failed",
        (F.col("n_words") < LEAST_WORDS)
        | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")),
    )


def per_group(rows: DataFrame, name: str, few: bool) -> DataFrame:
    """A table of a row per group, written."""
    return stored(rows.coalesce(1) if few else rows, name)


def grouped(rows: DataFrame) -> tuple[DataFrame, bool]:
    """The rows with ``q_group``, and whether there are few groups.

    The group is NULL where too few rows are alike for an estimate.
    """
    lang = F.coalesce(F.col("q_lang"), F.lit(""))
    source = F.coalesce(F.col("q_source"), F.lit(""))
    keyed = rows.withColumn("q_fine", F.concat_ws("\x1f", lang, source)).withColumn("q_pool", lang)

    def sizes(key: str, name: str) -> DataFrame:
        counts = keyed.filter("NOT base_failed").groupBy(key).agg(F.count("*").alias(name))
        return counts.withColumnRenamed(key, f"{name}_of")

    groups = Observation()
    fine = stored(sizes("q_fine", "q_n").observe(groups, F.count("*").alias("n")), "groups")
    few = groups.get["n"] <= FEW_GROUPS
    fine = per_group(fine, "groups", few)
    keyed = keyed.join(fine, F.col("q_fine") == F.col("q_n_of"), "left").drop("q_n_of")
    keyed = keyed.withColumn("q_small", F.coalesce("q_n", F.lit(0)) < LEAST_GROUP)
    # what is left over of a language, where its sources are too small
    pooled = keyed.filter("q_small AND NOT base_failed").groupBy("q_pool").agg(F.count("*").alias("q_m"))
    pools = Observation()
    rest = F.sum(F.when(F.col("q_m") < LEAST_GROUP, F.col("q_m"))).alias("rest")
    pooled = per_group(pooled.withColumnRenamed("q_pool", "q_m_of").observe(pools, rest), "groups", few)
    keyed = keyed.join(pooled, F.col("q_pool") == F.col("q_m_of"), "left").drop("q_m_of")
    group = (
        F.when(~F.col("q_small"), F.concat(F.lit("1"), "q_fine"))
        .when(F.col("q_m") >= LEAST_GROUP, F.concat(F.lit("2"), "q_pool"))
        .when(F.lit((pools.get["rest"] or 0) >= LEAST_GROUP), F.lit("3"))
    )
    return keyed.withColumn("q_group", group).drop("q_fine", "q_pool", "q_n", "q_m", "q_small"), few


def factored(out: DataFrame, few: bool, change: Observation | None = None) -> DataFrame:
    """The means and the Cholesky factor, from columns ``m_i`` and ``c_i_j``.

    ``change`` gets the largest change from ``q_before`` to ``q_det`` as the table is written.
    """
    p = range(len(NAMES))
    # one select whose columns refer to those before them: a plan per column would cost the driver dear
    factor = []
    for i in p:
        floor = PARTS[NAMES[i]][1] ** 2
        for j in range(i + 1):
            rest = f"c_{i}_{j}" + (f" + {floor!r}D" if i == j else "")
            rest += "".join(f" - l_{i}_{k} * l_{j}_{k}" for k in range(j))
            # the floor keeps every pivot positive but for rounding
            value = f"sqrt(greatest({rest}, {floor * 1e-3!r}D))" if i == j else f"({rest}) / l_{j}_{j}"
            factor.append(f"{value} AS l_{i}_{j}")
    if change is None:
        return per_group(out.selectExpr("q_group AS q_of", *[f"m_{i}" for i in p], *factor), "spread", few)
    out = out.selectExpr("q_group AS q_of", *[f"m_{i}" for i in p], *factor, f"abs({DETERMINANT} - q_before) AS q_change")
    return per_group(out.observe(change, F.max("q_change").alias("change")).drop("q_change"), "spread", few)


def spread(rows: DataFrame, few: bool = True, change: Observation | None = None) -> DataFrame:
    """Per group the mean ``m_i`` and the Cholesky factor ``l_i_j`` of the floored covariance."""
    p = range(len(NAMES))
    sums = [F.avg(NAMES[i]).alias(f"m_{i}") for i in p]
    sums += [
        F.covar_pop(NAMES[i], NAMES[j]).alias(f"c_{i}_{j}") for i in p for j in p if j <= i
    ]
    if change is not None:
        sums.append(F.max("q_det").alias("q_before"))
    return factored(rows.groupBy("q_group").agg(*sums), few, change)


def first_spread(rows: DataFrame, few: bool) -> DataFrame:
    """The starts, per group and start: medians, and three covariances scaled to the median
    absolute deviations; ``q_of`` is the start followed by the group."""
    p = range(len(NAMES))
    centre = rows.groupBy(F.col("q_group").alias("q_of")).agg(
        *[F.percentile_approx(NAMES[i], 0.5, ACCURACY).alias(f"m_{i}") for i in p]
    )
    centre = per_group(centre, "centre", few)
    off = rows.join(centre, F.col("q_group") == F.col("q_of")).groupBy("q_of").agg(
        *[F.first(f"m_{i}").alias(f"m_{i}") for i in p],
        *[F.percentile_approx(F.abs(F.col(NAMES[i]) - F.col(f"m_{i}")), 0.5, ACCURACY).alias(f"d_{i}") for i in p],
    )
    scale = [
        F.sqrt(F.pow(F.col(f"d_{i}") * 1.4826, 2.0) + PARTS[NAMES[i]][1] ** 2).alias(f"s_{i}") for i in p
    ]
    centre = per_group(off.select("q_of", *[f"m_{i}" for i in p], *scale), "centre", few)
    scaled = rows.join(centre, F.col("q_group") == F.col("q_of")).selectExpr(
        "q_group", *[f"({NAMES[i]} - m_{i}) / s_{i} AS z_{i}" for i in p], *[f"m_{i}" for i in p], *[f"s_{i}" for i in p]
    )
    length = " + ".join(f"z_{i} * z_{i}" for i in p)
    scaled = scaled.selectExpr("*", f"sqrt(greatest({length}, 1e-12D)) AS q_length")
    signs = [f"avg(z_{i} * z_{j} / (q_length * q_length)) AS g_{i}_{j}" for i in p for j in range(i + 1)]
    tangents = [f"covar_pop(tanh(z_{i}), tanh(z_{j})) AS t_{i}_{j}" for i in p for j in range(i + 1)]
    constant = [f"first({x}_{i}) AS {x}_{i}" for x in "ms" for i in p]
    sums = scaled.groupBy("q_group").agg(*[F.expr(e) for e in (*signs, *tangents, *constant)])

    def correlation(x: str, i: int, j: int) -> str:
        return f"CASE WHEN {x}_{i}_{i} * {x}_{j}_{j} > 0 THEN {x}_{i}_{j} / sqrt({x}_{i}_{i} * {x}_{j}_{j}) ELSE 0D END"

    def value(i: int, j: int) -> str:
        # as correlations, so that all starts have the same deviations
        alone = "1D" if i == j else "0D"
        which = f"CASE q_start WHEN '{STARTS[0]}' THEN {alone} WHEN '{STARTS[1]}' THEN {correlation('g', i, j)} ELSE {correlation('t', i, j)} END"
        return f"s_{i} * s_{j} * {which} AS c_{i}_{j}"

    starts = sums.withColumn("q_start", F.explode(F.array(*[F.lit(k) for k in STARTS]))).selectExpr(
        "concat(q_start, q_group) AS q_group", *[f"m_{i}" for i in p], *[value(i, j) for i in p for j in range(i + 1)]
    )
    return factored(starts, few)


def smallest_spread(core: DataFrame, few: bool) -> DataFrame:
    """Per group the estimate with the smallest determinant that the starts lead to."""
    rows = core.withColumn("q_start", F.explode(F.array(*[F.lit(k) for k in STARTS])))
    rows = rows.select(F.concat("q_start", "q_group").alias("q_group"), *NAMES)
    estimate = first_spread(core, few)
    # a step is one query, its test included: every query and broadcast fills the driver's heap
    for step in range(MOST_STEPS):
        far = distances(rows, estimate, f"{DETERMINANT} AS q_det")
        most = limit_of(far, CORE_SHARE, "q_most")
        most = F.broadcast(most.coalesce(1)) if few else stored(most, "limits")
        near = far.join(most, F.col("q_group") == F.col("q_lim")).filter(F.col("q_d2") <= F.col("q_most"))
        change = Observation()
        estimate = spread(near, few, change)
        # the first step starts from no estimate of its own
        if step and (change.get["change"] is None or change.get["change"] <= STABLE):
            break
    found = estimate.withColumn("q_of", F.substring("q_of", 2, 1 << 30)).withColumn("q_det", F.expr(DETERMINANT))
    best = found.groupBy("q_of").agg(F.min(F.struct("q_det", *[c for c in estimate.columns if c != "q_of"])).alias("s"))
    return per_group(best.select("q_of", "s.*").drop("q_det"), "spread", few)


def distances(rows: DataFrame, spread: DataFrame, *more: str) -> DataFrame:
    """The rows with ``q_d2``, the squared Mahalanobis distance within their group.

    ``more`` are further expressions of the group's estimate.
    """
    columns, p = rows.columns, range(len(NAMES))
    steps = [
        f"({NAMES[i]} - m_{i}" + "".join(f" - l_{i}_{j} * z_{j}" for j in range(i)) + f") / l_{i}_{i} AS z_{i}" for i in p
    ]
    total = " + ".join(f"z_{i} * z_{i}" for i in p) + " AS q_d2"
    rows = rows.join(spread, F.col("q_group") == F.col("q_of"), "left")
    rows = rows.selectExpr(*columns, *steps, total, *more)
    return rows.drop(*[f"z_{i}" for i in p])


def limit_of(rows: DataFrame, share: float, name: str) -> DataFrame:
    """Per group the distance within which that share of the rows lies."""
    return rows.groupBy(F.col("q_group").alias("q_lim")).agg(F.percentile_approx("q_d2", share, ACCURACY).alias(name))


def verdicts(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns, the base columns, ``base_failed``, ``distance`` and ``kept``.

    ``docs`` needs text, lang and source; carried columns named like the added ones give way. NULL
    lang or source count as a value of their own. Rows that fail a base rule are not measured
    and have no distance; nor have rows of a group that is too small even when pooled, which are
    kept. Repeated rows count as often as they stand. An empty table gives an empty one.
    """
    added = [*BASE, "base_failed", "distance", "kept"]
    rows = docs.select(
        F.struct(*[c for c in carried if c not in added]).alias("row"), F.col("text").alias("body"),
        F.col("lang").cast("string").alias("q_lang"), F.col("source").cast("string").alias("q_source"),
    )
    rows = measured(rows, "body").drop("body")
    # only rows that pass are measured; all have at least one word
    rows = rows.withColumns({n: F.when(~F.col("base_failed"), F.expr(v)) for n, (v, _) in PARTS.items()})
    # written once, with what is carried; the passes below read only the numbers of it
    rows, few = grouped(stored(rows, "measured"))
    # written as well, so that the passes need no group tables: each broadcast takes the driver's memory
    core = stored(rows.filter("NOT base_failed AND q_group IS NOT NULL").select("q_group", *NAMES), "core")
    estimate = smallest_spread(core, few)
    half = per_group(limit_of(distances(core, estimate), 0.5, "q_half"), "limits", few)
    rows = distances(rows, estimate).join(half, F.col("q_group") == F.col("q_lim"), "left")
    # the core is narrower than its group: scale so that the median row is where it should be
    distance = F.when(~F.col("base_failed"), F.col("q_d2") * CHI2_MEDIAN / F.greatest("q_half", F.lit(1e-9)))
    rows = rows.withColumn("distance", distance)
    kept = ~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= CUTOFF)
    return rows.select("row.*", *BASE, "base_failed", "distance", kept.alias("kept"))


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that all rules keep."""
    rows = docs.select(F.struct(*docs.columns).alias("all"), "text", "lang", "source")
    return verdicts(rows, ["all"]).filter("kept").select("all.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verdicts(table(spark, sf_dir, "documents"), ["doc_id"]).select("doc_id", *BASE, "base_failed", "kept", "distance")
