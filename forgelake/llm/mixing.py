"""Mixing sources to target weights by Poisson replication.

A source that should make up a share ``w`` of the mix and holds ``n`` of the corpus' ``N`` characters
is repeated ``w * N / n`` times on average. Each document draws its number of copies from the
Poisson distribution with that mean: a uniform number, hashed from seed and document, is put
through the inverse of the distribution function. A rerun draws the same numbers, and no document
needs to know of another. The copies then go to random places of the whole output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import stored, table

SEED = 17
TEMPERATURE = 0.5
#: No single draw has a larger mean: documents of a source that needs more draw several times.
MOST_AT_ONCE = 8.0
#: Steps of the distribution function; beyond it lies less than 1e-20 at a draw's largest mean.
STEPS = 64
#: Size of a document without words: it costs something to keep.
LEAST_SIZE = 1

#: Fixed value: hexadecimal digits of a 52-bit number.
DIGITS = 13


def size_of(text: Column) -> Column:
    return F.greatest(F.lit(LEAST_SIZE), F.length(F.coalesce(text, F.lit("")))).cast("long")


def uniform(seed: int, purpose: str, *parts: Column) -> Column:
    """A number in [0, 1) that depends only on the seed and the parts."""
    text = F.concat_ws("|", F.lit(f"{seed}|{purpose}"), *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, DIGITS), 16, 10).cast("double") / F.lit(float(16**DIGITS))


def poisson_steps(mean: Column) -> Column:
    """The distribution function at 0, 1, 2, ...: an array of STEPS numbers."""
    start = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("all")
    )

    def step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        c = acc["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(acc["all"], F.array(c)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS - 1)), start, step, lambda acc: acc["all"])


def source_means(
    docs: DataFrame, temperature: float = TEMPERATURE, weights: DataFrame | None = None,
) -> DataFrame:
    """Per source: its size, its mean repetition, its draws and the steps of a draw's distribution.

    A mean above MOST_AT_ONCE is dealt evenly over several draws: the sum of Poisson numbers is
    Poisson again.

    ``weights`` (source, weight) gives the target shares; a source without a row has weight 0.
    Without it, shares follow size to the power of ``temperature``.
    """
    sizes = docs.groupBy("source").agg(F.sum(size_of(F.col("text"))).alias("size"))
    if weights is None:
        sizes = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(temperature)))
    else:
        given = weights.select(F.col("source").alias("of"), F.col("weight").cast("double"))
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        sizes = sizes.withColumn("weight", F.coalesce("weight", F.lit(0.0)))
    all_size, all_weight = sizes.agg(F.sum("size")).scalar(), sizes.agg(F.sum("weight")).scalar()
    mean = F.col("weight") / F.nullif(all_weight, F.lit(0.0)) * all_size / F.col("size")
    mean = F.coalesce(mean, F.lit(0.0))
    draws = F.greatest(F.lit(1), F.ceil(F.col("mean") / MOST_AT_ONCE)).cast("int")
    return (
        sizes.withColumn("mean", F.round(mean, 6))
        .withColumn("draws", draws)
        .select("source", "size", "mean", "draws", poisson_steps(F.col("mean") / F.col("draws")).alias("steps"))
    )


def mixed(docs: DataFrame, weights: DataFrame | None = None, seed: int = SEED,
          temperature: float = TEMPERATURE) -> DataFrame:
    """The columns of ``docs`` plus ``mean``, ``copy`` (from 1) and ``place`` in [0, 1).

    Rows come in the order of ``place`` within each partition, and partitions hold random rows.
    The draw depends on doc_id alone, so repeated rows get equal numbers of copies. Rows without a
    doc_id draw by their text and their place in the input, each for itself, so that equal ones
    spread too; only their draws change if the input is laid out anew. A NULL source is a source of its
    own. Columns that are called like those added are replaced.
    """
    docs = docs.drop("mean", "copy", "place")
    means = stored(source_means(docs.select("source", "text"), temperature, weights), "means")
    means = means.select(F.col("source").alias("of"), "mean", "draws", "steps")
    nameless = F.concat_ws("-", F.lit("none"), F.xxhash64("text").cast("string"), F.monotonically_increasing_id().cast("string"))
    own = F.coalesce(F.col("doc_id").cast("string"), nameless)
    rows = docs.select(F.struct(*docs.columns).alias("row"), own.alias("own"))
    # Spark broadcasts the means if their table is small and splits a heavy source otherwise.
    rows = rows.join(means, F.col("row.source").eqNullSafe(F.col("of")))
    rows = rows.withColumn("drawn", uniform(seed, "copies", F.col("own")))
    copies = F.size(F.filter("steps", lambda c: c <= F.col("drawn")))
    more = F.aggregate(
        F.sequence(F.lit(2), F.greatest(F.col("draws"), F.lit(2))), copies,
        lambda total, k: total + F.size(F.filter("steps", lambda c: c <= uniform(seed, "copies", F.col("own"), k))),
    )
    rows = rows.withColumn("copies", F.when(F.col("draws") == 1, copies).otherwise(more))
    rows = rows.filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    rows = rows.withColumn("place", uniform(seed, "place", F.col("own"), F.col("copy")))
    return (
        rows.select("row.*", "mean", "copy", "place")
        .repartition("place")
        .sortWithinPartitions("place", "copy")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "source", "copy", "place", F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"))


#: The same draw in DuckDB.
SQL = f"""
WITH docs AS (SELECT doc_id, source, text FROM documents),
sizes AS (
  SELECT source, sum(greatest({LEAST_SIZE}, length(coalesce(text, ''))))::BIGINT AS size
  FROM docs GROUP BY source),
means AS (
  SELECT source, coalesce(round(
    pow(size, {TEMPERATURE}) / sum(pow(size, {TEMPERATURE})) OVER () * sum(size) OVER () / size, 6), 0) AS mean FROM sizes),
draws AS (SELECT source, mean, greatest(1, ceil(mean / {MOST_AT_ONCE}))::INTEGER AS draws FROM means),
terms AS (
  SELECT source, draws, k, exp(-mean / draws) * pow(mean / draws, k) / gamma(k + 1) AS p
  FROM draws, range({STEPS}) AS r(k)),
steps AS (
  SELECT source, draws, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms),
lists AS (SELECT source, draws, list(c ORDER BY k) AS cs FROM steps GROUP BY source, draws),
numbers AS (
  SELECT d.doc_id, d.source, d.text, l.cs, unnest(range(1, l.draws + 1)) AS draw
  FROM docs d JOIN lists l ON d.source IS NOT DISTINCT FROM l.source),
hits AS (
  SELECT doc_id, source, text, len(list_filter(cs, lambda c: c <=
    ('0x' || substr(md5('{SEED}|copies|' || coalesce(doc_id::VARCHAR, '') || CASE WHEN draw > 1 THEN '|' || draw ELSE '' END),
                    1, {DIGITS}))::BIGINT / {16**DIGITS}.0::DOUBLE)) AS n
  FROM numbers),
drawn AS (SELECT doc_id, source, text, sum(n)::BIGINT AS n FROM hits GROUP BY ALL),
copies AS (SELECT doc_id, source, text, unnest(range(1, n + 1))::INTEGER AS copy FROM drawn)
SELECT doc_id, source, copy,
  ('0x' || substr(md5('{SEED}|place|' || coalesce(doc_id::VARCHAR, '') || '|' || copy), 1, {DIGITS}))::BIGINT
    / {16**DIGITS}.0::DOUBLE AS place,
  md5(coalesce(text, '')) AS text_md5
FROM copies
"""
