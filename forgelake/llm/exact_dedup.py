"""Exact dedup by a tree-merge of sorted digest runs.

A text's digest is the SHA-256 of the text with every run of white space made one space. Rows are
dealt to nodes, of which there are a power of RADIX, so that copies of one text spread evenly over
them. Each node sorts its digests to a run and keeps, of equal ones, the smallest identifier and
how many there were.

Runs then meet in binomial rounds, as in a reduction over a hypercube whose sides have RADIX
nodes. In round ``i`` nodes whose numbers differ in digit ``i`` alone exchange their runs: each
cuts its run by digit ``i`` of the digest's home and sends every piece to the node of that digit.
A node so receives RADIX runs of the same share of digests and merges them to one. No node ever
holds more than its share, and a text that makes up a third of the corpus is one row per node
after the first merge. After the last round each digest is at its home, once.

What merges is verified on every level: rows count as equal only if digest, length in bytes and a
second hash all agree, and the identifier that survives carries these along.

All of it is DataFrame code; texts are read once and only digests move.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forgelake.llm.common import stored, table, text_or_empty

#: Bits of a digit, and so how many runs meet in a merge.
RADIX_BITS = 2
RADIX = 1 << RADIX_BITS

#: Fixed value: the white space of the contract.
WHITE = r"[\x20\x09-\x0D]+"

#: What must agree for rows to be equal.
DIGEST = ["digest", "n_bytes", "second_hash"]


def digested(docs: DataFrame, carried: list[str]) -> DataFrame:
    """The carried columns in ``row``, the id, a row number, and the digest of each text; written.

    The number tells repeated rows apart. It holds only within this table, hence the writing.
    """
    rows = docs.select(
        F.struct(*carried).alias("row"), F.col("doc_id").alias("id"),
        F.regexp_replace(text_or_empty(), WHITE, " ").alias("body"),
    )
    rows = rows.select(
        "row", "id", F.monotonically_increasing_id().alias("number"),
        F.unhex(F.sha2("body", 256)).alias("digest"),
        F.octet_length("body").cast("long").alias("n_bytes"),
        F.xxhash64("body").alias("second_hash"),
    )
    return stored(rows, "digests")


def rounds_for(spark: SparkSession) -> int:
    """Rounds that give as many nodes as a shuffle has partitions, or more."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rounds = 1
    while RADIX**rounds < wanted:
        rounds += 1
    return rounds


def merged(pieces: DataFrame, nodes: int) -> DataFrame:
    """The runs that have come to each node as one sorted run, a row per digest."""
    at_node = pieces.repartitionById(nodes, F.col("node")).sortWithinPartitions("node", *DIGEST)
    # the aggregate takes the rows in the order they have: nothing is shuffled or sorted again
    return at_node.groupBy("node", *DIGEST).agg(F.min("smallest").alias("smallest"), F.sum("copies").alias("copies"))


def digit(number: Column, place: int) -> Column:
    """That digit of a number, in its place."""
    return number.bitwiseAND(F.lit((RADIX - 1) << (RADIX_BITS * place)))


def tree_merged(rows: DataFrame, rounds: int | None = None) -> DataFrame:
    """A row per distinct text: DIGEST, ``smallest`` (absent, id, number) and ``copies``.

    ``absent`` puts rows without an id behind all others.
    """
    rounds = rounds_for(rows.sparkSession) if rounds is None else rounds
    nodes = RADIX**rounds
    smallest = F.struct(F.col("id").isNull().alias("absent"), "id", "number")
    dealt = F.pmod(F.xxhash64("number"), F.lit(nodes)).cast("int")
    runs = merged(rows.select(dealt.alias("node"), *DIGEST, smallest.alias("smallest"), F.lit(1).cast("long").alias("copies")), nodes)
    home = F.pmod(F.xxhash64("digest"), F.lit(nodes)).cast("int")
    for place in range(rounds):
        partner = F.col("node") - digit(F.col("node"), place) + digit(home, place)
        runs = merged(runs.withColumn("node", partner), nodes)
    return runs.drop("node")


def groups(docs: DataFrame, carried: list[str], rounds: int | None = None) -> DataFrame:
    """The carried columns plus ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``, a row per row of ``docs``.

    Of equal texts the row with the smallest doc_id stays; of rows that share it, one of them. Rows
    without a doc_id come after all others: keep_id is NULL only where no row of the group has an
    id. A NULL text is an empty one. Carried columns named like those added give way. An empty
    table gives an empty one.
    """
    added = ["keep_id", "group_size", "kept", "text_sha256"]
    rows = digested(docs, [c for c in carried if c not in added])
    repeated = tree_merged(rows, rounds).filter("copies > 1")
    repeated = stored(repeated.select(*[F.col(c).alias(f"of_{c}") for c in DIGEST], "smallest", "copies"), "repeated")
    # both sides come straight out of a shuffle, so that Spark can split a text with very many copies
    same = [F.col(c) == F.col(f"of_{c}") for c in DIGEST]
    found = rows.join(repeated, same, "left")
    alone = F.col("copies").isNull()
    return found.select(
        "row.*",
        F.when(alone, F.col("id")).otherwise(F.col("smallest.id")).alias("keep_id"),
        F.coalesce("copies", F.lit(1)).cast("long").alias("group_size"),
        (alone | (F.col("smallest.number") == F.col("number"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay."""
    rows = docs.select(F.struct(*docs.columns).alias("all"), "doc_id", "text")
    return groups(rows, ["all"]).filter("kept").select("all.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])


SQL = r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""
