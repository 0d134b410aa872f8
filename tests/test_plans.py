"""What the plans must look like: where rows move, what reaches the files, what is broadcast."""

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from forgelake.operators.facts import fact
from forgelake.operators.silver import flatten
from forgelake.plans import analytics as A
from forgelake.plans import marts as M
from forgelake.plans.gold import transform_to_gold
from forgelake.schemas import FACTS
from forgelake.session import settings
from forgelake.testbed.adapter import raw_events
from forgelake.testbed.queries import ANALYTICS, MARTS, QUERIES, gold_of


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return plan(df).count("Exchange hashpartitioning")


@pytest.fixture
def no_broadcasts(spark):
    """Broadcasts left to hints, as they would be with large dimensions."""
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        yield


@pytest.fixture
def gold(spark, tmp_path, no_broadcasts):
    made = transform_to_gold(flatten(raw_events(spark, SMALL)))
    for name, df in made.items():
        df.write.parquet(f"{tmp_path}/{name}")
    return {name: spark.read.parquet(f"{tmp_path}/{name}") for name in made}


@pytest.mark.parametrize("name", [*ANALYTICS, *MARTS, "silver_sparse", "dim_repo", "reopen_rate"])
def test_plans_stay_in_the_engine(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    for bad in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in text


def test_silver_and_facts_move_no_rows(spark):
    silver = flatten(raw_events(spark, SMALL))
    assert "Exchange" not in plan(silver)
    for name in FACTS:
        assert "Exchange" not in plan(fact(silver, name))


def test_names_are_found_by_hash_aggregates_over_events(spark):
    text = plan(gold_of(spark, SMALL)["dim_repo"])
    # Only the few (key, name) rows behind the first shuffle are sorted.
    first_shuffle = text.index("Exchange", text.index("SortAggregate"))
    below = text[text.rindex("Exchange"):]
    assert "HashAggregate" in below and "Sort" not in below and first_shuffle > 0


def test_scans_read_only_what_a_question_needs(gold):
    text = plan(A.monthly_commits(gold))
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,PushEvent)" in text
    assert "ReadSchema: struct<date_id:int,repo_id:bigint,event_type:string,push_commit_count:int>" in text


def test_shuffles_of_the_larger_questions(gold):
    # One per aggregate and one for the dimension: aggregates meet as they are partitioned.
    assert shuffles(A.repo_health(gold, ordered=False)) == 3
    # Creations and deletions, none for the join itself; branches made a million times are dealt out.
    branches = A.live_branches(gold)
    branches.collect()
    final = plan(branches).split("== Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") <= 3
    # One scan of the forks, and a shuffle for each side of both joins.
    assert plan(A.fork_log(gold)).split("== Initial Plan ==")[0].count("fact_community") <= 1
    assert shuffles(A.fork_log(gold)) == 4
    assert plan(A.monthly_commits(gold, ordered=False)).count("BroadcastExchange") == 1


def test_issue_events_are_aggregated_once(gold):
    # Some issues are closed before they are opened, so that both ways are taken.
    early = F.col("created_at") - F.expr("IF(issue_action = 'closed', INTERVAL 9 DAY, INTERVAL 0 DAY)")
    gold["fact_issue_lifecycle"] = gold["fact_issue_lifecycle"].withColumn("created_at", early)
    df = M.issue_resolution(gold)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final


def test_copies_of_one_row_are_split_at_run_time(spark, no_broadcasts, tmp_path):
    events = spark.range(0, 400_000, 1, 8)
    events.selectExpr("IF(id % 3 = 0, 5, id) AS k", "IF(id % 3 = 0, 0, id) AS v").write.parquet(
        f"{tmp_path}/left"
    )
    left = spark.read.parquet(f"{tmp_path}/left")
    # The right side is an aggregate, as a dimension made on the fly is.
    right = spark.range(400_000).selectExpr("id AS k", "id % 7 AS n").groupBy("k").agg(F.max("n").alias("n"))
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    with settings(spark, small):
        joined = left.join(right, "k")
        assert len(joined.collect()) == 400_000
        assert "SortMergeJoin(skew=true)" in plan(joined)
