"""The data model: what is read from raw events and which columns each table holds."""

# Read schema of a raw event. Only the paths that later layers use are listed, so the
# JSON reader skips the rest of the payload, and a field that is missing from a whole
# day reads as NULL instead of failing analysis.
BRONZE_DDL = """
id STRING, type STRING, created_at STRING,
actor STRUCT<id: BIGINT, login: STRING>,
repo STRUCT<id: BIGINT, name: STRING>,
org STRUCT<id: BIGINT, login: STRING>,
payload STRUCT<
  action: STRING, number: BIGINT, push_id: BIGINT, size: BIGINT, ref: STRING, ref_type: STRING,
  pull_request: STRUCT<id: BIGINT, merged: BOOLEAN>,
  issue: STRUCT<id: BIGINT, number: BIGINT>,
  comment: STRUCT<id: BIGINT>,
  forkee: STRUCT<id: BIGINT, full_name: STRING>>,
_corrupt_record STRING
"""

# Silver column -> path in the raw event, for the columns of every event.
COMMON_PATHS = {
    "event_id": "id",
    "event_type": "type",
    "created_at": "created_at",
    "actor_id": "actor.id",
    "actor_login": "actor.login",
    "repo_id": "repo.id",
    "repo_name": "repo.name",
    "org_id": "org.id",
    "org_login": "org.login",
}

# Event type -> {silver column: (path in the raw event, type)}.
# This is the extension point: a further event type is one more entry.
TYPE_PATHS = {
    "PushEvent": {
        "push_id": ("payload.push_id", "BIGINT"),
        "push_commit_count": ("payload.size", "BIGINT"),
        "push_ref": ("payload.ref", "STRING"),
    },
    "PullRequestEvent": {
        "pr_action": ("payload.action", "STRING"),
        "pr_number": ("payload.number", "BIGINT"),
        "pr_id": ("payload.pull_request.id", "BIGINT"),
        "pr_is_merged": ("payload.pull_request.merged", "BOOLEAN"),
    },
    "IssuesEvent": {
        "issue_action": ("payload.action", "STRING"),
        "issue_id": ("payload.issue.id", "BIGINT"),
        "issue_number": ("payload.issue.number", "BIGINT"),
    },
    "IssueCommentEvent": {
        "comment_action": ("payload.action", "STRING"),
        "comment_target_issue_id": ("payload.issue.id", "BIGINT"),
        "comment_id": ("payload.comment.id", "BIGINT"),
    },
    "WatchEvent": {"watch_action": ("payload.action", "STRING")},
    "ForkEvent": {
        "fork_new_repo_id": ("payload.forkee.id", "BIGINT"),
        "fork_new_repo_name": ("payload.forkee.full_name", "STRING"),
    },
    "CreateEvent": {
        "create_ref_type": ("payload.ref_type", "STRING"),
        "create_ref_name": ("payload.ref", "STRING"),
    },
    "DeleteEvent": {
        "delete_ref_type": ("payload.ref_type", "STRING"),
        "delete_ref_name": ("payload.ref", "STRING"),
    },
}

SILVER_TYPES = {
    "event_id": "STRING",
    "event_type": "STRING",
    "created_at": "TIMESTAMP",
    "actor_id": "BIGINT",
    "actor_login": "STRING",
    "repo_id": "BIGINT",
    "repo_name": "STRING",
    "org_id": "BIGINT",
    "org_login": "STRING",
    **{name: sql_type for fields in TYPE_PATHS.values() for name, (_, sql_type) in fields.items()},
    "event_date": "DATE",
}

# The event types and columns of the three facts. A comment event belongs
# to two facts on purpose, so these filters do not partition silver.
FACTS = {
    "fact_dev_activity": {
        "types": ["PushEvent", "PullRequestEvent", "CreateEvent", "DeleteEvent"],
        "columns": {
            "event_id": "STRING",
            "date_id": "INT",
            "actor_id": "BIGINT",
            "repo_id": "BIGINT",
            "event_type": "STRING",
            "push_commit_count": "INT",
            "push_ref": "STRING",
            "pr_action": "STRING",
            "pr_number": "INT",
            "pr_id": "BIGINT",
            "pr_is_merged": "BOOLEAN",
            "create_ref_type": "STRING",
            "create_ref_name": "STRING",
            "delete_ref_type": "STRING",
            "delete_ref_name": "STRING",
            "created_at": "TIMESTAMP",
        },
    },
    "fact_community": {
        "types": ["WatchEvent", "ForkEvent", "IssueCommentEvent"],
        "columns": {
            "event_id": "STRING",
            "date_id": "INT",
            "actor_id": "BIGINT",
            "repo_id": "BIGINT",
            "org_id": "BIGINT",
            "event_type": "STRING",
            "watch_action": "STRING",
            "fork_new_repo_id": "BIGINT",
            "fork_new_repo_name": "STRING",
            "comment_id": "BIGINT",
            "comment_action": "STRING",
            "comment_target_issue_id": "BIGINT",
            "created_at": "TIMESTAMP",
        },
    },
    "fact_issue_lifecycle": {
        "types": ["IssuesEvent", "IssueCommentEvent"],
        "columns": {
            "event_id": "STRING",
            "date_id": "INT",
            "actor_id": "BIGINT",
            "repo_id": "BIGINT",
            "event_type": "STRING",
            "issue_id": "BIGINT",
            "issue_number": "INT",
            "issue_action": "STRING",
            "comment_id": "BIGINT",
            "comment_action": "STRING",
            "comment_target_issue_id": "BIGINT",
            "created_at": "TIMESTAMP",
        },
    },
}

# The columns of the four shared dimensions (iso_year is an addition: the
# calendar year does not identify an ISO week around New Year).
DIMENSIONS = {
    "dim_date": {
        "date_id": "INT",
        "date_actual": "DATE",
        "year": "INT",
        "month": "INT",
        "day": "INT",
        "quarter": "INT",
        "week_of_year": "INT",
        "weekday_name": "STRING",
        "is_weekend": "BOOLEAN",
        "iso_year": "INT",
    },
    "dim_actor": {
        "actor_id": "BIGINT",
        "actor_login": "STRING",
        "actor_type": "STRING",
        "first_seen_at": "TIMESTAMP",
    },
    "dim_repo": {
        "repo_id": "BIGINT",
        "repo_name": "STRING",
        "org_id": "BIGINT",
        "primary_language": "STRING",
    },
    "dim_org": {"org_id": "BIGINT", "org_name": "STRING", "org_type": "STRING"},
}

# The names under which analysts address the gold tables in SQL.
VIEW_NAMES = {
    "dim_date": "Dim_Date",
    "dim_actor": "Dim_Actor",
    "dim_repo": "Dim_Repo",
    "dim_org": "Dim_Org",
    "fact_dev_activity": "Fact_DevActivity",
    "fact_community": "Fact_Community",
    "fact_issue_lifecycle": "Fact_IssueLifecycle",
}


def ddl(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {sql_type}" for name, sql_type in columns.items())
