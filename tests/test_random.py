"""Every question against brute force over random events with all kinds of untidiness.

Ids share names, issues turn up in several repositories, keys and actions are missing, branches
are created and deleted repeatedly, and one repository and one issue own much of everything.
"""

import random
from collections import Counter, defaultdict
from datetime import date, timedelta

import pytest

from forgelake.plans import analytics as A
from forgelake.plans import marts as M
from forgelake.plans.gold import transform_to_gold

KINDS = ["PushEvent", "PullRequestEvent", "IssuesEvent", "IssuesEvent", "IssueCommentEvent",
         "WatchEvent", "ForkEvent", "CreateEvent", "DeleteEvent"]


def random_event(rng, n):
    kind = rng.choice(KINDS)
    actor, repo = rng.choice([1, 1, 2, 3, 4, None]), rng.choice([10, 10, 10, 11, 12, 13, None])
    issue = rng.choice([100, 100, 100, 101, 102, 103, 104, 105, None])
    event = {
        "event_id": str(n), "event_type": kind, "actor_id": actor, "repo_id": repo,
        "actor_login": None if actor is None else ["ann", "bob", "ann", "cy[bot]"][actor - 1],
        "repo_name": None if repo is None else ["o/a", "o/b", "o/b", "o/c"][repo - 10],
        "org_id": rng.choice([7, 8, 9, None]),
        "created_at": f"2024-01-{rng.randrange(1, 29):02d} {rng.randrange(24):02d}:00:00",
    }
    event["org_login"] = {7: "x", 8: "x", 9: "y"}.get(event["org_id"])
    event |= {
        "PushEvent": lambda: {"push_commit_count": rng.choice([1, 2, 5, None])},
        "PullRequestEvent": lambda: {"pr_action": rng.choice(["opened", "closed", None]),
                                     "pr_is_merged": rng.choice([True, False, None])},
        "IssuesEvent": lambda: {"issue_id": issue,
                                "issue_action": rng.choice(["opened", "closed", "reopened", None])},
        "IssueCommentEvent": lambda: {"comment_target_issue_id": issue, "comment_id": n},
        "ForkEvent": lambda: {"fork_new_repo_name": f"f/{n}"},
        "CreateEvent": lambda: {"create_ref_type": rng.choice(["branch", "branch", "tag"]),
                                "create_ref_name": rng.choice(["m", "m", "d", "e", "f", None])},
        "DeleteEvent": lambda: {"delete_ref_type": rng.choice(["branch", "tag"]),
                                "delete_ref_name": rng.choice(["d", "e", None])},
    }.get(kind, dict)()
    return event


def total(values):
    known = [v for v in values if v is not None]
    return sum(known) if known else None


class Expected:
    """Plain loops over the tables."""

    def __init__(self, gold):
        self.dev, self.com, self.life = (
            gold[n].collect() for n in ("fact_dev_activity", "fact_community", "fact_issue_lifecycle")
        )
        self.repo = {r["repo_id"]: r["repo_name"] for r in gold["dim_repo"].collect()}
        self.actor = {r["actor_id"]: r["actor_login"] for r in gold["dim_actor"].collect()}
        self.org = {r["org_id"]: r["org_name"] for r in gold["dim_org"].collect()}

    def of(self, rows, kind, **equal):
        return [r for r in rows if r["event_type"] == kind and all(r[k] == v for k, v in equal.items())]

    def named(self, rows, key=lambda r: ()):
        groups = defaultdict(list)
        for r in rows:
            if r["repo_id"] in self.repo:
                groups[(self.repo[r["repo_id"]], *key(r))].append(r)
        return groups

    def monthly_commits(self):
        pushes = self.named(self.of(self.dev, "PushEvent"), lambda r: (r["created_at"].year, r["created_at"].month))
        return [(*k, total(r["push_commit_count"] for r in v)) for k, v in pushes.items()]

    def pr_merge_rate(self):
        closed = self.named(self.of(self.dev, "PullRequestEvent", pr_action="closed"))
        merged = {k: sum(r["pr_is_merged"] is True for r in v) for k, v in closed.items()}
        return [(*k, len(v), merged[k], round(100 * merged[k] / len(v) + 1e-9, 1)) for k, v in closed.items()]

    def top_pushers(self):
        groups = defaultdict(list)
        for r in self.of(self.dev, "PushEvent"):
            if r["actor_id"] in self.actor and r["created_at"].date() >= date(2024, 1, 30) - timedelta(days=20):
                groups[self.actor[r["actor_id"]]].append(r["push_commit_count"])
        rows = [(k, len(v), total(v)) for k, v in groups.items()]
        return sorted(rows, key=lambda r: (-r[2], r[0]))[:2]

    def live_branches(self):
        dead = {(r["repo_id"], r["delete_ref_name"]) for r in self.of(self.dev, "DeleteEvent")}
        dead = {k for k in dead if None not in k}
        made = self.of(self.dev, "CreateEvent", create_ref_type="branch")
        rows = [(r["repo_id"], r["create_ref_name"]) for r in made]
        return [k for k in rows if k not in dead]

    def weekly_stars(self):
        stars = self.named(self.of(self.com, "WatchEvent"),
                           lambda r: (r["created_at"].year, r["created_at"].isocalendar().week))
        return [(*k, len(v)) for k, v in stars.items()]

    def fork_log(self):
        return [(self.repo[r["repo_id"]], self.actor[r["actor_id"]], r["fork_new_repo_name"], r["created_at"].date())
                for r in self.of(self.com, "ForkEvent") if r["repo_id"] in self.repo and r["actor_id"] in self.actor]

    def engagement_score(self):
        weight = {"WatchEvent": 3, "ForkEvent": 5, "IssueCommentEvent": 1}
        return [(*k, sum(weight[r["event_type"]] for r in v)) for k, v in self.named(self.com).items()]

    def org_reach(self):
        groups = defaultdict(list)
        for r in self.of(self.com, "WatchEvent") + self.of(self.com, "ForkEvent"):
            if r["org_id"] in self.org:
                groups[self.org[r["org_id"]]].append(r["actor_id"])
        return [(k, len(set(v) - {None}), len(v)) for k, v in groups.items()]

    def issues(self, action):
        return self.of(self.life, "IssuesEvent", issue_action=action)

    def avg_days_to_close(self):
        days = defaultdict(list)
        for o in self.issues("opened"):
            for c in self.issues("closed"):
                if o["issue_id"] is not None and o["issue_id"] == c["issue_id"] and o["repo_id"] in self.repo:
                    gap = c["created_at"].date() - o["created_at"].date()
                    days[self.repo[o["repo_id"]]].append(gap.days)
        return [(k, round(sum(v) / len(v), 9)) for k, v in days.items()]

    def issue_backlog(self):
        closed = {r["issue_id"] for r in self.issues("closed")} - {None}
        pending = self.named([r for r in self.issues("opened") if r["issue_id"] not in closed])
        return [(*k, len({r["issue_id"] for r in v} - {None})) for k, v in pending.items()]

    def hot_issues(self):
        comments = self.named(self.of(self.life, "IssueCommentEvent"), lambda r: (r["comment_target_issue_id"],))
        rows = [(issue, name, len(v)) for (name, issue), v in comments.items()]
        return sorted(rows, key=lambda r: (-r[2], r[0] is not None, r[0] or 0, r[1]))[:5]

    def reopened_issues(self):
        again = self.named(self.issues("reopened"))
        return [(*k, len({r["issue_id"] for r in v} - {None})) for k, v in again.items()]

    def repo_health(self):
        commits, interest = defaultdict(list), defaultdict(Counter)
        for r in self.of(self.dev, "PushEvent"):
            commits[r["repo_id"]].append(r["push_commit_count"])
        for r in self.com:
            interest[r["repo_id"]][r["event_type"]] += 1
        return [(self.repo[i], total(commits[i]), interest[i]["WatchEvent"], interest[i]["ForkEvent"])
                for i in self.repo if i in commits and i in interest]

    def developer_profile(self):
        rows = []
        for login in set(self.actor.values()):
            ids = {i for i, name in self.actor.items() if name == login}
            mine = [r for r in self.dev if r["actor_id"] in ids]
            rows.append((
                login, total(r["push_commit_count"] for r in mine), len(self.of(mine, "PullRequestEvent")),
                len([r for r in self.of(self.life, "IssueCommentEvent") if r["actor_id"] in ids]),
            ))
        return rows

    def issue_resolution(self):
        rows = []
        events = [r for r in self.of(self.life, "IssuesEvent") if r["issue_id"] is not None]
        for issue in {r["issue_id"] for r in events}:
            mine = [r for r in events if r["issue_id"] == issue]
            opened = min((r["created_at"] for r in mine if r["issue_action"] == "opened"), default=None)
            closed = min((r["created_at"] for r in mine if r["issue_action"] == "closed"
                          and opened and r["created_at"] >= opened), default=None)
            rows.append((issue, opened, closed, (closed.date() - opened.date()).days if closed else None))
        return rows


def bag(rows):
    return Counter(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows)


@pytest.mark.parametrize("seed,broadcasts", [(1, True), (2, False), (3, False)])
def test_questions_against_brute_force(spark, rows, seed, broadcasts):
    if not broadcasts:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = random.Random(seed)
        gold = transform_to_gold(rows(*[random_event(rng, n) for n in range(600)]))
        expected = Expected(gold)
        found = {
            "top_pushers": A.top_pushers(gold, as_of=date(2024, 1, 30), days=20, n=2),
            "hot_issues": A.hot_issues(gold, n=5),
            "issue_resolution": M.issue_resolution(gold),
            **{name: getattr(A, name)(gold) for name in (
                "monthly_commits", "pr_merge_rate", "live_branches", "weekly_stars", "fork_log",
                "engagement_score", "org_reach", "avg_days_to_close", "issue_backlog",
                "reopened_issues", "repo_health", "developer_profile")},
        }
        for name, df in found.items():
            assert bag(df.collect()) == bag(getattr(expected, name)()), name
        for login in ("ann", "cy[bot]"):
            one = [tuple(r) for r in A.developer_profile(gold, login).collect()]
            assert one == [r for r in expected.developer_profile() if r[0] == login]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
