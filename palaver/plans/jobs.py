"""One table at a time: each job makes its table from the written tables under a root.

``run_lake`` does all of them, and for a daily batch only what the batch changed; a job by itself takes its inputs whole. Jobs
that are asked for together run in the order of ``JOBS``, in which every input comes before what is made of it.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from palaver.functions.calendar import AsOf
from palaver.plans.activity import first_contacts, user_activity
from palaver.plans.bronze import bronze_calls, bronze_conversations, bronze_messages, bronze_users, login_accounts
from palaver.plans.conversations import conversation_analytics
from palaver.plans.daily import daily_from_states, day_states
from palaver.plans.engagement import user_engagement
from palaver.plans.features import user_features
from palaver.plans.lake import Lake, mark_totals, quality_rows
from palaver.plans.periods import monthly_metrics, weekly_metrics
from palaver.plans.silver import silver_calls, silver_conversations, silver_messages, silver_users
from palaver.plans.totals import user_totals, windows_and_lifetime
from palaver.sources.tables import staged

Raw = Mapping[str, DataFrame]
Make = Callable[[Lake, Raw, AsOf], DataFrame]


class Job(NamedTuple):
    make: Make
    raw: tuple[str, ...] = ()  # raw frames it needs
    merged: bool = True  # into the table that exists, else in its place


def _every_day(lake: Lake) -> DataFrame:
    tables = (lake.table("gold/metrics/day_states"), lake.table("silver/users"), lake.table("bronze/conversations"))
    return staged(daily_from_states(*tables, spine="full"), "days")


def _bronze_users(lake: Lake, raw: Raw, _: AsOf) -> DataFrame:
    return bronze_users(raw["users"], staged(login_accounts(raw["auth"]), "accounts"))


def _engagement(lake: Lake, _: Raw, as_of: AsOf) -> DataFrame:
    users, activity, messages = map(lake.table, ("silver/users", "silver/user_activity", "silver/messages"))
    # Carried totals hold for one date only.
    return user_engagement(
        users, activity, messages, as_of, pairs=lake.table("silver/first_contacts"),
        totals=windows_and_lifetime(user_totals(activity, as_of)),
    )


JOBS: dict[str, Job] = {
    "bronze/messages": Job(lambda lake, raw, _: bronze_messages(raw["messages"]), ("messages",)),
    "bronze/users": Job(_bronze_users, ("users", "auth")),
    "bronze/conversations": Job(lambda lake, raw, _: bronze_conversations(raw["conversations"]), ("conversations",)),
    "bronze/calls": Job(lambda lake, raw, _: bronze_calls(raw["calls"]), ("calls",)),
    "silver/users": Job(lambda lake, _, as_of: silver_users(lake.table("bronze/users"), as_of)),
    "silver/conversations": Job(lambda lake, _, as_of: silver_conversations(lake.table("bronze/conversations"), as_of)),
    "silver/calls": Job(lambda lake, *_: silver_calls(lake.table("bronze/calls"))),
    "silver/messages": Job(
        lambda lake, *_: silver_messages(lake.table("bronze/messages"), lake.table("bronze/users"))
    ),
    "silver/first_contacts": Job(lambda lake, *_: first_contacts(lake.table("silver/messages")), merged=False),
    "silver/user_activity": Job(lambda lake, *_: user_activity(
        lake.table("silver/messages"), lake.table("bronze/calls"), contacts=lake.table("silver/first_contacts")
    )),
    "gold/metrics/day_states": Job(lambda lake, *_: day_states(
        lake.table("silver/messages"), lake.table("silver/user_activity"), lake.table("bronze/calls")
    )),
    "gold/metrics/daily": Job(lambda lake, *_: daily_from_states(
        lake.table("gold/metrics/day_states"), lake.table("silver/users"), lake.table("bronze/conversations")
    )),
    "gold/metrics/weekly": Job(
        lambda lake, *_: weekly_metrics(_every_day(lake), lake.table("silver/user_activity")), merged=False
    ),
    "gold/metrics/monthly": Job(lambda lake, *_: monthly_metrics(
        _every_day(lake), lake.table("silver/user_activity"), lake.table("gold/metrics/day_states")
    ), merged=False),
    "gold/analytics/user_totals": Job(
        lambda lake, _, as_of: user_totals(lake.table("silver/user_activity"), as_of), merged=False
    ),
    "gold/analytics/user_engagement": Job(_engagement),
    "gold/analytics/conversations": Job(lambda lake, _, as_of: conversation_analytics(
        lake.table("silver/conversations"), lake.table("silver/messages"), as_of
    )),
    "gold/ml_features": Job(lambda lake, _, as_of: user_features(
        lake.table("silver/user_activity"), lake.table("silver/users"), lake.table("silver/messages"), as_of
    ), merged=False),
    "quality": Job(lambda lake, _, as_of: quality_rows(
        lake.table("bronze/messages"), lake.table("bronze/users"), lake.table("bronze/calls"),
        lake.table("gold/metrics/daily"), as_of,
    ), merged=False),
}


def run_jobs(spark: SparkSession, root: str, names: Collection[str], as_of: AsOf, raw: Raw | None = None) -> Lake:
    """Run the named jobs on the tables under ``root``; bronze jobs take their rows from ``raw``.

    Nothing is written when a name is unknown or a raw frame is missing. Of the bronze messages, what streams have added is
    taken in first. After a change of the activity alone the next daily run sums its totals anew.
    """
    unknown = sorted(set(names) - set(JOBS))
    if unknown:
        raise ValueError(f"unknown jobs: {unknown}")
    missing = sorted({r for name in names for r in JOBS[name].raw} - set(raw or {}))
    if missing:
        raise ValueError(f"raw frames needed: {missing}")
    lake = Lake(spark, root)
    for name, job in JOBS.items():
        if name not in names:
            continue
        if name == "bronze/messages":
            lake.fold(name)
        if name == "silver/user_activity":
            mark_totals(lake, True)
        made = job.make(lake, raw or {}, as_of)
        lake.upsert(name, made) if job.merged else lake.replace(name, made)
        if name == "gold/analytics/user_totals":
            mark_totals(lake, False)
    return lake
