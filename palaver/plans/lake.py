"""The whole batch run: bronze, then silver, then gold, each layer read back from its written tables."""

from __future__ import annotations

from collections.abc import Mapping
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.calendar import AsOf, as_date
from palaver.functions.columns import since
from palaver.operators.dedup import deduplicate
from palaver.operators.layout import cluster_interleaved
from palaver.operators.quality import quality_report
from palaver.operators.retention import RETENTION_DAYS, expire_days
from palaver.plans.activity import first_contacts, new_contacts, user_activity
from palaver.plans.bronze import bronze_calls, bronze_conversations, bronze_messages, bronze_users, login_accounts
from palaver.plans.conversations import conversation_analytics
from palaver.plans.daily import daily_from_states, day_states
from palaver.plans.engagement import user_engagement
from palaver.plans.features import user_features
from palaver.plans.periods import monthly_metrics, weekly_metrics
from palaver.plans.silver import silver_calls, silver_conversations, silver_messages, silver_users
from palaver.plans.totals import carry_totals, user_totals, windows_and_lifetime
from palaver.schemas import DAY_PARTITIONS, MONTH_PARTITIONS
from palaver.sources.changes import Keyed, fold_changes, read_changes
from palaver.sources.files import Files
from palaver.sources.tables import (
    discard, find_table, read_table, replace_partitions, replace_table, staged, upsert_partitions, upsert_table,
)

class Spec(NamedTuple):
    contract: schemas.Contract
    keys: list[str]
    partition_by: tuple[str, ...]
    version: str | None = None  # orders versions of one key, where a batch may hold several
    tie_break: tuple[str, ...] = ()  # decides between versions of the same time
    in_place: bool = False  # written by the tasks that hold the rows, which are not shuffled by day

    @property
    def keyed(self) -> Keyed:
        return Keyed(self.contract, self.keys, self.partition_by, self.version, self.tie_break)


TABLES = {
    "bronze/messages": Spec(
        schemas.BRONZE_MESSAGES, ["_id"], DAY_PARTITIONS, "updatedAt", ("createdAt", "messageType", "content"),
        in_place=True,
    ),
    "bronze/events": Spec(schemas.BRONZE_EVENTS, ["eventId"], DAY_PARTITIONS, "timestamp", ("eventType", "payload")),
    "bronze/users": Spec(schemas.BRONZE_USERS, ["_id"], MONTH_PARTITIONS, "updatedAt", ("createdAt", "email")),
    "bronze/conversations": Spec(
        schemas.BRONZE_CONVERSATIONS, ["_id"], MONTH_PARTITIONS, "updatedAt", ("createdAt", "conversationType")
    ),
    "bronze/calls": Spec(
        schemas.BRONZE_CALLS, ["_id"], DAY_PARTITIONS, "createdAt", ("endTime", "status", "duration"), in_place=True
    ),
    "silver/messages": Spec(schemas.SILVER_MESSAGES, ["messageId"], DAY_PARTITIONS, in_place=True),
    "silver/users": Spec(schemas.SILVER_USERS, ["userId"], MONTH_PARTITIONS),
    "silver/conversations": Spec(schemas.SILVER_CONVERSATIONS, ["conversationId"], MONTH_PARTITIONS),
    "silver/calls": Spec(schemas.SILVER_CALLS, ["callId"], DAY_PARTITIONS, in_place=True),
    "silver/first_contacts": Spec(schemas.FIRST_CONTACTS, ["userId", "conversationId"], DAY_PARTITIONS),
    "silver/user_activity": Spec(schemas.USER_ACTIVITY, ["userId", "activityDate"], MONTH_PARTITIONS),
    "gold/metrics/day_states": Spec(schemas.DAY_STATES, ["metricDate"], MONTH_PARTITIONS),
    "gold/metrics/daily": Spec(schemas.DAILY_METRICS, ["metricDate"], MONTH_PARTITIONS),
    "gold/metrics/weekly": Spec(schemas.WEEKLY_METRICS, ["weekStartDate"], ()),
    "gold/metrics/monthly": Spec(schemas.MONTHLY_METRICS, ["monthDate"], ()),
    "gold/analytics/user_engagement": Spec(
        schemas.USER_ENGAGEMENT, ["userId", "calculationDate"], MONTH_PARTITIONS
    ),
    "gold/analytics/user_totals": Spec(schemas.USER_TOTALS, ["userId"], ()),
    "gold/analytics/conversations": Spec(
        schemas.CONVERSATION_ANALYTICS, ["conversationId", "calculationDate"], MONTH_PARTITIONS
    ),
    "gold/ml_features": Spec(schemas.USER_FEATURES, ["userId"], ()),
    "quality": Spec(schemas.QUALITY_REPORT, ["table", "check"], ()),
}


class Lake:
    """Tables under one root.

    An upsert merges into the table that exists under ``previous`` (the root itself unless another root is named); with
    ``rebuild`` nothing earlier is looked at. In the root itself tables are updated in place, directory by directory; this
    holds for every table here, as a key never changes the time its partition is made of.
    """

    def __init__(self, spark: SparkSession, root: str, previous: str | None = None, rebuild: bool = False):
        self.spark, self.root = spark, root.rstrip("/")
        self.previous = None if rebuild else (previous or root).rstrip("/")
        self.rows: dict[str, int] = {}

    def table(self, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.root}/{name}", TABLES[name].contract)

    def earlier(self, name: str) -> DataFrame | None:
        return find_table(self.spark, f"{self.previous}/{name}", TABLES[name].contract) if self.previous else None

    def fold(self, name: str) -> DataFrame | None:
        """Fold what streams have added to the table; the creation times of those rows, or None."""
        path = f"{self.root}/{name}"
        changes = read_changes(self.spark, path, TABLES[name].contract)
        if changes is None:
            return None
        times = staged(changes.select("createdAt"), "changed")
        fold_changes(self.spark, path, TABLES[name].keyed)
        return times

    def newest(self, name: str, df: DataFrame) -> DataFrame:
        """One row for each key of the batch; rows without a key are versions of nothing."""
        spec = TABLES[name]
        if not spec.version:
            return df
        no_key = " OR ".join(f"`{k}` IS NULL" for k in spec.keys)
        kept = deduplicate(df.dropna(subset=spec.keys), spec.keys, spec.version, tie_break=spec.tie_break)
        return kept.unionByName(df.filter(no_key))

    def upsert(self, name: str, df: DataFrame) -> DataFrame:
        spec, path = TABLES[name], f"{self.root}/{name}"
        if self.earlier(name) is None:
            self.rows[name] = replace_table(df, path, spec.partition_by, placed=spec.in_place)
            return self.table(name)
        newest = self.newest(name, df)
        if self.previous == self.root:
            self.rows[name] = upsert_partitions(self.spark, newest, path, spec.keys, spec.partition_by, placed=spec.in_place)
        else:
            old = f"{self.previous}/{name}"
            self.rows[name] = upsert_table(self.spark, newest, old, spec.keys, spec.partition_by, out_path=path)
        return self.table(name)

    def replace(self, name: str, df: DataFrame, placed: bool = False) -> DataFrame:
        self.rows[name] = replace_table(df, f"{self.root}/{name}", TABLES[name].partition_by, placed)
        return self.table(name)

    def replace_days(self, name: str, df: DataFrame) -> DataFrame:
        """Replace the directories that ``df`` has rows for."""
        spec = TABLES[name]
        self.rows[name] = replace_partitions(df, f"{self.root}/{name}", spec.partition_by, spec.in_place)
        return self.table(name)


def run_lake(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    root: str,
    as_of: AsOf,
    previous: str | None = None,
    changed_since: AsOf | None = None,
    rebuild: bool = False,
    cluster: bool = False,
    expire: bool = False,
) -> Lake:
    """Build or update all tables under ``root`` from raw frames ``messages users auth conversations calls``.

    Tables that exist are merged into; ``rebuild`` replaces them. With ``changed_since``, silver messages and user activity
    are recomputed, and merged, from that day on, or from the earliest creation day of the batch's messages and calls where
    that is earlier, so that an edit of an old message reaches them. It needs existing tables. ``cluster`` rewrites silver
    messages so that scans by conversation and scans by sender prune. ``expire`` at last removes the days past the limit of their layer.
    """
    lake = Lake(spark, root, previous, rebuild)
    if changed_since is not None and lake.earlier("silver/messages") is None:
        raise ValueError("changed_since updates existing tables; there are none")
    batch = {"messages": bronze_messages(raw["messages"]), "calls": bronze_calls(raw["calls"])}
    # In place, a run takes in what streams have added to the bronze messages since the last one.
    streamed = lake.fold("bronze/messages") if lake.previous == lake.root else None
    # A first load reads its batch once, to write it; a merge reads it several times.
    copies = [name for name in batch if lake.earlier(f"bronze/{name}") is not None]
    for name in copies:
        batch[name] = staged(batch[name], name)
    first = None
    if changed_since is not None:
        named = spark.range(1).select(as_date(changed_since).alias("d"))
        days = named.unionByName(batch["messages"].select(F.to_date("createdAt").alias("d")))
        if streamed is not None:
            days = days.unionByName(streamed.select(F.to_date("createdAt").alias("d")))
        first = days.unionByName(batch["calls"].select(F.to_date("createdAt").alias("d"))).agg(F.min("d")).first()[0]

    def recent(df: DataFrame, date: str) -> DataFrame:
        return df if first is None else since(df, date, F.lit(first))

    messages_b = lake.upsert("bronze/messages", batch["messages"])
    users_b = lake.upsert("bronze/users", bronze_users(raw["users"], staged(login_accounts(raw["auth"]), "accounts")))
    conversations = lake.upsert("bronze/conversations", bronze_conversations(raw["conversations"]))
    calls = lake.upsert("bronze/calls", batch["calls"])
    for name in copies:
        discard(batch[name])

    users = lake.upsert("silver/users", silver_users(users_b, as_of))
    groups = lake.upsert("silver/conversations", silver_conversations(conversations, as_of))
    lake.upsert("silver/calls", silver_calls(recent(calls, "createdAt")))
    messages = silver_messages(recent(messages_b, "createdAt"), users_b)
    if not cluster or lake.earlier("silver/messages") is not None:
        messages = lake.upsert("silver/messages", messages)
    if cluster:  # a first load is placed once, where the clusters are
        messages = lake.replace("silver/messages", _clustered(messages), placed=True)

    # The messages of the changed days give their first contacts; pairs that met before are left out.
    written = recent(messages, "createdAt")
    contacts = lake.earlier("silver/first_contacts") if first is not None else None
    if contacts is None:
        contacts = lake.replace("silver/first_contacts", first_contacts(messages))
    else:
        fresh = new_contacts(written, contacts, F.lit(first))
        if lake.previous == lake.root:
            contacts = lake.replace_days("silver/first_contacts", fresh)
        else:
            older = contacts.filter(F.col("firstDay") < F.lit(first))
            contacts = lake.replace("silver/first_contacts", older.unionByName(fresh))
    # Totals per user are carried: the changed days are subtracted as they were, so those are put aside before the merge.
    carried = old_days = None
    if first is not None and not _totals_open(lake, lake.previous):
        carried, earlier = lake.earlier("gold/analytics/user_totals"), lake.earlier("silver/user_activity")
        old_days = None if carried is None else staged(recent(earlier, "activityDate"), "old_days")
    mark_totals(lake, True)
    activity = lake.upsert("silver/user_activity", user_activity(
        written, recent(calls, "createdAt"), contacts=recent(contacts, "firstDay")
    ))
    if carried is None:
        fresh_totals = user_totals(activity, as_of)
    else:
        fresh_totals = carry_totals(carried, old_days, activity, first, as_of)
    totals = lake.replace("gold/analytics/user_totals", fresh_totals)
    mark_totals(lake, False)

    # Days before the changed ones keep their state, so no message, call or activity of theirs is read for the metrics.
    kept = lake.earlier("gold/metrics/day_states") is not None
    states = lake.upsert("gold/metrics/day_states", day_states(
        written, recent(activity, "activityDate"), recent(calls, "createdAt")
    ) if kept else day_states(messages, activity, calls))
    daily = lake.upsert("gold/metrics/daily", daily_from_states(states, users, conversations))
    every_day = staged(daily_from_states(states, users, conversations, spine="full"), "days")
    lake.replace("gold/metrics/weekly", weekly_metrics(every_day, activity))
    lake.replace("gold/metrics/monthly", monthly_metrics(every_day, activity, states))
    lake.upsert("gold/analytics/user_engagement", user_engagement(
        users, activity, messages, as_of, pairs=contacts, totals=windows_and_lifetime(totals)
    ))
    lake.upsert("gold/analytics/conversations", conversation_analytics(groups, messages, as_of))
    lake.replace("gold/ml_features", user_features(activity, users, messages, as_of))
    lake.replace("quality", quality_rows(messages_b, users_b, calls, daily, as_of))
    if expire:
        expire_lake(spark, root, as_of)
    return lake


def _totals_mark(root: str) -> str:
    return f"{root}/gold/analytics/_user_totals_open"


def _totals_open(lake: Lake, root: str) -> bool:
    """Whether a run stopped between its changes of the activity and the new totals: these are then summed anew."""
    return Files(lake.spark, root).exists(_totals_mark(root))


def mark_totals(lake: Lake, is_open: bool) -> None:
    """Set while the activity may be newer than the totals."""
    files, mark = Files(lake.spark, lake.root), _totals_mark(lake.root)
    files.touch(mark) if is_open else files.remove(mark)


# Tables of facts by day. First contacts stay: a pair that met once is never new again.
EXPIRING = ("bronze/messages", "bronze/events", "bronze/calls", "silver/messages", "silver/calls")


def expire_lake(spark: SparkSession, root: str, as_of: AsOf) -> dict[str, int]:
    """Remove days past the limit of their layer; the number of days that went, by table."""
    return {
        name: len(expire_days(spark, f"{root.rstrip('/')}/{name}", as_of, RETENTION_DAYS[name.split("/")[0]]))
        for name in EXPIRING
    }


def _clustered(messages: DataFrame) -> DataFrame:
    """A copy of the rows, ordered so that scans by conversation and scans by sender skip files and row groups."""
    return cluster_interleaved(staged(messages, "loose"), ["conversationId", "senderId"], ["messageId"], DAY_PARTITIONS)


def quality_rows(messages: DataFrame, users: DataFrame, calls: DataFrame, daily: DataFrame, as_of: AsOf) -> DataFrame:
    parts = [
        quality_report(messages, "bronze.messages", ["_id"], ["conversationId", "senderId", "createdAt"],
                       {"messageType": schemas.MESSAGE_TYPES}, ["createdAt"], as_of),
        quality_report(users, "bronze.users", ["_id"], ["createdAt"], not_future=["createdAt"], as_of=as_of),
        quality_report(calls, "bronze.calls", ["_id"], ["createdAt"],
                       {"status": schemas.CALL_STATUSES, "callType": schemas.CALL_TYPES}, ["createdAt"], as_of),
        quality_report(daily, "gold.metrics.daily", ["metricDate"], ["activeUsers"]),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def table_counts(lake: Lake) -> DataFrame:
    """One row per table of the run, counted from the files."""
    counts = [
        lake.table(name).agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name in lake.rows
    ]
    stacked = counts[0]
    for one in counts[1:]:
        stacked = stacked.unionByName(one)
    return stacked
