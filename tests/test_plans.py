"""Hand-made chats, shapes of plans, and skew."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from palaver import schemas
from palaver.functions.columns import since
from palaver.plans import activity, bronze, conversations, daily, engagement, features, lake, periods, silver
from palaver.sources import changes, tables

AS_OF = "2024-01-31"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def silver_rows(spark, rows):
    """Silver messages from (id, conversation, sender, type, reactions, attachments?, timestamp)."""
    df = spark.createDataFrame(
        [(*r[:6], dt.datetime.fromisoformat(r[6])) for r in rows],
        "messageId string, conversationId string, senderId string, messageType string, reactionCount int, "
        "hasAttachments boolean, createdAt timestamp",
    )
    return df.withColumns({
        "year": F.year("createdAt"), "month": F.month("createdAt"), "day": F.dayofmonth("createdAt"),
        "isWeekend": F.dayofweek("createdAt").isin(1, 7),
    })


@pytest.fixture(scope="module")
def messages(spark):
    return silver_rows(spark, [
        ("1", "c1", "u1", "text", 2, False, "2024-01-30 10:00:00"),
        ("2", "c1", "u1", "image", 0, True, "2024-01-30 10:30:00"),
        ("3", "c2", "u1", "text", 1, False, "2024-01-30 14:00:00"),
        ("4", "c2", "u2", "text", 0, False, "2024-01-30 14:10:00"),
        ("5", "c1", "u1", "video", 0, True, "2024-01-05 08:00:00"),
        ("6", "c3", "u2", "file", 3, True, "2024-01-05 09:00:00"),
    ])


@pytest.fixture(scope="module")
def calls(spark):
    at = dt.datetime.fromisoformat
    return spark.createDataFrame([
        ("k1", "u1", ["u2", "u3"], "audio", "ended", 90, at("2024-01-30 12:00:00")),
        ("k2", "u3", ["u1"], "video", "missed", None, at("2024-01-29 12:00:00")),
        ("k3", "u1", None, "video", "ended", None, at("2024-01-30 13:00:00")),
        ("k4", None, ["u1", None], "video", "ongoing", 30, at("2024-01-30 13:00:00")),
    ], "_id string, initiatorId string, participantIds array<string>, callType string, status string, "
       "duration bigint, createdAt timestamp")


def by_key(df, *keys):
    return {tuple(str(r[k]) for k in keys): r for r in df.collect()}


def test_user_activity(messages, calls):
    got = by_key(activity.user_activity(messages, calls), "userId", "activityDate")
    assert set(got) == {("u1", "2024-01-30"), ("u2", "2024-01-30"), ("u1", "2024-01-05"), ("u2", "2024-01-05")}
    row = got["u1", "2024-01-30"]
    assert (row.messagesSent, row.mediaShared, row.reactionsGiven, row.reactionsReceived) == (3, 1, 3, 3)
    assert (row.conversationsActive, row.newConversationsStarted) == (2, 1)
    assert (row.callsInitiated, row.callsReceived, row.totalCallDurationMinutes) == (2, 1, 1.5)
    assert (row.messagesReceived, row.isActiveDay, row.dayOfWeek) == (0, True, 3)


def test_user_activity_full_spine_adds_call_only_days(messages, calls):
    got = by_key(activity.user_activity(messages, calls, spine="full"), "userId", "activityDate")
    assert got["u3", "2024-01-29"].callsInitiated == 1
    assert got["u3", "2024-01-30"].callsReceived == 1
    assert got["u1", "2024-01-29"].messagesSent == 0
    with pytest.raises(ValueError):
        activity.user_activity(messages, calls, spine="other")


def test_user_activity_reads_each_input_once_and_combines_before_shuffling(spark, messages, calls, tmp_path):
    for name, df in (("m", messages), ("c", calls)):
        df.write.parquet(str(tmp_path / name))
    m, c = (spark.read.parquet(str(tmp_path / n)) for n in "mc")
    text = plan(activity.user_activity(m, c))
    assert len(re.findall(r"FileScan", text)) == 2
    assert "Join" not in text
    # every exchange but the window's re-clustering carries partial aggregates
    assert text.count("partial_sum") >= 2 and text.count("Exchange hashpartitioning") == 3
    scan = next(line for line in text.splitlines() if "FileScan" in line and "/m]" in line)
    assert "messageType" not in scan.split("ReadSchema")[1] and "messageId" not in scan.split("ReadSchema")[1]


def test_hot_sender_is_reduced_before_the_shuffle(spark, tmp_path):
    """A third of all rows by one sender: what reaches the exchange is one row per sender, conversation, day and task."""
    path = str(tmp_path / "hot")
    spark.range(30000).selectExpr(
        "CAST(id AS STRING) AS messageId", "CAST(id % 5 AS STRING) AS conversationId",
        "IF(id % 3 = 0, 'hot', CAST(id % 100 AS STRING)) AS senderId", "1 AS reactionCount", "false AS hasAttachments",
        "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id % 10 AS INT)) AS createdAt",
    ).repartition(4).write.parquet(path)
    cube = activity.message_facts(spark.read.parquet(path))
    total = cube.filter("userId = 'hot'").agg(F.sum("messagesSent"), F.count("*")).first()
    assert total[0] == 10000 and total[1] <= 50


def test_peak_hour_prefers_the_later_of_equal_hours(messages):
    got = by_key(daily.peak_hour_per_day(messages), "metricDate")
    assert got["2024-01-30",].peakHour == 14
    assert got["2024-01-05",].peakHour == 9


def test_daily_metrics_spines(spark, messages, calls):
    users = spark.sql("""SELECT * FROM VALUES ('u1', TIMESTAMP '2024-01-05'), ('u2', TIMESTAMP '2024-01-20'),
        ('u3', TIMESTAMP '2024-01-30') AS t(userId, createdAt)""")
    convs = spark.sql("SELECT 'c1' AS _id, TIMESTAMP '2024-01-06 10:00:00' AS createdAt")
    act = activity.user_activity(messages, calls)
    dau = by_key(daily.daily_metrics(messages, users, act, calls, convs), "metricDate")
    assert set(dau) == {("2024-01-05",), ("2024-01-30",)}
    last = dau["2024-01-30",]
    assert (last.activeUsers, last.totalUsers, last.newUsers, last.totalConversations) == (2, 2, 1, 0)
    assert (last.totalCalls, last.totalCallDurationMinutes, last.avgCallDurationMinutes) == (3, 2.0, 2.0 / 3)
    assert (last.totalMessages, last.textMessages, last.mediaMessages, last.activeConversations) == (4, 3, 1, 2)
    full = by_key(daily.daily_metrics(messages, users, act, calls, convs, spine="full"), "metricDate")
    assert len(full) == 5
    assert full["2024-01-20",].totalUsers == 2 and full["2024-01-20",].peakHour == 12
    assert full["2024-01-30",].totalUsers == 3 and full["2024-01-30",].totalConversations == 1


def test_user_engagement_of_silent_users(spark, messages, calls):
    users = spark.createDataFrame([("u1",), ("nobody",)], "userId string")
    act = activity.user_activity(messages, calls)
    got = by_key(engagement.user_engagement(users, act, messages, AS_OF), "userId")
    silent = got["nobody",]
    assert (silent.engagementScore, silent.activityTrend, silent.churnRisk, silent.userSegment) == (
        0.0, "stable", "high", "churned",
    )
    active = got["u1",]
    assert (active.totalMessagesSent, active.activeDaysLast7, active.activeDaysLast30) == (4, 1, 2)
    assert (active.avgDailyMessages, active.conversationsParticipating, active.groupsParticipating) == (2.0, 2, 0)
    assert active.activityTrend == "increasing" and active.avgResponseTimeMinutes is None


def test_user_engagement_reads_activity_once(spark, messages, calls, tmp_path):
    path = str(tmp_path / "act")
    activity.user_activity(messages, calls).write.parquet(path)
    users = spark.createDataFrame([("u1",)], "userId string")
    text = plan(engagement.user_engagement(users, spark.read.parquet(path), messages, AS_OF))
    assert text.count("FileScan") == 1


def test_user_features(spark, messages, calls):
    users = spark.createDataFrame([("u1",), ("nobody",)], "userId string")
    act = activity.user_activity(messages, calls)
    got = by_key(features.user_features(act, users, messages, AS_OF), "userId")
    one = got["u1",]
    assert (one.msgSentLast1d, one.msgSentLast7d, one.msgSentLast30d) == (3, 3, 4)
    assert (one.uniqueContacts, one.preferredHour, one.avgGroupSize, one.willChurnNext7d) == (2, 10, 5.0, False)
    assert (one.weekdayActivityRatio, one.messageVelocity7d, one.engagementTrend) == (1.0, 3 / 7.0, 3.0)
    assert one.avgSessionDurationMinutes == 0.75
    silent = got["nobody",]
    assert (silent.preferredHour, silent.avgGroupSize, silent.willChurnNext7d) == (12, 0.0, None)


def test_groups_come_from_conversations_when_given(spark, messages, calls):
    convs = spark.createDataFrame(
        [("c1", "group", ["a", "b", "c"]), ("c1", "group", ["a"]), ("c2", "single", ["a"]), ("c3", "group", ["a"])],
        "_id string, conversationType string, participants array<string>",
    )
    users = spark.createDataFrame([("u1",), ("u2",)], "userId string")
    act = activity.user_activity(messages, calls)
    engaged = by_key(engagement.user_engagement(users, act, messages, AS_OF, convs), "userId")
    assert (engaged["u1",].groupsParticipating, engaged["u2",].groupsParticipating) == (1, 1)
    vectors = by_key(features.user_features(act, users, messages, AS_OF, convs), "userId")
    assert (vectors["u1",].groupCount, vectors["u1",].avgGroupSize) == (1, 3.0)


def test_weekly_retention(spark):
    def day(user, date, sent=10):
        return (user, dt.date.fromisoformat(date), sent, 0, 0, 0, True)

    act = spark.createDataFrame([
        day("a", "2024-01-01"), day("a", "2024-01-08"), day("b", "2024-01-02"), day("b", "2024-01-16"),
        day("c", "2024-01-09"),
    ], "userId string, activityDate date, messagesSent bigint, reactionsGiven bigint, callsInitiated bigint, "
       "callsReceived bigint, isActiveDay boolean")
    days = spark.sql("""SELECT d AS metricDate, 5L AS totalUsers, 0L AS newUsers, 7L AS totalMessages, 0L AS totalCalls,
        0.0D AS totalCallDurationMinutes FROM (SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-21')) AS d)""")
    got = by_key(periods.weekly_metrics(days, act), "weekStartDate")
    first, second, third = (got[d,] for d in ("2024-01-01", "2024-01-08", "2024-01-15"))
    assert (first.weeklyActiveUsers, first.returningUsers, first.churnedUsers, first.retentionRate) == (2, 0, 0, None)
    assert (second.weeklyActiveUsers, second.returningUsers, second.churnedUsers) == (2, 1, 1)
    assert (second.retentionRate, second.totalMessages, second.avgDailyMessages) == (0.5, 49, 7.0)
    assert (third.weeklyActiveUsers, third.returningUsers, third.churnedUsers, third.retentionRate) == (1, 0, 2, 0.0)
    assert first.engagementScore == round(3 + 30 / 7, 2)


def test_conversation_analytics_ties_and_silence(spark, messages):
    convs = spark.createDataFrame(
        [("c1", "single", dt.datetime(2024, 1, 1), 1), ("empty", "group", dt.datetime(2024, 1, 31), 0)],
        "conversationId string, conversationType string, createdAt timestamp, participantCount int",
    )
    got = by_key(conversations.conversation_analytics(convs, messages, AS_OF), "conversationId")
    one = got["c1",]
    assert (one.totalMessages, one.totalMessagesLast7Days, one.uniqueParticipantsLast7Days) == (3, 2, 1)
    assert (one.peakActivityHour, one.dominantMessageType, one.avgMessagesPerDay) == (10, "image", 0.1)
    assert (one.mostActiveParticipantId, one.conversationHealth) == ("u1", "quiet")
    empty = got["empty",]
    assert (empty.totalMessages, empty.conversationHealth, empty.mostActiveParticipantId) == (0, "dead", None)


def raw_message(spark, **changes):
    base = {"_id": "named_struct('oid', 'm1')", "conversationId": "'c'", "senderId": "'u'", "type": "'text'",
            "updatedAt": "TIMESTAMP '2024-01-01'", "createdAt": "TIMESTAMP '2024-01-01'", **changes}
    return spark.range(1).selectExpr(*[
        f"CAST({base.get(c, 'NULL')} AS {t}) AS {c}" for c, t in schemas.RAW_MESSAGES.items()
    ])


def test_bronze_messages_fill_nulls(spark):
    row = bronze.bronze_messages(raw_message(spark)).first()
    assert (row._id, row.messageType, row.isEdited, row.attachments, row.reactions, row.readBy) == (
        "m1", "text", False, [], [], [],
    )


def test_silver_messages_take_the_latest_valid_version(spark):
    versions = raw_message(spark).unionByName(
        raw_message(spark, updatedAt="TIMESTAMP '2024-01-02'", content="'héllo'", isEdited="true")
    ).unionByName(raw_message(spark, _id="named_struct('oid', 'm2')", senderId="NULL"))
    users = spark.createDataFrame([("u", "Uma")], "_id string, displayName string")
    rows = silver.silver_messages(bronze.bronze_messages(versions), users).collect()
    assert [(r.messageId, r.isEdited, r.contentLength, r.senderName, r.isReply) for r in rows] == [
        ("m1", True, 5, "Uma", False)
    ]


def test_silver_messages_shuffle_no_nested_columns(spark, tmp_path):
    path = str(tmp_path / "b")
    bronze.bronze_messages(raw_message(spark)).write.parquet(path)
    users = spark.createDataFrame([("u", "Uma")], "_id string, displayName string")
    text = plan(silver.latest_messages(spark.read.parquet(path)))
    sort = next(line for line in text.splitlines() if "Project" in line and "attachmentCount" in line)
    assert "attachments#" not in sort.split("AS attachmentTypes")[-1]
    assert silver.silver_messages(spark.read.parquet(path), users).columns == list(schemas.SILVER_MESSAGES)


def test_bronze_users_do_not_fan_out_on_shared_emails(spark):
    user = {"_id": "named_struct('oid', 'u1')", "email": "'a@x'", "createdAt": "TIMESTAMP '2024-01-01'",
            "updatedAt": "TIMESTAMP '2024-01-01' + make_dt_interval(CAST(id AS INT))", "displayName": "'v' || id"}
    users = spark.range(3).selectExpr(*[f"CAST({user.get(c, 'NULL')} AS {t}) AS {c}" for c, t in schemas.RAW_USERS.items()])
    auth = spark.sql("""SELECT * FROM VALUES
        (1L, 'a@x', true, false, TIMESTAMP '2024-01-01', 5L, TIMESTAMP '2024-01-01'),
        (2L, 'a@x', false, true, TIMESTAMP '2024-01-03', 9L, TIMESTAMP '2024-01-01')
        AS t(id, email, email_verified, two_factor_enabled, last_login_at, login_count, created_at)""")
    rows = bronze.bronze_users(users, bronze.login_accounts(auth)).collect()
    assert [(r._id, r.displayName, r.role, r.loginCount, r.twoFactorEnabled) for r in rows] == [
        ("u1", "v2", "user", 9, True)
    ]


def lake_input(spark, **message):
    contracts = {"users": schemas.RAW_USERS, "auth": schemas.RAW_AUTH, "conversations": schemas.RAW_CONVERSATIONS,
                 "calls": schemas.RAW_CALLS}
    empty = {
        name: spark.range(0).selectExpr(*[f"CAST(NULL AS {t}) AS {c}" for c, t in contract.items()])
        for name, contract in contracts.items()
    }
    return {"messages": raw_message(spark, **message), **empty}


def contents(df):
    return {r.messageId: r.content for r in df.collect()}


def test_lake_rerun_merges_into_the_earlier_root(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    lake.run_lake(spark, lake_input(spark, content="'a'"), one, AS_OF)
    more = lake_input(spark, content="'b'", updatedAt="TIMESTAMP '2024-01-02'")
    more["messages"] = more["messages"].unionByName(raw_message(spark, _id="named_struct('oid', 'm2')"))
    run = lake.run_lake(spark, more, two, AS_OF, previous=one)
    assert run.rows["silver/messages"] == 2
    assert contents(run.table("silver/messages")) == {"m1": "b", "m2": None}
    assert run.table("gold/metrics/daily").first().totalMessages == 2


def test_lake_updates_in_place_from_a_day_on(spark, tmp_path):
    root = str(tmp_path / "lake")
    days = {f"m{d}": {"_id": f"named_struct('oid', 'm{d}')", "createdAt": f"TIMESTAMP '2024-01-0{d}'",
                      "updatedAt": f"TIMESTAMP '2024-01-0{d}'", "content": "'old'"} for d in (1, 2)}
    first = lake_input(spark, **days["m1"])
    first["messages"] = first["messages"].unionByName(raw_message(spark, **days["m2"]))
    lake.run_lake(spark, first, root, AS_OF)
    edit = lake_input(spark, **{**days["m2"], "content": "'new'", "updatedAt": "TIMESTAMP '2024-01-05'"})
    untouched = sorted((tmp_path / "lake/silver/messages/year=2024/month=1/day=1").glob("*.parquet"))
    run = lake.run_lake(spark, edit, root, AS_OF, changed_since="2024-01-02")
    assert contents(run.table("silver/messages")) == {"m1": "old", "m2": "new"}
    assert run.rows["silver/messages"] == 1
    assert sorted((tmp_path / "lake/silver/messages/year=2024/month=1/day=1").glob("*.parquet")) == untouched
    act = by_key(run.table("silver/user_activity"), "activityDate")
    assert act["2024-01-01",].newConversationsStarted == 1 and act["2024-01-02",].newConversationsStarted == 0
    with pytest.raises(ValueError):
        lake.run_lake(spark, edit, str(tmp_path / "x"), AS_OF, changed_since="2024-01-02")
    old = lake_input(spark, **{**days["m1"], "content": "'late edit'", "updatedAt": "TIMESTAMP '2024-01-30'"})
    run = lake.run_lake(spark, old, root, AS_OF, changed_since="2024-01-30")
    assert contents(run.table("silver/messages")) == {"m1": "late edit", "m2": "new"}
    rebuilt = lake.run_lake(spark, old, root, AS_OF, rebuild=True)
    assert contents(rebuilt.table("silver/messages")) == {"m1": "late edit"}


def test_versions_of_one_time_are_chosen_by_content(spark, tmp_path):
    one = spark.createDataFrame([("k", "ongoing", None), ("k", "ended", 60)], "_id string, status string, duration bigint")
    chosen = set()
    for i, order in enumerate((one.orderBy("status"), one.orderBy(F.desc("status")))):
        values = {"_id": "named_struct('oid', _id)", "createdAt": "TIMESTAMP '2024-01-01'", "status": "status",
                  "duration": "duration"}
        calls = order.selectExpr(*[f"CAST({values.get(c, 'NULL')} AS {t}) AS {c}" for c, t in schemas.RAW_CALLS.items()])
        run = lake.Lake(spark, str(tmp_path / f"l{i}"))
        rows = bronze.bronze_calls(calls)
        run.upsert("bronze/calls", rows.limit(0))
        chosen |= {r.status for r in run.upsert("bronze/calls", rows).collect()}
    assert len(chosen) == 1


def test_daily_update_scans_the_changed_days_only(spark, tmp_path):
    path = str(tmp_path / "m")
    silver_rows(spark, [(str(d), "c", "u", "text", 0, False, f"2024-01-{d:02d} 10:00:00") for d in range(1, 11)]).write.partitionBy(
        *schemas.DAY_PARTITIONS
    ).parquet(path)
    recent = since(spark.read.parquet(path), "createdAt", F.lit("2024-01-09").cast("date"))
    contacts = activity.first_contacts(spark.read.parquet(path))
    fresh = activity.new_contacts(recent, contacts, F.lit("2024-01-09").cast("date"))
    assert fresh.count() == 0
    calls = spark.createDataFrame([], "_id string, initiatorId string, participantIds array<string>, callType string, "
                                  "status string, duration bigint, createdAt timestamp")
    df = activity.user_activity(recent, calls, contacts=fresh)
    scans = [line for line in plan(df).splitlines() if "FileScan" in line and "senderId" in line]
    assert "PartitionFilters: [isnotnull" in plan(df) or "PartitionFilters: [(" in plan(df)
    assert scans and df.count() == 2


def test_pair_counts_stay_narrow(spark, messages, tmp_path):
    path = str(tmp_path / "act")
    spark.sql("SELECT 'u' AS userId, DATE '2024-01-01' AS activityDate, true AS isActiveDay, 1L AS messagesSent").write.parquet(path)
    text = plan(daily.active_users_per_day(spark.read.parquet(path)))
    assert text.count("Exchange hashpartitioning") == 1

def metric_rows(run):
    names = ("gold/metrics/day_states", "gold/metrics/daily", "gold/metrics/weekly", "gold/metrics/monthly")
    return {n: sorted(str(r.asDict()) for r in run.table(n).drop("processedAt").collect()) for n in names}


def test_day_states_are_kept_and_equal_a_rebuild(spark, tmp_path, monkeypatch):
    """Two months of messages, then an edit, a streamed message and new rows from one day on."""
    def many(days, **columns):
        out = None
        for i, (month, day) in enumerate(days):
            at = f"TIMESTAMP '2024-{month:02d}-{day:02d} {8 + i % 5}:00:00'"
            one = raw_message(spark, **{"_id": f"named_struct('oid', 'm{month}-{day}')", "createdAt": at, "updatedAt": at,
                                        "type": "'text'" if day % 3 else "'image'", **columns})
            out = one if out is None else out.unionByName(one)
        return out

    old_days, new_days = [(1, d) for d in (2, 5, 9, 30)] + [(2, 1), (2, 3)], [(2, 3), (2, 4), (2, 5)]
    old = lake_input(spark) | {"messages": many(old_days)}
    new = lake_input(spark) | {"messages": many(new_days, updatedAt="TIMESTAMP '2024-02-09'", type="'video'")}
    root = str(tmp_path / "lake")
    lake.run_lake(spark, old, root, "2024-02-10")
    late = bronze.bronze_messages(many([(2, 2)]))
    changes.append_changes(late, f"{root}/bronze/messages", 0)

    seen, plain = [], lake.day_states
    monkeypatch.setattr(lake, "day_states", lambda *tables: seen.append(tables) or plain(*tables))
    run = lake.run_lake(spark, new, root, "2024-02-10", changed_since="2024-02-04")
    ((messages, acts, _),) = seen
    assert str(messages.agg(F.min(F.to_date("createdAt"))).first()[0]) == "2024-02-02"  # the streamed one
    assert str(acts.agg(F.min("activityDate")).first()[0]) >= "2024-02-02"
    assert "PartitionFilters: [isnotnull" in plan(messages)
    everything = lake_input(spark) | {"messages": many(old_days).unionByName(many([(2, 2)])).unionByName(new["messages"])}
    rebuilt = lake.run_lake(spark, everything, str(tmp_path / "again"), "2024-02-10")
    assert metric_rows(run) == metric_rows(rebuilt)
    assert len(metric_rows(run)["gold/metrics/day_states"]) >= 8


def test_a_lake_without_day_states_gets_them_for_all_days(spark, tmp_path):
    root = str(tmp_path / "lake")
    lake.run_lake(spark, lake_input(spark), root, AS_OF)
    before = metric_rows(lake.Lake(spark, root))
    (tmp_path / "lake/gold/metrics/day_states").rename(tmp_path / "away")
    run = lake.run_lake(spark, lake_input(spark), root, AS_OF, changed_since="2024-01-20")
    assert metric_rows(run) == before


def test_a_first_clustered_load_writes_messages_once_a_layer(spark, tmp_path, monkeypatch):
    """The raw messages are not staged, and the silver ones are written once beside the copy that clustering reads."""
    staged, written = [], []
    plain_staged, plain_replace = lake.staged, lake.replace_table
    monkeypatch.setattr(lake, "staged", lambda df, label: staged.append(label) or plain_staged(df, label))
    monkeypatch.setattr(lake, "replace_table", lambda df, path, *a, **k: written.append(path) or plain_replace(df, path, *a, **k))
    root = str(tmp_path / "lake")
    run = lake.run_lake(spark, lake_input(spark, content="'a'"), root, AS_OF, cluster=True)
    assert contents(run.table("silver/messages")) == {"m1": "a"} and run.rows["silver/messages"] == 1
    assert staged.count("loose") == 1 and "messages" not in staged and "calls" not in staged
    assert written.count(f"{root}/silver/messages") == 1
    again = lake.run_lake(spark, lake_input(spark, content="'b'", updatedAt="TIMESTAMP '2024-01-09'"), root, AS_OF, cluster=True)
    assert contents(again.table("silver/messages")) == {"m1": "b"} and staged.count("messages") == 1


def test_an_update_writes_messages_once_a_layer_and_keeps_no_copy(spark, tmp_path, monkeypatch):
    """The staged batch goes when bronze has it; the rows that stay are written beside the new ones, and no row twice."""
    from palaver.sources import tables

    root, written, copies = str(tmp_path / "lake"), {}, []
    plain, plain_staged = tables.write_table, lake.staged

    def write(df, path, *args, **kwargs):
        name = path.removeprefix(f"{root}/").split(".merging-")[0]
        written[name] = written.get(name, 0) + (rows := plain(df, path, *args, **kwargs))
        return rows

    monkeypatch.setattr(tables, "write_table", write)
    monkeypatch.setattr(lake, "staged", lambda df, label: copies.append((label, out := plain_staged(df, label))) or out)
    first = lake_input(spark, content="'a'")
    first["messages"] = first["messages"].unionByName(raw_message(spark, _id="named_struct('oid', 'm2')", content="'b'"))
    lake.run_lake(spark, first, root, AS_OF)
    written.clear()
    edit = lake_input(spark, content="'c'", updatedAt="TIMESTAMP '2024-01-09'")
    run = lake.run_lake(spark, edit, root, AS_OF, changed_since="2024-01-01")
    assert contents(run.table("silver/messages")) == {"m1": "c", "m2": "b"}
    assert written["bronze/messages"] == written["silver/messages"] == 2
    ((label, batch),) = [c for c in copies if c[0] == "messages"]
    with pytest.raises(Exception, match="FILE_NOT_EXIST|does not exist"):
        batch.collect()
