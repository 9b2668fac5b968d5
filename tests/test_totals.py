"""Carried totals against full sums."""

import datetime as dt
import random

import pytest

from palaver import schemas
from palaver.plans import engagement, lake, totals
from palaver.schemas import MONTH_PARTITIONS
from palaver.sources.tables import read_table, replace_table, staged
from tests.test_plans import lake_input, plan, raw_message

START = dt.date(2024, 1, 1)


def activity_of(spark, days):
    """Activity rows of {(user, date): (messages, seconds)}."""
    rows = [(u, d, n, n % 3, s, n > 0 or s > 0) for (u, d), (n, s) in days.items()]
    df = spark.createDataFrame(rows, "userId string, activityDate date, n bigint, r bigint, s bigint, active boolean")
    values = {
        "userId": "userId", "activityDate": "activityDate", "messagesSent": "n", "messagesReceived": "0",
        "reactionsGiven": "r", "reactionsReceived": "n + r", "callsInitiated": "s DIV 50", "callsReceived": "s DIV 70",
        "totalCallDurationMinutes": "s / 60.0D", "isActiveDay": "active", "year": "year(activityDate)",
        "month": "month(activityDate)", "day": "day(activityDate)",
    }
    return df.selectExpr(*[f"CAST({values.get(c, 'NULL')} AS {t}) AS {c}" for c, t in schemas.USER_ACTIVITY.items()])


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_forty_days_with_late_edits_equal_full_sums(spark):
    chance, days, state = random.Random(7), {}, None
    users = ["a", "b", "c", None, "rare"]
    for i in range(40):
        today = START + dt.timedelta(i)
        before, first = dict(days), today
        for user in users[:4]:
            if chance.random() < 0.7:
                days[user, today] = (chance.randrange(5), chance.randrange(200))
        if i == 3:
            days["rare", today] = (2, 61)
        if days and chance.random() < 0.5:  # a late edit of one day, a late deletion of another
            key = chance.choice(list(days))
            days[key] = (chance.randrange(9), chance.randrange(100))
            gone = chance.choice([k for k in days if k[0] != "rare"] or [key])
            first = min(first, key[1], gone[1])
            del days[gone]
        now = activity_of(spark, days)
        if state is None:
            state = staged(totals.user_totals(now, today), "state")
        else:
            old = activity_of(spark, {k: v for k, v in before.items() if k[1] >= first})
            state = totals.carry_totals(state, old, now, first, today)
        if i % 4 == 3:
            assert rows_of(state) == rows_of(totals.user_totals(now, today)), today
    full = rows_of(totals.windows_and_lifetime(totals.user_totals(now, today)))
    assert rows_of(totals.windows_and_lifetime(state)) == full and len(full) == 5


def test_a_lost_last_day_is_looked_up_and_a_lost_user_goes(spark):
    jan = [START + dt.timedelta(i) for i in range(20)]
    days = {("u", jan[1]): (1, 0), ("u", jan[15]): (4, 30), ("v", jan[15]): (2, 0), (None, jan[2]): (1, 1), (None, jan[15]): (1, 1)}
    state = staged(totals.user_totals(activity_of(spark, days), jan[16]), "state")
    left = {k: v for k, v in days.items() if k[1] != jan[15]}
    old = activity_of(spark, {k: v for k, v in days.items() if k[1] == jan[15]})
    got = totals.carry_totals(state, old, activity_of(spark, left), jan[15], jan[16])
    assert {r.userId: r.lastActiveDate for r in got.collect()} == {"u": jan[1], None: jan[2]}
    assert rows_of(got) == rows_of(totals.user_totals(activity_of(spark, left), jan[16]))


@pytest.mark.parametrize("target", ["2024-01-05", "2024-01-20", "2024-02-09", "2025-01-01"])
def test_the_date_may_go_back_stay_or_jump(spark, target):
    days = {("u", START + dt.timedelta(i)): (i, i) for i in range(0, 30, 3)}
    rows = activity_of(spark, days)
    state = staged(totals.user_totals(rows, "2024-01-20"), "state")
    none = rows.filter("false")
    got = totals.carry_totals(state, none, rows, dt.date(2025, 6, 1), target)
    assert rows_of(got) == rows_of(totals.user_totals(rows, target))
    empty = totals.carry_totals(state.filter("false"), none, rows, START, target)
    assert rows_of(empty) == rows_of(totals.user_totals(rows, target))


def test_same_as_the_direct_sums(spark):
    rows = activity_of(spark, {(u, START + dt.timedelta(i)): (i % 4, i) for i in range(0, 30, 2) for u in "uv"})
    state = totals.windows_and_lifetime(totals.user_totals(rows, "2024-01-25"))
    recent = engagement.rolling_activity(rows, "2024-01-25").drop("uniqueActiveDaysLast30")
    direct = {r.userId: r.asDict() for r in engagement.lifetime_totals(rows).join(recent, "userId").collect()}
    assert {r.userId: pytest.approx(r.asDict()) for r in state.collect()} == direct


def test_only_changed_and_crossing_days_are_read(spark, tmp_path):
    path = str(tmp_path / "activity")
    days = {("u", dt.date(2023, m, d)): (1, 0) for m in range(1, 13) for d in (3, 28)}
    replace_table(activity_of(spark, days), path, MONTH_PARTITIONS)
    table = read_table(spark, path, schemas.USER_ACTIVITY)
    crossed = totals.crossing_days(table, dt.date(2023, 12, 30), dt.date(2024, 1, 1), dt.date(2023, 12, 31))
    assert sorted(str(r.activityDate) for r in crossed.collect()) == []
    crossed = totals.crossing_days(table, dt.date(2023, 12, 28), dt.date(2024, 1, 5), dt.date(2023, 12, 31))
    assert sorted(str(r.activityDate) for r in crossed.collect()) == ["2023-11-28", "2023-12-03", "2023-12-28"]
    assert "PartitionFilters: [isnotnull(year" in plan(crossed)


def lake_totals(run):
    return rows_of(run.table("gold/analytics/user_totals"))


def summed(run, as_of):
    return rows_of(totals.user_totals(run.table("silver/user_activity"), as_of))


def test_lake_carries_totals_and_sums_anew_after_a_stopped_run(spark, tmp_path, monkeypatch):
    def messages(*days):
        out = None
        for d in days:
            at = f"TIMESTAMP '2024-01-{d:02d} 10:00:00'"
            one = raw_message(spark, _id=f"named_struct('oid', 'm{d}')", createdAt=at, updatedAt=at)
            out = one if out is None else out.unionByName(one)
        return out

    root, source = str(tmp_path / "lake"), lake_input(spark)
    lake.run_lake(spark, source | {"messages": messages(1, 2, 12, 20)}, root, "2024-01-20")
    calls, plain = [], lake.carry_totals
    monkeypatch.setattr(lake, "carry_totals", lambda *args: calls.append(1) or plain(*args))
    run = lake.run_lake(spark, source | {"messages": messages(21, 22)}, root, "2024-01-22", changed_since="2024-01-21")
    assert calls == [1] and lake_totals(run) == summed(run, "2024-01-22")

    def stop(*args):
        raise RuntimeError("stopped")

    monkeypatch.setattr(lake, "carry_totals", stop)
    more = source | {"messages": messages(23)}
    with pytest.raises(RuntimeError, match="stopped"):
        lake.run_lake(spark, more, root, "2024-01-23", changed_since="2024-01-23")
    run = lake.run_lake(spark, more, root, "2024-01-23", changed_since="2024-01-23")  # does not carry
    assert lake_totals(run) == summed(run, "2024-01-23") and "messagesSentTotal=7" in lake_totals(run)[0]
