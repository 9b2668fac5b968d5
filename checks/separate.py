"""Seconds of the plain formulation of each job, one pass per aggregate and a chain of joins, beside the fused one.

``python -m checks.separate [folder]``: one warm-up, then the median of three runs, results to the no-op sink.
"""

from __future__ import annotations

import statistics
import sys
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.queries import AS_OF, QUERIES
from checks.session import session
from checks.stage import Stage, stage
from palaver.plans import activity, daily, engagement, features


def _chain(rows: DataFrame, sides: list[DataFrame], keys: list[str]) -> DataFrame:
    for side in sides:
        rows = rows.join(side, keys, "left")
    return rows


def user_activity(s: Stage) -> DataFrame:
    messages, calls = s.messages(), s.calls()
    return _chain(activity.message_activity(messages), [
        activity.reactions_by_day(messages), activity.calls_initiated(calls), activity.calls_received(calls),
        activity.first_touch(messages),
    ], activity.USER_DAY)


def daily_metrics(s: Stage) -> DataFrame:
    per_hour = s.messages().groupBy(F.to_date("createdAt").alias("metricDate"), F.hour("createdAt").alias("hour")).count()
    peak = per_hour.groupBy("metricDate").agg(F.max(F.struct("count", "hour"))["hour"].alias("peakHour"))
    return _chain(daily.active_users_per_day(s.activity()), [
        daily.new_per_day(s.users(), "newUsers"), daily.message_mix(s.messages()), peak, daily.call_metrics(s.calls()),
        daily.new_per_day(s.conversations(), "newConversations"), daily.active_conversations_per_day(s.messages()),
    ], ["metricDate"])


def user_engagement(s: Stage) -> DataFrame:
    return _chain(s.users().select("userId"), [
        engagement.rolling_activity(s.activity(), AS_OF), engagement.lifetime_totals(s.activity()),
        engagement.network_size(engagement.contact_pairs(s.messages())),
        engagement.groups_per_user(engagement.contact_pairs(s.messages()), s.conversations()),
    ], ["userId"])


def user_features(s: Stage) -> DataFrame:
    return _chain(s.users().select("userId"), [
        features.feature_windows(s.activity(), AS_OF), features.velocity(s.activity(), AS_OF),
        features.churn_label(s.activity(), AS_OF), features.social_features(s.messages(), AS_OF),
        features.temporal_features(s.messages(), AS_OF),
    ], ["userId"])


def seconds(build) -> float:
    def once() -> float:
        start = time.perf_counter()
        build().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    once()
    return statistics.median(once() for _ in range(3))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = session()
    s = stage(spark, sf_dir)
    s.build()
    for plain in (user_activity, daily_metrics, user_engagement, user_features):
        name = plain.__name__
        print(f"{name} {seconds(lambda: plain(s)):.2f} {seconds(lambda: QUERIES[name](spark, sf_dir)):.2f}", flush=True)


if __name__ == "__main__":
    main()
