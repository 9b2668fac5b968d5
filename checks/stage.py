"""Layer tables of one input folder, written on first use and shared by the queries of a session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.plans import activity, bronze, silver
from palaver.plans.lake import TABLES
from palaver.sources import fixtures
from palaver.sources.scratch import scratch_dir
from palaver.sources.tables import read_table, replace_table

_stages: dict[tuple[str, str], Stage] = {}


class Stage:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self.root = scratch_dir(spark, "stage")
        self.written: set[str] = set()

    def _table(self, name: str, build) -> DataFrame:
        path, spec = f"{self.root}/{name}", TABLES[name]
        if name not in self.written:
            replace_table(build(), path, spec.partition_by, placed=spec.in_place)
            self.written.add(name)
        return read_table(self.spark, path, spec.contract)

    def bronze_messages(self) -> DataFrame:
        return self._table(
            "bronze/messages", lambda: bronze.bronze_messages(fixtures.raw_messages(self.spark, self.sf_dir))
        )

    def accounts(self) -> DataFrame:
        path = f"{self.root}/accounts"
        if path not in self.written:
            replace_table(bronze.login_accounts(fixtures.raw_auth(self.spark, self.sf_dir)), path)
            self.written.add(path)
        return read_table(self.spark, path)

    def bronze_users(self) -> DataFrame:
        return self._table("bronze/users", lambda: bronze.bronze_users(
            fixtures.raw_users(self.spark, self.sf_dir), self.accounts()
        ))

    def conversations(self) -> DataFrame:
        return self._table("bronze/conversations", lambda: bronze.bronze_conversations(
            fixtures.raw_conversations(self.spark, self.sf_dir)
        ))

    def calls(self) -> DataFrame:
        return self._table("bronze/calls", lambda: bronze.bronze_calls(fixtures.raw_calls(self.spark, self.sf_dir)))

    def messages(self) -> DataFrame:
        return self._table(
            "silver/messages", lambda: silver.silver_messages(self.bronze_messages(), self.bronze_users())
        )

    def users(self) -> DataFrame:
        return self._table("silver/users", lambda: silver.silver_users(self.bronze_users(), fixtures.AS_OF))

    def activity(self) -> DataFrame:
        return self._table(
            "silver/user_activity", lambda: activity.user_activity(self.messages(), self.calls())
        )

    def bus_values(self, name: str, first_half: bool) -> DataFrame:
        """Bus records of ``messages`` or ``events``, of one half of the month; written as they come, without a shuffle."""
        path = f"{self.root}/bus/{name}/{'early' if first_half else 'late'}"
        if path not in self.written:
            values = getattr(fixtures, name.removesuffix("s") + "_values")(self.spark, self.sf_dir)
            replace_table(values.filter(F.expr("timestamp < DATE '2024-01-16'") == first_half), path)
            self.written.add(path)
        return read_table(self.spark, path)

    def build(self) -> None:
        self.activity(), self.users(), self.conversations()


def stage(spark: SparkSession, sf_dir: str) -> Stage:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stages:
        _stages[key] = Stage(spark, sf_dir)
    return _stages[key]
