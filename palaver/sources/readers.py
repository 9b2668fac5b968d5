"""Scans of the operational systems. Connector jars are the cluster's; files serve where there is none."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palaver.schemas import Contract, ddl


def scan_documents(
    spark: SparkSession, options: Mapping[str, str], contract: Contract, fmt: str = "mongodb"
) -> DataFrame:
    """Document-store collection: options ``uri``, ``database``, ``collection`` and, for parallel reads, ``partitioner``.

    A declared schema spares the sampling pass of schema inference.
    """
    return spark.read.format(fmt).schema(ddl(contract)).options(**options).load()


def scan_landing(spark: SparkSession, path: str, contract: Contract, fmt: str = "json") -> DataFrame:
    """Landing files (JSON or Parquet) that hold exported documents."""
    return spark.read.format(fmt).schema(ddl(contract)).load(path)


def relational_options(
    url: str,
    table: str,
    driver: str,
    user: str | None = None,
    password: str | None = None,
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """JDBC reader options. ``split_on`` with ``bounds`` reads in parallel ranges of a numeric or date column;
    without it the whole table passes through one task, which only suits small tables."""
    options = {"url": url, "dbtable": table, "driver": driver, "fetchsize": str(fetch_size)}
    if user is not None:
        options["user"] = user
    if password is not None:
        options["password"] = password
    if split_on is not None:
        if bounds is None:
            raise ValueError("split_on needs bounds")
        options |= {
            "partitionColumn": split_on, "lowerBound": str(bounds[0]), "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def scan_relational(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


# Columns of the auth service and the names they take in the lake.
AUTH_NAMES = {
    "id": "authUserId", "email": "authEmail", "email_verified": "emailVerified",
    "two_factor_enabled": "twoFactorEnabled", "last_login_at": "lastLoginAt", "login_count": "loginCount",
    "created_at": "authCreatedAt",
}


def auth_accounts(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for old, new in AUTH_NAMES.items()])


def scan_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "earliest",
    max_offsets_per_trigger: int | None = None,
) -> DataFrame:
    """Message-bus topic as a stream with ``value`` and ``timestamp`` columns."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", "false")
    )
    if max_offsets_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return reader.load()


def scan_value_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """The same two columns from Parquet files in a folder, read in order of arrival."""
    reader = spark.readStream.schema("value string, timestamp timestamp")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)
