"""Lake tables: partitioned Parquet directories."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from palaver.operators.layout import balance, cluster, compact
from palaver.operators.merge import merge, unique_keys
from palaver.schemas import Contract, ddl
from palaver.sources.files import Files
from palaver.sources.scratch import scratch_dir

# Texts take about a third less room than with Parquet's default in Spark.
CODEC = "zstd"
# Spark then removes the shuffle files of a job when the job ends, not when the driver happens to collect garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files behind. For writes: nothing reads the shuffles of a finished one again."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def read_table(spark: SparkSession, path: str, contract: Contract | StructType | None = None) -> DataFrame:
    """The table at ``path``; with its contract, no file is opened to find the schema, and none need exist."""
    if contract is None:
        return spark.read.parquet(path)
    schema = contract if isinstance(contract, StructType) else ddl(contract)
    return spark.read.schema(schema).parquet(path)


def find_table(spark: SparkSession, path: str, contract: Contract | StructType | None = None) -> DataFrame | None:
    """The table at ``path``, or None when there is no such path."""
    try:
        return read_table(spark, path, contract)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "append", placed: bool = False
) -> int:
    """Write and return the row count, observed while writing (no second job). ``placed`` rows are written where they are."""
    seen = Observation()
    rows = balance(df, partition_by) if partition_by and not placed else df
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
    with shuffles_removed(df.sparkSession):
        counted.write.mode(mode).partitionBy(*partition_by).parquet(path, compression=CODEC)
    return seen.get["rows"]


def replace_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), placed: bool = False) -> int:
    """Create the table or replace its whole content; ``df`` must not read from ``path``."""
    return write_table(df, path, partition_by, mode="overwrite", placed=placed)


def upsert_table(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str] = (),
    out_path: str | None = None,
) -> int:
    """Merge ``source`` into the table at ``path`` and write the result to ``out_path``.

    A missing table is created at ``path`` (or ``out_path``). A table cannot be overwritten while it is read, so an
    existing one needs an ``out_path`` of its own. The source is staged, so it is computed once.
    """
    target = find_table(spark, path, source.schema)
    if target is None:
        return write_table(source, out_path or path, partition_by, mode="overwrite")
    if out_path is None or out_path.rstrip("/") == path.rstrip("/"):
        raise ValueError("an existing table is merged into a fresh directory: give out_path")
    return write_table(merge(target, staged(source, "source"), keys), out_path, partition_by, mode="overwrite")


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to a scratch folder and read back."""
    path = scratch_dir(df.sparkSession, label)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path, compression=CODEC)
    return read_table(df.sparkSession, path, df.schema)


def discard(rows: DataFrame) -> None:
    """Remove the folder of ``staged`` rows that nothing reads any more."""
    for folder in {f.rsplit("/", 1)[0] for f in rows.inputFiles()}:
        Files(rows.sparkSession, folder).remove(folder)


def _ordinal(partition_by: Sequence[str]) -> Column:
    """Time partition columns (year, month, day) as one number that orders like them."""
    out = F.lit(0)
    for c in partition_by:
        out = out * 100 + F.col(c)
    return out


def in_same_directories(target: DataFrame, source: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Target rows in the directories that ``source`` (a written table) has rows for.

    A semi join on the partition columns decides, whatever their number. The lowest and the highest directory of the
    source are scalar subqueries on the same columns, so the scan opens nothing outside that range.
    """
    touched = source.select(*partition_by).distinct()
    place = _ordinal(partition_by)
    low, high = (source.agg(f(place).alias("edge")).scalar() for f in (F.min, F.max))
    near = target.filter(place.isNull() | ((place >= low) & (place <= high)))
    same = [near[c].eqNullSafe(touched[c]) for c in partition_by]
    return near.join(touched, same, "left_semi")


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> int:
    """Replace the directories that ``df`` (not read from ``path``) has rows for; the others stay."""
    seen = Observation()
    counted = balance(df, partition_by).observe(seen, F.count(F.lit(1)).alias("rows"))
    with shuffles_removed(df.sparkSession):
        (
            counted.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partition_by)
            .parquet(path, compression=CODEC)
        )
    return seen.get["rows"]


def _aside(path: str) -> str:
    """A fresh folder beside the table, in the same file system, from which directories can be moved into it."""
    return f"{path.rstrip('/')}.merging-{uuid.uuid4().hex}"


def _directories(files: Files, path: str, partition_by: Sequence[str]) -> list[str]:
    """The partition directories under ``path``, by their part of the path."""
    found = files.matching("/".join([path.rstrip("/"), *[f"{c}=*" for c in partition_by]]))
    return ["/".join(f.rsplit("/", len(partition_by))[1:]) for f in found]


def place_directories(spark: SparkSession, aside: str, path: str, partition_by: Sequence[str]) -> None:
    """Move the partition directories under ``aside`` into the table, each to the place of the old one.

    Old directories are put aside and go when all new ones are in place: where a call failed half-way, another one with the
    same folder finishes it.
    """
    files, away = Files(spark, path), f"{aside}.old"
    for part in _directories(files, aside, partition_by):
        new, old, kept = (f"{folder.rstrip('/')}/{part}".rstrip("/") for folder in (aside, path, away))
        if files.exists(old):
            files.move(old, kept)
        files.move(new, old)
    files.remove(aside)
    files.remove(away)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], placed: bool = False) -> int:
    """Replace the directories that ``df``, which may read from ``path``, has rows for. Rows are written once, beside it."""
    aside = _aside(path)
    rows = write_table(df, aside, partition_by, mode="overwrite", placed=placed)
    place_directories(df.sparkSession, aside, path, partition_by)
    return rows


def _staying(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, str]:
    """The rows of ``merge.unmatched``, and the folder of keys that they are found by.

    The keys alone decide which ones stay and which ones go, and are written as two directories. Rows are then held against
    the smaller of both, so that where Spark's limits let it broadcast that one no row is shuffled.
    """
    spark, folder, complete = target.sparkSession, scratch_dir(target.sparkSession, "keys"), F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    known = target.select(*keys).filter(complete).distinct()
    gone = unique_keys(source, keys).withColumn("_goes", F.lit(1))
    marked = known.join(gone, list(keys), "left").withColumn("_goes", F.coalesce("_goes", F.lit(0)))
    write_table(marked, folder, ["_goes"], placed=True)
    marks = read_table(spark, folder, marked.schema)
    counts = marks.agg(F.count_if(F.col("_goes") == 1).alias("go"), F.count_if(F.col("_goes") == 0).alias("stay")).first()
    if not counts["go"]:
        return target, folder
    loose = target.filter(~complete)
    if not counts["stay"]:
        return loose, folder
    few, how = (0, "left_semi") if counts["stay"] < counts["go"] else (1, "left_anti")
    kept = target.filter(complete).join(marks.filter(F.col("_goes") == few).select(*keys), list(keys), how)
    return kept.select(*target.columns).unionByName(loose), folder


def upsert_partitions(
    spark: SparkSession,
    source: DataFrame,
    path: str,
    keys: Sequence[str],
    partition_by: Sequence[str],
    staging_path: str | None = None,
    check_moved: bool = False,
    placed: bool = False,
) -> int:
    """Merge by rewriting only the directories that ``source`` touches.

    For tables whose key fixes the (integer) partition columns: a message never changes its creation day. The source is
    written once, in directories beside the table; of the target only the same directories are read, and their rows that
    stay are written beside the new ones. Then the directories move into the table (``place_directories``): a move that
    failed can be repeated. ``placed`` rows are written by the tasks that hold them. With ``staging_path`` the rows that stay
    are also left there.

    ``check_moved`` also reads the keys of all other directories and fails the call, before anything is replaced, when a
    key sits in another directory than its new version: use ``upsert_table`` there.
    """
    target = find_table(spark, path, source.schema)
    if target is None:
        return write_table(source, path, partition_by, mode="overwrite", placed=placed)
    aside, files = _aside(path), Files(spark, path)
    try:
        rows = write_table(source, aside, partition_by, placed=placed)
        fresh = read_table(spark, aside, source.schema)
        if check_moved:
            homes = fresh.dropna(subset=list(keys)).select(*keys, *[F.col(c).alias(f"_new_{c}") for c in partition_by])
            elsewhere = F.lit(False)
            for c in partition_by:
                elsewhere = elsewhere | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
            if not target.select(*keys, *partition_by).join(homes, list(keys)).filter(elsewhere).isEmpty():
                raise ValueError("a merge key changed its partition; use upsert_table")
        mine = set(_directories(files, aside, partition_by))
        both = [f"{path.rstrip('/')}/{part}".rstrip("/") for part in _directories(files, path, partition_by) if part in mine]
        touched = spark.read.schema(target.schema).option("basePath", path).parquet(*both) if both else target.limit(0)
        kept, folder = _staying(touched, fresh, keys)
        if staging_path:
            write_table(kept, staging_path, mode="overwrite")
            kept = read_table(spark, staging_path, target.schema)
        rows += write_table(kept, aside, partition_by, placed=placed)
        files.remove(folder)
    except Exception:
        files.remove(aside)  # the table is as it was
        raise
    place_directories(spark, aside, path, partition_by)
    return rows


def compact_table(spark: SparkSession, path: str, out_path: str, partition_by: Sequence[str] = ()) -> None:
    compact(read_table(spark, path), partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(out_path)


def cluster_table(
    spark: SparkSession,
    path: str,
    out_path: str,
    columns: Sequence[str],
    spread: Sequence[str] = (),
    partition_by: Sequence[str] = (),
) -> None:
    """Rewrite a table ordered by ``columns`` inside each output directory."""
    ordered = cluster(read_table(spark, path), [*partition_by, *columns], spread)
    ordered.write.mode("overwrite").partitionBy(*partition_by).parquet(out_path)
