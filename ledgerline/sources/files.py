"""Parquet and JSON sources and sinks."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ledgerline import schemas
from ledgerline.functions import date_lit


def read_cdc(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Change events from a Parquet directory. With no schema the footer's
    schema is used (the reference's behaviour); a declared schema skips
    inference and fails fast on drifted files."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


def read_rates_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Landed rate-feed files of ``{"data": "dd/MM/yyyy", "valor": "10.40"}``
    objects, each file one JSON array (the feed's response as delivered) or
    JSON Lines; the layout is seen from the file itself, so none is read
    short. Text that is neither fails the read. A feed file is a few kB (one
    object per business day), so a file is one row."""
    whole = spark.read.text(path, wholetext=True)
    text = F.regexp_replace("value", r"^[\uFEFF\s]+|\s+$", "")
    strict = {"mode": "FAILFAST"}
    row = schemas.RATES_RAW
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: F.trim(x) != "")
    objects = F.when(text.startswith("["), F.from_json(text, ArrayType(row), strict)).otherwise(
        F.transform(lines, lambda x: F.from_json(x, row, strict)))
    return whole.select(F.explode(objects).alias("o")).where("o is not null").select("o.*")


def write_by_day(df: DataFrame, path: str, mode: str = "overwrite",
                 dynamic: bool = True, compression: str = "snappy",
                 observation: Observation | None = None) -> None:
    """Parquet partitioned by ``partition_date`` (written as ISO text).

    ``dynamic=True`` replaces only the days present in ``df`` (incremental
    daily runs); ``dynamic=False`` is a static overwrite that wipes every
    earlier day under ``path``. Rows are rebalanced by day before the write:
    each task writes one day's folder, and adaptive execution splits a big
    day over several tasks (and merges small ones) from the shuffle's actual
    sizes, without a sampling pass over the data. Rows are sorted by
    account within each day.
    """
    out = (df.withColumn("partition_date", F.col("partition_date").cast("string"))
           .hint("rebalance", "partition_date"))
    # clustered by account inside each day's files: row-group min/max stats
    # then let per-account reads skip most of a day
    order = ["partition_date"] + (["account_id"] if "account_id" in df.columns else [])
    out = out.sortWithinPartitions(*order)
    if observation is not None:
        # above the exchange, so the row count is taken once
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    (out.write
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy("partition_date")
        .mode(mode)
        .parquet(path, compression=compression))


def read_by_day(spark: SparkSession, path: str, schema: StructType | None = None,
                start: str | None = None, end: str | None = None) -> DataFrame:
    """Read a day-partitioned table, pruned to a day or an inclusive range.

    The window is a predicate on the partition column only, so it becomes a
    ``PartitionFilters`` entry and only the needed day folders are listed
    and read, whatever type the partition column is read as. With no
    ``schema`` the files' own schema is used (it keeps zoned or local
    timestamps as written); the day comes back as DATE.
    """
    df = (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    day = F.col("partition_date").cast("date")
    if start is not None:
        if end is None:
            df = df.filter(day == F.lit(start).cast("date"))
        else:
            df = df.filter(day.between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    return df.withColumn("partition_date", day)


def write_rates(rates: DataFrame, path: str, dynamic: bool = True,
                observation: Observation | None = None) -> None:
    write_by_day(rates.select("cdi_rate", "partition_date"), path, dynamic=dynamic,
                 observation=observation)


def read_rates(spark: SparkSession, path: str, start: str | None = None,
               end: str | None = None) -> DataFrame:
    return read_by_day(spark, path, schemas.RATES_STORED, start, end) \
        .select("partition_date", "cdi_rate")


def _ledger_path(path: str) -> str:
    return f"{path.rstrip('/')}_days"


def write_day_ledger(spark: SparkSession, path: str, as_of: str, days: dict[str | None, int]) -> None:
    """Number of events of each day (None: undated) that the state of ``as_of``
    holds, stored beside it. One row per calendar day."""
    (spark.createDataFrame(sorted(days.items(), key=str), "day string, events long").coalesce(1)
     .withColumn("as_of", F.lit(as_of))
     .write.option("partitionOverwriteMode", "dynamic").partitionBy("as_of").mode("overwrite")
     .parquet(_ledger_path(path)))


def read_day_ledger(spark: SparkSession, path: str, as_of: str) -> dict[str | None, int] | None:
    """What ``write_day_ledger`` stored for a day's state, None when nothing was."""
    if not path_exists(spark, f"{_ledger_path(path)}/as_of={as_of}"):
        return None
    rows = spark.read.parquet(_ledger_path(path)).filter(F.col("as_of") == F.lit(as_of).cast("date"))
    return {r["day"]: r["events"] for r in rows.collect()}      # one row per calendar day


def write_state(state: DataFrame, path: str) -> None:
    """Balance state partitioned by its ``as_of`` day (dynamic overwrite:
    rewriting one day's state leaves the others)."""
    (state.withColumn("as_of", F.col("as_of").cast("string"))
        .hint("rebalance")
        .write.option("partitionOverwriteMode", "dynamic")
        .partitionBy("as_of").mode("overwrite").parquet(path))


def write_pairs(pairs: DataFrame, path: str) -> None:
    """Adds (account, user) pairs to a stored dictionary."""
    pairs.select("account_id", "user_id").hint("rebalance").write.mode("append").parquet(path)


def read_pairs(spark: SparkSession, path: str) -> DataFrame | None:
    """The stored (account, user) pairs, or None when there is no dictionary."""
    if not path_exists(spark, path):
        return None
    return spark.read.schema("account_id string, user_id string").parquet(path).distinct()


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path (local, HDFS, object stores alike) and
    a maker of its path objects."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, make = _fs(spark, path)
    return fs.exists(make(path))


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries; none when it is not there."""
    fs, make = _fs(spark, path)
    return [st.getPath().getName() for st in fs.listStatus(make(path))] if fs.exists(make(path)) else []


def state_days(spark: SparkSession, path: str) -> list[str]:
    """Days for which a state was written (folder listing, no data read)."""
    return sorted(n.split("=", 1)[1] for n in _folders(spark, path) if n.startswith("as_of="))


def read_state(spark: SparkSession, path: str, as_of: str) -> DataFrame | None:
    """The state of one day, or None when it was never written."""
    if not path_exists(spark, f"{path.rstrip('/')}/as_of={as_of}"):
        return None
    df = spark.read.parquet(path).filter(F.col("as_of") == F.lit(as_of).cast("date"))
    return df.select("account_id", "user_id", "balance", "last_movement_ts",
                     F.col("as_of").cast("date").alias("as_of"))


# --- staged commit of a window's days -----------------------------------------
# Names with a leading underscore are not read as data by Spark.
_STAGED, _MARKER = "_staged-", "_commit-"


def _days(spark: SparkSession, path: str) -> list[str]:
    prefix = "partition_date="
    return sorted(n[len(prefix):] for n in _folders(spark, path) if n.startswith(prefix))


def stage_by_day(df: DataFrame, path: str, observation: Observation | None = None) -> str:
    """Writes the frame, by day, to a new staging folder inside the table
    ``path`` and returns the folder's name. The table's days are untouched."""
    name = f"{_STAGED}{uuid.uuid4().hex}"
    write_by_day(df, f"{path.rstrip('/')}/{name}", dynamic=False, observation=observation)
    return name


def commit_days(spark: SparkSession, path: str, staged: str | None, start: str, end: str) -> list[str]:
    """Puts the staged days in place of the table's days from ``start`` to
    ``end`` (and of any other day that was staged); days of the window that
    were not staged go. Returns the earlier days replaced or removed.

    A marker holding the whole intent is put down first, by one rename. Until
    then nothing has changed; from then on the swap is repeatable, and
    ``finish_commits`` ends one that was interrupted. One writer at a time
    per table; a reader during a swap may miss the day being renamed.
    """
    path = path.rstrip("/")
    new = _days(spark, f"{path}/{staged}") if staged else []
    old = _days(spark, path)
    replaced = [d for d in old if start <= d <= end or d in new]
    fs, make = _fs(spark, path)
    if staged or replaced:
        name = f"{_MARKER}{uuid.uuid4().hex}"
        out = fs.create(make(f"{path}/{name}.tmp"))
        out.write(json.dumps({"staged": staged, "gone": [d for d in replaced if d not in new]}).encode())
        out.close()
        if not fs.rename(make(f"{path}/{name}.tmp"), make(f"{path}/{name}")):
            raise OSError(f"could not put down the commit marker in {path}")
        finish_commits(spark, path)
    return replaced


def finish_commits(spark: SparkSession, path: str) -> int:
    """Carries out every commit whose marker is there; returns how many. Each
    step can be repeated: a staged day leaves the staging folder only by the
    rename that puts it in place."""
    path = path.rstrip("/")
    fs, make = _fs(spark, path)
    markers = sorted(n for n in _folders(spark, path) if n.startswith(_MARKER) and not n.endswith(".tmp"))
    for name in markers:
        stream = fs.open(make(f"{path}/{name}"))
        intent = json.loads(bytes(stream.readAllBytes()).decode())
        stream.close()
        for day in intent["gone"]:
            fs.delete(make(f"{path}/partition_date={day}"), True)
        staged = intent["staged"] and f"{path}/{intent['staged']}"
        for day in _days(spark, staged) if staged else []:
            fs.delete(make(f"{path}/partition_date={day}"), True)
            if not fs.rename(make(f"{staged}/partition_date={day}"), make(f"{path}/partition_date={day}")):
                raise OSError(f"could not move day {day} into {path}; the next write goes on with it")
        if staged:
            fs.delete(make(staged), True)
        fs.delete(make(f"{path}/{name}"), False)
    return len(markers)


def drop_staged(spark: SparkSession, path: str, staged: str) -> None:
    """Removes a staging folder that will not be committed."""
    fs, make = _fs(spark, path)
    fs.delete(make(f"{path.rstrip('/')}/{staged}"), True)


# The widest span of event days that is taken for real. Every pair of the
# history has a row for each day of its window, so one stray date centuries
# away would multiply the result.
MAX_SPAN_DAYS = 36_600


def data_window(sg: DataFrame) -> tuple[str, str]:
    """First and last event day of a signed feed (one small aggregate). A span
    of more than ``MAX_SPAN_DAYS`` days raises; no event is dropped for it."""
    row = sg.agg(F.min("partition_date").alias("s"), F.max("partition_date").alias("e")).first()
    if row is None or row["s"] is None:
        raise ValueError("feed has no dated events")
    if (row["e"] - row["s"]).days > MAX_SPAN_DAYS:
        raise ValueError(f"event days span {row['s']} to {row['e']}: over {MAX_SPAN_DAYS} days, check the dates")
    return row["s"].isoformat(), row["e"].isoformat()


__all__ = ["read_cdc", "read_rates_json", "write_by_day", "read_by_day",
           "write_rates", "read_rates", "data_window", "date_lit"]
