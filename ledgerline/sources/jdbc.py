"""JDBC tables (e.g. PostgreSQL) as source and sink.

Thin by design: Spark's JDBC data source does the work. The reader can split
the scan on a date or number column into parallel range queries; filters and
column pruning are pushed into the remote query by Catalyst.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline import constants as K
from ledgerline.functions import in_window, validate_dates


def read_table(spark: SparkSession, url: str, table: str, properties: dict[str, str],
               partition_column: str | None = None, lower_bound: str | None = None,
               upper_bound: str | None = None, num_partitions: int | None = None,
               predicates: list[str] | None = None) -> DataFrame:
    """``predicates`` (see ``balanced_predicates``): one task and one range
    query each, instead of equal steps of ``partition_column``."""
    if predicates is not None:
        return spark.read.jdbc(url, table, predicates=predicates, properties=properties)
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    for key, value in properties.items():
        reader = reader.option(key, value)
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound))
                  .option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 8)))
    return reader.load()


def balanced_predicates(column: str, rows_by_day: dict[str, int], parts: int,
                        split: str | None = None) -> list[str]:
    """WHERE clauses that cut a table into about ``parts`` pieces of about
    equal rows, from its rows per day (ISO text; a grouped count of the
    table). Consecutive days are packed up to an equal share. A day with more
    than a share is cut by ``split``, a non-negative whole-number SQL
    expression (``abs(hashtext(account_id))``), where one is given.

    The clauses are disjoint and together hold every row: the first also takes
    earlier days and rows without a day, the last later ones; days that were
    not counted fall to the piece around them.
    """
    if parts < 1:
        raise ValueError(f"parts must be 1 or more, not {parts}")
    days = sorted((d, n) for d, n in rows_by_day.items() if n > 0)
    share = max(1.0, sum(n for _, n in days) / parts)
    pieces: list[tuple[str, int]] = []          # first day and rows of each piece
    for day, n in days:
        if pieces and pieces[-1][1] + n <= share * 1.25:
            pieces[-1] = (pieces[-1][0], pieces[-1][1] + n)
        else:
            pieces.append((day, n))
    out = []
    for i, (first, n) in enumerate(pieces):
        bounds = ([f"{column} >= '{first}'"] if i else []) + (
            [f"{column} < '{pieces[i + 1][0]}'"] if i + 1 < len(pieces) else [])
        where = " AND ".join(bounds) or "1 = 1"
        if i == 0:
            where = f"({where} OR {column} IS NULL)"
        cuts = max(1, round(n / share)) if split else 1
        out += [where] if cuts == 1 else [f"{where} AND mod({split}, {cuts}) = {j}" for j in range(cuts)]
    return out or ["1 = 1"]


# Most connections one write may open.
MAX_WRITERS = 64


def write_table(df: DataFrame, url: str, table: str, properties: dict[str, str],
                mode: str = "overwrite", truncate: bool = False,
                writers: int = K.MIN_JDBC_WRITERS,
                batch_size: int = K.JDBC_BATCH_SIZE,
                observation: Observation | None = None,
                decides: DataFrame | None = None) -> bool:
    """Write ``df``; returns whether anything was written.

    ``writers`` parallel connections, at most ``MAX_WRITERS``. ``decides``: a
    cheap frame (an input of ``df``) that is empty exactly when ``df`` is;
    nothing is written then, and no job runs on ``df`` itself before the
    write. ``truncate=True`` keeps the target's DDL (keys, partitions) on
    overwrite instead of dropping and recreating the table.
    """
    if not 1 <= writers <= MAX_WRITERS:
        raise ValueError(f"writers must be 1 to {MAX_WRITERS}, not {writers}")
    if decides is not None and decides.isEmpty():
        return False
    props = dict(properties)
    props.setdefault("batchsize", str(batch_size))
    props.setdefault("reWriteBatchedInserts", "true")
    props["truncate"] = "true" if truncate else "false"
    out = df.repartition(writers)
    if observation is not None:
        out = out.observe(observation, F.count(F.lit(1)).alias("rows"))
    out.write.jdbc(url=url, table=table, mode=mode, properties=props)
    return True


def replace_days(df: DataFrame, url: str, table: str, properties: dict[str, str], start: str, end: str,
                 connect=None, column: str = "partition_date", writers: int = K.MIN_JDBC_WRITERS,
                 observation: Observation | None = None) -> None:
    """Replaces the days ``start`` to ``end`` of a table with the rows of
    ``df``: Spark writes them to a staging table beside it, then one
    transaction deletes the window and inserts the staged rows. A run that
    fails before its commit leaves the table as it was; other days, keys and
    partitions of the table stay. The staging table is dropped either way.

    ``connect(url, properties)`` gives a connection with the methods of
    ``java.sql.Connection`` (default: the JVM's DriverManager).
    """
    start, end = validate_dates(start, end)
    names = ", ".join(df.columns)
    staging = f"{table}_staging_{uuid.uuid4().hex[:12]}"
    window = f"{column} BETWEEN '{start}' AND '{end}'"
    inside = df.filter(in_window(column, start, end))
    connection = (connect or _driver_manager(df.sparkSession))(url, properties)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        try:
            write_table(inside, url, staging, properties, writers=writers, observation=observation)
            statement.executeUpdate(f"DELETE FROM {table} WHERE {window}")
            statement.executeUpdate(f"INSERT INTO {table} ({names}) SELECT {names} FROM {staging}")
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            statement.executeUpdate(f"DROP TABLE IF EXISTS {staging}")
            connection.commit()
    finally:
        connection.close()


def _driver_manager(spark: SparkSession):
    def connect(url: str, properties: dict[str, str]):
        jvm = spark.sparkContext._jvm
        props = jvm.java.util.Properties()
        for key, value in properties.items():
            props.setProperty(key, value)
        return jvm.java.sql.DriverManager.getConnection(url, props)
    return connect
