"""Order-free sums, the local regression against a plain version, JDBC pieces."""

import datetime as dt
import math
import random
from statistics import median

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import order_free_avg, order_free_sum
from ledgerline.operators import reports as rep
from ledgerline.sources import jdbc


def test_sums_are_the_same_in_any_order(spark):
    rng = random.Random(5)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-9, 9) for _ in range(4000)] + [None]
    got = set()
    for n in (1, 4, 16):
        rng.shuffle(values)
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(n)
        got.add(tuple(df.agg(order_free_sum("v"), order_free_avg("v")).first()))
    assert len(got) == 1
    total, avg = got.pop()
    exact = math.fsum(v for v in values if v is not None)
    assert total == pytest.approx(exact, rel=1e-12) and avg == pytest.approx(exact / 4000, rel=1e-12)
    none = spark.createDataFrame([(None,)], "v double").agg(order_free_sum("v").alias("s"), order_free_avg("v").alias("a")).first()
    assert none.s is None and none.a is None


def test_reports_are_the_same_for_any_partitioning(spark):
    rng = random.Random(6)
    rows = [(f"a{i % 60}", "u", rng.uniform(0, 9000), 0.1, rng.uniform(0, 3), dt.date(2024, 1, 1 + i % 9)) for i in range(900)]
    seen = set()
    for n in (1, 4, 16):
        rng.shuffle(rows)
        pay = spark.createDataFrame(rows, "account_id string, user_id string, eligible_balance double, interest_rate double, "
                                    "interest_amount double, partition_date date").repartition(n)
        days = rep.payments_by_day(pay, "2024-01-01", "2024-01-31")
        trend = rep.balance_interest_trend(rep.payments_by_day(pay, "2024-01-01", "2024-01-31", ordered=False))
        seen.add((tuple(map(tuple, days.collect())), tuple(trend.first())))
    assert len(seen) == 1


def _plain_lowess(points, fraction=2 / 3, rounds=3):
    points = sorted(points)
    n = len(points)
    k = max(int(fraction * n + 1e-10), min(n, 2))
    weight, fit = [1.0] * n, [0.0] * n
    for r in range(rounds + 1):
        for i, (x, y) in enumerate(points):
            # the k nearest in x form a contiguous stretch; of equally good ones the first
            s = min(range(n - k + 1), key=lambda s: (max(x - points[s][0], points[s + k - 1][0] - x), s))
            near = range(s, s + k)
            h = max(abs(points[j][0] - x) for j in near)
            t = {j: weight[j] * ((1 - (abs(points[j][0] - x) / h) ** 3) ** 3 if h else 1) for j in near}
            sw = sum(t.values())
            if not sw > 0:
                fit[i] = y
                continue
            mx, my = (sum(t[j] * points[j][c] for j in near) / sw for c in (0, 1))
            sxx = sum(t[j] * (points[j][0] - mx) ** 2 for j in near) / sw
            sxy = sum(t[j] * (points[j][0] - mx) * (points[j][1] - my) for j in near) / sw
            fit[i] = my + ((x - mx) * sxy / sxx if sxx > 1e-12 else 0)
        res = [abs(p[1] - f) for p, f in zip(points, fit)]
        six = 6 * median(res)
        weight = [(1 - min(e / six if six else float(e > 0), 1) ** 2) ** 2 for e in res]
    return {p: f for p, f in zip(points, fit)}


@pytest.mark.parametrize("n,kind", [(1, "plain"), (2, "plain"), (3, "plain"), (17, "plain"), (40, "outlier"), (12, "equal")])
def test_lowess_is_the_plain_one(spark, n, kind):
    rng = random.Random(n)
    points = [(rng.uniform(0, 100), rng.uniform(0, 5)) for _ in range(n)]
    if kind == "outlier":
        points[7] = (points[7][0], 500.0)
    if kind == "equal":
        points = [(50.0, y) for _, y in points]
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=i), x, y) for i, (x, y) in enumerate(points)] + [(dt.date(2025, 1, 1), None, 2.0)]
    df = spark.createDataFrame(rows, "partition_date date, saldo_promedio double, interes_total double")
    got = {(r.saldo_promedio, r.interes_total): r.tendencia for r in rep.balance_interest_lowess(df).collect()}
    want = _plain_lowess(points)
    assert set(got) == set(want)
    for p in want:
        assert got[p] == pytest.approx(want[p], abs=1e-6)


def test_trends_of_no_day(spark):
    df = spark.createDataFrame([], "partition_date date, saldo_promedio double, interes_total double")
    assert rep.balance_interest_lowess(df).collect() == []
    assert tuple(rep.balance_interest_trend(df).first()) == (0, None, None, None)


def test_predicates_hold_every_row_once_and_are_even():
    rng = random.Random(1)
    first = dt.date(2024, 1, 1)
    counts = {(first + dt.timedelta(days=i)).isoformat(): rng.randint(50, 150) for i in range(120)}
    counts["2024-02-10"] = 6000          # about a third of all rows
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE t (id BIGINT, day DATE)")
    con.executemany("INSERT INTO t SELECT range, ? FROM range(?)", [[d, n] for d, n in counts.items()])
    con.execute("INSERT INTO t VALUES (1, NULL), (2, DATE '2001-01-01'), (3, DATE '2031-01-01')")
    total = con.sql("SELECT count(*) FROM t").fetchall()[0][0]
    for parts in (1, 4, 16, 500):
        where = jdbc.balanced_predicates("day", counts, parts, split="id")
        held = [con.sql(f"SELECT count(*) FROM t WHERE {w}").fetchall()[0][0] for w in where]
        assert sum(held) == total and max(held) <= 2 * max(total / parts, 150)
        assert con.sql(f"SELECT count(*) FROM t WHERE {' OR '.join('(%s)' % w for w in where)}").fetchall()[0][0] == total
    assert jdbc.balanced_predicates("day", {}, 4) == ["1 = 1"]
    with pytest.raises(ValueError):
        jdbc.balanced_predicates("day", counts, 0)


class _Connection:
    def __init__(self, log, fails=None):
        self.log, self.fails = log, fails

    def createStatement(self):  # noqa: N802 - the JVM's name
        return self

    def setAutoCommit(self, on):  # noqa: N802
        self.log.append(f"autocommit {on}")

    def executeUpdate(self, sql):  # noqa: N802
        self.log.append(sql)
        if self.fails and self.fails in sql:
            raise RuntimeError("database")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


@pytest.mark.parametrize("fails", [None, "INSERT"])
def test_days_of_a_table_are_swapped_in_one_transaction(spark, monkeypatch, fails):
    log = []
    monkeypatch.setattr(jdbc, "write_table", lambda df, url, table, props, **kw: log.append(f"write {df.count()} to {table}"))
    df = spark.createDataFrame([("a", dt.date(2024, 1, d)) for d in (1, 2, 3)], "account_id string, partition_date date")
    swap = lambda: jdbc.replace_days(df, "jdbc:x", "pay", {}, "2024-01-02", "2024-01-03",
                                     connect=lambda url, props: _Connection(log, fails))
    if fails:
        with pytest.raises(RuntimeError):
            swap()
    else:
        swap()
    staging = log[1].split(" to ")[1]
    head = ["autocommit False", f"write 2 to {staging}", "DELETE FROM pay WHERE partition_date BETWEEN '2024-01-02' AND '2024-01-03'",
            f"INSERT INTO pay (account_id, partition_date) SELECT account_id, partition_date FROM {staging}"]
    assert staging.startswith("pay_staging_")
    assert log == head + (["rollback"] if fails else ["commit"]) + [f"DROP TABLE IF EXISTS {staging}", "commit", "close"]
