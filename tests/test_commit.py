"""Days are replaced by a staged commit: a failing run leaves them as they were."""

import datetime as dt

import pytest

from ledgerline.plans import jobs
from ledgerline.sources import files

DAY = dt.date(2024, 3, 5)


def _history(spark, balance=500.0, day=DAY):
    return spark.createDataFrame([("u", "a", balance, day)], "user_id string, account_id string, "
                                 "immovable_balance double, partition_date date")


def _rates(spark):
    return spark.createDataFrame([(DAY, 0.365)], "partition_date date, cdi_rate double")


def _run(spark, history, payments, audit):
    return jobs.calculate_interest(history, _rates(spark), "2024-03-05", "2024-03-06", payments, audit)


def _amounts(spark, path):
    return [r.interest_amount for r in spark.read.parquet(path).collect()]


class _Failing(jobs.ParquetSink):
    """Writes its rows, then fails before the run can commit."""

    def stage(self, df, obs):
        super().stage(df, obs)
        raise OSError("the sink broke half-way")


def test_a_failing_sink_leaves_the_old_days(spark, tmp_path):
    pay, audit = str(tmp_path / "p"), str(tmp_path / "a")
    _run(spark, _history(spark), jobs.parquet_sink(pay), jobs.parquet_sink(audit))
    for first, second in ((_Failing(pay), jobs.parquet_sink(audit)), (jobs.parquet_sink(pay), _Failing(audit))):
        with pytest.raises(OSError, match="half-way"):
            _run(spark, _history(spark, 900.0), first, second)
        assert _amounts(spark, pay) == [0.5]
        assert spark.read.parquet(audit).first().relevant_balance == 500.0
    res = _run(spark, _history(spark, 900.0), jobs.parquet_sink(pay), jobs.parquet_sink(audit))
    assert _amounts(spark, pay) == [0.9] and res.cleared == ["2024-03-05"]


def test_an_interrupted_swap_is_finished_by_the_next_write(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    days = [DAY, DAY + dt.timedelta(days=1)]
    old = spark.createDataFrame([(d, "old") for d in [*days, DAY + dt.timedelta(days=2)]], "partition_date date, v string")
    new = spark.createDataFrame([(d, "new") for d in days], "partition_date date, v string")
    files.write_by_day(old, path)
    staged = files.stage_by_day(new, path)
    real, moved = files._fs, []

    class Dying:
        """A file system that breaks after the first day was moved."""

        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, a, b):
            if "partition_date" in a.toString():
                if moved:
                    raise OSError("lost")
                moved.append(1)
            return self.fs.rename(a, b)

    monkeypatch.setattr(files, "_fs", lambda s, p: (Dying(real(s, p)[0]), real(s, p)[1]))
    with pytest.raises(OSError, match="lost"):
        files.commit_days(spark, path, staged, "2024-03-05", "2024-03-07")
    monkeypatch.setattr(files, "_fs", real)
    assert files.finish_commits(spark, path) == 1
    got = {str(r.partition_date): r.v for r in files.read_by_day(spark, path).collect()}
    assert got == {"2024-03-05": "new", "2024-03-06": "new"}       # the third day of the window is gone
    assert files.finish_commits(spark, path) == 0 and not list((tmp_path / "t").glob("_*-*"))


def test_only_the_window_is_replaced(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(DAY + dt.timedelta(days=i), i) for i in range(4)], "partition_date date, v int")
    files.write_by_day(rows, path)
    assert files.commit_days(spark, path, None, "2024-03-06", "2024-03-07") == ["2024-03-06", "2024-03-07"]
    assert sorted(r.v for r in files.read_by_day(spark, path).collect()) == [0, 3]
    assert files.commit_days(spark, str(tmp_path / "none"), None, "2024-03-06", "2024-03-07") == []
