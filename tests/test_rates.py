"""Rate feed: parsing, dropping bad rows, JSON landing files, day-partitioned storage."""

import datetime as dt
import json
import os
import tempfile

import pytest

from ledgerline.operators import rates as ops
from ledgerline.sources import files


def raw(spark, rows):
    return spark.createDataFrame(rows, "data string, valor string")


def test_normalize_parses_day_first_and_percent(spark):
    out = ops.normalize(raw(spark, [("02/01/2024", "11.65")])).collect()
    assert [(r.partition_date, r.cdi_rate) for r in out] == [(dt.date(2024, 1, 2), 0.1165)]


def test_unparseable_rows_are_dropped(spark):
    out = ops.normalize(raw(spark, [("02/01/2024", "n/d"), ("2024-01-03", "10.0"),
                                    ("31/02/2024", "10.0"), (None, "10"), ("04/01/2024", "10.40")]))
    assert [(r.partition_date, r.cdi_rate) for r in out.collect()] == [(dt.date(2024, 1, 4), 10.40 / 100)]


def test_in_range_single_day_and_range(spark):
    r = ops.normalize(raw(spark, [("01/01/2024", "10"), ("02/01/2024", "11"), ("03/01/2024", "12")]))
    assert ops.in_range(r, "2024-01-02").count() == 1
    assert ops.in_range(r, "2024-01-02", "2024-01-03").count() == 2


def test_json_landing_file(spark):
    d = tempfile.mkdtemp(prefix="rates-json-")
    with open(os.path.join(d, "feed.json"), "w") as fh:
        json.dump([{"data": "02/01/2024", "valor": "11.65"}, {"data": "03/01/2024", "valor": "x"}], fh)
    out = ops.normalize(files.read_rates_json(spark, d)).collect()
    assert [(r.partition_date, r.cdi_rate) for r in out] == [(dt.date(2024, 1, 2), 0.1165)]


def test_empty_feed_has_typed_columns(spark):
    out = ops.normalize(raw(spark, []))
    assert out.isEmpty() and dict(out.dtypes) == {"partition_date": "date", "cdi_rate": "double"}


def _rates(spark, days):
    return ops.normalize(raw(spark, [(f"{d:02d}/01/2024", "10.5") for d in days]))


def test_dynamic_overwrite_keeps_other_days(spark, tmp_path):
    path = str(tmp_path / "rates")
    files.write_rates(_rates(spark, [1, 2, 3]), path)
    files.write_rates(_rates(spark, [3, 4]), path, dynamic=True)
    assert sorted(r.partition_date.day for r in files.read_rates(spark, path).collect()) == [1, 2, 3, 4]


def test_static_overwrite_wipes_other_days(spark, tmp_path):
    path = str(tmp_path / "rates")
    files.write_rates(_rates(spark, [1, 2, 3]), path)
    files.write_rates(_rates(spark, [3, 4]), path, dynamic=False)
    assert sorted(r.partition_date.day for r in files.read_rates(spark, path).collect()) == [3, 4]


def test_window_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "rates")
    files.write_rates(_rates(spark, [1, 2, 3, 4, 5]), path)
    df = files.read_rates(spark, path, "2024-01-02", "2024-01-03")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(partition_date" in plan
    assert sorted(r.partition_date.day for r in df.collect()) == [2, 3]
    assert [r.partition_date.day for r in files.read_rates(spark, path, "2024-01-04").collect()] == [4]


def test_json_lines_feed(spark, tmp_path):
    from ledgerline.plans import jobs
    d = tmp_path / "feed"
    d.mkdir()
    (d / "a.json").write_text("\n".join(json.dumps({"data": f"0{i}/01/2024", "valor": "10"}) for i in (1, 2, 3)))
    assert jobs.fetch_rates(spark, str(d), str(tmp_path / "r")).rows == {"rates": 3}


def test_layouts_mix_and_bad_text_fails(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"data": "01/01/2024", "valor": "1"},\n {"data": "02/01/2024", "valor": 2.5}]')
    (tmp_path / "b.json").write_text('\n{"data": "03/01/2024", "valor": "3"}\r\n{"data": "04/01/2024", "valor": "4"}\n')
    got = files.read_rates_json(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == [("01/01/2024", "1"), ("02/01/2024", "2.5"), ("03/01/2024", "3"), ("04/01/2024", "4")]
    (tmp_path / "c.json").write_text("{not json")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_rates_json(spark, str(tmp_path)).collect()
