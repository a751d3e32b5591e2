"""Checked exports (manifest, every value as read back) and reloaded days."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stepwise.plans.catalog import fixture_marts
from stepwise.sources.export import EXPORT_LEADING, MART_NAMES, ExportMismatch, as_cells, export_all, export_columns, read_exports
from stepwise.sources.fixture import load_raw
from stepwise.sources.ga4 import read_raw_events, replace_days, write_raw_events
from tests.conftest import SMOKE_DIR


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("exports") / "all")
    marts = fixture_marts(spark, SMOKE_DIR).shared(events=True, items=True).counted()
    tables = {name: getattr(marts, name) for name in MART_NAMES}
    export_all(tables, out)
    return out, {n: (df.columns, df.dtypes, sorted(map(tuple, df.collect()), key=repr)) for n, df in tables.items()}


def test_every_mart_comes_back_as_it_was(spark, exported):
    out, want = exported
    got = read_exports(spark, out)
    assert sorted(got) == sorted(MART_NAMES)
    for name, df in got.items():
        columns, dtypes, rows = want[name]
        assert df.columns == export_columns(name, columns)
        assert sorted(df.dtypes) == sorted(dtypes)
        assert sorted(map(tuple, df.select(*columns).collect()), key=repr) == rows
    assert got["friction_score"].columns[:2] == EXPORT_LEADING["friction_score"]
    assert got["funnel_summary"].where("previous_step_count IS NULL").count() == 3  # nulls stay nulls
    assert {r[0] for r in got["category_performance"].select("is_low_confidence_category").collect()} == {True, False}


def test_layers_that_several_marts_build_on_are_computed_once(spark):
    plain = fixture_marts(spark, SMOKE_DIR)
    marts = plain.for_all_marts()
    for name in ("session_funnel_steps", "funnel_counts", "revenue_baseline", "category_performance"):
        got, want = getattr(marts, name), getattr(plain, name)
        assert "Aggregate" not in got._jdf.queryExecution().optimizedPlan().toString()  # read as written
        assert got.dtypes == want.dtypes and got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def _file(out, mart):
    return next(os.path.join(out, mart, f) for f in os.listdir(os.path.join(out, mart)) if f.endswith(".csv"))


def _edited(spark, exported, tmp_path, mart, change):
    """A copy of the export with one file changed."""
    out = str(tmp_path / "copy")
    for name in [*MART_NAMES, "manifest"]:
        os.makedirs(os.path.join(out, name))
        for f in os.listdir(os.path.join(exported[0], name)):
            if not f.endswith(".crc"):
                with open(os.path.join(exported[0], name, f), "rb") as a, open(os.path.join(out, name, f), "wb") as b:
                    b.write(a.read())
    path = _file(out, mart)
    with open(path, encoding="utf-8") as f:
        lines = f.read().split("\n")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(change(lines)))
    return out


@pytest.mark.parametrize(
    "change",
    [
        lambda lines: lines[:-2] + lines[-1:],  # a row less
        lambda lines: lines[:-1] + lines[1:],  # rows twice
        lambda lines: [lines[0].replace("step_order", "step"), *lines[1:]],  # another header
        lambda lines: [*lines[:2], lines[2].replace("Shipping", "Shopping"), *lines[3:]],  # another text
    ],
)
def test_a_changed_file_is_refused(spark, exported, tmp_path, change):
    out = _edited(spark, exported, tmp_path, "funnel_summary", change)
    with pytest.raises(ExportMismatch, match="funnel_summary"):
        read_exports(spark, out)


def test_an_unchanged_copy_is_accepted(spark, exported, tmp_path):
    assert len(read_exports(spark, _edited(spark, exported, tmp_path, "funnel_summary", lambda lines: lines))) == 6


def test_cells(spark, exported):
    df = read_exports(spark, exported[0])["revenue_leakage"]
    cells = as_cells("revenue_leakage", df).collect()
    assert len(cells) == 9 * len(df.columns)
    assert [c.column_name for c in cells if c.row_number == 1] == df.columns
    assert {c.row_number for c in cells} == set(range(1, 10))
    first = {c.column_name: (c.text_value, c.number_value) for c in cells if c.row_number == 1}
    assert first["overall_leakage_rank"] == (None, 1.0) and first["funnel_type"][1] is None and first["funnel_type"][0]


def test_an_export_without_marts_has_no_manifest(spark, tmp_path):
    assert not os.path.exists(os.path.join(export_all({}, str(tmp_path / "none")), "manifest"))


# ---------------------------------------------------------- reloaded days --
def _parts(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_reloading_a_day_rewrites_its_folder_only(spark, tmp_path):
    path = str(tmp_path / "events")
    raw = load_raw(spark, SMOKE_DIR)
    write_raw_events(raw.where(F.col("event_name") != "purchase"), path)
    before = _parts(path)
    days = sorted(r.event_date for r in raw.select("event_date").distinct().collect())
    replace_days(raw, path, [days[3]])
    after = _parts(path)
    changed = {os.path.basename(os.path.dirname(f)) for f, _ in set(before.items()) ^ set(after.items())}
    assert changed == {f"event_date={days[3]}"}
    # And again: the same rows. Then all days: a full load.
    replace_days(raw, path, [days[3]])
    one = read_raw_events(spark, path, (days[3], days[3]))
    want = raw.where(F.col("event_date") == days[3])
    assert sorted(map(repr, one.select(*raw.columns).collect())) == sorted(map(repr, want.collect()))
    replace_days(raw, path)
    got = read_raw_events(spark, path, None).select(*raw.columns)
    assert got.exceptAll(raw).count() == 0 and raw.exceptAll(got).count() == 0


def test_a_day_without_records_and_a_new_day(spark, tmp_path):
    path = str(tmp_path / "events")
    raw = load_raw(spark, SMOKE_DIR)
    days = sorted(r.event_date for r in raw.select("event_date").distinct().collect())[:3]
    write_raw_events(raw.where(F.col("event_date") == days[0]), path)
    replace_days(raw, path, ["19990101"])
    replace_days(raw.limit(0), path)
    assert [r.event_date for r in read_raw_events(spark, path, None).select("event_date").distinct().collect()] == [days[0]]
    replace_days(raw, path, days[1:])
    assert read_raw_events(spark, path, None).count() == raw.where(F.col("event_date").isin(days)).count()
