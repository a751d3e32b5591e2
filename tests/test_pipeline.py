"""Stage-once pipeline and CSV export sink."""

from __future__ import annotations

import csv
import glob

from stepwise.plans.pipeline import MART_NAMES, run_pipeline, stage
from stepwise.sources.fixture import load_raw
from tests.conftest import SMOKE_DIR


def test_staged_marts_equal_lazy(spark, smoke_marts, tmp_path):
    staged = stage(smoke_marts, str(tmp_path / "stage"))
    for name in ["friction_score", "category_performance", "channel_device_performance", "data_quality_checks"]:
        a = sorted(tuple(r) for r in getattr(smoke_marts, name).collect())
        b = sorted(tuple(r) for r in getattr(staged, name).collect())
        assert a == b, name
    assert glob.glob(str(tmp_path / "stage" / "stg_events" / "event_date=*"))


def test_export_csv(spark, tmp_path):
    raw = load_raw(spark, SMOKE_DIR)
    paths = run_pipeline(raw, None, str(tmp_path / "out"), str(tmp_path / "stage"))
    assert set(paths) == set(MART_NAMES)
    files = glob.glob(paths["friction_score"] + "/*.csv")
    assert len(files) == 1
    with open(files[0], newline="", encoding="utf-8") as fh:
        rows = list(csv.reader(fh))
    assert rows[0][:2] == ["overall_friction_rank", "friction_rank_within_funnel"]
    ranks = [int(r[0]) for r in rows[1:]]
    assert ranks == sorted(ranks) and len(rows) == 10
    with open(glob.glob(paths["funnel_summary"] + "/*.csv")[0], newline="", encoding="utf-8") as fh:
        summary = list(csv.DictReader(fh))
    first = [r for r in summary if r["step_order"] == "1"]
    assert all(r["previous_step_count"] == "" for r in first)  # null as empty field
    with open(glob.glob(paths["category_performance"] + "/*.csv")[0], newline="", encoding="utf-8") as fh:
        cat = list(csv.DictReader(fh))
    assert {r["is_low_confidence_category"] for r in cat} <= {"true", "false"}
    views = [int(r["category_view_sessions"]) for r in cat]
    assert views == sorted(views, reverse=True)


def test_export_refuses_unknown_names(smoke_marts):
    import pytest

    from stepwise.sources.export import export_frame

    with pytest.raises(ValueError, match="no export order"):
        export_frame("stg_events", smoke_marts.stg_events)


def test_register_views(spark, smoke_marts):
    from stepwise.plans.catalog import register_views

    names = register_views(smoke_marts, ["funnel_summary", "revenue_leakage"])
    assert names == ["mart_funnel_summary", "mart_revenue_leakage"]
    n = spark.sql("SELECT count(*) AS n FROM mart_revenue_leakage WHERE step_order > 1").first().n
    assert n == 9


def test_command_line(spark, tmp_path, capsys):
    import json

    from stepwise.__main__ import main

    assert main(["run", "--fixture", SMOKE_DIR, "--export", str(tmp_path / "csv"), "--stage", str(tmp_path / "st")]) == 0
    paths = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert set(paths) == set(MART_NAMES)
    assert glob.glob(paths["data_quality_checks"] + "/*.csv")


def test_intermediate_layer_equals_lazy(spark, smoke_marts, tmp_path):
    from stepwise.plans.pipeline import INTERMEDIATE, stage_intermediate

    layered = stage_intermediate(smoke_marts, str(tmp_path / "int"))
    for name in INTERMEDIATE:
        assert glob.glob(str(tmp_path / "int" / name / "*.parquet"))
    for name in ["friction_score", "channel_device_performance", "data_quality_checks"]:
        a = sorted(tuple(r) for r in getattr(smoke_marts, name).collect())
        b = sorted(tuple(r) for r in getattr(layered, name).collect())
        assert a == b, name


def test_save_tables(spark, smoke_marts, tmp_path):
    from stepwise.plans.pipeline import save_tables

    out = save_tables(smoke_marts, "stepwise_test", ["stg_events", "friction_score"], str(tmp_path / "db"))
    assert out == {"stg_events": "stepwise_test.stg_events", "friction_score": "stepwise_test.mart_friction_score"}
    assert spark.table("stepwise_test.mart_friction_score").count() == 9
    assert spark.table("stepwise_test.stg_events").count() == 1000
    spark.sql("DROP DATABASE stepwise_test CASCADE")
