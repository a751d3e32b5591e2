"""Catalog views: every view has its layer's rows, views are read through one
another, and replacing a lower one changes the marts above it."""

from __future__ import annotations

import math

import pytest

from stepwise.plans import views
from stepwise.plans.catalog import Marts, fixture_marts
from stepwise.sources.fixture import load_raw
from tests.conftest import SMOKE_DIR
from tests.test_plans import plan

WEEK = ("20240108", "20240114")


@pytest.fixture(scope="module")
def database(spark, tmp_path_factory):
    name = "views_of_the_model"
    views.create_database(spark, name, str(tmp_path_factory.mktemp("views")))
    views.save_raw(load_raw(spark, SMOKE_DIR), name)
    assert views.create_views(spark, name) == [f"{name}.{v}" for v in views.LAYERS]
    return name


def rows(df, columns):
    def plain(v):
        return float(f"{v:.12g}") if isinstance(v, float) and not math.isnan(v) else v

    return sorted((tuple(map(plain, r)) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("view", list(views.LAYERS))
def test_a_view_has_its_layer_s_rows(spark, smoke_marts, database, view):
    layer = getattr(smoke_marts, views.LAYERS[view])
    got = spark.table(f"{database}.{view}")
    assert got.columns == layer.columns
    assert [t for _, t in got.dtypes] == [t for _, t in layer.dtypes]
    assert rows(got, layer.columns) == rows(layer, layer.columns)


def test_views_are_in_the_catalog_and_can_be_read_from_any_database(spark, database):
    listed = {t.name: t for t in spark.catalog.listTables(database)}
    assert set(listed) == {views.RAW, *views.LAYERS}
    assert all(listed[v].tableType == "VIEW" and not listed[v].isTemporary for v in views.LAYERS)
    assert spark.catalog.currentDatabase() == "default"
    assert spark.sql(f"SELECT count(*) AS n FROM {database}.mart_friction_score").first().n == 9


def test_replacing_a_lower_view_changes_the_marts_above(spark, database):
    whole = rows(spark.table(f"{database}.mart_funnel_summary"), ["*"])
    try:
        assert views.create_views(spark, database, WEEK, only=["stg_events"]) == [f"{database}.stg_events"]
        week = Marts(load_raw(spark, SMOKE_DIR), WEEK).funnel_summary
        got = spark.table(f"{database}.mart_funnel_summary")
        assert rows(got, week.columns) == rows(week, week.columns) != whole
    finally:
        views.create_views(spark, database)
    assert rows(spark.table(f"{database}.mart_funnel_summary"), ["*"]) == whole


def test_a_mart_reads_only_the_days_of_its_window(spark, database):
    views.create_views(spark, database, WEEK)
    try:
        p = plan(spark.table(f"{database}.mart_channel_device_performance"))
        assert "PartitionFilters: [isnotnull(event_date" in p and WEEK[0] in p
        assert "Python" not in p
    finally:
        views.create_views(spark, database)


def test_queries(spark):
    from stepwise.plans.catalog import queries

    want = fixture_marts(spark, SMOKE_DIR).friction_score
    got = queries()["view_friction_score"](spark, SMOKE_DIR)
    assert rows(got, want.columns) == rows(want, want.columns)


def test_texts_with_quotes_are_literals(spark):
    for value in ("it's", "a\\b", "", None, 3, 2.5):
        assert spark.sql(f"SELECT {views.text(value)} AS x").first().x == value
