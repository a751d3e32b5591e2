"""Hand-made raw event rows (nested schema) for operator tests."""

from __future__ import annotations

import datetime as dt

from stepwise.sources.schema import EVENT_SCHEMA

EPOCH = dt.datetime(2020, 11, 1, tzinfo=dt.timezone.utc)


def micros(minutes: float) -> int:
    """Epoch microseconds of 2020-11-01 00:00 UTC + ``minutes``."""
    return int((EPOCH.timestamp() + minutes * 60) * 1_000_000)


def event(
    name: str,
    minute: float,
    user: str | None = "u1",
    session: int | None = 1,
    *,
    date: str = "20201101",
    params: list | None = None,
    source: str | None = "google",
    medium: str | None = "organic",
    device: str | None = "desktop",
    transaction: str | None = None,
    revenue: float | None = None,
    items: list | None = None,
) -> tuple:
    if params is None:
        params = [("page_location", ("https://x/p", None))]
        if session is not None:
            params.append(("ga_session_id", (None, session)))
    return (
        date,
        micros(minute),
        name,
        user,
        params,
        "WEB",
        (device,),
        (source, medium, "(camp)"),
        (transaction, revenue) if (transaction is not None or revenue is not None) else None,
        items,
    )


def item(category: str | None, price: float = 10.0, quantity: int | None = 1, revenue: float | None = None, item_id: str = "i1"):
    return (item_id, "name", "brand", category, price, quantity, revenue)


def raw_df(spark, rows: list[tuple]):
    return spark.createDataFrame(rows, EVENT_SCHEMA)
