"""The model as persistent catalog views, each defined over the ones before it.

``create_views`` runs one ``CREATE OR REPLACE VIEW`` per layer in dependency
order. A view names the views that it reads, so replacing one (another window,
another raw table) changes every mart above it at its next read, and nothing is
materialised: a query on a mart is one plan down to the scan of the raw table.

The statements are Spark SQL. Rules (labels, bounds, texts) come from the lists in
``functions.columns``, so views and DataFrame layers can't drift apart; a test
compares their rows layer by layer. Funnels are folded from transition tables, as
in ``operators.transitions``: a funnel scans its source once.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

from stepwise.functions import columns as C
from stepwise.operators.transitions import RANGES
from stepwise.plans import performance, quality, revenue, summary
from stepwise.plans.funnels import CHECKOUT_FLAGS, CHECKOUT_STEPS, MAIN_FLAGS, MAIN_STEPS
from stepwise.plans.profile import KEY_FUNNEL_EVENTS

RAW = "raw_events"
#: Every view in dependency order, with the layer of ``Marts`` whose rows it has.
LAYERS = {
    "stg_events": "stg_events",
    "stg_items": "stg_items",
    "int_user_funnel_steps": "user_funnel_steps",
    "int_session_funnel_steps": "session_funnel_steps",
    "int_checkout_funnel_steps": "checkout_funnel_steps",
    "int_category_session_funnel": "category_session_funnel",
    "mart_funnel_summary": "funnel_summary",
    "mart_channel_device_performance": "channel_device_performance",
    "mart_category_performance": "category_performance",
    "mart_revenue_leakage": "revenue_leakage",
    "mart_friction_score": "friction_score",
    "data_quality_checks": "data_quality_checks",
}


def text(value) -> str:
    """A SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case(rules: list[tuple[str, str]], default: str) -> str:
    return "CASE " + " ".join(f"WHEN {cond} THEN {text(label)}" for cond, label in rules) + f" ELSE {text(default)} END"


def _channel(source: str, medium: str) -> str:
    rules = [(f"{source} = {text(s)} AND {medium} = {text(m)}", label) for s, m, label in C.CHANNEL_SOURCE_MEDIUM]
    referral, label = C.CHANNEL_REFERRAL_MEDIUM
    rules.append((f"{medium} = {text(referral)}", label))
    deleted, label = C.CHANNEL_DELETED
    rules.append((f"{source} = {text(deleted)} OR {medium} = {text(deleted)}", label))
    return _case(rules, C.CHANNEL_DEFAULT)


def _category(raw: str) -> str:
    rules = [(" OR ".join(f"lower({raw}) LIKE {text(p)}" for p in parts), label) for parts, label in C.CATEGORY_RULES]
    rules.append((rf"{raw} IS NULL OR {raw} RLIKE '(?U)^\\s*$'", C.CATEGORY_BLANK))
    return _case(rules, C.CATEGORY_DEFAULT)


def _tier(value: str, tiers: list, default: str) -> str:
    return _case([(f"{value} >= {bound}", label) for bound, label in tiers], default)


def _divided(a: str, b: str) -> str:
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def _exact_sum(value: str) -> str:
    return f"CAST(sum(CAST({value} AS DECIMAL(38,10))) AS DOUBLE)"


def _param(key: str, field: str) -> str:
    return f"get(filter(event_params, p -> p.key = {text(key)}), 0).value.{field}"


def _staged(window: tuple[str, str] | None, raw: str) -> str:
    where = f" WHERE event_date BETWEEN {text(window[0])} AND {text(window[1])}" if window else ""
    session = _param("ga_session_id", "int_value")
    return f"(SELECT *, {session} AS ga_session_id FROM {raw}{where})"


_HEADER = """to_date(event_date, 'yyyyMMdd') AS event_date, timestamp_micros(event_timestamp) AS event_time,
  event_timestamp, event_name, user_pseudo_id, ga_session_id,
  concat(user_pseudo_id, '-', CAST(ga_session_id AS STRING)) AS session_key"""


def _events(window: tuple[str, str] | None, raw: str) -> str:
    source, medium = "lower(traffic_source.source)", "lower(traffic_source.medium)"
    return f"""SELECT {_HEADER},
  {_param("page_location", "string_value")} AS page_location, platform, lower(device.category) AS device_category,
  {source} AS traffic_source, {medium} AS traffic_medium, lower(traffic_source.name) AS traffic_campaign,
  {_channel(source, medium)} AS traffic_channel,
  ecommerce.transaction_id AS transaction_id, ecommerce.purchase_revenue AS purchase_revenue
FROM {_staged(window, raw)}"""


def _items(window: tuple[str, str] | None, raw: str) -> str:
    return f"""SELECT {_HEADER},
  item.item_id, item.item_name, item.item_brand, item.item_category AS raw_item_category, item.price, item.quantity,
  item.item_revenue, {_category("item.item_category")} AS cleaned_item_category
FROM {_staged(window, raw)} LATERAL VIEW explode(items) AS item"""


def _funnel(source: str, keys: list[str], steps: list[str], shown: list[str]) -> str:
    """``shown`` columns of an ordered funnel; step times are ``t0``, ``t1``, ..."""
    key, n = ", ".join(keys), len(steps)
    names = ", ".join(map(text, steps))
    none = "CAST(array() AS ARRAY<TIMESTAMP>)"
    known = " AND ".join(f"{k} IS NOT NULL" for k in [*keys, "event_time"])
    in_steps = ", ".join(f"named_struct('nr', {i}, 'times', collect_list(CASE WHEN step = {i} THEN at END))" for i in range(n))
    times = ", ".join(f"get(done, {i}) AS t{i}" for i in range(n))
    return f"""WITH met AS (
  SELECT {key}, floor(unix_micros(event_time) / {RANGES[0] * 1_000_000}) AS span,
    array_position(array({names}), event_name) - 1 AS step, min(event_time) AS at
  FROM {source} WHERE event_name IN ({names}) AND {known}
  GROUP BY {key}, span, step, CASE WHEN event_name <> {text(steps[0])} THEN event_time END
), tables AS (
  SELECT {key}, span, transform(sequence(0, {n}), i -> aggregate(in_steps, {none},
    (done, s) -> CASE WHEN s.nr = i + size(done) THEN concat(done, array_compact(array(array_min(
      filter(s.times, t -> size(done) = 0 OR t >= element_at(done, -1)))))) ELSE done END)) AS runs
  FROM (SELECT {key}, span, array({in_steps}) AS in_steps FROM met GROUP BY {key}, span)
), folded AS (
  SELECT {key}, aggregate(sort_array(collect_list(struct(span, runs))), {none},
    (done, one) -> concat(done, get(one.runs, size(done)))) AS done
  FROM tables GROUP BY {key} HAVING bool_or(size(get(runs, 0)) > 0)
)
SELECT {key}, {", ".join(shown)} FROM (SELECT {key}, {times} FROM folded)"""


def _main_shown(steps: list[str]) -> list[str]:
    status = _case(
        [("t3 IS NOT NULL", C.STATUS_PURCHASED), ("t2 IS NOT NULL", C.STATUS_CHECKOUT), ("t1 IS NOT NULL", C.STATUS_CART)],
        C.STATUS_VIEW,
    )
    return [
        *[f"t{i} AS {s}_time" for i, s in enumerate(steps)],
        *_flags(MAIN_FLAGS),
        "CASE WHEN t3 IS NOT NULL THEN timestampdiff(MINUTE, t0, t3) END AS minutes_from_view_to_purchase",
        f"{status} AS final_funnel_status",
    ]


def _flags(names: list[str]) -> list[str]:
    # Every unit of a funnel has done the first step.
    return [f"1 AS {names[0]}", *[f"CASE WHEN t{i} IS NOT NULL THEN 1 ELSE 0 END AS {n}" for i, n in enumerate(names) if i]]


def _summary() -> str:
    def counts(view: str, funnel: str, unit: str, flags: list[str], labels: list[str]) -> str:
        sums = ", ".join(f"sum({f}) AS s{i}" for i, f in enumerate(flags))
        rows = ", ".join(f"named_struct('step_order', {i + 1}, 'funnel_step', {text(x)}, 'reached_count', s{i})" for i, x in enumerate(labels))
        return f"SELECT {text(funnel)} AS funnel_type, {text(unit)} AS unit_type, inline(array({rows})) FROM (SELECT {sums} FROM {view})"

    parts = [
        counts("int_user_funnel_steps", summary.USER_FUNNEL, "Users", MAIN_FLAGS, summary.MAIN_LABELS),
        counts("int_session_funnel_steps", summary.SESSION_FUNNEL, "Sessions", MAIN_FLAGS, summary.MAIN_LABELS),
        counts("int_checkout_funnel_steps", summary.CHECKOUT_FUNNEL, "Sessions", CHECKOUT_FLAGS, summary.CHECKOUT_LABELS),
    ]
    rate = _divided("reached_count", "previous_step_count")
    return f"""WITH counts AS ({" UNION ALL ".join(parts)}), beside AS (
  SELECT *, lag(reached_count) OVER steps AS previous_step_count, first(reached_count) OVER steps AS first_count
  FROM counts WINDOW steps AS (PARTITION BY funnel_type ORDER BY step_order)
)
SELECT funnel_type, unit_type, step_order, funnel_step, reached_count, previous_step_count,
  CASE WHEN step_order = 1 THEN 1.0D ELSE {rate} END AS step_conversion_rate,
  {_divided("reached_count", "first_count")} AS overall_conversion_rate,
  CASE WHEN step_order = 1 THEN 0L ELSE previous_step_count - reached_count END AS dropoff_count,
  CASE WHEN step_order = 1 THEN 0.0D ELSE 1 - {rate} END AS dropoff_rate
FROM beside"""


def _step_sums() -> str:
    return ", ".join(f"sum({f}) AS {n}" for f, n in zip(MAIN_FLAGS, performance.STEP_SUMS))


def _rates() -> str:
    """The rate columns of the two performance marts."""
    s, names = performance.STEP_SUMS, performance.TRANSITIONS
    shown = [f"{_divided(s[i + 1], s[i])} AS {names[i]}_rate" for i in range(3)]
    shown.append(f"{_divided(s[3], s[0])} AS view_to_purchase_rate")
    shown += [f"{s[i]} - {s[i + 1]} AS {names[i]}_dropoff_count" for i in range(3)]
    shown += [f"1 - {_divided(s[i + 1], s[i])} AS {names[i]}_dropoff_rate" for i in range(3)]
    return ", ".join(shown)


def _channel_device() -> str:
    return f"""WITH firsts AS (
  SELECT session_key, min(struct(event_time, traffic_channel, device_category)) AS first
  FROM stg_events WHERE event_name = {text(MAIN_STEPS[0])} AND session_key IS NOT NULL GROUP BY session_key
), segments AS (
  SELECT first.traffic_channel, first.device_category, count(*) AS sessions_entered_funnel,
    count(DISTINCT user_pseudo_id) AS unique_users, {_step_sums()}
  FROM int_session_funnel_steps JOIN firsts USING (session_key) GROUP BY ALL
)
SELECT traffic_channel, device_category, sessions_entered_funnel, unique_users, {", ".join(performance.STEP_SUMS)}, {_rates()},
  {performance.STEP_SUMS[0]} >= {C.HIGH_VOLUME_SESSIONS} AS is_high_volume_segment
FROM segments"""


def _category_mart() -> str:
    low = ", ".join(map(text, C.LOW_CONFIDENCE_CATEGORIES))
    return f"""WITH sums AS (
  SELECT cleaned_item_category, count(*) AS category_view_sessions, count(DISTINCT user_pseudo_id) AS category_view_users,
    {_step_sums()}
  FROM int_category_session_funnel GROUP BY cleaned_item_category
), revenue AS (
  SELECT cleaned_item_category, {_exact_sum("coalesce(item_revenue, price * quantity, 0.0D)")} AS revenue, count(*) AS item_rows
  FROM stg_items
  WHERE event_name = 'purchase' AND session_key IS NOT NULL AND cleaned_item_category IS NOT NULL
  GROUP BY cleaned_item_category
)
SELECT cleaned_item_category, category_view_sessions, category_view_users, {", ".join(performance.STEP_SUMS)}, {_rates()},
  coalesce(revenue, 0.0D) AS total_item_revenue, coalesce(item_rows, 0L) AS purchased_item_rows,
  {_divided("coalesce(revenue, 0.0D)", performance.STEP_SUMS[3])} AS revenue_per_purchasing_session,
  {performance.STEP_SUMS[0]} >= {C.HIGH_VOLUME_SESSIONS} AS is_high_volume_category,
  cleaned_item_category IN ({low}) AS is_low_confidence_category
FROM sums LEFT JOIN revenue USING (cleaned_item_category)"""


def _leakage() -> str:
    value = "estimated_revenue_leakage"
    rank = f"CAST(dense_rank() OVER ({{}}ORDER BY {value} DESC NULLS LAST) AS BIGINT)"
    return f"""WITH orders AS (
  SELECT max(purchase_revenue) AS revenue FROM stg_events
  WHERE event_name = 'purchase' AND transaction_id IS NOT NULL AND purchase_revenue IS NOT NULL GROUP BY transaction_id
), baseline AS (
  SELECT count(*) AS unique_transactions, {_exact_sum("revenue")} AS total_purchase_revenue,
    {_divided(_exact_sum("revenue"), "count(*)")} AS average_order_value
  FROM orders
), named AS (
  SELECT *, lag(funnel_step) OVER (PARTITION BY funnel_type ORDER BY step_order) AS previous_funnel_step
  FROM mart_funnel_summary
), leaks AS (
  SELECT *, funnel_step AS current_funnel_step, concat(previous_funnel_step, {text(C.ARROW)}, funnel_step) AS funnel_transition,
    (SELECT struct(*) FROM baseline) AS base
  FROM named WHERE step_order > 1
), valued AS (
  SELECT *, base.*, dropoff_count * base.average_order_value AS {value} FROM leaks
)
SELECT {", ".join(revenue.LEAKAGE_COLUMNS[:16])},
  {rank.format("PARTITION BY funnel_type ")} AS leakage_rank_within_funnel, {rank.format("")} AS overall_leakage_rank,
  {_tier(value, C.LEAKAGE_TIERS, C.LEAKAGE_TIER_DEFAULT)} AS leakage_priority
FROM valued"""


def _friction() -> str:
    def advice(pick: int, default: str) -> str:
        return _case([(f"contains(funnel_transition, {text(r[0])})", r[pick]) for r in C.FRICTION_RULES], default)

    rank = "CAST(dense_rank() OVER ({}ORDER BY friction_score DESC NULLS LAST) AS BIGINT)"
    return f"""WITH shares AS (
  SELECT *, {_divided("estimated_revenue_leakage", "max(estimated_revenue_leakage) OVER ()")} AS normalized_revenue_leakage
  FROM mart_revenue_leakage
), scored AS (
  SELECT *, round(({C.LEAKAGE_WEIGHT}D * normalized_revenue_leakage + {C.DROPOFF_WEIGHT}D * dropoff_rate) * 100, 2) AS friction_score
  FROM shares
)
SELECT {", ".join(revenue.FRICTION_COLUMNS[:16])},
  {rank.format("")} AS overall_friction_rank, {rank.format("PARTITION BY funnel_type ")} AS friction_rank_within_funnel,
  {_tier("friction_score", C.FRICTION_TIERS, C.FRICTION_TIER_DEFAULT)} AS friction_priority,
  {advice(1, C.FRICTION_DEFAULT_ISSUE)} AS likely_business_issue,
  {advice(2, C.FRICTION_DEFAULT_RECOMMENDATION)} AS recommended_investigation
FROM scored"""


def _quality() -> str:
    key_events = ", ".join(map(text, KEY_FUNNEL_EVENTS))
    outside = " OR ".join(f"coalesce({c} < 0 OR {c} > 1, false)" for c in ("step_conversion_rate", "overall_conversion_rate", "dropoff_rate"))
    missing = " OR ".join(f"{c} IS NULL OR {c} <= 0" for c in ("unique_transactions", "total_purchase_revenue", "average_order_value"))
    found = [
        ("reliable_categories_available", "mart_category_performance", "count_if(NOT is_low_confidence_category)", True),
        (
            "friction_scores_between_0_and_100",
            "mart_friction_score",
            "count_if(friction_score IS NULL OR coalesce(friction_score < 0 OR friction_score > 100, false))",
            False,
        ),
        (
            "funnel_counts_do_not_increase",
            "mart_funnel_summary",
            "count_if(step_order > 1 AND coalesce(reached_count > previous_step_count, false))",
            False,
        ),
        ("funnel_rates_between_0_and_1", "mart_funnel_summary", f"count_if({outside})", False),
        ("estimated_leakage_not_negative", "mart_revenue_leakage", "count_if(coalesce(estimated_revenue_leakage < 0, false))", False),
        ("revenue_baseline_valid", "mart_revenue_leakage", f"count_if({missing})", False),
        (
            "key_funnel_events_no_null_sessions",
            "stg_events",
            f"count_if(event_name IN ({key_events}) AND session_key IS NULL)",
            False,
        ),
        ("stg_events_not_empty", "stg_events", "count(*)", True),
    ]
    parts = []
    for name, view, value, some in found:
        area, description = quality.CHECKS[name]
        parts.append(
            f"SELECT {text(name)} AS check_name, {text(area)} AS check_area, value AS check_value, "
            f"CASE WHEN value {'> 0' if some else '= 0'} THEN {text(quality.PASS)} ELSE {text(quality.FAIL)} END AS check_status, "
            f"{text(description)} AS check_description FROM (SELECT coalesce({value}, 0L) AS value FROM {view})"
        )
    return " UNION ALL ".join(parts)


def definitions(window: tuple[str, str] | None = None, raw: str = RAW) -> dict[str, str]:
    """View name -> statement, in dependency order."""
    session = ["session_key", "user_pseudo_id"]
    checkout = [*[f"t{i} AS {s}_time" for i, s in enumerate(CHECKOUT_STEPS)], *_flags(CHECKOUT_FLAGS)]
    return {
        "stg_events": _events(window, raw),
        "stg_items": _items(window, raw),
        "int_user_funnel_steps": _funnel("stg_events", ["user_pseudo_id"], MAIN_STEPS, _main_shown(MAIN_STEPS)),
        "int_session_funnel_steps": _funnel("stg_events", session, MAIN_STEPS, _main_shown(MAIN_STEPS)),
        "int_checkout_funnel_steps": _funnel("stg_events", session, CHECKOUT_STEPS, checkout),
        "int_category_session_funnel": _funnel(
            "stg_items", [*session, "cleaned_item_category"], MAIN_STEPS, _flags(MAIN_FLAGS)
        ),
        "mart_funnel_summary": _summary(),
        "mart_channel_device_performance": _channel_device(),
        "mart_category_performance": _category_mart(),
        "mart_revenue_leakage": _leakage(),
        "mart_friction_score": _friction(),
        "data_quality_checks": _quality(),
    }


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def statements(database: str, window: tuple[str, str] | None = None, raw: str = RAW) -> Iterator[str]:
    """The ``CREATE OR REPLACE VIEW`` statements of a database, in order. Inside
    them other views are named with the database, so they can be read from any."""
    names = [raw, *LAYERS]
    for view, body in definitions(window, raw).items():
        for name in names:
            for before in ("FROM ", "JOIN "):
                for after in (" ", ")", "\n"):
                    body = (body + "\n").replace(f"{before}{name}{after}", f"{before}{quoted(database)}.{name}{after}")[:-1]
        yield f"CREATE OR REPLACE VIEW {quoted(database)}.{view} AS\n{body}"


def create_views(
    spark: SparkSession, database: str, window: tuple[str, str] | None = None, raw: str = RAW, only: list[str] | None = None
) -> list[str]:
    """Create or replace the views of ``database`` over its table ``raw``; ``only``
    some of them (those above keep their definitions and read the new ones)."""
    done = []
    for view, statement in zip(LAYERS, statements(database, window, raw)):
        if only is None or view in only:
            spark.sql(statement)
            done.append(f"{database}.{view}")
    return done


def create_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """``location``: the folder of its tables (on a cluster, a shared one)."""
    where = f" LOCATION {text(location)}" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}{where}")


def save_raw(raw: DataFrame, database: str, table: str = RAW) -> None:
    """The raw records as a table of ``database``, partitioned by day."""
    raw.write.mode("overwrite").partitionBy("event_date").format("parquet").saveAsTable(f"{quoted(database)}.{table}")
