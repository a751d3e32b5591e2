"""DuckDB statements for every registered query.

They share no algorithm with the Spark build:

* staging comes straight from the flat mapping rules (no nested records, no
  key lookups);
* a funnel is read off per-key lists of step times: the earliest time of each
  list that is not before the time reached so far. A unit's *depth* is the
  number of steps it reached, and every count of every mart is a count of
  units by depth;
* channels, categories, tiers, labels and texts are rule tables, and the
  matching rule of the lowest number (or the highest bound) wins;
* a dense rank is one more than the number of different greater values;
* data-quality values are rows of (check, number) joined to a table of checks.

Money is summed in DECIMAL(38,10) and divided once, on both sides, so
averages do not depend on the order of the sum.
"""

from __future__ import annotations

# name -> (relations it reads, body)
RELATIONS: dict[str, tuple[list[str], str]] = {}


def relation(name: str, body: str, *reads: str) -> None:
    RELATIONS[name] = (list(reads), body)


def values(rows: list[tuple]) -> str:
    def literal(v) -> str:
        if v is None:
            return "NULL"
        return str(v) if isinstance(v, (int, float)) else "'" + str(v).replace("'", "''") + "'"

    return "VALUES " + ",\n       ".join("(" + ", ".join(map(literal, r)) + ")" for r in rows)


def table(name: str, columns: str, rows: list[tuple]) -> None:
    relation(name, f"SELECT * FROM ({values(rows)}) AS v({columns})")


# --------------------------------------------------------------------------
# Names, labels, bounds and texts that results must show.
# --------------------------------------------------------------------------
MAIN = ["view_item", "add_to_cart", "begin_checkout", "purchase"]
CHECKOUT = ["begin_checkout", "add_shipping_info", "add_payment_info", "purchase"]
KEY_EVENTS = ["view_item", "add_to_cart", "begin_checkout", "add_shipping_info", "add_payment_info", "purchase"]
WINDOW = ("20240108", "20240114")
BLANK = "[\\t-\\r\\x20\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]*"

table(
    "channel_rule",
    "nr, source, medium, channel",
    [
        (1, "google", "organic", "Google Organic"),
        (2, "google", "cpc", "Google CPC"),
        (3, "(direct)", "(none)", "Direct"),
        (4, None, "referral", "Referral"),
        (5, "(data deleted)", None, "Data Deleted / Unknown"),
        (6, None, "(data deleted)", "Data Deleted / Unknown"),
        (7, None, None, "Other"),
    ],
)
table(
    "category_rule",
    "nr, part, label",
    [
        (1, "apparel", "Apparel"),
        (2, "men", "Apparel"),
        (3, "women", "Apparel"),
        (4, "drinkware", "Drinkware"),
        (5, "bags", "Bags"),
        (6, "stationery", "Stationery"),
        (7, "sale", "Sale"),
    ],
)
table(
    "funnel_step",
    "funnel_type, unit_type, step_order, funnel_step",
    [
        (funnel, unit, i, step)
        for funnel, unit, steps in [
            ("User-Level Main Funnel", "Users", ["View Item", "Add to Cart", "Begin Checkout", "Purchase"]),
            ("Session-Level Main Funnel", "Sessions", ["View Item", "Add to Cart", "Begin Checkout", "Purchase"]),
            ("Checkout Friction Funnel", "Sessions", ["Begin Checkout", "Add Shipping Info", "Add Payment Info", "Purchase"]),
        ]
        for i, step in enumerate(steps, 1)
    ],
)
table(
    "status_label",
    "depth, final_funnel_status",
    [(1, "Dropped After Product View"), (2, "Dropped After Cart"), (3, "Dropped After Checkout"), (4, "Purchased")],
)
table("leakage_tier", "low, label", [(-1e300, "Low"), (100000, "Medium"), (500000, "High"), (1000000, "Very High")])
table("friction_tier", "low, label", [(-1e300, "Low"), (25, "Medium"), (50, "High"), (75, "Critical")])
table(
    "friction_text",
    "nr, part, issue, advice",
    [
        (1, "View Item → Add to Cart", "Product page / merchandising friction",
         "Review product detail pages, pricing, product relevance, and add-to-cart UX."),
        (2, "Add to Cart → Begin Checkout", "Cart-to-checkout friction",
         "Review cart page clarity, shipping expectations, discounts, and checkout CTA visibility."),
        (3, "Begin Checkout → Add Shipping Info", "Checkout start / shipping friction",
         "Review checkout start flow, login requirements, form friction, and shipping cost visibility."),
        (4, "Add Shipping Info → Add Payment Info", "Shipping-to-payment friction",
         "Review shipping options, delivery costs, and transition from shipping to payment."),
        (5, "Add Payment Info → Purchase", "Payment confirmation friction",
         "Review payment errors, payment method support, trust signals, and final confirmation UX."),
        (6, "Begin Checkout → Purchase", "Checkout completion friction",
         "Review end-to-end checkout completion barriers."),
        (7, "", "General funnel friction", "Investigate funnel step behavior and segment-level drivers."),
    ],
)
table(
    "quality_check",
    "check_name, check_area, wants_some, check_description",
    [
        ("reliable_categories_available", "category_performance", 1,
         "Category performance should include at least one reliable product category."),
        ("friction_scores_between_0_and_100", "friction_score", 0,
         "Friction scores should stay between 0 and 100 for dashboard interpretation."),
        ("funnel_counts_do_not_increase", "funnel_summary", 0,
         "Each funnel step should have less than or equal to the previous step count."),
        ("funnel_rates_between_0_and_1", "funnel_summary", 0,
         "Funnel conversion and drop-off rates should stay within valid percentage bounds."),
        ("estimated_leakage_not_negative", "revenue_leakage", 0,
         "Estimated revenue leakage should never be negative."),
        ("revenue_baseline_valid", "revenue_leakage", 0,
         "Revenue leakage requires positive transaction count, revenue, and average order value."),
        ("key_funnel_events_no_null_sessions", "staging", 0,
         "Key funnel events should have valid session keys for session-level analysis."),
        ("stg_events_not_empty", "staging", 1, "stg_events should contain event-level GA4 data."),
    ],
)
LOW_CONFIDENCE = ["Other", "Unknown", "Sale"]
HIGH_VOLUME = 1000


def _in(column: str, names: list[str]) -> str:
    return f"list_contains({names!r}, {column})"


# ------------------------------------------------------------- staging -----
relation(
    "mapped",
    """
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
                 (user_id + CAST(event_id % 10 = 0 AS INTEGER)) % 8 + 1 AS pair FROM events)
    SELECT event_id, user_id, ts, value, k, event_type = 'purchase' AS bought,
      strftime(ts, '%Y%m%d') AS day_text, epoch_us(ts) AS event_timestamp,
      coalesce(map {
        'view': 'view_item',
        'click': if(user_id % 7 = 0, 'page_view', 'add_to_cart'),
        'signup': if(user_id % 5 = 0, 'page_view', 'begin_checkout'),
        'purchase': if(user_id % 4 = 3, 'page_view', 'purchase'),
        'error': if(k % 2 = 0, 'add_shipping_info', 'add_payment_info')}[event_type], NULL) AS event_name,
      if(event_id % 103 = 0, NULL, user_id::VARCHAR) AS user_pseudo_id,
      if(event_id % 101 = 0, NULL, floor((ts::DATE - DATE '2024-01-01') / 7)::BIGINT) AS ga_session_id,
      'https://shop.example/user/' || user_id AS page_location,
      ['Desktop', 'mobile', 'Tablet'][user_id % 3 + 1] AS device,
      ['google', 'Google', '(direct)', 'shop.example', '(data deleted)', '<Other>', NULL, 'google'][pair] AS source,
      ['organic', 'CPC', '(none)', 'referral', '(data deleted)', '<Other>', NULL, NULL][pair] AS medium,
      if(bought AND event_id % 13 <> 0, 'T' || (event_id // 5), NULL) AS transaction_id,
      if(bought AND event_id % 11 <> 0, value, NULL) AS purchase_revenue
    """,
)
relation(
    "channel_of",
    """
    SELECT p.source, p.medium, arg_min(r.channel, r.nr) AS channel
    FROM (SELECT DISTINCT lower(source) AS source, lower(medium) AS medium FROM mapped) p, channel_rule r
    WHERE coalesce(r.source = p.source, r.source IS NULL) AND coalesce(r.medium = p.medium, r.medium IS NULL)
    GROUP BY ALL
    """,
    "mapped",
    "channel_rule",
)
relation(
    "stg_events",
    """
    SELECT ts::DATE AS event_date, ts::TIMESTAMP AS event_time, event_timestamp, event_name, user_pseudo_id,
      ga_session_id::BIGINT AS ga_session_id, user_pseudo_id || '-' || ga_session_id AS session_key, page_location,
      'WEB' AS platform, lower(device) AS device_category, lower(m.source) AS traffic_source,
      lower(m.medium) AS traffic_medium, '(fixture)' AS traffic_campaign, c.channel AS traffic_channel,
      transaction_id, purchase_revenue
    FROM mapped m JOIN channel_of c
      ON lower(m.source) IS NOT DISTINCT FROM c.source AND lower(m.medium) IS NOT DISTINCT FROM c.medium
    """,
    "mapped",
    "channel_of",
)
relation(
    "item_rows",
    """
    SELECT m.*, 'SKU-' || slot AS item_id, 'Item ' || slot AS item_name,
      ['Home/Apparel', 'Womens', 'Drinkware', 'Bags', 'Office/Stationery', 'Shop Sale', 'Writing Instruments',
       NULL, '  ', '(not set)'][slot + 1] AS item_category,
      if(event_id % 17 = 0, NULL, (1 + k % 3)::BIGINT) AS quantity,
      if(bought AND event_id % 7 <> 0, value * if(event_id % 17 = 0, NULL, 1 + k % 3), NULL) AS item_revenue
    FROM mapped m, (SELECT unnest(range(2)) AS nth) n, (SELECT unnest(range(10)) AS slot) s
    WHERE nth < k % 3 AND slot = (user_id + nth) % 10
    """,
    "mapped",
)
relation(
    "category_of",
    f"""
    SELECT raw, coalesce(arg_min(r.label, r.nr), if(raw IS NULL OR regexp_full_match(raw, '{BLANK}'), 'Unknown', 'Other')) AS label
    FROM (SELECT DISTINCT item_category AS raw FROM item_rows) c LEFT JOIN category_rule r ON contains(lower(raw), r.part)
    GROUP BY raw
    """,
    "item_rows",
    "category_rule",
)
relation(
    "stg_items",
    """
    SELECT ts::DATE AS event_date, ts::TIMESTAMP AS event_time, event_timestamp, event_name, user_pseudo_id,
      ga_session_id::BIGINT AS ga_session_id, user_pseudo_id || '-' || ga_session_id AS session_key,
      item_id, item_name, 'Shop' AS item_brand, item_category AS raw_item_category, value AS price, quantity,
      item_revenue, c.label AS cleaned_item_category
    FROM item_rows i JOIN category_of c ON i.item_category IS NOT DISTINCT FROM c.raw
    """,
    "item_rows",
    "category_of",
)


# ------------------------------------------------------------- funnels -----
def timeline(name: str, source: str, keys: list[str], steps: list[str]) -> None:
    """Times ``t1..`` of a unit's steps from its lists of step times, and its depth."""
    lists = ", ".join(f"list(event_time) FILTER (event_name = '{s}') AS l{i}" for i, s in enumerate(steps, 1))
    body = (
        f"SELECT {', '.join(keys)}, min(user_pseudo_id) FILTER (event_name = '{steps[0]}') AS owner, {lists} "
        f"FROM {source} WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys)} GROUP BY ALL"
    )
    body = f"SELECT *, list_min(l1) AS t1 FROM ({body}) WHERE l1 IS NOT NULL"
    for i in range(2, len(steps) + 1):
        body = f"SELECT *, list_min([x FOR x IN l{i} IF x >= t{i - 1}]) AS t{i} FROM ({body})"
    reached = " + ".join(f"(t{i} IS NOT NULL)::INTEGER" for i in range(1, len(steps) + 1))
    relation(name, f"SELECT *, {reached} AS depth FROM ({body})", source)


timeline("users", "stg_events", ["user_pseudo_id"], MAIN)
timeline("sessions", "stg_events", ["session_key"], MAIN)
timeline("checkouts", "stg_events", ["session_key"], CHECKOUT)
timeline("category_sessions", "stg_items", ["session_key", "cleaned_item_category"], MAIN)


def _times(steps: list[str]) -> str:
    return ", ".join(f"t{i} AS {s}_time" for i, s in enumerate(steps, 1))


def _flags(names: list[str]) -> str:
    return ", ".join(f"(depth >= {i})::INTEGER AS {n}" for i, n in enumerate(names, 1))


MAIN_FLAGS = ["viewed_item", "added_to_cart", "began_checkout", "purchased"]
CHECKOUT_FLAGS = ["began_checkout", "added_shipping_info", "added_payment_info", "purchased"]
for out, unit, ids in [
    ("user_funnel_steps", "users", "user_pseudo_id"),
    ("session_funnel_steps", "sessions", "session_key, owner AS user_pseudo_id"),
]:
    relation(
        out,
        f"SELECT {ids}, {_times(MAIN)}, {_flags(MAIN_FLAGS)}, date_sub('minute', t1, t4) AS minutes_from_view_to_purchase, "
        f"final_funnel_status FROM {unit} JOIN status_label USING (depth)",
        unit,
        "status_label",
    )
relation(
    "checkout_funnel_steps",
    f"SELECT session_key, owner AS user_pseudo_id, {_times(CHECKOUT)}, {_flags(CHECKOUT_FLAGS)} FROM checkouts",
    "checkouts",
)
relation(
    "category_session_funnel",
    f"SELECT session_key, owner AS user_pseudo_id, cleaned_item_category, {_flags(MAIN_FLAGS)} FROM category_sessions",
    "category_sessions",
)
relation(
    "user_funnel_status",
    "SELECT final_funnel_status, count(*) AS user_count FROM users JOIN status_label USING (depth) GROUP BY ALL",
    "users",
    "status_label",
)

# ------------------------------------------------------------- summary -----
relation(
    "reached",
    """
    SELECT f.*, sum(n)::BIGINT AS reached_count
    FROM funnel_step f LEFT JOIN (
      SELECT 'User-Level Main Funnel' AS funnel_type, depth, count(*) AS n FROM users GROUP BY ALL
      UNION ALL SELECT 'Session-Level Main Funnel', depth, count(*) FROM sessions GROUP BY ALL
      UNION ALL SELECT 'Checkout Friction Funnel', depth, count(*) FROM checkouts GROUP BY ALL
    ) d ON d.funnel_type = f.funnel_type AND d.depth >= f.step_order
    GROUP BY ALL
    """,
    "funnel_step",
    "users",
    "sessions",
    "checkouts",
)
relation(
    "transition",
    """
    SELECT a.*, b.funnel_step AS before, b.reached_count AS previous_step_count,
      if(b.step_order IS NULL, 1.0, a.reached_count::DOUBLE / nullif(b.reached_count, 0)) AS step_conversion_rate,
      a.reached_count::DOUBLE / nullif(c.reached_count, 0) AS overall_conversion_rate
    FROM reached a JOIN reached c ON c.funnel_type = a.funnel_type AND c.step_order = 1
    LEFT JOIN reached b ON b.funnel_type = a.funnel_type AND b.step_order + 1 = a.step_order
    """,
    "reached",
)
relation(
    "funnel_summary",
    """
    SELECT * EXCLUDE (before), if(before IS NULL, 0, previous_step_count - reached_count) AS dropoff_count,
      1 - step_conversion_rate AS dropoff_rate
    FROM transition
    """,
    "transition",
)
relation(
    "funnel_transitions",
    """
    SELECT s.* EXCLUDE (funnel_step), t.before AS previous_funnel_step, s.funnel_step AS current_funnel_step,
      t.before || ' → ' || s.funnel_step AS funnel_transition
    FROM funnel_summary s JOIN transition t USING (funnel_type, step_order)
    """,
    "funnel_summary",
    "transition",
)

# ------------------------------------------------------------- revenue -----
relation(
    "transaction_revenue",
    """
    SELECT transaction_id, list_max(list(purchase_revenue)) AS transaction_revenue
    FROM stg_events WHERE event_name = 'purchase' GROUP BY transaction_id
    HAVING transaction_id IS NOT NULL AND count(purchase_revenue) > 0
    """,
    "stg_events",
)
relation(
    "revenue_baseline",
    """
    FROM (SELECT count(*) AS unique_transactions, sum(transaction_revenue::DECIMAL(38,10))::DOUBLE AS total_purchase_revenue
          FROM transaction_revenue)
    SELECT *, total_purchase_revenue / nullif(unique_transactions, 0) AS average_order_value
    """,
    "transaction_revenue",
)


def _rank(value: str, source: str, within: str = "") -> str:
    """Dense rank, greatest first, nulls last."""
    own = f" AND o.{within} = s.{within}" if within else ""
    least = "'-infinity'::DOUBLE"
    return (
        f"1 + (SELECT count(DISTINCT coalesce(o.{value}, {least})) FROM {source} o "
        f"WHERE coalesce(o.{value}, {least}) > coalesce(s.{value}, {least}){own})"
    )


def leakage(prefix: str, tiers: str) -> None:
    """``<prefix>leaking`` and ``<prefix>revenue_leakage`` with the tiers of a table."""
    relation(
        f"{prefix}leaking",
        """
        SELECT *, dropoff_count * average_order_value AS estimated_revenue_leakage
        FROM funnel_transitions, revenue_baseline WHERE previous_funnel_step IS NOT NULL
        """,
        "funnel_transitions",
        "revenue_baseline",
    )
    source = f"{prefix}leaking"
    relation(
        f"{prefix}revenue_leakage",
        f"""
        SELECT s.*, {_rank('estimated_revenue_leakage', source, 'funnel_type')} AS leakage_rank_within_funnel,
          {_rank('estimated_revenue_leakage', source)} AS overall_leakage_rank,
          (SELECT arg_max(label, low) FROM {tiers} WHERE low <= coalesce(s.estimated_revenue_leakage, -1e300)) AS leakage_priority
        FROM {source} s
        """,
        source,
        tiers,
    )


leakage("", "leakage_tier")


def friction(prefix: str, tiers: str) -> None:
    source = f"{prefix}scored"
    relation(
        source,
        f"""
        FROM (SELECT *, estimated_revenue_leakage / nullif((SELECT max(estimated_revenue_leakage) FROM {prefix}leaking), 0)
                AS normalized_revenue_leakage FROM {prefix}leaking)
        SELECT * EXCLUDE (unique_transactions, total_purchase_revenue),
          round((0.65::DOUBLE * normalized_revenue_leakage + 0.35::DOUBLE * dropoff_rate) * 100, 2) AS friction_score
        """,
        f"{prefix}leaking",
    )
    relation(
        f"{prefix}friction_score",
        f"""
        SELECT s.*, {_rank('friction_score', source)} AS overall_friction_rank,
          {_rank('friction_score', source, 'funnel_type')} AS friction_rank_within_funnel,
          (SELECT arg_max(label, low) FROM {tiers} WHERE low <= coalesce(s.friction_score, -1e300)) AS friction_priority,
          t.issue AS likely_business_issue, t.advice AS recommended_investigation
        FROM {source} s JOIN friction_text t
          ON t.nr = (SELECT min(nr) FROM friction_text f WHERE contains(s.funnel_transition, f.part))
        """,
        source,
        tiers,
        "friction_text",
    )


friction("", "friction_tier")

# --------------------------------------------------------- performance -----
relation(
    "category_revenue",
    f"""
    SELECT cleaned_item_category,
      sum(coalesce(item_revenue, price * quantity, 0)::DECIMAL(38,10))::DOUBLE AS total_item_revenue,
      count(*) AS purchased_item_rows
    FROM stg_items WHERE event_name = '{MAIN[3]}' AND session_key IS NOT NULL AND cleaned_item_category IS NOT NULL
    GROUP BY ALL
    """,
    "stg_items",
)
SUMS = ["viewed_item_sessions", "added_to_cart_sessions", "began_checkout_sessions", "purchased_sessions"]
STEPS = ["view_to_cart", "cart_to_checkout", "checkout_to_purchase"]


def by_depth(sessions: str, users: str) -> str:
    """Sessions, users and the list ``s`` of sessions that reached each step."""
    reached = ", ".join(f"count(*) FILTER (depth >= {i})" for i in range(1, 5))
    return f"count(*) AS {sessions}, count(DISTINCT owner) AS {users}, [{reached}] AS s"


def spread() -> str:
    """The columns that the marts show of ``s``."""
    out = [f"s[{i}] AS {n}" for i, n in enumerate(SUMS, 1)]
    for i, n in enumerate(STEPS, 1):
        rate = f"s[{i + 1}]::DOUBLE / nullif(s[{i}], 0)"
        out += [f"{rate} AS {n}_rate", f"1 - {rate} AS {n}_dropoff_rate", f"s[{i}] - s[{i + 1}] AS {n}_dropoff_count"]
    return ", ".join([*out, "s[4]::DOUBLE / nullif(s[1], 0) AS view_to_purchase_rate"])


def category_performance(name: str, volume: int) -> None:
    relation(
        name,
        f"""
        SELECT c.* EXCLUDE (s), {spread()}, coalesce(r.total_item_revenue, 0) AS total_item_revenue,
          coalesce(r.purchased_item_rows, 0) AS purchased_item_rows,
          coalesce(r.total_item_revenue, 0) / nullif(s[4], 0) AS revenue_per_purchasing_session,
          s[1] >= {volume} AS is_high_volume_category,
          {_in('cleaned_item_category', LOW_CONFIDENCE)} AS is_low_confidence_category
        FROM (SELECT cleaned_item_category, {by_depth('category_view_sessions', 'category_view_users')}
              FROM category_sessions GROUP BY ALL) c LEFT JOIN category_revenue r USING (cleaned_item_category)
        """,
        "category_sessions",
        "category_revenue",
    )


category_performance("category_performance", HIGH_VOLUME)
relation(
    "session_segments",
    f"""
    SELECT session_key, seen[1].c AS traffic_channel, seen[1].d AS device_category
    FROM (SELECT session_key, list_sort(list({{'t': event_time, 'c': traffic_channel, 'd': device_category}})) AS seen
          FROM stg_events WHERE event_name = '{MAIN[0]}' AND session_key IS NOT NULL GROUP BY ALL)
    """,
    "stg_events",
)
relation(
    "channel_device_performance",
    f"""
    SELECT g.* EXCLUDE (s), {spread()}, s[1] >= {HIGH_VOLUME} AS is_high_volume_segment
    FROM (SELECT traffic_channel, device_category, {by_depth('sessions_entered_funnel', 'unique_users')}
          FROM sessions JOIN session_segments USING (session_key) GROUP BY ALL) g
    """,
    "sessions",
    "session_segments",
)

# ------------------------------------------------------------- quality -----
_BAD_RATE = "NOT coalesce({0} BETWEEN 0 AND 1, true)"
_MEASURES = [
    ("reliable_categories_available", "category_performance", "NOT is_low_confidence_category"),
    ("friction_scores_between_0_and_100", "friction_score", "NOT coalesce(friction_score BETWEEN 0 AND 100, false)"),
    ("funnel_counts_do_not_increase", "funnel_summary", "dropoff_count < 0"),
    (
        "funnel_rates_between_0_and_1",
        "funnel_summary",
        " OR ".join(_BAD_RATE.format(c) for c in ("step_conversion_rate", "overall_conversion_rate", "dropoff_rate")),
    ),
    ("estimated_leakage_not_negative", "revenue_leakage", "estimated_revenue_leakage < 0"),
    (
        "revenue_baseline_valid",
        "revenue_leakage",
        "coalesce(least(unique_transactions, total_purchase_revenue, average_order_value), 0) <= 0"
        " OR total_purchase_revenue IS NULL OR average_order_value IS NULL",
    ),
    ("key_funnel_events_no_null_sessions", "stg_events", f"session_key IS NULL AND {_in('event_name', KEY_EVENTS)}"),
    ("stg_events_not_empty", "stg_events", "true"),
]
relation(
    "data_quality_checks",
    """
    SELECT check_name, check_area, m.n AS check_value, if((m.n > 0) = (wants_some = 1), 'PASS', 'FAIL') AS check_status,
      check_description
    FROM quality_check JOIN (
    """
    + "\nUNION ALL ".join(f"SELECT '{name}' AS check_name, count(*) FILTER ({bad}) AS n FROM {source}" for name, source, bad in _MEASURES)
    + ") m USING (check_name)",
    "quality_check",
    "category_performance",
    "friction_score",
    "funnel_summary",
    "revenue_leakage",
    "stg_events",
)

# ------------------------------------------------------------- profile -----
relation("event_name_counts", "SELECT event_name, count(*) AS event_count FROM mapped GROUP BY ALL", "mapped")
relation(
    "windowed_events",
    f"""
    SELECT event_date, event_name, count(*) AS event_count, count(DISTINCT session_key) AS sessions
    FROM stg_events WHERE event_date BETWEEN strptime('{WINDOW[0]}', '%Y%m%d') AND strptime('{WINDOW[1]}', '%Y%m%d')
    GROUP BY ALL
    """,
    "stg_events",
)
RELATIONS["sharded_window"] = RELATIONS["windowed_events"]
relation(
    "dataset_profile",
    """
    SELECT min(ts)::DATE AS min_event_date, max(ts)::DATE AS max_event_date, count(*) AS total_events,
      len(list_distinct(list(user_pseudo_id))) AS total_users FROM mapped
    """,
    "mapped",
)
relation(
    "null_session_audit",
    f"""
    SELECT event_name, count(*) AS event_count, count(*) - count(ga_session_id) AS null_session_id_count,
      count(*) - count(session_key) AS null_session_key_count
    FROM stg_events WHERE {_in('event_name', KEY_EVENTS)} GROUP BY ALL
    """,
    "stg_events",
)
relation(
    "purchase_audit",
    """
    SELECT count(*) AS purchase_events, count(DISTINCT transaction_id) AS unique_transaction_ids,
      count(*) - count(transaction_id) AS purchases_without_transaction_id,
      count(purchase_revenue) AS purchases_with_revenue, count(*) - count(purchase_revenue) AS purchases_without_revenue
    FROM stg_events WHERE event_name = 'purchase'
    """,
    "stg_events",
)
for _name, _columns, _source, _count in [
    ("traffic_device_coverage", "traffic_source, traffic_medium, device_category", "stg_events", "event_count"),
    ("traffic_channels", "traffic_source, traffic_medium, traffic_channel", "stg_events", "event_count"),
    ("category_coverage", "raw_item_category, cleaned_item_category", "stg_items", "item_rows"),
]:
    relation(_name, f"SELECT {_columns}, count(*) AS {_count} FROM {_source} GROUP BY ALL", _source)
relation(
    "category_cleaning",
    "SELECT event_timestamp, session_key, item_id, raw_item_category, cleaned_item_category FROM stg_items",
    "stg_items",
)
relation(
    "event_param_lookup",
    "SELECT event_timestamp, event_name, user_pseudo_id, ga_session_id, session_key, page_location FROM stg_events",
    "stg_events",
)
relation(
    "event_field_sample",
    """
    SELECT day_text AS event_date, ts::TIMESTAMP AS event_time, event_name, user_pseudo_id, 'WEB' AS platform,
      device AS device_category, source AS traffic_source, medium AS traffic_medium, '(fixture)' AS traffic_campaign,
      transaction_id, purchase_revenue
    FROM mapped ORDER BY event_timestamp, event_name, user_pseudo_id LIMIT 100
    """,
    "mapped",
)
relation(
    "item_field_sample",
    """
    SELECT day_text AS event_date, ts::TIMESTAMP AS event_time, event_name, user_pseudo_id, item_id, item_name,
      item_category, value AS price, quantity, item_revenue
    FROM item_rows ORDER BY event_timestamp, item_id, event_name, user_pseudo_id LIMIT 100
    """,
    "item_rows",
)

# ------------------------------------- other bounds, so that every branch occurs
#: Parameters of the ``*_scaled`` queries.
SCALED_TIERS = [(9_500, "Very High"), (5_000, "High"), (1_300, "Medium")]
SCALED_VOLUME = 104
table("scaled_tier", "low, label", [(-1e300, "Low"), *SCALED_TIERS])
leakage("scaled_", "scaled_tier")
category_performance("scaled_category_performance", SCALED_VOLUME)


RELATIONS["export_marts"] = RELATIONS["category_performance"]
RELATIONS["view_friction_score"] = RELATIONS["friction_score"]
RELATIONS["view_data_quality_checks"] = RELATIONS["data_quality_checks"]
relation(
    "reloaded_days",
    """
    SELECT event_date, count(*) AS event_count, len(list_distinct(list(user_pseudo_id))) AS users,
      len(list_distinct(list(session_key))) AS sessions, count(*) FILTER (event_name = 'purchase') AS purchase_events,
      sum(purchase_revenue::DECIMAL(38,10))::DOUBLE AS purchase_revenue
    FROM stg_events GROUP BY ALL
    """,
    "stg_events",
)

RELATIONS["colocated_channel_device"] = RELATIONS["channel_device_performance"]
RELATIONS["colocated_category"] = RELATIONS["category_performance"]
RELATIONS["observed_quality_checks"] = RELATIONS["data_quality_checks"]
RELATIONS["merged_baseline"] = RELATIONS["revenue_baseline"]
relation(
    "merged_distinct",
    """
    SELECT date_trunc('week', event_date)::DATE AS week, count(DISTINCT event_date) AS days, count(*) AS event_count,
      count(DISTINCT user_pseudo_id) AS users, count(DISTINCT session_key) AS sessions,
      true AS users_near, true AS sessions_near
    FROM stg_events GROUP BY ALL
    """,
    "stg_events",
)
relation(
    "windows_report",
    """
    SELECT w.name AS "window", event_name, count(*) AS event_count, count(DISTINCT session_key) AS sessions
    FROM stg_events, (SELECT min(event_date) AS lo, max(event_date) AS hi FROM stg_events) e,
      (VALUES ('first week'), ('last week')) w(name)
    WHERE if(w.name = 'first week', event_date < e.lo + 7, event_date > e.hi - 7)
    GROUP BY ALL
    """,
    "stg_events",
)

# ------------------------------------------------------------- exports -----
#: The header line and the order of each exported file.
_FUNNEL = "funnel_type unit_type step_order"
_MOVE = f"{_FUNNEL} previous_funnel_step current_funnel_step funnel_transition previous_step_count reached_count dropoff_count dropoff_rate step_conversion_rate overall_conversion_rate"
_SHARES = "view_to_cart_rate cart_to_checkout_rate checkout_to_purchase_rate view_to_purchase_rate view_to_cart_dropoff_count cart_to_checkout_dropoff_count checkout_to_purchase_dropoff_count view_to_cart_dropoff_rate cart_to_checkout_dropoff_rate checkout_to_purchase_dropoff_rate"
EXPORTS = {
    "funnel_summary": (
        f"{_FUNNEL} funnel_step reached_count previous_step_count step_conversion_rate overall_conversion_rate dropoff_count dropoff_rate",
        "funnel_type, step_order",
    ),
    "channel_device_performance": (
        f"traffic_channel device_category sessions_entered_funnel unique_users {' '.join(SUMS)} {_SHARES} is_high_volume_segment",
        "sessions_entered_funnel DESC, traffic_channel, device_category",
    ),
    "category_performance": (
        f"cleaned_item_category category_view_sessions category_view_users {' '.join(SUMS)} {_SHARES} total_item_revenue purchased_item_rows revenue_per_purchasing_session is_high_volume_category is_low_confidence_category",
        "category_view_sessions DESC, cleaned_item_category",
    ),
    "revenue_leakage": (
        f"{_MOVE} unique_transactions total_purchase_revenue average_order_value estimated_revenue_leakage leakage_rank_within_funnel overall_leakage_rank leakage_priority",
        "overall_leakage_rank, funnel_type",
    ),
    "friction_score": (
        f"overall_friction_rank friction_rank_within_funnel {_MOVE} average_order_value estimated_revenue_leakage normalized_revenue_leakage friction_score friction_priority likely_business_issue recommended_investigation",
        "overall_friction_rank, funnel_type",
    ),
    "data_quality_checks": ("check_name check_area check_value check_status check_description", "check_area, check_name"),
}


def _cells(mart: str, header: str, order: str) -> str:
    """One row per value of a file."""
    numbered = f"(SELECT *, row_number() OVER (ORDER BY {order}) AS row_number FROM {mart})"
    textual = "typeof({0}) IN ('VARCHAR', 'BOOLEAN')"
    return "\nUNION ALL ".join(
        f"SELECT '{mart}' AS mart, row_number, {i} AS position, '{c}' AS column_name, "
        f"if({textual.format(c)}, {c}::VARCHAR, NULL) AS text_value, "
        f"if({textual.format(c)}, NULL, try_cast({c} AS DOUBLE)) AS number_value FROM {numbered}"
        for i, c in enumerate(header.split(), 1)
    )


relation("export_cells", "\nUNION ALL ".join(_cells(m, *spec) for m, spec in EXPORTS.items()), *EXPORTS)


def sql_for(target: str) -> str:
    needed: dict[str, None] = {}

    def need(name: str) -> None:
        if name not in needed:
            for other in RELATIONS[name][0]:
                need(other)
            needed[name] = None

    need(target)
    body = ",\n".join(f"{n} AS ({RELATIONS[n][1].strip()})" for n in needed)
    return f"WITH {body}\nSELECT * FROM {target}"


def oracle_sql(names: list[str]) -> dict[str, str]:
    return {n: sql_for(n) for n in names if n in RELATIONS}
