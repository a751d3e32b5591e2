"""Column expressions used by staging and the marts.

Everything is a built-in Spark expression (JVM side, no Python workers).
Rule lists whose values must equal the original study's are kept together
under "Fixed values" comments, in their original order: the CASE chains are
first-match-wins, so the order is part of the semantics.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --------------------------------------------------------------------------
# Traffic channel rules, first match wins.
#   (source, medium) both required          -> label
#   medium only / source-or-medium           -> label
# --------------------------------------------------------------------------
CHANNEL_SOURCE_MEDIUM = [
    ("google", "organic", "Google Organic"),
    ("google", "cpc", "Google CPC"),
    ("(direct)", "(none)", "Direct"),
]
CHANNEL_REFERRAL_MEDIUM = ("referral", "Referral")
CHANNEL_DELETED = ("(data deleted)", "Data Deleted / Unknown")
CHANNEL_DEFAULT = "Other"

# --------------------------------------------------------------------------
# Product category rules on lower-cased text, first match wins.
# --------------------------------------------------------------------------
CATEGORY_RULES = [
    (["%apparel%", "%men%", "%women%"], "Apparel"),
    (["%drinkware%"], "Drinkware"),
    (["%bags%"], "Bags"),
    (["%stationery%"], "Stationery"),
    (["%sale%"], "Sale"),
]
CATEGORY_BLANK = "Unknown"
CATEGORY_DEFAULT = "Other"
LOW_CONFIDENCE_CATEGORIES = ["Other", "Unknown", "Sale"]

# --------------------------------------------------------------------------
# Furthest-stage labels of the user funnel.
# --------------------------------------------------------------------------
STATUS_PURCHASED = "Purchased"
STATUS_CHECKOUT = "Dropped After Checkout"
STATUS_CART = "Dropped After Cart"
STATUS_VIEW = "Dropped After Product View"

# --------------------------------------------------------------------------
# Priority tiers (inclusive lower bounds, checked top-down).
# --------------------------------------------------------------------------
LEAKAGE_TIERS = [(1_000_000, "Very High"), (500_000, "High"), (100_000, "Medium")]
LEAKAGE_TIER_DEFAULT = "Low"
FRICTION_TIERS = [(75, "Critical"), (50, "High"), (25, "Medium")]
FRICTION_TIER_DEFAULT = "Low"

# --------------------------------------------------------------------------
# Friction interpretation, matched as LIKE '%<transition>%'.
# (transition, likely_business_issue, recommended_investigation)
# --------------------------------------------------------------------------
ARROW = " → "
FRICTION_RULES = [
    (
        "View Item → Add to Cart",
        "Product page / merchandising friction",
        "Review product detail pages, pricing, product relevance, and add-to-cart UX.",
    ),
    (
        "Add to Cart → Begin Checkout",
        "Cart-to-checkout friction",
        "Review cart page clarity, shipping expectations, discounts, and checkout CTA visibility.",
    ),
    (
        "Begin Checkout → Add Shipping Info",
        "Checkout start / shipping friction",
        "Review checkout start flow, login requirements, form friction, and shipping cost visibility.",
    ),
    (
        "Add Shipping Info → Add Payment Info",
        "Shipping-to-payment friction",
        "Review shipping options, delivery costs, and transition from shipping to payment.",
    ),
    (
        "Add Payment Info → Purchase",
        "Payment confirmation friction",
        "Review payment errors, payment method support, trust signals, and final confirmation UX.",
    ),
    (
        "Begin Checkout → Purchase",
        "Checkout completion friction",
        "Review end-to-end checkout completion barriers.",
    ),
]
FRICTION_DEFAULT_ISSUE = "General funnel friction"
FRICTION_DEFAULT_RECOMMENDATION = "Investigate funnel step behavior and segment-level drivers."

# Weights of the friction score and the volume threshold.
LEAKAGE_WEIGHT = 0.65
DROPOFF_WEIGHT = 0.35
HIGH_VOLUME_SESSIONS = 1000


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- params ---
def param_value(params: str | Column, key: str, field: str) -> Column:
    """First ``value.<field>`` of the entry with ``key`` in a key/value list.

    ``filter`` + ``get(.., 0)``: null when the key is absent (``[0]`` would
    raise under ANSI), first occurrence when the key repeats.
    """
    hit = F.get(F.filter(_col(params), lambda p: p["key"] == F.lit(key)), 0)
    return hit["value"][field]


def param_int(params: str | Column, key: str) -> Column:
    return param_value(params, key, "int_value")


def param_str(params: str | Column, key: str) -> Column:
    return param_value(params, key, "string_value")


def session_key(user: str | Column, session_id: str | Column) -> Column:
    """``user || '-' || session_id``; null when either part is null
    (``concat`` propagates nulls, unlike ``concat_ws``)."""
    return F.concat(_col(user), F.lit("-"), _col(session_id).cast("string"))


# ---------------------------------------------------------------- labels ---
def traffic_channel(source: str | Column, medium: str | Column) -> Column:
    """Channel of lower-cased source/medium. Null inputs fall to ``Other``
    unless the other side matches a rule."""
    s, m = _col(source), _col(medium)
    expr = None
    for src, med, label in CHANNEL_SOURCE_MEDIUM:
        cond = (s == src) & (m == med)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    ref_med, ref_label = CHANNEL_REFERRAL_MEDIUM
    expr = expr.when(m == ref_med, ref_label)
    deleted, deleted_label = CHANNEL_DELETED
    expr = expr.when((s == deleted) | (m == deleted), deleted_label)
    return expr.otherwise(CHANNEL_DEFAULT)


def is_blank(text: str | Column) -> Column:
    """``TRIM(x) = ''`` where trimming strips all Unicode white space (Spark's
    ``trim`` strips only spaces, and a plain ``\\s`` knows only ASCII)."""
    return _col(text).rlike(r"(?U)^\s*$")


def clean_category(raw: str | Column) -> Column:
    r = _col(raw)
    low = F.lower(r)
    expr = None
    for patterns, label in CATEGORY_RULES:
        cond = None
        for p in patterns:
            c = low.like(p)
            cond = c if cond is None else (cond | c)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    expr = expr.when(r.isNull() | is_blank(r), CATEGORY_BLANK)
    return expr.otherwise(CATEGORY_DEFAULT)


def funnel_status(cart: Column, checkout: Column, purchase: Column) -> Column:
    return (
        F.when(purchase.isNotNull(), STATUS_PURCHASED)
        .when(checkout.isNotNull(), STATUS_CHECKOUT)
        .when(cart.isNotNull(), STATUS_CART)
        .otherwise(STATUS_VIEW)
    )


def tier(value: str | Column, tiers: list[tuple[float, str]], default: str) -> Column:
    v = _col(value)
    expr = None
    for bound, label in tiers:
        expr = F.when(v >= bound, label) if expr is None else expr.when(v >= bound, label)
    return expr.otherwise(default)


def leakage_priority(value: str | Column) -> Column:
    return tier(value, LEAKAGE_TIERS, LEAKAGE_TIER_DEFAULT)


def friction_priority(value: str | Column) -> Column:
    return tier(value, FRICTION_TIERS, FRICTION_TIER_DEFAULT)


def _rule_text(transition: str | Column, pick: int, default: str) -> Column:
    t = _col(transition)
    expr = None
    for rule in FRICTION_RULES:
        cond = t.contains(rule[0])
        expr = F.when(cond, rule[pick]) if expr is None else expr.when(cond, rule[pick])
    return expr.otherwise(default)


def likely_business_issue(transition: str | Column) -> Column:
    return _rule_text(transition, 1, FRICTION_DEFAULT_ISSUE)


def recommended_investigation(transition: str | Column) -> Column:
    return _rule_text(transition, 2, FRICTION_DEFAULT_RECOMMENDATION)


# ------------------------------------------------------------ arithmetic ---
def safe_divide(num: str | Column, den: str | Column) -> Column:
    """Double result; null when the divisor is 0 or either side is null."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def exact_sum(value: str | Column) -> Column:
    """Money sum that does not depend on row order: accumulate in
    decimal(38,10), return double."""
    return F.sum(_col(value).cast("decimal(38,10)")).cast("double")


def flag(ts: str | Column) -> Column:
    """1 when the step was reached (time not null), else 0."""
    return F.when(_col(ts).isNotNull(), F.lit(1)).otherwise(F.lit(0))
