"""SQL twins of the registered queries, for checking results on the same Parquet tables in another engine.

They are written the plain way (one aggregate per window, global window functions, pair sorting) on purpose: the
point is an independent statement of the result, not of the plan.
"""

from __future__ import annotations

from staywise import config

ORACLES: dict[str, str] = {}

AS_OF = "2024-01-31"
LABEL_DATE = "2023-11-02"

CUSTOMERS = f"""
customers AS (
  SELECT *, CAST(floor(date_diff('day', signup_date, DATE '{AS_OF}') / 30e0) AS INTEGER) AS customer_tenure_months
  FROM (
    SELECT 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS customer_id,
           c_name AS customer_name,
           CASE WHEN c_custkey % 50 <> 0 THEN CAST(18 + (c_custkey * 7) % 62 AS INTEGER) END AS age,
           CASE c_nationkey % 3 WHEN 0 THEN 'metro' WHEN 1 THEN 'suburban' ELSE 'rural' END AS city_type,
           CAST(DATE '2020-01-01' + CAST((c_custkey * 13) % 1480 AS INTEGER) AS DATE) AS signup_date,
           CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'premium' WHEN 'MACHINERY' THEN 'enterprise' ELSE 'basic' END
             AS subscription_tier
    FROM customer))"""

# The same table with the tenure as of the label date.
CUSTOMERS_THEN = CUSTOMERS.replace(
    f"date_diff('day', signup_date, DATE '{AS_OF}')", f"date_diff('day', signup_date, DATE '{LABEL_DATE}')"
)

TRANSACTIONS = """
tx AS (
  SELECT 'C' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS customer_id,
         CAST(CAST(o_orderdate AS DATE) + 8218 AS DATE) AS transaction_date,
         CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(0.01 AS DECIMAL(3,2)) AS transaction_amount,
         p_type AS product_category
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""

EVENTS = """
ev AS (
  SELECT event_id, ts, customer_id, event_date, event_type, value, k,
         CASE WHEN event_type = 'feature_usage' THEN 'f' || CAST(k % 12 AS VARCHAR) END AS feature_name,
         CASE WHEN event_type = 'content_view' THEN CAST(value AS DECIMAL(12,2)) END AS duration_minutes,
         CASE WHEN event_type = 'content_view' THEN k END AS content_id
  FROM (
    SELECT event_id, ts, value, k,
           'C' || lpad(CAST(user_id AS VARCHAR), 9, '0') AS customer_id,
           CAST(CAST(ts AS DATE) - CAST((event_id % 4) * 30 AS INTEGER) AS DATE) AS event_date,
           CASE WHEN event_type = 'click' THEN 'login' WHEN event_type = 'view' THEN 'content_view'
                WHEN event_type = 'purchase' THEN 'feature_usage'
                WHEN event_type = 'error' THEN CASE WHEN k % 2 = 0 THEN 'support_ticket' ELSE 'support_resolution' END
                WHEN event_type = 'signup' THEN CASE WHEN k % 2 = 0 THEN 'forum_post' ELSE 'review_submission' END
           END AS event_type
    FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)))"""

LOG = """
log AS (
  SELECT event_id AS request_id, customer_id, ts, value AS response_ms, k % 3 = 0 AS cache_hit,
         event_type IN ('support_ticket', 'support_resolution') AS error
  FROM ev)"""

INTAKE = """
intake AS (
  SELECT CASE WHEN c_custkey % 97 <> 0 THEN 'C' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') END AS customer_id,
         CAST(c_custkey % 45 AS DOUBLE) AS recency_30d, CAST(c_custkey % 9 AS DOUBLE) AS frequency_30d,
         c_acctbal AS monetary_total_30d,
         CASE WHEN c_custkey % 31 <> 0 THEN abs(c_acctbal) END AS monetary_avg_30d,
         CAST(c_custkey % 120 AS DOUBLE) / 100e0 AS engagement_score,
         CAST(c_custkey % 60 - 1 AS INTEGER) AS customer_tenure_months,
         CAST(c_custkey % 12 AS INTEGER) AS support_tickets_30d,
         CASE WHEN c_custkey % 50 <> 0 THEN CAST((c_custkey * 7) % 95 + 10 AS INTEGER) END AS age,
         CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'premium' WHEN 'MACHINERY' THEN 'high_value'
              WHEN 'BUILDING' THEN 'low_value' ELSE 'medium' END AS value_tier
  FROM customer)"""


def rfm(name: str, as_of: str, windows) -> str:
    """Left join of one aggregate per window."""
    columns, joins = [], []
    for w in windows:
        lower = f"DATE '{as_of}' - {w}"
        half = f"DATE '{as_of}' - {w // 2}"
        joins.append(f"""
  LEFT JOIN (
    SELECT customer_id, CAST(date_diff('day', max(transaction_date), DATE '{as_of}') AS INTEGER) AS recency_{w}d,
           count(*) AS frequency_{w}d,
           CAST(sum(transaction_amount) AS DOUBLE) AS monetary_total_{w}d,
           CAST(sum(transaction_amount) AS DOUBLE) / count(transaction_amount) AS monetary_avg_{w}d,
           count(DISTINCT product_category) AS category_diversity_{w}d,
           stddev_samp(transaction_amount) AS spending_variance_{w}d,
           CAST(count(*) AS DOUBLE) / {w} AS purchase_frequency_{w}d,
           CAST(sum(CASE WHEN transaction_date >= {half} THEN transaction_amount ELSE 0 END) AS DOUBLE)
             AS recent_spending_{w}d
    FROM tx WHERE transaction_date >= {lower} AND transaction_date <= DATE '{as_of}' GROUP BY customer_id
  ) t{w} ON t{w}.customer_id = c.customer_id""")
        columns += [
            f"{c}_{w}d"
            for c in (
                "recency", "frequency", "monetary_total", "monetary_avg", "category_diversity",
                "spending_variance", "purchase_frequency", "recent_spending",
            )
        ]
    return f"{name} AS (SELECT c.*, {', '.join(columns)} FROM customers c {' '.join(joins)})"


def engaged(name: str, source: str, as_of: str, windows) -> str:
    """Left join of one engagement aggregate per window to ``source``."""
    columns, joins = [], []
    for w in windows:
        counts = {
            "login_count": "login", "feature_usage": "feature_usage", "support_tickets": "support_ticket",
            "support_resolved": "support_resolution", "forum_posts": "forum_post", "reviews": "review_submission",
        }
        parts = [
            f"CAST(sum(CASE WHEN event_type = '{e}' THEN 1 ELSE 0 END) AS BIGINT) AS {c}_{w}d"
            for c, e in counts.items()
        ]
        parts += [
            f"count(DISTINCT CASE WHEN event_type = 'login' THEN event_date END) AS active_days_{w}d",
            f"count(DISTINCT CASE WHEN event_type = 'feature_usage' THEN feature_name END) AS features_used_{w}d",
            f"CAST(sum(CASE WHEN event_type = 'content_view' THEN duration_minutes ELSE 0 END) AS DOUBLE)"
            f" AS content_minutes_{w}d",
            f"count(DISTINCT CASE WHEN event_type = 'content_view' THEN content_id END) AS unique_content_{w}d",
        ]
        joins.append(f"""
  LEFT JOIN (
    SELECT customer_id, {', '.join(parts)}
    FROM ev WHERE event_date >= DATE '{as_of}' - {w} AND event_date <= DATE '{as_of}' GROUP BY customer_id
  ) e{w} ON e{w}.customer_id = s.customer_id""")
        columns += [
            f"{c}_{w}d"
            for c in (
                "login_count", "active_days", "feature_usage", "features_used", "support_tickets",
                "support_resolved", "forum_posts", "reviews", "content_minutes", "unique_content",
            )
        ]
    return f"{name} AS (SELECT s.*, {', '.join(columns)} FROM {source} s {' '.join(joins)})"


def with_score(name: str, source: str) -> str:
    """Components and weighted score; 30-day engagement columns count as 0 when missing."""
    f = lambda c: f"CAST(coalesce({c}, 0) AS DOUBLE)"
    return f"""
{name} AS (
  SELECT *, CASE WHEN engagement_score = 0 THEN 'unknown'
                 WHEN (engagement_score - engagement_score * 0.9e0) / (engagement_score * 0.9e0) > 0.1e0
                   THEN 'improving'
                 WHEN (engagement_score - engagement_score * 0.9e0) / (engagement_score * 0.9e0) < -0.1e0
                   THEN 'declining' ELSE 'stable' END AS engagement_trend_30_90
  FROM (
    SELECT *, login_engagement * 0.3e0 + feature_engagement * 0.25e0 + support_engagement * 0.2e0
              + community_engagement * 0.15e0 + content_engagement * 0.1e0 AS engagement_score
    FROM (
      SELECT *, least({f('login_count_30d')} / 30e0, 1e0) AS login_engagement,
             least({f('features_used_30d')} / 10e0, 1e0) AS feature_engagement,
             CASE WHEN coalesce(support_tickets_30d, 0) > 0
                  THEN least({f('support_resolved_30d')} / {f('support_tickets_30d')}, 1e0) ELSE 0.5e0 END
               AS support_engagement,
             least(({f('forum_posts_30d')} + {f('reviews_30d')}) / 5e0, 1e0) AS community_engagement,
             least({f('content_minutes_30d')} / 300e0, 1e0) AS content_engagement
      FROM {source})))"""


def clv(variant: str = "standard") -> str:
    revenue, aov = "CAST(monetary_total_365d AS DOUBLE)", "CAST(monetary_avg_90d AS DOUBLE)"
    frequency, tenure = "purchase_frequency_90d", "CAST(customer_tenure_months AS DOUBLE)"
    if variant == "standard":
        return f"""CASE WHEN coalesce({revenue}, 0) = 0 OR coalesce({tenure}, 0) = 0 THEN 0e0 ELSE
            {revenue} / greatest({tenure}, 1e0) * least({tenure} * 1.2e0, 60e0)
            * least(coalesce({frequency}, 0e0) * 2, 3e0)
            * CASE WHEN {aov} > 500 THEN 1.5e0 WHEN {aov} > 200 THEN 1.2e0 WHEN {aov} > 50 THEN 1e0 ELSE 0.8e0 END END"""
    return f"""CASE WHEN {tenure} = 0 THEN 0e0
        WHEN {tenure} IS NULL OR {revenue} IS NULL OR {frequency} IS NULL THEN NULL ELSE
        {revenue} / {tenure} * least({tenure} * 1.2e0, 60e0) * least({frequency} * 2, 3e0)
        * CASE WHEN {aov} > 500 THEN 1.5e0 WHEN {aov} > 200 THEN 1.2e0 WHEN {aov} < 50 THEN 0.8e0 ELSE 1e0 END END"""


def risk(recency: str) -> str:
    money, tickets = "CAST(coalesce(monetary_total_30d, 0) AS DOUBLE)", "coalesce(support_tickets_30d, 0)"
    often = "coalesce(purchase_frequency_30d, 0e0)"
    return f"""least(
        CASE WHEN {recency} > 90 THEN 0.3e0 WHEN {recency} > 60 THEN 0.2e0 WHEN {recency} > 30 THEN 0.1e0 ELSE 0e0 END
        + CASE WHEN {often} <> 0 AND {often} < 0.1e0 THEN 0.25e0 WHEN {often} <> 0 AND {often} < 0.2e0 THEN 0.15e0
               ELSE 0e0 END
        + CASE WHEN {money} <> 0 AND {money} < 100 THEN 0.2e0 ELSE 0e0 END
        + CASE WHEN engagement_score <> 0 AND engagement_score < 0.3e0 THEN 0.15e0 ELSE 0e0 END
        + CASE WHEN {tickets} > 10 THEN 0.1e0 ELSE 0e0 END, 1e0)"""


def trend(current: str, previous: str) -> str:
    return f"""CASE WHEN coalesce({current}, 0) = 0 OR coalesce({previous}, 0) = 0 THEN 'unknown'
        WHEN ({current} - {previous}) / {previous} > 0.1e0 THEN 'improving'
        WHEN ({current} - {previous}) / {previous} < -0.1e0 THEN 'declining' ELSE 'stable' END"""


SEGMENT = (
    "CASE "
    + " ".join(f"WHEN rfm_score >= {floor} THEN '{label}'" for floor, label in config.SEGMENT_FLOORS)
    + f" ELSE '{config.DEFAULT_SEGMENT}' END"
)
VALUE_TIER = (
    "CASE "
    + " ".join(f"WHEN monetary_total_365d > {floor} THEN '{label}'" for floor, label in config.VALUE_TIER_FLOORS)
    + f" ELSE '{config.VALUE_TIER_DEFAULT}' END"
)


def with_rfm_scores(name: str, source: str) -> str:
    return f"""
{name} AS (
  SELECT *, {SEGMENT} AS customer_segment
  FROM (
    SELECT *, recency_score * 100 + frequency_score * 10 + monetary_score AS rfm_score
    FROM (
      SELECT *, CAST(6 - ntile(5) OVER (ORDER BY recency_30d NULLS FIRST, customer_id) AS INTEGER) AS recency_score,
             CAST(ntile(5) OVER (ORDER BY frequency_30d NULLS FIRST, customer_id) AS INTEGER) AS frequency_score,
             CAST(ntile(5) OVER (ORDER BY monetary_total_30d NULLS FIRST, customer_id) AS INTEGER) AS monetary_score
      FROM {source})))"""


def scoring(as_of: str = AS_OF) -> str:
    """CTEs up to ``inputs``: one scoring request per customer with its formula probability."""
    customers = CUSTOMERS if as_of == AS_OF else CUSTOMERS_THEN
    return ",".join(
        [
            customers,
            TRANSACTIONS,
            EVENTS,
            rfm("base", as_of, (30, 365)),
            engaged("active", "base", as_of, (30,)),
            with_score("scored", "active"),
            f"""
inputs AS (
  SELECT *, least(greatest((recency_30d / 100e0) * 0.3e0 + (1e0 / (frequency_30d + 1e0)) * 0.3e0
                           + (1e0 - engagement_score) * 0.4e0, 0e0), 1e0) AS probability
  FROM (
    SELECT customer_id, CAST(coalesce(recency_365d, 0) AS DOUBLE) AS recency_30d,
           CAST(coalesce(frequency_30d, 0) AS DOUBLE) AS frequency_30d,
           CAST(coalesce(monetary_total_30d, 0) AS DOUBLE) AS monetary_total_30d,
           CAST(coalesce(monetary_avg_30d, 0) AS DOUBLE) AS monetary_avg_30d, engagement_score,
           coalesce(customer_tenure_months, 0) AS customer_tenure_months,
           coalesce(support_tickets_30d, 0) AS support_tickets_30d, coalesce(age, 35) AS age,
           {VALUE_TIER} AS value_tier, city_type, subscription_tier, signup_date
    FROM scored))""",
        ]
    )


LABELLED = (
    scoring(LABEL_DATE)
    + f""",
bought AS (
  SELECT DISTINCT customer_id FROM tx
  WHERE transaction_date > DATE '{LABEL_DATE}' AND transaction_date <= DATE '{LABEL_DATE}' + 90),
labelled AS (
  SELECT i.*, CASE WHEN b.customer_id IS NULL THEN 1 ELSE 0 END AS label,
         CASE WHEN probability > 0.5e0 THEN 1 ELSE 0 END AS prediction,
         CASE WHEN substr(md5(i.customer_id || '42'), 1, 8) < 'b3333333' THEN 'train'
              WHEN substr(md5(i.customer_id || '42'), 1, 8) < 'cccccccc' THEN 'val' ELSE 'test' END AS split
  FROM inputs i LEFT JOIN bought b ON b.customer_id = i.customer_id)"""
)

CANDIDATES = (
    LABELLED
    + """,
rows_of AS (
  SELECT model, customer_id, split, label, probability, CASE WHEN probability > 0.5e0 THEN 1 ELSE 0 END AS prediction
  FROM (
    SELECT 'blend' AS model, customer_id, split, label, probability FROM labelled
    UNION ALL SELECT 'recency', customer_id, split, label, least(recency_30d / 365e0, 1e0) FROM labelled
    UNION ALL SELECT 'frequency', customer_id, split, label, 1e0 / (frequency_30d + 1e0) FROM labelled
    UNION ALL SELECT 'engagement', customer_id, split, label, 1e0 - engagement_score FROM labelled))"""
)


def cells(source: str, group: str) -> str:
    return f"""
cells AS (
  SELECT {group}, count(*) FILTER (label = 0 AND prediction = 0) AS tn,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 1 AND prediction = 1) AS tp
  FROM {source} GROUP BY {group})"""


def ratio(part: str, whole: str) -> str:
    return f"CASE WHEN ({whole}) = 0 THEN 0e0 ELSE CAST(({part}) AS DOUBLE) / CAST(({whole}) AS DOUBLE) END"


POSITIVE = (ratio("tp", "tp + fp"), ratio("tp", "tp + fn"), ratio("2 * tp", "2 * tp + fp + fn"))
NEGATIVE = (ratio("tn", "tn + fn"), ratio("tn", "tn + fp"), ratio("2 * tn", "2 * tn + fn + fp"))


def auc(source: str, group: str) -> str:
    """Rank-sum form: average rank of the positives."""
    return f"""
auc_of AS (
  SELECT {group}, CASE WHEN min(pos) = 0 OR min(neg) = 0 THEN NULL ELSE
         CAST(sum(CAST(p AS HUGEINT) * (2 * upto - n)) AS DOUBLE) / (2e0 * CAST(min(pos) AS DOUBLE) * CAST(min(neg) AS DOUBLE)) END AS auc
  FROM (
    SELECT {group}, p, n, sum(n) OVER (PARTITION BY {group} ORDER BY probability) AS upto,
           sum(p) OVER (PARTITION BY {group}) AS pos, sum(n) OVER (PARTITION BY {group}) AS neg
    FROM (SELECT {group}, probability, count(*) FILTER (label = 1) AS p, count(*) FILTER (label <> 1) AS n
          FROM {source} GROUP BY {group}, probability))
  GROUP BY {group})"""


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


# ---- inputs and scalar functions -------------------------------------------------------------------------

ORACLES["customers_adapter"] = _with(
    CUSTOMERS,
    select="""SELECT customer_id, customer_name, age, city_type, strftime(signup_date, '%Y-%m-%d') AS signup_date,
    subscription_tier, customer_tenure_months FROM customers""",
)
ORACLES["customer_trend"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    rfm("base", AS_OF, (30, 90)),
    select=f"""SELECT customer_id, purchase_frequency_30d AS current_value, purchase_frequency_90d AS previous_value,
    {trend('purchase_frequency_30d', 'purchase_frequency_90d')} AS trend FROM base""",
)
for _name, _variant in (("clv_scores", "standard"), ("clv_scores_v2", "simple")):
    ORACLES[_name] = _with(
        CUSTOMERS,
        TRANSACTIONS,
        rfm("base", AS_OF, (90, 365)),
        select=f"SELECT customer_id, {clv(_variant)} AS predicted_clv FROM base",
    )
ORACLES["sql_functions"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    EVENTS,
    rfm("base", AS_OF, (30, 90, 365)),
    engaged("active", "base", AS_OF, (30,)),
    with_score("scored", "active"),
    select=f"""SELECT customer_id, {clv()} AS predicted_clv, {risk('recency_365d')} AS churn_risk_score,
    CASE WHEN coalesce(purchase_frequency_30d, 0) = 0 THEN 'unknown' ELSE
    {trend('purchase_frequency_30d', 'purchase_frequency_90d')} END AS trend FROM scored""",
)
ORACLES["snapshot_features"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    EVENTS,
    f"""
totals AS (
  SELECT customer_id, max(transaction_date) AS last_purchase_date,
         count(*) FILTER (transaction_date >= DATE '{AS_OF}' - 30 AND transaction_date <= DATE '{AS_OF}') AS p30,
         count(*) FILTER (transaction_date >= DATE '{AS_OF}' - 90 AND transaction_date <= DATE '{AS_OF}') AS p90,
         count(*) AS orders, CAST(sum(transaction_amount) AS DOUBLE) AS revenue,
         CAST(coalesce(sum(transaction_amount) FILTER (transaction_date >= DATE '{AS_OF}' - 30
              AND transaction_date <= DATE '{AS_OF}'), 0) AS DOUBLE) AS r30,
         CAST(coalesce(sum(transaction_amount) FILTER (transaction_date >= DATE '{AS_OF}' - 60
              AND transaction_date <= DATE '{AS_OF}'), 0) AS DOUBLE) AS r60
  FROM tx GROUP BY customer_id)""",
    engaged("active", "customers", AS_OF, (30,)),
    """
snapshot AS (
  SELECT a.customer_id, t.*, support_tickets_30d AS tickets,
         least(coalesce(login_count_30d, 0) / 30e0, 1e0) AS login,
         least(coalesce(support_resolved_30d, 0) / 10e0, 1e0) AS support,
         least(coalesce(feature_usage_30d, 0) / 10e0, 1e0) AS usage,
         least(coalesce(forum_posts_30d + reviews_30d, 0) / 5e0, 1e0) AS community
  FROM active a LEFT JOIN totals t ON t.customer_id = a.customer_id)""",
    select=f"""SELECT customer_id, CAST(date_diff('day', last_purchase_date, DATE '{AS_OF}') AS INTEGER) AS recency_days,
    CAST(p30 AS DOUBLE) / 30e0 AS purchase_frequency_30d, CAST(p90 AS DOUBLE) / 90e0 AS purchase_frequency_90d,
    CASE WHEN orders IS NOT NULL THEN revenue / greatest(CAST(orders AS DOUBLE), 1e0) END AS avg_order_value,
    CASE WHEN orders IS NOT NULL THEN (r30 - r60) / greatest(r60, 1e0) END AS revenue_trend, engagement_score,
    (date_diff('day', last_purchase_date, DATE '{AS_OF}') > 60) AND engagement_score < 0.3e0 AND tickets > 5
      AS high_risk_churn
    FROM (SELECT *, login * 0.3e0 + support * 0.2e0 + usage * 0.3e0 + community * 0.2e0 AS engagement_score
          FROM snapshot)""",
)

# ---- windowed features -----------------------------------------------------------------------------------

_RFM_ALL = (CUSTOMERS, TRANSACTIONS, rfm("base", AS_OF, config.TRANSACTION_WINDOWS))
_RFM_NAMES = ("recency", "frequency", "monetary_total", "monetary_avg", "purchase_frequency", "recent_spending")
ORACLES["rfm_windows"] = _with(
    *_RFM_ALL,
    select="SELECT customer_id, "
    + ", ".join(
        ", ".join([f"{c}_{w}d" for c in _RFM_NAMES] + [f"round(spending_variance_{w}d, 4) AS spending_variance_{w}d"])
        for w in config.TRANSACTION_WINDOWS
    )
    + " FROM base",
)
ORACLES["rfm_distinct"] = _with(
    *_RFM_ALL,
    select="SELECT customer_id, "
    + ", ".join(f"category_diversity_{w}d" for w in config.TRANSACTION_WINDOWS)
    + " FROM base",
)
_ENGAGED_ALL = (CUSTOMERS, EVENTS, engaged("active", "customers", AS_OF, config.ENGAGEMENT_WINDOWS))
_DISTINCT = ("active_days", "features_used", "unique_content")
_COUNTED = (
    "login_count", "feature_usage", "support_tickets", "support_resolved", "forum_posts", "reviews", "content_minutes",
)
for _name, _columns in (("engagement_windows", _COUNTED), ("engagement_distinct", _DISTINCT)):
    ORACLES[_name] = _with(
        *_ENGAGED_ALL,
        select="SELECT customer_id, "
        + ", ".join(f"{c}_{w}d" for w in config.ENGAGEMENT_WINDOWS for c in _columns)
        + " FROM active",
    )
_SCORED_30 = (CUSTOMERS, TRANSACTIONS, rfm("base", AS_OF, (30,)), with_rfm_scores("ranked", "base"))
ORACLES["rfm_scores"] = _with(
    *_SCORED_30,
    select="SELECT customer_id, recency_score, frequency_score, monetary_score, rfm_score, customer_segment FROM ranked",
)
ORACLES["customer_segments"] = _with(
    *_SCORED_30,
    select="""SELECT customer_segment, count(*) AS customers,
    round(CAST(sum(CAST(monetary_total_30d AS DECIMAL(18,4))) AS DOUBLE), 2) AS spend_30d,
    min(rfm_score) AS lowest_score, max(rfm_score) AS highest_score FROM ranked GROUP BY customer_segment""",
)

# ---- derived features ------------------------------------------------------------------------------------

_ENGAGED_30 = (CUSTOMERS, EVENTS, engaged("active", "customers", AS_OF, (30,)), with_score("scored", "active"))
ORACLES["engagement_scores"] = _with(
    *_ENGAGED_30,
    select=f"""SELECT customer_id, {', '.join(config.ENGAGEMENT_WEIGHTS)}, engagement_score, engagement_trend_30_90
    FROM scored""",
)
ORACLES["risk_and_health"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    EVENTS,
    rfm("base", AS_OF, (30,)),
    engaged("active", "base", AS_OF, (30,)),
    with_score("scored", "active"),
    select=f"""SELECT customer_id, churn_risk_score, 1e0 - churn_risk_score AS customer_health_score
    FROM (SELECT customer_id, {risk('recency_30d')} AS churn_risk_score FROM scored)""",
)
_LIFECYCLE = f"""CAST(date_diff('day', signup_date, DATE '{AS_OF}') AS INTEGER) AS days_since_signup,
    CASE WHEN date_diff('day', signup_date, DATE '{AS_OF}') <= 30 THEN 'new'
         WHEN date_diff('day', signup_date, DATE '{AS_OF}') <= 180 THEN 'growing'
         WHEN date_diff('day', signup_date, DATE '{AS_OF}') <= 365 THEN 'mature' ELSE 'veteran' END
      AS customer_lifecycle_stage,
    CAST(month(signup_date) AS INTEGER) AS signup_month, CAST(quarter(signup_date) AS INTEGER) AS signup_quarter,
    CAST(month(DATE '{AS_OF}') AS INTEGER) AS current_month,
    month(DATE '{AS_OF}') IN (11, 12, 1) AS is_holiday_season"""
_AFFINITY = f"""CAST(category_diversity_90d AS DOUBLE) / 10e0 AS product_diversity_score,
    CASE WHEN spending_variance_90d > 0 THEN
      CASE WHEN monetary_avg_90d <> 0 THEN 1e0 / (1e0 + spending_variance_90d / monetary_avg_90d) END
      ELSE 1e0 END AS spending_consistency,
    {VALUE_TIER} AS value_tier"""
_MONTHS = (
    f"(year(DATE '{AS_OF}') - year(signup_date)) * 12 + month(DATE '{AS_OF}') - month(signup_date)"
)
_DEMOGRAPHIC = f"""CASE WHEN age < 25 THEN 'young_adult' WHEN age < 35 THEN 'millennial' WHEN age < 50 THEN 'gen_x'
         ELSE 'baby_boomer' END AS age_group,
    city_type = 'metro' AS is_urban,
    CASE WHEN day(signup_date) = day(DATE '{AS_OF}') OR (signup_date = last_day(signup_date)
              AND DATE '{AS_OF}' = last_day(DATE '{AS_OF}'))
         THEN CAST({_MONTHS} AS DOUBLE)
         ELSE round({_MONTHS} + (day(DATE '{AS_OF}') - day(signup_date)) / 31e0, 8) END AS account_age_months,
    subscription_tier IN ('premium', 'enterprise') AS has_premium_features"""
ORACLES["lifecycle_features"] = _with(CUSTOMERS, select=f"SELECT customer_id, {_LIFECYCLE} FROM customers")
ORACLES["affinity_features"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    rfm("base", AS_OF, (90, 365)),
    select=f"""SELECT * REPLACE (round(spending_consistency, 6) AS spending_consistency)
    FROM (SELECT customer_id, {_AFFINITY} FROM base)""",
)
ORACLES["demographic_features"] = _with(CUSTOMERS, select=f"SELECT customer_id, {_DEMOGRAPHIC} FROM customers")


def _full_features() -> str:
    filled = []
    for w in config.TRANSACTION_WINDOWS:
        for c in (*_RFM_NAMES, "category_diversity"):
            filled.append(f"coalesce({c}_{w}d, 0) AS {c}_{w}d")
        filled.append(f"round(coalesce(spending_variance_{w}d, 0), 4) AS spending_variance_{w}d")
    for w in config.ENGAGEMENT_WINDOWS:
        for c in (*_COUNTED, *_DISTINCT):
            filled.append(f"coalesce({c}_{w}d, 0) AS {c}_{w}d")
    derived = f"{clv()} AS predicted_clv, {risk('recency_30d')} AS churn_risk_score, {_LIFECYCLE}, {_AFFINITY}, {_DEMOGRAPHIC}"
    return _with(
        *_RFM_ALL[:2],
        EVENTS,
        rfm("base", AS_OF, config.TRANSACTION_WINDOWS),
        with_rfm_scores("ranked", "base"),
        engaged("active", "ranked", AS_OF, config.ENGAGEMENT_WINDOWS),
        with_score("scored", "active"),
        f"derived AS (SELECT *, {derived} FROM scored)",
        select=f"""SELECT customer_id, coalesce(customer_name, 'unknown') AS customer_name, coalesce(age, 0) AS age,
        city_type, strftime(signup_date, '%Y-%m-%d') AS signup_date, subscription_tier, customer_tenure_months,
        recency_score, frequency_score, monetary_score, rfm_score, customer_segment, {', '.join(filled)},
        {', '.join(config.ENGAGEMENT_WEIGHTS)}, engagement_score, engagement_trend_30_90, predicted_clv,
        churn_risk_score, 1e0 - churn_risk_score AS customer_health_score, days_since_signup,
        customer_lifecycle_stage, signup_month, signup_quarter, current_month, is_holiday_season,
        coalesce(product_diversity_score, 0) AS product_diversity_score,
        round(coalesce(spending_consistency, 0), 6) AS spending_consistency, value_tier, age_group, is_urban,
        account_age_months, has_premium_features FROM derived""",
    )


ORACLES["customer_features"] = _full_features()


def _importance() -> str:
    rows = []
    names = [f"{c}_30d" for c in (*_RFM_NAMES, "category_diversity", "spending_variance", *_COUNTED, *_DISTINCT)]
    for n in names:
        rows.append(f"SELECT '{n}' AS feature, count({n}) AS filled_rows FROM active")
    rule = " ".join(
        f"WHEN {' OR '.join(f'contains(feature, {chr(39)}{p}{chr(39)})' for p in parts)} THEN {weight}e0"
        for parts, weight in config.IMPORTANCE_RULES
    )
    return _with(
        CUSTOMERS,
        TRANSACTIONS,
        EVENTS,
        rfm("base", AS_OF, (30,)),
        engaged("active", "base", AS_OF, (30,)),
        select=f"SELECT *, CASE {rule} ELSE 0.4e0 END AS importance FROM ({' UNION ALL '.join(rows)})",
    )


ORACLES["importance_rules"] = _importance()

# ---- feature tables --------------------------------------------------------------------------------------

_STORE = (
    CUSTOMERS,
    TRANSACTIONS,
    EVENTS,
    rfm("spending", AS_OF, (30,)),
    engaged("engaged_all", "customers", AS_OF, (90,)),
    "behavior AS (SELECT * FROM engaged_all WHERE login_count_90d IS NOT NULL)",
)
ORACLES["feature_table_pk_check"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    EVENTS,
    f"behavior AS (SELECT * FROM ev WHERE event_date >= DATE '{AS_OF}' - 30 AND event_date <= DATE '{AS_OF}')",
    f"spending AS (SELECT * FROM tx WHERE transaction_date >= DATE '{AS_OF}' - 30 AND transaction_date <= DATE '{AS_OF}')",
    select=" UNION ALL ".join(
        f"""SELECT '{name}' AS table_name, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows,
        count(*) FILTER (n > 1) AS duplicate_keys, count(*) FILTER (n > 1) = 0 AS is_unique
        FROM (SELECT customer_id, count(*) AS n FROM {source} GROUP BY customer_id)"""
        for name, source in (
            ("demographics", "customers"),
            ("behavior", "(SELECT DISTINCT customer_id FROM behavior)"),
            ("transactions", "(SELECT DISTINCT customer_id FROM spending)"),
        )
    ),
)
ORACLES["feature_upsert"] = _with(
    CUSTOMERS,
    EVENTS,
    "users AS (SELECT DISTINCT customer_id FROM ev)",
    engaged("earlier", "users", LABEL_DATE, (30,)),
    engaged("now", "users", AS_OF, (30,)),
    f"""
both_versions AS (
  SELECT customer_id, login_count_30d, content_minutes_30d, '{LABEL_DATE}' AS version_date FROM earlier
  WHERE login_count_30d IS NOT NULL
  UNION ALL
  SELECT customer_id, login_count_30d, content_minutes_30d, '{AS_OF}' FROM now WHERE login_count_30d IS NOT NULL)""",
    select="""SELECT customer_id, login_count_30d, content_minutes_30d, version_date FROM both_versions
    QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY version_date DESC) = 1""",
)
ORACLES["feature_lookup"] = _with(
    *_STORE,
    select="""SELECT s.customer_id, s.age, s.city_type, s.subscription_tier, login_count_90d, features_used_90d,
    content_minutes_90d, frequency_30d, monetary_total_30d
    FROM spending s JOIN behavior b ON b.customer_id = s.customer_id
    WHERE s.customer_id IN (SELECT customer_id FROM ev)""",
)
ORACLES["feature_lookup_asof"] = _with(
    EVENTS,
    """
versions AS (
  SELECT customer_id, event_date AS version_date, count(*) AS events,
         CAST(coalesce(sum(duration_minutes), 0) AS DOUBLE) AS minutes
  FROM ev GROUP BY customer_id, event_date),
requests AS (
  SELECT event_id AS request_id, customer_id, CAST(CAST(ts AS DATE) - 1 AS DATE) AS known_until FROM ev)""",
    select="""SELECT r.request_id, r.customer_id, strftime(r.known_until, '%Y-%m-%d') AS known_until,
    strftime(v.version_date, '%Y-%m-%d') AS version_date, v.events, v.minutes
    FROM requests r ASOF LEFT JOIN versions v
      ON v.customer_id = r.customer_id AND r.known_until >= v.version_date""",
)
ORACLES["extract_recent_labeled"] = (
    "WITH "
    + scoring()
    + f"""
SELECT customer_id, recency_30d, frequency_30d, monetary_total_30d, engagement_score, customer_tenure_months,
       support_tickets_30d, churned, strftime(created_at, '%Y-%m-%d') AS created_at
FROM (
  SELECT *, CASE WHEN customer_tenure_months > 0 THEN CASE WHEN probability > 0.5e0 THEN 1 ELSE 0 END END AS churned,
         greatest(CAST(DATE '{AS_OF}' - CAST(recency_30d AS INTEGER) AS DATE), signup_date) AS created_at
  FROM inputs)
WHERE created_at >= DATE '{AS_OF}' - 30 AND churned IS NOT NULL"""
)

_VIOLATIONS = {
    name: f"({name} < {low}" + (f" OR {name} > {high})" if high is not None else ")")
    for name, (low, high) in config.SCORING_RANGES.items()
}
_INTAKE_COLUMNS = ("customer_id", *config.SCORING_RANGES, "value_tier")
ORACLES["data_quality"] = _with(
    INTAKE,
    select=f"""SELECT count(*) AS records_extracted,
    round(100e0 * sum({' + '.join(f'CAST({c} IS NULL AS INTEGER)' for c in _INTAKE_COLUMNS)})
          / (count(*) * {len(_INTAKE_COLUMNS)}), 4) AS missing_values_pct,
    (SELECT count(*) FROM (SELECT customer_id FROM intake WHERE customer_id IS NOT NULL GROUP BY customer_id
                           HAVING count(*) > 1)) AS duplicate_keys,
    count(*) FILTER (coalesce({' , false) OR coalesce('.join(_VIOLATIONS.values())}, false)) AS rows_with_violation,
    round(1e0 - CAST(count(*) FILTER (coalesce({' , false) OR coalesce('.join(_VIOLATIONS.values())}, false)) AS DOUBLE)
          / count(*), 4) AS data_quality_score FROM intake""",
)
ORACLES["data_quality_columns"] = _with(
    INTAKE,
    select=" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS missing_count,
        CAST(count(*) FILTER ({c} IS NULL) AS DOUBLE) / count(*) AS missing_share,
        {f'count(*) FILTER ({_VIOLATIONS[c]})' if c in _VIOLATIONS else 'CAST(0 AS BIGINT)'} AS violations FROM intake"""
        for c in _INTAKE_COLUMNS
    ),
)
ORACLES["cardinality_profile"] = _with(
    CUSTOMERS,
    f"grouped AS (SELECT *, {_DEMOGRAPHIC} FROM customers)",
    select=" UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values,
        count(DISTINCT {c}) <= {config.MAX_CATEGORIES} AS kept FROM grouped"""
        for c in ("customer_name", "city_type", "subscription_tier", "age_group")
    ),
)
ORACLES["target_distribution"] = (
    "WITH "
    + LABELLED
    + """
SELECT 'churn' AS class, count(*) FILTER (label = 1) AS n_rows,
       CAST(count(*) FILTER (label = 1) AS DOUBLE) / count(*) AS share FROM labelled
UNION ALL
SELECT 'retain', count(*) FILTER (label = 0), CAST(count(*) FILTER (label = 0) AS DOUBLE) / count(*) FROM labelled"""
)
ORACLES["prepared_data"] = (
    "WITH "
    + LABELLED
    + f"""
SELECT customer_id, recency_30d, frequency_30d, monetary_total_30d, engagement_score, customer_tenure_months,
       support_tickets_30d, age, value_tier, label, split, '{AS_OF}' AS ds FROM labelled"""
)

# ---- scoring ---------------------------------------------------------------------------------------------


def _errors() -> str:
    parts = ["CASE WHEN customer_id IS NULL THEN 'customer_id: missing' END"]
    for name, (low, high) in config.SCORING_RANGES.items():
        if name not in config.OPTIONAL_SCORING_FIELDS:
            parts.append(f"CASE WHEN {name} IS NULL THEN '{name}: missing' END")
        parts.append(f"CASE WHEN {name} < {low} THEN '{name}: below {low}' END")
        if high is not None:
            parts.append(f"CASE WHEN {name} > {high} THEN '{name}: above {high}' END")
    return f"concat_ws('; ', {', '.join(parts)})"


ORACLES["validate_inputs"] = _with(
    INTAKE,
    select=f"""SELECT row_key, errors, errors = '' AS is_valid, value_tier, age
    FROM (
      SELECT md5(concat_ws('|', customer_id, CAST(CAST(recency_30d AS INTEGER) AS VARCHAR),
                           CAST(CAST(frequency_30d AS INTEGER) AS VARCHAR), CAST(customer_tenure_months AS VARCHAR),
                           CAST(support_tickets_30d AS VARCHAR))) AS row_key,
             {_errors()} AS errors,
             CASE WHEN value_tier IN ('low_value', 'medium_value', 'high_value', 'premium') THEN value_tier
                  ELSE 'medium_value' END AS value_tier, coalesce(age, {config.DEFAULT_AGE}) AS age
      FROM intake)""",
)

_RISK3 = "CASE WHEN probability > 0.7e0 THEN 'HIGH' WHEN probability > 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END"
_ACTIONS = """CASE
  WHEN probability > 0.7e0 THEN concat_ws('; ',
    CASE WHEN engagement_score < 0.3e0 THEN 'Immediate personal outreach required; Assign dedicated account manager' END,
    CASE WHEN recency_30d > 60
         THEN 'Send win-back campaign with special offer; Schedule product usage consultation' END,
    CASE WHEN support_tickets_30d > 5 THEN 'Priority support queue assignment; Product training session' END)
  WHEN probability > 0.4e0 THEN concat_ws('; ',
    'Enroll in loyalty program; Send usage analytics and insights',
    CASE WHEN frequency_30d < 2 THEN 'Promote high-value features' END,
    CASE WHEN value_tier IN ('high_value', 'premium') THEN 'VIP customer engagement program' END)
  ELSE 'Continue standard engagement; Upsell additional features' END"""
_ACTIONS_SHORT = """CASE
  WHEN probability > 0.7e0 THEN concat_ws('; ',
    CASE WHEN engagement_score < 0.3e0 THEN 'Immediate engagement campaign; Personal account manager assignment' END,
    CASE WHEN recency_30d > 60 THEN 'Win-back offer with discount; Product usage training session' END)
  WHEN probability > 0.5e0 THEN 'Loyalty program enrollment; Usage analytics and insights sharing'
  ELSE '' END"""
ORACLES["score_customers"] = (
    "WITH "
    + scoring()
    + f"""
SELECT customer_id, round(probability, 4) AS churn_probability, probability > 0.5e0 AS churn_prediction,
       {_RISK3} AS risk_level, round(abs(probability - 0.5e0) * 2, 4) AS confidence_score,
       {_ACTIONS} AS recommended_actions, '1.0.0' AS model_version FROM inputs"""
)
ORACLES["risk_bands4"] = (
    "WITH "
    + scoring()
    + """
SELECT customer_id, round(probability, 4) AS churn_probability,
       CASE WHEN probability > 0.8e0 THEN 'CRITICAL' WHEN probability > 0.6e0 THEN 'HIGH'
            WHEN probability > 0.4e0 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level FROM inputs"""
)
for _name, _rule in (("recommendations", _ACTIONS), ("recommendations_v2", _ACTIONS_SHORT)):
    ORACLES[_name] = (
        "WITH "
        + scoring()
        + f"""
SELECT customer_id, CAST(CASE WHEN recommended_actions = '' THEN 0
                              ELSE len(string_split(recommended_actions, '; ')) END AS INTEGER) AS action_count,
       recommended_actions
FROM (SELECT customer_id, {_rule} AS recommended_actions FROM inputs)"""
    )
ORACLES["score_dedup"] = (
    "WITH "
    + scoring()
    + """
SELECT event_id AS request_id, e.customer_id, round(probability, 4) AS churn_probability,
       row_number() OVER (PARTITION BY e.customer_id ORDER BY ts, event_id) > 1 AS cache_hit
FROM ev e JOIN inputs i ON i.customer_id = e.customer_id"""
)
# Customers stand for their records: the id is part of the fingerprint.
ORACLES["score_reuse_ttl"] = (
    "WITH RECURSIVE "
    + scoring()
    + """,
asked AS (SELECT event_id AS request_id, e.customer_id, ts, probability FROM ev e JOIN inputs i ON i.customer_id = e.customer_id),
onward AS (
  SELECT DISTINCT customer_id, ts, min(ts) OVER (PARTITION BY customer_id ORDER BY ts
         RANGE BETWEEN INTERVAL 1 HOUR FOLLOWING AND UNBOUNDED FOLLOWING) AS next_ts
  FROM asked),
made AS (
  SELECT customer_id, min(ts) AS ts FROM asked GROUP BY customer_id
  UNION ALL
  SELECT m.customer_id, o.next_ts FROM made m JOIN onward o ON o.customer_id = m.customer_id AND o.ts = m.ts
  WHERE o.next_ts IS NOT NULL),
used AS (
  SELECT a.*, m.ts AS scored_at FROM asked a ASOF JOIN made m ON m.customer_id = a.customer_id AND a.ts >= m.ts)
SELECT arg_min(request_id, (ts, request_id)) AS request_id, customer_id, strftime(scored_at, '%Y-%m-%d %H:%M:%S') AS scored_at,
       count(*) AS requests, round(any_value(probability), 4) AS churn_probability
FROM used GROUP BY customer_id, used.scored_at"""
)
ORACLES["score_store_runs"] = (
    "WITH "
    + scoring()
    + """,
asked AS (
  SELECT event_id AS request_id, e.customer_id, ts, round(probability, 4) AS churn_probability,
         CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 1 WHEN ts < TIMESTAMP '2024-01-18' THEN 2 ELSE 3 END AS nr
  FROM ev e JOIN inputs i ON i.customer_id = e.customer_id WHERE ts < TIMESTAMP '2024-01-24'),
one AS (SELECT DISTINCT customer_id FROM asked WHERE nr = 1),
two AS (SELECT DISTINCT customer_id FROM asked WHERE nr = 2 AND customer_id NOT IN (SELECT customer_id FROM one)),
known AS (
  SELECT *, CASE nr WHEN 1 THEN false WHEN 2 THEN customer_id IN (SELECT customer_id FROM one)
                    ELSE customer_id IN (SELECT customer_id FROM two) END AS stored
  FROM asked)
SELECT CASE nr WHEN 1 THEN '2024-01-10' WHEN 2 THEN '2024-01-18' ELSE '2024-01-24' END AS run, request_id, customer_id,
       churn_probability, stored OR row_number() OVER (PARTITION BY nr, customer_id ORDER BY ts, request_id) > 1 AS cache_hit
FROM known"""
)
ORACLES["score_summary"] = (
    "WITH "
    + scoring()
    + f"""
SELECT count(*) AS batch_size, count(*) FILTER (risk = 'HIGH') AS high_risk_count,
       count(*) FILTER (risk = 'MEDIUM') AS medium_risk_count, count(*) FILTER (risk = 'LOW') AS low_risk_count,
       round(CAST(sum(CAST(p AS DECIMAL(10,4))) AS DOUBLE) / count(*), 4) AS average_churn_probability
FROM (SELECT round(probability, 4) AS p, {_RISK3} AS risk FROM inputs)"""
)
ORACLES["serving_metrics"] = _with(
    EVENTS,
    LOG,
    select=f"""SELECT count(*) AS total_predictions,
    (SELECT round(avg(response_ms), 2) FROM
       (SELECT response_ms FROM log ORDER BY ts DESC, request_id DESC LIMIT {config.LATENCY_BUFFER}))
      AS avg_response_time_ms,
    round(count(*) FILTER (cache_hit) / greatest(count(*), 1), 4) AS cache_hit_rate,
    round(count(*) FILTER (error) / greatest(count(*), 1), 4) AS error_rate,
    strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_prediction FROM log""",
)

# ---- evaluation ------------------------------------------------------------------------------------------

_CELLS = "WITH " + CANDIDATES + "," + cells("rows_of", "model")
_N = "tn + fp + fn + tp"
ORACLES["confusion_matrix"] = _CELLS + " SELECT * FROM cells"
ORACLES["classification_metrics"] = (
    _CELLS
    + f"""
SELECT model, n, accuracy, (neg * np + pos * pp) / n AS precision_weighted, (neg * nr + pos * pr) / n AS recall_weighted,
       (neg * nf + pos * pf) / n AS f1_weighted, pp AS precision_churn, pr AS recall_churn, pf AS f1_churn
FROM (
  SELECT model, {_N} AS n, {ratio('tp + tn', _N)} AS accuracy, CAST(tn + fp AS DOUBLE) AS neg,
         CAST(tp + fn AS DOUBLE) AS pos, {POSITIVE[0]} AS pp, {POSITIVE[1]} AS pr, {POSITIVE[2]} AS pf,
         {NEGATIVE[0]} AS np, {NEGATIVE[1]} AS nr, {NEGATIVE[2]} AS nf
  FROM cells)"""
)
ORACLES["class_report"] = (
    _CELLS
    + f"""
SELECT model, 0 AS class, {NEGATIVE[0]} AS precision, {NEGATIVE[1]} AS recall, {NEGATIVE[2]} AS f1, tn + fp AS support
FROM cells
UNION ALL
SELECT model, 1, {POSITIVE[0]}, {POSITIVE[1]}, {POSITIVE[2]}, tp + fn FROM cells"""
)
ORACLES["roc_auc"] = "WITH " + CANDIDATES + "," + auc("rows_of", "model") + " SELECT model, auc FROM auc_of"
ORACLES["overfit_gaps"] = (
    "WITH "
    + CANDIDATES
    + ","
    + cells("rows_of", "model, split")
    + ","
    + auc("rows_of", "model, split")
    + f""",
both_of AS (
  SELECT c.model, c.split, {ratio('tp + tn', _N)} AS accuracy, auc
  FROM cells c JOIN auc_of a ON a.model = c.model AND a.split = c.split)
SELECT *, train_accuracy - val_accuracy AS accuracy_diff, train_auc - val_auc AS auc_diff
FROM (
  SELECT model, max(accuracy) FILTER (split = 'train') AS train_accuracy,
         max(accuracy) FILTER (split = 'val') AS val_accuracy, max(auc) FILTER (split = 'train') AS train_auc,
         max(auc) FILTER (split = 'val') AS val_auc
  FROM both_of GROUP BY model)"""
)
ORACLES["business_metrics"] = (
    _CELLS
    + f""",
cuts AS (SELECT model, quantile_cont(probability, 0.1) AS cut FROM rows_of WHERE label = 1 GROUP BY model)
SELECT c.model, tp AS true_positives, fp AS false_positives, tn AS true_negatives, fn AS false_negatives,
       {POSITIVE[0]} AS precision_at_risk, {POSITIVE[1]} AS recall_at_risk, fn * 1000 AS cost_of_false_negatives,
       fp * 100 AS cost_of_false_positives, tp * 900 AS savings_from_true_positives, cut AS precision_threshold_90,
       CAST(tp * 900 - (fn * 1000 + fp * 100) AS DOUBLE) / CAST(greatest(fn * 1000 + fp * 100, 1) AS DOUBLE) AS roi
FROM cells c LEFT JOIN cuts ON cuts.model = c.model"""
)
ORACLES["cv_stability"] = (
    "WITH "
    + CANDIDATES
    + """,
folded AS (
  SELECT model, k, accuracy FROM (
    SELECT model, k, CAST(CAST('0x' || substr(md5(customer_id || 'fold42'), 1, 8) AS BIGINT) % k AS INTEGER) AS fold,
           CAST(count(*) FILTER (label = prediction) AS DOUBLE) / count(*) AS accuracy
    FROM rows_of, (SELECT 5 AS k UNION ALL SELECT 10) GROUP BY ALL))
SELECT model, k, count(*) AS folds, round(avg(accuracy), 6) AS cv_mean_accuracy,
       round(stddev_pop(accuracy), 6) AS cv_std_accuracy, round(min(accuracy), 6) AS cv_min_accuracy,
       round(max(accuracy), 6) AS cv_max_accuracy, round(var_pop(accuracy), 6) AS cv_variance,
       round(1 - stddev_pop(accuracy) / avg(accuracy), 6) AS stability_score
FROM folded GROUP BY model, k"""
)
ORACLES["live_accuracy"] = (
    "WITH "
    + LABELLED
    + f"""
SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS predictions,
       CAST(count(*) FILTER (label = prediction) AS DOUBLE) / count(*) AS accuracy
FROM ev e JOIN labelled l ON l.customer_id = e.customer_id
WHERE CAST(ts AS DATE) >= DATE '{AS_OF}' - 7 GROUP BY 1"""
)

# ---- drift, gates, registry ------------------------------------------------------------------------------

_TIERS = "WITH " + LABELLED + "," + cells("labelled", "subscription_tier")
_BASE = f"{config.BASELINE_ACCURACY}e0"
ORACLES["performance_drift"] = (
    _TIERS
    + f"""
SELECT subscription_tier, n, current_accuracy, {_BASE} AS baseline_accuracy,
       ({_BASE} - current_accuracy) / {_BASE} AS performance_drift
FROM (SELECT subscription_tier, {_N} AS n, {ratio('tp + tn', _N)} AS current_accuracy FROM cells)"""
)


def _side(name: str, as_of: str) -> str:
    prefix = name[0]
    return ",".join(
        [
            rfm(f"{prefix}_base", as_of, (30,)),
            engaged(f"{prefix}_active", f"{prefix}_base", as_of, (30,)),
            with_score(f"{prefix}_scored", f"{prefix}_active"),
        ]
    )


_FEATURES = ("recency_30d", "frequency_30d", "monetary_total_30d", "engagement_score", "support_tickets_30d")
_SIDES = ",".join(
    [CUSTOMERS, TRANSACTIONS, EVENTS, _side("baseline", LABEL_DATE), _side("current", AS_OF)]
    + [
        "stacked AS ("
        + " UNION ALL ".join(
            f"SELECT '{side}' AS side, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {side[0]}_scored"
            for side in ("baseline", "current")
            for f in _FEATURES
        )
        + ")"
    ]
)
_DECILES = ", ".join(str(i / 10) for i in range(1, 10))
_PSI = (
    _SIDES
    + f""",
edges AS (
  SELECT feature, quantile_cont(value, [{_DECILES}]) AS edges FROM stacked
  WHERE side = 'baseline' AND value IS NOT NULL GROUP BY feature),
binned AS (
  SELECT s.feature, CASE WHEN value IS NOT NULL THEN len(list_filter(edges, lambda e: e < value)) END AS bin,
         count(*) FILTER (side = 'baseline') AS b, count(*) FILTER (side = 'current') AS c
  FROM stacked s LEFT JOIN edges ON edges.feature = s.feature GROUP BY 1, 2),
shares AS (
  SELECT feature, greatest(CAST(b AS DOUBLE) / sum(b) OVER (PARTITION BY feature), 1e-4) AS e,
         greatest(CAST(c AS DOUBLE) / sum(c) OVER (PARTITION BY feature), 1e-4) AS a
  FROM binned),
psi AS (SELECT feature, round(sum((a - e) * ln(a / e)), 6) AS psi FROM shares GROUP BY feature)"""
)
_KS = (
    _SIDES
    + """,
ks AS (
  SELECT feature, max(abs(CAST(bu AS DOUBLE) / CAST(ba AS DOUBLE) - CAST(cu AS DOUBLE) / CAST(ca AS DOUBLE))) AS ks
  FROM (
    SELECT feature, sum(b) OVER w AS bu, sum(c) OVER w AS cu, sum(b) OVER (PARTITION BY feature) AS ba,
           sum(c) OVER (PARTITION BY feature) AS ca
    FROM (SELECT feature, value, count(*) FILTER (side = 'baseline') AS b, count(*) FILTER (side = 'current') AS c
          FROM stacked WHERE value IS NOT NULL GROUP BY feature, value)
    WINDOW w AS (PARTITION BY feature ORDER BY value))
  GROUP BY feature)"""
)
ORACLES["feature_drift_psi"] = "WITH " + _PSI + " SELECT feature, psi FROM psi"
ORACLES["feature_drift_ks"] = "WITH " + _KS + " SELECT feature, ks FROM ks"
ORACLES["drift_alerts"] = (
    "WITH "
    + _PSI
    + f"""
SELECT (SELECT feature FROM psi ORDER BY psi DESC, feature DESC LIMIT 1) AS feature, max(psi) AS drift_score,
       count(*) FILTER (psi > {config.FEATURE_DRIFT_THRESHOLD}e0) AS features_over_threshold,
       max(psi) > {config.FEATURE_DRIFT_THRESHOLD}e0 AS alert FROM psi"""
)
ORACLES["retrain_decision"] = (
    "WITH "
    + LABELLED
    + ","
    + cells("labelled", "subscription_tier")
    + ","
    # The drift sides use today's customer table under the same name; only the tenure differs, which they ignore.
    + _KS[len(",".join([CUSTOMERS, TRANSACTIONS, EVENTS])) + 1 :]
    + f"""
SELECT subscription_tier, n, round(d, 4) AS performance_drift, drift > 0.05e0 AS data_drift_detected,
       d > 0.05e0 OR drift > 0.05e0 OR acc < 0.85e0 AS requires_retraining, round(acc, 4) AS current_accuracy,
       {_BASE} AS baseline_accuracy, round(drift, 4) AS drift_score
FROM (
  SELECT subscription_tier, n, acc, ({_BASE} - acc) / {_BASE} AS d, (SELECT max(ks) FROM ks) AS drift
  FROM (SELECT subscription_tier, {_N} AS n, {ratio('tp + tn', _N)} AS acc FROM cells))"""
)
_VALIDATED = (
    "WITH "
    + CANDIDATES
    + ", test_rows AS (SELECT * FROM rows_of WHERE split = 'test'),"
    + cells("test_rows", "model")
    + ","
    + auc("test_rows", "model")
    + f""",
checks AS (
  SELECT *, accuracy >= 0.85e0 AS accuracy_check, coalesce(auc, 0) >= 0.85e0 AS auc_check,
         -(accuracy - {_BASE}) <= 0.02e0 AS performance_regression_check, accuracy - {_BASE} AS accuracy_improvement
  FROM (SELECT c.model, {_N} AS n, {ratio('tp + tn', _N)} AS accuracy, auc, {_BASE} AS baseline_accuracy
        FROM cells c JOIN auc_of a ON a.model = c.model)),
validated AS (
  SELECT *, accuracy_check AND auc_check AND performance_regression_check AS validation_passed,
         concat_ws('; ', CASE WHEN NOT accuracy_check THEN 'accuracy below 0.85' END,
                   CASE WHEN NOT auc_check THEN 'auc below 0.85' END,
                   CASE WHEN NOT performance_regression_check THEN 'accuracy drop above 0.02' END) AS rejection_reasons
  FROM checks)"""
)
ORACLES["candidate_validation"] = (
    _VALIDATED
    + """
SELECT *, CASE WHEN validation_passed THEN 'APPROVE' ELSE 'REJECT' END AS deployment_recommendation,
       CASE WHEN validation_passed THEN CAST(trunc(accuracy_improvement * 10000) AS BIGINT) END
         AS estimated_customer_saves,
       CASE WHEN validation_passed THEN CAST(trunc(accuracy_improvement * 10000) AS BIGINT) * 1000 END
         AS estimated_revenue_impact
FROM validated"""
)
ORACLES["model_registry"] = (
    _VALIDATED
    + f""",
registry AS (
  SELECT 'v_' || model || '_{AS_OF.replace("-", "")}' AS model_version, '{AS_OF}' AS deployment_date,
         accuracy AS baseline_accuracy, model AS model_type,
         (SELECT count(*) FROM rows_of r WHERE r.model = validated.model) AS training_samples, validation_passed AS promoted
  FROM validated)
SELECT *, coalesce(model_version = (SELECT model_version FROM registry WHERE promoted
                                    ORDER BY deployment_date DESC, baseline_accuracy DESC, model_version DESC LIMIT 1),
                   false) AS is_current
FROM registry"""
)
ORACLES["model_leaderboard"] = (
    "WITH "
    + CANDIDATES
    + ", val_rows AS (SELECT * FROM rows_of WHERE split = 'val'),"
    + cells("val_rows", "model")
    + f""",
board AS (
  SELECT model, {ratio('tp + tn', _N)} AS val_accuracy,
         list_position(['blend', 'recency', 'frequency', 'engagement'], model) AS place FROM cells)
SELECT model, val_accuracy, row_number() OVER (ORDER BY val_accuracy DESC, place) = 1 AS is_best FROM board"""
)
ORACLES["ab_compare"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    f"""
arms AS (
  SELECT c.customer_id, CASE WHEN substr(md5(c.customer_id || '7'), 1, 8) < '80000000' THEN 'A' ELSE 'B' END AS arm,
         EXISTS (SELECT 1 FROM tx WHERE tx.customer_id = c.customer_id AND transaction_date > DATE '{LABEL_DATE}'
                 AND transaction_date <= DATE '{LABEL_DATE}' + 30) AS hit
  FROM customers c),
counts AS (
  SELECT count(*) FILTER (arm = 'A') AS n_a, count(*) FILTER (arm = 'A' AND hit) AS c_a,
         count(*) FILTER (arm = 'B') AS n_b, count(*) FILTER (arm = 'B' AND hit) AS c_b FROM arms),
rates AS (
  SELECT *, c_a / n_a AS r_a, c_b / n_b AS r_b, (c_a + c_b) / (n_a + n_b) AS pooled FROM counts)""",
    select="""SELECT n_a, c_a AS conversions_a, round(r_a, 6) AS rate_a, n_b, c_b AS conversions_b,
    round(r_b, 6) AS rate_b, round((r_b - r_a) / r_a, 6) AS lift,
    round((r_b - r_a) / sqrt(pooled * (1 - pooled) * (1e0 / n_a + 1e0 / n_b)), 6) AS z FROM rates""",
)
ORACLES["stratified_split"] = "WITH " + LABELLED + " SELECT customer_id, label, split FROM labelled"

# ---- preparation and streams -----------------------------------------------------------------------------

_NUMERIC = ("recency_30d", "frequency_30d", "monetary_total_30d", "age")
ORACLES["preprocess_numeric"] = _with(
    CUSTOMERS,
    TRANSACTIONS,
    rfm("base", LABEL_DATE, (30,)),
    f"""
parts AS (
  SELECT customer_id, CASE WHEN substr(md5(customer_id || '42'), 1, 8) < 'b3333333' THEN 'train'
         WHEN substr(md5(customer_id || '42'), 1, 8) < 'cccccccc' THEN 'val' ELSE 'test' END AS split,
         {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in _NUMERIC)}
  FROM base),
medians AS (SELECT {', '.join(f'quantile_cont({c}, 0.5) AS {c}_median' for c in _NUMERIC)} FROM parts WHERE split = 'train'),
filled AS (
  SELECT customer_id, split, {', '.join(f'coalesce({c}, {c}_median) AS {c}' for c in _NUMERIC)} FROM parts, medians),
stats AS (
  SELECT {', '.join(f'avg({c}) AS {c}_mean, stddev_pop({c}) AS {c}_dev' for c in _NUMERIC)}
  FROM filled WHERE split = 'train')""",
    select=f"""SELECT customer_id, split, {', '.join(f'round(({c} - {c}_mean) / {c}_dev, 6) AS {c}' for c in _NUMERIC)}
    FROM filled, stats""",
)


def _slots(column: str) -> str:
    return f"""(SELECT string_agg(CASE WHEN known = l.{column} THEN '1' ELSE '0' END, ',' ORDER BY known)
         FROM (SELECT DISTINCT {column} AS known FROM labelled WHERE split = 'train')) AS {column}"""


ORACLES["preprocess_onehot"] = (
    "WITH "
    + LABELLED
    + f"\nSELECT customer_id, {', '.join(_slots(c) for c in ('city_type', 'subscription_tier', 'value_tier'))}"
    + " FROM labelled l"
)
ORACLES["stream_engagement_daily"] = _with(
    EVENTS,
    select="""SELECT customer_id, strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, event_type, count(*) AS events,
    CAST(sum(coalesce(duration_minutes, 0)) AS DOUBLE) AS minutes FROM ev GROUP BY ALL""",
)
ORACLES["stream_scores"] = (
    "WITH "
    + scoring()
    + f"""
SELECT event_id AS request_id, e.customer_id, round(probability, 4) AS churn_probability, {_RISK3} AS risk_level
FROM ev e JOIN inputs i ON i.customer_id = e.customer_id"""
)
ORACLES["stream_score_dedup"] = (
    "WITH "
    + scoring()
    + """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS reuse_start, i.customer_id,
       arg_min(event_id, (ts, event_id)) AS request_id, count(*) AS requests,
       round(any_value(probability), 4) AS churn_probability
FROM ev e JOIN inputs i ON i.customer_id = e.customer_id GROUP BY date_trunc('hour', ts), i.customer_id"""
)
ORACLES["stream_serving_metrics"] = _with(
    EVENTS,
    LOG,
    select="""SELECT strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M') AS minute, count(*) AS requests,
    round(count(*) FILTER (cache_hit) / count(*), 4) AS cache_hit_rate,
    round(count(*) FILTER (error) / count(*), 4) AS error_rate,
    round(CAST(sum(CAST(response_ms AS DECIMAL(18,6))) AS DOUBLE) / count(*), 6) AS avg_response_time_ms
    FROM log GROUP BY date_trunc('minute', ts)""",
)
ORACLES["stream_behavior_features"] = _with(
    EVENTS.replace("CAST(CAST(ts AS DATE) - CAST((event_id % 4) * 30 AS INTEGER) AS DATE)", "CAST(ts AS DATE)"),
    "users AS (SELECT DISTINCT customer_id FROM ev)",
    engaged("active", "users", AS_OF, config.ENGAGEMENT_WINDOWS),
    select="SELECT * FROM active WHERE login_count_90d IS NOT NULL",
)
ORACLES["stratified_split_exact"] = (
    "WITH "
    + LABELLED
    + """
SELECT customer_id, label, CASE WHEN place <= 0.7e0 THEN 'train' WHEN place <= 0.8e0 THEN 'val' ELSE 'test' END AS split
FROM (
  SELECT customer_id, label,
         CAST(row_number() OVER (PARTITION BY label ORDER BY md5(customer_id || '42'), customer_id) AS DOUBLE)
           / count(*) OVER (PARTITION BY label) AS place
  FROM labelled)"""
)
ORACLES["score_summary_by_tier"] = (
    "WITH "
    + scoring()
    + f"""
SELECT coalesce(subscription_tier, 'all') AS subscription_tier, count(*) AS batch_size,
       count(*) FILTER (risk = 'HIGH') AS high_risk_count, count(*) FILTER (risk = 'MEDIUM') AS medium_risk_count,
       count(*) FILTER (risk = 'LOW') AS low_risk_count,
       round(CAST(sum(CAST(p AS DECIMAL(10,4))) AS DOUBLE) / count(*), 4) AS average_churn_probability
FROM (SELECT subscription_tier, round(probability, 4) AS p, {_RISK3} AS risk FROM inputs)
GROUP BY ROLLUP (subscription_tier)"""
)

ORACLES["stream_serving_totals"] = ORACLES["serving_metrics"]
ORACLES["score_with_quarantine"] = _with(
    INTAKE,
    select=f"""SELECT md5(CAST(to_json(struct_pack({', '.join(f'{c} := {c}' for c in sorted(_INTAKE_COLUMNS))})) AS VARCHAR)) AS fingerprint,
    customer_id, errors, CASE WHEN errors = '' THEN round(probability, 4) END AS churn_probability,
    CASE WHEN errors = '' THEN {_RISK3} END AS risk_level, '1.0.0' AS model_version,
    CASE WHEN errors = '' THEN 'scored' ELSE 'quarantined' END AS outcome
    FROM (SELECT *, {_errors()} AS errors,
                 least(greatest((recency_30d / 100e0) * 0.3e0 + (1e0 / (frequency_30d + 1e0)) * 0.3e0
                                + (1e0 - engagement_score) * 0.4e0, 0e0), 1e0) AS probability FROM intake)""",
)
ORACLES["live_accuracy_logged"] = (
    "WITH "
    + LABELLED
    + f""",
logged AS (
  SELECT label = prediction AS hit,
         CAST(DATE '{LABEL_DATE}' + 3 - CAST(CAST(substr(customer_id, 2) AS BIGINT) % 12 AS INTEGER) AS DATE) AS d FROM labelled),
closed AS (SELECT * FROM logged WHERE d <= DATE '{AS_OF}' - 90)
SELECT 'day' AS scope, strftime(d, '%Y-%m-%d') AS day, '1.0.0' AS model_version, count(*) AS predictions,
       CAST(count(*) FILTER (hit) AS DOUBLE) / count(*) AS accuracy FROM closed GROUP BY d
UNION ALL
SELECT 'last 7 days', strftime(CAST(DATE '{AS_OF}' - 90 AS DATE), '%Y-%m-%d'), '1.0.0', count(*),
       CAST(count(*) FILTER (hit) AS DOUBLE) / count(*) FROM closed WHERE d > DATE '{AS_OF}' - 97"""
)
ORACLES["ingest_text"] = _with(
    CUSTOMERS,
    select="""SELECT outcome, CASE WHEN outcome <> 'corrupt' THEN city_type END AS city_type,
    CASE WHEN outcome <> 'corrupt' AND nr % 37 = 0 THEN 'c' || (nr % 5) END AS campaign,
    count(*) AS customers, count(*) FILTER (outcome = 'ok') AS dated,
    CAST(sum(date_diff('day', DATE '2020-01-01', signup_date)) FILTER (outcome = 'ok') AS BIGINT) AS days,
    max(CASE WHEN outcome = 'corrupt' THEN '{"customer_id":"C0' END) AS line
    FROM (SELECT *, CASE WHEN nr % 29 = 0 THEN 'corrupt' WHEN nr % 31 = 0 THEN 'bad_date' ELSE 'ok' END AS outcome
          FROM (SELECT *, CAST(substr(customer_id, 2) AS BIGINT) AS nr FROM customers)) GROUP BY 1, 2, 3""",
)

# Counts of this size are held exactly by the sketches.
ORACLES["rfm_distinct_sketch"] = _with(
    TRANSACTIONS,
    select="SELECT customer_id, "
    + ", ".join(
        f"count(DISTINCT CASE WHEN transaction_date >= DATE '{AS_OF}' - {w} THEN product_category END) AS category_diversity_{w}d"
        for w in config.TRANSACTION_WINDOWS
    )
    + f""" FROM tx WHERE transaction_date >= DATE '{AS_OF}' - {max(config.TRANSACTION_WINDOWS)} AND transaction_date <= DATE '{AS_OF}'
    GROUP BY customer_id""",
)
_COUNTED_ONCE = {"active_days": ("login", "event_date"), "features_used": ("feature_usage", "feature_name"), "unique_content": ("content_view", "content_id")}
ORACLES["engagement_distinct_sketch"] = _with(
    EVENTS,
    select="SELECT customer_id, "
    + ", ".join(
        f"count(DISTINCT CASE WHEN event_type = '{kind}' AND event_date >= DATE '{AS_OF}' - {w} THEN {member} END) AS {name}_{w}d"
        for w in config.ENGAGEMENT_WINDOWS
        for name, (kind, member) in _COUNTED_ONCE.items()
    )
    + f""" FROM ev WHERE event_date >= DATE '{AS_OF}' - {max(config.ENGAGEMENT_WINDOWS)} AND event_date <= DATE '{AS_OF}'
    GROUP BY customer_id""",
)
