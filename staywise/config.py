"""Fixed values of the workload: windows, weights, thresholds, labels and texts, all in one place.

Results depend on every one of them, so they are written out plainly.
"""

from __future__ import annotations

# Trailing windows in days. A window of w days is [as_of - w, as_of], both ends included.
TRANSACTION_WINDOWS = (7, 30, 90, 180, 365)
ENGAGEMENT_WINDOWS = (7, 30, 90)

# Weights of the five engagement components, in the order they are added up.
ENGAGEMENT_WEIGHTS = {
    "login_engagement": 0.3,
    "feature_engagement": 0.25,
    "support_engagement": 0.2,
    "community_engagement": 0.15,
    "content_engagement": 0.1,
}

# Lowest composite score of each customer segment, best first; anything lower is DEFAULT_SEGMENT.
SEGMENT_FLOORS = (
    (555, "Champions"),
    (454, "Loyal Customers"),
    (344, "Potential Loyalists"),
    (334, "New Customers"),
    (313, "Promising"),
    (244, "Need Attention"),
    (144, "About to Sleep"),
    (133, "At Risk"),
    (123, "Cannot Lose Them"),
)
DEFAULT_SEGMENT = "Lost"

LIFECYCLE_LIMITS = ((30, "new"), (180, "growing"), (365, "mature"))
LIFECYCLE_DEFAULT = "veteran"
AGE_LIMITS = ((25, "young_adult"), (35, "millennial"), (50, "gen_x"))
AGE_DEFAULT = "baby_boomer"
VALUE_TIER_FLOORS = ((5000, "premium"), (1000, "high_value"), (200, "medium_value"))
VALUE_TIER_DEFAULT = "low_value"
HOLIDAY_MONTHS = (11, 12, 1)
PAID_TIERS = ("premium", "enterprise")

# Scoring input: valid tiers, defaults and the closed range of every checked field (None = open end).
SCORING_TIERS = ("low_value", "medium_value", "high_value", "premium")
DEFAULT_SCORING_TIER = "medium_value"
DEFAULT_AGE = 35
SCORING_RANGES = {
    "recency_30d": (0, None),
    "frequency_30d": (0, None),
    "monetary_total_30d": (0, None),
    "monetary_avg_30d": (0, None),
    "engagement_score": (0, 1),
    "customer_tenure_months": (0, None),
    "support_tickets_30d": (0, None),
    "age": (18, 100),
}
OPTIONAL_SCORING_FIELDS = ("age",)

RISK_BANDS = ((0.7, "HIGH"), (0.4, "MEDIUM"))
RISK_BANDS_FOUR = ((0.8, "CRITICAL"), (0.6, "HIGH"), (0.4, "MEDIUM"))
RISK_DEFAULT = "LOW"

# Texts of the recommended actions, by the rule that adds them, in the order they are listed.
ACTIONS = {
    "high_low_engagement": ("Immediate personal outreach required", "Assign dedicated account manager"),
    "high_inactive": ("Send win-back campaign with special offer", "Schedule product usage consultation"),
    "high_many_tickets": ("Priority support queue assignment", "Product training session"),
    "medium": ("Enroll in loyalty program", "Send usage analytics and insights"),
    "medium_infrequent": ("Promote high-value features",),
    "medium_valuable": ("VIP customer engagement program",),
    "low": ("Continue standard engagement", "Upsell additional features"),
}
# Texts of the shorter rule list.
ACTIONS_SHORT = {
    "high_low_engagement": ("Immediate engagement campaign", "Personal account manager assignment"),
    "high_inactive": ("Win-back offer with discount", "Product usage training session"),
    "medium": ("Loyalty program enrollment", "Usage analytics and insights sharing"),
}

# Importance of a feature by what its name contains; the first matching row wins.
IMPORTANCE_RULES = (
    (("rfm_score", "clv"), 0.9),
    (("engagement_score", "churn_risk"), 0.8),
    (("frequency", "monetary"), 0.7),
    (("recency",), 0.6),
)
IMPORTANCE_DEFAULT = 0.4

# Business value of the confusion matrix cells.
CUSTOMER_VALUE = 1000
RETENTION_COST = 100

# Drift and promotion gates.
DRIFT_THRESHOLD = 0.05
FEATURE_DRIFT_THRESHOLD = 0.3
PERFORMANCE_THRESHOLD = 0.85
MIN_AUC = 0.85
MAX_ACCURACY_DROP = 0.02
MIN_PRECISION = 0.80
MIN_RECALL = 0.75
BASELINE_ACCURACY = 0.902
SAVES_PER_ACCURACY_POINT = 10000

LATENCY_BUFFER = 1000
MAX_CATEGORIES = 50
SPLIT_SEED = 42
MODEL_VERSION = "1.0.0"
