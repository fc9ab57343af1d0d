"""Banding, labelling and recommendation rules as Column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from staywise import config


def first_floor(column: Column, floors: Sequence[tuple], default: str, inclusive: bool = False) -> Column:
    """Label of the first floor the value lies above (or on, if inclusive); floors go from high to low."""
    result = None
    for floor, label in floors:
        reached = column >= floor if inclusive else column > floor
        result = F.when(reached, label) if result is None else result.when(reached, label)
    return result.otherwise(default)


def first_limit(column: Column, limits: Sequence[tuple], default: str, inclusive: bool = False) -> Column:
    """Label of the first limit the value lies below (or on, if inclusive); limits go from low to high."""
    result = None
    for limit, label in limits:
        under = column <= limit if inclusive else column < limit
        result = F.when(under, label) if result is None else result.when(under, label)
    return result.otherwise(default)


def customer_segment(rfm_score: Column) -> Column:
    return first_floor(rfm_score, config.SEGMENT_FLOORS, config.DEFAULT_SEGMENT, inclusive=True)


def value_tier(yearly_spend: Column) -> Column:
    return first_floor(yearly_spend, config.VALUE_TIER_FLOORS, config.VALUE_TIER_DEFAULT)


def lifecycle_stage(days_since_signup: Column) -> Column:
    return first_limit(days_since_signup, config.LIFECYCLE_LIMITS, config.LIFECYCLE_DEFAULT, inclusive=True)


def age_group(age: Column) -> Column:
    return first_limit(age, config.AGE_LIMITS, config.AGE_DEFAULT)


def flag(condition: Column) -> Column:
    """Condition as a plain boolean: NULL becomes false."""
    return F.coalesce(condition, F.lit(False))


def risk_level(probability: Column) -> Column:
    return first_floor(probability, config.RISK_BANDS, config.RISK_DEFAULT)


def risk_level_four(probability: Column) -> Column:
    return first_floor(probability, config.RISK_BANDS_FOUR, config.RISK_DEFAULT)


def confidence(probability: Column) -> Column:
    """Distance from the decision boundary, scaled to [0, 1]."""
    return F.abs(probability - 0.5) * 2


def rule_importance(feature_name: Column) -> Column:
    result = None
    for parts, weight in config.IMPORTANCE_RULES:
        hit = F.lit(False)
        for part in parts:
            hit = hit | feature_name.contains(part)
        result = F.when(hit, weight) if result is None else result.when(hit, weight)
    return result.otherwise(config.IMPORTANCE_DEFAULT)


def _actions(texts: dict[str, tuple[str, ...]], conditions: dict[str, Column]) -> Column:
    """The texts of all rules that apply, in the order of the text table."""
    entries = [F.when(conditions[rule], F.lit(text)) for rule, lines in texts.items() for text in lines]
    return F.array_compact(F.array(*entries))


def recommended_actions(
    probability: Column, engagement: Column, recency: Column, tickets: Column, frequency: Column, tier: Column
) -> Column:
    """Actions in fixed order. A high-risk customer who meets no further rule gets an empty array."""
    level = risk_level(probability)
    high, medium = level == "HIGH", level == "MEDIUM"
    return _actions(
        config.ACTIONS,
        {
            "high_low_engagement": high & (engagement < 0.3),
            "high_inactive": high & (recency > 60),
            "high_many_tickets": high & (tickets > 5),
            "medium": medium,
            "medium_infrequent": medium & (frequency < 2),
            "medium_valuable": medium & tier.isin("high_value", "premium"),
            "low": level == config.RISK_DEFAULT,
        },
    )


def recommended_actions_short(probability: Column, engagement: Column, recency_days: Column) -> Column:
    """The shorter rule list: bands at 0.7 and 0.5, nothing for the rest."""
    high = probability > 0.7
    return _actions(
        config.ACTIONS_SHORT,
        {
            "high_low_engagement": high & (engagement < 0.3),
            "high_inactive": high & (recency_days > 60),
            "medium": (probability > 0.5) & ~high,
        },
    )


def hash_split(key: Column, seed: int, shares: Sequence[tuple[str, float]]) -> Column:
    """Name of the share a key falls into, from the first 8 hex digits of an md5: stable and shuffle-free."""
    digest = F.substring(F.md5(F.concat(key.cast("string"), F.lit(str(seed)))), 1, 8)
    result, reached = None, 0.0
    for name, share in shares[:-1]:
        reached += share
        cut = f"{int(reached * 16**8):08x}"
        result = F.when(digest < cut, name) if result is None else result.when(digest < cut, name)
    return result.otherwise(shares[-1][0])


def hash_fold(key: Column, seed: int, folds: int) -> Column:
    """Fold number in [0, folds) from the same kind of digest."""
    digest = F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"fold{seed}"))), 1, 8)
    return (F.conv(digest, 16, 10).cast("bigint") % folds).cast("int")
