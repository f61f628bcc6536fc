"""Labels derived from values."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Product categories in bucket order.
CATEGORY_BUCKETS = ("Electronics", "Clothing", "Home", "Sports", "Beauty")

# Lowest click-through rate of each tier, highest tier first.
CTR_TIERS = ((0.05, "Excellent"), (0.03, "Good"), (0.015, "Average"))
CTR_LOWEST_TIER = "Below Average"


def category_bucket(campaign_id: Column) -> Column:
    """Category by the code of the first character, modulo 5."""
    names = F.array(*[F.lit(name) for name in CATEGORY_BUCKETS])
    bucket = F.element_at(names, (F.ascii(campaign_id) % len(CATEGORY_BUCKETS) + 1).cast("int"))
    return F.coalesce(bucket, F.lit(CATEGORY_BUCKETS[-1]))


def ctr_tier(ctr: Column) -> Column:
    label = F.lit(CTR_LOWEST_TIER)
    for threshold, name in reversed(CTR_TIERS):
        label = F.when(ctr >= threshold, name).otherwise(label)
    return label


def quadrant(spend: Column, roi: Column, mean_spend: Column, mean_roi: Column) -> Column:
    """Efficiency quadrant of a campaign against the mean spend and mean ROI."""
    high_spend, high_roi = spend >= mean_spend, roi >= mean_roi
    return (
        F.when(high_spend & high_roi, "Stars")
        .when(high_spend, "Question Marks")
        .when(high_roi, "Cash Cows")
        .otherwise("Pets")
    )
