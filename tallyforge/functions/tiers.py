"""Class labels from numbers and texts. The thresholds are fixed values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

Limits = Sequence[tuple[float | Column, str]]


def below(column: str | Column, limits: Limits, rest: str | Column, missing: str | None = None) -> Column:
    """Label of the first limit the value lies below, else `rest`; `missing` for NULL if given."""
    value = F.col(column) if isinstance(column, str) else column
    label = F.when(value.isNull(), missing) if missing is not None else F
    for limit, name in limits:
        label = label.when(value < limit, name)
    return label.otherwise(rest)


def above(column: str | Column, limits: Limits, rest: str | Column, missing: str | None = None) -> Column:
    """Label of the first limit the value exceeds, else `rest`; `missing` for NULL if given."""
    value = F.col(column) if isinstance(column, str) else column
    label = F.when(value.isNull(), missing) if missing is not None else F
    for limit, name in limits:
        label = label.when(value > limit, name)
    return label.otherwise(rest)


# Fixed values, lowest or highest limit first as the function reads them.
SPENDING_SEGMENT = ((5000, "VIP"), (2000, "High Value"), (500, "Medium Value"))
SPENDING_TIER = ((3000, "High"), (1000, "Medium"))
AMOUNT_CLASS = ((1000, "high"), (100, "medium"))
AMOUNT_CATEGORY = ((50, "Low"), (200, "Medium"))
SPENDING_LEVEL = ((1000, "low"), (5000, "medium"))
CUSTOMER_TIER = ((150, "High Spender"), (75, "Regular"))
AGE_GROUP = ((25, "18-25"), (35, "26-35"), (45, "36-45"), (55, "46-55"))
AGE_GROUP_SHORT = ((25, "18-25"), (35, "26-35"), (45, "36-45"))
AGE_CATEGORY = ((25, "Young"), (35, "Adult"))
LIFE_STAGE = ((25, "Young Adult"), (35, "Adult"), (50, "Middle Age"))
GENERATION = ((25, "Gen Z"), (40, "Millennial"), (55, "Gen X"))
CARD_BRANDS = ("visa", "mastercard", "amex")


def customer_segment(total: str) -> Column:
    return above(total, SPENDING_SEGMENT, "Low Value")


def spending_tier(total: str) -> Column:
    return above(total, SPENDING_TIER, "Low")


def amount_class(amount: str) -> Column:
    return above(amount, AMOUNT_CLASS, "low", missing="unknown")


def amount_category(amount: str) -> Column:
    return below(amount, AMOUNT_CATEGORY, "High")


def spending_level(total: str) -> Column:
    return below(total, SPENDING_LEVEL, "high")


def customer_tier(total: str) -> Column:
    return above(total, CUSTOMER_TIER, "Low Spender")


def age_group(age: str) -> Column:
    return below(age, AGE_GROUP, "55+")


def age_group_short(age: str) -> Column:
    return below(age, AGE_GROUP_SHORT, "45+")


def age_category(age: str) -> Column:
    return below(age, AGE_CATEGORY, "Senior")


def life_stage(age: str) -> Column:
    return below(age, LIFE_STAGE, "Senior")


def generation(age: str) -> Column:
    return below(age, GENERATION, "Boomer", missing="Unknown")


def transaction_size(total: str) -> Column:
    """Small below 20, Medium up to and including 50, Large above."""
    return F.when(F.col(total) < 20, "Small").when(F.col(total) <= 50, "Medium").otherwise("Large")


def payment_category(method: str) -> Column:
    """Credit Card for the card brands in any case, else Other."""
    return F.when(F.lower(method).isin(*CARD_BRANDS), "Credit Card").otherwise("Other")


# Domain lists of the e-mail classes.
BUSINESS_DOMAINS = ("company.com", "corp.com", "business.com", "enterprise.com")
CONSUMER_DOMAINS = ("gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com")


def email_class(email: str) -> Column:
    """Business, Consumer, Educational, Government or Other from the domain; Unknown without one."""
    domain = F.lower(F.split_part(F.col(email), F.lit("@"), F.lit(2)))
    return (
        F.when(F.col(email).isNull() | ~F.contains(F.col(email), F.lit("@")), "Unknown")
        .when(domain.isin(*BUSINESS_DOMAINS) | domain.contains("corp") | domain.contains("company"), "Business")
        .when(domain.isin(*CONSUMER_DOMAINS), "Consumer")
        .when(domain.contains("edu"), "Educational")
        .when(domain.endswith(".gov"), "Government")
        .otherwise("Other")
    )


def shares(key: Column, parts: Sequence[tuple[int, str]]) -> Column:
    """A tag per row with the given shares in %, decided by the key: the same on every run."""
    place = F.pmod(key, F.lit(100))
    label, upto = F, 0
    for percent, name in parts[:-1]:
        upto += percent
        label = label.when(place < upto, name)
    return label.otherwise(parts[-1][1])


# Sales channels with their shares in %.
TRAFFIC_SOURCES = (
    (40, "walk-in"), (25, "online-order"), (20, "delivery-app"), (10, "phone-order"), (5, "social-media"),
)
