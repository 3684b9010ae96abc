"""Row rules as Column expressions (all inside whole-stage codegen)."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Euro per unit of local currency.
EUR_RATES = {"EUR": "1.0", "GBP": "1.17", "CHF": "1.05", "PLN": "0.22", "SEK": "0.095"}

# Code, region, currency, euro member, liquidity risk.
COUNTRY_PROFILES = {
    "Germany": ("DEU", "Western Europe", "EUR", "Y", "Low"),
    "France": ("FRA", "Western Europe", "EUR", "Y", "Low"),
    "United Kingdom": ("GBR", "Western Europe", "GBP", "N", "Medium"),
    "Switzerland": ("CHE", "Western Europe", "CHF", "N", "Low"),
    "Italy": ("ITA", "Southern Europe", "EUR", "Y", "High"),
    "Spain": ("ESP", "Southern Europe", "EUR", "Y", "High"),
    "Poland": ("POL", "Eastern Europe", "PLN", "N", "Medium"),
    "Sweden": ("SWE", "Northern Europe", "SEK", "N", "Low"),
}
COUNTRY_DEFAULT = ("UNK", "Other", "EUR", "N", "Unknown")

# Words in a subsidiary name and the business line they stand for, first hit wins.
BUSINESS_LINES = [
    (("Retail", "Consumer"), "Retail Banking"),
    (("Corporate", "SME", "Commercial"), "Corporate Banking"),
    (("Investment", "Trading"), "Investment Banking"),
    (("Asset Management",), "Asset Management"),
    (("Private Banking", "Wealth"), "Private Banking"),
    (("Holdings",), "Holdings"),
    (("Digital",), "Digital Banking"),
]

# Category domains.
HQLA_LEVELS = ["Level 1", "Level 2A", "Level 2B"]
QUALITY_RATINGS = ["A", "B", "C", "D"]
QUALITY_SCORES = {"A": 4, "B": 3, "C": 2, "D": 1}
STABLE_MATURITIES = ["180-day", "1-year", ">1-year"]
LEVEL_1_HAIRCUT = "0"
LEVEL_2A_HAIRCUT = "0.15"
LEVEL_2B_HAIRCUTS = ("0.25", "0.50")


def _number(text: str) -> Column:
    return F.lit(Decimal(text))


def choose(value: Column, options: dict, default=None) -> Column:
    """`options[value]` as a CASE expression; `default` for anything else."""
    picked = None
    for key, result in options.items():
        result = result if isinstance(result, Column) else F.lit(result)
        picked = (F if picked is None else picked).when(value == key, result)
    return picked.otherwise(F.lit(default))


def yes_no(condition: Column) -> Column:
    return F.when(condition, "Y").otherwise("N")


def country_profile(country: Column) -> dict[str, Column]:
    names = ["country_code", "region", "currency", "is_eurozone", "liquidity_risk_category"]
    return {
        name: choose(
            country, {c: row[i] for c, row in COUNTRY_PROFILES.items()}, COUNTRY_DEFAULT[i]
        )
        for i, name in enumerate(names)
    }


def subsidiary_type(name: Column) -> Column:
    line = F
    for words, label in BUSINESS_LINES:
        hit = name.contains(words[0])
        for word in words[1:]:
            hit = hit | name.contains(word)
        line = line.when(hit, label)
    return line.otherwise("Other")


def fx_to_eur(amount: Column, currency: Column) -> Column:
    """Local amount in euro, two decimals; NULL for a currency without a rate."""
    rate = choose(currency, {c: _number(r).cast("decimal(8,4)") for c, r in EUR_RATES.items()})
    return F.round(amount * rate, 2).cast("decimal(18,2)")


def hqla_haircut_rate(level: Column, level_2b_rate: Column) -> Column:
    """Haircut by level; Level 2B carries one of two rates, which the caller knows."""
    return (
        F.when(level == "Level 1", _number(LEVEL_1_HAIRCUT).cast("decimal(8,4)"))
        .when(level == "Level 2A", _number(LEVEL_2A_HAIRCUT).cast("decimal(8,4)"))
        .otherwise(level_2b_rate.cast("decimal(8,4)"))
    )


def haircut_fits_level(level: Column, haircut: Column) -> Column:
    low, high = map(_number, LEVEL_2B_HAIRCUTS)
    return (
        F.when(level == "Level 1", haircut == _number(LEVEL_1_HAIRCUT))
        .when(level == "Level 2A", haircut == _number(LEVEL_2A_HAIRCUT))
        .when(level == "Level 2B", haircut.between(low, high))
        .otherwise(False)
    )


def after_haircut(value: Column, haircut: Column) -> Column:
    """Value left once the haircut is taken off, two decimals."""
    return F.round(value * (F.lit(1) - haircut), 2).cast("decimal(18,2)")


def quality_adjusted_haircut(rating: Column, haircut: Column) -> Column:
    """Haircut raised for poor ratings, up to a ceiling; not rounded.  An unknown haircut stays unknown."""
    kind = "decimal(9,5)"
    return (
        F.when(haircut.isNull(), F.lit(None).cast(kind))
        .when(rating == "D", F.least(_number("0.60").cast(kind), (haircut * _number("1.5")).cast(kind)))
        .when(rating == "C", F.least(_number("0.45").cast(kind), (haircut * _number("1.2")).cast(kind)))
        .otherwise(haircut.cast(kind))
    )


def stable_funding_flag(maturity: Column) -> Column:
    return yes_no(maturity.isin(STABLE_MATURITIES))


def business_key(prefix: str, country: Column, number: Column) -> Column:
    """Prefix, three letters of the country and the number with at least six digits."""
    digits = number.cast("string")
    # lpad would cut numbers longer than its width
    padded = F.when(F.length(digits) >= 6, digits).otherwise(F.lpad(digits, 6, "0"))
    return F.concat(F.lit(prefix), F.upper(F.substring(country, 1, 3)), padded)


def next_review_date(valuation_date: Column, days: Column) -> Column:
    return F.date_add(valuation_date, days)


def quality_score(rating: Column) -> Column:
    return choose(rating, QUALITY_SCORES, 0)
