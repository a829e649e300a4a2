"""Gold features: fit once on the raw input, then one projection per feature group.

G1 fits all three artifacts on the *raw* frame (one aggregation job), then
applies select -> impute -> clip -> normalise as one projection.  G2 shares a
single fit across all feature groups: the union of their columns is fitted in
one pass and every group is a cheap projection of the same artifacts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators.apply import Artifacts, transform
from ..operators.fit import fit
from ..registry import (AMOUNT_DEFAULT, PRICE_DEFAULT, WINSORISED_ROBUST, ColumnStrategy,
                        ImputerPolicy, NormalizationPolicy, OutlierPolicy, Registry, select_existing)

# ---- fixed values: listing feature groups (names and member columns) ------------------------
FEATURE_GROUPS: dict[str, list[str]] = {
    "pricing_capital_structure": ["issue_price", "face_value", "market_capitalisation", "enterprise_value",
                                  "assets", "net_worth", "total_debt"],
    "profitability_fundamentals": ["revenue", "ebitda", "pat", "eps"],
    "efficiency_quality_ratios": ["roa", "roe", "roce", "ebitda_margin", "pat_margin", "debt_to_equity"],
    "valuation_multiples": ["pe_multiple", "pb_multiple", "ev_ebitda"],
    "demand_market_sentiment": ["ipo_open_gmp", "ipo_close_gmp", "ipo_allotment_gmp", "subscription",
                                "subscription_qib", "subscription_retail_investors",
                                "subscription_bnii_bids_above_10l", "subscription_snii_bids_below_10l"],
    "all_cols": Registry().names(),
    "custom": ["pat", "pat_margin", "ebitda", "ebitda_margin", "assets", "net_worth", "total_debt", "revenue",
               "enterprise_value", "market_capitalisation", "nav", "roe", "roa", "roce", "pe_multiple",
               "pb_multiple", "ev_ebitda", "debt_to_equity", "eps", "pre_issue_promoter_holding",
               "post_issue_promoter_holding", "subscription", "face_value", "issue_price"],
}

# ---- fixed values: exploratory feature groups, incl. labels kept out of training (G3) -------
EDA_FEATURE_GROUPS: dict[str, list[str]] = {
    "pricing_capital_structure": ["issue_price", "face_value", "assets", "net_worth", "total_debt",
                                  "market_capitalisation", "enterprise_value"],
    "profitability_fundamentals": ["revenue", "ebitda", "pat", "eps"],
    "efficiency_quality_ratios": ["roa", "roe", "roce", "ebitda_margin", "pat_margin", "debt_to_equity"],
    "valuation_multiples": ["pe_multiple", "pb_multiple", "ev_ebitda"],
    "demand_and_market_sentiment": ["ipo_open_gmp", "ipo_close_gmp", "ipo_allotment_gmp", "subscription",
                                    "subscription_qib", "subscription_retail_investors",
                                    "subscription_non_institutional_buyers"],
    "labels": ["listing_price", "listing_gain"],
}

# Policies for the provided ``lineitem`` table: exercises every fit/apply path.
LINEITEM_STRATEGIES: dict[str, ColumnStrategy] = {
    "l_quantity": AMOUNT_DEFAULT,                       # median / IQR fence / log1p
    "l_extendedprice": PRICE_DEFAULT,                   # median / percentile 1-99 / log1p
    "l_discount": WINSORISED_ROBUST,                    # median / percentile clip / robust z
    "l_tax": ColumnStrategy(ImputerPolicy.ZERO_WITH_MISSING_INDICATOR, OutlierPolicy.CLIP_THEN_PCTL_CLIP,
                            NormalizationPolicy.MINMAX, hard_min=0.0, hard_max=0.05),
}


@dataclass
class GoldResult:
    features: DataFrame
    artifacts: DataFrame


def create_gold(df: DataFrame, strategies: dict[str, ColumnStrategy], cols=None, *, mode: str = "clip",
                keep: list[str] | None = None, method: str = "distributed") -> GoldResult:
    """G1: fit on raw ``df`` -> apply to ``df``; returns features and the artifact frame."""
    art = fit(df, strategies, cols, method=method)
    a = Artifacts.from_frame(art)
    target = select_existing(df, cols if cols is not None else list(strategies))
    return GoldResult(transform(df, a, target, mode=mode, keep=keep), art)


def create_gold_groups(df: DataFrame, strategies: dict[str, ColumnStrategy], groups: dict[str, list[str]], *,
                       mode: str = "clip", keep: list[str] | None = None,
                       method: str = "distributed") -> tuple[dict[str, DataFrame], DataFrame]:
    """One shared fit over the union of group columns, one projection per group."""
    union: list[str] = []
    for cols in groups.values():
        union += [c for c in cols if c not in union]
    art = fit(df, strategies, union, method=method)
    a = Artifacts.from_frame(art)
    return {g: transform(df, a, select_existing(df, cols), mode=mode, keep=keep) for g, cols in groups.items()}, art


def feature_group_long(groups: dict[str, list[str]], spark) -> DataFrame:
    """Groups as a small (group, position, column) table."""
    rows = [(g, i, c) for g, cols in groups.items() for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "group STRING, pos INT, column STRING")
