"""Column registry: semantic metric + per-column cleaning policy.

Policies are plain driver-side metadata.  Everything that touches data takes a
``{column: ColumnStrategy}`` map, so the same fit/apply code runs on any
DataFrame, not only on the listing schema below.
"""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Metric(str, Enum):
    AMOUNT = "amount"
    PRICE = "price"
    PERCENTAGE = "percentage"
    RATIO = "ratio"
    TIMES = "times"
    COUNT = "count"
    DATE = "date"
    TEXT = "text"


class ImputerPolicy(str, Enum):
    NONE = "none"
    MEDIAN = "median"
    ZERO = "zero"
    MEDIAN_WITH_MISSING_INDICATOR = "median_with_missing_indicator"
    ZERO_WITH_MISSING_INDICATOR = "zero_with_missing_indicator"


class OutlierPolicy(str, Enum):
    NONE = "none"
    IQR_FILTER = "iqr_filter"
    PCTL_FILTER = "percentile_filter"
    PCTL_CLIP = "percentile_clip"
    CLIP_THEN_PCTL_CLIP = "clip_then_percentile_clip"


class NormalizationPolicy(str, Enum):
    NONE = "none"
    LOG1P = "log1p"
    ROBUST_Z = "robust_z"
    MINMAX = "minmax"


@dataclass(frozen=True)
class ColumnStrategy:
    imputer: ImputerPolicy = ImputerPolicy.NONE
    outlier: OutlierPolicy = OutlierPolicy.NONE
    normalization: NormalizationPolicy = NormalizationPolicy.NONE
    pctl_low: float = 0.01
    pctl_high: float = 0.99
    iqr_k: float = 1.5
    hard_min: float | None = None
    hard_max: float | None = None

    @property
    def is_numeric(self) -> bool:
        return (self.imputer != ImputerPolicy.NONE or self.outlier != OutlierPolicy.NONE
                or self.normalization != NormalizationPolicy.NONE)


I, O, N = ImputerPolicy, OutlierPolicy, NormalizationPolicy

# ---- fixed values: default strategies per metric -------------------------------------------
AMOUNT_DEFAULT = ColumnStrategy(I.MEDIAN, O.IQR_FILTER, N.LOG1P)
PRICE_DEFAULT = ColumnStrategy(I.MEDIAN, O.PCTL_FILTER, N.LOG1P)
PERCENT_DEFAULT = ColumnStrategy(I.MEDIAN, O.PCTL_FILTER, N.ROBUST_Z)
RATIO_DEFAULT = ColumnStrategy(I.MEDIAN, O.PCTL_CLIP, N.ROBUST_Z)
UNTOUCHED = ColumnStrategy()

DEFAULT_BY_METRIC = {
    Metric.AMOUNT: AMOUNT_DEFAULT,
    Metric.PRICE: PRICE_DEFAULT,
    Metric.PERCENTAGE: PERCENT_DEFAULT,
    Metric.RATIO: RATIO_DEFAULT,
    Metric.TIMES: RATIO_DEFAULT,
    Metric.COUNT: UNTOUCHED,
    Metric.DATE: UNTOUCHED,
    Metric.TEXT: UNTOUCHED,
}


def default_strategy_for(metric: Metric) -> ColumnStrategy:
    """Default policy for a metric."""
    return DEFAULT_BY_METRIC.get(Metric(metric), UNTOUCHED)


# ---- fixed values: presets used by the listing registry ------------------------------------
WINSORISED_ROBUST = ColumnStrategy(I.MEDIAN, O.PCTL_CLIP, N.ROBUST_Z)
WINSORISED_RAW = ColumnStrategy(I.MEDIAN, O.PCTL_CLIP, N.NONE)
BOUNDED_PERCENT = ColumnStrategy(I.MEDIAN, O.CLIP_THEN_PCTL_CLIP, N.ROBUST_Z, hard_min=0.0, hard_max=100.0)
TIMES_ZERO = ColumnStrategy(I.ZERO, O.PCTL_CLIP, N.ROBUST_Z, hard_min=0.0)
ALLOCATION_ZERO = ColumnStrategy(I.ZERO, O.CLIP_THEN_PCTL_CLIP, N.ROBUST_Z, hard_min=0.0, hard_max=100.0)


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    metric: Metric
    strategy: ColumnStrategy


M = Metric
# ---- fixed values: the 53 listing columns in registry order (name, metric, strategy) -------
LISTING_COLUMNS: list[ColumnSpec] = [ColumnSpec(n, m, s) for n, m, s in [
    ("assets", M.AMOUNT, AMOUNT_DEFAULT),
    ("net_worth", M.AMOUNT, AMOUNT_DEFAULT),
    ("total_debt", M.AMOUNT, AMOUNT_DEFAULT),
    ("revenue", M.AMOUNT, AMOUNT_DEFAULT),
    ("ebitda", M.AMOUNT, AMOUNT_DEFAULT),
    ("pat", M.AMOUNT, AMOUNT_DEFAULT),
    ("ebitda_margin", M.PERCENTAGE, WINSORISED_ROBUST),
    ("pat_margin", M.PERCENTAGE, WINSORISED_ROBUST),
    ("eps", M.PRICE, PRICE_DEFAULT),
    ("roe", M.PERCENTAGE, WINSORISED_ROBUST),
    ("roce", M.PERCENTAGE, WINSORISED_ROBUST),
    ("roa", M.PERCENTAGE, WINSORISED_ROBUST),
    ("debt_to_equity", M.RATIO, WINSORISED_ROBUST),
    ("market_capitalisation", M.AMOUNT, AMOUNT_DEFAULT),
    ("enterprise_value", M.AMOUNT, AMOUNT_DEFAULT),
    ("ev_ebitda", M.TIMES, WINSORISED_ROBUST),
    ("pe_multiple", M.TIMES, WINSORISED_ROBUST),
    ("pb_multiple", M.TIMES, WINSORISED_ROBUST),
    ("nav", M.PRICE, PRICE_DEFAULT),
    ("company", M.TEXT, UNTOUCHED),
    ("ipo_open_gmp", M.PRICE, WINSORISED_RAW),
    ("ipo_close_gmp", M.PRICE, WINSORISED_RAW),
    ("ipo_allotment_gmp", M.PRICE, WINSORISED_RAW),
    ("ipo_listing_gmp", M.PRICE, WINSORISED_RAW),
    ("ipo_category", M.TEXT, UNTOUCHED),
    ("exchange", M.TEXT, UNTOUCHED),
    ("issue_type", M.TEXT, UNTOUCHED),
    ("ipo_size", M.AMOUNT, AMOUNT_DEFAULT),
    ("issue_price", M.PRICE, PRICE_DEFAULT),
    ("face_value", M.PRICE, PRICE_DEFAULT),
    ("pre_issue_promoter_holding", M.PERCENTAGE, BOUNDED_PERCENT),
    ("post_issue_promoter_holding", M.PERCENTAGE, BOUNDED_PERCENT),
    ("dhrp_date", M.DATE, UNTOUCHED),
    ("open_date", M.DATE, UNTOUCHED),
    ("close_date", M.DATE, UNTOUCHED),
    ("allotment_date", M.DATE, UNTOUCHED),
    ("listing_date", M.DATE, UNTOUCHED),
    ("object_of_issue", M.TEXT, UNTOUCHED),
    ("listing_price", M.PRICE, UNTOUCHED),
    ("listing_gain", M.PRICE, UNTOUCHED),
    ("current_market_price", M.PRICE, PRICE_DEFAULT),
    ("subscription", M.TIMES, TIMES_ZERO),
    ("allocation_total_ipo_subscription", M.PERCENTAGE, ALLOCATION_ZERO),
    ("subscription_qib", M.TIMES, TIMES_ZERO),
    ("allocation_qib", M.PERCENTAGE, ALLOCATION_ZERO),
    ("subscription_retail_investors", M.TIMES, TIMES_ZERO),
    ("allocation_retail_investors", M.PERCENTAGE, ALLOCATION_ZERO),
    ("subscription_employees", M.TIMES, TIMES_ZERO),
    ("allocation_employees", M.PERCENTAGE, ALLOCATION_ZERO),
    ("subscription_snii_bids_below_10l", M.TIMES, TIMES_ZERO),
    ("allocation_snii_bids_below_10l", M.PERCENTAGE, ALLOCATION_ZERO),
    ("subscription_bnii_bids_above_10l", M.TIMES, TIMES_ZERO),
    ("allocation_bnii_bids_above_10l", M.PERCENTAGE, ALLOCATION_ZERO),
]]


class Registry:
    """An ordered, extensible list of column specs."""

    def __init__(self, specs: list[ColumnSpec] | None = None):
        self.specs = list(LISTING_COLUMNS if specs is None else specs)

    def extend(self, specs: list[ColumnSpec]) -> "Registry":
        known = {s.name for s in specs}
        return Registry([s for s in self.specs if s.name not in known] + list(specs))

    def names(self) -> list[str]:
        return [s.name for s in self.specs]

    def field_names(self, metric: Metric) -> list[str]:
        return [s.name for s in self.specs if s.metric == Metric(metric)]

    def by_imputer(self, policy: ImputerPolicy) -> list[str]:
        return [s.name for s in self.specs if s.strategy.imputer == ImputerPolicy(policy)]

    def by_outlier(self, policy: OutlierPolicy) -> list[str]:
        return [s.name for s in self.specs if s.strategy.outlier == OutlierPolicy(policy)]

    def by_normalization(self, policy: NormalizationPolicy) -> list[str]:
        return [s.name for s in self.specs if s.strategy.normalization == NormalizationPolicy(policy)]

    def strategy_map(self) -> dict[str, ColumnStrategy]:
        return {s.name: s.strategy for s in self.specs}

    def to_dataframe(self, spark: SparkSession) -> DataFrame:
        """The registry as a small table (one row per column) for SQL-side look-ups."""
        rows = [(i, s.name, s.metric.value, s.strategy.imputer.value, s.strategy.outlier.value,
                 s.strategy.normalization.value, s.strategy.pctl_low, s.strategy.pctl_high,
                 s.strategy.iqr_k, s.strategy.hard_min, s.strategy.hard_max)
                for i, s in enumerate(self.specs)]
        schema = ("pos INT, column STRING, metric STRING, imputer STRING, outlier STRING, "
                  "normalization STRING, pctl_low DOUBLE, pctl_high DOUBLE, iqr_k DOUBLE, "
                  "hard_min DOUBLE, hard_max DOUBLE")
        return spark.createDataFrame(rows, schema)


def group_cols_by_policy(df: DataFrame, strategies: dict[str, ColumnStrategy],
                         cols: list[str] | None = None) -> dict[str, list[str]]:
    """{imputer policy: [columns present in df]} (driver-side metadata only)."""
    out: dict[str, list[str]] = {}
    for c in select_existing(df, cols if cols is not None else list(strategies)):
        s = strategies.get(c)
        if s is not None:
            out.setdefault(s.imputer.value, []).append(c)
    return out


def policy_groups_frame(registry: Registry, spark: SparkSession, policy: str = "imputer") -> DataFrame:
    """G4 as a Spark job over the registry table: policy -> ordered column list."""
    reg = registry.to_dataframe(spark)
    return (reg.groupBy(policy)
            .agg(F.sort_array(F.collect_list(F.struct("pos", "column"))).alias("cols"))
            .select(F.col(policy).alias("policy"), F.transform("cols", lambda x: x["column"]).alias("columns")))


def select_existing(df: DataFrame, cols) -> list[str]:
    """Q1: requested columns that exist in ``df``, in request order (names or ColumnSpecs)."""
    present = set(df.columns)
    names = [c.name if isinstance(c, ColumnSpec) else c for c in cols]
    return [c for c in names if c in present]
