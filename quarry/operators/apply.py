"""Apply fitted artifacts: impute, clip/drop outliers, normalise.

The artifact frame is tiny (a handful of rows per column), so it is collected
once and its values are inlined as literals; Catalyst folds them and the whole
transform is a single codegen'd projection (plus one filter in drop mode).  The
same expressions work on batch and streaming DataFrames.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..registry import select_existing
from .fit import as_double


@dataclass
class Artifacts:
    """Driver-side view of the artifact frame: ``stats[stat][column] = value``."""

    stats: dict[str, dict[str, float | None]] = field(default_factory=dict)

    @classmethod
    def from_frame(cls, art: DataFrame) -> "Artifacts":
        out: dict[str, dict[str, float | None]] = {}
        # bounded: at most ~15 rows per fitted column
        for r in art.select("column", "stat", "value").collect():
            out.setdefault(r["stat"], {})[r["column"]] = r["value"]
        return cls(out)

    def get(self, stat: str) -> dict[str, float | None]:
        return self.stats.get(stat, {})

    @property
    def columns(self) -> set[str]:
        return {c for d in self.stats.values() for c in d}


def _art(a) -> Artifacts:
    return a if isinstance(a, Artifacts) else Artifacts.from_frame(a)


def _clip(x: Column, lo, hi) -> Column:
    """Clip keeping NULL as NULL (``greatest``/``least`` would turn NULL into a bound)."""
    if lo is not None:
        x = F.when(x < F.lit(lo), F.lit(float(lo))).otherwise(x)
    if hi is not None:
        x = F.when(x > F.lit(hi), F.lit(float(hi))).otherwise(x)
    return x


def impute_exprs(df: DataFrame, a: Artifacts, target: list[str]) -> tuple[dict[str, Column], dict[str, Column]]:
    """(value expressions, indicator expressions)."""
    med, zero, ind = a.get("median"), a.get("zero_fill"), a.get("missing_indicator")
    values: dict[str, Column] = {}
    flags: dict[str, Column] = {}
    for c in sorted(ind):
        if c in target and f"{c}__is_missing" not in df.columns:
            flags[f"{c}__is_missing"] = as_double(df, c).isNull().cast("tinyint")
    for c in target:
        if c in med or c in zero:
            x = as_double(df, c)
            if c in med and med[c] is not None:
                x = F.coalesce(x, F.lit(float(med[c])))
            if c in zero:
                x = F.coalesce(x, F.lit(0.0))
            values[c] = x
    return values, flags


def impute(df: DataFrame, artifacts, cols=None) -> DataFrame:
    a = _art(artifacts)
    target = select_existing(df, cols if cols is not None else sorted(a.columns))
    values, flags = impute_exprs(df, a, target)
    return df.withColumns({**flags, **values}) if (flags or values) else df


def outlier_exprs(df: DataFrame, a: Artifacts, target: list[str], base: dict[str, Column] | None = None,
                  mode: str = "clip") -> dict[str, Column]:
    """Hard clip first; in clip mode then percentile / IQR clip."""
    if mode not in {"clip", "drop"}:
        raise ValueError("mode must be 'clip' or 'drop'")
    base = dict(base or {})
    hmin, hmax = a.get("hard_min"), a.get("hard_max")
    plo, phi = a.get("pctl_low"), a.get("pctl_high")
    ilo, ihi = a.get("iqr_low"), a.get("iqr_high")
    out: dict[str, Column] = {}
    for c in target:
        if not (c in hmin or c in plo or c in ilo):
            continue
        x = base.get(c, as_double(df, c))
        if c in hmin and (hmin[c] is not None or hmax.get(c) is not None):
            x = _clip(x, hmin[c], hmax.get(c))
        if mode == "clip":
            for lo_d, hi_d in ((plo, phi), (ilo, ihi)):
                if c in lo_d:
                    x = _clip(x, lo_d[c], hi_d.get(c))
        out[c] = x
    return out


def drop_mask(a: Artifacts, target: list[str]) -> Column | None:
    """Keep rows inside every bound (inclusive) or NULL, over the named columns."""
    mask: Column | None = None
    for lo_d, hi_d in ((a.get("pctl_low"), a.get("pctl_high")), (a.get("iqr_low"), a.get("iqr_high"))):
        for c in target:
            if c not in lo_d:
                continue
            lo, hi = lo_d[c], hi_d.get(c)
            x = F.col(c)
            inside = F.lit(True)
            if lo is not None:
                inside = inside & (x >= F.lit(float(lo)))
            if hi is not None:
                inside = inside & (x <= F.lit(float(hi)))
            keep = x.isNull() | inside
            mask = keep if mask is None else (mask & keep)
    return mask


def handle_outliers(df: DataFrame, artifacts, cols=None, *, mode: str = "clip") -> DataFrame:
    a = _art(artifacts)
    target = select_existing(df, cols if cols is not None else sorted(a.columns))
    values = outlier_exprs(df, a, target, mode=mode)
    out = df.withColumns(values) if values else df
    mask = drop_mask(a, target) if mode == "drop" else None
    return out.where(mask) if mask is not None else out


def normalize_exprs(df: DataFrame, a: Artifacts, target: list[str],
                    base: dict[str, Column] | None = None) -> dict[str, Column]:
    """Z2/Z4/Z6."""
    base = dict(base or {})
    shift, med, iqr = a.get("log1p_shift"), a.get("robust_median"), a.get("robust_iqr")
    mn, mx = a.get("minmax_min"), a.get("minmax_max")
    out: dict[str, Column] = {}
    for c in target:
        x = base.get(c)
        if c in shift:
            x = as_double(df, c) if x is None else x
            s = shift[c] or 0.0
            out[c] = F.log1p(x + F.lit(float(s)) if s else x)
        elif c in med:
            x = as_double(df, c) if x is None else x
            q = iqr.get(c)
            q = 1.0 if (q is None or q != q or q in (0.0, float("inf"), float("-inf"))) else q
            m = med[c]
            out[c] = (x - F.lit(m).cast("double")) / F.lit(float(q))
        elif c in mn:
            x = as_double(df, c) if x is None else x
            lo, hi = mn[c], mx.get(c)
            denom = (hi - lo) if (lo is not None and hi is not None) else None
            if denom is None or denom != denom or denom == 0.0 or abs(denom) == float("inf"):
                denom = 1.0
            out[c] = (x - F.lit(lo).cast("double")) / F.lit(float(denom))
    return out


def normalize(df: DataFrame, artifacts, cols=None) -> DataFrame:
    a = _art(artifacts)
    target = select_existing(df, cols if cols is not None else sorted(a.columns))
    values = normalize_exprs(df, a, target)
    return df.withColumns(values) if values else df


def transform(df: DataFrame, artifacts, cols=None, *, mode: str = "clip", keep: list[str] | None = None) -> DataFrame:
    """G1 apply side: project ``cols`` (Q1) -> impute -> outliers -> normalise.

    One projection in clip mode; projection + filter + projection in drop mode.
    ``keep`` lists extra pass-through columns (e.g. a key) placed first.
    """
    a = _art(artifacts)
    target = select_existing(df, cols if cols is not None else sorted(a.columns))
    keep = [k for k in (keep or []) if k in df.columns and k not in target]
    imp, flags = impute_exprs(df, a, target)
    clipped = outlier_exprs(df, a, target, base=imp, mode=mode)
    stage1 = {c: clipped.get(c, imp.get(c, F.col(c))) for c in target}
    mask = drop_mask(a, target) if mode == "drop" else None
    if mask is not None:
        staged = df.select(*keep, *[stage1[c].alias(c) for c in target],
                           *[v.alias(k) for k, v in flags.items()]).where(mask)
        norm = normalize_exprs(staged, a, target, base={c: F.col(c) for c in target})
        return staged.select(*keep, *[norm.get(c, F.col(c)).alias(c) for c in target], *list(flags))
    norm = normalize_exprs(df, a, target, base=stage1)
    return df.select(*keep, *[norm.get(c, stage1[c]).alias(c) for c in target],
                     *[v.alias(k) for k, v in flags.items()])


__all__ = ["Artifacts", "impute", "handle_outliers", "normalize", "transform",
           "impute_exprs", "outlier_exprs", "drop_mask", "normalize_exprs"]
