"""Trip features, null fill, leakage guard (P5-P10) and MLlib feature stages (E-F1..E-F6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import constants as C
from ..functions.trip_columns import PICKUP, duration_minutes
from .quality import apply_rules, prepared_rules
from .strata import with_strata


def with_trip_features(df: DataFrame) -> DataFrame:
    """trip_duration_min (P5), pickup_hour (P6), pickup_dow."""
    return df.select("*", duration_minutes().alias("trip_duration_min"),
                     F.hour(PICKUP).alias("pickup_hour"), F.dayofweek(PICKUP).alias("pickup_dow"))


def impute(df: DataFrame, defaults: Mapping[str, float] = C.IMPUTE_DEFAULTS) -> DataFrame:
    """Constant null fill."""
    return df.fillna(dict(defaults))


def prepared(df: DataFrame, max_minutes: float = 180.0, max_fare: float = 500.0,
             pax_range: tuple[float, float] = (1, 6),
             defaults: Mapping[str, float] = C.IMPUTE_DEFAULTS) -> DataFrame:
    """Silver/strata rows → features → null fill → rules F9-F11.

    The passenger rule runs after the fill, so a null count becomes 1 and is
    kept while a zero is rejected.
    """
    if "stratum" not in df.columns:
        df = with_strata(df)
    return apply_rules(impute(with_trip_features(df), defaults),
                       prepared_rules(max_minutes, max_fare, pax_range))


def check_no_leakage(cols: Sequence[str], banned: Sequence[str] = C.LEAKAGE_COLUMNS) -> None:
    """Raise if a label-leaking column is requested as a feature (P10)."""
    bad = sorted(set(cols) & set(banned))
    if bad:
        raise ValueError(f"leakage: {bad} may not be used as features")


# ---------------------------------------------------------------- MLlib stages
def label_indexer(label_col: str = "pay_class", output: str = "label") -> StringIndexer:
    """Label indexing, frequency descending, ties alphabetical; unseen → error (E-F1)."""
    return StringIndexer(inputCol=label_col, outputCol=output, handleInvalid="error",
                         stringOrderType="frequencyDesc")


def categorical_stages(cols: Sequence[str] = C.CATEGORICAL_FEATURES):
    """Index (unseen → extra bucket) and one-hot (dropLast drops it) (E-F2, E-F3)."""
    cols = list(cols)
    idx = [StringIndexer(inputCols=cols, outputCols=[f"{c}_idx" for c in cols], handleInvalid="keep",
                         stringOrderType="frequencyDesc")]      # one pass for all columns
    ohe = [OneHotEncoder(inputCols=[f"{c}_idx" for c in cols], outputCols=[f"{c}_ohe" for c in cols],
                         dropLast=True)]
    return idx, ohe


def feature_stages(numeric: Sequence[str] = C.NUMERIC_FEATURES,
                   categorical: Sequence[str] = C.CATEGORICAL_FEATURES,
                   output: str = "features"):
    """index → one-hot → assemble (E-F2..E-F4). Nulls reaching the assembler raise."""
    check_no_leakage(list(numeric) + list(categorical))
    idx, ohe = categorical_stages(categorical)
    asm = VectorAssembler(inputCols=list(numeric) + [f"{c}_ohe" for c in categorical],
                          outputCol=output, handleInvalid="error")
    return idx + ohe + [asm]


def fit_features(df: DataFrame, numeric: Sequence[str] = C.NUMERIC_FEATURES,
                 categorical: Sequence[str] = C.CATEGORICAL_FEATURES,
                 output: str = "features") -> PipelineModel:
    return Pipeline(stages=feature_stages(numeric, categorical, output)).fit(df)


def feature_names(df: DataFrame, vec_col: str = "features") -> list[str]:
    """Slot names from the vector's ml_attr metadata; ``f{i}`` where missing (E-F6)."""
    meta = df.schema[vec_col].metadata.get("ml_attr", {})
    size = meta.get("num_attrs")
    attrs = [a for group in meta.get("attrs", {}).values() for a in group]
    if size is None:
        size = (max(a["idx"] for a in attrs) + 1) if attrs else 0
    names = [None] * size
    for a in attrs:
        if a["idx"] < size:
            names[a["idx"]] = a.get("name")
    return [n if n else f"f{i}" for i, n in enumerate(names)]


def vector_columns(df: DataFrame, vec_col: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Explode a vector into named double columns (JVM-side)."""
    arr = vector_to_array(F.col(vec_col))
    return df.select(*keep, *[arr[i].alias(n) for i, n in enumerate(names)])


def fit_scaler(df: DataFrame, cols: Sequence[str] = C.CLUSTER_FEATURES,
               raw: str = "features_raw", output: str = "features_scaled") -> PipelineModel:
    """Assemble + centre + divide by the sample stddev (E-F5)."""
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(cols), outputCol=raw, handleInvalid="error"),
        StandardScaler(inputCol=raw, outputCol=output, withMean=True, withStd=True),
    ]).fit(df)
