"""Column contracts of the datasets that travel between stages."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Columns each stage may rely on. Types are the ones the stages produce.
SESSION_KEYS = ["session_id", "did", "country", "source"]
MODEL_KEYS = ["model_date", "model_type", "is_main_model"]

# Evidence list carried by trend-applied estimates.
ANCHORS_TYPE = (
    "array<struct<trend_id:struct<type:string,anchor_dates:string>,"
    "trend:double,p:double,w:double>>"
)


def require(df: DataFrame, *columns: str) -> DataFrame:
    """Return ``df`` unchanged, or fail early when a needed column is absent."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; present: {df.columns}")
    return df
