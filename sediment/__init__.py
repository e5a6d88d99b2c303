"""Layered (landing -> bronze -> silver -> gold) processing on Spark DataFrames.

Sub-packages
------------
``functions``   named column transforms and validators
``sources``     readers, writers, keyed merge, file manifests
``operators``   mapping, joins, aggregation, rolling windows, quality, anomalies,
                events and audit-table lookups
``plans``       layer runs and step lists built from declarative specs
``streaming``   file/topic ingestion, alert flow, windowed metrics
"""

from sediment.config import (
    AggregationRule,
    AnomalyConfig,
    ColumnTransformation,
    InputFormat,
    PipelineConfig,
    QualityRule,
    StorageFormat,
    load_spec,
)
from sediment.session import build_session, materialize, scratch_root

__all__ = [
    "AggregationRule",
    "AnomalyConfig",
    "ColumnTransformation",
    "InputFormat",
    "PipelineConfig",
    "QualityRule",
    "StorageFormat",
    "build_session",
    "load_spec",
    "materialize",
    "scratch_root",
]
