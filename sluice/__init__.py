"""Configuration-driven stream and batch processing on Spark."""

from sluice.operators.aggregate import aggregate_rows
from sluice.operators.enrich import dedup, heavy_keys, latest_per_key, lookup_enrich
from sluice.operators.filter import filter_rows
from sluice.operators.inference import infer, register_scorer
from sluice.operators.payloads import build_requests, parse_responses
from sluice.operators.transform import transform_rows
from sluice.plans.chain import Chain
from sluice.plans.job import batch_result, ensure_table, run_batch
from sluice.schema import conform
from sluice.sinks.keyed import KeyedTable
from sluice.sources.config_tables import ConfigTables
from sluice.sources.decode import decode_json
from sluice.sources.messages import read_files, read_kafka
from sluice.spec import (
    AggregateRule,
    ConfigError,
    FilterRule,
    InferenceSpec,
    JobSpec,
    StepSpec,
    TableSchema,
    TransformRule,
)
from sluice.streaming.runner import run_job, run_reloading, run_stream, start_quarantine

__all__ = [
    "AggregateRule",
    "Chain",
    "ConfigError",
    "ConfigTables",
    "FilterRule",
    "InferenceSpec",
    "JobSpec",
    "KeyedTable",
    "StepSpec",
    "TableSchema",
    "TransformRule",
    "aggregate_rows",
    "batch_result",
    "build_requests",
    "conform",
    "decode_json",
    "dedup",
    "ensure_table",
    "filter_rows",
    "heavy_keys",
    "infer",
    "latest_per_key",
    "lookup_enrich",
    "parse_responses",
    "read_files",
    "read_kafka",
    "register_scorer",
    "run_batch",
    "run_job",
    "run_reloading",
    "run_stream",
    "start_quarantine",
    "transform_rows",
]
