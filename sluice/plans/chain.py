"""An ordered chain of steps, built from a job's rules or by hand.

A step is any function from DataFrame to DataFrame. The chain is compiled against the schema each
step really gets, so it runs the same on a batch and on a stream.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame

from sluice.operators.aggregate import WINDOW_COLUMN, aggregate_rows
from sluice.operators.filter import filter_rows
from sluice.operators.inference import ScorerFactory, infer, scorer_factory
from sluice.operators.transform import transform_rows
from sluice.sources.messages import SOURCE_COLUMN
from sluice.spec import AggregateRule, ConfigError, FilterRule, JobSpec, StepSpec, TableSchema, TransformRule

Step = Callable[[DataFrame], DataFrame]

# Columns the engine carries for its own use; they never reach a caller or a table.
HIDDEN_COLUMNS = (SOURCE_COLUMN, WINDOW_COLUMN)


def _filter_step(spec: StepSpec, schema: TableSchema, scorers) -> Step:
    rule = FilterRule.from_json(spec.config or {})
    return lambda df: filter_rows(df, rule)


def _transform_step(spec: StepSpec, schema: TableSchema, scorers) -> Step:
    rule = TransformRule.from_json(spec.config or {})
    return lambda df: transform_rows(df, rule, declared=schema)


def _aggregate_step(spec: StepSpec, schema: TableSchema, scorers) -> Step:
    rule = AggregateRule.from_json(spec.config or {})
    return lambda df: aggregate_rows(df, rule, keep_window=True)


def _inference_step(spec: StepSpec, schema: TableSchema, scorers) -> Step:
    function = spec.function
    if function is None:
        raise ConfigError("ai-inference: the step has no model function")
    given = scorers.get(function.function_id)
    if given is None:
        scorer_factory(function)  # an unknown function type fails here, not in a task
    return lambda df: infer(df, function, given, declared=schema)


_STEPS = {
    "filter": _filter_step,
    "transform": _transform_step,
    "aggregate": _aggregate_step,
    "ai-inference": _inference_step,
}


def compile_step(spec: StepSpec, schema: TableSchema, scorers: Mapping[str, ScorerFactory] | None = None) -> Step:
    step = _STEPS[spec.type](spec, schema, scorers or {})
    step.__name__ = spec.type
    return step


@dataclass
class Chain:
    """``Chain().add(step).add_all(steps).apply(df)``."""

    steps: list[Step] = field(default_factory=list)

    def add(self, step: Step) -> Chain:
        self.steps.append(step)
        return self

    def add_all(self, steps: Iterable[Step]) -> Chain:
        self.steps.extend(steps)
        return self

    @classmethod
    def from_job(cls, job: JobSpec, scorers: Mapping[str, ScorerFactory] | None = None) -> Chain:
        """The job's rules as a chain; ``scorers`` replaces model functions by id."""
        return cls([compile_step(s, job.schema, scorers) for s in job.steps])

    def apply(self, df: DataFrame, keep_hidden: bool = False) -> DataFrame:
        """Fold the steps over ``df``; nothing runs yet."""
        out = reduce(lambda rows, step: rows.transform(step), self.steps, df)
        return out if keep_hidden else out.drop(*HIDDEN_COLUMNS)
