"""Which declared fields of a message a job can ever look at."""

from __future__ import annotations

from collections.abc import Iterable

from sluice.spec import AggregateRule, FieldMapping, FilterRule, JobSpec, StepSpec, TransformRule


def _mapping_inputs(m: FieldMapping) -> set[str] | None:
    """What a mapping reads; None where its text would have to be understood."""
    if m.op == "expr":
        return None
    found = {*m.inputs}
    if m.input is not None:
        found.add(m.input)
    if m.condition is not None:
        found.add(m.condition.field)
    return found


def _before(step: StepSpec, needed: set[str], everything: set[str]) -> set[str]:
    """What must be there before ``step`` so that ``needed`` is right after it."""
    if step.type == "filter":
        return needed | {c.field for c in FilterRule.from_json(step.config or {}).conditions}
    if step.type == "transform":
        mappings = TransformRule.from_json(step.config or {}).mappings
        inputs = [_mapping_inputs(m) for m in mappings]
        if None in inputs:
            return everything
        return (needed - {m.output for m in mappings}).union(*inputs)
    if step.type == "aggregate":
        rule = AggregateRule.from_json(step.config or {})
        times = set() if rule.time_field is None else {rule.time_field}
        return {*rule.key_fields, *times, *(a.input for a in rule.aggregations if a.input is not None)}
    if step.type == "ai-inference" and step.function is not None:
        # its outputs are written whatever becomes of the call
        return (needed - set(step.function.output_fields)) | set(step.function.input_fields)
    return everything


def needed_fields(job: JobSpec, extra: Iterable[str] = ()) -> set[str]:
    """The declared fields to decode: from the table's columns and ``extra`` ones back through the job's steps.

    All inputs of a step count, whether or not its outputs are used, so what failed before goes on to fail.
    """
    everything = {f.name for f in job.schema.fields}
    needed = everything | set(extra)
    for step in reversed(job.steps):
        needed = _before(step, needed, everything | needed)
    return needed & everything
