"""Typed specs for jobs, rules and schemas, and the JSON readers that build them.

Every reader accepts camelCase and snake_case keys and rejects keys it does not know,
so a misspelt rule fails when it is loaded and not when the first row arrives.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping as MappingABC
from dataclasses import dataclass, field, fields
from typing import Any

# The type names a declared schema may use.
FIELD_TYPES = ("STRING", "INT", "LONG", "FLOAT", "DOUBLE", "BOOLEAN", "DATE", "TIMESTAMP", "DECIMAL")

# What an inference step does with a batch whose scorer failed.
FAILURE_STRATEGIES = ("SKIP", "PASS_THROUGH", "FAIL")

# The step types a job may use.
STEP_TYPES = ("filter", "transform", "aggregate", "ai-inference")


class ConfigError(ValueError):
    """A job, schema or rule that cannot be compiled."""


def snake(key: str) -> str:
    return re.sub(r"(?<=[a-z0-9])([A-Z])", r"_\1", key).lower()


def load_doc(doc: Any, where: str) -> dict:
    """Take a JSON object as text or as a dict."""
    if isinstance(doc, str):
        try:
            doc = json.loads(doc)
        except json.JSONDecodeError as e:
            raise ConfigError(f"{where}: not valid JSON ({e.msg} at position {e.pos})") from None
    if not isinstance(doc, MappingABC):
        raise ConfigError(f"{where}: expected a JSON object, got {type(doc).__name__}")
    return dict(doc)


def read_keys(doc: Any, where: str, known, aliases: dict[str, str] | None = None) -> dict:
    """Normalise the keys of a JSON object to the snake_case names in ``known``."""
    out: dict[str, Any] = {}
    for key, value in load_doc(doc, where).items():
        name = snake(key)
        name = (aliases or {}).get(name, name)
        if name not in known:
            raise ConfigError(f"{where}: unknown key {key!r}; known keys: {', '.join(sorted(known))}")
        if name in out:
            raise ConfigError(f"{where}: key {name!r} is given twice")
        out[name] = value
    return out


def _require(doc: dict, where: str, *names: str) -> None:
    for name in names:
        if doc.get(name) in (None, ""):
            raise ConfigError(f"{where}: {name!r} is required")


def _list(doc: dict, name: str, where: str) -> tuple:
    value = doc.get(name)
    if value is not None and not isinstance(value, (list, tuple)):
        raise ConfigError(f"{where}: {name!r} must be a list")
    return tuple(value or ())


def _names(cls) -> set[str]:
    return {f.name for f in fields(cls)}


def _build(cls, doc: dict):
    return cls(**{k: v for k, v in doc.items() if v is not None})


# --- schema -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = True
    precision: int = 10
    scale: int = 2

    def __post_init__(self):
        if self.type not in FIELD_TYPES:
            raise ConfigError(f"field {self.name!r}: unknown type {self.type!r}; known: {', '.join(FIELD_TYPES)}")


@dataclass(frozen=True)
class TableSchema:
    table: str
    fields: tuple[Field, ...]
    primary_keys: tuple[str, ...] = ()
    partition_keys: tuple[str, ...] = ()

    def __post_init__(self):
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ConfigError(f"schema {self.table!r}: duplicate field name")
        for key in (*self.primary_keys, *self.partition_keys):
            if key not in names:
                raise ConfigError(f"schema {self.table!r}: key {key!r} is not a declared field")
        if self.primary_keys and not set(self.partition_keys) <= set(self.primary_keys):
            # otherwise one key could live in two partitions and an upsert would miss the old row
            raise ConfigError(f"schema {self.table!r}: partition keys must be part of the primary key")

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    def field(self, name: str) -> Field | None:
        return next((f for f in self.fields if f.name == name), None)

    def required(self, f: Field) -> bool:
        return not f.nullable or f.name in self.primary_keys

    @classmethod
    def from_json(cls, doc: Any) -> TableSchema:
        d = read_keys(doc, "schema_config", _names(cls))
        _require(d, "schema_config", "table", "fields")
        cols = []
        for i, item in enumerate(_list(d, "fields", "schema_config")):
            fd = read_keys(item, f"schema_config.fields[{i}]", _names(Field))
            _require(fd, f"schema_config.fields[{i}]", "name", "type")
            cols.append(_build(Field, fd))
        keys = (_list(d, name, "schema_config") for name in ("primary_keys", "partition_keys"))
        return cls(d["table"], tuple(cols), *keys)


# --- rules ------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Condition:
    field: str
    op: str
    value: Any = None
    values: tuple | None = None

    @classmethod
    def from_json(cls, doc: Any, where: str = "condition") -> Condition:
        d = read_keys(doc, where, _names(cls), {"operator": "op"})
        _require(d, where, "field", "op")
        values = None if d.get("values") is None else _list(d, "values", where)
        return cls(d["field"], d["op"], d.get("value"), values)


@dataclass(frozen=True)
class FilterRule:
    logic: str = "AND"
    conditions: tuple[Condition, ...] = ()

    @classmethod
    def from_json(cls, doc: Any) -> FilterRule:
        d = read_keys(doc, "filter rule", _names(cls))
        conds = _list(d, "conditions", "filter rule")
        return cls(
            d.get("logic") or "AND",
            tuple(Condition.from_json(c, f"filter rule conditions[{i}]") for i, c in enumerate(conds)),
        )


@dataclass(frozen=True)
class FieldMapping:
    output: str
    op: str
    input: str | None = None
    inputs: tuple[str, ...] = ()
    operand: float | None = None
    separator: str = ""
    start: int = 0
    length: int | None = None
    format: str = "yyyy-MM-dd"
    condition: Condition | None = None
    then_value: Any = None
    else_value: Any = None
    value: Any = None
    target_type: str = "STRING"
    expression: str | None = None

    @classmethod
    def from_json(cls, doc: Any, where: str = "mapping") -> FieldMapping:
        d = read_keys(doc, where, _names(cls), {"operator": "op"})
        _require(d, where, "output", "op")
        d["inputs"] = _list(d, "inputs", where)
        if d.get("condition") is not None:
            d["condition"] = Condition.from_json(d["condition"], f"{where}.condition")
        return _build(cls, d)


@dataclass(frozen=True)
class TransformRule:
    mappings: tuple[FieldMapping, ...] = ()

    @classmethod
    def from_json(cls, doc: Any) -> TransformRule:
        d = read_keys(doc, "transform rule", _names(cls))
        items = _list(d, "mappings", "transform rule")
        return cls(tuple(FieldMapping.from_json(m, f"transform rule mappings[{i}]") for i, m in enumerate(items)))


@dataclass(frozen=True)
class WindowSpec:
    # Defaults that rules rely on.
    type: str = "tumbling"
    size_seconds: int = 60
    slide_seconds: int = 10
    gap_seconds: int | None = None

    @property
    def kind(self) -> str:
        """``sliding``, ``session`` or, for every other name, ``tumbling``."""
        name = self.type.lower()
        return name if name in ("sliding", "session") else "tumbling"

    @property
    def gap(self) -> int:
        return self.size_seconds if self.gap_seconds is None else self.gap_seconds

    def __post_init__(self):
        if min(self.size_seconds, self.slide_seconds, self.gap) <= 0:
            raise ConfigError("window: sizes must be positive")


@dataclass(frozen=True)
class Aggregation:
    output: str
    op: str
    input: str | None = None


@dataclass(frozen=True)
class AggregateRule:
    key_fields: tuple[str, ...] = ()
    window: WindowSpec = field(default_factory=WindowSpec)
    aggregations: tuple[Aggregation, ...] = ()
    time_field: str | None = None
    watermark: str | None = None  # required on a stream with a time_field: what is later than that is dropped
    nulls: str = "zero"
    emit_window: bool = False
    rsd: float = 0.05
    final: bool = False  # on a stream: each window once, when complete; exact distinct counts, less state, append mode only

    def __post_init__(self):
        if self.nulls not in ("zero", "skip"):
            raise ConfigError(f"aggregate rule: nulls must be 'zero' or 'skip', not {self.nulls!r}")
        outs = [*self.key_fields, *(a.output for a in self.aggregations)]
        if len(set(outs)) != len(outs):
            raise ConfigError("aggregate rule: duplicate output name")

    @classmethod
    def from_json(cls, doc: Any) -> AggregateRule:
        d = read_keys(doc, "aggregate rule", _names(cls))
        if d.get("window") is not None:
            d["window"] = _build(WindowSpec, read_keys(d["window"], "aggregate rule window", _names(WindowSpec)))
        aggs = []
        for i, item in enumerate(_list(d, "aggregations", "aggregate rule")):
            ad = read_keys(item, f"aggregate rule aggregations[{i}]", _names(Aggregation))
            _require(ad, f"aggregate rule aggregations[{i}]", "output", "op")
            aggs.append(_build(Aggregation, ad))
        d["aggregations"] = tuple(aggs)
        d["key_fields"] = _list(d, "key_fields", "aggregate rule")
        return _build(cls, d)


# --- model functions --------------------------------------------------------------------------


@dataclass(frozen=True)
class InferenceSpec:
    function_id: str
    function_type: str
    input_fields: tuple[str, ...]
    output_fields: tuple[str, ...]
    function_name: str | None = None
    service_url: str | None = None
    service_type: str | None = None
    model_name: str | None = None
    # Defaults that config rows rely on.
    batch_size: int = 64
    max_wait_ms: int = 100
    async_capacity: int = 100
    async_timeout_ms: int = 5000
    failure_strategy: str = "PASS_THROUGH"
    extra_config: MappingABC = field(default_factory=dict)

    def __post_init__(self):
        if self.failure_strategy not in FAILURE_STRATEGIES:
            raise ConfigError(
                f"function {self.function_id!r}: unknown failure strategy {self.failure_strategy!r}; "
                f"known: {', '.join(FAILURE_STRATEGIES)}"
            )
        if min(self.batch_size, self.async_capacity, self.async_timeout_ms) <= 0:
            raise ConfigError(f"function {self.function_id!r}: sizes must be positive")

    @property
    def carries(self) -> bool:
        """Whether a stream's rows wait for a full batch over micro-batches (``"carry": true`` in the extra config)."""
        return bool(self.extra_config.get("carry"))

    @property
    def lanes(self) -> int:
        """How many batches fill up side by side then."""
        return int(self.extra_config.get("lanes") or 1)

    @property
    def headers(self) -> dict[str, str]:
        return {str(k): str(v) for k, v in (self.extra_config.get("headers") or {}).items()}

    @classmethod
    def from_row(cls, row: MappingABC) -> InferenceSpec:
        """Build from a row of the function table; JSON columns arrive as text."""
        fid = row.get("function_id")
        extra = load_doc(row.get("extra_config") or {}, f"function {fid!r} extra_config")
        values: dict[str, Any] = {k: row.get(k) for k in _names(cls)}
        for name in ("input_fields", "output_fields"):
            raw = values[name]
            values[name] = tuple(json.loads(raw) if isinstance(raw, str) and raw else raw or ())
        values["extra_config"] = extra
        values["async_timeout_ms"] = extra.get("asyncTimeoutMs", extra.get("async_timeout_ms"))
        if not values["function_type"]:
            raise ConfigError(f"function {fid!r}: function_type is required")
        return _build(cls, values)


# --- job --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class KafkaSpec:
    bootstrap_servers: str
    topic: str
    group_id: str = "sluice"
    starting_offset: str = "latest"
    starting_timestamp: int | None = None

    @classmethod
    def from_json(cls, doc: Any) -> KafkaSpec:
        d = read_keys(doc, "kafka_config", _names(cls), {"startup_mode": "starting_offset"})
        _require(d, "kafka_config", "bootstrap_servers", "topic")
        if d.get("starting_offset"):
            d["starting_offset"] = str(d["starting_offset"]).lower()
        spec = _build(cls, d)
        if spec.starting_offset not in ("earliest", "latest", "timestamp"):
            raise ConfigError(f"kafka_config: unknown starting offset {spec.starting_offset!r}")
        if spec.starting_offset == "timestamp" and spec.starting_timestamp is None:
            raise ConfigError("kafka_config: starting offset 'timestamp' needs starting_timestamp")
        return spec


@dataclass(frozen=True)
class LakeSpec:
    """Where the target table lives and its free-form properties."""

    warehouse: str
    catalog_name: str = "paimon_catalog"  # fixed value: a default that config rows rely on
    database: str = "default"
    table_properties: MappingABC = field(default_factory=dict)

    @classmethod
    def from_json(cls, doc: Any) -> LakeSpec:
        d = read_keys(doc, "paimon_config", _names(cls))
        _require(d, "paimon_config", "warehouse")
        if d.get("table_properties") is not None:
            props = d["table_properties"].items()
            d["table_properties"] = {k: v if isinstance(v, str) else json.dumps(v) for k, v in props}
        return _build(cls, d)


@dataclass(frozen=True)
class StepSpec:
    type: str
    config: str | dict | None = None
    function: InferenceSpec | None = None

    def __post_init__(self):
        if self.type not in STEP_TYPES:
            raise ConfigError(f"unknown step type {self.type!r}; known: {', '.join(STEP_TYPES)}")


@dataclass(frozen=True)
class JobSpec:
    name: str
    schema: TableSchema
    kafka: KafkaSpec | None = None
    lake: LakeSpec | None = None
    parallelism: int = 1  # fixed value: a default that config rows rely on
    steps: tuple[StepSpec, ...] = ()
