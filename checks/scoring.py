"""Inference, payload, lookup and de-duplication checks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from checks.base import SPARSE, check, register, sparse_events, table
from sluice import InferenceSpec, TableSchema, build_requests, dedup, heavy_keys, infer, latest_per_key, lookup_enrich, parse_responses

_OUTPUTS = TableSchema.from_json(
    {"table": "scored", "fields": [{"name": "score", "type": "DOUBLE"}, {"name": "high", "type": "BOOLEAN"}]}
)


def _spec(**rest) -> InferenceSpec:
    values = {"function_id": "score", "function_type": "python", "input_fields": ("user_id", "value"), "output_fields": ("score", "high")}
    return InferenceSpec(**{**values, **rest})


def _scorer(spec):
    def score(batch: pd.DataFrame) -> pd.DataFrame:
        value = batch["value"].fillna(0.0)
        return pd.DataFrame({"score": value / 1000, "high": value > 100})

    return score


@check(f"SELECT event_id, value, coalesce(value, 0) / 1000 AS score, coalesce(value, 0) > 100 AS high FROM {SPARSE} e")
def infer_score(spark, sf):
    out = infer(sparse_events(spark, sf), _spec(), _scorer, _OUTPUTS)
    return out.select("event_id", "value", "score", "high")


@check(f"SELECT event_id, user_id, coalesce(value, 0) / 1000 AS value FROM {SPARSE} e")
def infer_overwrite(spark, sf):
    """An output with the name of an input column replaces it."""

    def scorer(spec):
        return lambda batch: [{"value": None if pd.isna(v) else v / 1000} for v in batch["value"].fillna(0.0)]

    out = infer(sparse_events(spark, sf), _spec(output_fields=("value",)), scorer)
    return out.select("event_id", "user_id", "value")


def _failing(spec):
    """Raises for the batches of bucket 3."""

    def score(batch: pd.DataFrame) -> pd.DataFrame:
        if batch["bucket"].iloc[0] == 3:
            raise ValueError("model is down")
        return pd.DataFrame({"score": batch["value"] / 1000, "high": batch["value"] > 100})

    return score


def _with_failures(strategy: str):
    def run(spark, sf):
        rows = table(spark, sf, "events").withColumn("bucket", F.col("user_id") % 7)
        spec = _spec(input_fields=("bucket", "value"), failure_strategy=strategy)
        return infer(rows, spec, _failing, _OUTPUTS, batch_by="bucket").select("event_id", "bucket", "score", "high")

    return run


register(
    "infer_pass_through",
    _with_failures("PASS_THROUGH"),
    "SELECT event_id, user_id % 7 AS bucket, CASE WHEN user_id % 7 <> 3 THEN value / 1000 END AS score, "
    "CASE WHEN user_id % 7 <> 3 THEN value > 100 END AS high FROM events",
)
register(
    "infer_skip",
    _with_failures("SKIP"),
    "SELECT event_id, user_id % 7 AS bucket, value / 1000 AS score, value > 100 AS high FROM events WHERE user_id % 7 <> 3",
)

_ECHOED = TableSchema.from_json(
    {"table": "echoed", "fields": [{"name": "user_out", "type": "LONG"}, {"name": "value_out", "type": "DOUBLE"}]}
)
_ECHO = {"input_fields": ("user_id", "value"), "output_fields": ("user_out", "value_out"), "function_type": "http"}


def _echo(service_type, answer):
    """Requests for all events, answered by a service that sends its inputs back."""

    def run(spark, sf):
        spec = _spec(service_type=service_type, model_name="echo", **_ECHO)
        requests = build_requests(sparse_events(spark, sf), spec, ["event_id"])
        out = parse_responses(requests.withColumn("response", answer(F.col("request"))), spec, _ECHOED)
        return out.select("event_id", "user_out", "value_out")

    return run


def _renamed(text):
    text = F.replace(text, F.lit('"user_id":'), F.lit('"user_out":'))
    return F.replace(text, F.lit('"value":'), F.lit('"value_out":'))


_ECHO_SQL = f"SELECT event_id, user_id AS user_out, value AS value_out FROM {SPARSE} e"
register("payload_torchserve", _echo("torchserve", lambda r: _renamed(F.replace(r, F.lit('"instances"'), F.lit('"predictions"')))), _ECHO_SQL)
register("payload_generic", _echo(None, lambda r: _renamed(F.replace(r, F.lit('"inputs"'), F.lit('"results"')))), _ECHO_SQL)
register(
    "payload_bare_array",
    _echo("torchserve", lambda r: _renamed(F.regexp_extract(r, r'^\{"instances":(.*)\}$', 1))),
    _ECHO_SQL,
)
register(
    "payload_triton",
    _echo("triton", lambda r: F.replace(r, F.lit('"inputs"'), F.lit('"outputs"'))),
    f"SELECT event_id, user_id AS user_out, coalesce(value, 0.0) AS value_out FROM {SPARSE} e",
)


@check("SELECT count(*) AS in_requests, count(*) AS in_full_size FROM events")
def payload_request_coverage(spark, sf):
    """Every row is in one request, and no request is longer than a batch."""
    requests = build_requests(table(spark, sf, "events"), _spec(service_type="triton", **_ECHO), ["event_id"])
    size = F.size("rows")
    within = F.sum(F.when(size <= 64, size).otherwise(0))
    return requests.agg(F.sum(size).cast("bigint").alias("in_requests"), within.cast("bigint").alias("in_full_size"))


@check(
    "SELECT c_custkey, c_nationkey, n_name, n_regionkey FROM (SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN c_nationkey END AS c_nationkey "
    "FROM customer) c LEFT JOIN nation ON c_nationkey = n_nationkey"
)
def lookup_nation(spark, sf):
    """Customers in debt have no nation key here, and so no match."""
    known = F.when(F.col("c_acctbal") > 0, F.col("c_nationkey")).alias("c_nationkey")
    customers = table(spark, sf, "customer").select("c_custkey", known)
    return lookup_enrich(customers, table(spark, sf, "nation"), {"c_nationkey": "n_nationkey"}, ["n_name", "n_regionkey"])


@check(
    "SELECT l_orderkey, l_linenumber, o_custkey, o_orderdate FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"
)
def lookup_large(spark, sf):
    orders = table(spark, sf, "orders")
    out = lookup_enrich(table(spark, sf, "lineitem"), orders, {"l_orderkey": "o_orderkey"}, ["o_custkey", "o_orderdate"])
    return out.select("l_orderkey", "l_linenumber", "o_custkey", "o_orderdate")


_HOT = "CASE WHEN l_orderkey % 3 = 0 THEN 7 WHEN l_orderkey % 3 = 1 THEN l_suppkey END"


@check(
    f"SELECT l_orderkey, l_linenumber, key, s_name FROM (SELECT l_orderkey, l_linenumber, {_HOT} AS key FROM lineitem) l "
    "LEFT JOIN supplier ON key = s_suppkey"
)
def lookup_hot(spark, sf):
    """A third of the rows have one key, a third none."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr(_HOT).cast("long").alias("key"))
    suppliers = table(spark, sf, "supplier").withColumn("s_suppkey", F.col("s_suppkey").cast("long"))
    return lookup_enrich(rows, suppliers, {"key": "s_suppkey"}, ["s_name"], heavy_keys(rows, ["key"]))


@check("SELECT DISTINCT user_id, event_type FROM events")
def dedup_keys(spark, sf):
    return dedup(table(spark, sf, "events").select("user_id", "event_type"), ["user_id", "event_type"])


@check(
    "SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER "
    "(PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) e WHERE rn = 1"
)
def dedup_latest(spark, sf):
    rows = table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")
    return latest_per_key(rows, ["user_id", "event_type"], ["ts", "event_id"])
