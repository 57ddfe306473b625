import pytest
from helpers import plan_of

from sluice import ConfigError, FilterRule, filter_rows


def keep(df, *conditions, logic="AND"):
    return filter_rows(df, FilterRule.from_json({"logic": logic, "conditions": list(conditions)}))


def c(field, op, value=None, **rest):
    return {"field": field, "op": op, "value": value, **rest}


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(
        [
            (1, 150.0, "click", 1, "9", True, "2024-01-01", "2024-01-01 10:00:00", "10.50"),
            (2, 100.0, "view", 2, "b", False, "2024-06-01", "2024-06-01 00:00:00", "2.25"),
            (3, None, None, None, None, None, None, None, None),
        ],
        "id int, amount double, kind string, user_id bigint, code string, flag boolean, day string, at string, price string",
    ).selectExpr("id", "amount", "cast(amount as float) small", "kind", "user_id", "code", "flag", "cast(day as date) day", "cast(at as timestamp_ntz) at", "cast(price as decimal(10,2)) price")


def ids(df):
    return [r.id for r in df.orderBy("id").collect()]


@pytest.mark.parametrize(
    "condition, expected",
    [
        (c("kind", "eq", "click"), [1]),
        (c("kind", "ne", "click"), [2, 3]),
        (c("kind", "eq", None), [3]),
        (c("kind", "ne", None), [1, 2]),
        (c("amount", "eq", 100), [2]),
        (c("amount", "eq", "100.0"), [2]),
        (c("amount", "eq", "x"), []),
        (c("amount", "ne", "x"), [1, 2, 3]),
        (c("user_id", "eq", 1.0), [1]),
        (c("user_id", "eq", 1.5), []),
        (c("flag", "eq", True), [1]),
        (c("flag", "eq", "false"), [2]),
        (c("price", "eq", 10.5), [1]),
        (c("amount", "gt", 100), [1]),
        (c("amount", "gte", 100), [1, 2]),
        (c("amount", "lt", 150), [2, 3]),
        (c("amount", "lte", 150), [1, 2, 3]),
        (c("small", "gte", 150), [1]),
        (c("price", "lt", "10.5"), [2, 3]),
        (c("amount", "gt", None), [1, 2]),
        (c("amount", "lt", None), [3]),
        (c("user_id", "gt", 1.5), [2]),
        (c("user_id", "gte", 1.5), [2]),
        (c("user_id", "lt", 1.5), [1, 3]),
        (c("user_id", "lte", 1.5), [1, 3]),
        (c("user_id", "gt", 10**30), []),
        (c("user_id", "lt", 10**30), [1, 2, 3]),
        (c("code", "lt", 10), [1, 3]),
        (c("code", "gt", "a"), [2]),
        (c("code", "gt", 10), [2]),
        (c("flag", "gt", "false"), [1]),
        (c("day", "gte", "2024-06-01"), [2]),
        (c("day", "gt", "2024"), [1, 2]),
        (c("at", "gt", "2024-01-01T10:00:00"), [2]),
        (c("at", "gt", "2024-01-01"), [1, 2]),
        (c("kind", "in", values=["click", "buy"]), [1]),
        (c("kind", "in", values=["click", None]), [1, 3]),
        (c("kind", "in"), []),
        (c("kind", "in", values=[]), []),
        (c("user_id", "in", values=[1, "2", "x"]), [1, 2]),
        (c("kind", "not_in", values=["click"]), [2, 3]),
        (c("kind", "not_in", values=["click", None]), [2]),
        (c("kind", "not_in"), [1, 2, 3]),
        (c("kind", "is_null"), [3]),
        (c("kind", "not_null"), [1, 2]),
        (c("kind", "contains", "lic"), [1]),
        (c("user_id", "contains", 2), [2]),
        (c("kind", "starts_with", "vi"), [2]),
        (c("kind", "ends_with", "ck"), [1]),
        (c("amount", "ends_with", ".0"), [1, 2]),
        (c("kind", "regex", "^(click|view)$"), [1, 2]),
    ],
)
def test_conditions(rows, condition, expected):
    assert ids(keep(rows, condition)) == expected


def test_logic(rows):
    a, b = c("amount", "gt", 120), c("kind", "is_null")
    assert ids(keep(rows, a, b)) == []
    assert ids(keep(rows, a, b, logic="or")) == [1, 3]
    assert ids(keep(rows, a, b, logic="XOR")) == []
    assert ids(keep(rows)) == [1, 2, 3]
    assert ids(keep(rows, logic="OR")) == [1, 2, 3]


def test_three_conditions(spark):
    data = [(7.5, "north", 1), (9.5, "north", 1), (7.5, "south", 1), (7.5, "north", 4), (None, "north", 1)]
    df = spark.createDataFrame(data, "celsius double, wing string, floor bigint")
    out = keep(df, c("celsius", "gte", 7), c("celsius", "ne", 9.5), c("wing", "not_in", values=["south"]), c("floor", "lte", 3))
    assert out.collect() == [(7.5, "north", 1)]


@pytest.mark.parametrize("condition", [c("missing", "eq", 1), c("kind", "like", "x"), c("kind", "regex", None)])
def test_bad_rules_fail_when_compiled(rows, condition):
    with pytest.raises(ConfigError):
        keep(rows, condition)


@pytest.mark.parametrize(
    "condition, pushed",
    [
        (c("value", "lt", 50), "Or(IsNull(value),LessThan(value,50.0))"),
        (c("user_id", "gt", 10.5), "GreaterThan(user_id,10)"),
        (c("event_type", "eq", "click"), "EqualNullSafe(event_type,click)"),
        (c("event_type", "not_in", values=["a", "b"]), "Or(IsNull(event_type),Not(In(event_type, [a,b])))"),
        (c("ts", "gte", "2024-01-10"), "GreaterThanOrEqual(ts,2024-01-10T00:00)"),
        (c("event_type", "starts_with", "cl"), "StringStartsWith(event_type,cl)"),
    ],
)
def test_conditions_reach_the_scan(events, condition, pushed):
    assert pushed in plan_of(keep(events, condition))
