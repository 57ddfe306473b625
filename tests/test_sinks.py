from datetime import datetime

import pytest
from pyspark.sql import functions as F

from sluice import ConfigError, KeyedTable, TableSchema, conform, dedup, latest_per_key, lookup_enrich
from sluice.schema import null_violations
from sluice.session import path_exists, remove_path, shared_dir
from sluice.sinks import ddl, keyed

SCHEMA = TableSchema.from_json(
    {
        "table": "state",
        "fields": [{"name": "day", "type": "DATE"}, {"name": "id", "type": "LONG"}, {"name": "value", "type": "DOUBLE"}, {"name": "at", "type": "TIMESTAMP"}],
        "primaryKeys": ["day", "id"],
        "partitionKeys": ["day"],
    }
)


def rows(spark, *data):
    df = spark.createDataFrame([(d, i, v, s) for d, i, v, s in data], "day string, id bigint, value double, seq int")
    return df.select(F.col("day").cast("date").alias("day"), "id", "value", F.lit(None).cast("timestamp_ntz").alias("at"), "seq")


def state(table):
    return sorted((str(r.day), r.id, r.value) for r in table.read().collect())


def files(path):
    return {str(p.relative_to(path)): p.stat().st_mtime_ns for p in path.rglob("*.parquet")}


def test_upsert_replaces_whole_rows_and_touches_only_its_folders(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=2)
    target.upsert(rows(spark, ("2024-01-01", 1, 1.0, 1), ("2024-01-01", 1, 2.0, 2), ("2024-01-02", 1, 3.0, 1), ("2024-01-02", 2, 4.0, 1)), 0, order_by=["seq"])
    assert state(target) == [("2024-01-01", 1, 2.0), ("2024-01-02", 1, 3.0), ("2024-01-02", 2, 4.0)]
    before = files(tmp_path / "t")
    update = rows(spark, ("2024-01-02", 1, None, 1), ("2024-01-03", 9, 9.0, 1))
    target.upsert(update, 1, order_by=["seq"])
    expected = [("2024-01-01", 1, 2.0), ("2024-01-02", 1, None), ("2024-01-02", 2, 4.0), ("2024-01-03", 9, 9.0)]
    assert state_with_nulls(target) == expected
    after = files(tmp_path / "t")
    assert all(after[f] == t for f, t in before.items() if "2024-01-01" in f)
    target.upsert(update, 1, order_by=["seq"])
    assert state_with_nulls(target) == expected
    assert not path_exists(spark, f"{shared_dir(spark)}/sluice-stage/state/batch/1")
    assert not path_exists(spark, str(tmp_path / "t__staged/batch/1"))


def state_with_nulls(table):
    return sorted(((str(r.day), r.id, r.value) for r in table.read().collect()), key=lambda r: r[:2])


def test_a_run_that_died_while_publishing_goes_on_from_staging(spark, tmp_path, monkeypatch):
    target = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=1)
    target.upsert(rows(spark, ("2024-01-01", 1, 1.0, 1), ("2024-01-01", 2, 2.0, 1)), 0)

    def die(spark, source, target):
        # the live folder is gone and nothing has taken its place
        remove_path(spark, target)
        raise RuntimeError("driver lost")

    update = rows(spark, ("2024-01-01", 1, 5.0, 1))
    monkeypatch.setattr(keyed, "replace_folder", die)
    with pytest.raises(RuntimeError):
        target.upsert(update, 7, "run")
    monkeypatch.undo()
    assert state(target) == [("2024-01-01", 1, 5.0), ("2024-01-01", 2, 2.0)]  # readers see the folder in staging
    target.recover()
    assert state(target) == [("2024-01-01", 1, 5.0), ("2024-01-01", 2, 2.0)]


def test_an_upsert_first_finishes_an_interrupted_one(spark, tmp_path, monkeypatch):
    target = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=1)
    monkeypatch.setattr(KeyedTable, "_publish", lambda self, staged: (_ for _ in ()).throw(RuntimeError("driver lost")))
    with pytest.raises(RuntimeError):
        target.upsert(rows(spark, ("2024-01-01", 1, 1.0, 1), ("2024-01-02", 2, 2.0, 1)), 0, "first")
    monkeypatch.undo()
    # half-written staging, as a lost driver leaves it
    (tmp_path / "t__staged" / "other" / "1" / "day=2024-01-01").mkdir(parents=True)
    target.upsert(rows(spark, ("2024-01-02", 2, 7.0, 1)), 0, "second")
    assert state(target) == [("2024-01-01", 1, 1.0), ("2024-01-02", 2, 7.0)]


def test_empty_batches_and_an_empty_table(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), SCHEMA)
    assert target.read().count() == 0
    target.upsert(rows(spark, ("2024-01-01", 1, 1.0, 1)).limit(0), 0)
    assert target.read().columns == SCHEMA.names and target.read().count() == 0


def test_changelog_keeps_every_accepted_row_once(spark, tmp_path):
    target = KeyedTable(spark, str(tmp_path / "t"), SCHEMA, changelog=True)
    batch = rows(spark, ("2024-01-01", 1, 1.0, 1), ("2024-01-01", 1, 2.0, 2))
    for _ in range(2):
        target.upsert(batch, 0, order_by=["seq"])
    target.upsert(rows(spark, ("2024-01-01", 1, 3.0, 1)), 1, order_by=["seq"])
    log = spark.read.parquet(target.changelog_path)
    assert sorted(r.value for r in log.collect()) == [1.0, 2.0, 3.0]
    assert state(target) == [("2024-01-01", 1, 3.0)]


def test_null_keys_fail_drop_or_are_set_aside(spark, tmp_path):
    batch = rows(spark, ("2024-01-01", 1, 1.0, 1), ("2024-01-01", None, 2.0, 1))
    target = KeyedTable(spark, str(tmp_path / "t"), SCHEMA)
    with pytest.raises(Exception, match="NOT NULL violated: field id"):
        target.upsert(batch, 0)
    target.upsert(batch, 0, on_null="drop")
    assert state(target) == [("2024-01-01", 1, 1.0)]
    target.upsert(batch, 1, on_null="quarantine")
    assert [r.value for r in spark.read.parquet(str(tmp_path / "t__rejected")).collect()] == [2.0]


def test_a_hot_key_is_folded_before_the_shuffle(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id").alias("seq"), (F.col("id") * 2).alias("v"))
    best = latest_per_key(df, ["k"], ["seq"])
    assert tuple(best.first()) == (1, 999, 1998)
    assert "partial_max" in best._jdf.queryExecution().executedPlan().toString()


def test_latest_without_order_is_repeatable(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], "k int, v string")
    assert sorted(tuple(r) for r in latest_per_key(df, ["k"]).fillna(-1).collect()) == [(-1, "c"), (1, "b")]
    assert latest_per_key(df.select("k"), ["k"]).count() == 2


def test_conform(spark):
    schema = TableSchema.from_json(
        {"table": "t", "fields": [{"name": "a", "type": "INT", "nullable": False}, {"name": "b", "type": "DECIMAL"}, {"name": "at", "type": "TIMESTAMP"}, {"name": "c", "type": "FLOAT"}]}
    )
    df = spark.createDataFrame([("1", 1.239, "x", "2024-01-01T00:00:00.123987")], "a string, b double, gone string, at string")
    out = conform(df.withColumn("at", F.col("at").cast("timestamp_ntz")), schema)
    assert out.dtypes == [("a", "int"), ("b", "decimal(10,2)"), ("at", "timestamp_ntz"), ("c", "float")]
    row = out.first()
    assert (row.a, float(row.b), row.at, row.c) == (1, 1.24, datetime(2024, 1, 1, 0, 0, 0, 123000), None)
    with pytest.raises(ConfigError):
        conform(df.drop("a"), schema)
    empty = df.withColumn("a", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="NOT NULL"):
        conform(empty, schema).collect()
    assert conform(empty, schema, "drop").count() == 0
    assert empty.filter(null_violations(empty, schema)).count() == 1


def test_statements(spark, tmp_path):
    sql = ddl.create_table("db.t", SCHEMA, properties={"contact": "o'neil", "bucket": "2"}, bucket_column="_bucket")
    assert sql == (
        "CREATE TABLE IF NOT EXISTS db.t (`day` DATE NOT NULL, `id` BIGINT NOT NULL, `value` DOUBLE, `at` TIMESTAMP_NTZ, `_bucket` INT) "
        "USING parquet PARTITIONED BY (`day`, `_bucket`) "
        "TBLPROPERTIES ('contact' = 'o\\'neil', 'bucket' = '2', 'primary-keys' = 'day,id')"
    )
    assert ddl.merge("c.d.t", SCHEMA, "s") == (
        "MERGE INTO c.d.t AS t USING s AS s ON t.`day` = s.`day` AND t.`id` = s.`id` "
        "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )
    spark.sql(ddl.create_database("ddl_test"))
    spark.sql(ddl.create_table("ddl_test.t", SCHEMA, properties={"contact": "o'neil"}, location=str(tmp_path)))
    properties = {r.key: r.value for r in spark.sql("SHOW TBLPROPERTIES ddl_test.t").collect()}
    assert properties["contact"] == "o'neil" and properties["primary-keys"] == "day,id"
    spark.sql("DROP TABLE ddl_test.t")


def test_lookup(spark):
    facts = spark.createDataFrame([(1, "a"), (2, "z"), (3, None)], "id int, code string")
    dim = spark.createDataFrame([("a", "Alpha", 1), ("b", "Beta", 2)], "key string, name string, size int")
    out = lookup_enrich(facts, dim, {"code": "key"}, ["name"]).orderBy("id")
    assert out.columns == ["id", "code", "name"] and [r.name for r in out.collect()] == ["Alpha", None, None]
    same = lookup_enrich(facts, dim.withColumnRenamed("key", "code"), ["code"], ["name", "size"])
    assert same.columns == ["id", "code", "name", "size"] and same.count() == 3
    for args in ((dim, {"missing": "key"}, ["name"]), (dim, {"code": "missing"}, ["name"]), (dim, {"code": "key"}, ["none"])):
        with pytest.raises(ConfigError):
            lookup_enrich(facts, *args)
    with pytest.raises(ConfigError):
        lookup_enrich(facts, dim.withColumnRenamed("name", "id"), {"code": "key"}, ["id"])


def test_dedup(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "x"), (None, "y")], "k int, v string")
    assert dedup(df, ["k"]).count() == 3
    with pytest.raises(ConfigError):
        dedup(df, ["missing"])


def test_two_keys_in_one_folder_of_an_empty_text(spark, tmp_path):
    fields = [{"name": "kind", "type": "STRING"}, {"name": "id", "type": "LONG"}]
    schema = TableSchema.from_json({"table": "t", "fields": fields, "primaryKeys": ["kind", "id"], "partitionKeys": ["kind"]})
    target = KeyedTable(spark, str(tmp_path / "t"), schema, buckets=1)
    for k in (1, 2):
        target.upsert(spark.createDataFrame([("", k)], "kind string, id bigint"), k)
    assert sorted(map(tuple, target.read().collect())) == [("", 1), ("", 2)]


def test_the_bucket_count_is_kept(spark, tmp_path):
    KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=4).upsert(rows(spark, ("2024-01-01", 1, 1.0, 1)), 0)
    with pytest.raises(ConfigError, match="4 buckets"):
        KeyedTable(spark, str(tmp_path / "t"), SCHEMA, buckets=7).upsert(rows(spark, ("2024-01-01", 1, 2.0, 1)), 1)


def test_a_lower_sequence_changes_nothing(spark, tmp_path):
    fields = [{"name": "id", "type": "LONG"}, {"name": "seq", "type": "LONG"}]
    schema = TableSchema.from_json({"table": "t", "fields": fields, "primaryKeys": ["id"]})
    target = KeyedTable(spark, str(tmp_path / "t"), schema, buckets=1, sequence=("seq",))
    for batch, seq in enumerate((5, 3, 5)):
        target.upsert(spark.createDataFrame([(1, seq)], "id bigint, seq bigint"), batch, order_by=["seq"])
    assert target.read().first().seq == 5
    with pytest.raises(ConfigError):
        KeyedTable(spark, "x", schema, sequence=("other",))


def test_unknown_word_for_nulls(spark, tmp_path):
    with pytest.raises(ConfigError, match="unknown word"):
        KeyedTable(spark, str(tmp_path / "t"), SCHEMA).upsert(rows(spark, ("2024-01-01", 1, 1.0, 1)), 0, on_null="quarantne")
