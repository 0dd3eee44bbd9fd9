"""Readers (explicit and inferred schema), availability check, batch sinks."""

import datetime as dt
import os

import pytest

from ledgerlake.sources.driver_tables import banking_sources
from ledgerlake.sources.readers import check_sources, read_csv_inferred, read_source
from ledgerlake.sources.schemas import SOURCE_SCHEMAS
from ledgerlake.params import RunParams
from ledgerlake.sources.sinks import read_batches, table_path, write_batch

from conftest import SF_SMALL


def test_sources_conform_to_schemas(spark):
    src = banking_sources(spark, SF_SMALL)
    for name, schema in SOURCE_SCHEMAS.items():
        assert [(f.name, f.dataType) for f in src[name].schema.fields] == \
            [(f.name, f.dataType) for f in schema.fields]


def test_read_source_csv_and_inferred(spark, scratch):
    src = banking_sources(spark, SF_SMALL)
    path = os.path.join(scratch, "accounts_csv")
    src["accounts"].write.option("header", True).csv(path)
    typed = read_source(spark, "accounts", path, "csv")
    assert typed.schema == SOURCE_SCHEMAS["accounts"]
    assert typed.count() == src["accounts"].count()
    inferred = read_csv_inferred(spark, path)
    assert set(inferred.columns) == set(SOURCE_SCHEMAS["accounts"].fieldNames())


def test_check_sources_rejects_missing_and_empty(spark):
    src = banking_sources(spark, SF_SMALL)
    check_sources(src)
    bad = {k: v for k, v in src.items() if k != "cards"}
    bad["loans"] = src["loans"].limit(0)
    with pytest.raises(ValueError, match="missing=\\['cards'\\] empty=\\['loans'\\]"):
        check_sources(bad)


def test_batches_are_idempotent(spark, scratch):
    path = table_path(scratch, "silver", "t")
    t1, t2 = RunParams(load_ts=dt.datetime(2024, 1, 1)), RunParams(load_ts=dt.datetime(2024, 2, 1))
    assert read_batches(spark, path) is None
    write_batch(spark.range(3), path, t1)
    write_batch(spark.range(5), path, t2)
    write_batch(spark.range(5), path, t2)          # retry of batch two
    assert read_batches(spark, path).count() == 8
    assert read_batches(spark, path, other_than=t2).count() == 3


def test_declared_driver_schemas_match_the_files(spark):
    from pyspark.sql.types import _parse_datatype_string

    from ledgerlake.sources.driver_tables import DRIVER_SCHEMAS
    for sf in [SF_SMALL, "/root/testdata/sf0.01"]:
        for name, ddl in DRIVER_SCHEMAS.items():
            inferred = spark.read.parquet(f"{sf}/{name}.parquet").schema
            declared = _parse_datatype_string(ddl)
            assert [(f.name, f.dataType) for f in inferred.fields] == \
                [(f.name, f.dataType) for f in declared.fields], name


def test_jdbc_reads_are_split_or_asked_for(spark):
    from ledgerlake.sources.readers import hash_predicates, jdbc_options, read_jdbc

    parts = hash_predicates("customer_id", 3)
    assert parts[0].endswith("= 0 OR customer_id IS NULL") and parts[2] == "mod(abs(hashtext(customer_id::text)), 3) = 2"
    opts = jdbc_options("loans", "jdbc:x", {"user": "u"}, "start_date", "2015-01-01", "2022-01-01", 8)
    assert opts["numPartitions"] == "8" and opts["partitionColumn"] == "start_date" and opts["user"] == "u"
    with pytest.raises(ValueError, match="single_task"):
        read_jdbc(spark, "loans", "jdbc:x", {})


def test_hot_key_list_does_not_grow_with_the_data(spark):
    from ledgerlake.operators.skew import HOT_SHARE, hot_keys

    for rows in (2_000, 200_000):
        df = spark.range(rows).selectExpr("case when id % 3 = 0 then 'hot' else cast(id % 1000 as string) end as k")
        assert 1 <= hot_keys(df, "k").count() <= 1 / HOT_SHARE
