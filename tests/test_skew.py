"""One key holds a third of all rows: results stay whole and the hot partition is split."""

import pytest
from pyspark.sql import functions as F

from pagedframes import plans
from pagedframes.operators import page_audit, read_by_keys, repeated_pages, unmatched_keys

N = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB",
}


@pytest.fixture
def shuffled(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark
    for key in SETTINGS:
        spark.conf.unset(key)


def hot(spark):
    """``id`` 0..N-1 and ``k``: 0 for a third of the rows, otherwise spread over 1..999."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 999 + 1)
    return spark.range(N, numPartitions=8).withColumn("k", key.cast("int"))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_endpoint(shuffled):
    params = F.array(
        F.struct(
            F.lit("s").alias("name"),
            F.lit("string").alias("type"),
            F.array(F.lit("x")).alias("enum"),
            F.lit(True).alias("required"),
        )
    )
    endpoints = shuffled.range(1000).select(
        F.col("id").cast("int").alias("spec_id"), F.lit("/a").alias("endpoint"), F.lit("get").alias("method"), params.alias("params")
    )
    given = F.when(F.col("id") % 2 == 0, F.create_map(F.lit("s"), F.lit("y"))).otherwise(
        F.create_map(F.lit("page"), F.lit("1"))
    )
    requests = hot(shuffled).select(
        F.col("id").alias("request_id"), F.col("k").alias("spec_id"), F.lit("/a").alias("endpoint"), given.alias("params")
    )
    missing = plans.missing_params(requests, endpoints)
    assert missing.count() == N // 2
    assert plans.enum_violations(requests, endpoints).count() == N // 2
    assert "skew=true" in final_plan(missing)


def test_hot_keys(shuffled):
    rows = hot(shuffled)
    # the hot key is asked for as often as it is held; odd keys are asked for as negatives
    keys = hot(shuffled).select(F.when(F.col("k") % 2 == 0, F.col("k")).otherwise(-F.col("k")).alias("k"))
    held = [0 if i % 3 == 0 else i % 999 + 1 for i in range(N)]
    found = read_by_keys(rows, keys, "k")
    assert found.count() == sum(k % 2 == 0 for k in held)
    assert "skew=true" in final_plan(found)
    assert {r["k"] for r in unmatched_keys(rows, keys, "k").collect()} == {-k for k in held if k % 2}


def test_hot_dataset(shuffled):
    pages = hot(shuffled).select(
        F.concat(F.lit("d"), F.col("k")).alias("dataset"),
        (F.col("id") % 1000).cast("int").alias("page"),
        F.lit('{"$total":7,"$items":[1,2,3]}').alias("body"),
    )
    expected = {}
    for i in range(N):
        counts = expected.setdefault(f"d{0 if i % 3 == 0 else i % 999 + 1}", {})
        counts[i % 1000] = counts.get(i % 1000, 0) + 1
    audit = {r["dataset"]: (r["items"], r["pages"], r["extra_copies"]) for r in page_audit(pages).collect()}
    assert audit == {d: (3 * len(c), len(c), sum(c.values()) - len(c)) for d, c in expected.items()}
    assert repeated_pages(pages).count() == sum(n > 1 for c in expected.values() for n in c.values())
