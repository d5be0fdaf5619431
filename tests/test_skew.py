"""One key with a third of all rows must not end up in one task."""

import pytest
from pyspark.sql import functions as F

from deedflow.operators import gates, integrity
from deedflow.operators.effects import reopen
from deedflow.operators.ordering import with_ids, with_previous
from deedflow.operators.skew import spread_join

N = 60_000
PARTS = 16


@pytest.fixture
def shuffled(spark):
    """Shuffle joins with a fixed number of partitions, so that they can be counted."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": str(PARTS),
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield spark
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def rows(shuffled):
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 3 == 1, None).otherwise(F.col("id"))
    return shuffled.range(N, numPartitions=8).select(F.col("id").alias("seq"), key.alias("k"))


def per_task(frame):
    """Rows per task; every column is used, or Spark would leave the join out."""
    used = F.max(F.xxhash64(*frame.columns))
    return frame.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), used)


def largest_share(frame):
    sizes = [r.n for r in per_task(frame).collect()]
    assert sum(sizes) == N
    return max(sizes) / N


def test_a_plain_join_on_an_aggregate_is_lopsided(rows):
    state = rows.groupBy("k").agg(F.max("seq").alias("last"))
    assert largest_share(rows.join(state, "k", "left")) > 0.3


def test_spread_join_deals_out_hot_and_null_keys(rows):
    state = rows.filter("k IS NOT NULL").groupBy("k").agg(F.max("seq").alias("last"))
    joined = spread_join(rows, state, ["k"], "seq", hot_rows=500)
    assert largest_share(joined) < 0.15
    assert joined.filter("k IS NOT NULL AND last IS NULL").count() == 0


def test_previous_rows_of_a_hot_key_are_found_in_blocks(rows):
    chained = with_previous(rows.withColumn("v", F.lit("x")), "k", "seq", "v", "p", hot_rows=500)
    assert largest_share(chained) < 0.2
    assert chained.filter("k = 1 AND p IS NULL").count() == 1


def test_previous_rows_of_a_hot_key_with_sparse_numbers(rows):
    sparse = rows.withColumn("seq", F.col("seq") * 1_000_003).withColumn("v", F.col("seq"))
    chained = with_previous(sparse, "k", "seq", "v", "p", hot_rows=500)
    assert largest_share(chained) < 0.2
    assert chained.filter("k = 1 AND seq > 0 AND p != seq - 3000009").count() == 0
    assert chained.filter("k = 1 AND p IS NULL").count() == 1


def test_reopening_spreads_what_is_no_house(shuffled):
    kind = F.when(F.col("id") % 14 == 0, "House").otherwise("Villa")
    frame = shuffled.range(N, numPartitions=8).select(
        F.col("id").alias("property_ID"), kind.alias("property_TYPE"), F.lit("Sold").alias("prop_status")
    )
    opened = reopen(frame, frame.filter("property_ID % 2 = 0"))
    assert largest_share(opened) < 0.15
    assert opened.filter("prop_status = 'For Sale'").count() == frame.filter("property_ID % 14 = 0").count()


def test_ids_are_given_in_blocks(shuffled):
    frame = shuffled.range(0, N * 64, 64, numPartitions=8).withColumnRenamed("id", "seq")
    numbered = with_ids(frame, "seq", "n")
    assert largest_share(numbered) < 0.3
    assert numbered.filter("n != seq / 64 + 1").count() == 0


@pytest.mark.parametrize("gate", ["sold", "exclusivity", "appointment", "review"])
def test_gates_spread_a_hot_key(shuffled, rows, gate):
    batch = rows.select(
        "seq", F.col("k").alias("property_ID"), F.col("k").alias("date_contract"), F.lit("No").alias("exclusivity"),
        F.col("seq").alias("date_appointment"), F.col("seq").alias("date_review"),
    )
    others = shuffled.range(1000).select(
        F.col("id").alias("property_ID"), F.col("id").alias("date_contract"), F.lit("No").alias("exclusivity"),
        F.col("id").alias("date_transaction"), F.lit("For Sale").alias("prop_status"),
    )
    judge = getattr(gates, f"{gate}_gate")
    assert largest_share(judge(batch, others, hot_rows=500)) < 0.15


def test_joins_of_stored_tables_are_split_at_run_time(shuffled, rows, tmp_path):
    conf = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "32k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
    }
    before = {k: shuffled.conf.get(k) for k in conf}
    for key, value in conf.items():
        shuffled.conf.set(key, value)
    try:
        rows.write.parquet(str(tmp_path / "rows"))
        shuffled.range(N).withColumnRenamed("id", "k").write.parquet(str(tmp_path / "parents"))
        child = shuffled.read.parquet(str(tmp_path / "rows"))
        parents = shuffled.read.parquet(str(tmp_path / "parents"))
        kept = integrity.set_null(child, "k", parents, "k")
        assert kept.filter("k IS NOT NULL").count() == 0
        observed = per_task(kept)
        observed.collect()
        assert "skew=true" in observed._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            shuffled.conf.set(key, value)
