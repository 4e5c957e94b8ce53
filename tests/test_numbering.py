import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from chatlake.operators.numbering import block_window, neighbour_blocks, number_rows
from chatlake.operators.runs import conversation_runs


def random_rows(spark, n, seed=3):
    rng = random.Random(seed)
    rows = [(rng.choice([1, 1, 1, 2, 3]), rng.randrange(5), uid) for uid in range(n)]
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "k long, t long, uid long").repartition(6)


@pytest.mark.parametrize("hot_rows", [1, 50, 10**6])
def test_numbers_equal_a_plain_window(spark, hot_rows):
    rows = random_rows(spark, 500)
    group = Window.partitionBy("k")
    expected = rows.select(
        "*",
        (F.row_number().over(group.orderBy("t", "uid")) - 1).cast("long").alias("position"),
        F.count(F.lit(1)).over(group).alias("total"),
    )
    found = number_rows(rows, "k", ("t", "uid"), total="total", hot_rows=hot_rows)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_hot_group_is_spread_over_tasks(spark):
    rows = spark.range(40_000).select(F.lit(7).alias("k"), (F.col("id") % 3).alias("t"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = number_rows(rows, "k", ("t", "id"), hot_rows=1000)
        per_task = placed.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(per_task) > 1 and max(r["count"] for r in per_task) < 30_000
    assert placed.agg(F.count_distinct("position"), F.max("position")).first() == (40_000, 39_999)


def test_neighbour_blocks_give_every_predecessor(spark):
    rows = spark.range(100).select(F.lit("a").alias("k"), F.col("id").alias("p"))
    window = block_window("p", "k")
    looked = neighbour_blocks(rows, "p", 3, block_rows=7).select(
        "p", "is_own", *[F.lag("p", n).over(window).alias(f"b{n}") for n in (1, 2, 3)])
    found = {r.p: (r.b1, r.b2, r.b3) for r in looked.filter("is_own").collect()}
    assert found == {p: tuple(p - n if p >= n else None for n in (1, 2, 3)) for p in range(100)}
    with pytest.raises(ValueError):
        neighbour_blocks(rows, "p", 3, block_rows=3)


def test_runs_fixture(spark):
    rows = spark.createDataFrame([(1, 0, 1), (1, 1, 2), (2, 2, 3)],
                                 "chat_id long, timestamp long, message_id long")
    runs = conversation_runs(rows).orderBy("run_index").collect()
    assert [(r.chat_id, r.message_count) for r in runs] == [(1, 2), (2, 1)]


@pytest.mark.parametrize("hot_rows,block_rows", [(10**6, 10**5), (10, 7), (10, 2)])
def test_runs_against_a_loop(spark, hot_rows, block_rows):
    rng = random.Random(5)
    chats = [rng.choice([1, 1, 2, 3]) for _ in range(300)]
    expected, last = [], None
    for chat in chats:
        if chat == last:
            expected[-1][1] += 1
        else:
            expected.append([chat, 1])
        last = chat
    rows = spark.createDataFrame([(c, n // 3, n) for n, c in enumerate(chats)],
                                 "chat_id long, timestamp long, message_id long").repartition(5)
    runs = conversation_runs(rows, hot_rows=hot_rows, block_rows=block_rows)
    found = [[r.chat_id, r.message_count] for r in runs.orderBy("run_index").collect()]
    assert found == expected
    assert [r.run_index for r in runs.orderBy("run_index").collect()] == list(range(len(found)))
