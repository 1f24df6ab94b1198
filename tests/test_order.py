import random

from biomesheaf.operators import alignments as al


def test_order_is_total_over_partitions_ties_and_nulls(spark):
    rng = random.Random(2)
    rows = [(rng.choice("ab"), rng.choice(["c1", "c2", None]), rng.randrange(5), f"r{rng.randrange(300)}") for _ in range(3000)]
    rows += [("a", "c1", 2, f"hot{i:04d}") for i in range(1500)]
    df = spark.createDataFrame(rows, "sample string, rname string, pos long, qname string").repartition(7)
    key = lambda r: (r[0], r[1] is not None, r[1] or "", r[2], r[3])
    for ordered in (al.sort_by_coordinate(df), al.sort_by_coordinate(df, 6)):
        got = [tuple(r) for r in ordered.collect()]
        assert got == sorted(rows, key=key)
    # A position that holds a third of all rows is dealt over several ranges.
    hot = al.sort_by_coordinate(df, 6).selectExpr("spark_partition_id() as part", "qname").where("qname like 'hot%'")
    assert hot.select("part").distinct().count() > 1


def test_order_of_nothing_is_empty(spark):
    assert al.sort_by_coordinate(spark.createDataFrame([], "sample string, rname string, pos long, qname string")).count() == 0
