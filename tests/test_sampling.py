"""Sizes, determinism and partition independence of the seeded operators."""

from pyspark.sql import functions as F

from polarity.operators import sampling as S
from polarity.operators.ordering import ordered_rank


def ids(spark, n, parts=4):
    return spark.range(n, numPartitions=parts).withColumnRenamed("id", "id")


def test_sample_round_half_even(spark):
    assert S.sample_exact(ids(spark, 5), 0.5, 7).count() == 2
    assert S.exact_count(0.5, 5) == 2 and S.exact_count(0.5, 7) == 4


def test_split_three_sizes_and_cover(spark):
    df = S.split_three(ids(spark, 1000), 0.3, 0.2, 7)
    counts = {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}
    assert counts == {"labeled": 140, "unlabeled": 560, "test": 300}
    assert df.select("id").distinct().count() == 1000


def test_split_train_valid_ceil(spark):
    df = S.split_train_valid(ids(spark, 101), 0.1, 230)
    counts = {r["part"]: r["count"] for r in df.groupBy("part").count().collect()}
    assert counts == {"valid": 11, "train": 90}
    assert S.split_train_valid(ids(spark, 101), use_all=True).filter("part='train'").count() == 101


def test_partition_independent(spark):
    a = S.sample_exact(ids(spark, 777, 1), 0.3, 11).orderBy("id").collect()
    b = S.sample_exact(ids(spark, 777, 17).repartition(17), 0.3, 11).orderBy("id").collect()
    assert a == b and len(a) == 233
    r1 = S.global_rank(ids(spark, 500, 1), "id", 3).orderBy("id").collect()
    r2 = S.global_rank(ids(spark, 500, 9).repartition(9), "id", 3).orderBy("id").collect()
    assert r1 == r2
    assert sorted(r["pos"] for r in r1) == list(range(500))


def test_threshold_refinement_matches_rank(spark, monkeypatch):
    # force the multi-round prefix search on a small table
    monkeypatch.setattr(S, "EXACT_ROWS", 50)
    df = ids(spark, 3000, 6)
    picked = {r["id"] for r in S.sample_exact(df, 0.37, 5).collect()}
    ranked = S.global_rank(df, "id", 5).filter(F.col("pos") < 1110)
    assert len(picked) == 1110 and picked == {r["id"] for r in ranked.collect()}


def test_assign_batches_drop_last(spark):
    b = S.assign_batches(ids(spark, 601), 64, epoch=0, seed=7, drop_last=True)
    assert b.count() == 576 and b.select("batch_id").distinct().count() == 9
    other = S.assign_batches(ids(spark, 601), 64, epoch=1, seed=7)
    assert b.select("id", "batch_id", "slot").collect() != other.select(
        "id", "batch_id", "slot").collect()


def test_assign_batches_no_shuffle_keeps_order(spark):
    b = S.assign_batches(ids(spark, 130, 3), 64, shuffle=False).orderBy("id").collect()
    assert [(r["batch_id"], r["slot"]) for r in b[:2]] == [(0, 0), (0, 1)]
    assert (b[129]["batch_id"], b[129]["slot"]) == (2, 1)


def test_tile_to_cover(spark):
    lab = ids(spark, 399)
    unl = spark.range(1000, 1601)
    t = S.tile_to_cover(lab, unl)
    assert t.count() == 798 and t.select("copy").distinct().count() == 2


def test_zip_batches_shapes(spark):
    lab = ids(spark, 399).withColumn("label", (F.col("id") % 2).cast("int"))
    unl = spark.range(1000, 1601)
    z = S.zip_batches(S.tile_to_cover(lab, unl), unl, 64, 0, (1, 2, 3))
    assert z.count() == 576
    assert z.select("unlabel1_id").distinct().count() == 576


def test_ordered_rank_in_groups(spark):
    df = spark.range(0, 1000, numPartitions=5).select(
        (F.col("id") % 3).alias("g"), (1000 - F.col("id")).alias("o"))
    r = ordered_rank(df, ["o"], ["g"], "rk", num_partitions=7).collect()
    by = {}
    for row in r:
        by.setdefault(row["g"], []).append((row["o"], row["rk"]))
    for g, pairs in by.items():
        pairs.sort()
        assert [rk for _, rk in pairs] == list(range(len(pairs)))


def test_complement(spark):
    from polarity.operators.joins import complement
    whole = ids(spark, 100)
    part = S.sample_exact(whole, 0.7, 7)
    rest = complement(whole, part, "id")
    assert rest.count() == 30
    assert rest.join(part, "id").count() == 0


def test_repeated_hot_key_still_exact(spark, monkeypatch):
    from polarity.operators import ordering as O
    monkeypatch.setattr(O, "TARGET_BUCKET_ROWS", 10)
    monkeypatch.setattr(O, "HOT_BUCKET_FACTOR", 2)
    monkeypatch.setattr(S, "EXACT_ROWS", 20)
    # half of all rows share one key
    df = spark.range(300, numPartitions=6).select(
        F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id") + 1000).alias("id"))
    r = S.global_rank(df, "id", 3).collect()
    assert sorted(x["pos"] for x in r) == list(range(300))
    assert S.sample_exact(df, 0.4, 3).count() == 120
