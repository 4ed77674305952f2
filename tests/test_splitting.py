import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickscore.operators import splitting as E


def table(spark, n=12_205, pos=1_908):
    return spark.range(n).select(
        F.col("id").alias("row_id"), (F.col("id") < pos).cast("int").alias("label")
    )


def test_exact_quota_of_the_published_split(spark):
    got = E.stratified_split(table(spark)).groupBy("label", "is_test").count().collect()
    assert {(r["label"], r["is_test"]): r["count"] for r in got} == {
        (0, True): 2059, (1, True): 382, (0, False): 8238, (1, False): 1526,
    }


def test_split_does_not_depend_on_partitioning(spark):
    df = table(spark, 3_000, 500)
    pick = lambda d: {r["row_id"] for r in E.stratified_split(d).filter("is_test").collect()}
    assert pick(df) == pick(df.repartition(13)) == pick(df.coalesce(1))


def test_another_seed_gives_another_split(spark):
    df = table(spark, 500, 100)
    pick = lambda s: {r["row_id"] for r in E.stratified_split(df, seed=s).filter("is_test").collect()}
    assert pick(1) != pick(2)


def test_deep_refinement_finds_the_same_cut(spark):
    df = table(spark, 4_000, 700)
    ranks = lambda sizes: {y: [1, n // 3, n] for y, n in sizes.items()}
    args = (df, "label", "row_id", 42, ranks)
    keys = E._cut_keys(*args, most=1)
    assert keys == E._cut_keys(*args, most=10**9)
    for y in (0, 1):
        every = sorted(r["k"] for r in df.filter(f"label = {y}").select(E.hash_key().alias("k")).collect())
        n = len(every)
        assert [k[:32] for k in keys[y]] == [every[0], every[n // 3 - 1], every[-1]]


@pytest.mark.parametrize("ids", ["CAST(7 AS BIGINT)", "CAST(NULL AS BIGINT)", "id % 3"])
def test_repeated_and_missing_ids_keep_the_quota(spark, ids):
    df = spark.range(5_000).selectExpr(f"{ids} AS row_id", "id AS other", "CAST(id % 5 = 0 AS INT) AS label").repartition(7)
    got = {(r["label"], r["is_test"]): r["count"] for r in E.stratified_split(df).groupBy("label", "is_test").count().collect()}
    assert got == {(0, True): 800, (0, False): 3200, (1, True): 200, (1, False): 800}
    sizes = [r["count"] for r in E.stratified_folds(df, k=5).groupBy("label", "fold").count().collect()]
    assert sorted(sizes) == [200] * 5 + [800] * 5


def test_folds_are_balanced_in_every_class(spark):
    got = E.stratified_folds(table(spark, 1_003, 202), k=5).groupBy("label", "fold").count().collect()
    for y in (0, 1):
        sizes = [r["count"] for r in got if r["label"] == y]
        assert len(sizes) == 5 and max(sizes) - min(sizes) <= 1


def test_tiny_classes(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 1)], "row_id bigint, label int")
    got = E.stratified_split(df).groupBy("is_test").count().collect()
    assert {r["is_test"]: r["count"] for r in got} == {True: 1, False: 2}
    assert E.stratified_folds(df, k=5).filter("fold IS NULL").count() == 0


@given(st.dictionaries(st.integers(0, 4), st.integers(1, 10_000), min_size=1), st.floats(0.01, 0.9))
def test_quota_adds_up(sizes, share):
    import math

    quota = E.holdout_quota(sizes, share)
    assert sum(quota.values()) == math.ceil(share * sum(sizes.values()))
    assert all(0 <= quota[y] <= sizes[y] for y in sizes)


def test_class_weights(spark):
    got = {r["label"]: r for r in E.class_weights(table(spark, 10, 2)).collect()}
    assert got[0]["balanced_weight"] == 0.625 and got[1]["balanced_weight"] == 2.5
    assert got[0]["positive_weight"] == 4.0
    none = {r["label"]: r for r in E.class_weights(table(spark, 4, 0)).collect()}
    assert none[1]["balanced_weight"] is None and none[0]["positive_weight"] == 4.0


def test_sample_params_without_replacement():
    grid = {"a": [1, 2, 3], "b": ["x", "y"]}
    draws = E.sample_params(grid, 4)
    assert len(draws) == 4 == len({tuple(sorted(d.items())) for d in draws})
    assert len(E.sample_params(grid, 30)) == 6
    assert E.sample_params(grid, 4) == draws


@pytest.mark.parametrize("n", [1, 7])
def test_head_rows(spark, n):
    assert [r["row_id"] for r in E.head_rows(table(spark, 50, 5), n).collect()] == list(range(n))
