import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from feedloom.operators import skew
from feedloom.sources.files import identified


def skewed(spark, n=200):
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.lit(None)).otherwise(
            F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))
        ).alias("k"),
        ((F.col("id") * 37) % 101).alias("v"), "id",
    )


def test_hot_keys_found(spark, hot):
    found = {r["k"] for r in skew.hot_keys(skewed(spark), ["k"]).collect()}
    assert found == {"hot", None}


def test_inputs_below_the_limit_have_no_hot_key(spark):
    assert skew.hot_keys(skewed(spark), ["k"]) is None


def test_every_key_above_the_limit_is_hot(spark, hot):
    many = spark.range(1200 * 11).select((F.col("id") % 1200).alias("k"), "id")
    assert skew.hot_keys(many, ["k"]).count() == 1200
    got = skew.numbered(many, ["k"], ["id"], "n").groupBy("n").count().collect()
    assert {r["n"]: r["count"] for r in got} == {n: 1200 for n in range(1, 12)}


def test_row_numbers(spark, request):
    df = skewed(spark)
    expected = rows(skew.numbered(df, ["k"], ["v", "id"], "n"), "id")
    request.getfixturevalue("hot")
    assert rows(skew.numbered(df, ["k"], ["v", "id"], "n").select("k", "v", "id", "n"), "id") == expected


def test_lookup_join(spark, request):
    df = skewed(spark)
    lookup = spark.createDataFrame([("hot", 1), ("k5", 2), ("none", 3)], "k string, w int")
    expected = {how: rows(skew.lookup_join(df, lookup, ["k"], how), "id") for how in ("left", "inner")}
    request.getfixturevalue("hot")
    for how, plain in expected.items():
        assert rows(skew.lookup_join(df, lookup, ["k"], how), "id") == plain


def test_top_per_key_reduces_before_the_shuffle(spark):
    plan = skew.top_per_key(skewed(spark), ["k"], [F.desc("v"), F.desc("id")])._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_copies_get_ids_of_their_own(spark):
    line = ("same", "f.csv", dt.datetime(2026, 1, 1))
    df = spark.createDataFrame([line] * 25 + [("other", *line[1:])], "x string, source_file string, source_modified_at timestamp")
    ids = {
        n: rows(identified(df.repartition(parts), "1", copies_per_task=n).select("x", "row_id"), "x", "row_id")
        for n, parts in ((1000, 1), (7, 5), (1, 3))
    }
    assert len(ids[1000]) == len(set(ids[1000])) == 26
    assert ids[1000] == ids[7] == ids[1]
