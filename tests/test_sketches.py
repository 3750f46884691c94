import pytest
from conftest import rows

from carestrata.operators import quality, sketches


def lines(spark, n=20000):
    return spark.range(n).selectExpr(
        "id", "id % 7 as few", "if(id % 4 = 0, null, cast(id % 3000 as string)) as text",
        "cast(id as double) as x", "date_add(date'2020-01-01', cast(id % 100 as int)) as day", "array(id % 5) as list",
    )


def test_batches_merge_to_the_profile_of_the_whole(spark):
    df = lines(spark)
    batches = [sketches.column_sketches(df.where(f"id % 3 = {i}"), "t") for i in range(3)]
    got = {r.column_name: r for r in sketches.sketched_profile(sketches.merge_sketches(batches)).collect()}
    for exact in quality.field_profile(df, "t").collect():
        found = got[exact.column_name]
        assert (found.n_rows, found.n_null) == (exact.n_rows, exact.n_null)
        assert abs(found.n_distinct - exact.n_distinct) <= sketches.DISTINCT_ERROR * exact.n_distinct


def test_quantiles_are_within_the_stated_rank(spark):
    got = {r.column_name: r.quantiles for r in sketches.sketched_profile(sketches.column_sketches(lines(spark), "t")).collect()}
    low, first, median, third, high = got["x"]
    assert (low, high) == (0.0, 19999.0)
    for value, share in ((first, 0.25), (median, 0.5), (third, 0.75)):
        assert abs(value / 20000 - share) <= sketches.RANK_ERROR
    assert got["text"] is None and got["list"] is None
    assert got["day"][0] == 18262.0


def test_frequent_values(spark):
    df = spark.range(9000).selectExpr("if(id % 3 = 0, 'hot', concat('v', id)) as v", "if(id % 2 = 0, 'a', 'b') as w", "cast(null as string) as e")
    got = sketches.frequent_values(sketches.column_sketches(df, "t"), 2)
    assert rows(got.where("column_name = 'w'"), "value", "n_rows") == [("a", 4500), ("b", 4500)]
    top = got.where("column_name = 'v'").orderBy("n_rows", ascending=False).first()
    assert top.value == "hot" and 3000 <= top.n_rows <= 3000 + 3.5 * 0.75 / sketches.TRACKED * 9000
    assert got.where("column_name = 'e'").isEmpty()


def test_empty_table_and_awkward_names(spark):
    df = spark.createDataFrame([], "`a.b` int, lane string, rows double")
    got = sketches.sketched_profile(sketches.merge_sketches([sketches.column_sketches(df, "t", ["lane", "rows"])]))
    assert rows(got) == [("t", "lane", 0, 0, 0, None), ("t", "rows", 0, 0, 0, None)]


def test_one_scan_of_all_columns(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    plan = sketches.column_sketches(df, "lineitem")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1


def test_a_batch_loaded_again_replaces_its_former_self(spark):
    def stored(df, batch, at):
        return sketches.column_sketches(df, "t", ["few"]).selectExpr("*", f"'{batch}' as batch", f"{at} as loaded_at")

    df = lines(spark, 100)
    log = stored(df, "jan", 1).unionByName(stored(df.limit(40), "feb", 1)).unionByName(stored(df.limit(60), "jan", 2))
    merged = sketches.merge_sketches([sketches.latest_sketches(log).drop("batch")])
    assert rows(sketches.sketched_profile(merged), "column_name", "n_rows", "n_distinct") == [("few", 100, 7)]


@pytest.mark.parametrize("name", ["id", "x"])
def test_nan_is_a_value_without_a_rank(spark, name):
    df = spark.createDataFrame([(1, float("nan")), (2, 3.0)], "id long, x double")
    got = sketches.sketched_profile(sketches.column_sketches(df, "t", [name])).first()
    assert (got.n_null, got.n_distinct) == (0, 2)
    assert got.quantiles[0] == {"id": 1.0, "x": 3.0}[name]
