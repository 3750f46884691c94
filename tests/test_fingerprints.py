import os

import pytest
from conftest import rows

from carestrata.operators import fingerprints as fp
from carestrata.sources import datasets, manifest

SCHEMA = "id long, part long, name string, other string"


def table(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def brute(left, right):
    """Keys whose bags of rows differ, with the side."""
    keys = {r[:2] for r in left + right}
    bag = lambda data, key: sorted((r for r in data if r[:2] == key), key=str)
    sides = {k: (bag(left, k), bag(right, k)) for k in keys}
    return {k: "left" if not b else "right" if not a else "changed" for k, (a, b) in sides.items() if a != b}


BASE = [(i, i % 3, f"n{i % 7}", None if i % 5 else "x") for i in range(500)]


def test_digest_ignores_order_and_counts_repeats(spark):
    df = table(spark, BASE)
    assert rows(fp.digest(df)) == rows(fp.digest(df.orderBy("name").repartition(5)))
    assert rows(fp.digest(df)) != rows(fp.digest(df.union(df.limit(2))))
    twice = table(spark, [BASE[0]] * 2 + [BASE[1]])
    assert rows(fp.digest(twice)) != rows(fp.digest(table(spark, [BASE[0], BASE[1]] + [BASE[1]])))
    assert fp.digest(df.limit(0)).first().n_rows == 0


@pytest.mark.parametrize("one, other", [((1, 1, None, "a"), (1, 1, "a", None)), ((1, 1, "ab", "c"), (1, 1, "a", "bc")), ((1, None, "", None), (1, None, None, ""))])
def test_digest_tells_nulls_and_borders_apart(spark, one, other):
    assert rows(fp.digest(table(spark, [one]))) != rows(fp.digest(table(spark, [other])))


def test_difference_of_stored_versions(spark, tmp_path):
    right = [r for r in BASE if r[0] != 17]  # gone
    right[40] = (right[40][0], right[40][1], "changed", None)
    right += [BASE[3], (None, 1, "null key", None), (900, 0, "new", "y")]
    left = BASE + [(None, 1, "null key", "z")]
    left_path, right_path = f"{tmp_path}/l", f"{tmp_path}/r"
    for data, path in ((left, left_path), (right, right_path)):
        fp.write_version(table(spark, data), path, ["id", "part"], leaves=64, fanout=4)
    assert rows(fp.read_version(spark, right_path)) == rows(table(spark, right))
    got = fp.dataset_difference(spark, left_path, right_path, ["id", "part"], fanout=4)
    assert {(r.id, r.part): r.difference for r in got.collect()} == brute(left, right)
    by_key = {r.id: (r.n_left, r.n_right, r.changed_columns) for r in got.collect()}
    assert by_key[None] == (1, 1, "other") and by_key[3] == (1, 2, "name,other") and by_key[17] == (1, 0, "")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "branch" in plan.split("PartitionFilters: [")[1][:200]


def test_equal_and_empty_versions(spark, tmp_path):
    df = table(spark, BASE)
    paths = [f"{tmp_path}/{n}" for n in ("a", "b", "empty", "none")]
    for data, path in zip((df, df.repartition(7), df.limit(0), df.limit(0)), paths, strict=True):
        fp.write_version(data, path, ["id"])
    assert fp.dataset_difference(spark, paths[0], paths[1], ["id"]).isEmpty()
    assert fp.dataset_difference(spark, paths[2], paths[3], ["id"]).isEmpty()
    assert fp.dataset_difference(spark, paths[2], paths[0], ["id"]).where("difference = 'right'").count() == len(BASE)


def test_tree_sums_up_to_the_root(spark):
    df = table(spark, BASE)
    root = fp.hash_tree(df, ["id"], 64, 4).where("level = 0").drop("level", "node")
    assert rows(root) == rows(fp.digest(df))


def test_key_with_a_third_of_all_rows(spark):
    left = table(spark, BASE).unionByName(spark.range(5000).selectExpr("1 as id", "1 as part", "'hot' as name", "cast(id as string) as other"))
    got = fp.row_difference(left, left.where("other is null or other <> '77'"), ["id"])
    assert rows(got, "id", "difference", "n_left", "n_right") == [(1, "changed", 5001, 5000)]


def test_columns_must_agree(spark):
    with pytest.raises(ValueError, match="columns differ"):
        fp.row_difference(table(spark, BASE), table(spark, BASE).drop("other"), ["id"])


def test_edit_that_keeps_size_and_time_is_loaded(spark, tmp_path):
    folder, root = tmp_path / "in", f"{tmp_path}/out"
    folder.mkdir()
    file = folder / "a.csv"
    file.write_text("id\n1\n2\n")
    load = lambda: manifest.load_folder(spark, str(folder), root, by_contents=True)
    assert load() == ["a"]
    before = os.stat(file)
    file.write_text("id\n1\n3\n")
    os.utime(file, ns=(before.st_atime_ns, before.st_mtime_ns))
    assert load() == ["a"]
    assert rows(datasets.open_table(spark, root, "a")) == [("1",), ("3",)]
    os.utime(file)  # touched only
    assert load() == []
