import random

import pytest

from tideline import flatten


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_struct_beside_array_of_struct(spark):
    order = (41, ("north", 7.5), [("bolt", 3), ("nut", None), ("bolt", 3)])
    df = spark.createDataFrame(
        [order, (42, None, [("gear", 1)])],
        "no int, depot struct<zone:string,rate:double>, items array<struct<sku:string,qty:int>>",
    )
    flat = flatten(df)
    assert flat.columns == ["no", "zone", "rate", "sku", "qty"]
    assert sorted(map(tuple, flat.collect()), key=str) == sorted(
        [(41, "north", 7.5, "bolt", 3), (41, "north", 7.5, "nut", None), (41, "north", 7.5, "bolt", 3),
         (42, None, None, "gear", 1)], key=str,
    )
    assert flatten(flat).columns == flat.columns


def test_inner_and_outer(spark):
    df = spark.createDataFrame([(1, [7, 8]), (2, []), (3, None)], "id int, n array<int>")
    assert rows(flatten(df)) == [(1, 7), (1, 8)]
    kept = flatten(df, outer=True).orderBy("id", "n").collect()
    assert [tuple(r) for r in kept] == [(1, 7), (1, 8), (2, None), (3, None)]


def test_null_struct_gives_null_fields(spark):
    df = spark.createDataFrame([(None, 1)], "s struct<a:int,b:struct<c:int>>, d int")
    flat = flatten(df)
    assert flat.columns == ["a", "c", "d"]
    assert flat.first() == (None, None, 1)


def test_array_of_array_and_deep(spark):
    df = spark.createDataFrame([([[1, 2], [3]],)], "n array<array<int>>")
    assert rows(flatten(df)) == [(1,), (2,), (3,)]
    deep = spark.createDataFrame(
        [("r", [("n1", [("s1",), ("s2",)]), ("n2", [("s3",)])])],
        "region string, nations array<struct<nation:string, sups:array<struct<sup:string>>>>",
    )
    assert rows(flatten(deep)) == [("r", "n1", "s1"), ("r", "n1", "s2"), ("r", "n2", "s3")]


def test_sibling_arrays_combine(spark):
    df = spark.createDataFrame([(1, [1, 2], ["a", "b"])], "id int, n array<int>, t array<string>")
    assert rows(flatten(df)) == [(1, 1, "a"), (1, 1, "b"), (1, 2, "a"), (1, 2, "b")]


def test_maps(spark):
    df = spark.createDataFrame([(1, {"a": 5, "b": 6})], "id int, m map<string,int>")
    assert flatten(df).columns == ["id", "m"]
    assert flatten(df, maps="drop").columns == ["id"]
    exploded = flatten(df, maps="explode")
    assert exploded.columns == ["id", "m_key", "m_value"]
    assert rows(exploded) == [(1, "a", 5), (1, "b", 6)]


def test_name_clash(spark):
    df = spark.createDataFrame([((1,), (2,), 3)], "x struct<a:int>, y struct<a:int>, z int")
    with pytest.raises(ValueError, match="clash"):
        flatten(df)
    flat = flatten(df, on_duplicate="prefix")
    assert flat.columns == ["x_a", "y_a", "z"]
    assert flat.first() == (1, 2, 3)


def test_names_with_dots(spark):
    df = spark.createDataFrame([((1,), [2])], "`a.b` struct<`c.d`:int>, `e f` array<int>")
    flat = flatten(df)
    assert flat.columns == ["c.d", "e f"]
    assert flat.first() == (1, 2)


def brute_force(record, outer):
    """Flat rows of (a, b, y, z) by plain loops."""

    def items(values):
        return [None] if outer and not values else values or []

    out = []
    for x in items(record["xs"]):
        for y in items(x["ys"] if x else None):
            for z in items(record["zs"]):
                out.append((record["s"]["a"] if record["s"] else None, x["b"] if x else None, y, z))
    return out


@pytest.mark.parametrize("outer", [False, True])
def test_random_nesting_against_loops(spark, outer):
    rnd = random.Random(3)

    def some(make):
        return rnd.choice([None, [], [make() for _ in range(rnd.randrange(1, 4))]])

    def element():
        return None if rnd.random() < 0.1 else {"b": rnd.randrange(9), "ys": some(lambda: rnd.randrange(9))}

    records = [
        {
            "s": rnd.choice([None, {"a": rnd.randrange(9)}]),
            "xs": some(element),
            "zs": some(lambda: rnd.choice("pqr")),
        }
        for _ in range(200)
    ]
    df = spark.createDataFrame(
        records, "s struct<a:int>, xs array<struct<b:int,ys:array<int>>>, zs array<string>"
    )
    flat = flatten(df, outer=outer)
    assert flat.columns == ["a", "b", "ys", "zs"]
    wanted = [row for r in records for row in brute_force(r, outer)]
    assert sorted(map(str, (tuple(r) for r in flat.collect()))) == sorted(map(str, wanted))
    again = flatten(flat, outer=outer)
    assert again.schema == flat.schema and again.count() == len(wanted)


def test_only_the_needed_fields_are_read(spark, tmp_path):
    path = str(tmp_path / "nested")
    spark.range(5).selectExpr(
        "id", "array(named_struct('b', id, 'unused', id)) AS xs", "struct(id AS spare) AS s"
    ).write.parquet(path)
    plan = flatten(spark.read.parquet(path)).select("b")._jdf.queryExecution().executedPlan().toString()
    assert "unused" not in plan.split("ReadSchema")[1] and "spare" not in plan.split("ReadSchema")[1]
