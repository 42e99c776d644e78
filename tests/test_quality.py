import pytest

from tallyframe.operators import quality as dq


def test_suite_reports_exactly_the_seeded_violations(spark):
    parent = spark.createDataFrame([("k1", "a"), ("k2", "b"), ("k2", "b"), (None, "a"), ("k4", "x"), ("k5", None)],
                                   "key string, kind string")
    child = spark.createDataFrame([("c1", "k1"), ("c2", "k9"), ("c3", "k9"), ("c4", None), ("c5", "k2")],
                                  "child_id string, key string")
    suite = dq.Suite(unique=[("parent", "key"), ("child", "child_id")],
                     not_null=[("parent", "key"), ("parent", "kind"), ("child", "key")],
                     accepted_values=[("parent", "kind", ["a", "b"])],
                     relationships=[("child", "key", "parent", "key")])
    got = {(r.model, r.column_name, r.test_name): (r.failures, r.passed)
           for r in suite.run({"parent": parent, "child": child}).collect()}
    assert got == {
        ("parent", "key", "unique"): (1, False),            # k2 twice; null is not a duplicate
        ("child", "child_id", "unique"): (0, True),
        ("parent", "key", "not_null"): (1, False),
        ("parent", "kind", "not_null"): (1, False),
        ("child", "key", "not_null"): (1, False),
        ("parent", "kind", "accepted_values"): (1, False),  # one distinct bad value, null ignored
        ("child", "key", "relationships"): (2, False),      # two orphan rows, null child ignored
    }


def test_details(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "v string")
    assert [(r.v, r.occurrences) for r in dq.duplicate_values(df, "v").collect()] == [("a", 2)]
    assert sorted((r.v, r.occurrences) for r in dq.unexpected_values(df, "v", ["a"]).collect()) == [("b", 1)]


def test_capacity_precondition(spark):
    pool = spark.range(3)
    assert dq.require_capacity(pool, 3) == 3
    with pytest.raises(dq.CapacityError):
        dq.require_capacity(pool, 4)


def relations(spark, child, parent):
    """Failures of one reference by the single check and by the suite."""
    single = dq.check_relationships(child, "c", parent, "p", "child").first()
    suite = dq.Suite(relationships=[("child", "c", "parent", "p")]).run({"child": child, "parent": parent}).first()
    assert (single.failures, single.passed) == (suite.failures, suite.passed) and single.asDict() == suite.asDict()
    return suite.failures


@pytest.mark.parametrize("child,parent,orphans", [
    ("c int: 1, 2, 2, 7", "p decimal(10,2): 1.00, 2.00", 1),
    ("c decimal(10,2): 1.00, 1.50", "p int: 1", 1),
    ("c decimal(38,0): 1, 99999999999999999999999999999999999999", "p decimal(38,10): 1.0", 1),
    ("c bigint: 1, 3000000000", "p int: 1", 1),
    ("c double: 1.5, 0.0, -0.0", "p float: 1.5, 0", 0),
    ("c string: '01', '1.0', 'x', '2'", "p int: 1, 2", 2),
    ("c int: 5, 6", "p string: '5', 'y', null", 1),
    ("c date: date '2020-01-01', date '2020-01-02'", "p timestamp: timestamp '2020-01-01 00:00:00'", 1),
    ("c string: 'a', null, ''", "p string: 'a', null", 1),
    ("c boolean: true, false", "p boolean: true", 1),
    ("c string: 'a', 'b', 'a'", "p string: ", 3),
    ("c string: ", "p string: 'a'", 0),
])
def test_references_compare_in_a_common_type(spark, child, parent, orphans):
    def frame(spec):
        head, values = spec.split(":", 1)
        name, kind = head.split(" ", 1)
        values = [v for v in values.strip().split(", ") if v]
        rows = " union all ".join(f"select cast({v} as {kind}) as {name}" for v in values)
        return spark.sql(rows or f"select cast(null as {kind}) as {name} where false")
    assert relations(spark, frame(child), frame(parent)) == orphans


def test_types_that_cannot_be_compared(spark):
    with pytest.raises(TypeError):
        dq.check_relationships(spark.range(1), "id", spark.sql("select true as p"), "p", "m")


def test_bloom_filter_flags_only_missing_keys(spark):
    from tallyframe.operators.bloom import surely_absent
    keys = spark.range(0, 5000, 2).withColumnRenamed("id", "k")
    for words in (1 << 22, 16):        # 16: far too few, lets nearly everything through
        got = {r.id: r.absent for r in surely_absent(spark.range(5000), "id", keys, "k", most_words=words).collect()}
        assert not any(got[i] for i in range(0, 5000, 2))
    got = surely_absent(spark.range(5000), "id", keys, "k").filter("absent").count()
    assert got > 2300                  # nearly all of the 2500 missing ones
    none = surely_absent(spark.sql("select cast(null as bigint) as id"), "id", keys.filter("k < 0"), "k").first()
    assert none.absent


def test_suite_reads_each_table_once(spark, scratch):
    import os

    from helpers import plan_text
    tables = {}
    for name in ("a", "b"):
        path = os.path.join(scratch, name)
        spark.range(50).selectExpr("id", "id % 7 as k", "if(id > 40, null, 'x') as t").write.parquet(path)
        tables[name] = spark.read.parquet(path)
    suite = dq.Suite(unique=[("a", "id"), ("b", "k"), ("b", "id")], not_null=[("a", "t"), ("b", "t")], accepted_values=[("a", "t", ["y"])],
                     relationships=[("a", "k", "b", "id"), ("b", "id", "a", "k"), ("b", "k", "b", "id")])
    out = suite.run(tables)
    assert plan_text(out).count("FileScan parquet") == 2 and plan_text(out).count("Exchange hashpartitioning(g") == 2
    got = {(r.model, r.column_name, r.test_name): r.failures for r in out.collect()}
    assert got == {("a", "id", "unique"): 0, ("b", "k", "unique"): 7, ("b", "id", "unique"): 0, ("a", "t", "not_null"): 9,
                   ("b", "t", "not_null"): 9, ("a", "t", "accepted_values"): 1, ("a", "k", "relationships"): 0,
                   ("b", "id", "relationships"): 43, ("b", "k", "relationships"): 0}


def test_unique_over_nested_and_float_values(spark):
    df = spark.sql("select array(1) as a, 0.0D as f union all select array(1), -0.0D union all select array(2), double('nan') union all select null, double('nan')")
    got = {r.column_name: r.failures for r in dq.Suite(unique=[("m", "a"), ("m", "f")]).run({"m": df}).collect()}
    assert got == {"a": 1, "f": 2}


def test_suite_tells_its_entries_in_generated_code(spark):
    """Lambdas of array functions are interpreted, entry by entry: the suite's scans hold none."""
    from helpers import plan_text
    df = spark.createDataFrame([(1, "a"), (1, None), (None, "b")], "k int, v string")
    suite = dq.Suite(unique=[("t", "k")], not_null=[("t", "k"), ("t", "v")], accepted_values=[("t", "v", ["a"])],
                     relationships=[("t", "k", "p", "k")])
    out = suite.run({"t": df, "p": spark.createDataFrame([(2,), (None,)], "k int")})
    assert "lambda" not in plan_text(out)
    assert sorted((r.test_name, r.column_name, r.failures) for r in out.collect()) == [
        ("accepted_values", "v", 1), ("not_null", "k", 1), ("not_null", "v", 1), ("relationships", "k", 2), ("unique", "k", 1)]


def test_suite_keeps_one_count_per_value_however_many_tests_refer_to_a_parent(spark):
    from helpers import plan_text
    parent = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    tables = {"p": parent} | {f"c{i}": spark.createDataFrame([("a",), ("x",), ("x",), (f"y{i}",), (None,)], "k string") for i in range(6)}
    one = dq.Suite(unique=[("p", "k")], relationships=[("c0", "k", "p", "k")]).run(tables)
    out = dq.Suite(unique=[("p", "k")], relationships=[*[(f"c{i}", "k", "p", "k") for i in range(6)], ("c0", "k", "c1", "k"), ("c0", "k", "p", "k")]).run(tables)
    assert plan_text(out).count("partial_") == plan_text(one).count("partial_")
    assert sorted((r.model, r.test_name, r.failures) for r in out.collect()) == [
        ("c0", "relationships", 1), ("c0", "relationships", 3), ("c0", "relationships", 3), *[(f"c{i}", "relationships", 3) for i in range(1, 6)],
        ("p", "unique", 0)]
