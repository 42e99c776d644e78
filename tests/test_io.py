import os

from tallyframe.sources import sinks, text


def write(path, content):
    with open(path, "w", encoding="utf-8") as f:
        f.write(content)


def test_text_csv_keeps_text_and_quotes(spark, scratch):
    p = os.path.join(scratch, "accounts.csv")
    write(p, 'account_id,account_name,per_member_rate\n'
             'a1,"Acme, Inc.",12.50\n'
             'a2,"Zoë ""Z"" Ltd",\n'
             'a3,"",4.0\n')
    df = text.read_text_csv(spark, p)
    assert all(t == "string" for _, t in df.dtypes)
    got = {r.account_id: r for r in df.collect()}
    assert got["a1"].account_name == "Acme, Inc."
    assert got["a2"].account_name == 'Zoë "Z" Ltd' and got["a2"].per_member_rate is None
    assert got["a3"].account_name in ("", None) and got["a3"].per_member_rate == "4.0"


def test_multi_file_pool(spark, scratch):
    a, b = os.path.join(scratch, "m1.csv"), os.path.join(scratch, "m2.csv")
    write(a, "Id,ActivityDate\n1,2016-04-12\n")
    write(b, "Id,ActivityDate\n1,2016-05-12\n2,2016-05-13\n")
    assert text.read_text_csv(spark, [a, b]).count() == 3


def test_registry_skips_missing_and_full_refresh_is_rerunnable(spark, scratch):
    write(os.path.join(scratch, "plans.csv"), "plan_id,plan_name,tier,monthly_price\np1,Standard,standard,14.99\n")
    loaded = text.load_registry(spark, scratch, {"plans": "plans.csv", "orders": "orders.csv"})
    assert set(loaded.tables) == {"plans"} and set(loaded.skipped) == {"orders"}
    report = sinks.load_all(spark, loaded.tables, "raw_test", skipped=loaded.skipped)
    assert sorted((r.table_name, r.status, r.rows) for r in report.collect()) == [
        ("orders", "skipped", None), ("plans", "loaded", 1)]
    again = sinks.load_all(spark, loaded.tables, "raw_test")
    assert again.collect()[0].rows == 1
    assert text.named_table(spark, "plans", "raw_test").count() == 1


def test_csv_sink_column_order(spark, scratch):
    df = spark.createDataFrame([("b", "a, with comma")], "y string, x string")
    out = os.path.join(scratch, "out")
    sinks.write_csv(df, out, ["x", "y"])
    back = text.read_text_csv(spark, out)
    assert back.columns == ["x", "y"] and back.collect()[0].x == "a, with comma"


def test_view(spark):
    sinks.as_view(spark.range(2), "two_rows")
    assert spark.sql("select count(*) as n from two_rows").collect()[0].n == 2


def test_scale_settings_fill_only_unset(spark):
    from tallyframe.session import configure_for_scale
    spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    changed = configure_for_scale(spark)
    assert "spark.sql.adaptive.advisoryPartitionSizeInBytes" in changed
    assert "spark.sql.adaptive.enabled" not in changed   # already set by the test session
    assert configure_for_scale(spark) == {}


def test_full_refresh_to_a_given_location(spark, scratch):
    df = spark.range(5).withColumnRenamed("id", "k")
    base = os.path.join(scratch, "warehouse_path")
    report = sinks.load_all(spark, {"five": df}, "path_test", base_path=base)
    assert report.collect()[0].rows == 5
    assert spark.read.parquet(sinks.live_version(spark, os.path.join(base, "five"))).count() == 5
    again = sinks.load_all(spark, {"five": spark.range(2).withColumnRenamed("id", "k")}, "path_test", base_path=base)
    assert again.collect()[0].rows == 2 and spark.table("path_test.five").count() == 2


def test_columns_are_matched_by_name(spark, scratch):
    import os
    import pytest
    from tallyframe.sources.text import read_text_csv, text_schema
    def put(name, text):
        path = os.path.join(scratch, name)
        with open(path, "w") as f:
            f.write(text)
        return path
    one, two = put("a.csv", "id,x\n1,ax\n"), put("b.csv", "x,id\nbx,2\n")
    want = [("1", "ax"), ("2", "bx")]
    assert sorted((r.id, r.x) for r in read_text_csv(spark, [one, two]).collect()) == want
    assert sorted((r.id, r.x) for r in read_text_csv(spark, os.path.join(scratch, "*.csv")).collect()) == want
    for other in ("id\n3\n", "id,x,y\n3,c,d\n"):
        with pytest.raises(ValueError):
            read_text_csv(spark, [one, put("c.csv", other)])
    with pytest.raises(Exception):
        read_text_csv(spark, [two], schema=text_schema(["id", "x"])).collect()


def test_a_refresh_that_fails_leaves_the_table(spark, scratch):
    import pytest
    at = os.path.join(scratch, "t")
    sinks.full_refresh(spark.range(3), "kept", path=at)
    live = sinks.live_version(spark, at)
    bad = spark.range(100).selectExpr("cast(if(id = 77, 'x', '1') as int) as id")
    with pytest.raises(Exception):
        sinks.full_refresh(bad, "kept", path=at)
    assert sinks.live_version(spark, at) == live and spark.table("kept").count() == 3
    reader = spark.table("kept")                             # of the version that is live now
    assert sinks.full_refresh(spark.range(7), "kept", path=at) == 7
    assert spark.table("kept").count() == 7 and reader.count() == 3
    for n in range(3):
        sinks.full_refresh(spark.range(n), "kept", path=at)
    assert len([v for v in os.listdir(at) if v.startswith("v-")]) == 2 and spark.table("kept").count() == 2


def test_a_table_of_an_older_load_is_replaced(spark, scratch):
    spark.range(4).write.mode("overwrite").saveAsTable("older_load")
    assert sinks.full_refresh(spark.range(2), "older_load") == 2 and spark.table("older_load").count() == 2


def test_header_census_takes_one_job(spark, scratch):
    for i in range(40):
        write(os.path.join(scratch, f"f {i}.csv"), ("a,b\n" if i % 3 else "b,a\n") + "".join(f"{i},{k}\n" for k in range(50)))
    write(os.path.join(scratch, "empty.csv"), "")
    files = text._files(spark, scratch)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("census", "census")
    got = text.header_census(spark, files)
    spark.sparkContext.setJobGroup("other", "other")
    assert len(tracker.getJobIdsForGroup("census")) <= 2     # one, and Spark's own listing of many paths
    assert {k: len(v) for k, v in got.items()} == {"a,b": 26, "b,a": 14, None: 1}
    assert text.header_census(spark, []) == {} and text.header_census(spark, files[:1]) == {None: files[:1]}
    os.rename(os.path.join(scratch, "empty.csv"), os.path.join(scratch, "_empty"))
    df = text.read_text_csv(spark, scratch)
    assert df.count() == 2000
    assert df.filter("cast(a as int) >= 40").count() == 14 * 10        # rows of files with the columns exchanged
