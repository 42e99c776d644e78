import pytest

from tallyframe import session


def test_shared_folder_check(spark, scratch):
    session._CHECKED.clear()
    session.check_shared(spark, f"file://{scratch}/shared")
    assert len(session._CHECKED) == 1
    session.check_shared(spark, f"file://{scratch}/shared")          # once per session and folder
    import os
    assert os.listdir(f"{scratch}/shared") == []
    with open(f"{scratch}/a_file", "w") as f:
        f.write("x")
    with pytest.raises(RuntimeError):
        session.check_shared(spark, f"file://{scratch}/a_file")


def test_local_mode_uses_the_configured_folder(spark):
    assert session.ensure_checkpoint_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert session._in_one_process(spark)


def test_a_changed_table_is_read_with_its_new_columns(spark, scratch):
    from tallyframe.sources import testdata as td
    spark.range(3).coalesce(1).write.mode("overwrite").parquet(f"{scratch}/t.parquet")
    assert td.table(spark, scratch, "t").columns == ["id"] and td.table(spark, scratch, "t").columns == ["id"]
    spark.range(3).selectExpr("id", "id as v").coalesce(1).write.mode("overwrite").parquet(f"{scratch}/t.parquet")
    assert td.table(spark, scratch, "t").columns == ["id", "v"]
