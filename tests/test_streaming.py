import os

from tallyframe.streaming.ingest import ingest_new_files


def test_incremental_ingest_reads_each_file_once(spark, scratch):
    src, dst = os.path.join(scratch, "in"), os.path.join(scratch, "out")
    ckpt = os.path.join(scratch, "ckpt")
    os.makedirs(src)
    with open(os.path.join(src, "a.csv"), "w") as f:
        f.write("order_id,amount\no1,1.0\no2,2.0\n")
    ingest_new_files(spark, src, ["order_id", "amount"], dst, "orders", checkpoint=ckpt)
    assert spark.read.parquet(dst).count() == 2
    with open(os.path.join(src, "b.csv"), "w") as f:
        f.write("order_id,amount\no3,3.0\n")
    ingest_new_files(spark, src, ["order_id", "amount"], dst, "orders", checkpoint=ckpt)
    out = spark.read.parquet(dst)
    assert sorted(r.order_id for r in out.collect()) == ["o1", "o2", "o3"]
    assert dict(out.dtypes) == {"order_id": "string", "amount": "string"}
