import datetime as dt

from tidemark.plans.entities import ENTITIES
from tidemark.sources.store import TableStore
from tidemark.streaming.micro_batch import start_sync_stream


def test_stream_feeds_upsert(spark, scratch):
    src = f"{scratch}/in"
    cols = "id string, fullName string, teamCommonName string, teamPlaceName string"
    spark.createDataFrame([("1", "A", "AAA", "a"), ("2", "B", "BBB", "b")], cols) \
        .coalesce(1).write.parquet(f"{src}/f1")
    store = TableStore(spark, f"{scratch}/store")
    schema = spark.createDataFrame([], cols).schema
    q = start_sync_stream(spark, store, "franchises", f"{src}/*", schema,
                          checkpoint=f"{scratch}/ckpt")
    q.awaitTermination(120)
    st = store.read("franchises")
    assert sorted(r["id"] for r in st.collect()) == [1, 2]
    log = store.read_log(ENTITIES["franchises"].log_name).collect()
    assert [r["notes"] for r in log] == ["stream batch 0"]
    assert log[0]["inserted_records"] == 2
