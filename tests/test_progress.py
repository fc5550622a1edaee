import threading
import time

import numpy as np

from tessera.plans.engine import Engine
from tessera.plans.progress import Cancelled, state
from tessera.sources.tables import Store
from tessera.streaming.ingest import ProgressLog, enqueue_stream, progress

COLUMNS = "pos long, text string, file_path string"


def embed(texts):
    return np.ones((len(texts), 2), np.float32)


def slow(texts):
    time.sleep(120)
    return [""] * len(texts)


def quick(texts):
    return ["entity<|#|>Ann<|#|>Person<|#|>Ann is here\n<|COMPLETE|>" for _ in texts]


def test_a_run_is_cancelled_in_flight_and_tried_again(spark, tmp_path):
    store = Store(spark, str(tmp_path), buckets=2)
    e = Engine(store, embed, slow)
    e.enqueue(spark.createDataFrame([(0, "Ann is here", "a.txt")], COLUMNS))
    assert not e.cancel()
    found = []

    def run():
        try:
            e.process()
        except Cancelled as x:
            found.append(x)

    thread = threading.Thread(target=run)
    thread.start()
    end = time.time() + 90
    while time.time() < end and (state(store, "process") or {}).get("stage") != "answers":
        time.sleep(0.2)
    time.sleep(2)
    began = time.time()
    assert state(store, "process")["busy"] and e.cancel()
    thread.join(100)
    assert found and time.time() - began < 90
    row = store.read("doc_status").first()
    assert (row.status, row.error_msg) == ("failed", "cancelled") and store.read("nodes").count() == 0
    after = state(store, "process")
    assert not after["busy"] and "Cancelled" in after["error"]
    assert Engine(store, embed, quick).process() == 1
    assert store.read("doc_status").first().status == "processed" and store.read("nodes").first().id == "Ann"
    assert [s for s, _ in state(store, "process")["history"]] == ["chunks", "answers", "chunks", "relations", "entities", "index", "status", "publish"]


def test_streams_log_their_batches_and_take_cleaned_texts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "kb"), buckets=2)
    for name, text in (("one", " a &amp; b "), ("two", "c")):
        spark.createDataFrame([(0, text, name), (0, text, name)], COLUMNS).write.mode("append").parquet(str(tmp_path / "in"))
    log = ProgressLog(store)
    spark.streams.addListener(log)
    try:
        enqueue_stream(spark, str(tmp_path / "in"), COLUMNS, store, str(tmp_path / "ck")).awaitTermination()
        end = time.time() + 30
        while time.time() < end and progress(store).count() == 0:
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(log)
    assert [r.batch for r in progress(store).collect()] == [0] and progress(store).first().n_rows >= 4
    assert {(r.content, r.file_path) for r in store.read("full_docs").collect()} == {("a & b", "one"), ("c", "two")}
    assert store.read("doc_status").where("status = 'failed'").count() == 2
