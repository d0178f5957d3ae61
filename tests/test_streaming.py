import logging
import time

from textloom.streaming import ingest, progress

SCHEMA = "msg_id long, conversation_id string, turn_index string, role string, content string, received_at timestamp"


def test_first_deliveries(spark, tmp_path):
    rows = spark.sql(
        """SELECT * FROM VALUES (1L, 'c', '1', 'user', 'a', TIMESTAMP '2031-01-01 00:00:00'), (2L, ' c', '01', 'User', 'a ', TIMESTAMP '2031-01-01 00:00:05'),
        (3L, 'c', '2', 'assistant', 'b', TIMESTAMP '2031-01-01 00:01:00'), (4L, null, '2', 'assistant', 'b', TIMESTAMP '2031-01-01 00:01:00'), (5L, 'c', 'x', null, null, TIMESTAMP '2031-01-01 00:01:00')
        AS t(msg_id, conversation_id, turn_index, role, content, received_at)"""
    )
    src = str(tmp_path / "in")
    rows.write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    for _ in range(2):  # nothing is written twice
        ingest.append(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.conversation_id, r.turn, r.role, r.content) for r in got if r.turn) == [("c", 1, "user", "a"), ("c", 2, "assistant", "b")]
    assert len(got) == 3


def test_progress_and_stop(spark, tmp_path, caplog):
    log, stopped = logging.getLogger("textloom.stream-test"), []
    watch = progress.Progress(log, every=1, check=lambda: True, stop=lambda: stopped.append(1))
    spark.streams.addListener(watch)
    try:
        spark.range(5).write.parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
        with caplog.at_level(logging.INFO, log.name):
            stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
            for _ in range(50):
                if watch.rows == 5 and "ended" in caplog.text:
                    break
                time.sleep(0.2)
    finally:
        spark.streams.removeListener(watch)
    assert watch.rows == 5 and stopped and "started" in caplog.text and "ended" in caplog.text
    assert not progress.memory_is_low(".", 0.0)
