from __future__ import annotations

import pytest

from rillrank.session import CHECKPOINT_DIR, run_dir, shared_dir
from rillrank.sources.lines import FileLines, KafkaLines, SocketLines, from_elements, read_lines


def test_kafka_options():
    spec = KafkaLines("h1:9092,h2:9092", "traffic", "group", extra={"failOnDataLoss": "false"})
    opts = spec.options(streaming=True)
    assert opts["kafka.bootstrap.servers"] == "h1:9092,h2:9092" and opts["subscribe"] == "traffic"
    assert opts["startingOffsets"] == "latest" and opts["kafka.group.id"] == "group"
    assert opts["failOnDataLoss"] == "false" and "maxOffsetsPerTrigger" in opts
    bounded = spec.options(streaming=False)
    assert (bounded["startingOffsets"], bounded["endingOffsets"]) == ("earliest", "latest")


def test_socket_options():
    assert SocketLines("h", 9999).options(True) == {"host": "h", "port": "9999", "includeTimestamp": "true"}
    with pytest.raises(ValueError):
        SocketLines("h", 9999).options(False)


def test_text_files_in_batch_and_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("hello,stream\nhello,world\n")
    spec = FileLines(str(tmp_path / "in"))
    batch = read_lines(spark, spec, streaming=False)
    assert sorted(r.value for r in batch.collect()) == ["hello,stream", "hello,world"]
    stream = read_lines(spark, spec, streaming=True)
    assert stream.isStreaming and stream.schema == batch.schema
    query = stream.writeStream.format("memory").queryName("text_lines").trigger(availableNow=True).start()
    query.awaitTermination()
    assert sorted(spark.table("text_lines").collect()) == sorted(batch.collect())


def test_unknown_source(spark):
    with pytest.raises((TypeError, AttributeError)):
        read_lines(spark, object(), streaming=False)


def test_elements_keep_their_order(spark):
    rows = from_elements(spark, [("a", 5), ("b", 1)]).orderBy("seq").collect()
    assert [(r.seq, r.key, r.value) for r in rows] == [(0, "a", 5), (1, "b", 1)]


def test_shared_dir_is_the_named_one(spark):
    named = spark.conf.get(CHECKPOINT_DIR)
    assert shared_dir(spark) == named
    assert run_dir(spark, "x").startswith(named) and run_dir(spark, "x") != run_dir(spark, "x")
