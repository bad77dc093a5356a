"""The log source: offsets behind whole lines, restarts without loss or copies, deliveries counted."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources import offset_log


def run(spark, tmp_path, change=lambda df: df):
    stream = change(offset_log.lines(spark, f"{tmp_path}/log", f"{tmp_path}/state"))
    q = stream.writeStream.format("offset_log").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).start()
    q.awaitTermination(120)


def test_restart_loses_and_doubles_nothing(spark, tmp_path):
    log = tmp_path / "log"
    log.mkdir()
    (log / "a").write_bytes(b"one\ntwo\nthr")
    (log / "b").write_bytes("eins\n\nzwölf\n".encode())
    run(spark, tmp_path)
    got = sorted((r.partition, r.position, r.line, r.deliveries) for r in offset_log.acknowledged(spark, f"{tmp_path}/out").collect())
    assert got == [("a", 0, "one", 1), ("a", 4, "two", 1), ("b", 0, "eins", 1), ("b", 5, "", 1), ("b", 6, "zwölf", 1)]
    with open(log / "a", "ab") as f:
        f.write(b"ee\nfour\n")
    (log / "c").write_bytes(b"new\n")

    def fail(df):
        return df.withColumn("line", F.when(F.col("line") == "four", F.raise_error(F.lit("down")).cast("string")).otherwise(F.col("line")))

    with pytest.raises(Exception, match="down"):
        run(spark, tmp_path, fail)
    assert offset_log.acknowledged(spark, f"{tmp_path}/out").count() == 5
    run(spark, tmp_path)
    got = sorted((r.partition, r.line, r.deliveries) for r in offset_log.acknowledged(spark, f"{tmp_path}/out").collect())
    assert got == [("a", "four", 2), ("a", "one", 1), ("a", "three", 2), ("a", "two", 1), ("b", "", 1), ("b", "eins", 1), ("b", "zwölf", 1), ("c", "new", 2)]
    run(spark, tmp_path)
    assert offset_log.acknowledged(spark, f"{tmp_path}/out").count() == 8


def test_offsets_end_behind_whole_lines(tmp_path):
    reader = offset_log.LogReader({"path": str(tmp_path), "state": str(tmp_path / "_state")})
    (tmp_path / "x").write_bytes(b"a" * 200_000)
    (tmp_path / "y").write_bytes(b"")
    (tmp_path / "z").write_bytes(b"b\n" + b"c" * 100_000)
    assert reader.latestOffset() == {"x": 0, "y": 0, "z": 2}
    spans = reader.partitions({}, {"x": 0, "z": 2})
    assert [(s.name, s.start, s.end, s.deliveries) for s in spans] == [("z", 0, 2, 1)]
    assert [s.deliveries for s in reader.partitions({}, {"z": 2})] == [2]
    reader.commit({"z": 2})
    assert list(reader.read(spans[0])) == [("z", 0, "b", 1)]
