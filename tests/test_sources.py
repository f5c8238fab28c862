import numpy as np
from pyspark.sql import functions as F

from corpusmill.sources import tables, token_files
from corpusmill.streaming import ingest


def test_json_shards_skip_what_is_no_record(spark, tmp_path):
    (tmp_path / "web").mkdir()
    (tmp_path / "web/web_00000.jsonl").write_text('{"text": "é", "category": "web"}\n{bad\n{"text": ""}\n{"category": "x"}\n')
    assert [r.text for r in tables.json_shards(spark, str(tmp_path)).collect()] == ["é"]


def test_token_files_round_trip(spark, tmp_path):
    pieces = spark.createDataFrame([(0, [1, 2, 3]), (3, [65535]), (4, [7, 8])], "offset long, ids array<long>").repartition(3)
    path = str(tmp_path / "train.bin")
    assert token_files.write(pieces, path, 65536) == 6
    assert np.fromfile(path, "<u2").tolist() == [1, 2, 3, 65535, 7, 8]
    spark.dataSource.register(token_files.TokenFiles)
    rows = spark.read.format("tokens").option("dtype", "uint16").option("sliceids", "4").load(path).orderBy("start").collect()
    assert [i for r in rows for i in r.ids] == [1, 2, 3, 65535, 7, 8]
    assert token_files.dtype_for(65537) == "uint32"


def test_training_log(spark, tmp_path):
    (tmp_path / "log").write_text("hello\nstep 1,500 | loss 4.25 | lr 3.0e-04 | grad 1 | 37.3k tok/s | mfu 37.5%\n")
    r = tables.training_log(spark, str(tmp_path / "log")).first()
    assert (r.step, r.loss, r.lr, r.ktok_s, r.mfu) == (1500, 4.25, 3e-4, 37.3, 37.5)


def test_stream_keeps_the_first_of_each_text_across_runs(spark, tmp_path):
    schema = "text string"
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    for batch in (["a", "a", "b"], ["b", "c"]):
        spark.createDataFrame([(x,) for x in batch], schema).coalesce(1).write.mode("append").parquet(source)
        ingest.run_available(ingest.deduplicated(spark.readStream.schema(schema).parquet(source)).select("text"), out, state)
    assert sorted(r.text for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


def test_closed_windows(spark, tmp_path):
    e = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    e.select("ts", "event_type", "value").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.select("ts", "event_type", "value").schema).parquet(str(tmp_path / "in"))
    ingest.run_available(ingest.per_window(stream, "1 hour", "10 minutes"), str(tmp_path / "out"), str(tmp_path / "state"))
    got = spark.read.parquet(str(tmp_path / "out")).agg(F.sum("n")).first()[0]
    assert 0 < got <= e.count()
