"""Readers, packed folders, sketches, streams and planning parts that no SQL checks."""

import hashlib
import json
import random

import pytest
from conftest import SF
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusmill.functions import lenient
from corpusmill.functions import text as X
from corpusmill.operators import packed, replay, rollouts, routing, sketches
from corpusmill.plans import planner, registry
from corpusmill.sources import readers
from corpusmill.streaming import ingest


def test_folder_rows_of_every_kind(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.csv").write_text('question,answer\n"what, so",4\nbroken\n')
    (tmp_path / "sub" / "b.tsv").write_text("text\tother\nhello\tx\n\ty\n")
    (tmp_path / "c.jsonl").write_text('{"text": "one"}\nnot json\n{"text": " "}\n')
    (tmp_path / "d.json").write_text('[{"content": "two"}, {"content": "three"}]')
    (tmp_path / "e.txt").write_text("whole\nfile")
    (tmp_path / "f.bin").write_bytes(b"\x00")
    got = sorted(r.text for r in readers.folder_rows(spark, str(tmp_path), "s").collect())
    assert got == sorted(["what, so\n\n4", "hello", "y", "one", "two", "three", "whole\nfile"])
    assert readers.folder_bytes(spark, str(tmp_path)).first().files == 6


def test_packed_folders_are_read_as_one_stream(spark, tmp_path):
    recs = spark.createDataFrame([(i, list(range(100 * i, 100 * i + 5 + i)), [0, 0] + [1] * (3 + i)) for i in range(20)], "id long, ids array<int>, mask array<int>")
    laid = packed.laid_out(recs, ["id"], 0.25, 4)
    val = {r.id for r in laid.filter("split = 'val'").collect()}
    assert val == {0, 4, 8, 12, 16}
    for name in ("x", "y"):
        packed.write(laid, str(tmp_path / name), 70_000)
    assert packed.kind_of(spark, str(tmp_path / "x")) == "pairs"
    told = {r.split: r for r in spark.read.json(str(tmp_path / "x" / "manifest")).collect()}
    assert told["val"].records == 5 and told["val"].dtype == "uint32" and told["val"].tokens == sum(5 + i for i in val)
    flat = [t for i in range(20) if i not in val for t in range(100 * i, 100 * i + 5 + i)] * 2
    stream = packed.read(spark, [str(tmp_path / "x"), str(tmp_path / "y")], "train")
    n = len(flat)
    wanted = spark.createDataFrame([(a, b) for a, b in ((0, 3), (7, 40), (n - 5, 5), (n // 2 - 10, 20), (0, n))], "start long, length int")
    got = {(r.start, r.length): r.ids for r in packed.at(stream, wanted).collect()}
    assert got == {(a, b): flat[a : a + b] for a, b in got} and len(got) == 5
    windows = packed.training_windows(stream, 16).collect()
    assert sorted(w.start for w in windows) == list(range(0, (n - 1) // 16 * 16, 16))
    assert all(w.ids == flat[w.start : w.start + 16] and w.targets == flat[w.start + 1 : w.start + 17] for w in windows)
    assert packed.example_ids(stream, 12).first().ids == flat[:12]
    with pytest.raises(ValueError, match="no test split"):
        packed.read(spark, [str(tmp_path / "x")], "test")
    with pytest.raises(ValueError, match="no packed data"):
        packed.kind_of(spark, str(tmp_path))


def test_pieces_longer_than_a_stretch(spark, monkeypatch):
    monkeypatch.setattr(packed, "STRETCH", 8)
    stream = spark.createDataFrame([(0, list(range(30)), [0] * 30), (30, [7], [1]), (31, list(range(50)), [1] * 50)], "start long, ids array<int>, mask array<int>")
    flat = [*range(30), 7, *range(50)]
    wanted = spark.createDataFrame([(a, b) for a in (0, 7, 8, 29, 30, 31, 60) for b in (1, 2, 9, 21)], "start long, length int")
    assert all(r.ids == flat[r.start : r.start + r.length] for r in packed.at(stream, wanted).collect())
    assert packed.at(stream, wanted).count() == 28


def test_shards_go_on_behind_those_that_are_there(spark, tmp_path):
    df = spark.createDataFrame([(i, "a" if i % 2 else None, "x" * (40 * i % 170)) for i in range(40)], "id long, category string, text string")
    folder = str(tmp_path / "out")
    for k in range(2):
        readers.write_shards(df.filter("category = 'a'"), folder, "category", "id", 300)
        files = sorted(int(p.name[6:]) for p in (tmp_path / "out" / "category=a").glob("shard=*"))
        assert files == list(range(len(files))) and (k == 0 or len(files) > first)
        first = len(files)
    for shard in (tmp_path / "out" / "category=a").glob("shard=*"):
        lines = [line for f in shard.glob("*.json") for line in f.read_text().splitlines()]
        assert len(lines) == 1 or sum(len(x) + 1 for x in lines) <= 300
    assert spark.read.json(folder).count() == 40


def test_a_bloom_filter_in_order(spark):
    rng = random.Random(1)
    texts = [f"text {rng.randint(0, 60)}" for _ in range(120)] + [None]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bits, kept = set(), set()
    for i, t in enumerate(texts[:-1]):
        digest = hashlib.sha256(hashlib.sha1(t.encode()).digest()).digest()
        own = {int.from_bytes(digest[4 * k : 4 * k + 4], "little") % 160 for k in range(4)}
        if not own <= bits:
            kept.add(i)
        bits |= own
    assert {r.doc_id for r in sketches.bloom_unseen(df, 20).collect()} == kept


def test_minhash_finds_what_is_near(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(0, " ".join(words)), (1, " ".join([*words[:5], "x", *words[6:]])), (2, " ".join(words[::-1])), (3, "a b"), (4, "a b"), (5, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.a, r.b) for r in sketches.lsh_pairs(df).collect()] == [(0, 1)]
    # A band of 13 values agrees with the 13th power of the similarity.
    many = [words[:i] + [f"x{k}y{j}" for j in range(400 - i)] for k in range(20) for i in (390, 200)]
    rows = [(0, " ".join(words)), *((k + 1, " ".join(w)) for k, w in enumerate(many))]
    found = {r.b for r in sketches.lsh_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.a == 0}
    assert len(found & set(range(1, 41, 2))) >= 18 and not found & set(range(2, 41, 2))
    kept = {r.doc_id for r in sketches.chained(df, registry._checkpoint, "minhash").collect()}
    assert kept == {0, 2, 3, 5}


def test_draws_and_gaps(spark):
    steps = spark.createDataFrame([(0, 10), (1, 7)], "rank long, calls long")
    alone = replay.drawn(steps, 5_000, 100, 3).collect()
    assert sorted(r.rank for r in alone) == [0] * 11 + [1] * 8
    some = replay.drawn(steps, 5_000, 100, 3, workers=4)
    assert some.groupBy("rank").count().orderBy("rank").collect() == [(0, 10), (1, 7)]
    used = {0: set(), 1: set()}
    for r in some.collect():
        assert 0 <= r.start < 4_900 and r.stop == r.start + 100
        used[r.rank] |= set(range(r.start, r.stop))
    gaps = replay.unused(some, spark.createDataFrame([(0, 5_000), (1, 5_000)], "rank long, n long"), 64).collect()
    assert all(not used[g.rank] & set(range(g.start, g.stop)) and g.stop - g.start >= 64 for g in gaps)
    assert sum(g.stop - g.start for g in gaps) <= sum(5_000 - len(u) for u in used.values())
    draws = rollouts.sampled_prompts(spark.range(5).toDF("doc_id"), ["doc_id"], 4, 6, 1).collect()
    assert len(draws) == 24 and {r.doc_id for r in draws} <= set(range(5))


def test_sketches_of_counts_are_near(spark):
    got = {r.lang: r for r in registry.queries()["approximate_counts"](spark, "/root/testdata/sf0.01").collect()}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for r in docs.groupBy("lang").agg(F.countDistinct("text").alias("n"), F.median("n_chars").alias("m")).collect():
        assert got[r.lang].texts == pytest.approx(r.n, rel=0.1) and got[r.lang].sketch == pytest.approx(r.n, rel=0.1)
        assert got[r.lang].middle == pytest.approx(r.m, rel=0.1)


def test_rounds_end_at_the_budget_or_when_idle(spark):
    seen = []
    fetch = lambda k: spark.createDataFrame([(30,), (12,)], "bytes long") if k in (1, 2, 8) else None
    assert ingest.topped_up(fetch, lambda df: seen.append(df.count()), 80) == 84 and seen == [2, 2]
    assert ingest.topped_up(lambda k: None, seen.append, 80) == 0


def test_streams_in_batches_and_without_near_copies(spark, tmp_path):
    words = [f"w{i}" for i in range(300)]
    texts = [" ".join(words), " ".join([*words[:5], "x", *words[6:]]), " ".join(words), " ".join(words[::-1]), "short one"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, text string").coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema("id long, text string").parquet(str(tmp_path / "in"))
    sizes = str(tmp_path / "sizes")
    ingest.in_batches(stream(), lambda rows: [{"id": r["id"], "text": str(len(rows))} for r in rows], sizes, str(tmp_path / "c1"), most_rows=2)
    assert sorted(r.text for r in spark.read.parquet(sizes).collect()) == ["1", "2", "2", "2", "2"]
    ingest.run_available(ingest.near_deduplicated(stream()), str(tmp_path / "out"), str(tmp_path / "c2"))
    kept = {r.id for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert len(kept & {0, 2}) == 1 and 3 in kept and 4 not in kept


def test_small_parts(spark):
    assert lenient.category_map("a=x, y;b = z; q,r ;;") == {"a": ["x", "y"], "b": ["z"], "__all__": ["q", "r"]}
    assert lenient.category_map(None) == {}
    schema = T.StructType().add("a", "string").add("b", T.ArrayType(T.StructType().add("c", "binary"))).add("d", T.MapType(T.StringType(), T.BinaryType()))
    assert routing.unsupported(schema) == ["b[].c", "d{}"]
    df = spark.createDataFrame([("q", 1)], "Ask string, n int")
    assert readers.hinted(df, lambda name, columns, row: {"prompt": "ASK", "answer": "n", "text": "gone"}, "d") == {"prompt": "ASK"}
    one = lambda c: spark.range(1).select(c.alias("x")).first().x
    assert one(lenient.cleaned(F.lit("​ ﻿"))) is None
    assert one(planner.human_bytes(F.lit(1_500_000))) == "1.50 MB" and one(planner.human_bytes(F.lit(12))) == "12 B"
    assert one(X.without_fences(F.lit("```a\nb\n```"))) == "b"
    assert [r.path for r in readers.shuffled(spark.createDataFrame([("a",), ("b",), ("c",)], "path string")).collect()] == [r.path for r in readers.shuffled(spark.createDataFrame([("c",), ("a",), ("b",)], "path string")).collect()]
    assert [r.config for r in readers.configurations(spark.createDataFrame([(None,)], "config string")).collect()] == [None]
    assert json.loads(one(readers.json_line(F.lit("é").alias("a"), F.lit(None).cast("string").alias("b")))) == {"a": "é", "b": None}


def test_tokens_round_trip_through_a_real_tokenizer(spark):
    import public_tokenizers

    from corpusmill.operators import tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    pairs = registry.queries()["first_exchange"](spark, SF)
    given, learnt = X.sft_turns(F.col("prompt"), F.lit(""), F.col("answer"))
    both = tokens.encoded(tokens.encoded(pairs.withColumn("g", given).withColumn("l", learnt), "g", path, out="gi"), "l", path, out="li")
    laid = packed.laid_out(packed.records(both, F.col("gi"), F.col("li"), 4_096, 50_256), ["conv_id"], 0.1, 4)
    back = tokens.decoded(laid.withColumn("own", F.slice("ids", F.lit(1), F.size("ids") - 1)), "own", path).collect()
    assert back and all(r.decoded == r.g + r.l for r in back)
    assert packed.manifest(laid, 50_257).agg(F.sum("records")).first()[0] == len(back)
