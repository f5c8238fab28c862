import pytest
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import dedup, filters, intervals, packing, rollouts
from corpusmill.plans import planner, registry
from corpusmill.sources import tables


def one(spark, expr, **values):
    row = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return row.select(expr.alias("x")).first().x


GOLDEN = {"de": (31, 29, 29, 70010), "en": (127, 109, 103, 285835), "es": (17, 16, 15, 48222), "fr": (25, 21, 18, 46348)}


def test_corpus_report_has_the_golden_values(spark):
    got = {r.lang: (r.n_docs, r.n_pass, r.n_kept, r.kept_bytes) for r in registry.queries()["corpus_report"](spark, "/root/testdata/sf0.001").collect()}
    assert got == GOLDEN


@pytest.mark.parametrize(
    ("text", "reason"),
    [
        ("a" * 499, "too_short"),
        ("1 " * 300, "low_alpha_ratio"),
        ("word " * 150, "high_repetition"),
        ("\n".join(" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(k, k + 50)) for k in range(0, 150, 50)) + "\nplease add to cart", "junk_marker:add to cart"),
        (" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(400)), "single_block_too_long"),
        ("\n".join(" ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}word" for i in range(k, k + 50)) for k in range(0, 150, 50)), None),
    ],
)
def test_prose_rules(spark, text, reason):
    assert one(spark, filters.prose_reason(F.col("t")), t=text) == reason


@pytest.mark.parametrize(("line", "reason"), [(1000, "avg_line_too_long"), (1001, "line_too_long")])
def test_code_line_limits(spark, line, reason):
    assert one(spark, filters.code_reason(F.col("t"), F.lit("")), t="x" * line) == reason


@pytest.mark.parametrize(("path", "reason"), [("a/b.exe", "disallowed_extension"), ("node_modules/a.py", "skip_path:node_modules/"), ("x.min.js", "skip_path:.min.js"), ("a/b.py", None), (".bashrc", None)])
def test_code_paths(spark, path, reason):
    assert one(spark, filters.code_reason(F.col("t"), F.col("p")), t="short line\n" * 60, p=path) == reason


@pytest.mark.parametrize(("p", "a", "reason"), [("", "x", "empty_prompt"), ("x", "  ", "empty_answer"), ("2+2?", "4", "too_short"), ("The same words here", " the SAME words here ", "answer_echoes_prompt"), ("What is ten minus three?", "7", None)])
def test_pair_rules(spark, p, a, reason):
    assert one(spark, filters.pair_reason(F.col("p"), F.col("a")), p=p, a=a) == reason


def test_words_count_at_ten(spark):
    assert one(spark, X.top_word_share(X.words(F.col("t"))), t="a " * 9) == 0.0
    assert one(spark, X.top_word_share(X.words(F.col("t"))), t="a " * 10) == 1.0


@pytest.mark.parametrize(
    ("text", "answer"), [(r"so \boxed{ 42 } and 7", "42"), ("<think>1 2</think> it is 1,000", "000"), ("no number here", "here"), ("<think>5</think>", ""), ("a -3.5 b", "-3.5"), ("a <think> 9 </think> b", "b")]
)
def test_answers(spark, text, answer):
    assert one(spark, X.answer_of(F.col("t")), t=text) == answer


@pytest.mark.parametrize(("said", "gold", "value"), [("<think>x</think> 4", "4", 1.0), ("4.001", "4", 0.5), ("<think>x</think> 5", "4", 0.3), ("5", "4", 0.0), ("<think>", "4", 0.0)])
def test_reward_tiers(spark, said, gold, value):
    assert one(spark, rollouts.reward(F.col("s"), F.col("g"), 100)["reward"], s=said, g=gold) == value


@pytest.mark.parametrize(("n", "most", "overlap", "pieces"), [(10, 10, 0, 1), (11, 10, 0, 2), (20, 10, 0, 3), (10, 4, 1, 3), (10, 4, 9, 3)])
def test_chunks_cover_the_text(spark, n, most, overlap, pieces):
    text = "".join(chr(97 + i) for i in range(n))
    got = packing.chunks(spark.createDataFrame([(1, text)], "id long, text string"), "text", most, overlap).orderBy("piece_no").collect()
    step = most - overlap if most > overlap else most
    expected = []
    for start in range(0, n, step):
        expected.append(text[start : start + most])
        if n <= most or len(expected[-1]) < most:
            break
    assert [r.piece for r in got] == expected


def test_every_nth_uses_bankers_rounding(spark):
    got = spark.range(9).select(packing.every_nth(F.col("id"), 0.4).alias("v")).collect()
    assert [r.v for r in got] == [i % 2 == 0 for i in range(9)]
    assert not one(spark, packing.every_nth(F.lit(0), 0.0))


def test_merge_and_invert_tile_the_stream(spark):
    iv = spark.createDataFrame([("a", 100, 0, 10), ("a", 100, 10, 20), ("a", 100, 15, 18), ("a", 100, 90, 140), ("a", 100, -5, 2)], "g string, n long, start long, stop long")
    groups = spark.createDataFrame([("a", 100), ("b", 50)], "g string, n long")
    merged = intervals.merge(iv, "g", "n")
    assert sorted((r.start, r.stop) for r in merged.collect()) == [(0, 20), (90, 100)]
    gaps = intervals.invert(merged, "g", "n", groups)
    assert sorted((r.g, r.start, r.stop) for r in gaps.collect()) == [("a", 20, 90), ("b", 0, 50)]


def test_record_scan_skips_spurious_separators_and_tails(spark):
    tokens = [(0, 0), (5, 0), (6, 1), (0, 0), (7, 0), (0, 0), (8, 1), (0, 0), (9, 0)]
    df = spark.createDataFrame([("a", i, t, m) for i, (t, m) in enumerate(tokens)], "g string, pos long, token int, mask int")
    got = sorted((r.pos, r.record) for r in rollouts.records(df, "g").collect())
    assert got == [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 1), (6, 1), (7, 1)]


def test_exact_dedup_keeps_one_row_of_each_text(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (1, "x"), (2, "y"), (4, None), (5, None), (None, "z"), (None, "y")], "doc_id long, text string")
    once = dedup.exact(df)
    rows = lambda d: sorted(((r.doc_id, r.text) for r in d.collect()), key=repr)
    assert rows(once) == rows(dedup.exact(once)) == sorted([(1, "x"), (2, "y"), (4, None), (None, "z")], key=repr)
    assert dedup.exact(df.limit(0)).count() == 0


def test_offsets_and_budgets_with_other_columns_carried(spark):
    df = spark.range(300_000).select((F.col("id") * 7919 % 300_000).alias("id"), (F.col("id") % 5 + 1).alias("n"), F.concat(F.lit("text "), F.col("id")).alias("text")).repartition(6)
    got = packing.running_offset(df, ["id"], F.col("n"), 16)
    wrong = got.join(df.select(F.col("id").alias("i"), F.col("n").alias("m")), F.col("id") == F.col("i")).groupBy().agg(F.count("text").alias("rows"), F.countDistinct("offset").alias("places"), F.max(F.col("offset") + F.col("n")).alias("end"), F.sum(F.col("offset") * F.col("id")).alias("check")).first()
    n = {r.id: r.n for r in df.select("id", "n").collect()}
    total = check = 0
    for i in range(300_000):
        check += total * i
        total += n[i]
    assert (wrong.rows, wrong.places, wrong.end, wrong.check) == (300_000, 300_000, total, check)
    groups = df.withColumn("g", F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 3))
    kept = {r.id for r in packing.within_budget(groups, "g", "id", F.col("n"), 200_000, 16).collect()}
    expected, held = set(), {}
    for i in range(300_000):
        g = i % 3
        if held.get(g, 0) < 200_000:
            expected.add(i)
            held[g] = held.get(g, 0) + n[i]
    assert kept == expected


def test_ordered_keep_is_greedy(spark):
    ids = spark.createDataFrame([(i,) for i in range(1, 5)], "id long")
    pairs = spark.createDataFrame([(1, 2, 0.9), (2, 3, 0.9), (3, 4, 0.9)], "a long, b long, jaccard double")
    assert sorted(r.id for r in dedup.ordered_keep(ids, pairs, registry._checkpoint).collect()) == [1, 3]


def test_running_offsets_over_ties_and_empty_tables(spark):
    df = spark.createDataFrame([(i, i % 3 + 1) for i in range(50)], "id long, n long")
    got = {r.id: r.offset for r in packing.running_offset(df, ["id"], F.col("n"), 4).collect()}
    assert got == {i: sum(j % 3 + 1 for j in range(i)) for i in range(50)}
    assert packing.running_offset(df.limit(0), ["id"], F.col("n"), 4).count() == 0


def test_subtitles(spark):
    vtt = "WEBVTT\n\n1\n00:01 --> 00:02\n<c>Hello</c>\n\n2\n00:02 --> 00:03\nHello\n[music]\nyou\nHello"
    assert one(spark, X.subtitle_text(F.col("t")), t=vtt) == "Hello you Hello"


@pytest.mark.parametrize(("url", "mime", "kind"), [("http://a/b.PDF?x", None, "pdf"), ("http://a/b.csv", None, "xlsx"), ("http://a/b", "text/csv", "csv"), ("http://www.youtube.com/w", None, "video"), ("http://a/b", "Image/png; q=1", "image"), ("http://a/.txt", None, "html"), ("http://a.b/c.d/e", None, "html")])
def test_content_kinds(spark, url, mime, kind):
    assert one(spark, X.content_kind(F.col("u"), F.lit(mime).cast("string")), u=url) == kind


def test_records_from_any_table(spark):
    df = spark.createDataFrame([(" q ", "a"), ("", "b")], "Question string, ANSWER string")
    got = [(r.text, r.prompt, r.answer) for r in tables.as_records(df, "s").collect()]
    assert got == [("q\n\na", "q", "a"), ("b", None, "b")]
    assert tables.suitable(df) and not tables.suitable(spark.range(1))


def test_presets_are_nearest_in_proportion(spark):
    p = spark.createDataFrame([(1_600_000_000,), (20_000_000_000,)], "n long")
    assert [r.preset for r in planner.nearest_preset(p, "n").collect()] == ["1.7B", "32B"]


def test_judges_that_fail_keep_rows(spark):
    from corpusmill.operators import judging

    df = spark.createDataFrame([(i, "good" if i % 2 else "bad") for i in range(20)], "id long, text string")
    got = {r.id: r.keep for r in judging.judged(df, lambda texts: [t == "good" for t in texts]).collect()}
    assert got == {i: bool(i % 2) for i in range(20)}
    assert all(r.keep and "ZeroDivisionError" in r.judge_error for r in judging.judged(df, lambda texts: [1 / 0]).collect())


def test_token_arrays_round_trip(spark):
    import public_tokenizers

    from corpusmill.operators import tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    df = spark.createDataFrame([("prose here",), ("def f(x): return x",), ("<think>2+2</think>4",), (None,)], "text string")
    got = tokens.decoded(tokens.encoded(df, "text", path, end_id=0), "ids", path).collect()
    assert [r.decoded for r in got] == [(r.text or "") + "!" for r in got]
    assert [len(r.ids) for r in tokens.encoded(df, "text", path, most=2).collect()] == [2, 2, 2, 0]
