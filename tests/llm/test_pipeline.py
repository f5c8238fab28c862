import base64
import collections
import hashlib
import re

import corpus_pipeline
import numpy as np
import public_tokenizers as P
from conftest import SF

from corpusmill.llm import common, latent_leaks, line_rules


def test_each_stage_keeps_what_it_should(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(9_000, None, None, "s", 0), (9_001, "12345 !!", "en", "s", 8), (9_002, "", "en", "s", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = common.materialize(stage(spark, docs, SF), name)
        if name != "encode":
            assert out.columns == docs.columns
        seen[name] = ({r.doc_id for r in docs.collect()}, {r.doc_id for r in out.collect()})
        assert seen[name][1] <= seen[name][0]
        docs = out
    assert seen["language"][0] - seen["language"][1] == {9_000, 9_001, 9_002}
    assert seen["near_copies"][0] != seen["near_copies"][1]
    assert seen["encode"][0] == seen["encode"][1]


def test_verdicts_belong_to_rows(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    a, b, c = (" ".join(f"{w}{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)) for w in ("one", "two", "three"))
    make = lambda rows: spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).repartition(2)
    left = lambda stage, rows: sorted(((r.doc_id, r.text) for r in stage(spark, make(rows), SF).collect()), key=repr)
    found = left(corpus_pipeline.identify_language, [(None, None), (None, "12 !"), (None, a), (5, "12 !"), (5, b), (6, a), (6, a)])
    assert found == sorted([(None, a), (5, b), (6, a), (6, a)], key=repr)
    found = left(corpus_pipeline.drop_near_copies, [(None, a), (None, a), (7, a), (8, a), (9, b), (9, b), (9, c), (None, c), (None, "x y z"), (None, "x y z")])
    assert found == sorted([(7, a), (9, b), (9, c), (None, "x y z")], key=repr)
    found = left(corpus_pipeline.remove_benchmark_leaks, [(None, item), (None, a), (3, item), (3, b), (4, c), (4, c)])
    assert found == sorted([(None, a), (3, b), (4, c), (4, c)], key=repr)


def _line_fails(x):
    low = x.lower()
    rules = [
        not re.search("[.!?:;\u2026\u3002]['\"\u201d\u2019\u00bb)\\]]*[\x20\x09-\x0d]*\\Z", x),
        x.count("!!") >= 3,
        sum(x.count(c) for c in "|»•·") >= 3,
        10 * sum(x.count(c) for c in "#*$%&<>{}") > len(x),
        any(p in low for p in line_rules.BOILERPLATE),
    ]
    return any(rules)


def _cleaned(text):
    """The text without failing lines; None where the document is rejected."""
    words = re.findall(r"[^\x20\x09-\x0d]+", text)
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    repeated = {k for i in range(len(words) - 4) if windows[tuple(words[i : i + 5])] > 1 for k in range(i, i + 5)}
    if len(words) < 10 or 100 * len(repeated) > 20 * len(words):
        return None
    lines = text.split("\n")
    worded = [x for x in lines if re.search(r"[^\x20\x09-\x0d]", x)]
    lost = [x for x in worded if _line_fails(x)]
    if 100 * sum(map(len, lost)) > 50 * sum(map(len, worded)):
        return None
    return "\n".join(x for x in lines if x not in lost or x not in worded)


def _components(texts):
    sets, index, common_, root = {}, collections.defaultdict(list), collections.Counter(), {k: k for k in texts}
    for k, t in texts.items():
        w = t.translate({c: c + 32 for c in range(65, 91)}).encode().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, s in sets.items():
        for x in s:
            common_.update((j, k) for j in index[x])
            index[x].append(k)
    for (a, b), c in common_.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: find(k) for k in texts}


def _leaks(text, items):
    words = [x for x in (y.strip(latent_leaks._PUNCTUATION) for y in text.lower().split()) if x]
    here = set(words)
    for own in items:
        if sum(x in here for x in own) < latent_leaks.PARAPHRASE * len(own):
            continue
        for a in range(0, len(words), max(1, len(own) // 4)):
            region = words[a : a + 2 * len(own)]
            cover = latent_leaks.common_length(own, region) / len(own)
            told = latent_leaks.common_length(own[-8:], region) / len(own[-8:])
            if cover >= latent_leaks.EXACT or (cover >= latent_leaks.PARAPHRASE and told >= latent_leaks.ANSWER_COVER):
                return True
    return False


def test_the_pipeline_against_brute_force(spark):
    import tiktoken

    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    texts = {i: t for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    texts = {i: c for i, t in texts.items() if (c := _cleaned(t)) is not None}
    texts = {i: texts[i] for i, root in _components(texts).items() if i == root}
    bench = [[x for x in (y.strip(latent_leaks._PUNCTUATION) for y in r.text.lower().split()) if x] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {i: t for i, t in texts.items() if not _leaks(t, bench)}
    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    expected = {i: hashlib.sha256(np.array(lib.encode_ordinary(t), "<u4").tobytes()).hexdigest() for i, t in texts.items()}
    assert {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF).collect()} == expected


def test_stages_take_empty_tables_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0
        some = docs.limit(30).selectExpr("*", "1 as node", "'x' as key", "array(1) as words")
        assert stage(spark, some, SF).count() > 0


def test_the_leaks_stage_fits_on_all_its_rows(spark, monkeypatch):
    docs, seen, fit = spark.read.parquet(f"{SF}/documents.parquet"), [], latent_leaks.fit
    monkeypatch.setattr(latent_leaks, "fit", lambda d: seen.append((d.count(), latent_leaks.FIT_PASSAGES)) or fit(d))
    corpus_pipeline.remove_benchmark_leaks(spark, docs, SF)
    assert seen == [(docs.count(), None)]


def test_each_stage_settles_the_executors_first(spark, monkeypatch):
    docs, calls, settle = spark.read.parquet(f"{SF}/documents.parquet"), [], common.settle
    monkeypatch.setattr(common, "settle", lambda s: calls.append(settle(s)))
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF)
    assert calls == [spark.sparkContext.defaultParallelism] * 2
