"""Each operator against a brute-force version, and on rows that break things."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib
from array import array

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from conftest import SF, same
from pyspark.sql import functions as F

from corpusmill.llm import ans_store, backoff_lm, bpe_codec, chat_trees, fst_tokens, graph, latent_leaks, line_rules, pigeonhole_join, rank_language, registry, url_rules

LONG = " ".join(f"word{i % 997} and {i}" for i in range(20_000))
TEXTS = [None, "", " ", "\n\n \t", "One.", "the the the the the the the the the the the", "Ünïcödé ' text's  two  spaces <|endoftext|> İΣ 中文 1234 ½", "<|ENDOFTEXT|>'re <|endoftext|>'s", "a" * 5000, LONG, "same text here again\nsame text here again", "same text here again\nsame text here again", "tab\tand\x0bvt\x0cff\rcr\x85nel\xa0nbsp\u2028ls"]


def odd(spark, texts=TEXTS):
    """Texts with ids, a repeated row, and columns whose names operators use inside."""
    rows = [(i, t, "en" if i % 2 else None, "s", None, i, "x", [1], "y", 0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows + rows[3:4], "doc_id long, text string, lang string, source string, n_chars long, node long, key string, words array<int>, t string, bucket int").repartition(3)


def table(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    same(registry.queries()[name](spark, SF), registry.oracle_sql()[name])


# ---- 1, 3, 5: tokenizers -------------------------------------------------------------------


def test_bpe_codec_equals_the_library(spark):
    import tiktoken

    path = P.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    lib = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    docs = odd(spark)
    encoded = bpe_codec.encode_documents(docs, path, P.PATTERN)
    got = table(encoded)
    assert encoded.count() == len(TEXTS) + 1
    for i, t in enumerate(TEXTS):
        ids = lib.encode_ordinary(t or "")
        assert list(array("I", got[i].ids)) == ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    assert {r.doc_id: r.text for r in bpe_codec.decode_documents(encoded, path, P.PATTERN).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert bpe_codec.encode_documents(docs.limit(0), path, P.PATTERN).count() == 0


def test_ans_blocks_round_trip():
    rng = np.random.default_rng(0)
    ids = (rng.zipf(1.3, 300_000) % 5000).astype(np.uint32)
    coder = ans_store.Coder(ans_store.scaled(np.bincount(ids, minlength=6000)))
    for n in (1, 255, 256, 257, 65_536, 65_537, 300_000):
        block = coder.encode(ids[:n])
        assert (coder.decode(block) == ids[:n]).all()
    broken = bytearray(block)
    broken[len(broken) // 2] ^= 1
    with pytest.raises(ValueError, match="checksum"):
        coder.decode(bytes(broken))
    a, b = b"left" * 99, b"right" * 77
    assert ans_store.crc32_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)
    assert ans_store.scaled(np.array([5, 0, 0])).tolist() == [1 << ans_store.SCALE_BITS, 0, 0]


def test_ans_blocks_side_by_side_are_those_coded_alone():
    rng = np.random.default_rng(1)
    ids = (rng.zipf(1.3, 70_000) % 5000).astype(np.uint32)
    coder = ans_store.Coder(ans_store.scaled(np.bincount(ids, minlength=6000)))
    parts = [ids[:n] for n in (257, 70_000, 1, 256, 65_536, 300)]
    blocks = coder.encode_all(parts)
    assert blocks == [coder.encode(p) for p in parts]
    assert all((a == b).all() for a, b in zip(coder.decode_all(blocks), parts, strict=True))


def test_ans_units_keep_the_tokens_of_their_texts():
    """Texts are cut into units; cuts beside odd white space, apostrophes, letters of two
    bytes and special strings leave the library's ids."""
    from tokenizers import Tokenizer

    path, rng = P.path("byte_bpe_50k.json"), random.Random(3)
    lib, enc = Tokenizer.from_file(path), ans_store.LibraryEncoder(path, "<u2", 0)
    odd_parts = ["a", "Zb", "s", "'s", "'", "'re", "1", "23", ".", ",", "$$", "<", "_", " ", " ", "  ", "\n", "\n\n", "\r\n", "\t", "\x1c", "\x85", "\xa0", "\u1680", "\u180e", "\u2003", "\u2028", "\u202f", "\u205f", "\u3000", "é", "ß", "×", "÷", "ʰ", "˂", "Ж", "ѿ", "α", "中", "。", "—", "😀", "²", "½", "<|endoftext|>", "<|end"]
    texts = [None, "", *("".join(rng.choices(odd_parts, k=rng.choice([1, 2, 3, 6, 40]))) for _ in range(6000)), ""]
    for kind in (pa.string(), pa.large_string()):
        got = [ids for part in enc(pa.array(["cut off", *texts], kind).slice(1)) for ids in part.to_pylist()]
        assert got == [np.array([*e.ids, 0], "<u2").tobytes() for e in lib.encode_batch_fast([t or "" for t in texts], add_special_tokens=False)]
    assert all(chr(c).isalpha() for c in [*range(0xC0, 0x2C0), *range(0x400, 0x480)] if c not in (0xD7, 0xF7))


def test_ans_encoder_gives_the_library_a_word_once(monkeypatch):
    """Marks, digits and line breaks beside a word don't make it another one, and long units are not kept."""
    path, asked = P.path("byte_bpe_50k.json"), []
    enc = ans_store.LibraryEncoder(path, "<u2", 0)
    for name in ("_matches", "_texts"):
        monkeypatch.setattr(enc, name, lambda units, run=getattr(enc, name): asked.extend(units) or run(units))
    list(enc(pa.array(["x wordé, wordé. wordé; (wordé) wordé!\nx wordé7 wordé$$$ wordé", "x wordé? wordé"])))
    assert len(asked) == len(set(asked)) and [u for u in asked if "word" in u] == [" wordé", "wordé"]
    list(enc(pa.array(["x" * 1000])))
    assert max(map(len, enc.young)) <= ans_store.LONGEST


@pytest.mark.parametrize("block_ids", [1000, ans_store.BLOCK_IDS])
def test_ans_store_equals_the_library(spark, tmp_path, block_ids):
    from tokenizers import Tokenizer

    path, lib = P.path("byte_bpe_50k.json"), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    docs = odd(spark).dropDuplicates(["doc_id"])
    tokens = ans_store.tokenize(docs, path, 0, 50257)
    tokens.cache()
    ans_store.write(tokens, str(tmp_path), 50257, 3, block_ids)
    got, start = table(ans_store.read(spark, str(tmp_path))), 0
    for i, t in enumerate(TEXTS):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_ans_store_of_repeated_rows_and_nothing(spark):
    path = P.path("byte_bpe_50k.json")
    assert ans_store.store_and_read(odd(spark), path, vocab_size=50257).count() == len(TEXTS) + 1
    assert ans_store.store_and_read(odd(spark).limit(0), path, vocab_size=50257).count() == 0


@pytest.mark.parametrize("chunk", [1, 8, 512])
def test_transducers_count_as_the_library(spark, monkeypatch, chunk):
    from tokenizers import Tokenizer

    monkeypatch.setattr(fst_tokens, "CHUNK", chunk)
    lib, count = Tokenizer.from_file(P.path("word_bpe_49k.json")), fst_tokens.Counter(P.path("word_bpe_49k.json"))
    rng = random.Random(chunk)
    bits = [" ", "\n", "'s", "'", "r", "e", "v", "l", "ll", "t", "m", "'re", "1", "²", "A", "é", "Σ", "İ", "中", "\u0301", ".", "!", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "\u3000", "the", "tion"]
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(2000)]
    assert count(texts).tolist() == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_token_count_query_rows(spark):
    got = table(fst_tokens.count_tokens(odd(spark), P.path("word_bpe_49k.json")))
    assert (got[0].n_bytes, got[0].n_tokens, got[0].over_limit) == (0, 0, False)
    assert got[9].over_limit and got[9].n_bytes == len(LONG)


def test_state_maps_compose_with_their_counts():
    rng = np.random.default_rng(1)
    maps, counts = rng.integers(0, 7, (37, 7)), rng.integers(0, 99, (37, 7))
    out, n = fst_tokens.scan((maps, counts))
    for entry in range(7):
        state, total = entry, 0
        for k in range(37):
            total += counts[k, state]
            state = maps[k, state]
            assert (out[k, entry], n[k, entry]) == (state, total)


def test_token_counts_of_repeated_rows_and_nothing(spark):
    df = spark.createDataFrame([(1, "a b's"), (1, "a b's"), (2, None)], "doc_id long, text string")
    rows = sorted((r.doc_id, r.n_tokens) for r in fst_tokens.count_tokens(df, P.path("word_bpe_49k.json")).collect())
    assert rows == [(1, 3), (1, 3), (2, 0)]
    assert fst_tokens.count_tokens(df.limit(0), P.path("word_bpe_49k.json")).count() == 0


# ---- 2: chat ---------------------------------------------------------------------------------


def test_reply_trees_branches_and_templates(spark):
    said = "</s>[INST] \\ ok [/INST] \\[INST]"
    rows = [(1, 1, None, "user", said, 0.0), (1, 2, 1, "assistant", "good", 2.0), (1, 3, 1, "assistant", None, 1.0), (1, 4, 2, None, "more", 0.0), (2, 7, 99, "assistant", "orphan", None), (3, 1, 2, "user", "cycle", 0.0), (3, 2, 1, "user", "cycle", 0.0)]
    m = spark.createDataFrame(rows, "tree long, id long, parent long, role string, text string, score double")
    parsed = chat_trees.parse(chat_trees.format_paths(m, chat_trees.paths(m)))
    got = {(r.tree, r.rank): ([(t.role, t.text) for t in r.turns], r.loss_text) for r in parsed.collect()}
    assert got == {(1, 1): ([("user", said), ("assistant", "good"), ("", "more")], "good"), (1, 2): ([("user", said), ("assistant", "")], ""), (2, 1): ([("assistant", "orphan")], "orphan")}
    assert [(r.tree, r.leaf) for r in chat_trees.paths(m, best=1).select("tree", "leaf").distinct().orderBy("tree").collect()] == [(1, 4), (2, 7)]
    assert chat_trees.paths(m.limit(0)).count() == 0


def test_a_long_chain_takes_few_rounds(spark):
    turns = spark.createDataFrame([(5, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(300)] + [(6, 0, "user", "twice")] * 2, "conv_id long, turn long, role string, text string")
    m = chat_trees.from_turns(turns)
    got = {r.conv_id: r for r in chat_trees.digests(chat_trees.parse(chat_trees.format_paths(m, chat_trees.paths(m)))).collect()}
    assert got[5].n_turns == 300 and got[6].n_turns == 2
    assert got[5].loss_sha256 == hashlib.sha256("".join(f"t{i}" for i in range(0, 300, 2)).encode()).hexdigest()


# ---- 4: leaks ----------------------------------------------------------------------------------


def test_leaks_are_found_and_clean_documents_left_alone(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {r.item_id: r.text for r in bench.collect()}
    words = [w for r in docs.limit(50).collect() for w in r.text.split()]
    rng = random.Random(3)
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    planted = []
    for i, t in list(items.items())[:20]:
        swapped = t.split()
        for k in range(3, len(swapped) - 8, 9):
            swapped[k] = "zzz"
        planted += [(10_000 + i, f"{filler(80)} {t} {filler(80)}"), (20_000 + i, f"{filler(40)}\n{' '.join(swapped)}\n{filler(40)}"), (30_000 + i, filler(200))]
    planted += [(40_000, None), (40_001, ""), (40_002, "...")]
    both = docs.select("doc_id", "text").unionByName(spark.createDataFrame(planted, "doc_id long, text string")).withColumn("item_id", F.lit(1))
    odd_items = bench.unionByName(spark.createDataFrame([(900, None), (901, ""), (902, "!!")], "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in latent_leaks.leaks(both.repartition(3), odd_items).collect()}
    verbatim = {(r.doc_id, i) for r in both.collect() for i, t in items.items() if t in (r.text or "")}
    assert len(verbatim & got) >= 0.98 * len(verbatim)
    assert len({(20_000 + i, i) for i in range(20)} & got) >= 18
    assert not [d for d, _ in got if d >= 30_000]
    assert latent_leaks.leaks(both.limit(0), bench).count() == 0
    assert latent_leaks.leaks(both, bench.limit(0)).count() == 0


def test_a_long_item_hides_no_shorter_one(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet")
    words = [w for r in docs.limit(50).collect() for w in r.text.split()]
    rng = random.Random(5)
    filler = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = {r.item_id: r.text for r in bench.collect() if len(r.text.split()) > 36} | {901: filler(1_000), 902: filler(130), 903: filler(300)}
    planted = [(10_000 + i, f"{filler(400)} {t} {filler(400)}") for i, t in items.items()]
    both = docs.unionByName(spark.createDataFrame(planted, "doc_id long, text string"))
    more = bench.unionByName(spark.createDataFrame([(i, items[i]) for i in (901, 902, 903)], "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in latent_leaks.leaks(both, more).collect()}
    assert not {(10_000 + i, i) for i in items} - got


def test_texts_whose_candidates_all_fall(spark):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    table = latent_leaks.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = [(r.item_id, r.text) for r in bench.collect()]
    wanted = latent_leaks.Items(rows, table)
    for _, text in rows[:20]:
        part = " ".join(text.split()[: len(text.split()) // 2])
        assert {x[0] for x in wanted.search([part, text])} == {1}
    assert list(wanted.search([None, "", "..."])) == list(wanted.search([])) == []


@pytest.mark.parametrize("fitted_on", [latent_leaks.FIT_PASSAGES, 500])
def test_leaks_against_a_search_of_all_places(spark, monkeypatch, fitted_on):
    monkeypatch.setattr(latent_leaks, "FIT_PASSAGES", fitted_on)
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items, rng = {r.item_id: r.text.lower().split() for r in bench.collect()}, random.Random(9)
    others = [w for r in docs.collect() for w in r.text.split()]
    rows = [(r.doc_id, r.text) for r in docs.collect()] * 2  # every row twice
    for i, w in items.items():  # paraphrases: every fourth word but the answer's is another
        told = [rng.choice(others) if k % 4 == 3 and k < len(w) - latent_leaks.ANSWER else x for k, x in enumerate(w)]
        rows.append((10_000 + i, " ".join([*rng.choices(others, k=150), *told, *rng.choices(others, k=150)])))
    found = latent_leaks.leaks(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), bench).collect()
    got = collections.Counter((r.doc_id, r.item_id) for r in found)
    assert all(got[x] == 2 for x in got if x[0] < 10_000)
    basis = latent_leaks.fit(docs)
    wanted = latent_leaks.Items([(i, " ".join(w)) for i, w in items.items()], basis)
    expected = set()
    for d, t in dict(rows).items():
        words = [x for x in (y.strip(latent_leaks._PUNCTUATION) for y in t.lower().split()) if x]
        here = set(words)
        for k, i in enumerate(wanted.ids):
            own = wanted.words[k]
            step = max(1, len(own) // 4)
            if sum(x in here for x in own) < latent_leaks.PARAPHRASE * len(own):
                continue
            if any(wanted._covers(k, words[a : a + 2 * len(own)]) for a in range(0, len(words), step)):
                expected.add((d, i))
    assert len(expected) >= len(items) and len(expected & set(got)) >= 0.97 * len(expected)
    assert not [x for x in set(got) - expected if x[0] < 10_000]


def test_words_are_split_and_stripped_as_strings_are():
    text = "  «Ünï-cödé», it's (one)... -- İstanbul\x85two\u2028x\u3000'' ¿qué? 𝒳y end."
    words, plain = latent_leaks.words_of(text.lower()), text.lower().split()
    bare = [w.strip(latent_leaks._PUNCTUATION) for w in plain]
    assert [words.text[a:b] for a, b in zip(words.begin, words.end, strict=True)] == bare
    assert words.bare(0, len(bare)) == [w for w in bare if w]
    assert [f == latent_leaks.FEATURES for f in words.feature] == [not w for w in bare]
    again = latent_leaks.words_of("x " + " ".join(w for w in bare if w))
    assert again.feature[1:].tolist() == [f for f in words.feature.tolist() if f < latent_leaks.FEATURES]
    assert len(latent_leaks.words_of("").feature) == 0 == len(latent_leaks.words_of(" \n").feature)


def test_slices_of_a_long_text(spark, monkeypatch):
    bench = [(1, " ".join(f"item{i}" for i in range(40)))]
    text = " ".join(f"w{i % 700}" for i in range(9_000))
    docs = spark.createDataFrame([(1, text), (2, f"{text} {bench[0][1]} {text}"), (3, bench[0][1])], "doc_id long, text string")
    basis = latent_leaks.fit(docs)
    for size in (1 << 12, 1 << 14, 1 << 18):
        monkeypatch.setattr(latent_leaks, "SLICE", size)
        found = latent_leaks.Items(bench, basis).search([text, f"{text} {bench[0][1]} {text}", "", f"{bench[0][1]} {text}"])
        assert [x[:2] for x in found] == [(1, 1), (3, 1)]
    assert [x for part in latent_leaks.slices(f" {text}\n") for x in part.split()] == text.split()


def test_the_basis_samples_rows_not_texts(spark, monkeypatch):
    monkeypatch.setattr(latent_leaks, "FIT_PASSAGES", 200)
    texts = [" ".join(f"w{k}x{i}" for i in range(latent_leaks.BLOCK)) for k in range(40)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts * 50)], "doc_id long, text string")
    basis = latent_leaks.fit(rows)
    known = [np.abs(basis.vectors[latent_leaks.words_of(t).feature]).max() > 0 for t in texts]
    assert sum(known) >= 39  # one in ten of 50 copies each; by text it would be one in ten of 40


def test_short_items_are_found_in_other_text(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in bench.collect() if len(r.text.split()) < 20]
    wanted, rng = latent_leaks.Items(rows, latent_leaks.fit(docs)), random.Random(2)
    others = [r.text.split() for r in docs.collect() if len((r.text or "").split()) > 100]
    for _ in range(30):
        pasted = []
        for _, t in rows:
            w = rng.choice(others)
            at = rng.randrange(40, 60)
            pasted.append(" ".join([*w[:at], t, *w[at:]]))
        assert {(k, i) for k, (i, _) in enumerate(rows)} <= {x[:2] for x in wanted.search(pasted)}


def test_common_length_is_the_subsequence():
    rng = random.Random(0)
    for _ in range(200):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        assert latent_leaks.common_length(a, b) == best[-1][-1]


# ---- 6: join -----------------------------------------------------------------------------------


def _sets(docs):
    out = {}
    for r in docs.collect():
        w = re.findall(r"[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in r.text or ""))
        out[r.doc_id] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def _brute(sets):
    index, common, root = collections.defaultdict(list), collections.Counter(), {k: k for k in sets}
    for k, s in sets.items():
        for x in s:
            common.update((j, k) for j in index[x])
            index[x].append(k)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in common.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {k: (len(s), find(k)) for k, s in sets.items()}


def test_join_equals_brute_force(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 3000)}" for _ in range(rng.choice([3, 5, 9, 14, 60, 200]))] for _ in range(25)]
    texts = list(TEXTS)
    for words in base:
        for _ in range(12):  # near copies around the threshold, so that components chain
            copy = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                copy[rng.randrange(len(copy))] = f"x{rng.randint(0, 9)}"
            texts.append(" ".join(copy + words[: rng.randint(0, len(words) // 8)]))
    docs = odd(spark, texts).dropDuplicates(["doc_id"])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in pigeonhole_join.link(docs, buckets=4).collect()}
    assert got == _brute(_sets(docs))


def test_join_of_repeated_rows_nulls_and_nothing(spark):
    df = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b\tc d e f"), (3, None), (None, "q r s t u v")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in pigeonhole_join.link(df, buckets=2).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3), (None, 2, None)], key=repr)
    assert pigeonhole_join.link(df.limit(0), buckets=2).count() == 0


def test_every_linked_pair_meets_in_a_probed_key():
    rng = np.random.default_rng(7)
    for n in (4, 5, 9, 20, 47, 48, 100, 333):
        for _ in range(30):
            r = rng.integers(0, 1 << 62, n).astype(np.uint64)
            s = r.copy()
            most = pigeonhole_join.most_different(n, n)
            k = max(0, most // 2)
            s[:k] = rng.integers(0, 1 << 62, k).astype(np.uint64)
            r, s = np.sort(r), np.sort(s)
            keys = []
            for h, prober in ((r, True), (s, False)):
                place, value = pigeonhole_join.ordered(h)
                own = set()
                for band, only in pigeonhole_join.schemes(n):
                    k2, f = pigeonhole_join.signatures(place, value, band, pigeonhole_join.bands(1 << max(8, n.bit_length()))[band], only)
                    own |= set(k2[(f & pigeonhole_join.PROBES) > 0].tolist()) if prober else set() if only else set(k2.tolist())
                keys.append(own)
            assert keys[0] & keys[1] or not pigeonhole_join.schemes(n)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (200, 201), (201, 200)]
    got = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 201: 200}


# ---- 7: lines ------------------------------------------------------------------------------------


def test_line_rules_keep_clean_text_and_remove_lines(spark):
    clean = "A first sentence that is quite long and clean.\nAnother one follows right here, with more words.\n\nThe end is near!"
    nav = clean + "\nHome | News | Shop | About\nAll rights reserved.\nREAD!! THIS!! NOW!!\nno end mark"
    junk = "\n".join(f"a{k} | b{k} | c{k} | d{k} | e{k}" for k in range(4)) + "\nthis line alone is fine as such."
    got = table(line_rules.judge(odd(spark, [clean, nav, junk, None, "x y. " * 50]), keep=["lang", "t", "words"]))
    assert got[0].kept and got[0].clean == clean
    assert got[1].kept and got[1].clean == clean
    assert not got[2].kept and not got[2].base_failed
    assert got[3].base_failed and not got[3].kept and got[3].n_words == 0
    assert got[4].n_repeat_words == 100 and got[4].base_failed
    assert got[1].lang == "en" and got[1].words == [1]
    assert line_rules.judge(odd(spark).limit(0)).count() == 0


def test_line_rules_base_counts_against_brute_force(spark):
    got = table(line_rules.judge(odd(spark)))
    for i, t in enumerate(TEXTS):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0d]+", t)
        windows = collections.Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4))
        covered = {k + j for k in range(len(w) - 4) if windows[tuple(w[k : k + 5])] > 1 for j in range(5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0d]", x)]
        assert (got[i].n_words, got[i].word_chars, got[i].n_symbols, got[i].n_dup_lines, got[i].n_repeat_words) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(covered))


# ---- 8, 9, 10 ---------------------------------------------------------------------------------------


def test_backoff_scores_against_brute_force(spark):
    texts = [*TEXTS, "a b c d a b c", "a b c", "x a b c d", "z", "a b a b a b"]
    docs = odd(spark, texts)  # one row twice
    words = [(t or "").encode().lower().split() for t in [*texts, texts[3]]]
    grams = [[collections.Counter(zip(*(ws[k:] for k in range(n)), strict=False)) for n in (1, 2, 3)] for ws in words]
    whole = [sum((g[n] for g in grams), collections.Counter()) for n in range(3)]
    for order, bits in ((1, 2), (2, 0), (3, None), (3, 5)):
        got = table(backoff_lm.score(docs, order=order, bits=bits))
        for i, t in enumerate(texts):
            ws, total, back = words[i], 0.0, 0
            rest = lambda g, i=i: whole[len(g) - 1][g] - grams[i][len(g) - 1][g]
            for k in range(len(ws)):
                most = min(k + 1, order)
                for n in range(most, 0, -1):
                    gram = tuple(ws[k - n + 1 : k + 1])
                    if n == 1:
                        total += math.log(max(rest(gram), 0.5) / max(1, sum(map(len, words)) - len(ws)))
                    elif rest(gram):
                        total += math.log(rest(gram) / rest(gram[:-1]))
                    else:
                        total += math.log(0.4)
                        continue
                    back += n < most
                    break
            assert (got[i].n_words, got[i].n_backoff) == (len(ws), back)
            assert got[i].score == (pytest.approx(total / len(ws)) if ws else None)
    assert backoff_lm.score(docs, bits=0).count() == len(texts) + 1
    assert backoff_lm.score(docs.limit(0), bits=1).count() == 0


def test_ranks_are_compared_place_by_place(spark):
    texts = {1: ("der hund und die katze", "de"), 2: ("the dog and the cat", "en"), 3: ("le chien et le chat", "fr"), 4: ("the hund", "en"), 5: ("", "en"), 7: ("Straße über öl", "de"), 8: (None, "fr"), 9: ("12 ;", None), 10: ("the dog and the cat", "en")}
    rows = [(i, t, lang) for i, (t, lang) in texts.items()]
    docs = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang string").repartition(2)
    size = 12

    def ranked(texts):
        n = collections.Counter()
        for t in texts:
            for w in "".join(c if c.isalpha() else " " for c in (t or "").lower()).split():
                n.update(w)  # single letters
                n.update(x for x in zip(f" {w}", w, strict=False) if x[0] == " ")
                n.update(x for x in zip(w, f"{w} "[1:], strict=False))
                n.update(zip(f" {w}", w, f"{w} "[1:], strict=False))
        code = lambda g: sum((0 if c == " " else ord(c)) << s for c, s in zip(g, {1: (0,), 2: (42, 0), 3: (42, 21, 0)}[len(g)], strict=True)) | (1 << 63 if len(g) == 1 else 0)
        return [g for g, _ in sorted(n.items(), key=lambda x: (-x[1], code(x[0])))][:size]

    learnt = collections.defaultdict(list)
    for i, t, lang in rows + rows[:2]:
        if lang and t is not None and zlib.crc32(str(i).encode()) % 4 != 2:
            learnt[lang].append(t)
    profiles = {lang: ranked(ts) for lang, ts in learnt.items()}
    found = rank_language.predict(docs, rank_language.learn(docs, size), size).collect()
    assert len(found) == len(rows) + 2
    for r in found:
        own = ranked([texts[r.doc_id][0]])
        if not own:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        far = {lang: sum(abs(p.index(g) - k) if g in p else size for k, g in enumerate(own)) for lang, p in profiles.items()}
        best = min(sorted(far), key=far.get)
        assert (r.lang_pred, r.score) == (best, pytest.approx(1 - far[best] / (size * len(own))))
    assert rank_language.predict(docs.limit(0), rank_language.learn(docs.limit(0))).count() == 0


def test_languages_are_told_apart_where_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = table(rank_language.predict(docs, rank_language.learn(docs)))
    truth = {r.doc_id: r.lang for r in docs.collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, r in rows.items() if r.held_out} == set(held)
    assert sum(rows[i].lang_pred == truth[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows.values())


def test_language_of_nothing(spark):
    docs = odd(spark)
    got = table(rank_language.predict(docs, rank_language.learn(docs)))
    assert [got[i].lang_pred for i in range(4)] == ["und"] * 4 and got[0].score == 0
    assert got[9].lang_pred == "en"
    assert {r.lang_pred for r in rank_language.predict(docs, rank_language.learn(docs.limit(0))).collect()} == {"und"}
    assert rank_language.grams("a")[1].sum() == 4  # a, _a, a_, _a_


def test_url_rules_nest_and_spread(spark):
    urls = [None, "", "no scheme", "http://COM/en/x", "x://a.example.com/en/7?q", "http://example.com/en/71#t", "http://xexample.com/en/7", "http://example.net/de/81", "http://net", "http://net?/de/", "http://a.b/c://d", "http://de.net/de/", "http://u@h:8/en/"]
    pages = spark.createDataFrame([(i, u, "p", 1) for i, u in enumerate(urls + ["http://hot.com/en/1"] * 200)], "page_id long, url string, path string, part int")
    rules = spark.createDataFrame(url_rules.RULES, "host string, path string, verdict string")
    got = table(url_rules.apply_rules(pages.repartition(3), rules), "page_id")
    assert len(got) == len(urls) + 200
    for i, u in enumerate(urls + ["http://hot.com/en/1"] * 200):
        after = (u or "").split("://", 1)[1] if "://" in (u or "") else ""
        host = re.match(r"[^/?#]*", after)[0]
        path = re.match(r"[^?#]*", after[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        fit = [(len(h + q), h + q, v) for h, q, v in url_rules.RULES if (host == h or host.endswith("." + h)) and path.startswith(q)]
        rule, verdict = max(fit)[1:] if fit else (None, "allow")
        assert (got[i].host, got[i].path, got[i].rule, got[i].verdict) == (host, path, rule, verdict)
    assert url_rules.apply_rules(pages.limit(0), rules).count() == 0
    assert {r.verdict for r in url_rules.apply_rules(pages, rules.limit(0)).collect()} == {"allow"}


def test_the_basis_is_fitted_on_every_passage(spark, monkeypatch):
    """Nothing is sampled by itself, and the sums are those of the whole matrix."""
    sampled = []
    monkeypatch.setattr(type(spark.range(1)), "sample", lambda self, *a, **b: sampled.append(a) or self)
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(50)) for _ in range(400)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    parts, added, n = [], latent_leaks._added, 1 << 20

    def counted(*a):
        parts.append({k: x.copy() for k, x in added(*a).items()})
        if len(parts) == 1:  # as if the corpus were large
            assert parts[0][latent_leaks.SLICES - 1][-1] == 800
            parts[0][latent_leaks.SLICES - 1][-1] = n
        return parts[-1]

    monkeypatch.setattr(latent_leaks, "_added", counted)
    latent_leaks.fit(docs)
    df, z = (np.concatenate([p[i] for i in range(latent_leaks.SLICES)]) for p in parts)
    rows = [latent_leaks.words_of(t).feature for t in texts]
    blocks = [r[i : i + latent_leaks.BLOCK] for r in rows for i in range(0, len(r), latent_leaks.BLOCK)]
    assert not sampled and len(blocks) == 800
    size = latent_leaks.RANK + latent_leaks.EXTRA
    w = np.random.default_rng(1).standard_normal((latent_leaks.FEATURES + 1, size)).astype(np.float32)
    idf = np.where(df > 0, np.log((1 + n) / (1 + df)) + 1e-3, 0)
    expected = np.zeros((latent_leaks.FEATURES, size))
    for b in blocks:
        a = idf[b] / np.linalg.norm(idf[b])
        np.add.at(expected, b, a[:, None] * (a @ w[b]))
    assert np.abs(z.reshape(-1, size) - expected).max() < 1e-3 * np.abs(expected).max()


@pytest.mark.parametrize("block, lead_rows, met_pairs", [(2048, 1 << 15, 1 << 20), (3, 8, 4)])
def test_keys_of_one_lead_tell_of_a_pair_once(spark, monkeypatch, block, lead_rows, met_pairs):
    for name, x in (("BLOCK", block), ("LEAD_ROWS", lead_rows), ("MET_PAIRS", met_pairs)):
        monkeypatch.setattr(pigeonhole_join, name, x)
    rng = np.random.default_rng(3)
    full = bytes([255] * (1 << pigeonhole_join.LEAST_BITS))  # excludes nothing
    size = {node: int(rng.integers(50, 55)) for node in range(12)}
    rows = [(key, node, node // 2, bool(rng.random() < 0.7), bool(rng.random() < 0.7)) for key in range(40) for node in range(12) if rng.random() < 0.8]
    many = collections.Counter(r[0] for r in rows)
    lead = {key: min(r[1] for r in rows if r[0] == key) for key in many}
    expected = set()
    for key, a, root, probes, _ in rows:
        expected |= {(a, b, g) for k, b, g, _, indexes in rows if k == key and probes and indexes and root != g and (size[b], b) < (size[a], a)}
    table = spark.createDataFrame([(key, many[key], lead[key], node, root, size[node], full, probes, indexes) for key, node, root, probes, indexes in rows], "key long, many long, lead long, node long, root long, n long, coarse binary, probes boolean, indexes boolean")
    found = [tuple(r) for r in pigeonhole_join._met(table, 80).collect()]
    assert set(found) == expected
    if block == 2048:  # one row for each pair and lead
        assert len(found) <= len(expected) * len(set(lead.values()))
        assert len(found) < sum(k == key and probes and indexes and root != g and (size[b], b) < (size[a], a) for key, a, root, probes, _ in rows for k, b, g, _, indexes in rows) / 3


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(7)
    for n in (1, 30, 255, 257, 400, 513, 1100, 5000):
        for _ in range(20):
            one = rng.integers(0, 1 << 63, n, np.uint64)
            kept = one[rng.random(n) < 0.9]
            other = np.concatenate([kept, rng.integers(0, 1 << 63, int(rng.integers(0, n // 10 + 2)), np.uint64)])
            large, small = (one, other) if len(one) >= len(other) else (other, one)
            found = int(pigeonhole_join.flipped(pigeonhole_join.sketch(small)[None, :], pigeonhole_join.sketch(large))[0])
            assert found <= len(np.setxor1d(one, other))


def test_texts_that_share_a_passage_do_not_meet_in_all_pairs(spark, monkeypatch):
    rng, met = random.Random(4), []
    passage = " ".join(f"p{rng.randint(0, 9999)}" for _ in range(300))
    docs = spark.createDataFrame([(i, passage + "".join(f" w{rng.randint(0, 10**9)}" for _ in range(60))) for i in range(40)], "doc_id long, text string")
    counted = pigeonhole_join._met

    def count(rows, percent):
        found = counted(rows, percent)
        met.append(found.count())
        return found

    monkeypatch.setattr(pigeonhole_join, "_met", count)
    assert {(r.doc_id, r.component_id) for r in pigeonhole_join.link(docs, buckets=2).collect()} == {(i, i) for i in range(40)}
    assert met[0] < 40  # of 780 pairs
