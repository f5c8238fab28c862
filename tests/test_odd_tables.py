"""Queries against their SQL on tables that the generated data does not have."""

import random

import pyarrow as pa
import pyarrow.parquet as pq
from conftest import same

from corpusmill.operators import dedup
from corpusmill.plans import registry


def check(spark, folder, query, **tables):
    for name, columns in tables.items():
        pq.write_table(pa.table(columns), folder / f"{name}.parquet")
    same(registry.queries()[query](spark, str(folder)), registry.oracle_sql()[query], str(folder))


def test_judge_gate_shows_the_judge_all_of_the_beginning(spark, tmp_path):
    """The last characters shown, the first ones not shown, and a missing text."""
    texts = [("x" * at + "the").ljust(3502, "x") for at in (2990, 2995, 2996, 2997, 2998, 3000)] + ["x" * 3502, None]
    check(spark, tmp_path, "judge_gate", documents={"doc_id": list(range(len(texts))), "text": texts})

def test_worker_files_counts_repeated_urls(spark, tmp_path):
    urls = [f"http://h/{i // 3}" for i in range(40)] + ["http://h/5", None, None, ""]
    random.Random(1).shuffle(urls)
    check(spark, tmp_path, "worker_files", pages={"page_id": list(range(len(urls))), "url": pa.array(urls, pa.string())})


def test_intervals_that_occur_again_change_nothing(spark, tmp_path):
    """The SQL itself needs rows without repeats: its ORDER BY leaves equal rows open, and its
    two windows may take them in different orders."""
    ids = [i * 37 for i in range(600)]
    for name, times in (("once", 1), ("again", 9)):
        (tmp_path / name).mkdir()
        many = [i + 20000 * k for k in range(times) for i in ids]
        pq.write_table(pa.table({"event_id": many, "user_id": [i % 20000 % 5 for i in many]}), tmp_path / name / "events.parquet")
    for query in ("merged_intervals", "unused_intervals"):
        same(registry.queries()[query](spark, str(tmp_path / "again")), registry.oracle_sql()[query], str(tmp_path / "once"))


def near_copies(rng, groups, copies, most):
    """Texts of several families, some of their five-word groups replaced, and lines of many families."""
    texts = []
    for g in range(groups):
        words = [f"g{g}w{i}" for i in range(200)]
        words[:20] = [f"common{i}" for i in range(20)]
        for _ in range(copies):
            own = list(words)
            for at in rng.sample(range(40), rng.randint(0, most)):
                own[5 * at] = f"x{rng.randint(0, 10**9)}"
            texts.append(" ".join(own))
    texts += texts[::7] + ["a b", "a b", "a b c", "", None, None]
    rng.shuffle(texts)
    return texts


def kept_of(texts):
    """Greedy in order over sets of shingles, in plain Python."""
    kept, sets, short = set(), [], set()
    for i, t in enumerate(texts):
        w = (t or "").split()
        s = frozenset(" ".join(w[k : k + 5]) for k in range(0, len(w) - 4, 5))
        if not s and t not in short or s and not any(len(s & o) / len(s | o) >= 0.8 for o in sets):
            kept.add(i)
            short |= set() if s else {t}
            sets += [s] if s else []
    return kept


def test_dedup_chain_by_rounds_and_by_pairs(spark, tmp_path, monkeypatch):
    texts = near_copies(random.Random(3), 2, 9, 7)
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())}), tmp_path / "documents.parquet")
    for few in (0, 10**9):
        monkeypatch.setattr(dedup, "FEW", few, raising=False)
        got = [r.doc_id for r in registry.queries()["dedup_chain"](spark, str(tmp_path)).collect()]
        assert sorted(got) == sorted(kept_of(texts))


def test_dedup_chain_shuffles_less_than_its_texts(spark, tmp_path):
    """A group of near copies costs by its rows, not by its pairs, and no text is shuffled."""
    texts = near_copies(random.Random(4), 1, 600, 2)
    pq.write_table(pa.table({"doc_id": list(range(len(texts))), "text": pa.array(texts, pa.string())}), tmp_path / "documents.parquet")
    jvm, store = spark.sparkContext._jvm, spark.sparkContext._jsc.sc().statusStore()

    def written():
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        stages = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}

    before = written()
    registry.queries()["dedup_chain"](spark, str(tmp_path)).collect()
    new = sum(n for k, n in written().items() if k not in before)
    assert 0 < new < 2 * sum(len(t or "") for t in texts)
