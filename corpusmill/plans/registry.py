"""All queries of the library and the SQL that checks them.

``query`` registers a function (t, spark) with the SQL of the same name; ``t`` reads a table
of the folder that the query is run on.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusmill.functions import text as X
from corpusmill.operators import dedup, filters, intervals, judging, packing, rollouts, tokens
from corpusmill.plans import planner
from corpusmill.session import shared_folder
from corpusmill.sources import tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        _QUERIES[f.__name__] = run
        if sql:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from corpusmill.plans import more  # noqa: F401  registers its own

    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    from corpusmill.plans import more  # noqa: F401

    return dict(_SQL)


def _checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage in the session's shared checkpoint folder; one of our own only if unset."""
    spark = df.sparkSession
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


# ---- quality filters -------------------------------------------------------------------

_W = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
_ALPHA = r"(length(regexp_replace(text, '[^\p{L}]', '', 'g')) / length(text))"
_TOPS = f"tops AS (SELECT doc_id, CASE WHEN sum(c) < 10 THEN 0.0 ELSE max(c) / sum(c) END AS top, CAST(sum(c) AS BIGINT) AS n FROM (SELECT doc_id, w, count(*) AS c FROM (SELECT doc_id, unnest({_W}) AS w FROM documents) GROUP BY doc_id, w) GROUP BY doc_id)"
_JUNK = " ".join(f"WHEN contains(lower(text), '{m}') THEN 'junk_marker:{m}'" for m in filters.JUNK_MARKERS)
_PROSE = f"CASE WHEN length(text) < 500 THEN 'too_short' WHEN {_ALPHA} < 0.5 THEN 'low_alpha_ratio' WHEN coalesce(top, 0) > 0.4 THEN 'high_repetition' WHEN length(text) > 2000 AND len(string_split(text, chr(10))) < 3 THEN 'single_block_too_long' {_JUNK} END"


@query(f"WITH {_TOPS} SELECT doc_id, {_PROSE} AS reason FROM documents LEFT JOIN tops USING (doc_id)")
def prose_filter(t, spark):
    return t("documents").select("doc_id", filters.prose_reason(F.col("text")).alias("reason"))


@query(rf"""WITH {_TOPS} SELECT doc_id, CASE WHEN length(text) < 300 THEN 'too_short' WHEN {_ALPHA} < 0.5 THEN 'low_alpha_ratio' WHEN coalesce(top, 0) > 0.35 THEN 'high_repetition'
  WHEN length(regexp_replace(lower(text), '\[music\]|\[applause\]|\[laughter\]|♪', '', 'g')) < 150 THEN 'mostly_nonspeech' END AS reason FROM documents LEFT JOIN tops USING (doc_id)""")
def transcript_filter(t, spark):
    return t("documents").select("doc_id", filters.transcript_reason(F.col("text")).alias("reason"))


_PATHS = ["", "src/a.py", "lib/b.exe", "vendor/c.go", "web/d.min.js", ".bashrc", "x/y.SQL", "gen/generated_e.rs"]


@query("""SELECT doc_id, CASE WHEN length(text) < 500 THEN 'too_short' WHEN doc_id % 8 = 2 THEN 'disallowed_extension' WHEN doc_id % 8 = 3 THEN 'skip_path:vendor/' WHEN doc_id % 8 = 4 THEN 'skip_path:.min.js' WHEN doc_id % 8 = 7 THEN 'skip_path:generated' WHEN len(list_filter(string_split(text, chr(10)), lambda x: length(x) > 1000)) > 0 THEN 'line_too_long'
  WHEN list_sum(list_transform(string_split(text, chr(10)), lambda x: length(x))) / len(string_split(text, chr(10))) > 200 THEN 'avg_line_too_long' END AS reason FROM documents""")
def code_filter(t, spark):
    path = F.get(F.array(*map(F.lit, _PATHS)), (F.col("doc_id") % 8).cast("int"))
    return t("documents").select("doc_id", filters.code_reason(F.col("text"), path).alias("reason"))


@query(f"WITH {_TOPS}, j AS (SELECT lang, source, {_PROSE} AS reason FROM documents LEFT JOIN tops USING (doc_id)) SELECT lang, source, coalesce(reason, 'pass') AS reason, count(*) AS n FROM j GROUP BY ALL")
def reject_report(t, spark):
    return filters.reject_report(t("documents").select("lang", "source", filters.prose_reason(F.col("text")).alias("reason")), "lang", "source")


@query(rf"SELECT doc_id, round({_ALPHA}, 9) AS alpha, round(length(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g')) / length(text), 9) AS alnum FROM documents")
def character_ratios(t, spark):
    return t("documents").select("doc_id", F.round(X.alpha_ratio(F.col("text")), 9).alias("alpha"), F.round(X.alnum_ratio(F.col("text")), 9).alias("alnum"))


@query(f"WITH {_TOPS} SELECT doc_id, coalesce(n, 0) AS n_words, round(coalesce(top, 0), 9) AS top FROM documents LEFT JOIN tops USING (doc_id)")
def word_repetition(t, spark):
    d = t("documents").select("doc_id", X.words(F.col("text")).alias("w"))
    return d.select("doc_id", F.size("w").cast("long").alias("n_words"), F.round(X.top_word_share(F.col("w")), 9).alias("top"))


@query(f"""WITH {_TOPS}, j AS (SELECT d.*, {_PROSE} AS reason FROM documents d LEFT JOIN tops USING (doc_id)),
  k AS (SELECT lang, min_by(octet_length(encode(text)), doc_id) AS b, text FROM (SELECT lang, text, doc_id FROM j WHERE reason IS NULL) GROUP BY lang, text),
  f AS (SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) AS r FROM j WHERE reason IS NULL) WHERE r = 1)
  SELECT lang, count(*) AS n_docs, count(*) FILTER (reason IS NULL) AS n_pass, count(f.doc_id) AS n_kept, CAST(coalesce(sum(octet_length(encode(text))) FILTER (f.doc_id IS NOT NULL), 0) AS BIGINT) AS kept_bytes
  FROM j LEFT JOIN f ON f.doc_id = j.doc_id GROUP BY lang""")
def corpus_report(t, spark):
    """The curation pipeline in one report: filter, exact duplicates, sizes by language."""
    judged = t("documents").select("doc_id", "lang", F.col("text"), filters.prose_reason(F.col("text")).alias("reason"))
    rows = judged.select("doc_id", "lang", F.sha1("text").alias("hash"), F.octet_length("text").alias("bytes"), F.col("reason").isNull().alias("ok"))
    # One row per passed text, and one per failed row's language, with what each adds to the report.
    texts = rows.groupBy("ok", F.when(F.col("ok"), F.col("hash")).alias("hash"), "lang").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "bytes")).alias("first"))
    firsts = Window.partitionBy("hash").orderBy("first.doc_id")
    texts = texts.withColumn("kept", F.col("ok") & (F.row_number().over(firsts) == 1))
    counts = texts.groupBy("lang").agg(F.sum("n").alias("n_docs"), F.sum(F.when(F.col("ok"), F.col("n")).otherwise(0)).alias("n_pass"), F.count(F.when(F.col("kept"), 1)).alias("n_kept"), F.sum(F.when(F.col("kept"), F.col("first.bytes")).otherwise(0)).cast("long").alias("kept_bytes"))
    return counts


# ---- duplicates --------------------------------------------------------------------------


@query("SELECT doc_id, sha1(text) AS hash FROM documents QUALIFY row_number() OVER (PARTITION BY sha1(text) ORDER BY doc_id) = 1")
def exact_dedup(t, spark):
    return dedup.exact(t("documents")).select("doc_id", F.sha1("text").alias("hash"))


@query("SELECT doc_id FROM documents WHERE sha1(text) NOT IN (SELECT sha1(text) FROM documents WHERE source = 'src0')")
def incremental_dedup(t, spark):
    docs = t("documents")
    seen = docs.filter("source = 'src0'").select(F.sha1("text").alias("hash"))
    return dedup.unseen(docs, seen).select("doc_id")


@query("SELECT page_id FROM pages QUALIFY row_number() OVER (PARTITION BY url ORDER BY page_id) = 1")
def url_dedup(t, spark):
    return dedup.first_of(t("pages"), F.col("url"), "page_id").select("page_id")


_SHINGLES = f"""w AS (SELECT doc_id, {_W} AS w FROM documents),
  s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(w) - 3, 5), lambda i: array_to_string(w[i : i + 4], ' ')))) AS s FROM w WHERE len(w) >= 5)"""


@query(f"WITH {_SHINGLES} SELECT d.doc_id, CAST(coalesce(len(s), 0) AS BIGINT) AS n FROM documents d LEFT JOIN s ON s.doc_id = d.doc_id")
def shingle_counts(t, spark):
    return dedup.with_shingles(t("documents").select("doc_id", "text")).select("doc_id", F.size("shingles").cast("long").alias("n"))


@query(f"""WITH {_SHINGLES}, r AS (SELECT s, min(doc_id) AS id FROM s GROUP BY s), x AS (SELECT id, len(s) AS n, unnest(s) AS x FROM r),
  p AS (SELECT a.id AS a, b.id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id)
  SELECT a, b, round(c / (na + nb - c), 9) AS jaccard FROM p WHERE c / (na + nb - c) >= 0.8""")
def near_pairs(t, spark):
    return dedup.near_pairs(t("documents")).withColumn("jaccard", F.round("jaccard", 9))


@query(f"""WITH RECURSIVE {_SHINGLES}, r AS (SELECT s, min(doc_id) AS id FROM s GROUP BY s), x AS (SELECT id, len(s) AS n, unnest(s) AS x FROM r),
  p AS (SELECT a.id AS a, b.id AS b FROM (SELECT a.id AS i, b.id AS j, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.x = b.x AND a.id < b.id GROUP BY a.id, b.id) q JOIN r a ON a.id = q.i JOIN r b ON b.id = q.j WHERE c / (na + nb - c) >= 0.8),
  o AS (SELECT id, row_number() OVER (ORDER BY id) AS k, (SELECT list(a) FROM p WHERE p.b = v.id) AS before FROM (SELECT DISTINCT b AS id FROM p) v),
  g AS (SELECT CAST(0 AS BIGINT) AS k, CAST([] AS BIGINT[]) AS dropped UNION ALL SELECT o.k, CASE WHEN len(list_filter(o.before, lambda y: NOT list_contains(g.dropped, y))) > 0 THEN list_append(g.dropped, o.id) ELSE g.dropped END FROM g JOIN o ON o.k = g.k + 1),
  gone AS (SELECT unnest(dropped) AS id FROM (SELECT dropped FROM g ORDER BY k DESC LIMIT 1))
  SELECT id AS doc_id FROM r WHERE id NOT IN (SELECT id FROM gone) UNION ALL SELECT doc_id FROM w WHERE len(w) < 5""")
def near_dedup(t, spark):
    """Greedy in order over all rows: copies of one shingle set, then similar sets."""
    docs = t("documents").select("doc_id", "text")
    sets = dedup.with_shingles(docs).select("doc_id", F.sort_array("shingles").alias("s"))
    short = sets.filter("size(s) = 0").select("doc_id")
    first = _checkpoint(sets.filter("size(s) > 0").groupBy("s").agg(F.min("doc_id").alias("doc_id")).select("doc_id"))
    kept = dedup.ordered_keep(first, dedup.near_pairs(docs), _checkpoint)
    return kept.select(F.col("id").alias("doc_id")).unionByName(short)


@query(f"""WITH l AS (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM documents)
  SELECT doc_id, md5(array_to_string(list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), chr(10))) AS hash FROM l""")
def line_dedup(t, spark):
    return t("documents").select("doc_id", F.md5(dedup.line_runs(F.col("text"))).alias("hash"))


# ---- pages ---------------------------------------------------------------------------------

_HOST = r"regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)', 1)), '^www\.', '')"


_KINDS = "CASE page_id % 12 " + " ".join(f"WHEN {i} THEN '{k}'" for i, k in enumerate(["pdf", "xlsx", "xlsx", "docx", "image", "video", "text", "html", "html", "csv", "audio", "text"])) + " END"


@query(f"SELECT page_id, {_HOST} AS host, {_KINDS} AS kind FROM pages")
def page_kinds(t, spark):
    """Kinds by extension, by media host and by MIME type, of urls that get one of each."""
    i = (F.col("page_id") % 12).cast("int")
    ends = F.get(F.array(*[F.lit(x) for x in ("/a.PDF?x=1", "/a.csv", "/b.xls#f", "/c.doc", "/d.jpeg", "", "/e.jsonl", "/.txt", "/f.g/h", "/i", "/j.pdf", "/k.html")]), i)
    site = F.when(i == 5, F.lit("https://www.youtube.com/watch")).otherwise(F.concat(F.lit("http://"), X.net_location(F.col("url"))))
    mime = F.when(i == 9, "Text/CSV; charset=utf-8").when(i == 10, "audio/mpeg").when(i == 11, "application/json")
    return t("pages").select("page_id", X.host(F.col("url")).alias("host"), X.content_kind(F.concat(site, ends), mime).alias("kind"))


@query(f"SELECT page_id FROM pages WHERE ({_HOST} = 'example.net' OR ends_with({_HOST}, '.example.net')) AND NOT ends_with({_HOST}, 'tionsh.example.net')")
def domain_rules(t, spark):
    p = t("pages").withColumn("host", X.host(F.col("url")))
    return p.filter(X.host_among(F.col("host"), ["example.net"]) & ~X.host_among(F.col("host"), ["tionsh.example.net"])).select("page_id")


@query(r"""WITH a AS (SELECT page_id, regexp_replace(html, '(?is)<!--.*?-->', ' ', 'g') AS t FROM pages),
  b AS (SELECT page_id, regexp_replace(t, '(?is)<script\b.*?</script\s*>|<style\b.*?</style\s*>|<nav\b.*?</nav\s*>|<header\b.*?</header\s*>|<footer\b.*?</footer\s*>|<aside\b.*?</aside\s*>', ' ', 'g') AS t FROM a),
  c AS (SELECT page_id, trim(regexp_replace(regexp_replace(t, '<[^>]+>', ' ', 'g'), '[ \t\n\x0B\f\r]+', ' ', 'g')) AS t FROM b) SELECT page_id, length(t) AS n, md5(t) AS hash FROM c WHERE length(t) > 200""")
def html_text(t, spark):
    return t("pages").select("page_id", X.html_to_text(F.col("html")).alias("t")).select("page_id", F.length("t").cast("long").alias("n"), F.md5("t").alias("hash")).filter("n > 200")


@query(rf"SELECT {_HOST} AS host, count(*) AS n FROM pages GROUP BY 1")
def pages_per_host(t, spark):
    return t("pages").groupBy(X.host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


# ---- packing ---------------------------------------------------------------------------------


@query("""WITH p AS (SELECT doc_id, text, unnest(CASE WHEN length(text) <= 5000 THEN [0] ELSE range(0, length(text), 4500) END) AS s FROM documents),
  q AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS piece_no, min(s) FILTER (s + 5000 > length(text)) OVER (PARTITION BY doc_id) AS last FROM p)
  SELECT doc_id, CAST(piece_no AS BIGINT) AS piece_no, length(substr(text, s + 1, 5000)) AS n, md5(substr(text, s + 1, 5000)) AS hash FROM q WHERE length(text) <= 5000 OR s <= last""")
def chunked(t, spark):
    c = packing.chunks(t("documents").select("doc_id", "text"), "text", 5000, 500)
    return c.select("doc_id", F.col("piece_no").cast("long").alias("piece_no"), F.length("piece").cast("long").alias("n"), F.md5("piece").alias("hash"))


_OFFSET = "coalesce(sum(length(text)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)"


@query(f"SELECT doc_id, CAST({_OFFSET} AS BIGINT) AS start FROM documents")
def stream_offsets(t, spark):
    return packing.running_offset(t("documents").select("doc_id", "text"), ["doc_id"], F.length("text"), 16).select("doc_id", F.col("offset").alias("start"))


@query(f"""WITH o AS (SELECT doc_id, length(text) AS n, {_OFFSET} AS o, floor((SELECT sum(length(text)) FROM documents) * 0.005) AS b FROM documents)
  SELECT doc_id, CAST(greatest(0, least(n, b - o)) AS BIGINT) AS val, CAST(n - greatest(0, least(n, b - o)) AS BIGINT) AS train FROM o""")
def prefix_split(t, spark):
    d = t("documents").select("doc_id", F.length("text").cast("long").alias("n"))
    budget = int((d.agg(F.sum("n")).first()[0] or 0) * 0.005)
    o = packing.running_offset(d, ["doc_id"], F.col("n"), 16)
    val, train = packing.prefix_split(F.col("offset"), F.col("n"), F.lit(budget))
    return o.select("doc_id", val.alias("val"), train.alias("train"))


@query("SELECT doc_id, CASE WHEN (row_number() OVER (ORDER BY doc_id) - 1) % 10 = 0 THEN 'val' ELSE 'train' END AS split FROM documents")
def every_nth_split(t, spark):
    o = packing.running_offset(t("documents").select("doc_id"), ["doc_id"], F.lit(1), 16)
    return o.select("doc_id", F.when(packing.every_nth(F.col("offset"), 0.1), "val").otherwise("train").alias("split"))


@query("WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p, count(*) OVER () AS n FROM documents) SELECT doc_id, CAST(least(p // (n // 7), 6) AS INT) AS rank FROM n")
def rank_shards(t, spark):
    d = t("documents").select("doc_id")
    return packing.running_offset(d, ["doc_id"], F.lit(1), 16).select("doc_id", packing.rank_of(F.col("offset"), F.lit(d.count()), 7).alias("rank"))


@query("""WITH s AS (SELECT doc_id, coalesce(sum(octet_length(encode(text))) OVER (PARTITION BY lang ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM documents) SELECT doc_id FROM s WHERE b < 100000""")
def byte_budget(t, spark):
    return packing.within_budget(t("documents").select("doc_id", "lang", "text"), "lang", "doc_id", F.octet_length("text"), 100_000, 16).select("doc_id")


@query("""WITH RECURSIVE d AS (SELECT source, doc_id, octet_length(encode(text)) AS n, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents),
  w AS (SELECT source, doc_id, r, n AS held, 0 AS shard FROM d WHERE r = 1
    UNION ALL SELECT d.source, d.doc_id, d.r, CASE WHEN w.held + d.n > 20000 THEN d.n ELSE w.held + d.n END, CASE WHEN w.held + d.n > 20000 THEN w.shard + 1 ELSE w.shard END FROM w JOIN d ON d.source = w.source AND d.r = w.r + 1)
  SELECT doc_id, CAST(shard AS BIGINT) AS shard FROM w""")
def shard_writer(t, spark):
    d = t("documents").select("doc_id", "source", F.octet_length("text").alias("n"))
    return packing.assign_shards(d, "source", "doc_id", F.col("n"), 20_000).select("doc_id", "shard")


@query("SELECT lang AS category, count(*) AS docs, CAST(sum(length(text)) AS BIGINT) AS tokens, round(100 * sum(length(text)) / (SELECT sum(length(text)) FROM documents), 6) AS percent FROM documents GROUP BY lang")
def manifest(t, spark):
    g = t("documents").groupBy(F.col("lang").alias("category")).agg(F.count("*").alias("docs"), F.sum(F.length("text")).cast("long").alias("tokens"))
    total = g.agg(F.sum("tokens").alias("total"))
    return g.join(F.broadcast(total)).select("category", "docs", "tokens", F.round(100 * F.col("tokens") / F.col("total"), 6).alias("percent"))  # one row


@query("SELECT doc_id, unnest(range(0, length(text) - 1024, 1024)) AS start FROM documents WHERE length(text) > 1024")
def sequential_windows(t, spark):
    return t("documents").select("doc_id", F.explode(packing.windows(F.length("text"), 1024)).alias("start"))


@query()
def hashed_windows(t, spark):
    """Reproducible draws; the hash has no SQL twin."""
    d = t("documents").select("doc_id", F.length("text").cast("long").alias("n"))
    return d.select("doc_id", "n", packing.hashed_starts(F.col("doc_id"), F.col("n"), 1024, 42).alias("start"))


# ---- intervals -------------------------------------------------------------------------------

_IV = "iv AS (SELECT user_id AS g, 20000 AS n, (event_id * 7919) % 20000 AS start, least(20000, (event_id * 7919) % 20000 + 64 + event_id % 100) AS stop FROM events)"
_MERGED = f"""{_IV}, o AS (SELECT *, max(stop) OVER (PARTITION BY g ORDER BY start, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM iv),
  i AS (SELECT *, sum(CASE WHEN reach IS NULL OR start > reach THEN 1 ELSE 0 END) OVER (PARTITION BY g ORDER BY start, stop ROWS UNBOUNDED PRECEDING) AS k FROM o),
  m AS (SELECT g, CAST(min(start) AS BIGINT) AS start, CAST(max(stop) AS BIGINT) AS stop FROM i GROUP BY g, k)"""
_GAPS = f"""{_MERGED}, e AS (SELECT g, start, stop FROM m UNION ALL SELECT DISTINCT g, 20000, 20000 FROM iv),
  gaps AS (SELECT * FROM (SELECT g, coalesce(lag(stop) OVER (PARTITION BY g ORDER BY start, stop), 0) AS start, start AS stop FROM e) WHERE stop > start)"""


def _intervals(t) -> DataFrame:
    e = t("events")
    start = (F.col("event_id") * 7919) % 20000
    return e.select(F.col("user_id").alias("g"), F.lit(20000).cast("long").alias("n"), start.alias("start"), (start + 64 + F.col("event_id") % 100).alias("stop"))


@query(f"WITH {_MERGED} SELECT * FROM m")
def merged_intervals(t, spark):
    return intervals.merge(_intervals(t), "g", "n").select("g", "start", "stop")


@query(f"WITH {_GAPS} SELECT g, CAST(start AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM gaps")
def unused_intervals(t, spark):
    iv = _intervals(t)
    return intervals.invert(intervals.merge(iv, "g", "n"), "g", "n", iv.select("g", "n").distinct()).select("g", "start", "stop")


@query(f"WITH {_GAPS}, k AS (SELECT g, sum(stop - start) AS u, count(*) AS r FROM gaps WHERE stop - start >= 1024 GROUP BY g) SELECT DISTINCT iv.g, CAST(coalesce(u, 0) AS BIGINT) AS unused, coalesce(r, 0) AS runs, CAST(20000 - coalesce(u, 0) AS BIGINT) AS used FROM iv LEFT JOIN k ON k.g = iv.g")
def interval_coverage(t, spark):
    iv = _intervals(t)
    groups = iv.select("g", "n").distinct()
    gaps = intervals.invert(intervals.merge(iv, "g", "n"), "g", "n", groups)
    return intervals.coverage(gaps, "g", "n", groups, 1024).select("g", "unused", "runs", "used")


# ---- conversations -----------------------------------------------------------------------------

_PAIR = """u AS (SELECT conv_id, min(turn) AS at, min_by(text, turn) AS prompt FROM conversations WHERE lower(role) IN ('human', 'user', 'prompter') AND trim(coalesce(text, '')) <> '' GROUP BY conv_id),
  pair AS (SELECT c.conv_id, any_value(prompt) AS prompt, min_by(c.text, c.turn) AS answer FROM conversations c JOIN u ON u.conv_id = c.conv_id WHERE lower(role) IN ('gpt', 'assistant', 'bot', 'model') AND trim(coalesce(c.text, '')) <> '' AND c.turn > u.at GROUP BY c.conv_id)"""


@query(f"WITH {_PAIR} SELECT * FROM pair")
def first_exchange(t, spark):
    return tables.first_exchange(t("conversations"))


_BOTH = "trim(prompt) || chr(10) || chr(10) || trim(answer)"


@query(rf"""WITH {_PAIR} SELECT conv_id, CASE WHEN length({_BOTH}) < 20 THEN 'too_short' WHEN length(regexp_replace({_BOTH}, '[^\p{{L}}\p{{N}}]', '', 'g')) / length({_BOTH}) < 0.25 THEN 'low_content_ratio'
  WHEN lower(trim(prompt)) = lower(trim(answer)) THEN 'answer_echoes_prompt' {_JUNK.replace('lower(text)', f'lower({_BOTH})')} END AS reason FROM pair""")
def pair_filter(t, spark):
    return tables.first_exchange(t("conversations")).select("conv_id", filters.pair_reason(F.col("prompt"), F.col("answer")).alias("reason"))


@query(f"""WITH {_PAIR} SELECT conv_id, '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) AS given, '<|im_start|>assistant' || chr(10) || answer || '<|im_end|>' || chr(10) AS learnt,
  '<|im_start|>user' || chr(10) || prompt || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) AS opened FROM pair""")
def chat_templates(t, spark):
    p = tables.first_exchange(t("conversations"))
    given, learnt = X.sft_turns(F.col("prompt"), F.lit(""), F.col("answer"))
    return p.select("conv_id", given.alias("given"), learnt.alias("learnt"), X.prompt_turns(F.col("prompt"), F.col("answer"))[0].alias("opened"))


_STREAM = "st AS (SELECT conv_id AS g, turn * 2 AS pos, length(text) % 50 + 1 AS token, CASE WHEN role = 'assistant' THEN 1 ELSE 0 END AS mask FROM conversations UNION ALL SELECT conv_id, turn * 2 + 1, 0, 0 FROM conversations)"


@query(f"""WITH {_STREAM}, a AS (SELECT *, coalesce(sum(CASE WHEN token = 0 AND mask = 0 THEN 1 ELSE 0 END) OVER w, 0) AS seg FROM st WINDOW w AS (PARTITION BY g ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  b AS (SELECT *, max(mask) OVER (PARTITION BY g, seg) AS has FROM a), c AS (SELECT *, coalesce(sum(CASE WHEN token = 0 AND mask = 0 THEN has ELSE 0 END) OVER (PARTITION BY g ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS record FROM b),
  d AS (SELECT *, max(mask) OVER (PARTITION BY g, record) AS ok FROM c) SELECT g, CAST(pos AS BIGINT) AS pos, CAST(record AS BIGINT) AS record FROM d WHERE ok = 1""")
def record_boundaries(t, spark):
    c = t("conversations")
    given = c.select(F.col("conv_id").alias("g"), (F.col("turn") * 2).alias("pos"), (F.length("text") % 50 + 1).alias("token"), (F.col("role") == "assistant").cast("int").alias("mask"))
    ends = c.select(F.col("conv_id").alias("g"), (F.col("turn") * 2 + 1).alias("pos"), F.lit(0).alias("token"), F.lit(0).alias("mask"))
    return rollouts.records(given.unionByName(ends), "g").select("g", "pos", "record")


# ---- rollouts ------------------------------------------------------------------------------------

_TOLD = "r AS (SELECT doc_id, lang, CASE WHEN doc_id % 3 = 0 THEN '' ELSE '<think>' || substr(text, 1, 20) || '</think> ' END || CASE WHEN doc_id % 4 = 0 THEN '\\boxed{' || (n_chars % 5) || '}' WHEN doc_id % 4 = 1 THEN 'so ' || (n_chars % 5) || '.5 then' ELSE 'the answer' END AS told, CAST(n_chars % 3 AS VARCHAR) AS gold FROM documents)"
_ANSWER = r"CASE WHEN regexp_matches(told, '\\boxed\{([^}]+)\}') THEN regexp_extract(told, '\\boxed\{([^}]+)\}', 1) WHEN doc_id % 4 = 1 THEN regexp_extract_all(told, '-?[0-9]+(?:\.[0-9]+)?')[-1] ELSE 'answer' END"


def _told(t) -> DataFrame:
    n = F.col("n_chars") % 5
    think = F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.concat(F.lit("<think>"), F.substring("text", 1, 20), F.lit("</think> ")))
    end = F.when(F.col("doc_id") % 4 == 0, F.concat(F.lit("\\boxed{"), n, F.lit("}"))).when(F.col("doc_id") % 4 == 1, F.concat(F.lit("so "), n, F.lit(".5 then"))).otherwise("the answer")
    return t("documents").select("doc_id", "lang", F.concat(think, end).alias("told"), (F.col("n_chars") % 3).cast("string").alias("gold"))


@query(f"WITH {_TOLD} SELECT doc_id, {_ANSWER} AS answer FROM r")
def answers(t, spark):
    return _told(t).select("doc_id", X.answer_of(F.col("told")).alias("answer"))


_REWARD = f"rw AS (SELECT doc_id, lang, {_ANSWER} AS a, gold, contains(told, '<think>') AS th, length(told) >= 400 AS cut FROM r), rr AS (SELECT doc_id, lang, CASE WHEN TRY_CAST(a AS DOUBLE) IS NOT NULL AND abs(CAST(gold AS DOUBLE) - TRY_CAST(a AS DOUBLE)) <= greatest(1e-3 * greatest(abs(CAST(gold AS DOUBLE)), abs(TRY_CAST(a AS DOUBLE))), 1e-4) THEN CASE WHEN th THEN 1.0 ELSE 0.5 END WHEN th AND NOT cut THEN 0.3 ELSE 0.0 END AS reward FROM rw)"


@query(f"WITH {_TOLD}, {_REWARD} SELECT doc_id, CAST(reward AS DOUBLE) AS reward FROM rr")
def rewards(t, spark):
    return _told(t).select("doc_id", rollouts.reward(F.col("told"), F.col("gold"), 100)["reward"].alias("reward"))


@query("WITH g AS (SELECT user_id, avg(value) AS m, greatest(coalesce(stddev_samp(value), 0), 1e-4) AS s FROM events GROUP BY user_id) SELECT event_id, round((value - m) / s, 6) AS advantage FROM events JOIN g USING (user_id)")
def group_advantage(t, spark):
    return rollouts.advantage(t("events").select("event_id", "user_id", "value"), "user_id", "value").select("event_id", F.round("advantage", 6).alias("advantage"))


_TOK = "tk AS (SELECT (event_id % 7 - 3) / 2.0 AS adv, (event_id % 11) / 50.0 - (event_id % 5) / 40.0 AS lr0, CASE WHEN event_id % 4 = 0 THEN 0 ELSE 1 END AS m FROM events), tl AS (SELECT adv, lr0 * m AS lr, m FROM tk)"


@query(f"""WITH {_TOK}, s AS (SELECT sum(-least(adv * exp(lr), adv * greatest(0.8, least(1.2, exp(lr)))) * m) / greatest(sum(m), 1) AS pg, sum((exp(lr) - lr - 1) * m) / greatest(sum(m), 1) AS kl, avg(exp(lr)) AS ratio_mean FROM tl)
  SELECT round(pg, 6) AS pg, round(kl, 6) AS kl, round(ratio_mean, 6) AS ratio_mean, round(pg + 0.04 * kl, 6) AS loss FROM s""")
def policy_loss(t, spark):
    i = F.col("event_id")
    tokens = t("events").select(((i % 7 - 3) / 2.0).alias("advantage"), (i % 11 / 50.0).alias("logp"), (i % 5 / 40.0).alias("ref_logp"), (i % 4 != 0).cast("int").alias("mask"))
    loss = rollouts.policy_loss(tokens, 0.2, 0.04)
    return loss.select(*[F.round(c, 6).alias(c) for c in ("pg", "kl", "ratio_mean", "loss")])


@query("""WITH k AS (SELECT user_id, event_id, value / 50 AS logit, rank() OVER (PARTITION BY user_id ORDER BY value / 50 DESC) AS r FROM events),
  p AS (SELECT *, exp(logit - max(logit) OVER (PARTITION BY user_id)) AS e FROM k WHERE r <= 8), q AS (SELECT *, e / sum(e) OVER (PARTITION BY user_id) AS p FROM p),
  c AS (SELECT *, sum(p) OVER w AS cum, row_number() OVER w AS n FROM q WINDOW w AS (PARTITION BY user_id ORDER BY logit DESC, event_id ROWS UNBOUNDED PRECEDING)) SELECT user_id, event_id AS token, round(p, 6) AS p FROM c WHERE cum <= 0.9 OR n = 1""")
def nucleus_filter(t, spark):
    logits = t("events").select("user_id", F.col("event_id").alias("token"), (F.col("value") / 50).alias("logit"))
    return rollouts.nucleus(logits, "user_id", 8, 0.9).select("user_id", "token", F.round("p", 6).alias("p"))


@query("SELECT lang, round(sum(n_chars * (CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END)) / greatest(sum(CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END), 1), 6) AS mean FROM documents GROUP BY lang")
def masked_mean(t, spark):
    return t("documents").groupBy("lang").agg(F.round(rollouts.masked_mean(F.col("n_chars"), (F.col("doc_id") % 3 == 0).cast("int")), 6).alias("mean"))


@query("""WITH e AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS k FROM events)
  SELECT user_id, max(n) AS longest FROM (SELECT user_id, event_type, k, count(*) AS n FROM e GROUP BY ALL) GROUP BY user_id""")
def longest_error_run(t, spark):
    """Equal neighbours in a row, as a breaker counts equal errors."""
    e = t("events").groupBy("user_id").agg(F.sort_array(F.collect_list(F.struct("event_id", "event_type"))).alias("e"))
    return e.select("user_id", X.longest_run(F.transform("e", lambda x: x["event_type"])).cast("long").alias("longest"))


@query("SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS r FROM events) WHERE r <= greatest(1, 500 // (SELECT count(DISTINCT event_type) FROM events))")
def capped_rows(t, spark):
    return tables.capped(t("events"), "event_type", "event_id", 500).select("event_id")


@query("SELECT time_bucket(INTERVAL '1 hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY ALL")
def hourly_events(t, spark):
    """The window aggregate of the streaming module, over a batch."""
    g = t("events").groupBy(F.window("ts", "1 hour").alias("w"), "event_type").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.col("w.start").alias("start"), "event_type", "n", "total")


@query(f"WITH {_PAIR} SELECT trim(prompt) || chr(10) || chr(10) || trim(answer) AS text, trim(prompt) AS prompt, trim(answer) AS answer, 'pairs' AS source FROM pair")
def mapped_records(t, spark):
    """Columns by their usual names, whatever their case; a pair makes the text where there is none."""
    pairs = tables.first_exchange(t("conversations")).select(F.col("prompt").alias("Instruction"), F.col("answer").alias("OUTPUT"))
    return tables.as_records(pairs, "pairs")


@query("SELECT trim(text) AS text, CAST(NULL AS VARCHAR) AS prompt, CAST(NULL AS VARCHAR) AS answer, 'documents' AS source FROM documents")
def mapped_texts(t, spark):
    return tables.as_records(t("documents").select("text", "lang"), "documents", {"text": "TEXT"})


# ---- plans -----------------------------------------------------------------------------------------


@query("""WITH p AS (SELECT l_orderkey, l_linenumber, CAST(l_extendedprice * 1000000 AS DOUBLE) AS tokens FROM lineitem), q AS (SELECT *, CAST(round(tokens / 20) AS BIGINT) AS params FROM p),
  r AS (SELECT *, CASE WHEN params < 5e8 THEN 1000000 WHEN params < 2e9 THEN 2000000 WHEN params < 8e9 THEN 4000000 ELSE 8000000 END AS batch FROM q),
  s AS (SELECT *, CAST(greatest(1, floor(tokens / batch)) AS BIGINT) AS steps FROM r)
  SELECT l_orderkey, l_linenumber, params, CAST(batch AS BIGINT) AS batch, steps, CAST(greatest(100, floor(steps / 100)) AS BIGINT) AS warmup, round(5e-4 * sqrt(2000000 / batch), 9) AS lr FROM s""")
def pretrain_plans(t, spark):
    p = t("lineitem").select("l_orderkey", "l_linenumber", (F.col("l_extendedprice") * 1000000).cast("double").alias("tokens"))
    return planner.pretrain_plan(p).select("l_orderkey", "l_linenumber", "params", "batch", "steps", "warmup", F.round("lr", 9).alias("lr"))


@query("SELECT event_id, round(CASE WHEN event_id < 100 THEN 3e-4 * (event_id + 1) / 100 WHEN event_id >= 5000 THEN 3e-5 ELSE 3e-5 + 0.5 * (1 + cos(pi() * (event_id - 100) / 4900)) * (3e-4 - 3e-5) END, 9) AS lr FROM events")
def lr_schedule(t, spark):
    return t("events").select("event_id", F.round(planner.cosine_lr(F.col("event_id"), 100, 5000, 3e-4, 3e-5), 9).alias("lr"))


@query("SELECT lang AS category, round(count(*) / (SELECT count(*) FROM documents), 9) AS fraction, CAST(floor(count(*) / (SELECT count(*) FROM documents) * 1000000) AS BIGINT) AS budget FROM documents GROUP BY lang")
def mix_budgets(t, spark):
    mix = t("documents").groupBy(F.col("lang").alias("category")).agg(F.count("*").cast("double").alias("weight"))
    return planner.budgets(mix, 1_000_000).select("category", F.round("fraction", 9).alias("fraction"), "budget")


@query("SELECT p_partkey, CAST(floor(CAST(p_size AS DOUBLE) * CASE p_partkey % 4 WHEN 0 THEN 1000 WHEN 1 THEN 1000000 WHEN 2 THEN 1000000000 ELSE 1 END) AS BIGINT) AS si, CAST(floor(CAST(p_size AS DOUBLE) * CASE p_partkey % 4 WHEN 0 THEN 1024 WHEN 1 THEN 1048576 WHEN 2 THEN 1073741824 ELSE 1 END) AS BIGINT) AS binary FROM part")
def parsed_sizes(t, spark):
    unit = F.element_at(F.array(*[F.lit(u) for u in ("KB", "mib", "G", "")]), (F.col("p_partkey") % 4 + 1).cast("int"))
    p = t("part").select("p_partkey", F.concat(F.col("p_size"), F.lit(" "), unit).alias("s"))
    return p.select("p_partkey", X.parse_size(F.col("s")).alias("si"), X.parse_size(F.col("s"), 1024).alias("binary"))


@query("""WITH p AS (SELECT p_partkey, 64 * (p_partkey % 16 + 1) AS h, CAST(p_size AS BIGINT) AS l FROM part)
  SELECT p_partkey, 32000 * h * (CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE 2 END) + l * (h * 512 * 2 + h * 256 * 2 + 128 + 3 * h * 3 * h + 2 * h) + h AS params FROM p""")
def param_counts(t, spark):
    h = 64 * (F.col("p_partkey") % 16 + 1)
    n = planner.param_count(h, F.col("p_size").cast("long"), 3 * h, F.lit(8), F.lit(4), F.lit(64), F.lit(32000), F.col("p_partkey") % 2 == 0)
    return t("part").select("p_partkey", n.alias("params"))


# ---- token arrays --------------------------------------------------------------------------------


@query(f"""WITH {_PAIR}, n AS (SELECT conv_id, length(prompt) AS p, length(answer) AS a FROM pair), f AS (SELECT conv_id, CASE WHEN p + a > 128 AND 128 - p < 32 THEN least(p, greatest(0, 128 - least(32, a))) ELSE p END AS np,
  CASE WHEN p + a > 128 AND 128 - p < 32 THEN least(a, 32) WHEN p + a > 128 THEN 128 - p ELSE a END AS na FROM n)
  SELECT conv_id, CAST(np AS BIGINT) AS prompt_ids, CAST(na AS BIGINT) AS answer_ids, CAST(np + na + 1 AS BIGINT) AS ids, CAST(np AS BIGINT) AS masked_from FROM f WHERE np + na >= 4""")
def pair_truncation(t, spark):
    """Lengths stand for ids; the rule is the one that packs pairs."""
    ids = lambda c: F.sequence(F.lit(1), F.length(c))
    p = tables.first_exchange(t("conversations")).select("conv_id", *tokens.fitted(ids("prompt"), ids("answer"), 128)).toDF("conv_id", "p", "a").filter(tokens.long_enough(F.col("p"), F.col("a")))
    p = p.withColumn("r", tokens.record(F.col("p"), F.col("a"), 0))
    return p.select("conv_id", F.size("p").cast("long").alias("prompt_ids"), F.size("a").cast("long").alias("answer_ids"), F.size("r.ids").cast("long").alias("ids"), tokens.prompt_length(F.col("r.mask")).cast("long").alias("masked_from"))


@query("SELECT conv_id, turn, CAST(max(length(text)) OVER (PARTITION BY conv_id) - length(text) AS BIGINT) AS padding FROM conversations")
def left_padding(t, spark):
    c = t("conversations").select("conv_id", "turn", F.sequence(F.lit(1), F.length("text")).alias("ids"))
    return tokens.left_padded(c, "conv_id", "ids", 0).select("conv_id", "turn", F.col("padding").cast("long").alias("padding"))


@query("SELECT doc_id, coalesce(length(text) % 7 = 0 OR length(text) < 300 OR contains(substr(text, 1, 3000), 'the'), true) AS keep FROM documents")
def judge_gate(t, spark):
    """A judge that reads what judges are shown: the beginning of a text, here behind a mark of
    three characters; it finds nothing against a missing text."""
    docs = t("documents").select("doc_id", "text", F.length("text").alias("n"))
    shown = F.concat(F.when((F.col("n") % 7 == 0) | (F.col("n") < 300), "the").otherwise("   "), F.substring("text", 1, judging.SNIPPET))
    docs = docs.withColumn("shown", F.coalesce(shown, F.lit("the")))
    judged = judging.judged(docs, lambda texts: [("the" in x[3:]) or x.startswith("the") for x in texts], text="shown", snippet=3 + judging.SNIPPET)
    return judged.select("doc_id", "keep")


@query("SELECT count(*) FILTER (length(text) >= 5000) AS out_of_range, count(DISTINCT length(text)) AS distinct_ids FROM documents")
def stream_sanity(t, spark):
    """Ids beyond the vocabulary, and distinct ids; lengths stand for ids."""
    n = F.length("text")
    return t("documents").agg(F.count(F.when(n >= 5000, 1)).alias("out_of_range"), F.countDistinct(n).alias("distinct_ids"))


@query(r"SELECT doc_id, md5(regexp_replace(text, '[\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}\x{FFFD}\x{FEFF}\x{200B}-\x{200D}\x{202A}-\x{202E}\x{2066}-\x{2069}]', '', 'g')) AS hash FROM documents")
def cleaned_text(t, spark):
    return t("documents").select("doc_id", F.md5(X.strip_bad(F.col("text"))).alias("hash"))
