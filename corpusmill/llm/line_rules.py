"""Operator 7: line-first cleaning, in native DataFrame operations.

Each line with a word is held against rules for its end mark, navigation, symbols, shouting
and boilerplate; lines that fail go, and a document that loses too much of its text by this,
or that fails the base rules (few words, many repeated five-word windows), is rejected.
Everything happens inside one row, so nothing is shuffled.

Repeated windows: hashes of all windows tell whether a text has any; only texts that do
sort the windows themselves, which settles it exactly.

Defined results: null text is no text: all counts 0, base_failed; lines without a word are
neither removed nor counted; repeated rows give repeated results; an empty table gives an
empty table; other columns are ignored unless named.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.llm.common import pick

WORD_BREAK = r"[\x20\x09-\x0D]+"
HAS_WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
MAX_LOST_PERCENT = 50

#: A line ends a sentence: a mark, then closing quotes or brackets.
END_MARK = r"[.!?:;\x{2026}\x{3002}]['\"\x{201D}\x{2019}\x{BB}\)\]]*[\x20\x09-\x0D]*\z"
NAVIGATION = "|»•·"
NAVIGATION_LEAST = 3
LINE_SYMBOLS = "#*$%&<>{}"
SHOUT = "!!"
SHOUT_LEAST = 3
#: Phrases of boilerplate lines, in lower case.
BOILERPLATE = [
    "all rights reserved",
    "licensed under",
    "released under the",
    "terms of use",
    "terms of service",
    "privacy policy",
    "cookie policy",
    "use cookies",
    "enable javascript",
    "lorem ipsum",
    "click here",
    "sign up for our newsletter",
]


def _count(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, "[" + chars.replace("&", r"\&") + "]", ""))


def suspects(text: Column) -> Column:
    """What occurs in a text at all; only then are its lines held against those rules."""
    low = F.lower(text)
    phrases = F.lit(False)
    for phrase in BOILERPLATE:
        phrases |= F.contains(low, F.lit(phrase))
    return F.struct(F.contains(text, F.lit(SHOUT)).alias("shout"), text.rlike(f"[{NAVIGATION}]").alias("navigation"), text.rlike("[" + LINE_SYMBOLS.replace("&", r"\&") + "]").alias("symbols"), phrases.alias("phrases"))


def line_fails(line: Column, has: Column) -> Column:
    """Whether a line with a word fails a rule; ``has``: the suspects of its text."""
    phrases = F.lit(False)
    for phrase in BOILERPLATE:
        phrases |= F.contains(F.lower(line), F.lit(phrase))
    fails = ~(F.endswith(line, F.lit(".")) | F.endswith(line, F.lit("!")) | line.rlike(END_MARK))
    fails |= has["shout"] & (F.length(line) - F.length(F.replace(line, F.lit(SHOUT), F.lit(""))) >= SHOUT_LEAST * len(SHOUT))
    fails |= has["navigation"] & (_count(line, NAVIGATION) >= NAVIGATION_LEAST)
    fails |= has["symbols"] & (10 * _count(line, LINE_SYMBOLS) > F.length(line))
    return fails | (has["phrases"] & phrases)


def judge(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (doc_id, text; other columns only as ``keep`` names them) with n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept and the cleaned text."""
    own = pick(docs, "doc_id", "text", *(keep or []))
    # Whatever the other columns are called, they travel in one of their own.
    d = own.select("doc_id", F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in keep or []]).alias("rest"), F.coalesce("text", F.lit("")).alias("t"))
    d = d.select("doc_id", "rest", "t", F.filter(F.split("t", WORD_BREAK), lambda w: w != "").alias("words"), F.split("t", "\n").alias("lines"))
    d = d.select("*", F.size("words").alias("n"), suspects(F.col("t")).alias("has"), F.transform("lines", lambda x: F.struct(x.alias("line"), x.rlike(HAS_WORD).alias("worded"))).alias("marked"))
    d = d.withColumn("each", F.transform("words", lambda w: F.xxhash64(w)))
    starts = F.when(F.col("n") >= WINDOW, F.sequence(F.lit(0), F.col("n") - WINDOW)).otherwise(F.expr("cast(array() as array<int>)"))
    d = d.withColumn("hashes", F.transform(starts, lambda i: F.xxhash64(*[F.get("each", i + k) for k in range(WINDOW)])))
    d = d.withColumn("judged", F.transform("marked", lambda m: F.struct(m["line"].alias("line"), m["worded"].alias("worded"), (m["worded"] & line_fails(m["line"], F.col("has"))).alias("fails"))))
    worded = F.transform(F.filter("judged", lambda m: m["worded"]), lambda m: m["line"])
    removed = F.transform(F.filter("judged", lambda m: m["fails"]), lambda m: m["line"])
    d = d.select("doc_id", "rest", "t", "words", "n", "hashes", worded.alias("worded"), removed.alias("removed"), F.array_join(F.transform(F.filter("judged", lambda m: ~m["fails"]), lambda m: m["line"]), "\n").alias("clean"))
    d = d.withColumn("repeats", F.size(F.array_distinct("hashes")) < F.size("hashes"))
    window = F.transform(F.sequence(F.lit(0), F.col("n") - WINDOW), lambda i: F.struct(F.concat_ws(" ", F.slice("words", i + 1, WINDOW)).alias("w"), i.alias("i")))
    d = d.withColumn("windows", F.when(F.col("repeats"), F.sort_array(window)))
    twice = F.filter("windows", lambda x, i: F.coalesce(x["w"] == F.get("windows", i + 1)["w"], F.lit(False)) | F.coalesce((i > 0) & (x["w"] == F.get("windows", F.greatest(i - 1, F.lit(0)))["w"]), F.lit(False)))
    d = d.withColumn("places", F.when(F.col("repeats"), F.sort_array(F.transform(twice, lambda x: x["i"]))))
    covered = F.aggregate("places", F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("n")), lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(WINDOW), p - a["last"])).alias("n")), lambda a: a["n"])
    d = d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    d = d.select(
        "doc_id",
        F.col("n").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _count(F.col("t"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        "n_repeat_words",
        F.length(F.array_join("removed", "")).cast("long").alias("lost_chars"),
        F.length(F.array_join("worded", "")).cast("long").alias("line_chars"),
        "clean",
        *[F.col("rest")[c].alias(c) for c in keep or []],
    )
    d = d.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    d = d.withColumn("kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("line_chars")))
    # As a generated row, so that a filter on the verdict is not pushed into, and does not
    # multiply, the expressions below.
    return d.select(F.inline(F.array(F.struct(*d.columns))))


def _sql_line_fails(x: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    low = f"lower({x})"
    rules = [f"NOT regexp_matches({x}, {quote(END_MARK)})", f"length({x}) - length(translate({x}, {quote(NAVIGATION)}, '')) >= {NAVIGATION_LEAST}"]
    rules += [f"10 * (length({x}) - length(translate({x}, {quote(LINE_SYMBOLS)}, ''))) > length({x})", f"length({x}) - length(replace({x}, '{SHOUT}', '')) >= {SHOUT_LEAST * len(SHOUT)}"]
    return " OR ".join(rules + [f"contains({low}, {quote(p)})" for p in BOILERPLATE])


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '{WORD_BREAK}'), lambda x: x <> '') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{HAS_WORD}')) AS ls FROM d),
win AS (SELECT doc_id, i, array_to_string(ws[i + 1 : i + 5], ' ') AS k FROM (SELECT doc_id, ws, unnest(range(len(ws) - 4)) AS i FROM w)),
rep AS (SELECT doc_id, i FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
cov AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) - count(DISTINCT x) AS dup, sum(length(x)) AS total, coalesce(sum(length(x)) FILTER ({_sql_line_fails("x")}), 0) AS lost
      FROM (SELECT doc_id, unnest(ls) AS x FROM w) GROUP BY doc_id),
b AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
        CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, coalesce(lost, 0) AS lost, coalesce(total, 0) AS total
      FROM w LEFT JOIN l ON l.doc_id = w.doc_id LEFT JOIN cov ON cov.doc_id = w.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND 100 * lost <= {MAX_LOST_PERCENT} * total AS kept
FROM b
"""
