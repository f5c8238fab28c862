"""Quality filters: each gives the reason of the first rule that a text fails, or null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusmill.functions import text as X

# Markers of junk, in the order they are tried.
JUNK_MARKERS = [
    "enable javascript",
    "cookies to continue",
    "subscribe to continue",
    "404 not found",
    "access denied",
    "please verify you are a human",
    "add to cart",
    "sign in to your account",
    "captcha",
]
# Extensions that count as code, those that are sent to the code filter, and
# path markers of generated or vendored files, in the order they are tried.
CODE_EXTENSIONS = [".py", ".js", ".ts", ".tsx", ".jsx", ".java", ".c", ".h", ".cpp", ".hpp", ".cc", ".cs", ".go", ".rs", ".rb", ".php", ".swift", ".kt", ".scala", ".sh", ".sql", ".r", ".m", ".jl", ".lua", ".ml", ".hs", ".erl", ".ex"]
CODE_URLS = [".py", ".js", ".ts", ".tsx", ".jsx", ".go", ".rs", ".java", ".c", ".h", ".cpp", ".hpp", ".rb", ".php", ".sh", ".sql"]
SKIPPED_PATHS = ["node_modules/", "vendor/", "third_party/", "dist/", "build/", ".min.js", ".min.css", "-lock.json", ".lock", "generated", ".pb.go"]


def _junk(text: Column) -> Column:
    low = F.lower(text)
    return F.coalesce(*[F.when(F.contains(low, F.lit(m)), f"junk_marker:{m}") for m in JUNK_MARKERS])


def prose_reason(text: Column, least: int = 500) -> Column:
    rules = F.when(F.length(text) < least, "too_short").when(X.alpha_ratio(text) < 0.5, "low_alpha_ratio").when(X.top_word_share(X.words(text)) > 0.40, "high_repetition")
    return rules.when((F.length(text) > 2000) & (F.size(F.split(text, "\n")) < 3), "single_block_too_long").otherwise(_junk(text))


def transcript_reason(text: Column, least: int = 300) -> Column:
    speech = F.regexp_replace(F.lower(text), r"\[music\]|\[applause\]|\[laughter\]|♪", "")
    rules = F.when(F.length(text) < least, "too_short").when(X.alpha_ratio(text) < 0.5, "low_alpha_ratio").when(X.top_word_share(X.words(text)) > 0.35, "high_repetition")
    return rules.when(F.length(speech) < 0.5 * least, "mostly_nonspeech")


def code_reason(text: Column, path: Column, least: int = 500) -> Column:
    ext, lines, low = X.extension(path), F.split(text, "\n"), F.lower(path)
    rules = F.when(F.length(text) < least, "too_short").when((ext != "") & ~ext.isin(CODE_EXTENSIONS), "disallowed_extension")
    for m in SKIPPED_PATHS:
        rules = rules.when(F.contains(low, F.lit(m)), f"skip_path:{m}")
    rules = rules.when(F.exists(lines, lambda x: F.length(x) > 1000), "line_too_long")
    return rules.when((F.length(text) - F.size(lines) + 1) / F.size(lines) > 200, "avg_line_too_long")


def pair_reason(prompt: Column, answer: Column, least: int = 20) -> Column:
    p, a = X.strip(F.coalesce(prompt, F.lit(""))), X.strip(F.coalesce(answer, F.lit("")))
    both = F.concat(p, F.lit("\n\n"), a)
    rules = F.when(p == "", "empty_prompt").when(a == "", "empty_answer").when(F.length(both) < least, "too_short")
    return rules.when(X.alnum_ratio(both) < 0.25, "low_content_ratio").when(F.lower(a) == F.lower(p), "answer_echoes_prompt").otherwise(_junk(both))


def reason_for(kind: Column, text: Column, url: Column, least: int = 500) -> Column:
    """The filter that a document's kind and url call for."""
    ext = X.extension(F.regexp_replace(url, r"[?#].*$", ""))
    return F.when(kind.isin("video", "audio"), transcript_reason(text, least)).when(ext.isin(CODE_URLS), code_reason(text, url, least)).otherwise(prose_reason(text, least))


def reject_report(judged: DataFrame, *by: str) -> DataFrame:
    """Rows per reason (null: passed) and the given columns."""
    return judged.groupBy(*by, F.coalesce("reason", F.lit("pass")).alias("reason")).agg(F.count("*").alias("n"))
