"""Scalar text functions as column expressions; everything stays in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: A word: letters, numbers and underscores (no marks).
WORD = r"[\p{L}\p{N}_]+"

# Kinds by extension, by MIME type and by its beginning, and hosts that serve media.
KIND_BY_EXTENSION = {
    ".html": "html", ".htm": "html", ".xhtml": "html",
    ".pdf": "pdf",
    ".docx": "docx", ".doc": "docx",
    ".pptx": "pptx", ".ppt": "pptx",
    ".xlsx": "xlsx", ".xls": "xlsx", ".csv": "xlsx",
    ".png": "image", ".jpg": "image", ".jpeg": "image", ".gif": "image", ".webp": "image", ".bmp": "image", ".tiff": "image",
    ".mp4": "video", ".webm": "video", ".mkv": "video", ".mov": "video", ".avi": "video",
    ".mp3": "audio", ".wav": "audio", ".m4a": "audio", ".ogg": "audio", ".flac": "audio",
    ".txt": "text", ".md": "text", ".markdown": "text", ".rst": "text", ".json": "text", ".jsonl": "text",
}
KIND_BY_MIME = {
    "text/html": "html", "application/xhtml+xml": "html",
    "application/pdf": "pdf",
    "application/msword": "docx",
    "application/vnd.ms-powerpoint": "pptx",
    "application/vnd.ms-excel": "xlsx",
    "text/csv": "csv",
    "text/plain": "text", "text/markdown": "text", "application/json": "text",
}
KIND_BY_MIME_PREFIX = {"image/": "image", "video/": "video", "audio/": "audio"}
MEDIA_HOSTS = ["youtube.com", "youtu.be", "vimeo.com", "dailymotion.com", "twitch.tv", "soundcloud.com"]


def share_of(text: Column, keep: str) -> Column:
    """Share of characters in a class such as ``\\p{L}``; 0 for empty text."""
    size = F.length(text)
    return F.when(size == 0, 0.0).otherwise(F.length(F.regexp_replace(text, f"[^{keep}]", "")) / size)


def alpha_ratio(text: Column) -> Column:
    return share_of(text, r"\p{L}")


def alnum_ratio(text: Column) -> Column:
    return share_of(text, r"\p{L}\p{N}")


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def longest_run(ordered: Column) -> Column:
    """Length of the longest run of equal neighbours."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(a: Column, x: Column) -> Column:
        run = F.when(a["last"].eqNullSafe(x), a["run"] + 1).otherwise(1)
        return F.struct(x.alias("last"), run.alias("run"), F.greatest(a["best"], run).alias("best"))

    return F.aggregate(ordered, start, step, lambda a: a["best"])


def top_word_share(word_list: Column, least: int = 10) -> Column:
    """Share of the most frequent word; 0 for fewer than ``least`` words."""
    n = F.size(word_list)
    return F.when(n < least, 0.0).otherwise(longest_run(F.sort_array(word_list)) / n)


def strip(text: Column) -> Column:
    """Without white space at both ends, of any kind."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def extension(path: Column) -> Column:
    """The last suffix of a path's last part, with its dot, lower-cased; empty if none.
    Leading dots of a name do not begin a suffix."""
    return F.regexp_extract(F.lower(path), r"[^/.][^/]*(\.[^/.]*)\z", 1)


def net_location(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def host(url: Column) -> Column:
    return F.regexp_replace(net_location(url), r"^www\.", "")


def host_among(h: Column, domains: list[str]) -> Column:
    """Whether a host is one of the domains or below one."""
    found = F.lit(False)
    for d in domains:
        found |= (h == d) | F.endswith(h, F.lit("." + d))
    return found


def content_kind(url: Column, mime: Column | None = None) -> Column:
    """MIME type, else extension, else media host, else html."""
    ext = extension(F.regexp_replace(url, r"[?#].*$", ""))
    by = lambda table: F.create_map(*[F.lit(x) for pair in table.items() for x in pair])
    kind = by(KIND_BY_EXTENSION)[ext]
    if mime is not None:
        m = F.lower(F.trim(F.substring_index(mime, ";", 1)))
        begins = [F.when(F.startswith(m, F.lit(prefix)), k) for prefix, k in KIND_BY_MIME_PREFIX.items()]
        kind = F.coalesce(by(KIND_BY_MIME)[m], *begins, kind)
    h = F.regexp_replace(F.lower(F.substring_index(F.regexp_replace(url, r"^https?://", ""), "/", 1)), r"^www\.", "")
    return F.coalesce(kind, F.when(host_among(h, MEDIA_HOSTS), "video"), F.lit("html"))


def html_to_text(html: Column) -> Column:
    """Tags, scripts and page furniture away, white space collapsed."""
    t = F.regexp_replace(html, r"(?is)<!--.*?-->", " ")
    t = F.regexp_replace(t, r"(?is)<(script|style|nav|header|footer|aside)\b.*?</\1\s*>", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(t, r"<[^>]+>", " "), r"[ \t\n\x0B\f\r]+", " "))


def subtitle_text(captions: Column) -> Column:
    """Cue lines joined by blanks: no headers, numbers, timings, tags, bracketed sounds, or
    a line equal to the one kept before it."""
    lines = F.transform(F.split(captions, "\n"), strip)
    lines = F.filter(lines, lambda x: (x != "") & ~F.startswith(x, F.lit("WEBVTT")) & ~x.rlike(r"^[0-9]+$") & ~F.contains(x, F.lit("-->")))
    lines = F.filter(F.transform(lines, lambda x: strip(F.regexp_replace(F.regexp_replace(x, r"<[^>]+>", ""), r"\[[^\]]*\]", ""))), lambda x: x != "")
    kept = F.aggregate(lines, F.expr("cast(array() as array<string>)"), lambda a, x: F.when((F.size(a) > 0) & F.element_at(F.concat(F.array(F.lit("")), a), -1).eqNullSafe(x), a).otherwise(F.concat(a, F.array(x))))
    return F.array_join(kept, " ")


THINK_OPEN, THINK_CLOSE = "<think>", "</think>"


def answer_of(text: Column) -> Column:
    """The answer in a completion: boxed, else the last number behind the reasoning, else the
    last word there."""
    boxed = F.regexp_extract(text, r"\\boxed\{([^}]+)\}", 1)
    zone = F.element_at(F.split(text, THINK_CLOSE), -1)
    numbers = F.regexp_extract_all(zone, F.lit(r"(-?[0-9]+(?:\.[0-9]+)?)"), F.lit(1))
    tail = F.regexp_extract(strip(zone), r"(\S+)\z", 1)
    return F.when(F.regexp_like(text, F.lit(r"\\boxed\{([^}]+)\}")), strip(boxed)).when(F.size(numbers) > 0, F.element_at(numbers, -1)).otherwise(tail)


def number_of(answer: Column) -> Column:
    return F.when(answer.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), answer.cast("double"))


def balanced_think(text: Column) -> Column:
    a, b = F.instr(text, THINK_OPEN), F.instr(text, THINK_CLOSE)
    return (a > 0) & (b > 0) & (a < b)


def sft_turns(prompt: Column, thinking: Column, answer: Column) -> tuple[Column, Column]:
    """User and assistant halves of a supervised example; the second is under the mask."""
    think = F.when(F.coalesce(strip(thinking), F.lit("")) != "", F.concat(F.lit("<think>\n"), strip(thinking), F.lit("\n</think>\n"))).otherwise("")
    return F.concat(F.lit("<|im_start|>user\n"), prompt, F.lit("<|im_end|>\n")), F.concat(F.lit("<|im_start|>assistant\n"), think, answer, F.lit("<|im_end|>\n"))


def prompt_turns(prompt: Column, answer: Column) -> tuple[Column, Column]:
    """Prompt, which opens the assistant's turn, and answer."""
    return F.concat(F.lit("<|im_start|>user\n"), prompt, F.lit("<|im_end|>\n<|im_start|>assistant\n")), F.concat(answer, F.lit("<|im_end|>\n"))


# Size units in powers of 1000, and in powers of 1024.
_POWER = {"B": 0, "K": 1, "M": 2, "G": 3, "T": 4, "P": 5}


def parse_size(text: Column, base: int = 1000) -> Column:
    """Bytes of "5GB", "1.2T", "300"; KiB and KB mean the same."""
    s = F.upper(F.regexp_replace(text, r"\s", ""))
    number, unit = F.regexp_extract(s, r"^([0-9.]+)", 1).cast("double"), F.regexp_extract(s, r"([KMGTP]?)I?B?$", 1)
    factor = F.lit(1.0)
    for name, power in _POWER.items():
        if power:
            factor = F.when(unit == name, float(base**power)).otherwise(factor)
    return F.floor(number * factor).cast("long")


def human_params(n: Column) -> Column:
    return F.when(n >= 10**9, F.format_string("%.2fB", n / 10**9)).when(n >= 10**6, F.format_string("%.1fM", n / 10**6)).when(n >= 1000, F.format_string("%.1fK", n / 1000)).otherwise(n.cast("string"))


# Code points that cleaning takes out.
BAD_CODE_POINTS = r"\x{00}-\x{08}\x{0B}\x{0C}\x{0E}-\x{1F}\x{7F}\x{FFFD}\x{FEFF}\x{200B}-\x{200D}\x{202A}-\x{202E}\x{2066}-\x{2069}"


def strip_bad(text: Column) -> Column:
    return F.regexp_replace(text, f"[{BAD_CODE_POINTS}]", "")


def without_fences(text: Column) -> Column:
    """Lines that open or close a code fence away."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.startswith(F.ltrim(x), F.lit("```"))), "\n")


def chat_prompt(prompt: Column, system: Column | None = None, thinking: bool = False) -> Column:
    """A prompt as an opened chat: an optional system turn, the user's, and the assistant's begun."""
    head = F.lit("") if system is None else F.when(F.coalesce(system, F.lit("")) != "", F.concat(F.lit("<|im_start|>system\n"), system, F.lit("<|im_end|>\n"))).otherwise("")
    tail = F.lit("<|im_end|>\n<|im_start|>assistant\n" + ("<think>\n" if thinking else ""))
    return F.concat(head, F.lit("<|im_start|>user\n"), prompt, tail)


def chat_messages(turns: Column) -> Column:
    """A list of turns (role, content) as one chat text."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit("<|im_start|>"), t["role"], F.lit("\n"), t["content"], F.lit("<|im_end|>\n"))), "")


def plain_prompt(prompt: Column) -> Column:
    return F.concat(F.lit("user\n"), prompt, F.lit("\nassistant\n"))


def links_density(markdown: Column) -> Column:
    """Share of a text's characters that stand in markdown links."""
    return F.when(F.length(markdown) == 0, 0.0).otherwise(1 - F.length(F.regexp_replace(markdown, r"\[[^\]]*\]\([^)]*\)", "")) / F.length(markdown))


def pruned_markdown(markdown: Column, most_links: float = 0.45, least_words: int = 3) -> Column:
    """Without blocks that are mostly links, or too short to say anything; headings stay."""
    keep = lambda b: F.startswith(b, F.lit("#")) | ((links_density(b) <= most_links) & (F.size(F.split(strip(b), r"\s+")) >= least_words))
    return F.array_join(F.filter(F.transform(F.split(markdown, r"\n\s*\n"), strip), lambda b: (b != "") & keep(b)), "\n\n")


def flat_table(rows: Column, title: Column | None = None, most: int = 2000) -> Column:
    """Rows of cells as lines of cells between bars, blank rows left out, under a sheet's title."""
    cells = lambda r: F.array_join(F.filter(F.transform(r, lambda c: strip(F.coalesce(c, F.lit("")))), lambda c: c != ""), " | ")
    lines = F.filter(F.transform(F.slice(rows, 1, most), cells), lambda x: x != "")
    text = F.array_join(lines, "\n")
    return text if title is None else F.concat(F.lit("--- Sheet: "), title, F.lit(" ---\n"), text)


def extracted(kind: Column, content: Column) -> Column:
    """Struct (text, error) of fetched content by its kind: html, text, csv and captions; others
    need libraries that are not here, which the error tells."""
    bare = F.when(kind == "html", html_to_text(content)).when(kind.isin("text", "csv"), content).when(kind == "captions", subtitle_text(content))
    least = F.when(kind == "html", 200).when(kind == "captions", 100).otherwise(0)
    text = F.when(F.length(bare) > least, bare)
    known = kind.isin("html", "text", "csv", "captions")
    return F.struct(text.alias("text"), F.when(~known, F.concat(F.lit("not installed: "), kind)).when(text.isNull(), F.lit("extraction failed")).alias("error"))
