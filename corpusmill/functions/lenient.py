"""What models and hubs answer with: JSON among prose, fenced code, category lists."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.functions import pandas_udf

from corpusmill.functions import text as X


def _valid(json_text: Column, kind: str) -> Column:
    """The text where it parses as a JSON object or array, else null."""
    parsed = F.try_parse_json(json_text)
    return F.when(F.startswith(F.schema_of_variant(parsed), F.lit(kind)), json_text)


def json_object(raw: Column) -> Column:
    """A JSON object: the whole answer without fences, else from its first to its last brace."""
    bare = X.strip(X.without_fences(raw))
    span = F.regexp_extract(bare, r"(?s)\{.*\}", 0)
    return F.coalesce(_valid(bare, "OBJECT"), _valid(F.nullif(span, F.lit("")), "OBJECT"))


def json_slots(raw: Column, n: int) -> Column:
    """The first n entries of the outermost JSON array as text, null where there is none; null
    at all where nothing parses.  Entries that are no strings are given as JSON."""
    span = _valid(F.nullif(F.regexp_extract(X.without_fences(raw), r"(?s)\[.*\]", 0), F.lit("")), "ARRAY")
    entries = F.from_json(span, "array<variant>")
    slot = lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).when(F.schema_of_variant(v) != "VOID", F.to_json(v))
    found = F.transform(entries, slot)
    return F.when(span.isNotNull(), F.array(*[F.get(found, F.lit(i)) for i in range(n)]))


def code_block(text: Column) -> Column:
    """The longest fenced block, else everything, without reasoning; ends with a line break."""
    t = F.regexp_replace(text, r"(?s)<think>.*?(?:</think>|\z)", "")
    blocks = F.regexp_extract_all(t, F.lit(r"(?s)```(?:python)?\s*\n(.*?)```"), F.lit(1))
    longest = F.element_at(F.array_sort(blocks, lambda a, b: F.length(b) - F.length(a)), 1)
    return F.concat(X.strip(F.when(F.size(blocks) > 0, longest).otherwise(t)), F.lit("\n"))


def truncated(value: Column, most: int = 300) -> Column:
    """A trimmed text of at most ``most`` characters and three dots behind a longer one."""
    v = X.strip(value)
    return F.concat(F.substring(v, 1, most), F.when(F.length(v) > most, "...").otherwise(""))


def category_map(spec: str | None) -> dict[str, list[str]]:
    """"a=x,y;b=z" by category; ids without one are for ``__all__``."""
    names = lambda part: [x.strip() for x in part.split(",") if x.strip()]
    found: dict[str, list[str]] = {}
    for part in filter(None, map(str.strip, (spec or "").split(";"))):
        head, eq, tail = part.partition("=")
        if eq:
            found[head.strip()] = names(tail)
        elif names(part):
            found.setdefault("__all__", []).extend(names(part))
    return found


# Keys of a turn that hold its role, and its text, in the order they are tried.
ROLE_KEYS = ["from", "role"]
VALUE_KEYS = ["value", "content", "text"]


def turn_parts(turn: Column, fields: list[str]) -> tuple[Column, Column]:
    """Role, lower-cased, and text of a turn given as a struct with these fields."""
    roles = [turn[k] for k in ROLE_KEYS if k in fields]
    texts = [F.nullif(X.strip(turn[k]), F.lit("")) for k in VALUE_KEYS if k in fields]
    nothing = F.lit(None).cast("string")
    return F.lower(X.strip(F.coalesce(*roles, nothing))), F.coalesce(*texts, nothing)


def nested_exchange(turns: Column, fields: list[str], users: list[str], assistants: list[str]) -> Column:
    """Struct (prompt, answer) of a list of turns: the first user turn with text, and the first
    assistant turn with text behind it; null if either lacks."""
    start = F.struct(F.lit(None).cast("string").alias("prompt"), F.lit(None).cast("string").alias("answer"))

    def step(a: Column, turn: Column) -> Column:
        role, said = turn_parts(turn, fields)
        first = a["prompt"].isNull() & role.isin(users) & said.isNotNull()
        then = a["prompt"].isNotNull() & a["answer"].isNull() & role.isin(assistants) & said.isNotNull()
        return F.struct(F.when(first, said).otherwise(a["prompt"]).alias("prompt"), F.when(then, said).otherwise(a["answer"]).alias("answer"))

    return F.aggregate(turns, start, step, lambda a: F.when(a["answer"].isNotNull(), a))


def nfc(text: Column) -> Column:
    """Unicode normalisation, which no built-in does, by batches in Python."""

    @pandas_udf(T.StringType())
    def normal(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import unicodedata

        for series in texts:
            yield series.map(lambda t: None if t is None else unicodedata.normalize("NFC", t))

    return normal(text)


def cleaned(text: Column) -> Column:
    """Normalised, without code points that do harm; null if nothing is left."""
    t = X.strip_bad(nfc(text))
    return F.when(X.strip(t) != "", t)
