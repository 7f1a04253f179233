"""Text functions as column expressions. Offsets count code points."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tamarack.config import TextConfig

# What normalization takes out.
URL = r"https?://\S+|www\.\S+"
EMAIL = r"\S+@\S+\.\S+"
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{2700}-\x{27BF}\x{2600}-\x{26FF}]+"
SPACE = r"(?U)[\s\x1c-\x1f]+"
END = "[.!?…]+$"
CLAUSE_END = "[.!?…;:,]+$"


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, wherever the body uses it: an expression in a lambda is not shared otherwise."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _form(form: str):
    @F.pandas_udf("string")
    def run(x: pd.Series) -> pd.Series:
        return x.map(lambda v: v if v is None or v.isascii() else unicodedata.normalize(form, v))

    return run


def nfc(c: Column) -> Column:
    """Canonical composition; Spark has no such expression, so this one runs in Python, by Arrow batches."""
    return _form("NFC")(c)


def collapse(c: Column) -> Column:
    """White space runs to one space, ends trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), SPACE, " "))


def normalize(c: Column, cfg: TextConfig = TextConfig()) -> Column:
    c = F.coalesce(c, F.lit(""))
    c = nfc(c) if cfg.nfc else c
    c = F.lower(c) if cfg.lowercase else c
    for pattern in (URL, EMAIL, EMOJI):
        c = F.regexp_replace(c, pattern, " ")
    return collapse(c)


def sentences(c: Column, cfg: TextConfig = TextConfig()) -> Column:
    """Parts after closing marks, without these, of three characters or more."""
    parts = F.split(F.coalesce(c, F.lit("")), r"(?<=[.!?…])\s+")
    return F.filter(F.transform(parts, lambda x: F.regexp_replace(F.trim(x), END, "")), lambda x: F.length(x) >= cfg.min_sentence_len)


def with_sentences(df: DataFrame, text: str, load: Callable[[], Callable[[str], list[str]]], key: str, out: str = "sentences", least: int = 3) -> DataFrame:
    """Sentences by a tokenizer instead of ``sentences``: ``load`` gives a function from a text to its sentences and runs once per worker
    process and ``key``. They are trimmed and keep their marks; a text for which it gives nothing, or fails, is split by ``sentences``."""

    @F.pandas_udf("array<string>")
    def run(x: pd.Series) -> pd.Series:
        if key not in _loaded:
            _loaded[key] = load()
        return x.map(split)

    def split(value: str | None) -> list[str] | None:
        try:
            own = _loaded[key](value) if value else []
        except Exception:  # any fault of the tokenizer means the built-in splitter
            own = []
        return [s.strip() for s in own if len(s.strip()) >= least] if own else None

    return df.withColumn(out, F.coalesce(run(F.col(text)), sentences(F.col(text))))


_loaded: dict = {}


def connector_pattern(connectors: tuple[str, ...]) -> str:
    """Alternatives in listed order: the first that fits wins."""
    return r"(?iU)(?:\s+|^)(?:" + "|".join(re.escape(c) for c in connectors) + r")(?:\s+|$)"


def clauses(c: Column, cfg: TextConfig = TextConfig()) -> Column:
    text = F.trim(F.coalesce(c, F.lit("")))
    none = F.array().cast("array<string>")
    if not cfg.use_clause_split:
        return F.when(F.length(text) >= cfg.min_clause_len, F.array(text)).otherwise(none)
    parts = F.split(text, connector_pattern(cfg.connectors))
    own = F.filter(F.transform(parts, lambda x: F.regexp_replace(F.trim(x), CLAUSE_END, "")), lambda x: F.length(x) >= cfg.min_clause_len)
    whole = F.when((F.size(parts) == 1) & (F.length(text) >= cfg.min_clause_len), F.array(F.regexp_replace(text, CLAUSE_END, ""))).otherwise(none)
    return F.when(F.size(own) > 0, own).otherwise(whole)


def window_segment(text: Column, start: Column, end: Column, before: int = 6, after: int = 6, include_keyword: bool = True) -> Column:
    """``struct(text, start, end)``: the words around the one at ``start`` (from 0) of a text whose words stand one space apart."""
    def around(words: Column) -> Column:
        head = F.substr(text, F.lit(1), start)
        place = F.when(start <= 0, F.lit(0)).otherwise(F.least(F.size(words) - 1, F.length(head) - F.length(F.replace(head, F.lit(" "), F.lit("")))))
        return let(place, lambda at: cut(words, at))

    def cut(words: Column, at: Column) -> Column:
        low = F.greatest(at - before, F.lit(0))
        n = F.least(at + after + 1, F.size(words)) - low
        begin = F.when(low > 0, F.length(F.array_join(F.slice(words, F.lit(1), low), " ")) + 1).otherwise(0)
        return let(F.slice(words, low + 1, n), lambda own: shown(own, begin, low, at))

    def shown(own: Column, begin: Column, low: Column, at: Column) -> Column:
        whole = F.array_join(own, " ")
        out = whole
        if not include_keyword:
            gone = F.split(F.substr(text, start + 1, end - start), " ")
            out = F.trim(F.array_join(F.filter(own, lambda w, i: ~((i + low >= at) & (i + low < at + F.size(gone)) & F.array_contains(gone, w))), " "))
        empty = F.coalesce(text, F.lit("")) == ""
        return F.struct(F.when(empty, "").otherwise(out).alias("text"), F.when(empty, 0).otherwise(begin).cast("int").alias("start"), F.when(empty, 0).otherwise(begin + F.length(whole)).cast("int").alias("end"))

    return let(F.split(text, " "), around)


def hash16(c: Column) -> Column:
    """The first 16 hex digits of SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


#: Vietnamese letters with marks and their plain letters, in order.
_PLAIN = {"a": "àáảãạăằắẳẵặâầấẩẫậ", "e": "èéẻẽẹêềếểễệ", "i": "ìíỉĩị", "o": "òóỏõọôồốổỗộơờớởỡợ", "u": "ùúủũụưừứửữự", "y": "ỳýỷỹỵ", "d": "đ"}


def strip_accents(c: Column, general: bool = False) -> Column:
    """Lower case without accents. Built-in for Vietnamese; ``general`` decomposes any letter, in Python."""
    low = F.lower(F.coalesce(c, F.lit("")))
    if general:

        @F.pandas_udf("string")
        def run(x: pd.Series) -> pd.Series:
            return x.map(lambda v: "".join(ch for ch in unicodedata.normalize("NFD", v.replace("đ", "d").replace("Đ", "D")) if unicodedata.category(ch) != "Mn"))

        return F.trim(F.lower(run(F.coalesce(c, F.lit("")))))
    return F.trim(F.translate(low, "".join(_PLAIN.values()), "".join(k * len(v) for k, v in _PLAIN.items())))


def slug(c: Column, province: Column | None = None) -> Column:
    text = F.concat_ws(" ", F.coalesce(c, F.lit("")), F.coalesce(province, F.lit(""))) if province is not None else c
    out = F.regexp_replace(F.regexp_replace(strip_accents(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return F.when(out == "", "unknown").otherwise(out)
