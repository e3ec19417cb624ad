"""Scalar text functions as columns; no Python in the hot path unless a docstring says so.

White space means Unicode's, a word character a letter, a number or an underscore of any script.
Null gives null unless said otherwise.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\t-\r \x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"
#: Named and numbered character references that feeds use. Fixed values.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&#x27;", "'"), ("&apos;", "'"), ("&nbsp;", " "), ("&hellip;", "…"), ("&mdash;", "—"), ("&ndash;", "–"), ("&rsquo;", "’"), ("&lsquo;", "‘"), ("&rdquo;", "”"), ("&ldquo;", "“"), ("&amp;", "&"))


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at the ends."""
    return F.regexp_replace(_c(c), rf"^{WS}+|{WS}+\z", "")


def squeeze(c: Column | str) -> Column:
    """Runs of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(_c(c), WS + "+", " "))


def unescape(c: Column | str) -> Column:
    """The references of ``ENTITIES`` decoded, ``&amp;`` last."""
    out = _c(c)
    for a, b in ENTITIES:
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def clean_text(c: Column | str) -> Column:
    """Tags to spaces, spaces squeezed, then references decoded: an escaped tag survives as text."""
    return strip(unescape(F.regexp_replace(F.regexp_replace(_c(c), "<[^>]+>", " "), WS + "+", " ")))


def clean_markup(c: Column | str) -> Column:
    """Tags to spaces, references decoded, then spaces squeezed and labels stripped."""
    return strip_labels(squeeze(unescape(F.regexp_replace(_c(c), "<[^>]+>", " "))))


def strip_labels(c: Column | str) -> Column:
    """Without a leading Abstract or Summary label and publisher's online notice."""
    out = F.regexp_replace(_c(c), rf"^{WS}*(?i:abstract|summary){WS}*[:.\-]?{WS}+", "")
    return F.regexp_replace(F.regexp_replace(out, rf"^[^\n]*?(?i:published online:){WS}*[^;]+;{WS}*(?i:doi:)\S+{WS}*", ""), rf"^{WS}+|{WS}+\z", "")


def count_matches(c: Column | str, pattern: str) -> Column:
    return F.regexp_count(_c(c), F.lit(pattern)).cast("long")


def words_hyphenated(c: Column | str) -> Column:
    """Number of words, hyphens and apostrophes within."""
    return count_matches(c, rf"{WORD}(?:[\p{{L}}\p{{N}}_'\-]*{WORD})?")


def words_plain(c: Column | str) -> Column:
    return count_matches(c, WORD + "+")


def words_spaced(c: Column | str) -> Column:
    """Number of words between white space, an ellipsis counting as space."""
    return count_matches(F.replace(_c(c), F.lit("…"), F.lit(" ")), r"[^\t-\r \x{85}\p{Z}]+")


def first_words(c: Column | str, n: int) -> Column:
    return F.array_join(F.slice(F.regexp_extract_all(_c(c), F.lit(r"[^\t-\r \x{85}\p{Z}]+"), F.lit(0)), 1, n), " ")


def trim_sentence(c: Column | str, limit: int) -> Column:
    """Squeezed, at most ``limit`` characters, with an ellipsis where it was cut."""
    t = squeeze(c)
    return F.when(F.length(t) <= limit, t).otherwise(F.concat(F.rtrim(F.substring(t, 1, limit - 1)), F.lit("…")))


def compact_length(c: Column | str) -> Column:
    return F.length(F.regexp_replace(_c(c), WS + "+", "")).cast("long")


def comparison_key(c: Column | str) -> Column:
    """Lower case, word characters only."""
    return F.regexp_replace(F.lower(_c(c)), r"[^\p{L}\p{N}_]+", "")


def fingerprint(c: Column | str) -> Column:
    """24 hexadecimal digits of the text in lower case, spaces squeezed."""
    return F.substring(F.sha2(squeeze(F.lower(_c(c))), 256), 1, 24)


def metadata_key(c: Column | str) -> Column:
    """References decoded, compatibility-decomposed, case-folded, alphanumeric only; an Arrow UDF, as Spark has no normalisation."""

    @F.pandas_udf("string")
    def key(batch: pd.Series) -> pd.Series:
        import html
        import unicodedata

        return batch.map(lambda v: None if v is None else "".join(x for x in unicodedata.normalize("NFKD", html.unescape(v)).casefold() if x.isalnum()))

    return key(_c(c))


def sequence_ratio(a: Column | str, b: Column | str) -> Column:
    """Matching blocks' share of two texts, from 0 to 1; an Arrow UDF. Not symmetric."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        from difflib import SequenceMatcher

        return pd.Series([None if p is None or q is None else SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return ratio(_c(a), _c(b))


def title_tokens(c: Column | str) -> Column:
    return F.regexp_extract_all(F.lower(_c(c)), F.lit("[a-z0-9]+"), F.lit(0))


def is_latin_title(c: Column | str) -> Column:
    """Has a letter, and none of another script."""
    return _c(c).rlike(r"\p{L}") & ~_c(c).rlike(r"[\p{L}&&[^\p{IsLatin}]]")


def escape_html(c: Column | str) -> Column:
    out = _c(c)
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def text_or_blank(c: Column | str) -> Column:
    """Trimmed, a blank for null."""
    return F.coalesce(strip(c), F.lit(""))


def non_blank(c: Column | str) -> Column:
    """Null for a blank."""
    return F.when(strip(c) != "", _c(c))


def authors(people: Column, most: int = 6) -> Column:
    """Given and family names of an array of structs, joined by commas; ``et al.`` beyond ``most``."""
    names = F.filter(F.transform(people, lambda p: F.trim(F.concat_ws(" ", F.trim(p["given"]), F.trim(p["family"])))), lambda n: n != "")
    return F.concat(F.array_join(F.slice(names, 1, most), ", "), F.when(F.size(names) > most, ", et al.").otherwise(""))


def clean_tags(raw: Column, fallback: Column, broad: list[str], most: int = 3) -> Column:
    """Fallback tags first, broad ones dropped, distinct in order, at most ``most``."""
    kept = F.filter(F.transform(F.concat(fallback, raw), lambda t: F.trim(t)), lambda t: (t != "") & ~t.isin(broad))
    return F.slice(F.array_distinct(kept), 1, most)


def mapped(tags: Column, table: dict[str, str]) -> Column:
    """The table's values for the tags it has, distinct in order."""
    held = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.array_distinct(F.filter(F.transform(tags, lambda t: held[t]), lambda t: t.isNotNull()))
