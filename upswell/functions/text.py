"""Text expressions. All run JVM-side but one: Unicode folding, which Spark lacks."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

from upswell import settings


def fold_text(text: str | None) -> str | None:
    if text is None:
        return None
    decomposed = unicodedata.normalize("NFKD", text)
    return "".join(ch for ch in decomposed if unicodedata.combining(ch) == 0).casefold()


@pandas_udf(StringType())
def _fold_unicode(texts: pd.Series) -> pd.Series:
    return texts.map(fold_text)


def unaccent(text: Column) -> Column:
    """Compatibility-decompose, drop combining marks, casefold. Plain ASCII text never leaves the
    JVM: only rows holding other characters are sent to Python, as Arrow batches."""
    return F.coalesce(
        _fold_unicode(F.when(text.rlike(r"[^\x00-\x7F]"), text)), F.lower(text)
    )


def _collapse(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, r"(?U)\s+", " "), r"^ | $", "")


def normalize_name(name: Column) -> Column:
    """Spelling variants of one name (case, accents, spacing) share this form."""
    return _collapse(unaccent(name))


def entity_key(name: Column, mbid: Column) -> Column:
    """``mbid:<id>`` where an ID is known, else ``name:<normalized name>``."""
    return F.when(
        F.coalesce(mbid, F.lit("")) != "", F.concat(F.lit("mbid:"), F.lower(mbid))
    ).otherwise(F.concat(F.lit("name:"), normalize_name(name)))


def match_form(name: Column) -> Column:
    """The looser form names are matched on: ``&`` reads "and", punctuation is a space, and a
    leading "the" goes unless nothing would remain."""
    words = F.replace(unaccent(name), F.lit("&"), F.lit(" and "))
    words = _collapse(F.regexp_replace(words, r"(?U)[^\w\s]", " "))
    short = F.trim(F.regexp_replace(words, "^the ", ""))
    return F.when(short != "", short).otherwise(words)


def fold_place(place: Column) -> Column:
    """City and country spellings that mean the same place share this form."""
    return unaccent(F.trim(place))


def is_tribute(name: Column) -> Column:
    return name.rlike(r"(?i)\b(" + "|".join(settings.TRIBUTE_PHRASES) + r")\b")


def strip_anchors(html: Column) -> Column:
    """Drop ``<a href=...>...</a>`` spans with a period that follows, then trim."""
    return F.trim(F.regexp_replace(html, r"<a href=.*?</a>\.?", ""))


def ascii_punctuation(text: Column) -> Column:
    """Unicode hyphens and special spaces to their ASCII forms."""
    text = F.regexp_replace(text, r"[\x{2010}-\x{2015}]", "-")
    return F.regexp_replace(text, r"[\x{00A0}\x{202F}\x{2009}]", " ")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def markdown_section(text: Column, title: str) -> Column:
    """Body of one ``### title`` section, up to the next heading or the end; blank is NULL."""
    pattern = rf"(?s)### {title}\s*(.*?)\s*(###|$)"
    return blank_to_null(F.trim(F.regexp_extract(text, pattern, 1)))


def lacks_prefix(text: Column, prefix: str) -> Column:
    """NULL where there is no text, else whether it does not begin with ``prefix``."""
    return ~text.startswith(prefix)


def truncate_words(text: Column, max_chars: int = settings.MAX_BIO_CHARS) -> Column:
    """Cut long text at the last space before ``max_chars`` and add an ellipsis."""
    head = F.substring(text, 1, max_chars)
    cut = F.regexp_replace(head, r"(?s) [^ ]*$", "")
    return F.when(F.length(text) > max_chars, F.concat(cut, F.lit("..."))).otherwise(text)


def pseudonym(user: Column) -> Column:
    """What logs show instead of a user name."""
    return F.concat(F.lit("user#"), F.substring(F.sha2(F.lower(user), 256), 1, 8))


def valid_username(user: Column) -> Column:
    return F.coalesce(user, F.lit("")).rlike("^[A-Za-z][A-Za-z0-9_-]{1,14}$")


def key_to_mbid(key: Column) -> Column:
    return F.when(key.startswith("mbid:"), F.substr(key, F.lit(6)))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def signed_percent(value: Column) -> Column:
    shown = F.format_string("%+.1f%%", F.bround(value, 1))
    return F.when(value.isNotNull(), shown).otherwise("n/a")


def grouped_number(value: Column) -> Column:
    return F.coalesce(F.format_number(value.cast("double"), 0), F.lit("n/a"))
