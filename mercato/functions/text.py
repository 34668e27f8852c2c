"""Text search: folding, word split, stop words, light stemming, weighted score.

Terms are expanded once, when the plan is built, into the literal word forms
that share their stem; at run time a token is only compared with that set.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BREAK = "[^a-z0-9]+"

# Common Portuguese function words, already folded.
STOP_WORDS = (
    "a", "ao", "aos", "as", "ate", "com", "como", "da", "das", "de", "do", "dos", "e", "ela", "ele", "em",
    "entre", "era", "essa", "esse", "esta", "este", "eu", "foi", "isso", "isto", "ja", "mais", "mas", "me",
    "mesmo", "meu", "minha", "muito", "na", "nao", "nas", "nem", "no", "nos", "o", "os", "ou", "para", "pela",
    "pelo", "por", "qual", "quando", "que", "se", "sem", "ser", "seu", "sua", "so", "tambem", "te", "tem", "um",
    "uma", "voce",
)

# Plural, adverb and gender endings dropped by the light stemmer,
# longest first.
SUFFIXES = ("mente", "coes", "oes", "ais", "eis", "cao", "ao", "es", "as", "os", "s", "a", "o", "e")
SHORTEST_STEM = 3


def _accented_letters() -> dict[str, str]:
    """Accented Latin letters and the plain letter each decomposes to."""
    plain = {}
    for code in range(0x00C0, 0x0180):
        base = unicodedata.normalize("NFD", chr(code).lower())[0]
        if base.isascii() and base.isalpha():
            plain[chr(code).lower()] = base
    return plain


def folded(text: Column) -> Column:
    """Lower case without diacritics; plain ASCII text skips the letter table."""
    letters = _accented_letters()
    lower = F.lower(text)
    plain = F.translate(lower, "".join(letters), "".join(letters.values()))
    return F.when(F.octet_length(text) == F.char_length(text), lower).otherwise(plain)


def tokens(text: Column, stop_words: tuple[str, ...] = STOP_WORDS) -> Column:
    """Words of the whole text, folded, stop words dropped, repeats kept."""
    words = F.split(folded(text), WORD_BREAK)
    return F.filter(words, lambda w: (w != "") & ~w.isin(list(stop_words)))


def stem(word: str) -> str:
    """Drop the longest listed ending that leaves a stem of three letters."""
    for suffix in SUFFIXES:
        if word.endswith(suffix) and len(word) - len(suffix) >= SHORTEST_STEM:
            return word[: -len(suffix)]
    return word


def query_words(query: str) -> list[str]:
    """Folded words of a search string without stop words."""
    plain = "".join(c for c in unicodedata.normalize("NFD", query.lower()) if not unicodedata.combining(c))
    return [w for w in re.split(WORD_BREAK, plain) if w and w not in STOP_WORDS]


def word_forms(query: str) -> list[str]:
    """Every word form whose stem equals the stem of a query word."""
    forms = set()
    for word in query_words(query):
        root = stem(word)
        forms.update(root + s for s in ("",) + SUFFIXES if stem(root + s) == root)
        forms.add(word)
    return sorted(forms)


def match_count(text: Column, query: str) -> Column:
    """How many words of the text match a query word."""
    forms = word_forms(query)
    words = F.split(folded(F.coalesce(text, F.lit(""))), WORD_BREAK)
    return F.size(F.filter(words, lambda w: w.isin(forms)))


def mentions(fields: Mapping[str, float], query: str) -> Column:
    """Whether a field has a query word: one pattern, so only texts that match are split into words."""
    forms = "|".join(word_forms(query))
    pattern = f"(?<![a-z0-9])(?:{forms})(?![a-z0-9])" if forms else "(?!)"
    found = [folded(F.coalesce(F.col(name), F.lit(""))).rlike(pattern) for name in fields]
    return reduce(lambda a, b: a | b, found, F.lit(False))


def text_score(fields: Mapping[str, float], query: str) -> Column:
    """Sum over the fields of weight times matching words; zero means no match."""
    score = F.lit(0.0)
    for name, weight in fields.items():
        score = score + F.lit(float(weight)) * match_count(F.col(name), query)
    return score
