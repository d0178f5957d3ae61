"""Language labels as people write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from textloom.functions import text as T

# codes and names of the languages (fixed values); a region behind the code is disregarded
NAMES = {
    "en": ("en", "eng", "english"),
    "ta": ("ta", "tam", "tamil"),
    "es": ("es", "spa", "spanish", "español", "espanol", "castellano"),
    "fr": ("fr", "fra", "fre", "french", "français", "francais"),
    "de": ("de", "deu", "ger", "german", "deutsch"),
    "hi": ("hi", "hin", "hindi"),
}
# both orders, and Tamil-English under one word (fixed values)
MIXED = ("ta-en", "en-ta", "tam-eng", "eng-tam", "tamil-english", "english-tamil", "tanglish")
LANGUAGES = (*NAMES, "ta-en")


def canonical(c: Column) -> Column:
    """The language code that a label stands for in any spelling; null for a missing, unknown or foreign label."""
    t = F.regexp_replace(F.lower(T.label(c)), r"[\s_/+]+", "-")
    head = F.split(t, "-")[0]
    out = F.when(t.isin(*MIXED), F.lit("ta-en"))
    for code, names in NAMES.items():
        out = out.when(head.isin(*names), F.lit(code))
    return out
