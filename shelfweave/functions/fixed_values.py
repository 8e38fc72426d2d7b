"""Values that have to equal the published ones for results to agree. Plain text, natural order."""

from __future__ import annotations

import unicodedata

# ISO language code -> named stop-word set; English where a code is unknown.
STOPWORD_SETS = {
    "ar": "_arabic_",
    "am": "_armenian_",
    "eu": "_basque_",
    "br": "_brazilian_",
    "bg": "_bulgarian_",
    "ca": "_catalan_",
    "cs": "_czech_",
    "da": "_danish_",
    "nl": "_dutch_",
    "en": "_english_",
    "gb": "_english_",
    "fi": "_finnish_",
    "fr": "_french_",
    "gl": "_galician_",
    "de": "_german_",
    "el": "_greek_",
    "hi": "_hindi_",
    "hu": "_hungarian_",
    "id": "_indonesian_",
    "ga": "_irish_",
    "it": "_italian_",
    "lv": "_latvian_",
    "no": "_norwegian_",
    "fa": "_persian_",
    "pl": "_polish_",
    "pt": "_portuguese_",
    "ro": "_romanian_",
    "ru": "_russian_",
    "es": "_spanish_",
    "se": "_swedish_",
    "th": "_thai_",
    "tr": "_turkish_",
}
DEFAULT_STOPWORD_ISO = "en"

# The default English stop words of Apache Lucene. Other languages are a parameter.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is", "it", "no", "not",
    "of", "on", "or", "such", "that", "the", "their", "then", "there", "these", "they", "this", "to", "was",
    "will", "with",
)

# Field type names a document schema may use.
FIELD_TYPES = (
    "text", "keyword", "long", "integer", "short", "byte", "double", "float", "half_float", "scaled_float",
    "date", "boolean", "binary", "nested",
)
DATE_FORMATS = "yyyy-MM-dd HH:mm:ss||yyyy-MM-dd||epoch_millis"

# Facet operators, facet list limits, page ids that never show in a path.
FACET_AND = 0
FACET_OR = 1
FACET_LIMITS = (0, 3, 4, 5, 10, 20)
HIDDEN_CATEGORIES = (1, 2)
PATH_SEPARATOR = " /// "
DEFAULT_CHUNK = 100
DEFAULT_HIDDEN_FIELDS = "pageviews,sales"


def _accent_table() -> tuple[str, str]:
    # Latin-1 letters and Latin Extended-A, each mapped to its base letter by Unicode decomposition.
    source, target = [], []
    for code in range(0xC0, 0x180):
        char = chr(code)
        base = unicodedata.normalize("NFKD", char)[0]
        if base != char and base.isascii() and base.isalpha():
            source.append(char)
            target.append(base)
    for char, base in (("đ", "d"), ("Đ", "D"), ("ħ", "h"), ("Ħ", "H"), ("ı", "i"), ("ł", "l"), ("Ł", "L"), ("ø", "o"), ("Ø", "O"), ("ŧ", "t"), ("Ŧ", "T")):
        source.append(char)
        target.append(base)
    return "".join(source), "".join(target)


ACCENTS_FROM, ACCENTS_TO = _accent_table()
LIGATURES = (("ß", "ss"), ("æ", "ae"), ("Æ", "AE"), ("œ", "oe"), ("Œ", "OE"))
