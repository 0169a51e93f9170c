"""A short stop list for the registered queries; real runs read their own with ``read_stop_words``."""

STOP_WORDS = [
    "and", "are", "as", "at", "auf", "avec", "by", "das", "de", "den", "der", "des", "die", "du",
    "ein", "en", "es", "et", "for", "he", "in", "is", "ist", "it", "la", "le", "les", "mit", "of",
    "on", "or", "que", "qui", "that", "the", "this", "to", "un", "und", "une", "was", "with",
]
