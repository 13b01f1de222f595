"""Small inputs that hold every hard case, and plain references."""

import zlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long, mark string, _place int"


def documents(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, source), with extra columns whose names clash with inner ones."""
    full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", None if r[1] is None else len(r[1]), "x", 1) for r in rows]
    return spark.createDataFrame(full, DOCS)


def crc(doc_id):
    return zlib.crc32(str(doc_id).encode())


def lowered_words(text):
    return (text or "").encode().lower().split()
