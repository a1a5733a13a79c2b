"""Small documents with every hard case, shared by the tests of the corpus operators."""

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, simhash string, size string, lang_pred string, spans int"

EN = "the quick brown fox jumps over the lazy dog and runs away from the old farmer with his dogs"
DE = "der schnelle braune Fuchs springt über den faulen Hund und läuft dem alten Bauern davon mit"
FR = "le renard brun et rapide saute par-dessus le chien paresseux et s'enfuit devant le vieux fermier"
ES = "el rápido zorro marrón salta sobre el perro perezoso y huye del viejo granjero con sus perros"


def rows():
    """Nulls in each column, empty, blank and very long texts, ties, repeated rows, and columns with clashing names."""
    long = " ".join(f"word{i % 977} {EN}" for i in range(2500))
    texts = [
        (1, EN, "en", "a"),
        (2, EN, "en", "a"),
        (3, EN + " now", "en", None),
        (3, EN + " now", "en", None),
        (4, None, None, None),
        (5, "", "de", "b"),
        (6, " \t\n", "fr", "b"),
        (7, long, "en", "b"),
        (8, "x", None, "c"),
        (9, "12 34 !!", "es", "c"),
        (None, DE, "de", "c"),
        (None, DE + " Ende", "de", "a"),
        (10, FR, "fr", "a"),
        (11, ES, "es", "b"),
        (12, "a 😀 b́ ñ", "es", "b"),
        (13, long[:5000] + ES, "es", "b"),
        (2, FR, "fr", "c"),
    ]
    return [(i, t, lang, s, None if t is None else len(t), "clash", "clash", "clash", 7) for i, t, lang, s in texts]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def key(value):
    return (value is not None, value if value is not None else 0)
