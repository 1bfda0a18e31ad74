"""Awkward documents that every operator must take."""

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, h long, th long, at int, k string, "
          "copies string, size string, n_removed string, score string, host string, u string, next string")
EXTRA = ("x", 1, 2, 3, "k", "c", "s", "n", "sc", "ho", "u", "ne")
LONG_TEXT = "The quick brown fox jumps over the lazy dog number %d. " * 1 + "word " * 200_000
TEXTS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "a"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "a"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "a"),
    (3, None, "en", "a"),
    (4, "", "fr", None),
    (5, "  \n\t ", None, "b"),
    (None, "le chat est sur la table et le chien dort dans la maison", "fr", "b"),
    (None, None, None, None),
    (6, "one", "en", "b"),
    (7, "le chat est sur la table et le chien mange dans la cuisine", "fr", "é"),
    (8, "日本語のテキスト 😀 ß É", None, "c"),
    (9, LONG_TEXT, "en", "c"),
    (10, "x" * 100_000, "en", "c"),
]


def documents(spark, rows=None):
    """The cases as a DataFrame with extra columns whose names operators use inside."""
    rows = TEXTS if rows is None else rows
    return spark.createDataFrame([(*r, len(r[1] or ""), *EXTRA) for r in rows], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
