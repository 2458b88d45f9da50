"""Small corpora for the operators' edge cases."""

from __future__ import annotations

CLASHING = ("ids", "size", "score", "class_id", "_node", "base", "rank", "rest", "places", "secrets")


def words(rng, n, letters="abcdeilnorst"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 8))) for _ in range(n))


def odd_documents(spark, rows=None):
    """Nulls, empty, long, tied and repeated rows, and extra columns with clashing names."""
    import random

    rng = random.Random(11)
    long_text = words(rng, 9000)
    rows = rows if rows is not None else [
        (1, "one two three four five six seven", "en", "a"), (1, "one two three four five six seven", "en", "a"),
        (2, None, None, None), (3, "", "en", "b"), (4, " \n\t", "de", "b"), (None, "no id but words here", "en", "a"),
        (5, long_text, "en", "c"), (6, long_text, "en", None), (7, "x" * 50_000, "en", "a"), (8, "a b", "fr", "a"),
        (9, "mail a.b@c.de or call +49 30 1234567, token=abcdefghijklmnop", "en", "a"), (10, "\U0001f600 é ▁ \x00 end", "en", "b"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)
    return spark.createDataFrame([(i, t, g, s, len(t or ""), *["z"] * len(CLASHING)) for i, t, g, s in rows], schema)


def plain_rows(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))
