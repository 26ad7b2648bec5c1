"""Small awkward tables: nulls in every column, empty and very long texts,
ties, repeated rows, and extra columns named like the operators' own."""

import random
import zlib

LONG = "word " * 30_000 + "end"


def awkward_rows():
    base = "the quick brown fox jumps over the lazy dog and runs far away from the slow red cat"
    texts = [base, base, base.replace(" ", "\n"), base + " ", base.upper(), base.replace("dog", "pig"),
             "", None, "   \t\n", "a", "a b", "a b c", "Ünïcödé ŵörds ﬁ ①  two  spaces", LONG, LONG + " tail", base]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 4}" if i % 5 else None, i) for i, t in enumerate(texts)]
    rows += [rows[0], rows[0], (None, base, None, None, None), (None, None, None, None, None), (0, "another text", "de", "s1", 1)]
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def awkward(spark):
    """The table with clashing extra columns behind its own."""
    df = spark.createDataFrame(awkward_rows(), SCHEMA)
    return df.selectExpr("*", "1 AS id", "'x' AS norm", "2 AS size", "'y' AS row", "3.0D AS score", "true AS kept",
                         "4L AS fp", "'z' AS keep_id", "5 AS `odd name`", "6L AS text_hash", "7 AS cls", "8 AS place")


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(n, seed=0, toxic=False, junk=False):
    """Invented documents: (doc_id, text, lang, source, n_chars)."""
    rng = random.Random(seed)
    stems = [a + b for a in ("ba", "do", "ki", "lu", "me", "no", "pa", "ri", "su", "te") for b in ("n", "r", "s", "l", "")]
    out = []
    for i in range(n):
        words = [rng.choice(stems) + rng.choice(stems) if rng.random() < .6 else rng.choice(["the", "of", "and", "to"])
                 for _ in range(rng.randint(60, 120))]
        text = " ".join(words) + "."
        out.append((i, text, "en", f"s{i % 3}", len(text)))
    return out


def fold(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def words(text):
    return [w.decode() for w in (text or "").encode().split()]


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
