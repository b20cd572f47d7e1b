"""Small tables of awkward documents, and plain versions of what the operators see in a text."""

from __future__ import annotations

import random
import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def awkward(seed: int = 1, n: int = 60):
    """Nulls in any column, empty and long texts, repeated rows, copies with edits, and words of all widths."""
    r = random.Random(seed)
    vocabulary = ["the", "of", "And", "année", "größe", "x", "12", "naïve", "tokén", "a|b", "🙂", "über-", "it's"] + [f"w{i}" for i in range(40)]
    say = lambda k: " ".join(r.choice(vocabulary) + r.choice(["", "", ",", ".\n"]) for _ in range(k))
    rows = []
    for i in range(n):
        text = say(r.choice([1, 3, 4, 5, 12, 40, 90, 200]))
        if rows and r.random() < 0.4:
            text = rows[r.randrange(len(rows))][1] or ""
            words = text.split(" ")
            for _ in range(r.choice([0, 0, 1, 2, 5])):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            text = " ".join(words)
        rows.append((i, text, r.choice(["en", "fr", None]), r.choice(["a", "b", "é", None]), len(text)))
    rows += [(n, None, "en", "a", None), (n + 1, "", "en", "b", 0), (n + 2, " \n\t ", None, None, 4), (n + 3, "#$ 12 !!", "fr", "a", 8)]
    rows += [(n + 4, say(4_000), "en", "a", 1), (None, "a text without an id " * 6, "fr", "b", 1), rows[0], rows[0], rows[7]]
    return rows


def table(spark, rows, schema: str = DOCUMENTS):
    return spark.createDataFrame(rows, schema)


def clashing(df):
    """The table with columns named like the operators' own."""
    from pyspark.sql import functions as F

    names = "size k n token label score kept items copies pivot block tokens place runs rows target n_words Lang_Pred".split()
    return df.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
