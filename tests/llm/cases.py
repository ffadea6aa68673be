"""Small documents with every awkward case, and plain helpers for brute force."""

import random
import re

SCHEMA = "doc_id long, text string, source string, uid string, id string, label string, n int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(text or "")


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def documents():
    """(doc_id, text, source): nulls, empties, blanks, repeats, near copies, a very long text, ids that repeat."""
    rng = random.Random(11)
    base = prose(rng, 120, 100_000)
    rows = [(1, None, "a"), (2, "", "a"), (3, " \n\t ", None), (None, "no id here but some words to keep it going", "b")]
    rows += [(10, base, "a"), (11, base, "b"), (12, base + " one more word", "b"), (11, base, "b")]
    near = base.split()
    for i in range(6):
        changed = list(near)
        changed[rng.randrange(120)] = "edited"
        rows.append((20 + i, " ".join(changed), "c"))
    far = list(near)
    for i in range(0, 120, 12):
        far[i] = "other"
    rows.append((30, " ".join(far), "c"))
    rows += [(40, "two words", "d"), (41, "Two  WORDS", "d"), (42, "ein zwei drei vier fünf sechs", None)]
    rows.append((50, prose(rng, 30_000), "a"))
    rows += [(100 + i, prose(rng, rng.randrange(1, 300), 2000), rng.choice("abcde")) for i in range(60)]
    return [(a, b, c, "u", "i", "l", 7) for a, b, c in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)
