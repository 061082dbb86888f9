"""Small tables with the awkward rows that every operator must handle."""

from __future__ import annotations

import random

WORDS = "alpha beta gamma delta omega river stone cloud maple ember quartz lantern meadow harbor violet copper".split()
# Columns that share names with what operators use inside.
EXTRA = "score string, class long, id string, root long, grams string, toxic int, place int, fold int, entry long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def document(doc_id, text, lang="en") -> tuple:
    return doc_id, text, lang, "s", len(text or ""), "x", 1, "y", 2, "z", 0, 3, 4, 5


def awkward() -> list[tuple]:
    """Null and empty texts, white space, one very long text, repeated rows, a repeated and a null id."""
    long = " ".join(random.Random(5).choice(WORDS) for _ in range(30_000))
    rows = [document(1, None), document(2, ""), document(3, " \n\t "), document(4, "word"), document(5, long)]
    rows += [document(6, "same words again and again here")] * 3
    rows += [document(7, "one text of an id"), document(7, "another text of the id"), document(None, "no id at all")]
    return rows + [document(8, "Ünïcode ünd 漢字 👍"), document(9, None, None), document(None, None, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def prose(seed: int, words: int) -> list[str]:
    source = random.Random(seed)
    return [source.choice(WORDS) + str(source.randrange(400)) for _ in range(words)]
