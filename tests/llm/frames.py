"""Small inputs: documents with every odd case, and random texts with near copies and shared passages."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, name string, words string, size string, copies string, n string, component string, marks string, kept string, k1 string, label string, span string"
EXTRA = 12


def prose(rng, n, vocabulary=4000):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def random_rows(seed=3, families=12):
    """(doc_id, text): families of near copies, exact copies, and passages of 40 words that texts share."""
    rng = random.Random(seed)
    rows, passage = [], prose(rng, 40)
    for _ in range(families):
        base = prose(rng, rng.choice([6, 20, 60, 150]))
        for copy in range(rng.randrange(1, 7)):
            words = list(base)
            for _ in range(rng.randrange(0, 1 + len(words) // 25)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            if rng.random() < 0.3:
                words[len(words) // 2:len(words) // 2] = passage
            rows.append(" ".join(words) if copy % 2 else "\n".join(words))
    rng.shuffle(rows)
    return [(i, t) for i, t in enumerate(rows)]


def odd_rows():
    rng = random.Random(1)
    long = " ".join(prose(rng, 30_000))
    return [(1, None), (2, ""), (3, " \t\n \x0b\x0c\r"), (4, "one"), (5, "One two three"), (6, "one  two\tthree"), (7, long), (8, long), (8, long), (9, "\n".join(["same line here"] * 40)),
            (None, "a text of no id at all"), (None, None), (10, "É Ünïcode ✓ 漢字 " * 20), (11, "x" * 50_000), (12, "a b c d"), (13, "a b c"), (14, "<|endoftext|> &amp; 's don't 12 345"), (15, "\x1f\x85\xa0 　 odd spaces")]


def documents(spark, rows):
    data = [(d, t, "en", None if (d or 0) % 4 == 3 else f"s{(d or 0) % 4}", len(t or ""), *["clash"] * EXTRA) for d, t in rows]
    return spark.createDataFrame(data, SCHEMA)
