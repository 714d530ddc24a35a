"""Rows that the tests of several operators share."""

import re

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def odd_rows(rng):
    """Rows that every operator has to bear."""
    words = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta,", "漢字", "\U0001F600"]
    text = lambda n: " ".join(rng.choice(words) + rng.choice(["", ".", "\n"]) for _ in range(n))
    long = text(30_000)
    base = text(60)
    return [
        (1, base, "en", "a"), (2, base, "en", "b"), (2, base, "en", "b"), (3, None, None, None), (4, "", "de", "a"),
        (5, " \n\t ", "de", None), (None, base, "en", "a"), (6, long, "fr", "a"), (7, long + " end", "fr", "c"),
        (8, "one", None, "a"), (9, "x" * 50_000, "en", "a"), (10, base.upper(), "en", "a"), (11, text(13), "en", "a"),
        (-5, base + " more", "en", "a"), (12, " ".join(["the"] * 400), "en", "a"),
    ]
