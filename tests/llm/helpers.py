from __future__ import annotations

import random
import re

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def fold(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(fold(text))


def prose(seed, n, vocabulary=400, prefix="w"):
    rng = random.Random(seed)
    return " ".join(f"{prefix}{rng.randrange(vocabulary)}" for _ in range(n))


def edited(text, seed, share):
    rng = random.Random(seed)
    return " ".join(f"e{rng.randrange(10**6)}" if rng.random() < share else w for w in text.split())
