"""Invented texts for the tests."""

from __future__ import annotations

import random


def prose(seed: float, n: int) -> str:
    draw = random.Random(seed)
    syllables = "th an er on re he in ed nd ha at en es of or nt ea ti to it".split()
    common = ["the", "of", "and", "to", "in", "is"]
    words = [draw.choice(common) if draw.random() < 0.35 else "".join(draw.choices(syllables, k=draw.randint(2, 4))) for _ in range(n)]
    return " ".join(words)


def edited(text: str, seed: int, edits: int) -> str:
    words, draw = text.split(" "), random.Random(seed)
    for _ in range(edits):
        words[draw.randrange(len(words))] = f"x{draw.randrange(10**6)}"
    return " ".join(words)
