from __future__ import annotations

import random

WORDS = "an be cat dog elm fig gem hut ink jet kin log map net oak pen quay rim sun tap urn vat web yak zoo".split()


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))


# Odd rows that every operator has to take: null, empty and blank texts, a null id, a row
# that repeats another, equal texts, and one long text.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one"), (5, "one"), (None, "two words"), (6, "É é İ ß 漢字 🙂 two"),
    (7, prose(7, 20_000)), (8, None),
]
