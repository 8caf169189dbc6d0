"""Small documents with every awkward case, and plain-Python readings of the contracts."""

from __future__ import annotations

import random

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
BREAKS = b" \t\n\x0b\x0c\r"

# Extra columns carry names that the operators use inside.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, row string, d1 long, part int, "
          "slice long, copies long, fingerprint string, size int, key string, kept string, ids string, gram string")


def rows(seed: int = 3, n: int = 60) -> list[tuple]:
    """Nulls in every column, empty and long texts, copies, near copies, shared passages, ties, repeated rows."""
    rng = random.Random(seed)
    words = ["the", "of", "and", "to", "ist", "ein", "été", "日本", "año", "zwölf", "x|y", "a###", "Straße", "NAÏVE"]
    words += ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(150)]

    def prose(size: int) -> str:
        return "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\n", "\t", ". "]) for _ in range(size))

    passage, line = prose(60).strip(), "  A shared LINE \t"
    texts: list[str | None] = [None, "", " ", "\n\n", "\t \x0b", "one", "one two three", "ONE two three", None, ""]
    for number in range(n):
        text = prose(rng.choice([1, 5, 40, 80, 200]))
        if number % 3 == 0:
            text += "\n" + line
        if number % 5 == 0:
            text += "\n" + passage + "\n" + prose(10)
        texts.append(text)
    long = prose(6000)
    texts += [long, long.replace("the", "thee", 2), long + " end", texts[12], texts[12], "z" * 3000, "yes " * 500]
    found = []
    for number, text in enumerate(texts):
        own = None if number % 17 == 4 else number
        found.append((own, text, [None, "en", "de", "en"][number % 4], [None, "s0", "s1", "s2", "s0"][number % 5],
                      number, "row", number, 1, None, 5, "f", 3, "k", None, "i", None))
    return found + [found[12], found[12], found[0], found[1], (None, None) + (None,) * 14]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().split()


def multiset(found) -> list:
    return sorted(map(repr, found))
