"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

WORDS = "the and of words some are long others short été naïve größe x1 42 a,b 日本語 don't".split()


def sentence(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 30)) for _ in range(n))


def documents() -> list[tuple]:
    """(doc_id, text, key, row, node, bucket, part, label, spans): the others have names that operators use."""
    base = sentence(1, 200)
    near = base.replace("the", "this", 1)
    texts = [
        (1, base), (2, base), (3, near), (4, None), (5, ""), (6, "   \n\t "), (7, "one two three"), (8, "ONE two\nthree"),
        (9, sentence(2, 12) + "\n\n  \n " + base), (10, "a" * 3000), (11, sentence(3, 6000)), (11, sentence(3, 6000)), (None, sentence(4, 30)),
        (None, base), (12, "tabs\t\there  and \x1c\x85  spaces \n \n end "), (13, "<|endoftext|> is text"), (14, "😀" * 200), (15, sentence(5, 90)), (15, sentence(6, 90)),
    ]
    return [(i, t, "k", 1, 2, 3, 4, 0, "s") for i, t in texts]


SCHEMA = "doc_id long, text string, key string, row int, node int, bucket int, part int, label int, spans string"


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
