"""Small tables with everything that operators must stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random

PASSAGE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fingerprint string, component_id long, score double, __kept int"


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 9))) for _ in range(words))


def rows():
    texts = [
        (1, prose(1, 80)), (2, prose(1, 80)), (3, prose(3, 60) + "\n" + PASSAGE + "\n" + prose(4, 60)), (4, PASSAGE + "\n" + prose(5, 30)),
        (5, ""), (6, None), (7, "   \n\t \n"), (8, "a"), (8, "a"), (9, prose(6, 40)), (9, prose(6, 40)), (None, prose(1, 80)), (None, prose(7, 50)),
        (None, prose(7, 50)), (10, "é" * 3000), (11, "ab" * 30_000), (12, prose(8, 30_000)), (13, prose(8, 29_000)),
        (14, "x\0y " * 40), (15, "\n".join(["same line here"] * 30)), (16, "𝄞 😀   tail " * 20), (17, prose(1, 79) + " other"),
        (-3, prose(9, 20)), (18, "password = hunter2hunter2 AKIA" + "Q" * 16 + " " + "0f" * 20 + " token:short"),
    ]
    return [(i, t, ["en", None, "fr"][k % 3], "s", 0, "f", 5, 0.5, 1) for k, (i, t) in enumerate(texts)]


def docs(spark, keep=lambda r: True):
    return spark.createDataFrame([r for r in rows() if keep(r)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
