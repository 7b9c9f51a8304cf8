"""Texts that operators must not stumble over."""

import random

LONG = " ".join(f"word{k % 977} und{k % 13}" for k in range(30_000))
#: (doc_id, text): null and empty texts, null and repeated ids, equal rows, one long text, marks, other scripts.
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "a"), (5, "The same text twice, in two rows."), (6, "The same text twice, in two rows."),
    (7, LONG), (8, "... !!! 123"), (9, "日本語のテキスト と ελληνικά Σας"), (10, "a" * 5000), (None, "no id here"), (None, None),
    (11, "one id"), (11, "one id, two texts"), (12, "row again"), (12, "row again"), (13, "<|endoftext|> it's x\x1cy ÀÉ"),
]
#: Columns of the documents table and names that operators use inside.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id int, fp string, score string, row string, component_id string, c0 string, label string, key string, lang_pred string"


def odd_docs(spark, rows=None):
    given = ODD if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "fp", "sc", "r", "c", "c0", "l", "k", "p") for i, t in given], SCHEMA)


def prose(seed: int, n: int, words: str = "the of and to in that is was for it with on as by this are be from") -> str:
    rnd, parts = random.Random(seed), words.split()
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))
