"""Small tables with odd rows, shared by the tests of the operators."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
WORDS = "the of and idiot river stone walks über naïve 漢字 a1 it's 42 #tag &amp; moon tree cloud".split()


def prose(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    return "".join(rnd.choice(WORDS) + rnd.choice([" ", " ", " ", "\n", "  ", "\t"]) for _ in range(words))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, blanks, ties, repeated rows, special strings, long words."""
    base = prose(1, 200)
    near = base.replace("river", "rivers", 1)
    texts = [
        None, "", " \t\n ", "word", "a b c d", "x\ny\nx\n x", base, base.replace(" ", "  "), near, prose(2, 4000), "z" * 3000,
        "<|endoftext|> and <|endoftext|>", "it's 's ''s 'll\r\n\r\nend  ", "é🎉漢字 ½ Ⅷ", " " * 300, "a b c " * 60, "Ab cD eF gH iJ", "ab cd ef gh ij",
    ]
    rows = [(n, text, "en", f"s{n % 2}", len(text or "")) for n, text in enumerate(texts)]
    rows += [rows[6], rows[6], (None, base, None, None, None), (None, base, None, None, None), (None, None, None, None, None)]
    return rows + [(100 + n, prose(100 + n % 30, 60), "en", "s0", 0) for n in range(60)]


def frame(spark, rows=None):
    """The rows with columns whose names clash with those that operators use themselves."""
    df = spark.createDataFrame(odd_rows() if rows is None else rows, SCHEMA)
    return df.selectExpr("*", "1 AS row", "'k' AS key", "2 AS size", "3 AS shard", "4 AS kept", "5 AS label", "6 AS digest")
