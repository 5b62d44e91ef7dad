"""Inputs and plain-Python helpers of these tests."""

import re

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = re.compile(f"[^{SPACES}]+")


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def words(text):
    return WORD.findall(text or "")


#: ids that repeat or are null, texts that are null, empty, odd, or repeated
EDGES = [
    (None, None),
    (None, "null id"),
    (1, ""),
    (1, " \t\n\x0b\x0c\r"),
    (2, "Word"),
    (2, "Word"),
    (3, "É̀ naïve — “quoted” ’tis wide space\u0085end 日本語 текст"),
    (4, "a\n\nb\n \nA \n\ta\n"),
    (5, "x\x1cy\x00z"),
    (9_000_000_000, "Big id"),
]


def with_clashes(df, names):
    """df with extra columns of the given names."""
    from pyspark.sql import functions as F

    for n in names:
        df = df.withColumn(n, F.lit("extra"))
    return df
