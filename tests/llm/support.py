"""Small document tables for the tests of this folder."""

import re

from spreadkit.llm.tables import ship_package

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string"
# a column of every name that an operator uses inside
CLASHES = ["id", "n", "label", "block", "part", "tail", "ids", "kept", "vector", "start", "_gone", "value", "units"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def docs(spark, texts, first=0, clashes=False):
    """``doc_id, text`` (and clashing columns) from a list of texts."""
    ship_package(spark)
    df = spark.createDataFrame([(first + i, t) for i, t in enumerate(texts)], DOCS)
    for c in CLASHES if clashes else ():
        df = df.selectExpr("*", f"'x' AS `{c}`")
    return df


def empty(spark):
    ship_package(spark)
    return spark.createDataFrame([], DOCS)


ODD = [None, "", " ", "\n\n", "a", "  lead", "trail \n", "é ß  x　y", "<|endoftext|> a<|endoftext|>b", "\x1c \x00 z"]


def thue_morse(n, letters):
    """The word of length ``n`` over two letters, and its complement: equal under
    any polynomial hash modulo 2^64 from 1024 letters on."""
    bits = [bin(i).count("1") & 1 for i in range(n)]
    return ["".join(letters[b ^ flip] for b in bits) for flip in (0, 1)]
