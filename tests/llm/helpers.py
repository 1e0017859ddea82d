"""Small tables with the odd cases every operator must take: nulls, empties, ties, repeats, clashing columns."""

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")

LINE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty"
ODD = [
    (0, None, "en", "a"),
    (1, "", "en", "a"),
    (2, "  \n\t ", None, "a"),
    (3, LINE, "en", "b"),
    (4, LINE, "en", "b"),
    (4, LINE, "en", "b"),
    (5, LINE + "\n" + LINE + "\n" + LINE, "en", None),
    (6, "a b c d e f g h " * 5, None, None),
    (None, "short text", "fr", "b"),
    (7, "é ü  x<|endoftext|>y   don't stop, 12 34!! ### $$ **", "de", "c"),
    (8, " ".join(f"w{i * i % 977}x{i}" for i in range(4000)), "en", "c"),
    (9, "ALL CAPS HERE! " * 12, "en", "c"),
]


def odd_documents(spark, rows=ODD):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, id long, size long, length long, component_id long, bits long, `key` string, whole string"
    return spark.createDataFrame([(*r, len(r[1] or ""), 0.5, 7, 3, 9, 4, 1, "k", "w") for r in rows], schema)


def no_documents(spark):
    return odd_documents(spark, [])


def words(text):
    return WORD.findall(text or "")


def sample(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")
