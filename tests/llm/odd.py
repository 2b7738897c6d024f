"""Small documents with every kind of trouble, for all operators."""

from __future__ import annotations

import pandas as pd

LONG = " ".join(f"w{i}x{i * 7 % 1013}" for i in range(30_000))
PLAIN = "the of and to in that it is was for on are as with his they at be this from I have or by one had not but what all were when we"

#: (doc_id, text, lang); ids may be missing or repeated.
ODD = [
    (1, "One plain text with more than ten words that nobody needs to reject at all.", "en"),
    (1, "One plain text with more than ten words that nobody needs to reject at all.", "en"),
    (None, "One plain text with more than ten words that nobody needs to reject at all.", "en"),
    (2, None, "de"),
    (3, "", None),
    (4, " \n\t ", None),
    (None, None, None),
    (5, LONG, "en"),
    (6, "12345 !!! 67", "en"),
    (7, "a", "fr"),
    (8, "ééé ñ 日本語 😀 <|endoftext|> </s> ▁x  y", None),
    (9, PLAIN, "en"),
    (10, PLAIN + " too", "en"),
]

#: Columns that operators use inside, as extra columns of the input.
CLASHING = ["row", "id", "key", "words", "lines", "n", "node", "root", "spans", "ids", "rank", "score", "known", "doc", "label", "n_tokens"]


def documents(spark, rows=ODD):
    frame = spark.createDataFrame([(i, t, lang, "src", len(t or "")) for i, t, lang in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in CLASHING:
        frame = frame.selectExpr("*", f"'x' AS `{name}`")
    return frame


def local(frame) -> pd.DataFrame:
    return frame.toPandas()


def table(spark, name):
    return spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
