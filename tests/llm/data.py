"""Small odd tables: NULLs, empty and long texts, repeated rows, columns with names that operators use."""

import os
import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row long, score double, doc string, key long, n long, start long, _row long"
WORDS = {
    "en": "the that with ing tion house river water morning letter and for of in".split(),
    "de": "und der die nicht schön straße über mit ein haus fluss wasser auch zu".split(),
    "fr": "le la les été garçon où très avec maison eau être pour des une".split(),
}


def prose(lang, words, seed):
    rng = random.Random(f"{lang}{seed}")
    return " ".join(rng.choice(WORDS[lang]) + rng.choice(["", "", ",", "."]) for _ in range(words))


def odd_rows():
    """(doc_id, text, lang, source)"""
    base = prose("en", 60, 1)
    rows = [(i, prose(("en", "de", "fr")[i % 3], 20 + i % 37, i), ("en", "de", "fr")[i % 3], f"s{i % 4}") for i in range(100, 160)]
    rows += [
        (1, base, "en", "s0"), (2, base, "en", "s1"), (3, base.upper(), "en", None), (4, base + " tail", "en", "s0"),
        (5, None, "en", "s0"), (6, "", "en", "s0"), (7, " \n\t ", "en", "s1"), (8, "12345 !!! ...", None, "s1"), (9, "one two", "en", "s2"),
        (10, "one two", "en", "s2"), (10, "one two", "en", "s2"), (11, prose("de", 3000, 5), "de", None), (11, prose("fr", 30, 6), None, "s3"),
        (None, prose("fr", 40, 7), "fr", "s3"), (12, "x" * 20000, "en", "s3"), (13, "中文文本 という", None, "s3"), (14, "🎉 ok", "en", "é"),
        (15, prose("en", 40, 8) + " token = 'abcdefgh1234' mail a.b@c.example.org +1 (234) 555-6789", "en", "s0"),
    ]
    return rows


def odd_documents(spark, rows=None):
    rows = odd_rows() if rows is None else rows
    full = [(d, t, lang, s, None if t is None else len(t), 7, 0.5, "x", 1, 2, 3, None) for d, t, lang, s in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def written(df, tmp_path, name="documents"):
    """A table folder that holds the frame."""
    df.write.mode("overwrite").parquet(os.path.join(str(tmp_path), f"{name}.parquet"))
    return str(tmp_path)
