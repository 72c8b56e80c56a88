"""Names against the same rules in plain Python."""

import re
import unicodedata

from pyspark.sql import functions as F

from stillframe.functions.text import sanitise


def plain(name):
    name = re.sub(r"[\s_]+", "-", unicodedata.normalize("NFC", name))
    return re.sub("-{2,}", "-", re.sub(r"[^a-zA-Z0-9\-.]", "", name)).strip("-.")


def test_decomposed_characters_go_whole(spark):
    marks = [chr(p) for p in range(0x300, 0x370)] + ["᪰", "᷀", "⃐", "\U0001d165", "ः"]
    names = [b + m for b in "AaKkxZ9é" for m in marks] + [f"n{a}{b}o{b}{a}" for a in marks[::3] for b in marks[::2]]
    names += ["å ö_ö.jpg", "K1", "Ķ", "a͏̊", "é́", "", "́a"]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", sanitise(F.col("n")).alias("s")).collect()
    assert [(r.n, r.s) for r in got if r.s != plain(r.n)] == []
