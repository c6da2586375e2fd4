"""Words are cut without a pattern, and few windows reach the comparison."""

import re

from pyspark.sql import functions as F

from replyscope.llm import decontamination as decon

ODD = [
    None, "", "   ", "A", "\x00a\x00B\x7f", "".join(map(chr, range(128))), "Ärger ä İx KK", "a b   c\u0085d",
    "\U0001f600X-y_Z\U0001f600", " lead and trail ", "x\r\ny\tz", "café CAFÉ",
]


def plain_words(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def test_words_of_odd_texts(spark):
    rows = spark.createDataFrame(list(enumerate(ODD)), "id int, text string")
    found = rows.select("id", decon.words_of(F.col("text")).alias("w"), decon.count_of_words(F.col("text")).alias("n")).collect()
    assert {row["id"]: (row["w"], row["n"]) for row in found} == {at: ((w := plain_words(text)), len(w)) for at, text in enumerate(ODD)}


def test_words_need_no_pattern(spark, capsys):
    rows = spark.createDataFrame([(1, "a")], "id int, text string")
    rows.select(decon.words_of(F.col("text")), decon.count_of_words(F.col("text"))).explain()
    assert "regexp" not in capsys.readouterr().out.lower()


def test_few_other_windows_are_compared(spark):
    text = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(4999)), lambda at: F.concat(F.lit("w"), F.pmod(F.xxhash64("id", at), F.lit(100_000)))), " ")
    items = spark.range(0, 2).select(F.col("id").alias("item_id"), text.alias("text"))
    docs = spark.range(2, 6).select(F.col("id").alias("doc_id"), text.alias("text"))
    windows = decon.benchmark_windows(items).cache()
    bits = decon.bits_of({13: windows.count()})[13]
    words = F.col("w")
    hits = decon.hit_places(words, decon.bitmap_of(windows, 13, bits), 13, bits)
    through = docs.select(decon.words_of(F.col("text")).alias("w")).select(F.sum(F.size(hits))).first()[0]
    inside = items.select(decon.words_of(F.col("text")).alias("w")).select(F.sum(F.size(hits))).first()[0]
    windows.unpersist()
    # One in 32 to 64 of 20,000 windows came through when all words made the only hash
    assert through < 150
    assert inside == 2 * (5000 - 12)
