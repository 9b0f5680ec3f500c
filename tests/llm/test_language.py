"""Languages that few documents declare."""

from __future__ import annotations

from pyspark.sql import functions as F

from sediment.llm import language
from sediment.llm.base import prepare

COMMON = {
    "en": "the house and the garden of the other people were there with this thing",
    "de": "der garten und das haus der anderen leute waren nicht mit diesem ding",
}
RARE = {
    "el": "το σπίτι και ο κήπος των άλλων ανθρώπων ήταν εκεί με αυτό το πράγμα",
    "fi": "talo ja muiden ihmisten puutarha olivat siellä tämän asian kanssa",
}


def test_rare_languages_are_kept(spark):
    """9 documents of 10,000 have a language of their own, also in the source of a common one."""
    prepare(spark)
    rows = [(i, COMMON["de" if i % 10 == 0 else "en"] + f" {i}", "de" if i % 10 == 0 else "en", "hot") for i in range(9982)]
    rows += [(20_000 + i, RARE["el"] + f" {i}", "el", "hot") for i in range(9)]
    rows += [(30_000 + i, RARE["fi"] + f" {i}", "fi", "hot") for i in range(8)] + [(30_008, RARE["fi"], None, "hot")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    found = language.languages_of(df, F.col("lang"), F.col("source"), F.lit(None)).collect()
    found = {r["doc_id"]: r for r in found}
    assert all((found[i]["language"], found[i]["kept"]) == ("el", True) for i in range(20_000, 20_009))
    assert all((found[i]["language"], found[i]["kept"]) == ("fi", True) for i in range(30_000, 30_009))
    assert all(found[i]["language"] == ("de" if i % 10 == 0 else "en") for i in range(9982))


def test_many_languages(spark):
    prepare(spark)
    codes = [a + b for a in "abcdefgh" for b in "nopqrstu"]
    text = {c: " ".join(f"{c}{x}{y}{c[::-1]}" for x in "aeiou" for y in "klmpr") for c in codes}
    rows = [(i, text[codes[i % 64]], codes[i % 64], "s") for i in range(192)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = language.languages_of(df, F.col("lang"), F.col("source"), F.lit(None)).collect()
    assert {r["doc_id"]: r["language"] for r in found} == {i: codes[i % 64] for i in range(192)}


def test_declarations_that_are_no_codes(spark):
    """20,000 declarations of free text: none is an outcome, none reaches the driver."""
    prepare(spark)
    noise = [None, "", "none of it", "e n", "zzz", "x", "123", "englisch"]
    rows = [(i, COMMON["en"] + f" {i}", f"text {i}" if i % 2 else noise[i // 2 % len(noise)], "s") for i in range(20_000)]
    rows += [(30_000 + i, COMMON["en"] + f" {i}", ["en-US", " EN ", "en_gb"][i % 3], "s") for i in range(30)]
    rows += [(40_000 + i, COMMON["de"] + f" {i}", "de-AT", "t") for i in range(30)]
    rows += [(50_000 + i, RARE["el"] + f" {i}", "ceb", "u") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4)
    found = language.languages_of(df, F.col("lang"), F.col("source"), F.lit(None)).groupBy("language").count()
    assert dict(map(tuple, found.collect())) == {"en": 20_030, "de": 30, "ceb": 30}
