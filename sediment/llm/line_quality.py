"""Line-first quality rules: each line is judged, failing lines go, and a document that loses too
much of its text that way, or fails a rule on the whole, is rejected.

Only built-in functions, row by row: nothing is shuffled, and a row is the largest unit of work.
Repeated five-word windows are found inside a row by sorting the windows' hashes, and only in texts
whose windows are not all different.

Null and empty texts have no words, fail the base rules and lose nothing. Repeated rows are judged
alike; an empty table gives an empty result; other columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A line fails if so many percent of its characters are symbols,
MAX_SYMBOL_PERCENT = 10
#: or if so many exclamation and question marks stand on a word,
MAX_MARKS_PER_WORD = 0.5
#: or if it has at least so many fields between bars (a menu or the row of a table),
MIN_BARS = 2
#: or if it is a phrase of page furniture.
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "privacy policy",
    "terms of service",
    "terms of use",
    "click here",
    "read more",
    "sign in",
    "log in",
    "subscribe",
    "lorem ipsum",
    "javascript",
)
#: A document is rejected if its failing lines hold more than so many percent of its characters.
MAX_LOST_PERCENT = 50


def count_of(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def words(text: Column) -> Column:
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda word: word != "")


def line_fails(line: Column) -> Column:
    """Punctuation (symbols, marks), navigation (bars) and boilerplate rules on one line.

    A line without words never fails: there is nothing to lose.
    """
    low = F.lower(line)
    bare = F.length(F.translate(line, WHITE, ""))
    n_words = F.size(F.split(F.trim(line), " "))
    return (bare > 0) & (
        (count_of(line, SYMBOLS) * 100 > bare * MAX_SYMBOL_PERCENT)
        | (count_of(line, "!?") > n_words * MAX_MARKS_PER_WORD)
        | (count_of(line, "|") >= MIN_BARS)
        | ((n_words <= 12) & F.rlike(low, F.lit("|".join(BOILERPLATE))))
    )


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value`` worked out once, also where ``body`` uses it inside a loop over an array."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def window_hashes(n_words: Column, hashes: Column) -> Column:
    """The hash of each five-word window, from the hashes of the words."""
    return let(
        hashes,
        lambda h: F.transform(
            F.sequence(F.lit(0), n_words - WINDOW), lambda i: F.xxhash64(*(F.get(h, i + k) for k in range(WINDOW)))
        ),
    )


def repeated_words(hashes: Column) -> Column:
    """How many words lie in a window that occurs twice or more, from the hashes of all windows."""

    def again(order: Column) -> Column:
        # Windows sorted by hash, then place: those with the same hash as a neighbour are repeated.
        marked = F.transform(
            order,
            lambda x, j: F.when(
                ((j > 0) & (F.get(order, F.greatest(j - 1, F.lit(0)))["h"] == x["h"]))
                | F.coalesce(F.get(order, j + 1)["h"] == x["h"], F.lit(False)),
                x["i"],
            ),
        )
        return F.sort_array(F.array_compact(marked))

    def covered(places: Column) -> Column:
        # A repeated window adds the words up to the next repeated window, at most its own.
        steps = F.transform(
            places, lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0), lambda total, step: total + step)

    order = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return let(let(order, again), covered)


def line_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept``, ``n_failed_lines``, ``lost_chars`` and
    ``kept_text``, the lines that passed.

    The base rules fail a text of fewer than 10 words, or one in which more than a fifth of the words
    lie in five-word windows that occur twice or more. Windows are compared by 64-bit hashes.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text"))
    rows = rows.select("_id", "_text", words(F.col("_text")).alias("_words"))
    word_hashes = F.transform("_words", lambda word: F.xxhash64(word))
    windows = F.when(F.size("_words") >= WINDOW, window_hashes(F.size("_words"), word_hashes))
    lines = F.split("_text", "\n")
    rows = rows.select("_id", "_text", F.size("_words").alias("_n"), windows.alias("_windows"), lines.alias("_lines"))
    solid = F.filter("_lines", lambda line: F.length(F.translate(line, WHITE, "")) > 0)
    failing = F.filter("_lines", line_fails)
    rows = rows.select(
        "_id",
        "_text",
        "_n",
        "_windows",
        "_lines",
        failing.alias("_failing"),
        (F.size(solid) - F.size(F.array_distinct(solid))).alias("_dup"),
    )
    repeated = F.when(
        F.size(F.array_distinct("_windows")) < F.size("_windows"), repeated_words(F.col("_windows"))
    ).otherwise(0)
    whole = F.length(F.translate("_text", WHITE, ""))
    lost = F.length(F.translate(F.array_join("_failing", ""), WHITE, ""))
    rows = rows.select(
        "_id",
        F.col("_n").cast("long").alias("n_words"),
        whole.cast("long").alias("word_chars"),
        count_of(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        F.col("_dup").cast("long").alias("n_dup_lines"),
        F.coalesce(repeated, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_failing").cast("long").alias("n_failed_lines"),
        lost.cast("long").alias("lost_chars"),
        F.when(F.size("_failing") == 0, F.col("_text"))
        .otherwise(F.array_join(F.filter("_lines", lambda line: ~line_fails(line)), "\n"))
        .alias("kept_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return rows.select(
        F.col("_id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars"))).alias("kept"),
        "n_failed_lines",
        "lost_chars",
        "kept_text",
    )
