"""Statistics of whole texts as Spark column expressions. A null text counts as empty; every statistic is then 0.

What several statistics need (words, lines, hashes of windows) is a column of its own, made once a row, so that sorting and
telling apart run in generated code on plain numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import SPACES, words_of

#: The characters that count as symbols, and the width of a repeated window.
SYMBOLS = "[#*$%&|<>]"
WINDOW = 5


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("bigint")


def text_lines(text: Column) -> Column:
    """The lines, parted by newlines, that hold a word."""
    return F.filter(F.split(text, "\n", -1), lambda line: F.length(F.trim(line, F.lit(SPACES))) > 0)


def _beside(a: Column, b: Column, shift: int) -> Column:
    """The hash of a[i] and b[i + shift] for every i that has both."""
    n = F.greatest(F.size(b) - shift, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(shift + 1), n), lambda x, y: F.xxhash64(x, y))


def _covered(places: Column, width: int) -> Column:
    """How many words lie in windows that begin at the places, which rise."""
    steps = F.zip_with(F.slice(places, F.lit(2), F.greatest(F.size(places) - 1, F.lit(0))), F.slice(places, F.lit(1), F.greatest(F.size(places) - 1, F.lit(0))), lambda b, a: F.least(b - a, F.lit(width)))
    return F.when(F.size(places) > 0, F.aggregate(steps, F.lit(width).cast("bigint"), lambda total, x: total + x)).otherwise(F.lit(0).cast("bigint"))


def with_repeated_words(df: DataFrame, words: str = "_words") -> DataFrame:
    """Adds n_repeat_words: words inside windows of WINDOW words that occur twice or more in the text, the first included.

    Windows are told apart by a 64-bit hash: among 20,000 windows of a text, two different ones agree with a chance of 1e-11.
    Only a text with equal hashes has its windows sorted with their places, n log n in the words of that text.
    """
    one = df.withColumn("_one", F.transform(words, lambda w: F.xxhash64(w)))
    two = one.withColumn("_two", _beside(F.col("_one"), F.col("_one"), 1))
    four = two.withColumn("_four", _beside(F.col("_two"), F.col("_two"), 2))
    five = four.withColumn("_five", _beside(F.col("_four"), F.col("_one"), 4)).drop("_one", "_two", "_four")
    told = five.withColumn("_again", F.size(F.array_distinct("_five")) < F.size("_five"))
    placed = F.when(F.col("_again"), F.sort_array(F.transform("_five", lambda h, p: F.struct(h.alias("h"), p.alias("p"))))).otherwise(F.array().cast("array<struct<h:bigint,p:int>>"))
    ordered = told.withColumn("_placed", placed).drop("_five", "_again")
    twice = F.filter("_placed", lambda x, i: (F.get("_placed", i - 1)["h"] == x["h"]) | (F.get("_placed", i + 1)["h"] == x["h"]))
    again = ordered.withColumn("_places", F.sort_array(F.transform(twice, lambda x: x["p"]))).drop("_placed")
    return again.withColumn("n_repeat_words", _covered(F.col("_places"), WINDOW)).drop("_places")


def with_counts(df: DataFrame, text: str = "text") -> DataFrame:
    """df without its text, with plain counts of it."""
    cleaned = df.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).drop(text)
    parted = cleaned.withColumns({"_words": words_of(F.col("_text")), "_lines": text_lines(F.col("_text"))})
    t, w, lines = F.col("_text"), F.col("_words"), F.col("_lines")
    counted = parted.withColumns(
        {
            "n_words": F.size(w).cast("bigint"),
            "word_chars": F.length(F.array_join(w, "")).cast("bigint"),
            "n_symbols": count_of(t, SYMBOLS),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint"),
            "n_lines": F.size(lines).cast("bigint"),
            "n_upper": count_of(t, r"\p{Lu}"),
            "n_digits": count_of(t, "[0-9]"),
            "n_marks": count_of(t, "[!?]"),
            "n_bars": count_of(t, r"\|"),
            "n_stops": count_of(t, "[.,;:]"),
            "n_neighbours": F.size(F.filter(F.zip_with(F.slice(w, F.lit(2), F.size(w)), w, lambda a, b: a == b), lambda same: same)).cast("bigint"),
            "n_kinds": F.size(F.array_distinct(w)).cast("bigint"),
        }
    ).drop("_text", "_lines")
    return with_repeated_words(counted).drop("_words")


def ratios() -> dict[str, Column]:
    """Shares over the columns of with_counts(), in 0 to about 1 for most texts; 0 where there is nothing to divide by."""

    def share(top: str, bottom: str) -> Column:
        return F.col(top).cast("double") / F.greatest(F.col(bottom), F.lit(1)).cast("double")

    return {
        "symbol_share": share("n_symbols", "n_words"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "upper_share": share("n_upper", "word_chars"),
        "digit_share": share("n_digits", "word_chars"),
        "mark_share": share("n_marks", "n_words"),
        "bar_share": share("n_bars", "n_words"),
        "stop_share": share("n_stops", "n_words"),
        "neighbour_share": share("n_neighbours", "n_words"),
        "kinds_share": share("n_kinds", "n_words"),
        "mean_word": share("word_chars", "n_words"),
        "log_words": F.log1p(F.col("n_words").cast("double")),
    }


FEATURES = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share", "bar_share", "stop_share", "neighbour_share", "kinds_share", "mean_word", "log_words")
