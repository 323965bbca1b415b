"""Line-first cleaning: rules per line, then rejection of documents that lose too much."""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words, symbols that are counted, words to a window.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5

#: A line's last character, closing quotes and brackets left aside.
ENDING = r"""[.!?:;…。！？]["'”’»)\]]*[\x20\x09-\x0D]*$"""
SEPARATORS = "|›»·•>"
NAVIGATION = (
    r"(?i)^[\x20\x09-\x0D]*(home|menu|log ?in|sign ?in|sign ?up|register|search|share|next|previous"
    r"|prev|back to top|read more|contact( us)?|about( us)?|help|faq|site ?map|print|comments?)"
    r"([\x20\x09-\x0D]*[|›»·•>/-].*)?[\x20\x09-\x0D]*$"
)
BOILERPLATE = (
    "all rights reserved",
    "cookie policy",
    "cookie settings",
    "privacy policy",
    "terms of use",
    "terms of service",
    "terms and conditions",
    "enable javascript",
    "lorem ipsum",
    "subscribe to our",
    "follow us on",
    "licensed under",
)
MAX_LOST_PERCENT = 50
MAX_SYMBOL_PERCENT = 10
MIN_SEPARATORS = 3


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, also where `use` names it inside a lambda."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(value: Column) -> Column:
    """The value as column `once`, computed once however many later columns use it.

    The optimizer copies a costly expression into each of its uses; it can't see
    through a generator.
    """
    return F.explode(F.array(value)).alias("once")


def count_of(text: Column, characters: str) -> Column:
    """How many of the characters the text has; most texts have none and are only searched."""
    some = text.rlike("[" + re.escape(characters) + "]")
    return F.when(some, F.length(text) - F.length(F.translate(text, characters, ""))).otherwise(0)


def says_any(text: Column, phrases: Sequence[str]) -> Column:
    """Whether the lower-cased text has one of the phrases."""
    return let(
        F.lower(text), lambda x: functools.reduce(operator.or_, [x.contains(p) for p in phrases])
    )


def word_array(text: Column) -> Column:
    """All words; none for a text without any."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, r"[ \t\n\x0B\f\r]+")
    )


def repeated_words(words: Column) -> Column:
    """How many words lie in a window that occurs twice or more, the first one included.

    Windows are compared by a 64-bit hash. A text without equal windows, which is the
    common case, ends at the distinct count; else the windows are sorted to find the equal
    ones, and each adds the words that no earlier one covers. n log n in the words.
    """

    def covered(windows: Column) -> Column:
        keyed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(
            keyed,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(
                        (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]), x["i"]
                    ),
                ),
                lambda p: p.isNotNull(),
            ),
        )
        return let(
            F.sort_array(again),
            lambda p: F.aggregate(
                F.transform(
                    p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))
                ),
                F.lit(0),
                lambda a, b: a + b,
            ),
        )

    hashes = F.transform(words, lambda w: F.xxhash64(w))
    windows = let(
        hashes,
        lambda h: F.transform(
            F.sequence(F.lit(0), F.size(h) - WINDOW),
            lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]),
        ),
    )
    counted = let(
        windows,
        lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(covered(w)),
    )
    return F.when(F.size(words) < WINDOW, F.lit(0)).otherwise(counted)


def line_kept(line: Column, symbols: Column, phrases: Column) -> Column:
    """Whether a line passes the punctuation, navigation and boilerplate rules.

    Punctuation: it ends as a sentence does and has few symbols. Navigation: it is no
    bare menu word and not cut by separators into entries of about three words or fewer.
    Boilerplate: it has none of the known phrases. `symbols` and `phrases` say whether
    the document has any symbol or phrase at all, which spares most lines those rules.
    """
    few = count_of(line, SYMBOLS) * 100 <= F.length(line) * MAX_SYMBOL_PERCENT
    separators = count_of(line, SEPARATORS)
    gaps = count_of(F.btrim(line, F.lit(SPACES)), " \t")
    listed = (separators >= MIN_SEPARATORS) & (gaps <= (separators + 1) * 4)
    return (
        line.rlike(ENDING)
        & F.when(symbols, few).otherwise(True)
        & ~line.rlike(NAVIGATION)
        & ~listed
        & ~F.when(phrases, says_any(line, BOILERPLATE)).otherwise(False)
    )


def clean_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    max_lost_percent: int = MAX_LOST_PERCENT,
) -> DataFrame:
    """Counts, cleaned text and verdict of every document.

    Lines that fail `line_kept` go; a document that has lost more than `max_lost_percent`
    of its word characters, or failed the base counts, is not kept. A null text counts as
    empty, has no words and fails. Lines without a word pass unseen. Equal rows are judged
    alike, each on its own; an empty table gives no rows; other columns are not read. All
    of it is column functions within the row: no shuffle, and no row larger than its text.
    """
    has_word = lambda x: F.btrim(x, F.lit(SPACES)) != ""
    text = F.col("text")
    base = docs.select(
        F.col(id_column).alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )
    of_words = let(
        word_array(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            repeated_words(w).cast("long").alias("n_repeat_words"),
            count_of(text, SYMBOLS).cast("long").alias("n_symbols"),
            says_any(text, BOILERPLATE).alias("phrases"),
        ),
    )
    counted = base.select("doc_id", "text", once(of_words)).select("doc_id", "text", "once.*")
    of_lines = let(
        F.filter(F.split(text, "\n"), has_word),
        lambda lines: F.struct(
            F.size(lines).cast("long").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
            F.filter(
                lines, lambda x: line_kept(x, F.col("n_symbols") > 0, F.col("phrases"))
            ).alias("lines"),
        ),
    )
    n_words, n_repeat = F.col("n_words"), F.col("n_repeat_words")
    left = F.length(F.array_join(F.flatten(F.transform("lines", word_array)), ""))
    lost = F.when(F.size("lines") == F.col("n_lines"), 0).otherwise(F.col("word_chars") - left)
    failed = (n_words < 10) | (n_repeat * 100 > n_words * 20)
    judged = counted.select("*", once(of_lines)).select(*counted.columns, "once.*")
    return judged.select("*", once(F.struct(lost.cast("long").alias("lost_chars")))).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("once.lost_chars") * 100 <= F.col("word_chars") * max_lost_percent)).alias(
            "kept"
        ),
        (F.col("n_lines") - F.size("lines")).cast("long").alias("n_lines_removed"),
        "once.lost_chars",
        F.array_join("lines", "\n").alias("clean_text"),
    )
