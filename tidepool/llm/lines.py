"""Line-first cleaning with DataFrame functions only.

Every line of a text is judged by its own punctuation, navigation and boilerplate rules.  Lines that
fail are removed, and a document that loses too much of its text that way is rejected.  The work is
one narrow pass: no shuffle, no Python, nothing larger than one document in memory.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

# What ends a sentence in any script (Unicode's sentence terminals of the scripts in
# wide use, and the ellipsis), what may close it, what separates menu entries, what boilerplate says.
SENTENCE_ENDS = (
    ".!?\u2026\u0589\u061d\u061e\u061f\u06d4\u0700\u0701\u0702\u0964\u0965\u104a\u104b\u1362\u1367\u1368"
    "\u166e\u1803\u1809\u17d4\u17d5\u1944\u1945\u203c\u203d\u2047\u2048\u2049\u2e2e\u3002\ua4ff\ua60e"
    "\ua60f\ua876\ua877\ua8ce\ua8cf\ufe52\ufe56\ufe57\uff01\uff0e\uff1f\uff61")
CLOSING = "\"')]}*_\u2019\u201c\u201d\u00bb\u203a\u300b\u300d\u300f\uff02\uff09"
BLANK = " \t\n\x0b\x0c\r\u00a0\u3000"
SEPARATORS = ("|", ">", ">>", "»", "›", "·", "•")
BOILERPLATE = (
    "all rights reserved", "click here", "cookie policy", "enable javascript",
    "javascript is disabled", "licensed under", "log in to", "lorem ipsum", "privacy policy",
    "sign up for", "subscribe to our", "terms of service", "terms of use", "use of cookies",
)


@dataclass(frozen=True)
class LineRules:
    """Limits of the rules.  All comparisons are on whole numbers, so they mean the same anywhere."""

    short_line: int = 12          # a line with fewer words must end like a sentence
    symbol_percent: int = 10      # more symbol characters than this share fail
    shout_words: int = 3          # a "!!" for every so many words fails
    separator_words: int = 3      # two separators or more, one for every so many words, fail
    max_lost_percent: int = 40    # a document that loses more of its line characters is rejected
    min_words: int = 20
    max_repeat_percent: int = 30
    window: int = 8


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def any_of(conditions: list[Column]) -> Column:
    out = conditions[0]
    for more in conditions[1:]:
        out = out | more
    return out


def symbols_in(text: Column) -> Column:
    return F.length(text) - F.length(F.regexp_replace(text, f"[{SYMBOLS}]+", ""))


def ends_a_sentence(line: Column) -> Column:
    """Whether the last character of a line, white space and closing marks aside, ends a sentence."""
    last = F.right(F.rtrim(line, F.lit(BLANK + CLOSING)), F.lit(1))
    return (last != "") & F.lit(SENTENCE_ENDS).contains(last)


def line_passes(line: Column, rules: LineRules, symbols: Column) -> Column:
    """True if the line meets the punctuation, navigation and boilerplate rules.

    ``symbols`` counts those of the whole text: where there are none, no line needs to be searched.
    """
    def judge(words):
        n = F.size(words)
        shouts = (F.length(line) - F.length(F.replace(line, F.lit("!!"), F.lit("")))) / 2
        separators = F.size(F.filter(words, lambda w: w.isin(*SEPARATORS)))
        punctuated = (n >= rules.short_line) | ends_a_sentence(line)
        few_symbols = (symbols == 0) | (
            symbols_in(line) * 100 <= F.length(line) * rules.symbol_percent)
        calm = ~line.contains("!!") | (shouts * rules.shout_words < n)
        prose = ~any_of([line.contains(s) for s in SEPARATORS]) | (separators < 2) | (
            separators * rules.separator_words < n)
        boilerplate = let(F.lower(line), lambda lower: any_of(
            [lower.contains(s) for s in BOILERPLATE]))
        return punctuated & few_symbols & calm & prose & ~boilerplate

    return let(words_of(line), judge)


def repeated_words(words: Column, window: int) -> Column:
    """How many words lie in a window of ``window`` words that occurs twice or more in the text."""
    def grams(hashes):
        return F.when(F.size(hashes) >= window, F.transform(
            F.sequence(F.lit(0), F.size(hashes) - window),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(window)]))
        ).otherwise(F.array().cast("array<bigint>"))

    def covered(places):
        last = F.size(places) - 1
        steps = F.transform(places, lambda p, k: F.when(k == last, window).otherwise(
            F.least(F.lit(window), F.get(places, k + 1) - p)))
        return F.aggregate(steps, F.lit(0), lambda a, s: a + s)

    def places(ordered):
        def met_again(p, k):
            here = p["h"]
            return (((k > 0) & (F.get(ordered, k - 1)["h"] == here))
                    | F.coalesce(F.get(ordered, k + 1)["h"] == here, F.lit(False)))

        return let(F.array_sort(F.transform(F.filter(ordered, met_again), lambda p: p["i"])), covered)

    def count(hashes):
        once = F.size(F.array_distinct(hashes)) == F.size(hashes)
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.when(once, F.lit(0)).otherwise(let(F.sort_array(pairs), places))

    return let(let(F.transform(words, lambda w: F.xxhash64(w)), grams), count)


def line_quality(docs: DataFrame, rules: LineRules | None = None, text: str = "text",
                 key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: counts, the verdict and the cleaned text.

    A null text counts as empty, and an empty text has no words, so both fail for being too short.
    Lines without a word are neither judged nor counted.  Equal rows get equal answers; other
    columns of ``docs`` are not looked at.  Windows of words are compared by their 64-bit hashes
    within one document.
    """
    rules = rules or LineRules()
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    base = docs.select(F.col(f"`{key}`").alias("doc_id"), t.alias("text"))
    parts = base.select("doc_id", "text", words_of(F.col("text")).alias("words"), F.filter(
        F.split("text", "\n"), lambda s: s.rlike(WORD)).alias("lines"))
    counted = parts.withColumn("n_symbols", symbols_in(F.col("text")).cast("long"))
    judged = counted.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words"), rules.window).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        _characters(F.col("lines")).alias("line_chars"),
        F.filter("lines", lambda s: line_passes(s, rules, F.col("n_symbols"))).alias("clean"))
    measured = judged.select(
        *[c for c in judged.columns if c != "clean"],
        F.size("clean").cast("long").alias("n_clean_lines"),
        _characters(F.col("clean")).alias("clean_chars"),
        F.array_join("clean", "\n").alias("clean_text"),
        ((F.col("n_words") < rules.min_words) | (
            100 * F.col("n_repeat_words") > rules.max_repeat_percent * F.col("n_words"))
         ).alias("base_failed"))
    lost = (F.col("line_chars") - F.col("clean_chars")) * 100
    return measured.withColumn("kept", ~F.col("base_failed") & (
        lost <= F.col("line_chars") * rules.max_lost_percent))


def _characters(lines: Column) -> Column:
    return F.aggregate(lines, F.lit(0).cast("long"), lambda a, s: a + F.length(s))
