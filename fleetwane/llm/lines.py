"""Quality rules, line first: lines that fail a rule go, then documents that lose too much.

A line fails if it is boilerplate (a notice), navigation (many separators or arrows), shouted
or symbol-heavy punctuation, or a short line without end punctuation; a line equal to an
earlier one goes too. A document is kept if it passes the base rules and at least
``MIN_KEPT_PERCENT`` of its words are left.

Defined cases: a null text has no words and no lines, so it fails the base rules; empty lines
count for nothing; repeated rows are judged alike; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetwane.llm.text import WORD_BREAK, n_words, whole, words

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MIN_KEPT_PERCENT = 60

#: A line with fewer words must end like a sentence.
SHORT_LINE = 4
#: Percent of a line's words.
MAX_SEPARATORS = 25
MAX_SHOUTS = 30
#: Percent of a line's characters in words.
MAX_SYMBOLS = 10

SYMBOLS = r"[#*$%&|<>]"
SEPARATORS = ("|", "»", "›", "→", "::")
SHOUTS = r"[!?][!?]"
ENDS = r"""[.!?:;…。]["')\]]?[ \t-\r]*$"""
#: What notices say, in lower case.
NOTICES = (
    "all rights reserved", "copyright (c)", "privacy policy", "terms of use", "terms of service", "cookie policy", "cookie settings",
    "accept cookies", "accept all cookies", "sign up for", "subscribe to our", "click here to", "enable javascript", "powered by",
    "skip to content", "skip to main content", "share on", "share this on",
)


def line_fails(line: Column, low: Column, with_symbols: Column) -> Column:
    """Rules that need the line's words or an expression are tried only where a plain search finds something."""
    count = n_words(line)
    separators = sum((F.length(line) - F.length(F.replace(line, F.lit(x), F.lit("")))) / len(x) for x in SEPARATORS)
    separated, shouted, notice = F.lit(False), F.lit(False), F.lit(False)
    for x in SEPARATORS:
        separated = separated | line.contains(x)
    for x in ("!!", "??", "!?", "?!"):
        shouted = shouted | line.contains(x)
    for x in NOTICES:
        notice = notice | low.contains(x)
    symbols = F.length(line) - F.length(F.regexp_replace(line, SYMBOLS, ""))
    return (
        notice
        | F.when(~line.rlike(ENDS), count < SHORT_LINE).otherwise(False)
        | F.when(separated, 100 * separators > MAX_SEPARATORS * count).otherwise(False)
        | F.when(shouted, 100 * F.regexp_count(line, F.lit(SHOUTS)) > MAX_SHOUTS * count).otherwise(False)
        | F.when(with_symbols, 100 * symbols > MAX_SYMBOLS * F.length(F.regexp_replace(line, WORD_BREAK, ""))).otherwise(False)
    )


def window_hashes(tokens: Column) -> Column:
    """A hash of each run of WINDOW (eight) words, from hashes of runs of one, two and four."""

    def doubled(hashes: Column, step: int) -> Column:
        def pairs(h: Column) -> Column:
            return F.zip_with(h, F.slice(h, F.lit(step + 1), F.size(h)), lambda a, b: F.xxhash64(a, b))

        return F.transform(F.array(hashes), pairs)[0]

    single = F.transform(tokens, lambda w: F.xxhash64(w))
    return F.slice(doubled(doubled(doubled(single, 1), 2), 4), F.lit(1), F.size(tokens) - (WINDOW - 1))


def _repeated_words(row: Column) -> Column:
    """Words in windows found twice or more, from a row with the words ``w`` and the windows in order of hash, ``o``.

    Equal windows are neighbours in that order; their words decide.
    """
    at, tokens = row["o"], row["w"]

    def same(k: Column, j: Column) -> Column:
        a, b = at[k]["i"], at[j]["i"]
        words_equal = F.forall(F.sequence(F.lit(0), F.lit(WINDOW - 1)), lambda d: F.get(tokens, a + d) == F.get(tokens, b + d))
        return F.when(at[k]["h"] == at[j]["h"], words_equal).otherwise(False)

    last = F.size(at) - 1
    twice = F.filter(F.sequence(F.lit(0), last), lambda k: F.when(k > 0, same(k, k - 1)).otherwise(False) | F.when(k < last, same(k, k + 1)).otherwise(False))
    return F.sort_array(F.transform(twice, lambda k: at[k]["i"]))


def _covered(starts: Column) -> Column:
    """Words in windows that begin at the sorted ``starts``."""
    lengths = F.transform(starts, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1), x + WINDOW) - x).cast("long"))
    return F.aggregate(lengths, F.lit(0).cast("long"), lambda total, x: total + x)


def judge(docs: DataFrame) -> DataFrame:
    """doc_id, the figures of the base rules, base_failed, kept, clean_words and clean_text."""
    texts = docs.select("doc_id", whole("text").alias("text"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^ \t-\r]"))
    symbols = F.octet_length("text") - F.octet_length(F.regexp_replace("text", SYMBOLS, ""))
    split = texts.select("doc_id", words(F.col("text")).alias("w"), lines.alias("lines"), symbols.cast("long").alias("n_symbols"))
    hashed = split.withColumn("h", F.when(F.size("w") > WINDOW, window_hashes(F.col("w"))))
    # only a text with two equal hashes is looked at closer
    ordered = F.sort_array(F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    found = hashed.withColumn("o", F.when(F.size(F.array_distinct("h")) < F.size("h"), ordered))
    starts = F.when(F.col("o").isNotNull(), _repeated_words(F.struct("o", "w")))
    both = F.transform("lines", lambda x: F.struct(x.alias("line"), F.lower(x).alias("low")))
    judged = found.withColumn("starts", starts).withColumn("both", both)
    good = F.filter("both", lambda x: ~line_fails(x["line"], x["low"], F.col("n_symbols") > 0))
    figures = judged.select(
        "doc_id",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.array_join("w", "")).cast("long").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("starts").isNotNull(), _covered(F.col("starts"))).otherwise(F.lit(0).cast("long")).alias("n_repeat_words"),
        F.array_join(F.array_distinct(F.transform(good, lambda x: x["line"])), "\n").alias("clean_text"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = figures.withColumn("base_failed", failed).withColumn("clean_words", n_words(F.col("clean_text")))
    return left.withColumn("kept", ~F.col("base_failed") & (100 * F.col("clean_words") >= MIN_KEPT_PERCENT * F.col("n_words")))
