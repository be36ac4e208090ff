"""Quality rules: a table of thresholds compiled into one Spark projection.

Base counts follow a fixed rule; the thresholds of ``RULES`` give the verdict.
Everything is a column expression over one row, so nothing is shuffled and a hot
source or a group of copies costs no more than other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import SPACES

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = "[#*$%&|<>]"

#: Frequent function words of the languages served (fixed list).
STOP_WORDS = tuple(
    "a an and are as at be by for from has have in is it its of on or that the this to was were which with "
    "au aux avec ce dans de des du elle en est et il la le les mais ne ou par pas pour que qui se sur un une "
    "als auch auf aus bei das dem den der die ein eine einer es für im ist mit nicht sich und von zu zum "
    "al como con del el ella en es esta las lo los más no para pero por que se sin su sus un una y".split()
)

#: name, least and greatest value (None: open).  A document is kept if every
#: ratio lies within its bounds; ratios of a text too short for them are null
#: and pass.
RULES = (
    ("mean_word_chars", 1.5, 20.0),
    ("symbol_ratio", None, 0.1),
    ("mark_ratio", None, 0.5),
    ("stop_ratio", 0.02, None),
    ("dup_line_ratio", None, 0.3),
    ("bullet_line_ratio", None, 0.9),
    ("ellipsis_line_ratio", None, 0.5),
)
#: Words from which on the share of stop words is judged.
STOP_FROM = 50
#: Lines from which on shares of lines are judged.
LINES_FROM = 4


def word_list(text: Column) -> Column:
    """The words of a text (runs of characters other than space, 9 to 13)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES), "")


def count_matches(text: Column, character_class: str) -> Column:
    """Characters of ``text`` in a class."""
    return F.length(text) - F.length(F.regexp_replace(text, character_class, ""))


def window_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)])


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``_words`` (the words) and the counts n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words (long).

    Repeated windows are first told apart by hash; only a text whose hashes
    repeat goes on: its windows are sorted by (hash, words, place), so equal
    ones are neighbours, and the places of those are merged.
    """
    text_of = F.coalesce(F.col(text).cast("string"), F.lit(""))
    out = docs.withColumn("_text", text_of)
    out = out.withColumn("_words", word_list(F.col("_text")))
    out = out.withColumn("n_words", F.size("_words").cast("long"))
    out = out.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda s: s.rlike("[^\\x20\\x09-\\x0D]")))
    words, n = F.col("_words"), F.col("n_words").cast("int")
    places = F.sequence(F.lit(0), n - WINDOW)
    out = out.withColumn("_hashes", F.when(n >= WINDOW, F.transform(places, lambda i: window_hash(words, i))))
    out = out.withColumn("_repeats", F.coalesce(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.lit(False)))
    entries = F.array_sort(F.transform(places, lambda i: F.struct(
        window_hash(words, i).alias("h"), F.slice(words, i + 1, WINDOW).alias("w"), i.alias("i"))))
    out = out.withColumn("_entries", F.when(F.col("_repeats"), entries))
    e = F.col("_entries")
    same = lambda a, b: (a["h"] == b["h"]) & (a["w"] == b["w"])
    marked = F.transform(F.sequence(F.lit(0), F.size(e) - 1), lambda k: F.when(
        F.coalesce((k > 0) & same(F.get(e, k), F.get(e, k - 1)), F.lit(False))
        | F.coalesce(same(F.get(e, k), F.get(e, k + 1)), F.lit(False)), F.get(e, k)["i"]))
    out = out.withColumn("_at", F.when(F.col("_repeats"), F.array_sort(F.array_compact(marked))))
    at = F.col("_at")
    steps = F.zip_with(F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), at,
                       lambda b, a: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    covered = F.aggregate(steps, F.lit(0), lambda s, x: s + x)
    return out.select(
        *docs.columns, "_text", "_words", "_lines", "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        count_matches(F.col("_text"), SYMBOLS).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.col("_repeats") & (F.size(at) > 0), covered).otherwise(0).cast("long").alias("n_repeat_words"),
    )


def ratios() -> dict[str, Column]:
    """The measured ratios, by name."""
    n, lines = F.col("n_words"), F.size("_lines")
    share = lambda kind: F.size(F.filter("_lines", lambda s: s.rlike(kind))) / lines
    stops = F.array(*[F.lit(w) for w in sorted(set(STOP_WORDS))])
    # a stop word counts in any case and with punctuation after it
    found = F.size(F.filter(F.split(F.lower("_text"), "[^\\p{L}]+"), lambda w: F.array_contains(stops, w)))
    enough = lambda c, least, value: F.when(c >= least, value)
    return {
        "mean_word_chars": enough(n, 1, F.col("word_chars") / n),
        "symbol_ratio": enough(n, 1, F.col("n_symbols") / n),
        "mark_ratio": enough(n, 1, count_matches(F.col("_text"), "[!?{}~^\\\\=]") / n),
        "stop_ratio": enough(n, STOP_FROM, found / n),
        "dup_line_ratio": enough(lines, LINES_FROM, F.col("n_dup_lines") / lines),
        "bullet_line_ratio": enough(lines, LINES_FROM, share("^\\s*[-*•‣▪]")),
        "ellipsis_line_ratio": enough(lines, LINES_FROM, share("(\\.\\.\\.|…)\\s*$")),
    }


def quality_rules(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    the ratio of every rule, base_failed and kept.

    Null and empty texts have no words and so fail the base rule.  Every row is
    judged by itself; repeated rows and null ids keep their rows.  Columns of
    ``docs`` with the name of a result are replaced; all others stay, whatever
    their names.
    """
    results = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
               *[name for name, _, _ in rules]]
    own = [c for c in docs.columns if c.lower() not in results]
    # the row travels packed, so its columns meet none of the helpers'
    out = base_counts(docs.select(F.col(f"`{text}`").alias("_in"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("_own")), "_in")
    measured = ratios()
    out = out.withColumns({name: measured[name] for name, _, _ in rules})
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    passes = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            passes &= F.coalesce(F.col(name) >= least, F.lit(True))
        if most is not None:
            passes &= F.coalesce(F.col(name) <= most, F.lit(True))
    out = out.withColumn("base_failed", failed).withColumn("kept", ~failed & passes)
    return out.select("_own.*", *results)


def keep_good(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns."""
    own = docs.columns
    packed = docs.select(F.col(f"`{text}`").alias("text"), F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"))
    judged = quality_rules(packed, "text", rules)
    # beside a row number the verdict is computed once, not again inside the filter
    judged = judged.withColumn("_place", F.monotonically_increasing_id())
    return judged.where(F.col("kept") & (F.col("_place") >= 0)).select("row.*")
