"""Quality rules, line by line: bad lines go first, then documents that lost too much or fail as a whole.

Everything is built-in column functions: one pass over the rows and no shuffle. An array that a lambda reads again
and again is a column of an earlier select, referenced more than once, so that the optimizer doesn't inline it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD_GAP = r"[\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_KEPT_PERCENT = 60  # of the characters in words, after the bad lines are gone
SHORT_LINE, FURNITURE_LINE = 40, 200  # characters: shorter lines must end like a sentence; only shorter lines can be page furniture

# What a sentence ends with, and phrases of pages rather than of texts.
SENTENCE_END = r"[.!?…。！？:;,\"'”’»)\]]\s*$"
BOILERPLATE = (
    r"(?i)\b(enable javascript|javascript is (disabled|required)|accept (all )?cookies|uses? cookies|cookie (policy|settings)|privacy policy|"
    r"terms of (use|service)|all rights reserved|lorem ipsum|click here|sign (in|up)|log ?in|subscribe (now|to our)|skip to (main )?content|"
    r"back to top|share (this|on)|read more|add to cart)\b")


def words_of(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null, empty and blank texts."""
    bare = F.btrim(text, F.lit(GAP_CHARS))
    return F.when(F.coalesce(bare, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(bare, WORD_GAP))


def count_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars``."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def has_word(text: Column) -> Column:
    return text.rlike(r"[^\x20\x09-\x0D]")


def line_reason(line: Column) -> Column:
    """Why a line goes, or null for one that stays. Blank lines stay.

    * ``navigation``: bars separate its parts, at least one for 32 characters
    * ``symbols``: a fifth of its characters are symbols, or doubled exclamation marks come every 16 characters
    * ``boilerplate``: a line of fewer than ``FURNITURE_LINE`` characters with a phrase of page furniture
    * ``punctuation``: a line of fewer than ``SHORT_LINE`` characters that doesn't end like a sentence
    """
    n = F.length(line)
    return (
        F.when(~has_word(line), F.lit(None).cast("string"))
        .when(F.contains(line, F.lit("|")) & (count_of(line, "|") * 32 >= n), F.lit("navigation"))
        .when(line.rlike(f"[{SYMBOLS}]") & (count_of(line, SYMBOLS) * 5 >= n), F.lit("symbols"))
        .when(F.contains(line, F.lit("!!")) & (F.regexp_count(line, F.lit("!{2,}")) * 16 >= n), F.lit("symbols"))
        .when((n < FURNITURE_LINE) & line.rlike(BOILERPLATE), F.lit("boilerplate"))
        .when((n < SHORT_LINE) & ~line.rlike(SENTENCE_END), F.lit("punctuation")))


def quality_rules(df: DataFrame, text: str = "text", min_words: int = MIN_WORDS, max_repeat: int = MAX_REPEAT_PERCENT,
                  min_kept: int = MIN_KEPT_PERCENT) -> DataFrame:
    """Judge every whole text; the columns of ``df`` and one struct ``rules`` (in place of a column of that name).

    ``rules`` holds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (longs), ``base_failed``,
    ``clean_text`` (without the bad lines), ``n_bad_lines``, ``kept_chars`` and ``kept``. A document is kept if the rules on the whole text
    hold (``min_words``, words in repeated 3-word windows at most ``max_repeat`` percent) and the lines that stay have ``min_kept`` percent
    of the characters in words. Null, empty and blank texts have no words and fail. Rows are judged one by one, so ties and repeated rows need no
    rule, an empty table gives an empty one, and further columns are carried along.
    """
    held = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_t"))
    split = held.withColumns({"_w": words_of(F.col("_t")), "_l": F.split("_t", "\n")})
    sized = split.withColumns({"_n": F.size("_w").cast("long"), "_low": F.expr("shiftleft(1L, length(bin(size(_w)))) - 1")})
    window = lambda i: F.xxhash64(F.get("_w", i), F.get("_w", i + 1), F.get("_w", i + 2))
    # Hash and place of each 3-word window in one long: sorted, equal windows are neighbours.
    packed = F.when(F.col("_n") >= 4, F.sort_array(F.transform(
        F.sequence(F.lit(0), F.size("_w") - 3), lambda i: window(i).bitwiseAND(F.bitwise_not("_low")).bitwiseOR(i.cast("long")))))
    placed = sized.withColumn("_p", packed)
    spot = lambda j: F.get("_p", j).bitwiseAND(F.col("_low")).cast("int")
    same = lambda a, b: (F.get("_w", a) == F.get("_w", b)) & (F.get("_w", a + 1) == F.get("_w", b + 1)) & (F.get("_w", a + 2) == F.get("_w", b + 2))
    paired = F.when(F.col("_n") >= 4, F.filter(F.sequence(F.lit(1), F.size("_p") - 1), lambda j: (
        F.get("_p", j).bitwiseXOR(F.get("_p", j - 1)) <= F.col("_low")) & (F.get("_p", j).bitwiseXOR(F.get("_p", j - 1)) >= 0) & same(spot(j), spot(j - 1))))
    doubled = placed.withColumn("_d", F.coalesce(paired, F.array().cast("array<int>")))
    cover = F.flatten(F.transform("_d", lambda j: F.array(*[spot(k) + o for k in (j, j - 1) for o in range(3)])))
    lined = F.filter("_l", has_word)
    counted = doubled.select(
        "_row", "_t", "_n", "_l", F.length(F.array_join("_w", "")).cast("long").alias("_chars"),
        F.when(F.size("_d") > 0, F.size(F.array_distinct(cover))).otherwise(0).cast("long").alias("_rep"),
        (F.size(lined) - F.size(F.array_distinct(lined))).cast("long").alias("_dup"), F.filter("_l", lambda x: line_reason(x).isNull()).alias("_s"))
    joined = counted.withColumn("_clean", F.when(F.size("_s") == F.size("_l"), F.col("_t")).otherwise(F.array_join("_s", "\n")))
    # The row number is never negative. It keeps a later filter on the verdict from being pushed below, where the
    # arrays would be computed again for every element.
    left = joined.withColumns({
        "_left": F.when(F.size("_s") == F.size("_l"), F.col("_chars")).otherwise(F.length(F.translate("_clean", GAP_CHARS, "")).cast("long")),
        "_symbols": F.when(F.col("_t").rlike(f"[{SYMBOLS}]"), count_of(F.col("_t"), SYMBOLS)).otherwise(0).cast("long"),
        "_id": F.monotonically_increasing_id()})
    failed = (F.col("_n") < min_words) | (100 * F.col("_rep") > max_repeat * F.col("_n"))
    kept = (F.col("_id") >= 0) & ~failed & (100 * F.col("_left") >= min_kept * F.col("_chars"))
    rules = F.struct(
        F.col("_n").alias("n_words"), F.col("_chars").alias("word_chars"), F.col("_symbols").alias("n_symbols"),
        F.col("_dup").alias("n_dup_lines"), F.col("_rep").alias("n_repeat_words"), failed.alias("base_failed"), F.col("_clean").alias("clean_text"),
        (F.size("_l") - F.size("_s")).cast("long").alias("n_bad_lines"), F.col("_left").alias("kept_chars"), kept.alias("kept"))
    return left.select(*[F.col("_row").getField(c).alias(c) for c in df.columns if c != "rules"], rules.alias("rules"))
