"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Words are runs of bytes other than 0x20 and 0x09-0x0D. Defined cases: a null or empty text has no words, all counts
are 0 and it fails; nulls in other columns do not matter; equal rows get equal verdicts; an empty table stays empty.
Columns of the input that clash with a measure's name are left out of the measures' table by ``measure`` (it returns
the key and the measures only); ``keep_good`` returns the input's own columns untouched.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space, symbols, windows and limits of the base rules.
SPACE = r"[ \t\n\x0B\f\r]+"
SYMBOLS = r"[#*$%&|<>]+"
WINDOW = 3
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Bits of a sorted number that hold a window's place; texts of more words compare whole hashes from the start.
PLACE_BITS = 24
MOST_PLACES = 1 << PLACE_BITS

STOP_WORDS = (
    "a an and are as at be by for from had has have he in is it of on or that the they this to was were will with you "
    "au aux ce dans de des du elle en est et il je la le les ne nous on ou par pas pour que qui se sur un une "
    "auch auf das dass dem den der des die ein eine er es für im ist mit nicht sich sie und von zu "
    "al como con del el ella las lo los más no para pero por se su sus una y"
).split()


@dataclass(frozen=True)
class Rule:
    """``low <= 100 * part / whole <= high`` in percent; a missing bound is open. ``whole`` None: the part itself."""

    name: str
    part: str
    whole: str | None = None
    low: int | None = None
    high: int | None = None

    def holds(self) -> Column:
        value = F.col(self.part) * 100 if self.whole else F.col(self.part)
        scale = F.col(self.whole) if self.whole else F.lit(1)
        bounds = [] if self.low is None else [value >= scale * self.low]
        bounds += [] if self.high is None else [value <= scale * self.high]
        out = bounds[0]
        for b in bounds[1:]:
            out = out & b
        return out

    def sql(self) -> str:
        value = f"100 * {self.part}" if self.whole else self.part
        scale = f"{self.whole} * " if self.whole else ""
        parts = [] if self.low is None else [f"{value} >= {scale}{self.low}"]
        parts += [] if self.high is None else [f"{value} <= {scale}{self.high}"]
        return " and ".join(parts)


#: What the method adds to the base rules: length, symbol, stop-word and line ratios.
RULES = (
    Rule("word_length", "word_chars", "n_words", low=200, high=1500),
    Rule("symbols", "n_symbols", "n_words", high=10),
    Rule("stop_words", "n_stop_words", "n_words", low=2),
    Rule("repeated_lines", "n_dup_lines", "n_lines", high=60),
)


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once for a row, however often ``use`` names it."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SPACE), "")


def repeated_window_words(words: Column) -> Column:
    """How many words stand in windows of three that occur twice or more in the same list.

    Sorted numbers made of a part of a window's hash and its place bring windows together that may be equal; only
    those are compared by their whole hash. The covered words are counted from the gaps between the repeats' places.
    Nothing is exploded and the work is n log n for a text of n words.
    """
    n = F.size(words)

    def whole(place: Column) -> Column:
        return F.xxhash64(F.get(words, place), F.get(words, place + 1), F.get(words, place + 2))

    def covered(places: Column) -> Column:
        gap = F.transform(places, lambda a, i: F.least(F.coalesce(F.get(places, i + 1) - a, F.lit(WINDOW)),
                                                       F.lit(WINDOW)))
        return F.aggregate(gap, F.lit(0).cast("bigint"), lambda total, g: total + g)

    def repeats(near: Column) -> Column:
        """Places among ``near`` (hash, place; sorted) whose hash stands there twice."""
        same = F.filter(near, lambda x, i: F.coalesce(x["h"] == F.get(near, i + 1)["h"], F.lit(False))
                        | F.coalesce(x["h"] == F.get(near, i - 1)["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["i"]))

    def exact(places: Column) -> Column:
        pairs = F.transform(places, lambda i: F.struct(whole(i).alias("h"), i.alias("i")))
        return let(F.sort_array(pairs), lambda near: let(repeats(near), covered))

    def close(ordered: Column) -> Column:
        def alike(x: Column, y: Column) -> Column:
            return F.coalesce(F.shiftright(x.bitwiseXOR(y), PLACE_BITS) == 0, F.lit(False))
        found = F.filter(ordered, lambda x, i: alike(x, F.get(ordered, i + 1)) | alike(x, F.get(ordered, i - 1)))
        return F.transform(found, lambda x: x.bitwiseAND(F.lit(MOST_PLACES - 1)).cast("int"))

    packed = F.slice(F.transform(words, lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2))
                                 .bitwiseAND(F.lit(-MOST_PLACES)).bitwiseOR(i.cast("bigint"))), 1, n - 2)
    return (F.when(n < 4, F.lit(0).cast("bigint"))
            .when(n < MOST_PLACES, let(F.sort_array(packed), lambda o: let(close(o), exact)))
            .otherwise(exact(F.sequence(F.lit(0), n - 3))))


def measure(docs: DataFrame, *keys: str, text: str = "text") -> DataFrame:
    """Keys and measures of each text; one projection after the words are split."""
    whole = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(r"[^ \t\n\x0B\f\r]"))
    split = docs.select(*keys, whole.alias("_text"), words_of(whole).alias("_words"), lines.alias("_lines"))
    stops = F.size(F.filter("_words", lambda w: F.lower(w).isin(STOP_WORDS)))
    return split.select(
        *keys,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.regexp_replace("_text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        let(F.col("_words"), repeated_window_words).alias("n_repeat_words"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        stops.cast("bigint").alias("n_stop_words"))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)


def verdict(rules: tuple[Rule, ...] = RULES) -> Column:
    """True for a text that passes the base rules and every rule of the table."""
    out = ~base_failed()
    for rule in rules:
        out = out & rule.holds()
    return out


def judge(docs: DataFrame, *keys: str, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures, base verdict, final verdict and the names of the broken rules of each text."""
    broken = F.array_compact(F.array(*[F.when(~r.holds(), F.lit(r.name)) for r in rules])) if rules else F.array()
    return measure(docs, *keys, text=text).select(
        "*", base_failed().alias("base_failed"), verdict(rules).alias("kept"), broken.alias("broken"))


def keep_good(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows whose text passes, with their own columns."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(text).alias("_t"))
    measured = measure(packed, "_row", text="_t")
    return measured.where(verdict(rules)).select(*[F.col("_row")[c].alias(c) for c in docs.columns])
