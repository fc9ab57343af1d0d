"""Quality rules: a table of thresholds compiled into one Spark projection, without user functions.

Each rule names a measure and the range in which a text passes. ``measures`` turns a text column into a struct of
counts by built-in functions only; ``compile_rules`` turns the table into columns over it. Adding a rule is adding a row.

Edge cases: a null text is an empty one; a text without words has all counts 0, fails ``enough_words`` and nothing else (ratios over
0 words are null and pass). Repeated rows are judged one by one. All input columns are kept; result columns of ``apply_rules`` stand
in one struct named by the caller, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import let

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MARK = r"[\x21-\x40\x5B-\x60\x7B-\x7E]"  # ASCII digits and punctuation
CAPITAL = r"\p{Lu}"

# Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in a is that it for as was with be by on not he his but at are this have from or had an they which "
    "le la les de des du et un une en est que qui dans pour au aux par sur pas ne se ce plus son "
    "der die das und den dem ein eine von zu mit sich auf für ist im nicht des als auch es an er "
    "el los las y del que se por con una su para al lo como más o"
).split()


@dataclass(frozen=True)
class Rule:
    """A text passes if ``least <= measure <= most``; a null measure passes."""

    name: str
    measure: str
    least: float | None = None
    most: float | None = None


def ratio(top: str, bottom: str) -> str:
    return f"{top} / nullif({bottom}, 0)"


# The first two are the base; they are compared in whole numbers.
BASE_RULES = (
    Rule("enough_words", "n_words", least=50),
    Rule("few_repeats", "100 * n_repeat_words - 50 * n_words", most=0),
)
RULES = BASE_RULES + (
    Rule("symbols_per_word", ratio("n_symbols", "n_words"), most=0.5),
    Rule("repeated_lines", ratio("n_dup_lines", "n_lines"), most=0.5),
    Rule("stop_words", ratio("n_stop_words", "n_words"), least=0.04),
    Rule("capitals", ratio("n_capitals", "word_chars"), most=0.4),
    Rule("word_length", ratio("word_chars", "n_words"), least=2.0, most=20.0),
    Rule("marks", ratio("n_marks", "word_chars"), most=0.4),
)


def repeat_words(words: Column) -> Column:
    """The number of words that stand in a window of three words found twice or more.

    Windows are sorted as one long each (hash bits above, position below); only neighbours that agree in the hash bits are
    looked at as words, so the count is exact and the work is n log n for texts of any length.
    """

    def over(w: Column) -> Column:
        n = F.size(w) - 2
        return let(F.struct(n.alias("n"), (F.length(F.bin(n.cast("long"))) + 1).alias("bits")), lambda z: keyed(w, z))

    def keyed(w: Column, z: Column) -> Column:
        low = F.call_function("shiftleft", F.lit(1).cast("long"), z["bits"]) - 1
        masks = F.struct(low.alias("low"), F.bitwise_not(low).alias("high"))
        return let(masks, lambda m: sorted_keys(w, z, m["low"], m["high"]))

    def sorted_keys(w: Column, z: Column, low: Column, high: Column) -> Column:
        keys = F.transform(
            F.slice(w, F.lit(1), z["n"]),
            lambda x, i: F.xxhash64(x, w[i + 1], w[i + 2]).bitwiseAND(high).bitwiseOR(i.cast("long")),
        )
        return let(F.sort_array(keys), lambda k: let(_candidates(k, low, high), lambda ps: _marked(w, ps)))

    return F.when(F.size(words) < 3, F.lit(0)).otherwise(let(words, over)).cast("long")


def _candidates(keys: Column, low: Column, high: Column) -> Column:
    """Positions whose window has the hash bits of a neighbour in sorted order."""

    def agree(other: int) -> Column:
        return F.filter(keys, lambda x, i: x.bitwiseXOR(F.get(keys, i + other)).bitwiseAND(high) == 0)

    def both(later: Column) -> Column:
        found = F.array_distinct(F.concat(later, agree(1)))
        return F.when(F.size(later) == 0, F.lit(None)).otherwise(F.transform(found, lambda x: x.bitwiseAND(low).cast("int")))

    return let(agree(-1), both)


def _marked(words: Column, positions: Column) -> Column:
    windows = F.sort_array(
        F.transform(
            positions,
            lambda p: F.struct(
                words[p].alias("a"), words[p + 1].alias("b"), words[p + 2].alias("c"), p.alias("p")
            ),
        )
    )

    def same(x: Column, y: Column) -> Column:
        return (x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"])

    def twice(s: Column) -> Column:
        last = F.size(s) - 1
        return F.filter(
            s,
            lambda x, i: ((i > 0) & same(x, s[F.greatest(i - 1, F.lit(0))]))
            | ((i < last) & same(x, s[F.least(i + 1, last)])),
        )

    def covered(s: Column) -> Column:
        ps = F.array_sort(F.transform(twice(s), lambda x: x["p"]))
        # In order, a window adds as many words as it lies beyond the one before it, three at most.
        return let(
            ps,
            lambda q: F.aggregate(
                F.transform(q, lambda p, i: F.when(i == 0, F.lit(3)).otherwise(F.least(F.lit(3), p - q[F.greatest(i - 1, F.lit(0))]))),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )

    return F.when(positions.isNull(), F.lit(0)).otherwise(let(windows, covered))


def measures(text: Column) -> Column:
    """A struct of counts of a text."""

    def counted(words: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.concat_ws("", words)).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
            F.size(lines).cast("long").alias("n_lines"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            repeat_words(words).alias("n_repeat_words"),
            F.size(F.filter(words, lambda w: F.lower(w).isin(STOP_WORDS))).cast("long").alias("n_stop_words"),
            F.regexp_count(text, F.lit(MARK)).cast("long").alias("n_marks"),
            F.regexp_count(text, F.lit(CAPITAL)).cast("long").alias("n_capitals"),
        )

    return let(F.filter(F.split(text, SPACE), lambda w: w != ""), counted)


def compile_rules(rules: tuple[Rule, ...] = RULES) -> list[Column]:
    """One boolean per rule over the columns of ``measures``: true where the text fails."""
    columns = []
    for rule in rules:
        value = F.expr(rule.measure)
        fails = F.lit(False)
        if rule.least is not None:
            fails = fails | (value < rule.least)
        if rule.most is not None:
            fails = fails | (value > rule.most)
        columns.append(F.coalesce(fails, F.lit(False)).alias(rule.name))
    return columns


def apply_rules(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``row`` (all input columns), the counts, ``failed`` (names of failed rules), ``base_failed`` and ``kept``."""
    counts = docs.select(
        F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"),
        measures(F.coalesce(F.col(text_col), F.lit(""))).alias("m"),
    ).select("row", "m.*")
    verdicts = counts.select("*", F.struct(*compile_rules(rules)).alias("v"))
    base = {r.name for r in BASE_RULES}
    failed = F.array_compact(F.array(*(F.when(F.col(f"v.{r.name}"), F.lit(r.name)) for r in rules)))
    base_failed = F.lit(False)
    for r in rules:
        if r.name in base:
            base_failed = base_failed | F.col(f"v.{r.name}")
    out = verdicts.select("*", failed.alias("failed"), base_failed.alias("base_failed")).drop("v")
    return out.withColumn("kept", F.size("failed") == 0)


def kept_rows(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows that no rule rejects, all columns as they are; a narrow pass.

    The verdict goes through a generator: a filter cannot be moved across it, where it would work out the counts again.
    """
    judged = apply_rules(docs, text_col, rules).select(F.inline(F.array(F.struct("row", "kept"))))
    return judged.where("kept").select("row.*")
