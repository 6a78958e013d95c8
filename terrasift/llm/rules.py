"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Measures of a text: words, characters in words, symbols, repeated lines and words in repeated three-word windows (the
base), and ratios of symbols, stop words, short lines and repeated lines. A rule names a measure, and the least and greatest
values that pass; ``compile_rules`` turns the table into one boolean expression. Nothing is shuffled.

Repeated windows: each window's 64-bit hash, less as many low bits as its number takes, carries that number; the sorted
longs put windows that may be equal side by side. Of those, the words are compared: sorted by their words, equal ones meet.

Cases: null texts have no words; empty and blank ones too: all measures are 0 and base_failed is true. Repeated rows give
repeated rows. Texts of any length are read whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Common words of the languages at hand, for the share of stop words.
STOP_WORDS = (
    "the of and to a in is that for it was on as with be by an at this from are or not have he his "
    "der die das und ist in den von zu mit sich des auf für nicht ein eine als auch dem "
    "le la les de des et un une est en que qui dans pour par sur du pas au avec il elle "
    "el los las que y en un una es por con para su no se lo del al"
).split()

#: measure, least, greatest (None: no bound).
RULES = [
    ("n_words", 50, None),
    ("word_length", 2.0, 14.0),
    ("symbol_ratio", None, 0.15),
    ("repeat_word_ratio", None, 0.5),
    ("dup_line_ratio", None, 0.5),
    ("stop_ratio", 0.02, None),
    ("bar_line_ratio", None, 0.6),
]


def _let(value: Column, body) -> Column:
    """body(value), value being worked out once."""
    return F.transform(F.array(value), body)[0]


def _repeated(words: Column, n: Column) -> Column:
    """How many words stand in three-word windows found twice or more."""
    bits = F.ceil(F.log2(n + 1)).cast("int")

    def of(b: Column) -> Column:
        def number(i):
            return F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))

        low = F.expr("1L")
        packed = F.array_sort(F.transform(F.sequence(F.lit(0), (n - 3).cast("int")), lambda i: F.call_function("shiftleft", F.call_function("shiftrightunsigned", number(i), b), b).bitwiseOR(i.cast("long"))))
        side_by_side = lambda xs, of: F.filter(xs, lambda x, j: ((j > 0) & (of(F.get(xs, j - 1)) == of(x))) | F.coalesce(of(F.get(xs, j + 1)) == of(x), F.lit(False)))

        def marked(k: Column) -> Column:
            maybe = side_by_side(k, lambda x: F.call_function("shiftrightunsigned", x, b))
            at = F.transform(maybe, lambda x: x.bitwiseAND(F.call_function("shiftleft", low, b) - 1).cast("int"))
            said = F.array_sort(F.transform(at, lambda i: F.struct(F.concat_ws(" ", *[F.get(words, i + j) for j in range(3)]).alias("said"), i.alias("i"))))
            return _let(said, lambda s: F.size(F.array_distinct(F.flatten(F.transform(side_by_side(s, lambda x: x["said"]), lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2))))))

        return _let(packed, marked)

    return F.when(n < 3, F.lit(0)).otherwise(_let(bits, of)).cast("long")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with the base measures and the ratios as columns."""
    white = " \t\n\x0b\f\r"
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(white))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, "[ \\t-\\r]+"))
    one = docs.withColumn("_w", words)
    n = F.size("_w")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(white)) != "")
    counted = one.withColumns({
        "n_words": n.cast("long"),
        "word_chars": (F.length(F.translate(text, white, ""))).cast("long"),
        "n_symbols": (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long"),
        "n_dup_lines": _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "_lines": F.size(lines),
        "_bars": F.size(F.filter(lines, lambda x: x.contains("|"))),
        "_stops": F.size(F.filter("_w", lambda x: F.lower(x).isin(STOP_WORDS))),
        "n_repeat_words": _repeated(F.col("_w"), n),
    })
    at_least_one = lambda x: F.greatest(F.col(x), F.lit(1))
    return counted.withColumns({
        "word_length": F.col("word_chars") / at_least_one("n_words"),
        "symbol_ratio": F.col("n_symbols") / at_least_one("n_words"),
        "repeat_word_ratio": F.col("n_repeat_words") / at_least_one("n_words"),
        "dup_line_ratio": F.col("n_dup_lines") / at_least_one("_lines"),
        "stop_ratio": F.col("_stops") / at_least_one("n_words"),
        "bar_line_ratio": F.col("_bars") / at_least_one("_lines"),
    }).drop("_w", "_lines", "_bars", "_stops")


def compile_rules(rules: list[tuple]) -> Column:
    """True where every rule's measure is within its bounds."""
    ok = F.lit(True)
    for name, least, most in rules:
        if least is not None:
            ok = ok & (F.col(name) >= F.lit(least))
        if most is not None:
            ok = ok & (F.col(name) <= F.lit(most))
    return ok


def judge(docs: DataFrame, rules: list[tuple] = RULES) -> DataFrame:
    """doc_id, the base measures, base_failed and kept."""
    failed = F.expr("n_words < 50 or 100 * n_repeat_words > 50 * n_words")
    return measures(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & compile_rules(rules)).alias("kept"),
    )
