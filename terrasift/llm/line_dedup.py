"""Fuzzy line deduplication with built-in functions only.

A line is normalised: lower case, digits as 0, runs of other characters than letters and digits as one space. Two lines are
linked if the edit distance of their words is at most a fifth (1 - SIMILAR) of the longer line's words: lines under five words only
if they are equal once normalised. Of each connected group of lines, the occurrence of the least (doc_id, line) stays.

Candidates: of a line's runs of words (of SHORT words for lines under 15 words, of LONG words for lines of 10 or more, of two for lines of four or
five), the KEYS of each length with the least hashes are its keys; lines that share a key are candidates. k edits break at most as many runs as k
times a run's words, so a line of up to 12 words, which has all its runs as keys or nearly so, loses hardly a link; for longer ones recall is
measured in the tests and stated in the README. A SimHash of 64 bits can't serve here: at similarity 0.8 two lines differ in 13 bits on
average, so pigeonhole blocks of a useful size miss nearly all of them (the README has figures for both).

A key in more than HOT lines that aren't joined yet is hot. The lines of hot keys meet anew by their rarest words, one more than the edits
that a line allows: linked lines share one of these, so every linked pair that shares a hot key is compared.

Verification: the number of words and 256 bits of word parities rule most candidates out (an edit flips two bits at most), then the edit distance of
the words, each coded as one of 983 040 characters: a wrong link needs two unlike words with equal codes in a pair at the limit.

Cases: null texts have no lines, and stay null; lines without a letter or digit are kept. Rows without doc_id keep all lines and
count for no other. Ties are decided by (doc_id, line). Repeated rows of one doc_id keep the same lines. A line of any length is read
whole. Other columns are untouched, whatever their names. Empty tables give empty results.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import components, cut, freed, likely, small, stars, with_components

SHORT, LONG, SIMILAR, KEYS = 3, 4, 0.8, 8
#: Either way every pair of a key is compared. Meeting by rarest words cost about 0.9 ms of CPU time a line, testing a pair in its bucket far less than
#: a microsecond: keys of some hundred lines are cheaper in pairs, those of many more are not.
HOT = 1 << 14
#: Codes of words: characters whose numbers have five hexadecimal digits.
FIRST_CODE, CODES = 0x10000, 0xF0000
PARITIES = "pqrs"
#: Of keys 40 bits are dealt: the rest would cost shuffled bytes, and a key that unlike lines have by chance only makes a candidate.
KEY_BITS = (1 << 40) - 1


def normalised(text: str = "text") -> Column:
    """All lines of the text, normalised."""
    lower = F.regexp_replace(F.lower(F.col(text)), "[1-9]", "0")
    return F.split(F.regexp_replace(lower, "[^\\p{L}\\p{N}\\n]+", " "), "\n")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), value being worked out once."""
    return F.transform(F.array(value), body)[0]


def _least(runs: str, enough: Column) -> Column:
    """The KEYS least hashes of runs, ascending; none unless ``enough``."""
    return F.when(enough, F.slice(F.sort_array(runs), 1, KEYS)).otherwise(F.array().cast("array<long>"))


def lines(docs: DataFrame) -> DataFrame:
    """(doc_id, line_no, line, h, n, keys) of the lines with a word: normalised, its hash, words and keys.

    Keys are the line's runs, of two lengths where lines of other lengths may be linked to it. Each step is a projection: within a lambda Spark
    interprets and sorts boxed values, here arrays of longs.
    """
    each = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.posexplode(normalised()).alias("line_no", "line")).select("doc_id", "line_no", F.trim("line").alias("line")).where("line != ''")
    n = F.col("n")
    part = lambda x, at, size: F.slice(x, at, F.greatest(n - size + 1, F.lit(0)))
    pairs = lambda x, ahead, size: F.zip_with(part(x, 1, size), part(x, 1 + ahead, size), lambda a, b: F.xxhash64(a, b))
    none = F.array().cast("array<long>")
    words = each.withColumn("w", F.transform(F.split("line", " "), lambda x: F.hash(x))).withColumn("n", F.size("w"))
    runs = words.withColumn("twos", pairs("w", 1, 2))
    runs = runs.withColumns({"threes": F.when((n > 3) & (n < 15), F.zip_with(part("twos", 1, SHORT), part("w", 3, SHORT), lambda a, b: F.xxhash64(a, b))).otherwise(none), "fours": F.when(n > 9, pairs("twos", 2, LONG)).otherwise(none)})
    keys = F.concat(_least("twos", (n > 3) & (n < 6)), _least("threes", (n > 3) & (n < 15)), _least("fours", n > 9))
    return runs.select("doc_id", "line_no", "line", F.xxhash64("line").alias("h"), "n", keys.alias("keys"))


def _parities(line: str) -> Column:
    """(p, q, r, s): parities of the line's words, 256 bits."""
    bit = lambda x: F.call_function("shiftleft", F.lit(1).cast("long"), x)  # noqa: E731  # by the six last bits of x
    half = lambda w, k: F.filter(w, lambda x: x.bitwiseAND(F.lit(192)) == 64 * k)
    parity = lambda w, k: F.aggregate(half(w, k), F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(bit(x)))
    return _let(F.transform(F.split(line, " "), lambda x: F.hash(x)), lambda w: F.struct(*[parity(w, k).alias(name) for k, name in enumerate(PARITIES)]))


def _code(line: str) -> Column:
    """The line with one character for each word."""
    codes = F.transform(F.split(line, " "), lambda x: F.hex(F.pmod(F.xxhash64(x), F.lit(CODES)) + FIRST_CODE))
    return F.decode(F.unhex(F.concat(F.lit("000"), F.array_join(codes, "000"))), "UTF-32")


def _edits(n: Column) -> Column:
    """Word edits allowed where the longer line has n words."""
    return F.floor((1 - SIMILAR) * n + 1e-9).cast("int")


#: What linked lines meet, of their words na and nb and parities pa, pb and so on.
NEAR = f"least(na, nb) >= {SIMILAR} * greatest(na, nb) - 1e-9 and {' + '.join(f'bit_count({x}a ^ {x}b)' for x in PARITIES)} <= 2 * floor({1 - SIMILAR} * greatest(na, nb) + 1e-9)"


def _rest(members: DataFrame, comps: DataFrame) -> DataFrame:
    """(bucket, node, comp, many) of the buckets of _met() whose nodes are of more than one component, ``many`` of them.

    Every node was compared to its buckets' least and greatest by now, so buckets of two or three hold no other pair.
    """
    open_ = members.where("many > 3").select("bucket", "node").join(comps, "node", "left").select("bucket", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = open_.groupBy("bucket").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count(F.lit(1)).alias("many")).where("c0 != c1").select("bucket", "many")
    return cut(open_.join(mixed, "bucket"), "line-rest")


def _across(rest: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b) of the nodes of a bucket in ``rest`` that may be linked and are of different components; each pair in the least bucket both are in."""
    keys = rest.groupBy("node").agg(F.collect_set("bucket").alias("k"))  # a line's own keys
    sized = rest.join(sizes, F.col("node") == F.col("h")).join(keys, "node")
    side = lambda x: sized.select("bucket", *[F.col(c).alias(c[0] + x) for c in ("comp", "n", "k", *PARITIES)], F.col("node").alias(x))
    pairs = side("a").join(side("b"), "bucket").where(f"a < b and ca != cb and {NEAR} and array_min(array_intersect(ka, kb)) = bucket")
    return pairs.select("a", "b").distinct()


def _rarest(texts: DataFrame) -> DataFrame:
    """(bucket, node) of texts (h, c): each line by its rarest words, one more than the edits it allows.

    Linked lines have all words but those edits in common, repeats counted; so the rarest of either, in one order for all lines, share a
    word: no pair of these lines is left out.
    """
    words = texts.select(F.col("h").alias("node"), F.length("c").alias("n"), F.explode(F.split("c", "")).alias("w")).where("w != ''")
    counted = words.groupBy("node", "n", "w").agg(F.count(F.lit(1)).cast("int").alias("times"))
    each = cut(counted.select("node", "n", F.explode(F.sequence(F.lit(1), "times")).alias("k"), "w").select("node", "n", F.xxhash64("w", "k").alias("bucket")), "line-hot-words")
    common = each.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"))
    place = F.row_number().over(Window.partitionBy("node").orderBy("c", "bucket"))  # a line's own words
    return each.join(common, "bucket").withColumn("_at", place).where((F.col("_at") <= _edits(F.col("n")) + 1) & (F.col("c") > 1)).select("bucket", "node")


def _shared(whole: DataFrame) -> DataFrame:
    """(bucket, node): the distinct lines of the keys that unlike ones share, but for keys of two lines whose numbers of words rule a link out."""
    keyed = whole.select(F.explode("keys").alias("bucket"), F.col("h").alias("node"), "n").withColumn("bucket", F.col("bucket").bitwiseAND(F.lit(KEY_BITS)))
    of = {"c": F.count(F.lit(1)), "lo": F.min("node"), "hi": F.max("node"), "n0": F.min("n"), "n1": F.max("n")}
    sized = keyed.groupBy("bucket").agg(*[v.alias(k) for k, v in of.items()]).where(f"lo != hi and (c > 2 or n0 >= {SIMILAR} * n1 - 1e-9)").select("bucket")
    sized = cut(sized, "line-sized")
    freed(whole.sparkSession)
    members = cut(likely(keyed.select("bucket", "node"), sized, "bucket").join(sized, "bucket").distinct(), "line-members")
    freed(whole.sparkSession)
    return members


def _once(whole: DataFrame, members: DataFrame) -> DataFrame:
    """(h, n, line) of the members' lines and few others. Of a line's occurrences the one of the least hash is read, so that a common line's don't meet."""
    mark = F.xxhash64("doc_id", "line_no")
    nodes = cut(members.select(F.col("node").alias("h")).distinct(), "line-nodes")
    some = likely(whole.select("h", "n", "line", mark.alias("mark")), nodes, "h")
    one = some.groupBy("h").agg(F.min("mark").alias("mark"))
    return some.join(one, ["h", "mark"]).dropDuplicates(["h"]).select("h", "n", "line")  # rows of a doc_id may be repeated


def _met(members: DataFrame, sizes: DataFrame, label: str) -> DataFrame:
    """(bucket, node, lo, hi, many, by_lo, by_hi) of members (bucket, node): the least and greatest node of a bucket, its number of nodes, and
    whether this one may be linked to those. Buckets of two or three leave out the nodes that may not: they hold no other pair."""
    rows = members.select("bucket", "node").join(sizes.withColumnRenamed("h", "node"), "node")
    of = ("n", *PARITIES)
    end = lambda x, pick, by: [pick("node").alias(x), *[by(c, "node").alias(c + x) for c in of]]
    ends = rows.groupBy("bucket").agg(*end("lo", F.min, F.min_by), *end("hi", F.max, F.max_by), F.count(F.lit(1)).alias("many")).where("many > 1")
    own = rows.select("bucket", "node", *[F.col(c).alias(c + "own") for c in of])
    near = lambda x: F.expr(re.sub(r"\b([npqrs])([ab])\b", lambda m: m[1] + {"a": "own", "b": x}[m[2]], NEAR))
    both = own.join(ends, "bucket").select("bucket", "node", "lo", "hi", "many", ((F.col("node") != F.col("lo")) & near("lo")).alias("by_lo"), (~F.col("node").isin(F.col("lo"), F.col("hi")) & near("hi")).alias("by_hi"))
    return cut(both.where("by_lo or by_hi or many > 3"), label)


def linked(whole: DataFrame) -> DataFrame:
    """(node, comp): the components of linked unlike lines, by their hashes, of lines() that are written."""
    members = _shared(whole)
    texts = cut(_once(whole, members).select("h", "n", "line", _parities("line").alias("r")).select("h", "n", *[f"r.{x}" for x in PARITIES], "line"), "line-texts")
    freed(whole.sparkSession)
    sizes = texts.select("h", "n", *PARITIES)

    def alike(pairs: DataFrame) -> DataFrame:
        near = cut(pairs, "line-near")
        ids = near.select(F.col("a").alias("h")).union(near.select("b")).distinct()
        coded = cut(texts.select("h", "line").join(small(ids), "h").select("h", _code("line").alias("c")), "line-coded")  # only lines of pairs are coded
        both = near.join(coded.select(F.col("h").alias("a"), F.col("c").alias("ca")), "a").join(coded.select(F.col("h").alias("b"), F.col("c").alias("cb")), "b")
        far = _edits(F.greatest(F.length("ca"), F.length("cb")))
        return both.withColumn("far", far).where("levenshtein(ca, cb, far) >= 0").select("a", "b")

    def by_least(met: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
        return stars(met.where("by_lo").select("bucket", "node", "lo"), alike, label)

    def by_greatest(met: DataFrame, comps: DataFrame) -> DataFrame:
        """Links to the greatest of a key's lines where the least doesn't join them: alike lines that are left apart would meet in pairs."""
        pairs = met.where("by_hi").select(F.col("node").alias("a"), F.col("hi").alias("b")).distinct()
        return alike(with_components(pairs, comps).where("ca != cb").select("a", "b")).select("a", "b")

    met = _met(members, sizes, "line-met")
    freed(whole.sparkSession)
    edges, comps = by_least(met, "line")
    more = cut(by_greatest(met, comps), "line-greatest")
    if not more.isEmpty():
        edges = edges.union(more)
        comps = components(edges, "line-c")
    rest = _rest(met, comps)
    freed(whole.sparkSession)
    last = alike(_across(rest.where(f"many <= {HOT}"), sizes))
    hot = cut(rest.where(f"many > {HOT}").select(F.col("node").alias("h")).distinct(), "line-hot")
    again = None
    if not hot.isEmpty():
        chosen = cut(_rarest(texts.join(hot, "h").select("h", _code("line").alias("c"))), "line-hot-keys")
        again = _met(chosen, sizes, "line-hot-met")
        links, joined = by_least(again, "line-hot")
        last = last.union(links).union(by_greatest(again, joined))
    for more in (lambda: last, lambda: alike(_across(_rest(again, comps), sizes))):
        found = cut(more().select("a", "b"), "line-last")
        if not found.isEmpty():
            edges = edges.union(found)
            comps = components(edges, "line-c")
        if again is None:
            break
    return comps


def dropped(docs: DataFrame) -> DataFrame:
    """(doc_id, gone): the numbers, from 0 and ascending, of the lines that each text loses; texts that lose none are left out."""
    whole = cut(lines(docs), "lines")
    groups = linked(whole).select(F.col("node").alias("h"), "comp")
    named = cut(whole.select("doc_id", "line_no", "h").join(groups, "h", "left").select("doc_id", "line_no", F.coalesce("comp", "h").alias("g")), "line-groups")
    repeated = named.groupBy("g").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("d0")).where("c > 1").select("g", "d0")
    rows = cut(named.join(repeated, "g"), "line-repeats")
    freed(docs.sparkSession)
    first = rows.where("doc_id = d0").groupBy("g").agg(F.min("line_no").alias("l0"))
    lost = rows.join(first, "g").where("doc_id != d0 or line_no != l0")
    return lost.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("gone"))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_kept, gone, a row for each of docs."""
    gone = cut(dropped(docs), "line-gone")
    counted = docs.select("doc_id", F.coalesce(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long").alias("n_lines"))
    out = counted.join(gone, "doc_id", "left").withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    return out.select("doc_id", "n_lines", (F.col("n_lines") - F.size("gone")).cast("long").alias("n_kept"), "gone")


def without_repeats(docs: DataFrame) -> DataFrame:
    """docs with the lost lines cut out of text, and n_chars, if there is one, counted anew; texts that lose all their words go."""
    gone = cut(dropped(docs), "line-gone")
    names = set(docs.columns)
    key, lost = next((a, b) for a, b in ((f"_id{k}", f"_gone{k}") for k in range(len(names) + 1)) if not {a, b} & names)
    lists = gone.select(F.col("doc_id").alias(key), F.col("gone").alias(lost)).hint("merge")  # the same way at every size
    joined = docs.join(lists, docs["doc_id"] == F.col(key), "left")
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(lost, i)), "\n")
    whole = F.col(lost).isNull()
    out = joined.withColumn("text", F.when(whole, F.col("text")).otherwise(rest)).where(whole | F.col("text").rlike("[^\\x20\\x09-\\x0D]"))
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(whole, F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)
