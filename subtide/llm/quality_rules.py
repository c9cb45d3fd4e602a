"""Quality rules with thresholds that adapt to each language and source.

Each group keeps a mergeable sketch per measure: counts of values in bins that
hold the value to seven significant bits. Sketches of parts of the data add
up to the sketch of all of it, so they are built before the shuffle. A document
fails where a measure lies ``FENCE`` widths of the middle half of its group
beyond that half. A measure that is alike in all of the middle half (most texts
hold no symbols) has no such width; there the limit lies beyond the outermost
hundredth by that hundredth's own distance from the median. Bad documents widen
the sketches, so a second round takes them from the documents that the first
round accepts, and judges all documents anew. A group of fewer than ``MIN_DOCS``
documents merges its sketch with those of its language, and if these are too
few, of all documents; only in a corpus smaller than that the width has a fixed
least value.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Measures per thousand (integers, so that every engine bins them alike) and the least width of the accepted range
#: in a corpus of fewer than ``MIN_DOCS`` documents.
MEASURES = {"word_chars": 2000, "n_symbols": 100, "n_dup_lines": 100, "n_repeat_words": 100}
#: Hundredths of a sketch below and above which its tails begin.
TAILS = (1, 99)
#: Documents from which on a tail of one hundredth holds at least one of them.
MIN_DOCS = 100
#: Widths of the middle half that an accepted value may lie beyond it.
FENCE = 3
ROUNDS = 2
BITS = 7

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_WHITE = " \t\n\x0b\x0c\r"
_SYMBOLS = "#*$%&|<>"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.transform(F.array(value), body)[0]


def _words(text: Column) -> Column:
    return F.filter(F.split(text, "[ \\t-\\r]"), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more.

    Windows are told apart by a 64-bit hash within their own text. Sorted by
    hash and place, a window is repeated if a neighbour has its hash; then each
    such window adds the words that the one before it did not cover.
    """
    windows = F.transform(
        F.slice(words, F.lit(3), F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), w).alias("h"), i.alias("p")),
    )
    covered = lambda places: F.aggregate(
        places,
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda acc, p: F.struct(p.alias("last"), (acc["n"] + F.least(p - acc["last"], F.lit(3))).alias("n")),
        lambda acc: acc["n"],
    )
    same = lambda s, x, i: (F.get(s, i - 1)["h"] == x["h"]) | (F.get(s, i + 1)["h"] == x["h"])
    repeated = lambda s: F.transform(F.filter(s, lambda x, i: F.coalesce(same(s, x, i), F.lit(False))), lambda x: x["p"])
    return _let(F.sort_array(windows), lambda s: covered(F.sort_array(repeated(s))))


def with_measures(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Append the counts of ``BASE`` and ``base_failed``; null texts count as empty.

    Input columns with these names give way.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    length = lambda drop: F.length(F.translate(text, drop, ""))
    lines = F.filter(F.split(text, "\n"), lambda line: F.translate(line, _WHITE, "") != "")
    counts = _let(
        _words(text),
        lambda w: F.struct(F.size(w).cast("long").alias("n_words"), _repeated(w).cast("long").alias("n_repeat_words")),
    )
    measured = F.struct(
        length(_WHITE).cast("long").alias("word_chars"),
        (F.length(text) - length(_SYMBOLS)).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
    )
    names = {*BASE, "base_failed"}
    kept = [c for c in docs.columns if c.lower() not in names]
    out = docs.withColumns({"_counts": counts, "_measured": measured}).select(
        *kept, *(F.col(f"{'_counts' if c in ('n_words', 'n_repeat_words') else '_measured'}.{c}").alias(c) for c in BASE)
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    return out.withColumn("base_failed", failed)


def _per_thousand(measure: str) -> str:
    return f"({measure} * 1000 div greatest(n_words, 1))"


def bin_of(measure: str) -> Column:
    """Lower end of the bin: the value with all but its first ``BITS`` bits set to zero."""
    value = _per_thousand(measure)
    step = f"shiftleft(1L, greatest(length(bin({value})) - {BITS}, 0))"
    return F.expr(f"{step} * ({value} div {step})")


def _scope(group: list[str]) -> Column:
    """Key of a document's own group; its beginnings are the keys of the groups around it. Null is a group of its own."""
    keys = [F.coalesce(F.concat(F.lit("="), F.col(g).cast("string")), F.lit("")) for g in group]
    return F.array(*keys) if keys else F.array().cast("array<string>")


def _around(scope: str) -> Column:
    """Keys of a group and of the groups around it, up to all documents (the empty key)."""
    return F.transform(F.sequence(F.lit(0), F.size(scope)), lambda n: F.slice(scope, F.lit(1), n))


def sketches(measured: DataFrame, group: list[str]) -> DataFrame:
    """``scope, measure, bin, n`` of each group and of the groups around it.

    Mergeable by adding ``n`` of equal bins: the wider sketches are sums of the
    narrower ones. Documents that fail the base rules are left out; those that a
    former round does not keep add nothing to ``n``, but keep their group listed.
    """
    bins = F.array(*(F.struct(F.lit(m).alias("measure"), bin_of(m).alias("bin")) for m in MEASURES))
    counted = F.col("kept").cast("long") if "kept" in measured.columns else F.lit(1).cast("long")
    rows = measured.where(~F.col("base_failed")).select(_scope(group).alias("own"), counted.alias("counted"), F.explode(bins).alias("s"))
    own = rows.groupBy("own", "s.measure", "s.bin").agg(F.sum("counted").alias("n"))
    wider = own.select(F.explode(_around("own")).alias("scope"), "measure", "bin", "n")
    return wider.groupBy("scope", "measure", "bin").agg(F.sum("n").alias("n"))


def limits(sketch: DataFrame) -> DataFrame:
    """``scope, measure, total, low, high``: the bins that each sketch accepts, ends included."""
    whole = Window.partitionBy("scope", "measure")
    # A window holds the bins of one sketch, at most 64 * 64 of them.
    ranked = sketch.withColumns({"upto": F.sum("n").over(whole.orderBy("bin")), "total": F.sum("n").over(whole)})
    rank = lambda k: F.min(F.when(F.col("upto") * 100 >= F.col("total") * k, F.col("bin")))
    marks = {"q25": 25, "middle": 50, "q75": 75, "first": TAILS[0], "last": TAILS[1]}
    found = ranked.groupBy("scope", "measure").agg(F.first("total").alias("total"), *(rank(k).alias(c) for c, k in marks.items()))
    least = reduce(lambda c, m: c.when(F.col("measure") == m, MEASURES[m]), MEASURES, F).otherwise(0)
    least = F.when(F.col("total") < MIN_DOCS, least).otherwise(0)
    width = F.greatest((F.col("q75") - F.col("q25")) * FENCE, least)
    alike = (F.col("total") >= MIN_DOCS) & (F.col("q25") == F.col("q75"))
    low = F.when(alike, F.col("first") * 2 - F.col("middle")).otherwise(F.col("q25") - width)
    high = F.when(alike, F.col("last") * 2 - F.col("middle")).otherwise(F.col("q75") + width)
    return found.select("scope", "measure", "total", low.alias("low"), high.alias("high"))


def group_limits(measured: DataFrame, group: list[str]) -> DataFrame:
    """One row per group: its key ``_scope``, ``_docs`` behind its limits, and ``_<measure>_low`` and ``_high``.

    The limits are those of the narrowest sketch around the group that holds
    ``MIN_DOCS`` documents, or of all documents.
    """
    wide = limits(sketches(measured, group)).groupBy("scope").agg(
        F.first("total").alias("_docs"),
        *(F.max(F.when(F.col("measure") == m, F.col(e))).alias(f"_{m}_{e}") for m in MEASURES for e in ("low", "high")),
    )
    values = F.struct(*(c for c in wide.columns if c != "scope"))
    usable = wide.where((F.col("_docs") >= MIN_DOCS) | (F.size("scope") == 0) & (F.col("_docs") > 0)).select("scope", values.alias("limits"))
    groups = wide.where(F.size("scope") == len(group)).select(F.col("scope").alias("_scope"))
    near = groups.select("_scope", F.explode(_around("_scope")).alias("scope")).join(usable, "scope")
    chosen = near.groupBy("_scope").agg(F.max_by("limits", F.size("scope")).alias("limits"))
    return chosen.select("_scope", "limits.*")


def _judged(measured: DataFrame, found: DataFrame, group: list[str]) -> DataFrame:
    # One row per group; groups are few, and hot ones were added up before the shuffle.
    joined = measured.withColumn("_scope", _scope(group)).join(found, "_scope", "left")
    inside = [bin_of(m).between(F.col(f"_{m}_low"), F.col(f"_{m}_high")) for m in MEASURES]
    kept = ~F.col("base_failed") & F.coalesce(reduce(lambda a, b: a & b, inside), F.lit(True))
    return joined.select(*measured.columns, kept.alias("kept"))


def apply_rules(measured: DataFrame, group: list[str] = ["lang", "source"], rounds: int = ROUNDS) -> DataFrame:  # noqa: B006
    """Append ``kept``: false if the base rules fail or a measure lies outside the limits of its group.

    Null is a group of its own. A group of which the first round keeps nothing is
    judged by the groups around it; where that leaves nothing at all, only the base
    rules hold. ``measured`` is read twice a round; write it first if it is costly.
    """
    plain = measured.select(*(c for c in measured.columns if c.lower() != "kept"))
    out = _judged(plain, group_limits(plain, group), group)
    for _ in range(rounds - 1):
        out = _judged(plain, group_limits(out, group), group)
    return out
