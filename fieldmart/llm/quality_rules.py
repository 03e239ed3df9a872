"""Quality rules with cutoffs whose false rejections are bounded.

Base measures come from each whole text. A rule rejects a text whose measure (a share by the rule's weight, in
thousandths) is over a cutoff. The cutoffs, the same for all rules, are tested on the labelled holdout per stratum, in a fixed sequence from
the loosest on, each for all rules together: of n good texts k would be rejected by any rule, and if good texts were
rejected at rate ``risk`` or more, seeing k or fewer would have a binomial probability of at most ``doubt / strata``
(exact). The sequence ends with the first cutoff that fails; all before it are certified. In a fixed sequence no further
correction is due for the number of cutoffs and rules, only the one for the strata: so with probability 1 - ``doubt``
every certified cutoff rejects at most ``risk`` of the good texts in every stratum, and about 110 good labels are enough
to certify one (with four strata, at the default risk). The bound holds for all of them at once, so the choice among them
is free: the one with the widest gap between the shares of bad and of good labelled texts that it rejects, of equal ones
the loosest. A stratum without a certified cutoff has the base alone.

All of it is DataFrame functions.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, cut

# Part, whole, and how much more of it a clean text may have than of symbols: lists, tables and headings repeat lines and
# words and have capitals, but few of these signs.
RULES = {"symbols": ("n_symbols", "word_chars", 1), "dup_lines": ("n_dup_lines", "n_lines", 4),
         "repeats": ("n_repeat_words", "n_words", 4), "capitals": ("n_capitals", "word_chars", 4)}
CUTOFFS = (700, 500, 400, 300, 200, 150, 120, 100, 80, 60, 50, 40, 30, 20)  # thousandths, in the order of the tests
RISK, DOUBT = 0.04, 0.05
SPACE = "[ \\t\\n\\x0b\\f\\r]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def _repeated(hashes: Column) -> Column:
    """Words covered by five-word windows that occur twice, from the windows' hashes in order."""
    def covered(pairs):
        twice = F.filter(pairs, lambda e, i: F.coalesce(F.get(pairs, i - 1).h == e.h, F.lit(False)) | F.coalesce(F.get(pairs, i + 1).h == e.h, F.lit(False)))
        return let(F.array_sort(F.transform(twice, lambda e: e.p)), lambda at: F.aggregate(
            F.transform(at, lambda p, i: F.least(F.lit(5), F.coalesce(F.get(at, i + 1) - p, F.lit(5)))), F.lit(0), lambda a, b: a + b))

    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(
        let(F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("p")))), covered))


def _windows(words: Column) -> Column:
    """64-bit hashes of the five-word windows."""
    return let(F.transform(words, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) < 5, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(h) - 5), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(5)]))))


def _kept_chars(text: Column, kind: str) -> Column:
    return F.length(F.regexp_replace(text, f"[^{kind}]+", "")).cast("long")


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang") -> DataFrame:
    """(doc_id, stratum, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, base_failed)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(stratum_col).cast("string").alias("stratum"), F.col(text_col).cast("string").alias("text"))
    trimmed = F.btrim(text, F.lit(SPACES))
    rows = rows.select("doc_id", "stratum", text.alias("text"),
                       F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE)).alias("words"),
                       F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t\\n\\x0b\\f\\r]")).alias("lines"))
    rows = rows.select(
        "doc_id", "stratum", F.size("words").cast("long").alias("n_words"), F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        _kept_chars(F.col("text"), "#*$%&|<>").alias("n_symbols"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeated_words(F.col("words")).alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"), _kept_chars(F.col("text"), "A-Z").alias("n_capitals"))
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _repeated_words(words: Column) -> Column:
    return let(_windows(words), _repeated).cast("long")


def measure(rule: str) -> Column:
    """The rule's share by its weight, in whole thousandths; 0 for texts without words."""
    part, whole, weight = RULES[rule]
    return F.when(F.col(whole) > 0, F.floor(1000 * F.col(part) / (weight * F.col(whole)))).otherwise(0)


def worst() -> Column:
    """The greatest measure: any rule rejects a text for which this is over the cutoff."""
    return F.greatest(*[measure(rule) for rule in RULES])


def _log_tail(n: Column, k: Column, rate: float) -> Column:
    """Log of the probability of k or fewer hits among n at the given rate; 0 where k is not below the mean."""
    first = n * math.log1p(-rate)
    step = F.aggregate(
        F.sequence(F.lit(1).cast("long"), k), F.struct(first.alias("term"), first.alias("total")),
        lambda acc, j: let(acc.term + F.ln((n - j + 1) / j) + math.log(rate / (1 - rate)), lambda term: F.struct(
            term.alias("term"), (F.greatest(acc.total, term) + F.log1p(F.exp(F.least(acc.total, term) - F.greatest(acc.total, term)))).alias("total"))),
        lambda acc: acc.total)
    return F.when(k >= n * rate, 0.0).when(k == 0, first).otherwise(step)


def cutoffs(labelled: DataFrame, risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """(stratum, cutoff): the chosen cutoff of each stratum with good texts, null if none is certified.

    ``labelled``: measures of labelled texts, with ``good``. One row per stratum comes out of the first aggregate.
    """
    over = [(F.count_if(F.col("good") & (worst() > c)).alias(f"good_{c}"), F.count_if(~F.col("good") & (worst() > c)).alias(f"bad_{c}")) for c in CUTOFFS]
    counted = labelled.groupBy("stratum").agg(F.count_if("good").alias("n"), F.count_if(~F.col("good")).alias("n_bad"), *[x for pair in over for x in pair])
    strata = F.count("*").over(Window.partitionBy(F.lit(1)))
    tested = counted.filter("n > 0").withColumn("strata", strata).select("stratum", "n", "n_bad", "strata", F.explode(F.array(*[
        F.struct(F.lit(c).alias("cutoff"), F.col(f"good_{c}").alias("k"), F.col(f"bad_{c}").alias("k_bad")) for c in CUTOFFS])).alias("test"))
    passed = _log_tail(F.col("n"), F.col("test.k"), risk) <= F.ln(F.lit(doubt) / F.col("strata"))
    failed = F.max(F.when(~F.col("passed"), F.col("test.cutoff")))  # the loosest that failed; those after it don't count
    tested = tested.withColumn("passed", passed).withColumn("failed", failed.over(Window.partitionBy("stratum")))
    certified = F.col("failed").isNull() | (F.col("test.cutoff") > F.col("failed"))
    gap = F.col("test.k_bad") * F.col("n") - F.col("test.k") * F.greatest("n_bad", F.lit(1))
    return tested.groupBy("stratum").agg(F.max(F.when(certified, F.struct(gap.alias("gap"), F.col("test.cutoff").alias("cutoff"))))["cutoff"].alias("cutoff"))


def judged(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang",
           label_col: str = "quality", risk: float = RISK, doubt: float = DOUBT) -> DataFrame:
    """The measures of each row of ``docs`` and ``kept``.

    Texts that fail the base (under 10 words, or over a fifth of the words in repeated windows) are not
    kept. Null texts have no words. Null strata are one stratum; strata without good labels only have
    the base. Of contradicting labels of an id none counts. Repeated rows stay; an empty table gives an
    empty result; other columns are not read. Texts are measured whole, whatever their length. Five-word windows are compared by 64-bit hashes.
    """
    rows = cut(measures(docs, id_col, text_col, stratum_col))
    known = labels.groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("low"), F.max(label_col).alias("high")).filter("low = high")
    labelled = rows.filter("NOT base_failed").join(known.hint("merge"), F.col("doc_id") == F.col("id")).withColumn("good", F.col("low") == 1).drop("id", "low", "high")
    limits = cutoffs(labelled, risk, doubt).withColumnRenamed("stratum", "of")
    found = rows.join(limits, F.col("stratum").eqNullSafe(F.col("of")), "left")
    rejected = F.coalesce(worst() > F.col("cutoff"), F.lit(False))
    return found.withColumn("kept", ~F.col("base_failed") & ~rejected).drop("of", "cutoff")
