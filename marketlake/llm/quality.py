"""Quality rules as weak supervision: rules vote or abstain, expectation-maximisation weighs them.

Every document gets measures of its whole text, every rule votes good (1), bad (-1) or nothing (0). The votes of all
documents are counted by pattern (at most 3 to the number of rules), and expectation-maximisation over these counts
estimates the share of good documents and, for each rule, how often
its votes are right on good and on bad documents. A document is kept if its posterior
probability of being good reaches the threshold and it does not fail the two base rules.

Defined results: a null text counts as empty, an empty text has no words and fails the base rules; every row of the
input gets its own verdict, so repeated rows and null ids are kept or dropped one by one; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import NO_WORD, text_of, words_of
from marketlake.session import stage

WINDOW = 5
ROUNDS = 30
THRESHOLD = 0.5
#: Starting values: how often a rule's vote is bad on good and on bad documents, and the share of documents that stand for them.
BAD_ON_GOOD, BAD_ON_BAD, SMOOTH = 0.03, 0.6, 0.01

#: Frequent function words of the languages of the corpus (fixed values).
FUNCTION_WORDS = (
    "the", "of", "and", "to", "in", "is", "that", "for", "it", "with", "on", "was", "this", "are", "be", "by",
    "le", "la", "les", "de", "des", "du", "et", "en", "un", "une", "que", "qui", "pour", "dans", "sur",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "ist", "nicht", "ein", "eine", "auf",
    "el", "los", "las", "y", "del", "se", "por", "con", "una", "su", "para", "al",
)

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_function")


def _repeat_words(starts: Column) -> Column:
    """How many words the windows at these ascending starts cover."""
    reach = F.transform(starts, lambda s, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - s, F.lit(WINDOW))))
    return F.aggregate(reach, F.lit(0), lambda a, x: a + x)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct ``__m`` of MEASURES (long), computed row by row, without a shuffle."""
    df = docs.withColumn("__t", text_of(text)).withColumn("__w", words_of(F.col("__t")))
    df = df.withColumn("__h", F.transform("__w", lambda w: F.xxhash64(w)))
    window = lambda i: F.xxhash64(*[F.get(F.col("__h"), i + k) for k in range(WINDOW)])
    df = df.withColumn(
        "__win",
        F.when(F.size("__h") >= WINDOW, F.transform(F.sequence(F.lit(0), F.size("__h") - WINDOW), window)).otherwise(F.array().cast("array<bigint>")),
    )
    # Only a text with an equal pair of windows is sorted.
    df = df.withColumn(
        "__sorted",
        F.when(F.size(F.array_distinct("__win")) < F.size("__win"), F.array_sort(F.transform("__win", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )
    same = lambda s, k: F.coalesce(F.get(F.col("__sorted"), k)["h"] == s["h"], F.lit(False))
    df = df.withColumn(
        "__starts",
        F.array_sort(F.array_compact(F.transform("__sorted", lambda s, k: F.when(same(s, k - 1) | same(s, k + 1), s["i"])))),
    )
    df = df.withColumn("__lines", F.filter(F.split("__t", "\n"), lambda x: ~x.rlike(NO_WORD)))
    t = F.col("__t")
    values = {
        "n_words": F.size("__w"),
        "word_chars": F.length(F.array_join("__w", "")),
        "n_symbols": F.length(F.regexp_replace(t, r"[^#*$%&|<>]+", "")),
        "n_dup_lines": F.size("__lines") - F.size(F.array_distinct("__lines")),
        "n_repeat_words": F.coalesce(_repeat_words(F.col("__starts")), F.lit(0)),
        "n_lines": F.size("__lines"),
        "n_upper": F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")),
        "n_function": F.size(F.filter("__w", lambda w: F.lower(w).isin(*FUNCTION_WORDS))),
    }
    packed = F.struct(*[values[name].cast("long").alias(name) for name in MEASURES])
    return df.withColumn("__m", packed).drop("__t", "__w", "__h", "__win", "__sorted", "__starts", "__lines")


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def votes(m: Column) -> Column:
    """The votes of all rules as an array; a rule that does not apply abstains."""
    n, some = m["n_words"], m["n_words"] >= 20
    rules = [
        _vote(20 * m["n_symbols"] > n, 100 * m["n_symbols"] <= n),
        _vote(some & ((m["word_chars"] > 7 * n) | (2 * m["word_chars"] < 7 * n)), (m["word_chars"] > 4 * n) & (m["word_chars"] < 6 * n)),
        _vote(100 * m["n_repeat_words"] > 10 * n, 100 * m["n_repeat_words"] <= 2 * n),
        _vote((m["n_lines"] >= 4) & (10 * m["n_dup_lines"] > 4 * m["n_lines"]), (m["n_lines"] >= 2) & (m["n_dup_lines"] == 0)),
        _vote(some & (100 * m["n_upper"] > 30 * m["word_chars"]), 100 * m["n_upper"] <= 12 * m["word_chars"]),
        _vote(some & (100 * m["n_function"] < n), 100 * m["n_function"] >= 8 * n),
    ]
    return F.array(*[r.cast("int") for r in rules])


N_RULES = 6


def _code(v: Column) -> Column:
    """One number for a pattern of votes."""
    return F.aggregate(v, F.lit(0), lambda a, x: a * 3 + x + 1)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _posterior(params: Column, v: Column) -> Column:
    """Probability of good for the votes; an abstention is no evidence.

    ``params``: the share of good documents, then by rule how often its vote is bad on good, and on bad documents.
    """
    g = lambda r: F.get(params, r + 1)
    b = lambda r: F.get(params, r + 1 + N_RULES)
    evidence = lambda x, r: F.when(x == -1, F.log(g(r) / b(r))).when(x == 1, F.log((1 - g(r)) / (1 - b(r)))).otherwise(0.0)
    score = F.aggregate(F.transform(v, evidence), F.lit(0.0), lambda a, x: a + x)
    prior = F.get(params, F.lit(0))
    return 1 / (1 + F.exp(-(score + F.log(prior / (1 - prior)))))


def estimate(patterns: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """Posterior by pattern from ``patterns`` (code, votes, n): one row per code, at most 3 ** N_RULES in all.

    The counts of all patterns fit one row, in which an aggregate over the rounds runs the estimation. A share SMOOTH
    of the documents stands for the starting values, so rules that never vote keep them.
    """
    arr = F.col("__p")
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda a, x: a + x)
    pseudo = SMOOTH * F.col("__n")

    def rates(weights: Column, r: int, start: float) -> Column:
        bad = total(F.zip_with(arr, weights, lambda x, q: F.when(x["votes"][r] == -1, q).otherwise(0.0)))
        cast = total(F.zip_with(arr, weights, lambda x, q: F.when(x["votes"][r] != 0, q).otherwise(0.0)))
        return (bad + pseudo * start) / (cast + pseudo)

    def step(params: Column) -> Column:
        goods = F.transform(arr, lambda x: x["n"] * _posterior(params, x["votes"]))

        def after(good: Column) -> Column:
            def by_rule(bad: Column) -> Column:
                prior = F.greatest(F.lit(0.05), F.least(F.lit(0.95), total(good) / F.col("__n")))
                on_good = [rates(good, r, BAD_ON_GOOD) for r in range(N_RULES)]
                return F.array(prior, *on_good, *[F.greatest(rates(bad, r, BAD_ON_BAD), on_good[r]) for r in range(N_RULES)])

            return _let(F.zip_with(arr, good, lambda x, q: x["n"] - q), by_rule)

        return _let(goods, after)

    start = F.array(F.lit(0.85), *[F.lit(BAD_ON_GOOD)] * N_RULES, *[F.lit(BAD_ON_BAD)] * N_RULES)
    one = patterns.agg(F.array_sort(F.collect_list(F.struct("code", "votes", F.col("n").cast("double").alias("n")))).alias("__p"))
    one = one.withColumn("__n", F.aggregate("__p", F.lit(0.0), lambda a, x: a + x["n"]))
    one = one.withColumn("params", F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, lambda p, _: step(p)))
    rows = one.select("params", F.explode("__p").alias("x"))
    return rows.select(F.col("x.code").alias("__code"), _posterior(F.col("params"), F.col("x.votes")).alias("__post"), "params")


def _patterns(measured: DataFrame) -> DataFrame:
    v = measured.select(votes(F.col("__m")).alias("votes"))
    return v.groupBy(_code(F.col("votes")).alias("code"), "votes").agg(F.count(F.lit(1)).alias("n"))


def judge(measured: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Rows of ``measure`` with ``__failed``, ``__post`` and ``__kept``. It reads its input twice: to count, to judge."""
    posteriors = F.broadcast(estimate(_patterns(measured)).drop("params"))  # at most 3 ** N_RULES rows
    df = measured.withColumn("__code", _code(votes(F.col("__m")))).join(posteriors, "__code", "left").drop("__code")
    df = df.withColumn("__failed", base_failed(F.col("__m")))
    return df.withColumn("__kept", ~F.col("__failed") & (F.col("__post") >= threshold))


def filter_quality(docs: DataFrame, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that pass, with their own columns. Documents and measures are written once, before the votes are counted."""
    return judge(stage(measure(docs, text), "measured"), threshold).where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def summary(measured: DataFrame) -> DataFrame:
    """The estimated prior and accuracies, one row."""
    return estimate(_patterns(measured)).select("params").limit(1)


def all_must_pass(m: Column) -> Column:
    """The plain rule that the posterior replaces: no rule votes bad."""
    return reduce(lambda a, b: a & b, [votes(m)[r] >= 0 for r in range(N_RULES)])
