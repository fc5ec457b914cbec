"""Quality by weak supervision: rules vote or abstain, EM learns their accuracies, the posterior decides.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.tools import materialise

ROUNDS = 25  # of expectation and maximisation
GOOD = "good"
START_SHARE = 0.85  # of good texts
START_WRONG, START_OWN, START_OTHER = 0.005, 0.9, 0.1  # how often a rule votes bad: on good texts, on its own kind of bad ones, on other kinds
MOST_WRONG, LEAST_OWN, EDGE = 0.01, 0.5, 0.001  # bounds: on good texts at most, on its own kind at least; and away from 0 and 1
SMOOTH = 2.0  # votes that each rate starts with
LEAST_WORDS = 50
WINDOW = 3

_WORDS_BETWEEN = r"[\x20\x09-\x0D]+"


def _each_once(df: DataFrame, name: str, value: Column, *keep: str) -> DataFrame:
    """``df`` with a column that is computed once per row, whatever later expressions do with it."""
    return df.select(*keep, F.explode(F.array(value)).alias(name))


def measure(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_ends, n_chars), one row per row.

    A null text reads as empty and has 0 of everything. Repeated windows are found by sorting the window hashes
    of a text with their positions, inside the row; nothing is shuffled.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    split = F.filter(F.split("t", _WORDS_BETWEEN), lambda w: w != "")
    base = _each_once(docs.select(F.col(id_col).cast("long").alias("id"), t.alias("t")), "w", split, "id", "t")
    lines = F.filter(F.split("t", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = _each_once(base, "lines", F.transform(lines, lambda x: F.xxhash64(x)), "id", "t", "w")
    n = F.size("w")
    # hash of three words from the hashes of two and one: arrays are walked side by side, never indexed
    pairs = F.zip_with("w", F.slice("w", 2, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b))
    grams = F.slice(F.zip_with(pairs, F.slice("w", WINDOW, F.greatest(n, F.lit(1))), lambda a, b: F.xxhash64(a, b)), 1, F.greatest(n - WINDOW + 1, F.lit(0)))
    placed = _each_once(base, "s", F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), "id", "t", "w", "lines")
    # a window repeats if the one before or behind it in hash order is the same
    before = F.concat(F.array(F.lit(None).cast("struct<h:bigint,i:int>")), "s")
    twice = F.slice(F.zip_with("s", before, lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"]))), 1, F.greatest(F.size("s"), F.lit(1)))
    starts = F.sort_array(F.array_distinct(F.flatten(F.filter(twice, lambda x: x.isNotNull()))))
    placed = _each_once(placed, "r", starts, "id", "t", "w", "lines")
    # each window covers its words up to where the next one starts
    gaps = F.zip_with("r", F.slice("r", 2, F.greatest(F.size("r"), F.lit(1))), lambda a, b: F.least(F.coalesce(b - a, F.lit(WINDOW)), F.lit(WINDOW)))
    repeated = F.aggregate(gaps, F.lit(0), lambda acc, x: acc + x)
    chars = F.length(F.regexp_replace("t", _WORDS_BETWEEN, ""))
    return placed.select(
        "id", n.cast("long").alias("n_words"), chars.cast("long").alias("word_chars"),
        F.length(F.regexp_replace("t", r"[^#*$%&|<>]", "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated.cast("long").alias("n_repeat_words"), F.size("lines").cast("long").alias("n_lines"),
        F.length(F.regexp_replace("t", r"[^A-Z]", "")).cast("long").alias("n_upper"),
        F.length(F.regexp_replace("t", r"[^.!?]", "")).cast("long").alias("n_ends"), F.length("t").cast("long").alias("n_chars"))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def rules() -> dict[str, Column]:
    """Votes: 1 good, -1 bad, 0 abstains."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    symbols, repeats = F.col("n_symbols") / n, F.col("n_repeat_words") / n
    upper, mean = F.col("n_upper") / F.greatest(F.col("word_chars"), F.lit(1)), F.col("word_chars") / n
    lines, ends = F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)), F.col("n_ends") / n

    def vote(good: Column, bad: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "symbols": vote(symbols < 0.02, symbols > 0.2),
        "repeats": vote(repeats < 0.15, repeats > 0.4),
        "upper": vote(upper < 0.15, upper > 0.4),
        "word_length": vote(mean.between(3, 8), (mean < 2.5) | (mean > 11)),
        "lines": vote(lines < 0.1, (lines > 0.3) & (F.col("n_dup_lines") >= 3)),
        "ends": vote(ends.between(0.02, 0.25), (ends < 0.004) | (ends > 0.5)),
    }


def _likelihoods(names: list[str], rates: dict[str, dict[str, float]], shares: dict[str, float]) -> dict[str, Column]:
    """For each kind of text its share times the probability of the row's votes."""
    out = {}
    for kind, share in shares.items():
        p = F.lit(share)
        for k in names:
            p = p * F.when(F.col(k) == 1, 1 - rates[kind][k]).when(F.col(k) == -1, rates[kind][k]).otherwise(1.0)
        out[kind] = p
    return out


def _posterior(names: list[str], rates: dict[str, dict[str, float]], shares: dict[str, float]) -> Column:
    """Probability of a good text given its votes."""
    p = _likelihoods(names, rates, shares)
    return p[GOOD] / reduce(add, p.values())


def learn(votes: DataFrame, names: list[str], rounds: int = ROUNDS) -> tuple[dict[str, dict[str, float]], dict[str, float]]:
    """(how often each rule votes bad on each kind of text, share of each kind), by EM over all rows.

    Kinds are good texts and, as a rule seldom sees every way to be bad, one kind of bad text for each rule; a
    rule's accuracy is 1 less its rate on good texts, and its rate on bad ones. Rows with equal votes are equal to
    EM and are counted once first: at most 3 ** len(names) rows stay, and each round is one aggregate over them.
    No rows give the starting values.
    """
    patterns = materialise(votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).coalesce(1).sortWithinPartitions(*names))
    kinds = [GOOD, *names]
    start = {c: {k: START_WRONG if c == GOOD else START_OWN if c == k else START_OTHER for k in names} for c in kinds}
    rates, shares = start, {c: START_SHARE if c == GOOD else (1 - START_SHARE) / len(names) for c in kinds}
    sums = [F.sum("n").alias("all")]
    for i, c in enumerate(kinds):
        weight = F.col("n") * F.col(f"p{i}") / F.col("p")
        sums.append(F.sum(weight).alias(f"s{i}"))
        for j, k in enumerate(names):
            sums += [F.sum(F.when(F.col(k) == -1, weight)).alias(f"b{i}_{j}"), F.sum(F.when(F.col(k) != 0, weight)).alias(f"v{i}_{j}")]
    for _ in range(rounds):
        p = [x.alias(f"p{i}") for i, x in enumerate(_likelihoods(names, rates, shares).values())]
        each = patterns.select("*", *p)
        r = each.withColumn("p", reduce(add, [F.col(f"p{i}") for i in range(len(kinds))])).agg(*sums).first()
        if not r["all"]:
            break
        new: dict[str, dict[str, float]] = {}
        for i, c in enumerate(kinds):
            new[c] = {}
            for j, k in enumerate(names):
                rate = ((r[f"b{i}_{j}"] or 0.0) + SMOOTH * start[c][k]) / ((r[f"v{i}_{j}"] or 0.0) + SMOOTH)
                low, high = (EDGE, MOST_WRONG) if c == GOOD else (LEAST_OWN if c == k else EDGE, 1 - EDGE)
                new[c][k] = min(high, max(low, rate))
        rates, shares = new, {c: (r[f"s{i}"] + 1) / (r["all"] + len(kinds)) for i, c in enumerate(kinds)}
    return rates, shares


def judge(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Measures, votes, ``base_failed``, ``posterior`` and ``kept`` of each row of ``docs``.

    ``kept`` is false where the base rule fails, else true from a posterior of 0.5 on. Null and empty texts fail.
    Repeated rows get equal verdicts; null ids are kept as they are.
    """
    cast = rules()
    names = [f"vote_{k}" for k in cast]
    # measured once, read for learning and for the verdict; a few numbers per text
    measured = materialise(measure(docs, id_col, text))
    voted = measured.select("*", *[v.alias(f"vote_{k}") for k, v in cast.items()])
    rates, shares = learn(voted, names)
    failed = base_failed()
    return voted.withColumn("base_failed", failed).withColumn("posterior", _posterior(names, rates, shares)) \
        .withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5))
