"""Quality rules with risk-controlled thresholds.

Base facts of each text are counted (``facts``). Rules reject a text whose measure is on the wrong side of a cutoff
(``RULES``); which cutoffs are used is decided on labelled holdout rows:

1. For each stratum (language), rule and candidate cutoff, Spark counts the good rows (quality 1) and the others that
   the cutoff would reject. Only these counts, whose number is strata x rules x candidates, reach the driver.
2. For each rule and each of a few shares of ``risk``, the cutoffs are tested in fixed sequence from lax to strict: a
   cutoff holds if the exact (Clopper-Pearson) upper bound on its false rejection rate is within the share, and the first
   that does not ends the sequence. So the error is divided by strata, rules and shares, not by cutoffs (Bonferroni), and
   all sequences hold at once, whichever are used.
3. Rules get the shares, of ``risk`` in all, that reject most rows that are not good: what one rule does not need, others get.
   All rules together reject at most ``risk`` of a stratum's good texts, with probability 1 - ``delta``. A rule without a
   share rejects nothing.
4. Strata with too few labels for all rules at once (even without any false rejection) are pooled: they share cutoffs, and
   what is bounded is the rate over all of them together. If even the pool is too small for one rule, all strata are pooled for them.

A text is kept if it passes the base rule and no chosen rule rejects it.

Defined cases: null and empty texts have no words and fail the base rule; a text whose stratum is null is of the stratum
''; a stratum without labels has no rules, one with only bad labels is pooled; several labels of one id: it is good only if all non-null ones are 1;
labels without id or quality are not used; ratios with nothing below the line are 0. Rows with one id are separate rows.
Other columns are carried in ``rest``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvest.llm._text import U64, WORD, cut, gram_hashes, mix, pieces, rest_of

SYMBOL = re.compile(r"[#*$%&|<>]")
WHITE = [chr(c) for c in (0x20, *range(0x09, 0x0E))]
FACTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


class Codes(dict):
    """A 64-bit number for each word seen of late, from its place in the order they were met: equal only for equal words."""

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        return n


def repeated_words(codes: np.ndarray, size: int = 5) -> int:
    """Words that lie in a window found twice or more."""
    n = len(codes) - size + 1
    if n < 2:
        return 0
    grams = gram_hashes(mix(codes.astype(np.uint64) + U64(1)), size)
    order = np.argsort(grams)
    s = grams[order]
    same = s[1:] == s[:-1]
    if not same.any():
        return 0
    edge = np.zeros(len(codes) + 1, np.int32)
    twice = np.zeros(n, np.int32)
    twice[order[1:][same]] = 1
    twice[order[:-1][same]] = 1
    edge[:n] += twice
    edge[size:size + n] -= twice
    return int((np.cumsum(edge[:-1]) > 0).sum())


def count_facts(text: str | None, known: Codes) -> tuple[int, ...]:
    """The facts of one text, in the order of FACTS."""
    words = WORD.findall(text) if text else []
    if not words:
        return 0, 0, 0, 0, 0
    if len(known) > 200_000:
        known.clear()
    lines = [x for x in text.split("\n") if x.strip("\t\n\x0b\x0c\r ")]
    return (len(words), len(text) - sum(map(text.count, WHITE)), len(SYMBOL.findall(text)), len(lines) - len(set(lines)),
            repeated_words(np.fromiter(map(known.__getitem__, words), np.int64, len(words))))


def facts(docs: DataFrame, text: str = "text") -> DataFrame:
    """rest (all columns but the text), text and the facts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Codes()
        for b in pieces(batches):
            cols = zip(*(count_facts(t, known) for t in b.column("text").to_pylist()))
            yield pa.RecordBatch.from_arrays([b.column("rest"), *(pa.array(c, pa.int64()) for c in cols)], ["rest", *FACTS])

    frame = docs.select(rest_of(docs, text), F.col(text).cast("string").alias("text"))
    return frame.mapInArrow(run, f"rest {dict(frame.dtypes)['rest']}, " + ", ".join(f"{f} long" for f in FACTS))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def per_word(fact: str) -> Column:
    return F.coalesce(F.col(fact) / F.nullif(F.col("n_words"), F.lit(0)), F.lit(0.0))


#: Each rule: its measure, whether it rejects values above (1) or below (-1) the cutoff, and candidates from strict to lax.
RULES: dict[str, tuple[Column | None, int, list[float]]] = {
    "symbols": (None, 1, [0.02, 0.05, 0.1, 0.2, 0.3, 0.5, 1.0]),
    "dup_lines": (None, 1, [1, 2, 3, 5, 8, 13, 21]),
    "repeats": (None, 1, [0.02, 0.04, 0.06, 0.08, 0.1, 0.13, 0.16]),
    "long_words": (None, 1, [6, 7, 8, 9, 10, 12, 15, 20]),
    "short_words": (None, -1, [5, 4.5, 4, 3.5, 3, 2.5, 2]),
    "short": (None, -1, [50, 40, 30, 25, 20, 15, 12]),
}


def measure(rule: str) -> Column:
    return {"symbols": lambda: per_word("n_symbols"), "dup_lines": lambda: F.col("n_dup_lines").cast("double"),
            "repeats": lambda: per_word("n_repeat_words"), "long_words": lambda: per_word("word_chars"),
            "short_words": lambda: per_word("word_chars"), "short": lambda: F.col("n_words").cast("double")}[rule]()


def rejects(rule: str, cutoff: Column | float) -> Column:
    return (measure(rule) - cutoff) * RULES[rule][1] > 0


def upper_bound(k: int, n: int, error: float) -> float:
    """The exact upper confidence bound on a rate of which k in n were seen: the rate at which k or fewer have probability ``error``."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if binomial_cdf(k, n, p) > error else (low, p)
    return high


def binomial_cdf(k: int, n: int, p: float) -> float:
    """P(X <= k), summed from the largest term down."""
    if p <= 0 or p >= 1:
        return float(p <= 0 or k >= n)
    if k > n * p:
        return 1 - binomial_cdf(n - k - 1, n, 1 - p)
    term = math.exp(math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p))
    total, i = 0.0, k
    while i >= 0 and term > total * 1e-17:
        total += term
        term *= i / (n - i + 1) * (1 - p) / p
        i -= 1
    return min(total, 1.0)


def choose(labelled: DataFrame, risk: float = 0.03, delta: float = 0.05, strata: int = 1000) -> dict[str, dict[str, float]]:
    """stratum -> rule -> cutoff. labelled: stratum, good, facts, base_failed. More than ``strata`` strata are refused."""
    tests = [(rule, c) for rule, (_, _, candidates) in RULES.items() for c in candidates]
    counts = labelled.groupBy("stratum").agg(F.count_if("good").alias("n"), *[F.count_if(side & rejects(r, F.lit(c))).alias(f"{name}{i}")
                                             for name, side in (("t", F.col("good")), ("b", ~F.col("good"))) for i, (r, c) in enumerate(tests)])
    rows = counts.limit(strata + 1).collect()
    if len(rows) > strata:
        raise ValueError(f"over {strata} strata")
    error = delta / ((len(rows) + 1) * len(RULES) * len(SHARES))
    groups = {r.stratum: r.asDict() for r in rows}
    few = [s for s, r in groups.items() if upper_bound(0, r["n"], error) > risk / len(RULES)]
    total = lambda names: {k: sum(groups[s][k] for s in names) for k in rows[0].asDict() if k != "stratum"}
    out = {s: cutoffs(r, tests, risk, error) for s, r in groups.items() if s not in few}
    if few:
        pool = total(few)
        pool = cutoffs(pool if upper_bound(0, pool["n"], error) <= risk else total(groups), tests, risk, error)
        out |= {s: pool for s in few}
    return out


#: Parts of the risk that a rule can get.
UNITS = 12
SHARES = (1, 2, 3, 4, 6, 12)


def cutoffs(counts: dict[str, int], tests: list[tuple[str, float]], risk: float, error: float) -> dict[str, float]:
    """rule -> cutoff. counts: n, and the good (t) and other (b) rows that each test rejects."""
    best: list[tuple[int, int, dict[str, float]]] = [(0, 0, {})] * (UNITS + 1)     # by parts spent: other rows rejected, strictness, cutoffs
    for rule in RULES:
        mine = [(i, c) for i, (r, c) in enumerate(tests) if r == rule][::-1]      # lax to strict
        now = list(best)
        for share in SHARES:
            held = 0
            while held < len(mine) and upper_bound(counts[f"t{mine[held][0]}"], counts["n"], error) <= risk * share / UNITS:
                held += 1
            if held:
                i, c = mine[held - 1]
                for spent in range(share, UNITS + 1):
                    others, strict, chosen = best[spent - share]
                    now[spent] = max(now[spent], (others + counts[f"b{i}"], strict + held, chosen | {rule: c}), key=lambda x: x[:2])
        best = now
    return max(best, key=lambda x: x[:2])[2]


def quality(docs: DataFrame, labels: DataFrame, risk: float = 0.03, delta: float = 0.05, doc_id: str = "doc_id", text: str = "text",
            stratum: str = "lang") -> DataFrame:
    """rest (all columns but the text), the facts, base_failed, rejected_by (the rules' names) and kept."""
    rows = cut(facts(docs, text).withColumns({"base_failed": base_failed(), "stratum": F.coalesce(F.col(f"rest.`{stratum}`").cast("string"), F.lit(""))}))
    verdicts = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("label_id")).agg((F.min("quality") == 1).alias("good"))
    labelled = rows.select(F.col(f"rest.`{doc_id}`").alias("id"), "stratum", "base_failed", *FACTS).join(verdicts, F.col("id") == F.col("label_id"))
    chosen = choose(labelled.where("not base_failed"), risk, delta)
    names = []
    for rule in RULES:
        cutoffs = [F.lit(x) for s, c in chosen.items() if rule in c for x in (s, float(c[rule]))]
        if cutoffs:
            names.append(F.when(rejects(rule, F.create_map(*cutoffs)[F.col("stratum")]), F.lit(rule)))
    by = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return (rows.withColumn("rejected_by", by).withColumn("kept", ~F.col("base_failed") & (F.size("rejected_by") == 0)).drop("stratum"))


def digest(found: DataFrame) -> DataFrame:
    return found.select("rest.doc_id", *FACTS, "base_failed", "kept", "rejected_by")
