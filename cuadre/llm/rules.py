"""Quality rules whose cutoffs bound the false rejections.

A rule rejects a text when a ratio of it exceeds a cutoff. Cutoffs are chosen on labelled documents, per
stratum: with n good documents of the stratum of which k exceed a cutoff, the exact binomial test says how
likely k or fewer are if the rule in truth rejects a share `RISK / rules` of good documents. A cutoff may be used
when that is at most `ERROR / (strata x rules)` for it and for every higher cutoff: the cutoffs of a rule are
tested in a fixed sequence, from the highest down to the first failure, so that their number needs no correction,
and strata and rules are corrected for by Bonferroni. With probability 1 - ERROR every rule keeps its share in
every stratum, and all rules of a stratum together reject at most the share RISK of good documents. Of the
permitted cutoffs that one is taken which separates rejected bad from rejected good documents best, where a share of
good documents weighs GOOD_WEIGHT times as much as one of bad documents, and the highest of equals. Without a permitted cutoff that rejects a labelled bad document the rule is off there.

Strata with fewer good documents than any cutoff needs are pooled, and so are values without labels.

All labelled documents count: they meet in counts by stratum, rule and cutoff step, whose number is fixed.

Defined cases: a null or empty text has all counts 0 and fails the base rules; a null stratum is a stratum;
a document labelled twice counts as bad if any of its labels is; null labels are not used; without labels no
rule is on.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuadre.llm.common import kinds, per_batch, raw, written
from cuadre.llm.signals import NAMES, signals

RISK = 0.1
ERROR = 0.05
#: Cutoffs are the steps k / STEPS of a ratio between 0 and 1.
STEPS = 100
GOOD_WEIGHT = 20
BASE_LEAST_WORDS = 50
BASE_REPEAT_PERCENT = 50


RULES = ("symbols", "upper", "dup_lines", "repeat_words", "digits")


def share(part: Column, whole: Column) -> Column:
    return F.coalesce(F.least(F.lit(1.0), part / F.nullif(whole.cast("double"), F.lit(0.0))), F.lit(0.0))


def ratios() -> dict[str, Column]:
    """Rule of RULES -> ratio between 0 and 1, from the columns of signals.NAMES."""
    c = F.col
    return {
        "symbols": share(c("n_symbols") + c("n_exclaims"), c("n_words")),
        "upper": share(c("n_upper"), c("n_upper") + c("n_lower")),
        "dup_lines": share(c("n_dup_lines"), c("n_lines")),
        "repeat_words": share(c("n_repeat_words"), c("n_words")),
        "digits": share(c("n_digits"), c("word_chars")),
    }


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with the counts of signals.NAMES in place of `text`."""
    carried = [c for c in docs.columns if c not in (text, *NAMES)]
    prepared = docs.select(*[F.col(f"`{c}`") for c in carried], F.col(f"`{text}`").cast("string").alias("text"))

    def make():
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            counts = [signals(x) for x in raw(batch.column(batch.num_columns - 1))]
            columns = [pa.array([x[k] for x in counts], pa.int64()) for k in range(len(NAMES))]
            return pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*carried, *NAMES])

        return one

    return per_batch(prepared, kinds(docs, carried, ", ".join(f"{n} long" for n in NAMES)), make)


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) for X binomial with n trials of probability p: the incomplete beta function
    I_{1-p}(n - k, k + 1) by its continued fraction."""
    if k >= n:
        return 1.0
    a, b, x = float(n - k), float(k + 1), 1.0 - p
    if x > (a + 1) / (a + b + 2):
        return 1.0 - _beta_fraction(b, a, 1.0 - x)
    return _beta_fraction(a, b, x)


def _beta_fraction(a: float, b: float, x: float) -> float:
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, 100_000):
        for step in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + step * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + step / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-13:
            break
    return front * value


POOLED = object()  # stands for all strata that are pooled


def choose_cutoffs(counts: list[tuple[str | None, str, int, int, int]], risk: float, error: float) -> dict:
    """(stratum or POOLED, rule) -> cutoff; strata that are not among the keys belong to POOLED.

    `counts`: stratum, rule, step, good and bad documents; a ratio in step s is above s / STEPS and at most
    (s + 1) / STEPS, and step -1 is 0.
    """
    rules = RULES
    part = risk / len(rules)
    good_of: dict = {}
    for stratum, rule, _, good, _ in counts:
        if rule == rules[0]:
            good_of[stratum] = good_of.get(stratum, 0) + good
    least = math.log(error / ((len(good_of) + 1) * len(rules))) / math.log1p(-part)
    own = {stratum for stratum, good in good_of.items() if good >= least}
    level = error / ((len(own) + 1) * len(rules))
    tables: dict = {}
    for stratum, rule, step, good, bad in counts:
        rows = tables.setdefault((stratum if stratum in own else POOLED, rule), [[0, 0] for _ in range(STEPS + 1)])
        rows[step + 1][0] += good
        rows[step + 1][1] += bad
    chosen = {(stratum, rule): None for stratum in [*own, POOLED] for rule in rules}
    for place, rows in tables.items():
        n, m = (sum(x[k] for x in rows) for k in (0, 1))
        best, over_good, over_bad = 0.0, 0, 0
        for step in range(STEPS - 1, -1, -1):  # the cutoff step / STEPS rejects what lies in this step or above
            over_good, over_bad = over_good + rows[step + 1][0], over_bad + rows[step + 1][1]
            if not n or binomial_tail(over_good, n, part) > level:
                break
            gain = (over_bad / m if m else 0.0) - GOOD_WEIGHT * over_good / n
            if gain > best:
                best, chosen[place] = gain, step / STEPS
    return chosen


def calibrate(
    measured: DataFrame, labels: DataFrame, doc_id: str = "doc_id", stratum: str = "lang",
    risk: float = RISK, error: float = ERROR,
) -> dict:
    """Cutoffs by (stratum, rule) from `labels` (doc_id, quality: 1 good, 0 bad)."""
    known = labels.where(F.col("quality").isNotNull()).groupBy(F.col(doc_id).alias("labelled"))
    known = known.agg(F.min("quality").alias("quality"))
    steps = F.array(
        *[
            # above step / STEPS: a ratio that equals a cutoff is not above it; -1 where it is 0
            F.struct(F.lit(rule).alias("rule"), (F.ceil(value * STEPS) - 1).cast("int").alias("step"))
            for rule, value in ratios().items()
        ]
    )
    rows = (
        measured.join(known, F.col(doc_id) == F.col("labelled"))
        .select(F.col(stratum).alias("stratum"), "quality", F.explode(steps).alias("x"))
        .groupBy("stratum", "x.rule", "x.step")
        .agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") != 1).alias("bad"))
        .collect()
    )
    return choose_cutoffs([tuple(r) for r in rows], risk, error)


def judge(measured: DataFrame, cutoffs: dict, stratum: str = "lang") -> DataFrame:
    """`measured` with `base_failed`, `failed_rules` (their names) and `kept`."""
    columns = ratios()
    tests = []
    for rule, value in columns.items():
        cut = F.lit(cutoffs.get((POOLED, rule))).cast("double")
        for (where, of_rule), at in cutoffs.items():
            if of_rule == rule and where is not POOLED:
                cut = F.when(F.col(stratum).eqNullSafe(F.lit(where)), F.lit(at).cast("double")).otherwise(cut)
        # compared in whole steps, as in the counts
        tests.append(F.when(F.ceil(value * STEPS) - 1 >= F.round(cut * STEPS), F.lit(rule)))
    base = (F.col("n_words") < BASE_LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > BASE_REPEAT_PERCENT * F.col("n_words")
    )
    return (
        measured.withColumn("base_failed", base)
        .withColumn("failed_rules", F.array_compact(F.array(*tests)))
        .withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))
    )


def screen(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Measures `docs` once, chooses cutoffs by `labels` and judges. The counts are written in between."""
    measured = written(measure(docs, text), "signals")
    return judge(measured, calibrate(measured, labels, doc_id, stratum), stratum)
