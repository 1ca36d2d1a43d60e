"""Document rates that bring soft domain memberships to target weights.

A classifier fitted to labelled documents gives every document a posterior over domains.
Projected gradient descent on a least-squares problem then finds the non-negative rates
closest to 1 under which the expected tokens of the domains have the wanted shares.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimwright.llm.storage import written

SPACES = "[ \t\n\u000b\f\r]+"
# Labelled documents that the classifier is fitted to.
MAX_LABELLED = 8_000
# The share of all tokens by which a domain may miss its target.
TOLERANCE = 1e-4
# Keeps steps finite where no rates reach the targets; far below the tolerance elsewhere.
SLACK = 1e-12
# Words' worth of evidence that one text can give; more words sharpen it no further.
EVIDENCE = 20.0
# Repeats of a row made at once.
RUN = 10_000


def _words(text: str) -> Column:
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    return F.array_remove(F.split(lowered, SPACES), "")


def word_model(
    labelled: DataFrame,
    domain: str,
    domains: list[str],
    *,
    max_rows: int = MAX_LABELLED,
    max_words: int = 2_048,
) -> DataFrame:
    """``word, logs``: log-likelihoods of a word in every domain, from a bounded sample.

    At most ``max_rows`` labelled documents are drawn, in the order of a hash of their id,
    and the ``max_words`` words that tell most about the domain are kept. The row of the
    empty word holds the log shares of the domains.
    """
    drawn = (
        labelled.where(F.col(domain).isin(domains) & F.col("text").isNotNull())
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_rows)
    )
    drawn = written(drawn.select(F.col(domain).alias("domain"), _words("text").alias("words")), "mixing-sample")
    shares = {
        row.domain: row["count"] for row in drawn.groupBy("domain").count().collect()
    }
    total = sum(shares.values()) + len(domains)
    logs = [math.log((shares.get(d, 0) + 1) / total) for d in domains]
    counts = drawn.select("domain", F.explode("words").alias("word")).groupBy("word").agg(
        *(F.count_if(F.col("domain") == d).cast("double").alias(f"c{k}") for k, d in enumerate(domains))
    )
    sums = counts.agg(*(F.sum(f"c{k}") for k in range(len(domains)))).first()
    of_all = [float(value or 0) + max_words for value in sums]
    likelihoods = [(F.col(f"c{k}") + 1) / of_all[k] for k in range(len(domains))]
    mean = sum(likelihoods[1:], likelihoods[0]) / len(domains)
    telling = sum(
        (F.col(f"c{k}") * F.log(likelihoods[k] / mean) for k in range(len(domains))), F.lit(0.0)
    )
    best = (
        counts.withColumn("telling", telling)
        .orderBy(F.desc("telling"), "word")
        .limit(max_words)
        .select("word", F.array(*(F.log(p) for p in likelihoods)).alias("logs"))
    )
    prior = drawn.sparkSession.createDataFrame([("", logs)], "word string, logs array<double>")
    return written(best.union(prior), "mixing-model")


def posteriors(docs: DataFrame, model: DataFrame, domains: list[str]) -> DataFrame:
    """``doc_id, text_id, copies, n_tokens, shares``: the posterior over domains of every text.

    Rows that agree in id and text are one row here, with their number in ``copies``.
    """
    rows = docs.select(
        "doc_id", F.xxhash64("text").alias("text_id"), _words("text").alias("words")
    )
    said = rows.select(
        "doc_id",
        "text_id",
        F.size("words").cast("long").alias("n_tokens"),
        F.explode(F.concat(F.array(F.lit("")), "words")).alias("word"),
    )
    # At most max_words rows and one more.
    known = said.join(F.broadcast(model), "word")
    is_prior = F.col("word") == ""
    ids = ["doc_id", "text_id", "n_tokens"]
    summed = known.groupBy(*ids).agg(
        F.count_if(is_prior).alias("copies"),
        F.count_if(~is_prior).alias("known"),
        *(F.sum(F.when(~is_prior, F.col("logs")[k]).otherwise(0.0)).alias(f"w{k}") for k in range(len(domains))),
        *(F.max(F.when(is_prior, F.col("logs")[k])).alias(f"p{k}") for k in range(len(domains))),
    )
    worth = F.least(F.lit(EVIDENCE), F.col("known") / F.col("copies")) / F.greatest(
        F.col("known"), F.lit(1)
    )
    scores = F.array(*(F.col(f"p{k}") + F.col(f"w{k}") * worth for k in range(len(domains))))
    scored = summed.select(*ids, "copies", scores.alias("scores"))
    top = F.array_max("scores")
    raised = scored.withColumn(
        "raised", F.transform("scores", lambda s: F.exp(s - top))
    )
    weight = F.aggregate("raised", F.lit(0.0), lambda a, x: a + x)
    return raised.withColumn("weight", weight).select(
        "doc_id",
        "text_id",
        "copies",
        "n_tokens",
        F.transform("raised", lambda x: x / F.col("weight")).alias("shares"),
    )


def fit_rates(
    members: DataFrame, targets: Mapping[str, float], *, tolerance: float = TOLERANCE, rounds: int = 100
) -> DataFrame:
    """``members`` with ``rate``: expected domain tokens come to ``targets`` of all tokens.

    The rates are the non-negative ones closest to 1, with no upper bound: 1 and a multiple of
    the tokens in each domain, projected on zero and above. Every round aggregates the domains'
    tokens and their products over the rates above zero, and moves the multipliers against the
    gradient, scaled by these products; a step that overshoots is halved. A round stores
    nothing but one number a domain. Ends when all domains are within ``tolerance`` of their
    share, or no step leads nearer, or after ``rounds``.

    ``residuals`` has for each domain the reached share less the wanted one. Targets that no
    rates reach, as of a domain that no text belongs to, show there, and a warning names them.
    """
    n = len(targets)
    a = [F.col("n_tokens") * F.col("shares")[k] for k in range(n)]
    copies = F.col("copies").cast("double")
    squares = [F.sum(copies * a[k] * a[k]) for k in range(n)]
    first = members.agg(F.sum(copies * F.col("n_tokens")), *squares).first()
    total = float(first[0] or 0)
    used = [k for k in range(n) if float(first[1 + k] or 0) > 0]
    if not used:
        nothing = F.array(*(F.lit(0.0) for _ in targets))
        return members.withColumn("rate", F.lit(1.0)).withColumn("residuals", nothing)
    whole = sum(targets.values()) or 1.0
    weights = [weight / whole for weight in targets.values()]
    left = sum(weights[k] for k in used) or 1.0
    scale = np.sqrt([float(first[1 + k]) for k in used])
    wanted = np.array([weights[k] / left * total for k in used]) / scale
    near = [a[k] / F.lit(float(scale[i])) for i, k in enumerate(used)]
    # One weight a token missed, whatever the domain.
    slack = SLACK * (scale.max() / scale) ** 2
    m = len(used)

    def rates(at: np.ndarray) -> Column:
        moved = sum((near[i] * F.lit(float(at[i])) for i in range(m)), F.lit(1.0))
        return F.greatest(F.lit(0.0), moved)

    def aggregated(at: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Half the squared rates less their due, the residuals, and the products."""
        rate = rates(at)
        above = copies * (rate > 0).cast("double")
        row = members.agg(
            F.sum(copies * rate * rate),
            *(F.sum(copies * near[i] * rate) for i in range(m)),
            *(F.sum(above * near[i] * near[j]) for i in range(m) for j in range(m)),
        ).first()
        values = np.array([float(value) for value in row])
        cost = values[0] / 2 - at @ wanted + (slack * at) @ at / 2
        return cost, values[1 : 1 + m] - wanted, values[1 + m :].reshape(m, m)

    at = np.zeros(m)
    cost, residual, products = aggregated(at)
    for _ in range(rounds):
        if (np.abs(residual * scale) <= tolerance * total).all():
            break
        slope = residual + slack * at
        step = -np.linalg.solve(products + np.diag(slack), slope)
        part, found = 1.0, aggregated(at + step)
        while found[0] > cost + 1e-4 * part * (slope @ step) and part > 1e-6:
            part /= 2
            found = aggregated(at + part * step)
        if found[0] >= cost:
            break
        at = at + part * step
        cost, residual, products = found
    reached = np.zeros(n)
    reached[used] = (residual + wanted) * scale / total
    missed = reached - np.array(weights)
    if (np.abs(missed) > tolerance).any():
        shares = ", ".join(f"{d} by {x:+.4f}" for d, x in zip(targets, missed))
        warnings.warn(f"mixing rates miss the target shares: {shares}", stacklevel=2)
    return members.withColumn("rate", rates(at)).withColumn(
        "residuals", F.array(*(F.lit(float(x)) for x in missed))
    )


def mixing_rates(
    docs: DataFrame, labels: DataFrame, targets: Mapping[str, float], domain: str = "lang"
) -> DataFrame:
    """``doc_id, text_id, copies, n_tokens, shares, rate, residuals`` of every distinct id and text.

    The classifier learns ``domain`` from the documents listed in ``labels``, by their words
    alone. Without any, every text has the same posterior. Null and empty texts have the
    domains' shares among the labelled documents, and no tokens, so their rate stays 1.
    """
    domains = list(targets)
    listed = labels.where(F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # At most MAX_LABELLED ids, drawn before any text is read.
    drawn = listed.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELLED)
    # One text an id, the smallest, so that the sample is bounded in texts as well.
    labelled = (
        docs.where(F.col("text").isNotNull())
        .select("doc_id", F.struct("text", F.col(domain).alias("domain")).alias("one"))
        .join(F.broadcast(drawn), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min("one").alias("one"))
        .select("doc_id", "one.text", "one.domain")
    )
    model = word_model(labelled, "domain", domains)
    members = written(posteriors(docs, model, domains), "memberships")
    return fit_rates(members, targets)


def mixture(docs: DataFrame, labels: DataFrame, targets: Mapping[str, float]) -> DataFrame:
    """``doc_id, n_tokens, domain, shares, rate, residuals`` of every row.

    The likeliest domain is named. ``residuals``, the same in every row, has for each domain
    the reached share of tokens less the wanted one, zero within the tolerance of the fit.
    Repeated rows have the same rate; a null id is kept; no rows give no rows.
    """
    domains = list(targets)
    rated = mixing_rates(docs, labels, targets)
    best = F.array_position("shares", F.array_max("shares"))
    names = F.array(*(F.lit(d) for d in domains))
    return rated.select(
        "doc_id",
        "n_tokens",
        F.element_at(names, best.cast("int")).alias("domain"),
        "shares",
        "rate",
        "residuals",
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy"),
    ).drop("copy")


def resampled(docs: DataFrame, rates: DataFrame) -> DataFrame:
    """Every row of ``docs`` as often as its rate says.

    A rate of 2.3 gives two rows, and a third where a hash of the id and text, as good as
    random but the same in every run, falls below 0.3.
    """
    names = docs.columns
    by_row = rates.select(
        F.col("doc_id").alias("cw_doc"), F.col("text_id").alias("cw_text"), F.col("rate").alias("cw_rate")
    )
    text_id = F.xxhash64("text")
    chance = F.pmod(F.xxhash64("doc_id", text_id), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (
        docs.join(
            by_row,
            F.col("doc_id").eqNullSafe(F.col("cw_doc")) & (text_id == F.col("cw_text")),
        )
        .withColumn("cw_rows", F.floor(F.col("cw_rate") + chance))
        .where("cw_rows > 0")
        # In runs, so that no array grows with the rate.
        .withColumn("cw_run", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(cw_rows - 1) div {RUN}"))))
        .withColumn("cw_left", F.least(F.lit(RUN).cast("long"), F.col("cw_rows") - F.col("cw_run") * RUN))
        .withColumn("cw_row", F.explode(F.sequence(F.lit(1).cast("long"), "cw_left")))
        .select(*(F.col(f"`{name}`") for name in names))
    )
