"""Mixing to target weights by soft membership, in DataFrame functions only.

A naive Bayes classifier, counted on a bounded sample of the labelled table, gives each document
posterior probabilities of the domains. Rates of the documents, 0 or more, are then fitted by
projected gradients of least squares, so that the tokens expected of each domain meet the
targets; where the gradients end short of them, Newton steps on one number per domain find the
nearest rates that do. An iteration is one sum over the documents; what it finds is one number per domain, and
a document's rate follows from those numbers and its own posteriors.
"""

from __future__ import annotations

import warnings

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from barlake.llm.common import stored

#: Domains of the labelled table, with their shares of the mixture.
TARGETS = {"high": 0.80, "low": 0.18, "toxic": 0.02}
#: Bounds: labelled rows that the classifier is counted on, and hashed words that it knows.
SAMPLE_ROWS, BUCKETS = 20_000, 1 << 16
#: Smoothing adds to each domain this share of all words, spread like the words of all domains.
SMOOTHING = 0.05
#: Least log ratio of a word's share of a domain to its share of all.
LEAST_EVIDENCE = 0.7
ITERATIONS, TOLERANCE = 25, 1e-4
#: Newton steps at most, the parts of a step that a pass tries, and the weights of its ridge one after the other.
NEWTON_STEPS, PARTS, RIDGES = 60, (1.0, 0.5, 0.25, 0.0625), (1e-4, 1e-6, 1e-8, 1e-10)


def domain_of_labels() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "high").otherwise("low")


def _words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"\s+"), "")


def _buckets() -> Column:
    """Hashed different words as they are written, and how often words repeat: never empty."""
    distinct = F.array_distinct("words")
    repeats = F.floor(10 * F.size(distinct) / F.greatest(F.size("words"), F.lit(1)))
    named = F.concat(distinct, F.array(F.concat(F.lit(" distinct "), repeats.cast("string"))))
    return F.transform(named, lambda w: F.pmod(F.xxhash64(w), F.lit(BUCKETS)).cast("int"))


def classifier(spark: SparkSession, docs: DataFrame, labels: DataFrame, domains: list[str], *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``bucket`` and the log-likelihood of each domain; bucket -1 holds the log-priors.

    Labels without doc_id, quality or toxic are left out; if a doc_id is labelled or present
    twice, each of its rows counts. A domain without samples keeps its smoothing alone.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
    # The bound of the sample is what makes this side small.
    sample = usable.select("doc_id", domain_of_labels().alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(sample_rows)
    texts = docs.select("doc_id", _words(F.col("text")).alias("words")).join(F.broadcast(sample), "doc_id")
    # Copies of a text are one example.
    texts = texts.dropDuplicates(["domain", "words"])
    seen = texts.select("domain", F.explode(F.concat(_buckets(), F.array(F.lit(-1)))).alias("bucket"))
    counted = seen.groupBy("bucket").agg(*[F.count_if(F.col("domain") == d).alias(d) for d in domains])
    counts = stored(spark, counted, "counts")
    totals = counts.where("bucket >= 0").agg(*[F.coalesce(F.sum(d), F.lit(0)).alias(d) for d in domains]).first()
    rows = counts.where("bucket = -1").select(*[F.col(d) for d in domains]).first() or {d: 0 for d in domains}
    rows = {d: rows[d] for d in domains}
    every = sum(rows.values())

    words = sum(totals[d] for d in domains)
    added = SMOOTHING * words + 1.0
    overall = (sum((F.col(d) for d in domains), F.lit(0)) + 0.5) / F.lit(words + 0.5 * BUCKETS)

    def weight(domain: str) -> Column:
        # Shares of a domain are drawn towards those of all, so that rare words say little.
        # A share near that of all words is no evidence: thousands of them would still add up.
        prior = F.log(F.lit((rows[domain] + 1) / (every + len(domains))))
        word = F.log((F.col(domain) + added * overall) / F.lit(totals[domain] + added) / overall)
        word = F.when(F.abs(word) >= LEAST_EVIDENCE, word).otherwise(0.0)
        return F.when(F.col("bucket") == -1, prior).otherwise(word).alias(domain)

    known = spark.range(-1, BUCKETS, numPartitions=1).select(F.col("id").cast("int").alias("bucket")).join(counts, "bucket", "left")
    return known.na.fill(0).select("bucket", *[weight(d) for d in domains])


def posteriors(docs: DataFrame, weights: DataFrame, domains: list[str]) -> DataFrame:
    """``doc_id, n_tokens`` and ``p_<domain>`` of every row."""
    words = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.monotonically_increasing_id().alias("row"), _words(F.col("text")).alias("words")
    )
    seen = words.select(
        "doc_id", "row", F.size("words").cast("bigint").alias("n_tokens"), F.explode(F.concat(_buckets(), F.array(F.lit(-1)))).alias("bucket")
    )
    # The table of weights has a fixed number of rows.
    scored = seen.join(F.broadcast(weights), "bucket").groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_tokens").alias("n_tokens"), *[F.sum(d).alias(d) for d in domains]
    )
    best = F.greatest(*domains) if len(domains) > 1 else F.col(domains[0])
    raised = scored.select("doc_id", "n_tokens", *[F.exp(F.col(d) - best).alias(d) for d in domains])
    total = sum((F.col(d) for d in domains), F.lit(0.0))
    return raised.select("doc_id", "n_tokens", *[(F.col(d) / total).alias(f"p_{d}") for d in domains])


def _inverse(matrix: list[list[float]]) -> list[list[float]]:
    """Inverse of a small positive matrix."""
    size = len(matrix)
    rows = [[*row, *(float(i == j) for j in range(size))] for i, row in enumerate(matrix)]
    for i in range(size):
        pivot = max(range(i, size), key=lambda k: abs(rows[k][i]))
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(size):
            if k != i:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i], strict=True)]
    return [row[size:] for row in rows]


def rate(steps: list[list[float]], domains: list[str], start: Column | None = None) -> Column:
    """A document's rate after the given steps from ``start`` (1), cut off at 0 after each."""
    start = F.lit(1.0) if start is None else start
    if not steps:
        return start
    history = F.array(*[F.array(*[F.lit(float(x)) for x in step]) for step in steps])

    def descend(value, step):
        move = sum((step[k] * F.col(f"p_{d}") for k, d in enumerate(domains)), F.lit(0.0))
        return F.greatest(F.lit(0.0), value - move)

    return F.aggregate(history, start, descend)


def fit_rates(members: DataFrame, targets: dict[str, float]) -> tuple[list[list[float]], list[float]]:
    """Gradient steps, and the shares of the domains that they reach.

    Least squares of (expected share - target), measured in the metric of the memberships, so that
    rare domains converge as fast as common ones. Rates fit the size of the whole input. Stops
    when no share is off by more than ``TOLERANCE``, or nothing changes, or after ``ITERATIONS``.
    """
    domains = list(targets)
    tokens = F.col("n_tokens").cast("double")
    pairs = [(a, b) for a in domains for b in domains]
    first = members.agg(
        F.sum(tokens).alias("size"), *[F.sum(tokens * F.col(f"p_{a}") * F.col(f"p_{b}")).alias(f"{a}*{b}") for a, b in pairs]
    ).first()
    size = first["size"] or 0.0
    if size == 0:
        return [], [0.0] * len(domains)
    gram = [[first[f"{a}*{b}"] / size + (1e-9 if a == b else 0.0) for b in domains] for a in domains]
    metric = _inverse(gram)
    steps: list[list[float]] = []
    shares: list[float] = []
    for _ in range(ITERATIONS):
        sums = members.agg(*[F.sum(tokens * rate(steps, domains) * F.col(f"p_{d}")).alias(d) for d in domains]).first()
        before, shares = shares, [sums[d] / size for d in domains]
        off = [s - targets[d] for s, d in zip(shares, domains, strict=True)]
        if max(map(abs, off)) <= TOLERANCE or (before and max(abs(a - b) for a, b in zip(before, shares, strict=True)) < TOLERANCE / 100):
            break
        steps.append([sum(m * o for m, o in zip(row, off, strict=True)) for row in metric])
    return steps, shares


def finish_rates(members: DataFrame, targets: dict[str, float]) -> tuple[list[float], list[float], bool]:
    """One more step from the column ``rate``, the shares that it reaches, and whether it is final.

    The step leads to the rates of 0 or more nearest to ``rate`` (squares weighed by tokens) with
    the target shares: the minimum of a convex function of one number per domain, found by Newton
    steps over the documents whose rate is above 0. A small ridge makes the minimum exist where
    the targets are out of reach; it then is the least-squares point of the shares. Final are
    shares within ``TOLERANCE``, and such a point.
    """
    domains = list(targets)
    goal, count = np.array([targets[d] for d in domains]), len(domains)
    tokens = F.col("n_tokens").cast("double")
    pairs = [(i, j) for i in range(count) for j in range(i, count)]

    def values(points):
        """At each point the function without ridge, the shares, and the second derivatives, in one pass."""
        rates = members.select(
            tokens.alias("tokens"), *[f"p_{d}" for d in domains],
            *[F.greatest(F.lit(0.0), F.col("rate") - sum((F.lit(float(x)) * F.col(f"p_{d}") for x, d in zip(p, domains, strict=True)), F.lit(0.0))).alias(f"rate_{n}") for n, p in enumerate(points)],
        )
        sums = [F.sum("tokens")]
        for n in range(len(points)):
            weight, held = F.col("tokens") * F.col(f"rate_{n}"), F.when(F.col(f"rate_{n}") > 0, F.col("tokens")).otherwise(0.0)
            sums += [F.sum(weight * F.col(f"rate_{n}")), *[F.sum(weight * F.col(f"p_{d}")) for d in domains]]
            sums += [F.sum(held * F.col(f"p_{domains[i]}") * F.col(f"p_{domains[j]}")) for i, j in pairs]
        size, *rest = rates.agg(*[c.alias(f"sum_{n}") for n, c in enumerate(sums)]).first()
        found = []
        for point, row in zip(points, np.array(rest, float).reshape(len(points), -1) / size if size else [], strict=bool(size)):
            second = np.zeros((count, count))
            for (i, j), x in zip(pairs, row[1 + count :], strict=True):
                second[i, j] = second[j, i] = x
            found.append((point, row[0] / 2 + point @ goal, row[1 : 1 + count], second))
        return found

    begun = values([np.zeros(count)])
    if not begun:
        return [0.0] * count, [0.0] * count, True
    (point, value, shares, second), ridge, scale = begun[0], 0, 1.0
    for _ in range(NEWTON_STEPS):
        # On to the next ridge where this one's minimum is reached, or steps have become too small to tell.
        while ridge < len(RIDGES) and (np.abs(goal - shares + RIDGES[ridge] * point).max() <= TOLERANCE / 100 or scale < 1e-9):
            ridge, scale = ridge + 1, 1.0
        if np.abs(shares - goal).max() <= TOLERANCE or ridge == len(RIDGES):
            break
        sizes, axes = np.linalg.eigh(second)
        down = goal - shares + RIDGES[ridge] * point
        step = -axes @ ((axes.T @ down) / (np.maximum(sizes, 0.0) + RIDGES[ridge]))
        best = min(values([point + scale * part * step for part in PARTS]), key=lambda f: f[1] + RIDGES[ridge] / 2 * (f[0] @ f[0]))
        if best[1] + RIDGES[ridge] / 2 * (best[0] @ best[0]) < value + RIDGES[ridge] / 2 * (point @ point):
            (point, value, shares, second), scale = best, 1.0
        else:
            scale /= 64
    final = bool(np.abs(shares - goal).max() <= TOLERANCE or np.abs(goal - shares + RIDGES[-1] * point).max() <= TOLERANCE / 100)
    return point.tolist(), shares.tolist(), final


def mixture(spark: SparkSession, members: DataFrame, targets: dict[str, float]) -> tuple[DataFrame, list[float], bool]:
    """``members`` with their ``rate``, the shares of the domains reached, and whether no rates come nearer."""
    domains = list(targets)
    steps, shares = fit_rates(members, targets)
    if all(abs(s - targets[d]) <= TOLERANCE for s, d in zip(shares, domains, strict=True)):
        return members.withColumn("rate", rate(steps, domains)), shares, True
    begun = stored(spark, members.withColumn("rate", rate(steps, domains)), "rates")
    step, shares, final = finish_rates(begun, targets)
    return begun.withColumn("rate", rate([step], domains, F.col("rate"))), shares, final


def mix(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, targets: dict[str, float] | None = None, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per document: ``doc_id, n_tokens, p_<domain>..., rate``.

    ``rate`` says how often a document is to be read: its tokens times rate times posterior, summed
    over all documents, are the target shares of all tokens (as near as rates of 0 or more
    allow; a warning gives the shares where they are off by more than ``TOLERANCE``). Texts that are null or empty have no tokens and a rate like others of their
    posteriors. Without labels all domains are equally likely. Repeated rows and null doc_ids
    are kept; an empty table gives no rows.
    """
    targets = targets or TARGETS
    domains = list(targets)
    weights = stored(spark, classifier(spark, docs, labels, domains, sample_rows=sample_rows), "weights")
    members = stored(spark, posteriors(docs, weights, domains), "members")
    mixed, shares, final = mixture(spark, members, targets)
    if any(shares) and any(abs(s - targets[d]) > TOLERANCE for s, d in zip(shares, domains, strict=True)):
        why = "no rates of 0 or more come nearer" if final else f"not converged after {NEWTON_STEPS} Newton steps"
        reached = ", ".join(f"{d} {s:.4f} for {targets[d]:.4f}" for s, d in zip(shares, domains, strict=True))
        warnings.warn(f"mixture off its targets ({why}): {reached}", stacklevel=2)
    return mixed.select("doc_id", "n_tokens", *[f"p_{d}" for d in domains], "rate")
