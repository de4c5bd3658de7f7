"""Mixing documents to target weights of domains, in DataFrame operations only.

A classifier learned from a labelled table gives every document a posterior
over domains (naive Bayes on the presence of telling words and of a few
statistics).  Document rates are then fitted by least squares: they stay as
near to 1 as the targets allow, and never fall below 0.  A rate is 1 minus a
product of the document's posteriors with one number per domain, projected to
0 or more; the numbers come from gradient steps, scaled by the curvature, and
each step needs only sums that Spark takes over all documents.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.shared import written

#: Labelled rows (about) from which the classifier learns.
TRAIN_ROWS = 20_000
#: Telling words that it keeps, and the share of them that may tell by chance.
LEXICON = 100
FALSE_WORDS = 0.01
#: How much a telling word raises the odds of a domain, at least.
LIFT = 20.0
BINS = 400
BIN_WIDTH = 0.25
_BETWEEN = r"[^\p{L}]+"


def _features(docs: DataFrame, *more: str) -> DataFrame:
    """(row, doc_id, tokens, feature, head): a row per word, and per text a few
    more that stand for its statistics; ``head`` marks a text's first row."""
    text = F.coalesce("text", F.lit(""))
    # a generator of one element: what stands above it uses the words and doesn't split again
    base = docs.select("doc_id", F.monotonically_increasing_id().alias("row"), *more,
                       F.explode_outer(F.array(F.struct(
                           F.split(text, _BETWEEN).alias("words"), F.length(text).alias("size"),
                           F.octet_length(F.regexp_replace(text, r"[^A-Z!#$%&*|{}<>=]+", "")).alias("marks")))).alias("x"))
    some, words = F.greatest(F.size("x.words"), F.lit(1)), F.greatest(F.col("x.size"), F.lit(1))
    # statistics as words: shares in steps, none of which is a word of letters
    step = lambda name, share: F.concat(F.lit(name), F.floor(F.least(F.lit(9), share)).cast("string"))
    stats = F.array(step("marks ", 100 * F.col("x.marks") / words / 3), step("letters ", F.col("x.size") / some / 3),
                    step("distinct ", 10 * F.size(F.array_distinct("x.words")) / some))
    return base.select("doc_id", "row", *more, F.size("x.words").alias("tokens"),
                       F.posexplode_outer(F.concat(stats, "x.words")).alias("place", "feature")).select(
        "doc_id", "row", *more, "tokens", F.lower("feature").alias("feature"), (F.col("place") == 0).alias("head"))


def _telling(counts: DataFrame, tests: int, rate: float) -> float:
    """The least ``lead`` that still tells at this rate of false discoveries,
    by the step-up procedure on a histogram with a fixed number of bins."""
    bins = counts.groupBy(F.least(F.floor(F.col("lead") / BIN_WIDTH), F.lit(BINS)).alias("bin")).count().collect()
    limit, reached = float("inf"), 0
    for b, n in sorted(((int(r["bin"]), r["count"]) for r in bins), reverse=True):
        reached += n
        if np.exp(-b * BIN_WIDTH) * tests <= rate * reached:
            limit = b * BIN_WIDTH
    return limit


def lexicon(docs: DataFrame, labelled: DataFrame, domains: list[str], bound: int = TRAIN_ROWS,
            size: int = LEXICON, rate: float = FALSE_WORDS, lift: float = LIFT) -> tuple[DataFrame, list[float]]:
    """Telling words with one weight per domain (what their presence adds to the
    log-likelihood), written once, and each domain's log-likelihood of a text
    without any.

    Learned from about ``bound`` labelled rows, an equal part of them for each
    domain, by a hash of the id, when there are more.  A word tells when more of
    its texts belong to a domain than chance explains; the chance is bounded by
    Chernoff's inequality, exp(-texts x divergence of the shares), and among all
    words and domains a share ``rate`` of those kept may be false.  It also
    raises the odds of that domain ``lift`` times or more, so that common words
    with a slight preference stay out, however many labels there are."""
    known = labelled.select("doc_id", "domain").where(F.col("doc_id").isNotNull() & F.col("domain").isin(domains))
    totals = {r["domain"]: r["count"] for r in known.groupBy("domain").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1_000_000)) / 1_000_000
    part = F.lit(0.0)
    for d in domains:
        part = F.when(F.col("domain") == d, min(1.0, bound / len(domains) / max(1, totals.get(d, 0)))).otherwise(part)
    # about `bound` rows at most; copies of a text would make its words look telling
    rows = docs.select("doc_id", "text").join(F.broadcast(known.where(place < part)), "doc_id").dropDuplicates(
        ["text", "domain"])
    seen = _features(rows, "domain").groupBy("row", "domain", "feature").agg(F.lit(1).alias("one"))
    n = {r["domain"]: r["count"] for r in rows.groupBy("domain").count().collect()}
    n = [n.get(d, 0) for d in domains]
    k = range(len(domains))
    counts = seen.groupBy("feature").agg(*[F.count_if(F.col("domain") == d).alias(f"n{i}") for i, d in enumerate(domains)])
    whole = sum((F.col(f"n{i}") for i in k), F.lit(0))

    def lead(i: int) -> Column:
        usual, own = n[i] / max(1, sum(n)), F.col(f"n{i}") / whole
        if not 0 < usual < 1:
            return F.lit(0.0)
        others = F.when(own < 1, (1 - own) * F.log((1 - own) / (1 - usual))).otherwise(0.0)
        return F.when(own * (1 - usual) >= lift * usual * (1 - own), whole * (own * F.log(own / usual) + others)).otherwise(0.0)

    counts = written(counts.withColumn("lead", F.greatest(*[lead(i) for i in k], F.lit(0.0))), "mixing-counts")
    limit = _telling(counts, counts.count() * len(domains), rate)
    # smoothed towards the word's use over all domains
    p = (whole + 1) / (sum(n) + 2)
    use = lambda i: (F.col(f"n{i}") + 2 * p) / (n[i] + 2)
    top = (counts.where(F.col("lead") >= limit).orderBy(F.desc("lead"), "feature").limit(size)
           .select("feature", *[F.log(use(i) / (1 - use(i))).alias(f"w{i}") for i in k],
                   *[F.log(1 - use(i)).alias(f"a{i}") for i in k]))
    table = written(top, "mixing-words")
    absent = table.agg(*[F.sum(f"a{i}") for i in k]).head()
    prior = [float(np.log((totals.get(d, 0) + 1) / (sum(totals.values()) + len(domains)))) for d in domains]
    return table.select("feature", *[f"w{i}" for i in k]), [x + (a or 0.0) for x, a in zip(prior, absent)]


def posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], carry: Sequence[str] = ()) -> DataFrame:
    """(row, doc_id, carry..., tokens, p0, p1, ...) of every row, written once."""
    words, prior = lexicon(docs, labelled, domains)
    each = _features(docs, *carry)
    # at most LEXICON rows; the left join keeps each text's first row
    hits = each.join(F.broadcast(words), "feature", "left").where("head or w0 is not null")
    names = [f"w{k}" for k in range(len(domains))]
    once = hits.groupBy("row", "doc_id", *carry, "tokens", "feature").agg(*[F.first(w).alias(w) for w in names])
    logs = once.groupBy("row", "doc_id", *carry, "tokens").agg(
        *[(F.coalesce(F.sum(w), F.lit(0.0)) + prior[k]).alias(f"l{k}") for k, w in enumerate(names)])
    top = F.greatest(*[F.col(f"l{k}") for k in range(len(domains))], F.lit(-1e308))
    mass = [F.exp(F.col(f"l{k}") - top) for k in range(len(domains))]
    whole = sum(mass, F.lit(0.0))
    return written(logs.select("row", "doc_id", *carry, "tokens", *[(m / whole).alias(f"p{k}") for k, m in enumerate(mass)]),
                   "mixing-posteriors")


def _descended(members: DataFrame, off: np.ndarray, loose: float, passes: int) -> np.ndarray:
    """Projected gradient on the rates of ``members`` (all 1 at first, when the
    domains are ``off`` their targets by so many tokens): the domains' distances
    from their targets at the end, over ``loose``.

    Minimised are the squared distances over ``loose`` and, weighted with
    tokens, the rates' squared distances from 1, halved."""
    k = range(len(off))
    inner = lambda point: sum((F.col(f"p{i}") * float(point[i]) for i in k), F.lit(0.0))
    got = members.agg(*[F.sum(F.col("tokens") * F.col(f"p{i}") * F.col(f"p{j}")) for i in k for j in k]).head()
    both = np.array([x or 0.0 for x in got]).reshape(len(off), len(off))
    least = loose / (loose + float(np.linalg.eigvalsh(both)[-1]))  # the step that always leads down
    rates, step = members.withColumn("rate", F.lit(1.0)), least
    for turn in range(passes):
        target = F.greatest(F.lit(0.0), F.col("rate") - step * (inner(off / loose) + F.col("rate") - 1))
        moved = rates.withColumn("move", target - F.col("rate"))
        part = F.col("tokens") * F.col("move")
        got = moved.agg(F.sum(part * F.col("move")), F.sum(part * (F.col("rate") - 1)),
                        *[F.sum(part * F.col(f"p{i}")) for i in k]).head()
        size, back, *shift = (float(x or 0.0) for x in got)
        shift = np.array(shift)
        bend = size + shift @ shift / loose
        if size <= 1e-18 * max(1.0, float(both.sum())):
            break
        share = min(1.0, -(off @ shift / loose + back) / bend)  # the lowest point on the way
        rates = moved.withColumn("rate", F.col("rate") + share * F.col("move")).drop("move")
        off = off + share * shift
        # the next step's length by the change of the gradient along this one
        change = shift @ both @ shift / loose ** 2 + 2 * (shift @ shift) / loose + size
        step = float(np.clip(size / bend if turn % 2 else bend / change, least, 1.0))
    return off / loose


def fit_rates(members: DataFrame, domains: list[str], weights: dict[str, float], headroom: float = 1.0,
              slack: float = 1e-4, steps: int = 20, close: float = 1e-6, passes: int = 12) -> tuple[Column, dict]:
    """The rate as a column over ``p0, p1, ...`` and a report: ``error`` after
    the descent of at most ``passes`` steps, and after each further step.

    ``weights`` are the domains' shares of all tokens; ``slack`` weighs rates
    near 1 against targets that can't be met (those that can are met to about
    this share).  The corpus is aimed at
    the largest size at which no domain has to be repeated, times
    ``headroom``.  The driver sees one row of sums per step.  Documents of equal
    posteriors have equal rates, so their tokens are summed up front."""
    k = range(len(domains))
    each = [f"p{i}" for i in k]
    members = written(members.groupBy(*each).agg(F.sum("tokens").cast("double").alias("tokens")), "mixing-masses")
    total = sum(weights.get(d, 0.0) for d in domains) or 1.0
    share = np.array([weights.get(d, 0.0) / total for d in domains])
    held = np.array([x or 0.0 for x in members.agg(*[F.sum(F.col("tokens") * F.col(f"p{i}")) for i in k]).head()])
    fits = [h / s for h, s in zip(held, share) if s > 0 and h > 0]
    target = share * (min(fits) * headroom if fits else 0.0)
    n = len(domains)
    loose = slack * max(1.0, held.sum())

    def rate_at(point: np.ndarray) -> Column:
        return F.greatest(F.lit(0.0), F.lit(1.0) - sum((F.col(f"p{i}") * float(point[i]) for i in k), F.lit(0.0)))

    def sums_at(point: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """What is minimised, its gradient and its curvature, in one pass."""
        rows, part = members.withColumn("rate", rate_at(point)), F.col("tokens") * F.col("rate")
        live = F.when(F.col("rate") > 0, F.col("tokens")).otherwise(0)
        got = rows.agg(F.sum(part * F.col("rate")), *[F.sum(part * F.col(f"p{i}")) for i in k],
                       *[F.sum(live * F.col(f"p{i}") * F.col(f"p{j}")) for i in k for j in k]).head()
        got = np.array([x or 0.0 for x in got])
        return (0.5 * got[0] + point @ target + 0.5 * loose * point @ point, target - got[1:1 + n] + loose * point,
                got[1 + n:].reshape(n, n) + loose * np.eye(n))

    report = {"held": held.tolist(), "target": target.tolist(), "error": []}
    point, length = _descended(members, held - target, loose, passes), 1.0
    value, slope, curve = sums_at(point)
    for _ in range(steps):
        report["error"].append(float(np.abs(slope).sum() / max(1.0, target.sum())))
        if report["error"][-1] < close or length < 1e-3:
            break
        step, length = np.linalg.solve(curve, slope), 1.0
        while length >= 1e-3:  # halved until it leads down
            new = sums_at(point - length * step)
            if new[0] <= value - 1e-4 * length * float(step @ slope):
                point, (value, slope, curve) = point - length * step, new
                break
            length /= 2
    return rate_at(point), report


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], headroom: float = 1.0,
          carry: Sequence[str] = ()) -> DataFrame:
    """Per row ``doc_id, n_tokens, domain, p_<domain>..., rate, copies``:
    ``copies`` is the rate rounded up or down by a hash of the id, so that its
    expectation is the rate.  Columns named in ``carry`` go along.

    ``labelled`` has ``doc_id, domain``; labels of other domains are ignored.
    A null or empty text counts as one token and has the priors for posterior;
    without labels all domains are equally likely; repeated rows each get a
    row; a null ``doc_id`` is carried; an empty table gives an empty result."""
    domains = sorted(weights)
    members = posteriors(docs, labelled, domains, carry)
    rate, _ = fit_rates(members, domains, weights, headroom)
    names = F.array(*[F.lit(d) for d in domains])
    best = F.array(*[F.col(f"p{k}") for k in range(len(domains))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("copies")), F.lit(1_000_000)) / 1_000_000
    return members.select(
        "doc_id", *carry, F.col("tokens").cast("long").alias("n_tokens"),
        F.element_at(names, F.array_position(best, F.array_max(best)).cast("int")).alias("domain"),
        *[F.col(f"p{k}").alias(f"p_{d}") for k, d in enumerate(domains)], rate.alias("rate"),
    ).withColumn("copies", F.floor(F.col("rate") + place).cast("int"))
