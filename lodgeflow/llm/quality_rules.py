"""Quality classifier: a sparse ensemble of rules over text statistics.

Small trees are grown on a bounded sample of labelled documents, one after the
other on what the earlier ones leave; every path from a root is a rule (a
conjunction of comparisons).  A lasso logistic regression weighs the rules and
leaves few of them, and what is left becomes one Spark column expression over
the statistics.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lodgeflow.llm.bytewords import LOWER, run_hashes, text_bytes
from lodgeflow.llm.shared import crc_mod, map_arrow, slices

#: Labelled rows (about) from which the ensemble is fitted.
TRAIN_ROWS = 20_000
THRESHOLD = 0.3
STATISTICS = ("log_chars", "log_words", "word_length", "upper", "digits", "dots", "symbols", "symbol_words",
              "wide", "lines", "line_words", "distinct_words", "distinct_lines", "top_word", "short_words")

_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0, 9, 10, 11, 12, 13, 32]] = True
_UPPER, _DIGIT, _DOT, _SYMBOL, _WIDE = np.zeros((5, 256), dtype=bool)
_UPPER[65:91] = True
_DIGIT[48:58] = True
_DOT[[44, 46]] = True
_SYMBOL[[*range(33, 44), 45, 47, *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_WIDE[128:] = True


def _per_text(mask: np.ndarray, begins: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return (total[begins[1:]] - total[begins[:-1]]).astype(float)


def _distinct(owner: np.ndarray, hashes: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: distinct hashes, and how often the commonest one occurs."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    first = np.ones(len(o), dtype=bool)
    first[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(first)
    top = np.zeros(n)
    np.maximum.at(top, o[at], np.diff(np.append(at, len(o))))
    return np.bincount(o[at], minlength=n).astype(float), top


def _runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    starts = np.flatnonzero(edge == 1)
    return starts, np.flatnonzero(edge == -1) - starts


def statistics(texts: list[str]) -> np.ndarray:
    """One row of ``STATISTICS`` per text, over the whole text."""
    data, begins = text_bytes(texts)
    n = len(texts)
    size = np.maximum(1.0, np.diff(begins) - 1)
    share = lambda table: _per_text(table[data], begins) / size
    starts, lengths = _runs(~_WHITE[data])
    owner = np.searchsorted(begins, starts, "right") - 1
    words = np.bincount(owner, minlength=n).astype(float)
    some = np.maximum(1.0, words)
    symbol = np.concatenate([[0], np.cumsum(_SYMBOL[data], dtype=np.int64)])
    marked = symbol[starts + lengths] > symbol[starts]
    distinct, top = _distinct(owner, run_hashes(LOWER[data], starts, lengths), n)
    at, size_of = _runs((data != 10) & (data != 0))
    line_owner = np.searchsorted(begins, at, "right") - 1
    lines = np.bincount(line_owner, minlength=n).astype(float)
    distinct_lines, _ = _distinct(line_owner, run_hashes(data, at, size_of), n)
    per_line = np.maximum(1.0, lines)
    return np.stack([
        np.log1p(np.diff(begins) - 1), np.log1p(words), np.bincount(owner, weights=lengths, minlength=n) / some,
        share(_UPPER), share(_DIGIT), share(_DOT), share(_SYMBOL),
        np.bincount(owner, weights=marked, minlength=n) / some, share(_WIDE), np.log1p(lines), words / per_line,
        distinct / some, distinct_lines / per_line, top / some,
        np.bincount(owner, weights=lengths <= 3, minlength=n) / some], axis=1)


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with one struct column ``_stats`` (null text: as empty)."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [t or "" for t in batch.column(at).to_pylist()]
            for a, b in slices(values):
                table = statistics(values[a:b])
                part = batch.slice(a, b - a)
                stats = pa.StructArray.from_arrays([pa.array(c) for c in table.T], names=list(STATISTICS))
                yield pa.RecordBatch.from_arrays([*part.columns, stats], [*part.schema.names, "_stats"])

    struct = T.StructType([T.StructField(s, T.DoubleType()) for s in STATISTICS])
    return map_arrow(docs, run, T.StructType([*docs.schema.fields, T.StructField("_stats", struct)]))


# -- fitting, on the driver, over a bounded sample ---------------------------

Rule = tuple[tuple[int, bool, float], ...]  # (statistic, above, bound), all of them


def _holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    out = np.ones(len(x), dtype=bool)
    for k, above, bound in rule:
        out &= (x[:, k] > bound) if above else (x[:, k] <= bound)
    return out


def _grow(x: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, weight: np.ndarray, rows: np.ndarray,
          rule: Rule, depth: int, least: int, out: list[Rule], step: np.ndarray) -> None:
    best = None
    if depth and len(rows) >= 2 * least:
        g, h = residual[rows], weight[rows]
        base = g.sum() ** 2 / (h.sum() + 1)
        for k, bounds in enumerate(cuts):
            bins = np.searchsorted(bounds, x[rows, k], "left")  # <= bound: left
            gl = np.cumsum(np.bincount(bins, weights=g, minlength=len(bounds) + 1))[:-1]
            hl = np.cumsum(np.bincount(bins, weights=h, minlength=len(bounds) + 1))[:-1]
            nl = np.cumsum(np.bincount(bins, minlength=len(bounds) + 1))[:-1]
            gain = gl ** 2 / (hl + 1) + (g.sum() - gl) ** 2 / (h.sum() - hl + 1) - base
            gain[(nl < least) | (len(rows) - nl < least)] = -1
            if len(gain) and gain.max() > 1e-6 and (best is None or gain.max() > best[0]):
                best = (gain.max(), k, float(bounds[gain.argmax()]))
    if best is None:
        step[rows] = residual[rows].sum() / (weight[rows].sum() + 1)
        return
    _, k, bound = best
    for above in (False, True):
        child = (*rule, (k, above, bound))
        out.append(child)
        side = x[rows, k] > bound
        _grow(x, cuts, residual, weight, rows[side if above else ~side], child, depth - 1, least, out, step)


def fit_rules(x: np.ndarray, y: np.ndarray, trees: int = 30, depth: int = 3, rate: float = 0.3,
              penalty: float = 0.002, steps: int = 400) -> tuple[float, list[tuple[float, Rule]]]:
    """(intercept, weighted rules).  With labels of one kind only, no rule."""
    mean = float(np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99))
    start = float(np.log(mean / (1 - mean)))
    if not len(y) or y.min() == y.max():
        return start, []
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.02, 0.98, 33))) for k in range(x.shape[1])]
    margin, rules = np.full(len(y), start), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        step = np.zeros(len(y))
        _grow(x, cuts, y - p, p * (1 - p), np.arange(len(y)), (), depth, max(5, len(y) // 400), rules, step)
        margin += rate * step
    rules = list(dict.fromkeys(rules))
    if not rules:
        return start, []
    table = np.stack([_holds(r, x) for r in rules], axis=1).astype(np.float32)
    spread = table.std(axis=0)
    rules = [r for r, s in zip(rules, spread) if s > 0]
    table = table[:, spread > 0]
    spread = spread[spread > 0]
    z = (table - table.mean(axis=0)) / spread
    w = np.zeros(z.shape[1], dtype=np.float32)
    v, b, t = w.copy(), start, 1.0
    # largest curvature by power iteration: the step of the proximal gradient
    # (from no special direction: opposite rules would cancel out)
    u = np.random.default_rng(0).normal(size=z.shape[1]).astype(np.float32)
    u /= np.linalg.norm(u)
    for _ in range(15):
        u = z.T @ (z @ u) / len(y)
        top = float(np.linalg.norm(u))
        u /= top
    size = 4 / (top + 1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-(z @ v + b)))
        new = v - size * (z.T @ (p - y) / len(y)).astype(np.float32)
        new = np.sign(new) * np.maximum(np.abs(new) - size * penalty, 0)
        b -= 2 * float((p - y).mean())
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, w, t = new + np.float32((t - 1) / t_new) * (new - w), new, t_new
    weights = w / spread
    return (b - float((table.mean(axis=0) * weights).sum()),
            [(float(c), r) for c, r in zip(weights, rules) if abs(c) > 1e-6])


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", folds: int = 5, held: int = 0,
        bound: int = TRAIN_ROWS) -> tuple[float, list[tuple[float, Rule]]]:
    """Fit on rows of ``labels`` outside the held-out fold; of more than
    ``bound`` such rows about ``bound`` are taken, by a hash of the id."""
    known = labels.select("doc_id", F.col(target).cast("double").alias("y")).where(
        (crc_mod("doc_id", folds) != held) & F.col("y").isNotNull())
    n = known.count()
    place = F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1_000_000)) / 1_000_000
    taken = known.where(place < min(1.0, bound / max(1, n)))
    joined = docs.select("doc_id", "text").join(F.broadcast(taken), "doc_id")  # about `bound` rows at most
    rows = with_statistics(joined).select("doc_id", "y", "_stats.*").orderBy("doc_id", *STATISTICS, "y").toPandas()
    return fit_rules(rows[list(STATISTICS)].to_numpy(float), rows["y"].to_numpy(float))


def compiled(model: tuple[float, list[tuple[float, Rule]]]) -> Column:
    """The ensemble as a column over ``_stats``: a probability."""
    intercept, rules = model
    margin = F.lit(intercept)
    for weight, rule in rules:
        test = F.lit(True)
        for k, above, bound in rule:
            value = F.col(f"_stats.{STATISTICS[k]}")
            test = test & ((value > bound) if above else (value <= bound))
        margin = margin + F.when(test, F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def scored(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row, on whole texts.

    Null and empty texts are scored by the statistics of an empty text; a null
    ``doc_id`` trains nothing and counts as not held out; without labels every
    score is one half; repeated rows get equal results; an empty table gives
    an empty result; other columns are ignored."""
    score = compiled(fit(docs, labels, folds=folds, held=held))
    return with_statistics(docs.select("doc_id", "text")).select(
        "doc_id", F.coalesce(crc_mod("doc_id", folds) == held, F.lit(False)).alias("held_out"),
        score.alias("score")).withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that are not rejected."""
    score = compiled(fit(docs, labels))
    return with_statistics(docs).where(score >= THRESHOLD).select(*docs.columns)
