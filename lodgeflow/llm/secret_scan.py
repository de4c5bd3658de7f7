"""Secret scans with a battery of randomness tests.

Base patterns find what stands beside a telling name, and keys of known
forms.  The method then looks at every other long run of letters and digits:
it infers the run's encoding (the smallest alphabet that holds it) and tests
the characters in three ways: a chi-squared test of uniform use of the
alphabet, a runs test above and below the alphabet's middle, and a test of
serial correlation.  A run whose order or use of characters is visibly not
random is dropped.  For the others the likelihood under the uniform alphabet is
held against that under a model of words and identifiers: which kind of
character follows which, and which letter follows which.  A run of that model
has a ratio of x or more with a chance of at most 1/x (Markov's inequality), so
one over the ratio is a p-value, and it shrinks with every character.  False
discoveries are controlled over the whole corpus, within bands of length, by
the step-up procedure on a histogram of p-values with a fixed number of bins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.shared import map_arrow, texts, written

# fixed values: the base patterns
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")

#: What the method looks at: runs of at least this many characters.
LEAST = 20
_RUN = re.compile(rf"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{{{LEAST},}}")
#: Encodings by their alphabets, the narrower ones first.
ALPHABETS = {
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
}
#: Words and identifiers: chance of a small letter, capital, digit or one of
#: +/-_ at the start and after a small letter, capital, digit or one of +/-_.
KIND_AFTER = ((0.45, 0.25, 0.25, 0.05), (0.85, 0.05, 0.04, 0.06), (0.35, 0.50, 0.07, 0.08),
              (0.08, 0.05, 0.72, 0.15), (0.50, 0.20, 0.20, 0.10))
#: Letters a to z at the start of a word and after a to z (a row each): -4 ln of
#: the chance in base 36, from English (half), French, German and Spanish texts
#: with 15% of even use mixed in.
LETTER_AFTER = """
9fdc8iieckjdgcahgde8fhglkj fibeeljhbjlgi6fkjca88jjlll kjii6hkkkkk4kk7kkkkkkkkkck jigibhk48kk9kkbkkkkk9kkkkk
bfkl4lkdallfld7llfdbflglll ahgbcljhcjkdi7ejj79efjillf bdcfaggegjhejh6hj9eahgijjg 6ejk6kibdkjfkcbjkfcbijfkkj
7fgk5kidckiehebghedbiggkki eidi7ljjhjlhg58jifdajjjlll 4fffffffffffffdfffffffffff hhhh2hhhhhhhhhhhhhhhhhhhhh
akik5lkl8klajlflkjhkklll6l bjjk5kkh6kkkkj7ckfjekkkkkk bfe99l9edjiegfchhed7hhhllj hjhjhbjkdjkjg4jlj9aj8lklll
4kkkk7kk7kkckk9kkkkkgkkkkk gggggggggggggggggggg2ggggg 9egj4lhedjififchjbdchhhlli ch9iclh7eilgghekifh5bkjlll
ahil7lj58ljhkidjkbgfjjjllc cfil5ikddljfi8bhjecbjjfclk iiii3iii7iiiiibiiiiiiiiiii aiiiiii2aiiiiibiiiiiiiiiii
3hfhchhhehhfehcefdhehfhhhh aedg8iicbiiehc8iiebahieiii ccbfcgfgcfeeegfgeefe5fgggg
"""
BANDS = (20, 32, 48, 96)
BINS = 400
BIN_WIDTH = 0.1  # of -log10 p


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the base patterns, by start, then kind as listed."""
    out = [(m.start(), m.end(), 0) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(*m.span(), 1) for m in ACCESS.finditer(text)]
    out += [(*m.span(), 2) for m in HEX.finditer(text)]
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _text_model() -> np.ndarray:
    """ln of the chance of a byte after a byte in words and identifiers; row 0
    holds the first bytes."""
    rows = [[math.exp(-int(c, 36) / 4) for c in row] for row in LETTER_AFTER.split()]
    letters = np.array(rows) / np.sum(rows, axis=1, keepdims=True)
    groups = [np.arange(97, 123), np.arange(65, 91), np.arange(48, 58), np.frombuffer(b"+/-_", dtype=np.uint8)]
    out = np.full((128, 128), -np.inf)
    for kind, before in enumerate([np.array([0]), *groups]):
        for row in before:
            after = letters[row % 32 if kind in (1, 2) else 0]
            for chance, group in zip(KIND_AFTER[kind], groups):
                out[row, group] = np.log(chance * (after if len(group) == 26 else 1 / len(group)))
    return out


_TEXT = _text_model()


def randomness(run: str) -> tuple[str, float, float]:
    """(encoding, p that a random run looks so ordered, p that text looks so
    random)."""
    letters = set(run)
    name = next((k for k, a in ALPHABETS.items() if letters <= set(a)), "")
    if not name:
        return "", 0.0, 1.0
    alphabet = ALPHABETS[name]
    k, n = len(alphabet), len(run)
    x = np.array([alphabet.index(c) for c in run], dtype=float)
    counts = np.bincount(x.astype(int), minlength=k)
    chi = float(((counts - n / k) ** 2).sum() * k / n)
    # Wilson-Hilferty: cube root of chi-squared over its degrees is near normal
    d = k - 1
    p_uniform = _normal_tail(((chi / d) ** (1 / 3) - (1 - 2 / (9 * d))) / math.sqrt(2 / (9 * d)))
    high = x >= k / 2
    ups = int(high.sum())
    p_runs = 0.0
    if 0 < ups < n:
        mean = 2 * ups * (n - ups) / n + 1
        var = max((mean - 1) * (mean - 2) / (n - 1), 1e-9)
        p_runs = 2 * _normal_tail(abs(1 + int((high[1:] != high[:-1]).sum()) - mean) / math.sqrt(var))
    spread = x - x.mean()
    p_serial = 0.0
    if spread.any():
        r = float((spread[1:] * spread[:-1]).sum() / (spread ** 2).sum())
        p_serial = 2 * _normal_tail(abs(r + 1 / n) * math.sqrt(n))
    raw = np.frombuffer(run.encode(), dtype=np.uint8)
    p_text = math.exp(min(0.0, float(_TEXT[np.append(0, raw[:-1]), raw].sum()) + n * math.log(k)))
    return f"random_{name}", min(1.0, 3 * min(p_uniform, p_runs, p_serial)), p_text


def candidates(text: str, taken: list[tuple[int, int, str]]) -> list[tuple[int, int, str, float, float]]:
    """(start, end, encoding, p_random, p_text) of the runs beside the base spans."""
    out, k = [], 0
    for m in _RUN.finditer(text):
        s, e = m.span()
        while k < len(taken) and taken[k][1] <= s:
            k += 1
        if not any(t < e and s < u for t, u, _ in taken[k:k + 3]):
            out.append((s, e, *randomness(m.group())))
    return out


def _band(length: int) -> int:
    return sum(length >= b for b in BANDS)


def _of(docs: DataFrame) -> DataFrame:
    """First pass, written once: per row ``doc_id``, the ``base`` spans and the
    ``runs`` with their p-values (places only, no text)."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = [("start", pa.int32()), ("stop", pa.int32()), ("kind", pa.string())]
    more = [*span, ("p_random", pa.float64()), ("p_text", pa.float64()), ("band", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, runs = [], []
            for text in batch.column("text").to_pylist():
                own = base_spans(text)
                base.append([dict(zip([k for k, _ in span], x)) for x in own])
                runs.append([dict(zip([k for k, _ in more], (*x, _band(x[1] - x[0])))) for x in candidates(text, own)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(pa.struct(span))),
                 pa.array(runs, pa.list_(pa.struct(more)))], ["doc_id", "base", "runs"])

    part = "start: int, stop: int, kind: string"
    schema = (f"doc_id {kind}, base array<struct<{part}>>, "
              f"runs array<struct<{part}, p_random: double, p_text: double, band: int>>")
    return written(map_arrow(texts(docs), run, schema), "secret-spans")


def thresholds(spans: DataFrame, rate: float, least_random: float) -> dict[int, float]:
    """Band of length -> largest p_text that is still a discovery.  The driver
    gets at most bands times bins counts, whatever the corpus."""
    each = spans.select(F.explode("runs").alias("r")).select("r.*").where(F.col("p_random") >= least_random)
    depth = F.floor(-F.log10(F.greatest("p_text", F.lit(1e-300))) / BIN_WIDTH)
    bins = each.groupBy("band", F.least(F.lit(BINS), depth).alias("bin")).count().collect()
    out = {}
    for band in {r["band"] for r in bins}:
        own = sorted(((int(r["bin"]), r["count"]) for r in bins if r["band"] == band), reverse=True)
        total, reached = sum(n for _, n in own), 0
        for b, n in own:  # the smallest p-values first
            reached += n
            p = 10 ** (-b * BIN_WIDTH)
            if p * total <= rate * reached:
                out[band] = p
    return out


def scan(docs: DataFrame, rate: float = 0.01, least_random: float = 0.001) -> DataFrame:
    """Per row ``doc_id``, ``base`` and ``spans`` (base and discoveries):
    arrays of ``start, stop, kind`` by start, then kind (base kinds as listed,
    then the others).

    Null and empty texts have no span; repeated rows get equal spans; a null
    ``doc_id`` is carried; an empty table gives an empty result; other columns
    are ignored.  ``rate``: share of false discoveries; ``least_random``: p
    under which a run counts as not random."""
    spans = _of(docs)
    limits = thresholds(spans, rate, least_random)

    def passes(x: Column) -> Column:
        limit = F.lit(-1.0)
        for band, p in limits.items():
            limit = F.when(x["band"] == band, F.lit(p)).otherwise(limit)
        return (x["p_random"] >= least_random) & (x["p_text"] <= limit)

    def placed(x: Column, order: Column) -> Column:
        return F.struct(x["start"].alias("start"), order.alias("place"), x["kind"].alias("kind"), x["stop"].alias("stop"))

    listed = F.array(*[F.lit(k) for k in KINDS])
    merged = F.array_sort(F.concat(
        F.transform("base", lambda x: placed(x, F.array_position(listed, x["kind"]).cast("int"))),
        F.transform(F.filter("runs", passes), lambda x: placed(x, F.lit(len(KINDS) + 1)))))
    bare = F.transform(merged, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"),
                                                  x["kind"].alias("kind")))
    return spans.select("doc_id", "base", bare.alias("spans"))


def joined(spans: str) -> Column:
    """``kind:start:stop`` of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def scan_digest(spans: DataFrame) -> DataFrame:
    """Counts of the base kinds and both lists of spans as text."""
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")
    return spans.select("doc_id", *[count(k).alias(f"n_{k}") for k in KINDS],
                        F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def redacted(docs: DataFrame, mark: str = "[secret]", rate: float = 0.01, least_random: float = 0.001) -> DataFrame:
    """``docs`` (all its columns) with every span of ``scan`` replaced by
    ``mark`` and ``n_chars``, where it is a column, counted anew.  Null texts
    stay null; nothing else changes."""
    limits = thresholds(_of(docs), rate, least_random)
    at = docs.columns.index("text")
    length = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def clean(text: str | None) -> str | None:
        if not text:
            return text
        own = base_spans(text)
        spans = [(s, e) for s, e, _ in own]
        spans += [(s, e) for s, e, _, p, q in candidates(text, own)
                  if p >= least_random and q <= limits.get(_band(e - s), -1.0)]
        out, last = [], 0
        for s, e in sorted(spans):
            if s >= last:
                out += [text[last:s], mark]
            last = max(last, e)
        return "".join([*out, text[last:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = [clean(t) for t in batch.column(at).to_pylist()]
            columns = list(batch.columns)
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if length is not None:
                columns[length] = pa.array([None if t is None else len(t) for t in new], batch.schema.field(length).type)
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return map_arrow(docs, run, docs.schema)
