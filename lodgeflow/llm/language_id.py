"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A trigram's vector binds (by
multiplication) its letters' vectors, permuted by their place; a text's vector
bundles (sums) its trigrams' vectors; a language's prototype bundles the
vectors, at equal length, of labelled texts.  A text gets the language whose
prototype is nearest by cosine.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodgeflow.llm.shared import crc_mod, map_arrow

DIMENSIONS = 512
#: Labelled texts per language (about) from which a prototype is learned.
TRAIN_PER_LANG = 4000
#: Trigram vectors remembered per Python worker (512 bytes each).
MAX_TRIGRAMS = 100_000
UNKNOWN = "und"

_NOT_LETTERS = re.compile(r"[\W\d_]+")


class _Space:
    """Trigram vectors, made when first met."""

    def __init__(self, dimensions: int):
        self.dimensions = dimensions
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[int, int] = {}
        self.table = np.zeros((1024, dimensions), dtype=np.int8)

    def _letter(self, c: int) -> np.ndarray:
        if c not in self.letters:
            self.letters[c] = np.random.default_rng(c).choice(np.array([-1, 1], dtype=np.int8), self.dimensions)
        return self.letters[c]

    def _row(self, key: int) -> int:
        if key not in self.rows:
            k = len(self.rows)
            if k == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            a, b, c = key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF
            self.table[k] = np.roll(self._letter(a), 2) * np.roll(self._letter(b), 1) * self._letter(c)
            self.rows[key] = k
        return self.rows[key]

    def vector(self, text: str) -> np.ndarray | None:
        """The bundled trigrams at length 1; nothing for a text without letters."""
        plain = _NOT_LETTERS.sub(" ", text.lower()).strip()
        signs = {ord(c): " " for c in set(plain) if c != " " and not c.isalpha()}  # such as ² and ½
        if signs:
            plain = " ".join(plain.translate(signs).split())
        if not plain:
            return None
        if len(self.rows) > MAX_TRIGRAMS:
            self.__init__(self.dimensions)
        x = np.frombuffer(f" {plain} ".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        keys, counts = np.unique(x[:-2] << 42 | x[1:-1] << 21 | x[2:], return_counts=True)
        total = np.zeros(self.dimensions, dtype=np.float32)
        for a in range(0, len(keys), 4096):  # a long text of many scripts, in parts
            rows = [self._row(k) for k in keys[a:a + 4096].tolist()]
            total += counts[a:a + 4096].astype(np.float32) @ self.table[rows].astype(np.float32)
        norm = float(np.linalg.norm(total))
        return total / norm if norm else total


_spaces: dict[int, _Space] = {}


def _space(dimensions: int) -> _Space:
    return _spaces.setdefault(dimensions, _Space(dimensions))


def prototypes(labelled: DataFrame, dimensions: int = DIMENSIONS, bound: int = TRAIN_PER_LANG) -> dict[str, np.ndarray]:
    """Language -> prototype, from ``doc_id, text, lang``.  Of a language with
    more than ``bound`` texts about ``bound`` are taken, by a hash of the id."""
    labelled = labelled.select("doc_id", "text", "lang").where("lang is not null and text is not null")
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    if not counts:
        return {}
    share = F.create_map(*[F.lit(x) for k, n in counts.items() for x in (k, min(1.0, bound / n))])
    place = F.pmod(F.xxhash64("doc_id", F.lit("language")), F.lit(1_000_000)) / 1_000_000
    sample = labelled.where(F.coalesce(place, F.lit(0.5)) < share[F.col("lang")]).select("lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        space = _space(dimensions)
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                v = space.vector(text)
                if v is not None:
                    sums[lang] = sums.get(lang, 0) + v.astype(np.float64)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()),
                                          pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                                         ["lang", "vector"])

    # the sample is bounded, so a fixed number of tasks holds it
    parts = map_arrow(sample.repartition(16), run, "lang string, vector array<double>").collect()
    out: dict[str, np.ndarray] = {}
    for r in sorted(parts, key=lambda r: (r["lang"], r["vector"][0])):
        out[r["lang"]] = out.get(r["lang"], 0) + np.array(r["vector"])
    return {k: v / np.linalg.norm(v) for k, v in out.items() if np.linalg.norm(v)}


def predict(docs: DataFrame, known: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, lang_pred, score): the score is the cosine, at least 0."""
    names = sorted(known)
    table = np.array([known[k] for k in names])
    dimensions = table.shape[1] if names else 0
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text").to_pylist():
                v = _space(dimensions).vector(text) if text and names else None
                if v is None:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    cosines = table @ v
                    best = int(cosines.argmax())
                    langs.append(names[best])
                    scores.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(langs, pa.string()),
                                              pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, lang_pred string, score double")


def identified(docs: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; prototypes come from
    rows of the other folds only.

    Null, empty and letterless texts give ``und`` with score 0, as does every
    row when no labelled text exists; a null ``doc_id`` is held out of nothing
    and trains nothing; repeated rows get equal results; an empty table gives
    an empty result; other columns are ignored."""
    fold = crc_mod("doc_id", folds)
    known = prototypes(docs.where(fold != held))
    return predict(docs, known).select("doc_id", F.coalesce(fold == held, F.lit(False)).alias("held_out"),
                                       "lang_pred", "score")
