"""Sketches of large sets never drop a pair that links, and drop far ones."""

import numpy as np

from lodgeflow.llm import ngram_join


def test_wide_sketches_bound_the_difference(spark):
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 6_000, dtype=np.uint64)
    sets = {k: np.unique(np.concatenate([base[:n], rng.integers(0, 2**63, extra, dtype=np.uint64)]))
            for k, (n, extra) in enumerate([(2_000, 0), (2_000, 200), (2_040, 100), (2_060, 120), (1_900, 700), (1_000, 1_200),
                                            (500, 3), (4_000, 100), (4_100, 300), (0, 4_096), (0, 4_097), (2_000, 2_000)])}
    wides = spark.createDataFrame(
        [(k, len(v), w.tolist()) for k, v in sets.items() if (w := ngram_join.wide_sketch(v)) is not None],
        "node long, n long, wide array<long>")
    assert wides.count() == len(sets) - 1  # the one of 503 has none
    pairs = [(a, b) for a in sets for b in sets if a < b]
    for num in (80, 90, 50):
        left = {tuple(r) for r in ngram_join._still_possible(
            spark.createDataFrame(pairs, "a long, b long"), wides, num, 100).collect()}
        for a, b in pairs:
            common = len(np.intersect1d(sets[a], sets[b]))
            union = len(sets[a]) + len(sets[b]) - common
            if 100 * common >= num * union:
                assert (a, b) in left
        assert (0, 6) in left
        if num >= 80:  # at 50 the bound is as large as what the sketches of these can show
            assert (9, 10) not in left and (0, 5) not in left
