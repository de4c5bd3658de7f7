"""Rates against a plain descent in numpy, and words that tell rare domains."""

import numpy as np
import pytest

from lodgeflow.llm import mixing

_WORDS = [f"{a}{b}{c}" for a in "bdfgklmnprst" for b in "aeiou" for c in "bdgklmnrst"]


def _plain(tokens, share, target, loose, steps=200_000):
    """Projected gradient with one safe step length, to the end."""
    rate = np.ones(len(tokens))
    step = loose / (loose + np.linalg.eigvalsh((share * tokens[:, None]).T @ share)[-1])
    for _ in range(steps):
        new = np.maximum(0, rate - step * (share @ ((tokens * rate) @ share - target) / loose + rate - 1))
        if np.abs(new - rate).max() < 1e-13:
            break
        rate = new
    return rate


@pytest.mark.parametrize("weights, headroom", [({"a": 0.6, "b": 0.3, "c": 0.1}, 1.0), ({"a": 1.0, "b": 0.0, "c": 0.0}, 1.05)])
def test_rates_are_the_least_squares_fit(spark, weights, headroom):
    rng = np.random.default_rng(4)
    share = rng.dirichlet([0.4, 0.3, 0.3], 120)
    share[40:80] = share[40]  # many alike
    tokens = rng.integers(1, 500, 120).astype(float)
    rows = [(k, int(tokens[k]), *map(float, share[k])) for k in range(120)]
    members = spark.createDataFrame(rows, "doc_id long, tokens int, p0 double, p1 double, p2 double")
    rate, report = mixing.fit_rates(members, ["a", "b", "c"], weights, headroom, slack=0.01)
    got = np.array([r[1] for r in sorted(members.select("doc_id", rate).collect())])
    held, aim = tokens @ share, np.array(list(weights.values()))
    target = aim * min(h / a for h, a in zip(held, aim) if a) * headroom
    assert np.allclose(report["target"], target) and report["error"][-1] < 1e-6
    assert np.allclose(got, _plain(tokens, share, target, 0.01 * held.sum()), atol=1e-4)
    assert got.min() >= 0


def test_a_rare_domain_is_told_on_held_out_labels(spark):
    rng = np.random.default_rng(9)
    insults = ["nitwit", "dunce", "oaf"]

    def text(bad):
        words = list(rng.choice(_WORDS, int(rng.integers(20, 60))))
        return " ".join([*words[:5], *([str(rng.choice(insults))] * 2 if bad else []), *words[5:]])

    truth = [k % 12 == 0 for k in range(1800)]
    docs = spark.createDataFrame([(k, text(bad)) for k, bad in enumerate(truth)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, "toxic" if truth[k] else "clean") for k in range(600)], "doc_id long, domain string")
    out = [r for r in mixing.mixed(docs, labels, {"clean": 0.98, "toxic": 0.02}).collect() if r["doc_id"] >= 600]
    assert sum((r["domain"] == "toxic") == truth[r["doc_id"]] for r in out) >= 0.99 * len(out)
    kept = sum(r["n_tokens"] * r["rate"] for r in out)
    assert sum(r["n_tokens"] * r["rate"] for r in out if truth[r["doc_id"]]) < 1.5 * 0.02 * kept
    few, _ = mixing.lexicon(docs, labels, ["clean", "toxic"], bound=240)  # all 50 of one, 120 of the other
    assert {r["feature"] for r in few.collect()} == {*insults}


def test_labels_that_say_nothing_give_no_words(spark):
    rng = np.random.default_rng(10)
    docs = spark.createDataFrame([(k, " ".join(rng.choice(_WORDS, 30))) for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, "ab"[int(rng.integers(2))]) for k in range(400)], "doc_id long, domain string")
    words, _ = mixing.lexicon(docs, labels, ["a", "b"])
    assert words.count() <= 1
    assert mixing.mixed(docs, labels.where("false"), {"a": 0.5, "b": 0.5}).where("abs(rate - 1) > 1e-6").count() == 0
