"""Random keys of usual length among plain identifiers."""

import numpy as np

from lodgeflow.llm import secret_scan

_rng = np.random.default_rng(11)
LENGTHS, PER_CASE = (20, 24, 32, 40, 64), 20
WORDS = ("account user config loader main source index value stream buffer parser handler request response session "
         "image upload gallery travel hotel city review price market report season winter summer family world").split()


def _identifier() -> str:
    w = [str(x) for x in _rng.choice(WORDS, 6)]
    n, day = int(_rng.integers(10, 9999)), f"20{_rng.integers(10, 25)}-0{_rng.integers(1, 9)}-{_rng.integers(10, 28)}"
    return str(_rng.choice(["_".join(w[:4]) + f"_v{n}", "-".join(w) + f"-{day}", "/".join(w[:5]) + str(n),
                            "get" + "".join(x.title() for x in w[:4]) + f"By{n}", "_".join(w[:4]).upper() + str(n),
                            f"IMG-{day}-{n}{n}{n}", "".join(w[:5]), f"{w[0]}{n}_{w[1]}{n}_{w[2]}_{w[3]}"]))


def test_keys_of_usual_length_are_found_among_identifiers(spark):
    keys = [(name, n, "".join(_rng.choice(list(letters), n)))
            for name, letters in secret_scan.ALPHABETS.items() for n in LENGTHS for _ in range(PER_CASE)]
    plain = [x for x in (_identifier() for _ in range(6000)) if len(x) >= secret_scan.LEAST]
    lines = [k for _, _, k in keys] + plain
    rows = [(k, f"see {x} here") for k, x in enumerate(lines)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"] for r in secret_scan.scan(frame).collect() for s in r["spans"] if s["stop"] - s["start"] >= 20}
    for name in secret_scan.ALPHABETS:
        for n in LENGTHS:
            own = [i for i, (a, m, _) in enumerate(keys) if (a, m) == (name, n)]
            assert sum(i in found for i in own) >= 0.8 * PER_CASE, (name, n)
    assert sum(i in found for i in range(len(keys))) >= 0.96 * len(keys)
    wrong = [lines[i] for i in found if i >= len(keys)]
    assert len(wrong) <= 0.01 * len(found), wrong


def test_text_model_is_a_distribution():
    assert np.allclose(np.exp(secret_scan._TEXT[[0, *b"azAZ09+/-_"]]).sum(axis=1), 1)


def test_words_are_no_keys():
    for word in ("internationalisation", "Donaudampfschifffahrtsgesellschaft", "anticonstitutionnellement",
                 "AbstractSingletonProxyFactoryBean", "00000000001111111111", "2023-01-15-20150304123456"):
        assert secret_scan.randomness(word)[2] > 0.01, word
