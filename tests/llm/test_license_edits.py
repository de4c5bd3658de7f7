"""Edited licence notices of every label, and texts that only look like one."""

import numpy as np
import pytest

from lodgeflow.llm import license_scan

REAL = [("Licensed under GNU Lesser General Public License", {"gpl", "lgpl"}),
        ("Text is CC BY 3.0.", {"cc-by"}), ("photo (CC-BY-SA 2.5)", {"cc-by-sa"}), ("CC BY-NC-ND 4.0", {"cc-by-nc-nd"}),
        ("Licensed under CC BY-SA 4.0", {"cc-by-sa"}), ("licensed under a CC BY-NC 3.0", {"cc-by-nc"}),
        ("a Creative Commons Attribution 4.0 International License", {"cc-by"}),
        ("Creative Commons Attribution-ShareAlike 3.0 Unported License", {"cc-by-sa"}),
        ("Creative Commons Attribution-Noncommercial-No Derivs 3.0 Unported License", {"cc-by-nc-nd"}),
        ("licensed under the GNU General Public License, version 2", {"gpl"}),
        ("licensed under the Eclipse Public License", set()), ("the license of this software is free of charge", set()),
        ("rated 4.0 by 2.5 of users under the terms", set()), ("", set()), (None, set())]


def _labels(spark, texts):
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    return {r["doc_id"]: set(filter(None, r["labels"].split(","))) for r in license_scan.scan(frame).collect()}


def test_real_notices(spark):
    got = _labels(spark, [t for t, _ in REAL])
    assert {REAL[k][0]: v for k, v in got.items()} == dict(REAL)


@pytest.mark.parametrize("around", [("", ""), ("as the file says, ", " and so on for some more words")])
def test_one_word_put_in_and_one_replaced(spark, around):
    rng, texts, want = np.random.default_rng(4), [], []
    for notice, label in license_scan.NOTICES:
        words = notice.split()
        if len(words) < license_scan.EDIT_WORDS:
            continue
        free = [k for k in range(1, len(words) - 1) if words[k] not in license_scan.TELLING]
        for k in free:
            for at in (1, len(words) // 2, len(words) - 1, int(rng.integers(1, len(words)))):
                new = [w if i != k else "changed" for i, w in enumerate(words)]
                texts += [" ".join([*new[:at], "inserted", *new[at:]])]
                want.append(label)
        texts += [" ".join(words[:k] + words[k + 1:]) for k in free]
        want += [label] * len(free)
    got = _labels(spark, [t.join(around) for t in texts])
    assert len(set(want)) >= 12 and not [(t, w, got[k]) for k, (t, w) in enumerate(zip(texts, want)) if w not in got[k]]
