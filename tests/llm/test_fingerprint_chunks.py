"""Fingerprints against chunks cut by a plain loop, and whole, repetitive texts."""

import random

import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import fingerprints

_FULL = 2 ** 64 - 1


def _chunks(text, block):
    """The different chunks of a text in order, by one pass over its bytes."""
    data, out, start = text.encode(), [], 0
    for k in range(len(data)):
        h = 0
        for b in data[max(0, k - 6):k + 1]:
            h = (h * 0x100000001B3 + b + 1) & _FULL
        for shift, by in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = ((h ^ h >> shift) * by) & _FULL
        h = (h ^ h >> 31) >> 16
        if h & block - 1 == block - 1 and k + 1 < len(data):
            out.append(data[start:k + 1])
            start = k + 1
    return list(dict.fromkeys([*out, data[start:]]))


def _plain_likeness(a, b):
    """1 - (insertions and deletions) / chunks of both, by the table of edits."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        old, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(old[j - 1] if x == y else 1 + min(old[j], row[j - 1]))
    return 1 - row[-1] / (len(a) + len(b))


def _text(seed, words):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(words))


@pytest.mark.parametrize("words", [3, 40, 300, 1200])
def test_symbols_stand_for_the_chunks_of_a_plain_pass(words):
    one, other = _text(1, words), _text(2, words)
    changed = fingerprints.edited(one, other)
    for a, b in ((one, changed), (one, other), (changed, other)):
        marks = fingerprints.fingerprint(a), fingerprints.fingerprint(b)
        sizes = [{int(m.split(":")[0]) << k: s for k, s in enumerate(m.split(":")[1:])} for m in marks]
        for text, size in zip((a, b), sizes):
            for block, symbols in size.items():
                assert len(symbols) == 2 * len(_chunks(text, block))
                assert block == min(size) or len(symbols) <= 2 * fingerprints.SYMBOLS
        common = sizes[0].keys() & sizes[1].keys()
        want = max(_plain_likeness(_chunks(a, k), _chunks(b, k)) for k in common)
        assert abs(fingerprints.likeness(*marks) - want) < 0.05


def test_the_whole_of_a_repetitive_text_counts():
    lines = [_text(k, 12) for k in range(40)]
    text = "\n".join(random.Random(3).choices(lines, k=4000))
    changed = fingerprints.edited(text, _text(99, 60_000))
    mark = fingerprints.fingerprint(changed)
    assert 0 < fingerprints.likeness(fingerprints.fingerprint(text), mark) < 0.9
    assert fingerprints.likeness(mark, fingerprints.fingerprint(changed + " end")) > 0.9
    assert fingerprints.fingerprint("") == "0:::" and fingerprints.likeness("0:::", "0:::") == 1.0
    assert fingerprints.likeness("0:::", mark) == 0.0


@pytest.mark.parametrize("buckets", [1, 3, 40])
def test_neighbours_meet_over_any_ranges(spark, buckets):
    texts = [None, "", "ü" * 9, _text(5, 400), _text(5, 400), _text(6, 50) * 30, "z"]
    rows = [(10 * k, t, k, "clash") for k, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, part int, place string").repartition(4)
    got = {r["doc_id"]: r for r in fingerprints.compared(frame, buckets).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        following = texts[(k + 1) % len(texts)] or ""
        a, b = fingerprints.fingerprint(text or ""), fingerprints.fingerprint(following)
        changed = fingerprints.fingerprint(fingerprints.edited(text or "", following))
        r = got[10 * k]
        assert (r["fingerprint"], r["edited_fingerprint"]) == (a, changed)
        assert (r["near_next"], r["near_edited"]) == (fingerprints.likeness(a, b), fingerprints.likeness(a, changed))
    single = fingerprints.compared(frame.where("doc_id = 30"), buckets).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0
    again = fingerprints.compared(frame.union(frame).withColumn("doc_id", F.lit(7).cast("long")), buckets)
    assert again.count() == 2 * len(texts) and again.select("fingerprint").distinct().count() == len(texts) - 2
