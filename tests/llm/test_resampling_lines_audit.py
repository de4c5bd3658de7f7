"""Resampling, line bitmaps and the filter audit against brute force, on odd
input, long texts, hot keys, ties and repeated rows."""

import hashlib
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm import filter_audit, importance, line_dedup

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, place int, h1 string, weight string, "
          "segment int, part string")
_rng = random.Random(3)
_LEX = ["alpha", "Beta", "gamma", "DELTA", "straße", "Éclair", "漢字", "x1", "#tag", "a&b", "İstanbul", "end.", "it's"]
_SHARED = ["  THE SAME LONG LINE of text that many documents hold, again ",
           "the same long line of text that many documents hold, again\r", "ÄÖÜ " * 12, "ä" * 39, "Ä" * 40, ""]


def _text(k):
    r = random.Random(k)
    lines = [" ".join(r.choice(_LEX) for _ in range(r.randint(0, 12))) for _ in range(r.randint(1, 90))]
    for _ in range(r.randint(0, 5)):
        lines.insert(r.randint(0, len(lines)), r.choice(_SHARED))
    return "\n".join(lines)


ROWS = [(k, _text(k % 45), None, f"s{k % 4}" if k % 5 else None) for k in range(60)]
ROWS += [(100, None, "en", "s1"), (101, "", "en", "s1"), (102, " \t\n\x0b\x0c\r ", None, "s1"), (103, "\n\n", None, ""),
         (104, "\n".join(["only one shared line, of forty and more characters"] * 200), None, "hot"),
         (105, "zéro\0byte " * 30, None, "s2"), (106, ("long word run " * 9_000 + "\n") * 20, None, "s2"),
         (107, "w" * 3_000_000, None, "s3")]
ROWS += [(200 + k, "copied text of a hot group, which is longer than forty\nTHE end", None, "hot") for k in range(40)]
CLASH = (7, 5, "clash", "clash", 3, "clash")


def _docs(spark, rows):
    return spark.createDataFrame([(*r[:4], *CLASH) if len(r) == 4 else r for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return _docs(spark, ROWS).repartition(5)


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# ---------------------------------------------------------------- line bitmaps

def _line_brute(rows, least_chars=40, least_docs=5):
    held = defaultdict(set)
    key = lambda line: _lower(line.strip(" \t\n\x0b\x0c\r"))
    for doc, text, *_ in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= least_chars:
                held[key(line)].add(doc)
    out = []
    for doc, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(held.get(key(x), ())) < least_docs or doc == max(
            (d for d in held[key(x)] if d is not None), default=None)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def _line_rows(df):
    return sorted((tuple(r) for r in line_dedup.digest(df).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()),
                  key=repr)


def test_lines_against_brute_force(docs):
    assert _line_rows(line_dedup.deduplicated(docs)) == _line_brute(ROWS)
    assert _line_rows(line_dedup.deduplicated(docs, 1, 2)) == _line_brute(ROWS, 1, 2)


def test_lines_hot_key_over_many_ranges(spark):
    hot = "a very common line, which every document of the table has in it"
    rows = [(k, "\n".join([hot, f"own line {k} " * 5, hot.upper()]), None, "s") for k in range(2_000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = _docs(spark, rows).repartition(8)
        parts = line_dedup._ranges(df, 40).groupBy("part").count().collect()
        assert max(r["count"] for r in parts) < 4 * 6_000 / 16  # the line's rows lie in many ranges
        assert _line_rows(line_dedup.deduplicated(df)) == _line_brute(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_lines_repeated_rows_and_missing_ids(spark):
    line = "a line of more than forty characters that is held by all of them"
    rows = [(k, line, None, "s") for k in (1, 2, 3, 4, 5, 5, None, None)] + [(5, line + "\nother text", None, "s")]
    assert _line_rows(line_dedup.deduplicated(_docs(spark, rows))) == _line_brute(rows)
    rows = [(None, line, None, "s")] * 6  # one document without an id
    assert _line_rows(line_dedup.deduplicated(_docs(spark, rows))) == _line_brute(rows)


def test_bitmaps_leave_out_full_words_and_plan_has_no_python(docs):
    maps = line_dedup.keep_bitmaps(docs)
    for r in maps.collect():
        assert all(w["bits"] != -1 for w in r["keep"])
        assert sum(64 - bin(w["bits"] & (2**64 - 1)).count("1") for w in r["keep"]) == r["n_dropped"] > 0
    plan = line_dedup.deduplicated(docs)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


# ---------------------------------------------------------------- filter audit

def _audit_brute(rows, labels):
    smallest = {}
    for doc, text, *_ in rows:
        if doc is not None:
            smallest[text or ""] = min(doc, smallest.get(text or "", doc))
    good = {d for d, q, t in labels if q == 1 and d is not None}  # a label without doc_id belongs to no document
    toxic = {d for d, q, t in labels if t == 1 and d is not None}
    facts = defaultdict(list)
    for doc, text, _, source, *_ in rows:
        text = text or ""
        words = re.findall("[^\x20\x09-\x0D]+", text)
        fails = set()
        fails |= {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search("[#$%&*|]", text) else set()
        fails |= {"E"} if doc is not None and smallest[text] < doc else set()
        facts[source or ""].append((doc, fails))
    out = []
    for part, own in facts.items():
        removed_of, shapley = {}, Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                removed_of["".join(order), step] = f, len(left), gone
                shapley[f] += len(gone)
        for (order, step), (f, kept, gone) in removed_of.items():
            out.append((part, order, step, kept, len(gone), sum(f in x for _, x in own) - len(gone),
                        sum(x == {f} for _, x in own), sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone),
                        shapley[f]))
    return sorted(out)


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, source string, mask int")


def test_audit_against_brute_force(spark, docs):
    labels = [(k, k % 2, k % 3 // 2, "x", 9) for k in range(0, 240, 2)] + [(1, None, 1, "x", 9), (3, 1, None, "x", 9),
                                                                          (None, 1, 1, "x", 9)]
    rows = ROWS + [(None, _text(3), None, "s1"), ROWS[5], ROWS[5], (5, "another text of that id", None, "s0")]
    found = filter_audit.audit(_docs(spark, rows).repartition(4), _labels(spark, labels + [(4, 0, 0, "x", 9)]))
    got = sorted(tuple(r) for r in found.collect())
    assert len(got) == 600 * len({r[3] or "" for r in rows})
    assert got == _audit_brute(rows, [x[:3] for x in labels])


def test_adjacent_swaps_pass_all_orders():
    for n in (1, 2, 3, 5):
        counts = {m: filter_audit.Weight(m + 1, m % 2, m % 3) for m in range(1 << n) if m % 5 != 3}
        diagram = filter_audit.Diagram(counts, "ABCDE"[:n])
        seen = {diagram.order}
        for level in filter_audit.adjacent_swaps(n):
            diagram.swap(level)
            seen.add(diagram.order)
            assert filter_audit.weight(diagram.root).docs == sum(w.docs for w in counts.values())
        assert len(seen) == math.factorial(n)


# ---------------------------------------------------------------- resampling

def _importance_brute(rows, target, percent=25):
    def found(text):
        words = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(text or ""))
        runs = words + [" ".join(p) for p in zip(words, words[1:])]
        return len(words), [zlib.crc32(x.encode()) % 10000 for x in runs]

    s = Counter(b for _, text, *_ in rows for b in found(text)[1])
    t = Counter(b for text in target for b in found(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
    out, able = [], []
    for k, (doc, text, *_) in enumerate(rows):
        n, own = found(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        score = None
        if doc is not None:
            h = int(hashlib.sha256(f"7:{doc}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
            if n >= 20:
                able.append((-score, doc, len(own), k))
        out.append([doc, len(own), weight, score, None])
    for rank, (*_, k) in enumerate(sorted(able)[:len(able) * percent // 100], 1):
        out[k][4] = rank
    return sorted(map(tuple, out), key=repr)


def _target(spark, texts):
    return spark.createDataFrame([(k, t, "clash") for k, t in enumerate(texts)], "item_id long, text string, doc_id string")


def _drawn(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def test_resampling_against_brute_force(spark, docs):
    target = [_text(k) for k in range(5)] + [None, ""]
    rows = ROWS + [(None, _text(1), None, "s")]
    df = _docs(spark, rows).repartition(6)
    assert _drawn(importance.resampled(df, _target(spark, target))) == _importance_brute(rows, target)
    assert _drawn(importance.resampled(df, _target(spark, target), percent=100)) == _importance_brute(rows, target, 100)
    assert _drawn(importance.resampled(df, _target(spark, [None]))) == _importance_brute(rows, [])


def test_ranks_are_exact_over_many_runs_and_segments(spark):
    rows = [(k, " ".join(f"w{(k * j) % 97}" for j in range(20 + k % 7)), None, "s") for k in range(6_000)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        df = _docs(spark, rows).repartition(13)
        got = _drawn(importance.resampled(df, _target(spark, ["w1 w2 w3 w4"]), percent=100))
        assert got == _importance_brute(rows, ["w1 w2 w3 w4"], 100)
        assert sorted(r[4] for r in got) == list(range(1, 6_001))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_features_of_blocks_are_those_of_the_whole(monkeypatch):
    text = _text(8).encode() * 3
    whole = np.sort(np.concatenate([f for _, f in importance.features(text, 10_000, 3)]))
    words = sum(n for n, _ in importance.features(text, 10_000, 3))
    monkeypatch.setattr(importance, "BLOCK", 50)
    blocks = list(importance.features(text, 10_000, 3))
    assert len(blocks) > 5 and sum(n for n, _ in blocks) == words
    assert np.array_equal(np.sort(np.concatenate([f for _, f in blocks])), whole)
    monkeypatch.setattr(filter_audit, "BLOCK", 50)
    assert filter_audit._vocabulary(text) == (len(text.split()), len(set(text.split())))


def test_ties_go_to_the_smaller_doc_id(spark):
    # equal rows of one doc_id tie in score; all get a rank of their own
    rows = [(5, " ".join(["same"] * 30), None, "s")] * 7 + [(6, " ".join(["same"] * 25), None, "s")] * 3
    got = _drawn(importance.resampled(_docs(spark, rows), _target(spark, ["same"]), percent=100))
    assert got == _importance_brute(rows, ["same"], 100)


# ---------------------------------------------------------------- odd input

def test_empty_tables(spark):
    none, labels = _docs(spark, []), _labels(spark, [])
    assert line_dedup.digest(line_dedup.deduplicated(none)).count() == 0
    assert filter_audit.audit(none, labels).count() == 0
    assert importance.resampled(none, _target(spark, [])).count() == 0


def test_all_null_columns(spark):
    rows = _docs(spark, [(None, None, None, None)] * 3).withColumns(
        {c: F.lit(None).cast(t) for c, t in (("place", "int"), ("h1", "string"))})
    kept = line_dedup.deduplicated(rows).select("doc_id", "n_lines", "n_dropped", "kept").collect()
    assert [tuple(r) for r in kept] == [(None, 1, 0, "")] * 3
    audit = filter_audit.audit(rows, _labels(spark, [(None, None, None, None, None)])).where("filter_order = 'ABCDE'")
    assert [(r["part"], r["step"], r["removed"]) for r in audit.orderBy("step").collect()] == [
        ("", 1, 3), ("", 2, 0), ("", 3, 0), ("", 4, 0), ("", 5, 0)]
    assert _drawn(importance.resampled(rows, _target(spark, [None]))) == [(None, 0, 0, None, None)] * 3
