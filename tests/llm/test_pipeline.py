"""The pipeline's stages with planted copies, secrets and toxic rows, and with
nulls, empty tables, repeated rows and doc_ids that several texts share."""

import random

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from lodgeflow.llm.shared import read

SF = "/root/testdata/sf0.001"
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, text_id string, id long, own int, "
          "component_id string, copies int, _stats int")
CLASH = ("clash", 1, 2, "clash", 0, 3)


def _docs(spark, rows):
    return spark.createDataFrame([(d, t, None, None, None, *CLASH) for d, t in rows], SCHEMA)


def _prose(k, n=80):
    r = random.Random(k)
    return " ".join("".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 9))) for _ in range(n))


def _near(text, at):
    words = text.split()
    words[at] = "changed"
    return " ".join(words)


def _rows(df):
    assert df.columns == P.COLUMNS
    return sorted(((r["doc_id"], r["text"]) for r in df.collect()), key=repr)


def _shingles(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


def test_near_duplicates_per_row(spark):
    one, two = _prose(1), _prose(2)
    rows = [(1, one), (2, one), (3, _near(one, 4)), (4, two), (5, two + " more"), (5, _prose(5)), (5, _prose(5)),
            (6, None), (6, ""), (7, None), (8, "few words"), (9, "few words"), (None, one), (None, one),
            (10, _prose(6)), (10, _near(_prose(6), 70)), (11, _near(_near(one, 4), 60))]
    kept = _rows(P.near_duplicates(spark, _docs(spark, rows).repartition(3), SF))
    # copies and near copies of 1 go, the clean text that shares its doc_id with a copy stays
    assert (1, one) in kept and not {2, 3, 9, 11} & {d for d, _ in kept}
    assert [t for d, t in kept if d == 5] == [_prose(5)]
    assert [r for r in kept if r[0] in (6, 7)] in ([(6, ""), (7, None)], [(6, None), (7, None)])
    assert kept.count((None, one)) == 2 and (8, "few words") in kept
    assert len([r for r in kept if r[0] == 10]) == 1


def test_near_duplicates_against_brute_force(spark):
    r, rows = random.Random(4), []
    for k in range(60):
        words = _prose(k % 12, 60).split()
        for _ in range(r.randint(0, 3)):
            words[r.randrange(60)] = f"new{k}"
        rows.append((k, " ".join(words)))
    label = {k: k for k, _ in rows}
    for a, x in rows:
        for b, y in rows:
            s, t = _shingles(x), _shingles(y)
            if a < b and 5 * len(s & t) >= 4 * len(s | t):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {k: new if v == old else v for k, v in label.items()}
    kept = _rows(P.near_duplicates(spark, _docs(spark, rows).repartition(4), SF))
    assert kept == sorted(((k, t) for k, t in rows if label[k] == k), key=repr)


def test_secrets_go_and_texts_stay(spark):
    key = "AKIA" + "Q7ZK3MW9X2VB5NT8"
    rows = [(1, f"a line\nkey {key} end"), (1, f"a line\nkey {key} end"), (2, "no secret here"), (3, None), (4, ""),
            (None, "password = hunter2hunter2 x")]
    out = _rows(P.secrets(spark, _docs(spark, rows), SF))
    assert len(out) == 6
    assert not any(key in (t or "") or "hunter2hunter2" in (t or "") for _, t in out)
    assert (2, "no secret here") in out and {d for d, _ in out} == {1, 2, 3, 4, None}
    assert all(t.startswith("a line\nkey ") and t.endswith(" end") for d, t in out if d == 1)


@pytest.fixture(scope="module")
def labelled(spark, tmp_path_factory):
    """A folder whose labels mark doc_ids below 200, odd ones toxic and of low quality."""
    path = str(tmp_path_factory.mktemp("labels"))
    spark.createDataFrame([(k, 1 - k % 2, k % 2) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(
        f"{path}/labels.parquet")
    return path


def _talk(k):
    r = random.Random(k)
    if k % 2:
        return " ".join(r.choice(["vile", "hatred", "scum", "filth", "idiot", "the", "and"]) for _ in range(60))
    return " ".join(r.choice(["garden", "river", "music", "bread", "window", "the", "and"]) for _ in range(60))


def test_mixture_drops_toxic_rows_one_by_one(spark, labelled):
    rows = [(k, _talk(k)) for k in range(300)] + [(402, _talk(401)), (402, _talk(400)), (None, _talk(403)),
                                                  (None, _talk(404)), (500, None)]
    kept = _rows(P.mixture(spark, _docs(spark, rows).repartition(3), labelled))
    ids = {d for d, _ in kept}
    assert {k for k in range(0, 300, 2)} <= ids                      # clean ones stay
    assert not [k for k in range(1, 300, 2) if k in ids]             # toxic ones go, held out or not
    assert [t for d, t in kept if d == 402] == [_talk(400)]          # by text, not by doc_id
    assert [t for d, t in kept if d is None] == [_talk(404)]


def test_stages_keep_columns_and_take_empty_tables(spark, labelled):
    none = _docs(spark, [])
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, none, labelled)
        assert out.columns == P.COLUMNS and out.count() == 0, name
    assert P.pack(spark, none, labelled).count() == 0
    nulls = _docs(spark, [(None, None)] * 3)
    for name, stage in P.STAGES[1:-1]:
        assert stage(spark, nulls, labelled).count() == 3, name


def test_no_labels_no_loss(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = _docs(spark, [(k, _prose(k)) for k in range(20)])
    assert P.quality(spark, docs, str(tmp_path)).count() == 20
    assert P.mixture(spark, docs, str(tmp_path)).count() == 20


def test_whole_run_keeps_what_the_stages_keep(spark):
    docs = read(spark, SF, "documents")
    for _, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    want = {r["doc_id"] for r in docs.select("doc_id").collect()}
    pieces = P.run(spark, SF)
    got = {r["doc_id"]: (r["n"], r["t"]) for r in pieces.groupBy("doc_id").agg(
        F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()}
    assert set(got) == want and all(n == t for n, t in got.values())
