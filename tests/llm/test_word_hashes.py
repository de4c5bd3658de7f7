"""Words that a polynomial hash modulo 2**64 cannot tell apart."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodgeflow.llm import binary_output, ngram_join, packing
from lodgeflow.llm.bytewords import run_hashes, text_bytes
from lodgeflow.llm.tokens import Encoder


def doubled(n, a="a", b="b"):
    """a, ab, abba, abbabaab, ...: each is followed by its opposite."""
    x, y = a, b
    while len(x) < n:
        x, y = x + y, y + x
    return x, y


WORDS = [w for n in (512, 1024, 2048, 4096) for w in doubled(n)] + [w for w in doubled(1024, "x", "q")]


def test_hashes_differ():
    words = WORDS + ["a" * n for n in range(1, 300)] + ["ab" * n for n in range(1, 300)]
    data, begins = text_bytes(words)
    hashes = run_hashes(data, begins[:-1], np.diff(begins) - 1)
    assert len(set(hashes.tolist())) == len(set(words))
    again = run_hashes(data, begins[:-1], np.diff(begins) - 1)
    assert np.array_equal(hashes, again)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_token_ids_are_the_librarys(name):
    path = public_tokenizers.path(name)
    encoder, library = Encoder(path), Tokenizer.from_file(path)
    for word in WORDS:  # one after the other: the first must not answer for the second
        ids = np.frombuffer(encoder.encode([f"the {word} end"])[0], dtype="<u4").tolist()
        assert ids == library.encode(f"the {word} end", add_special_tokens=False).ids


def test_sets_stay_apart_and_files_hold_the_librarys_ids(spark, tmp_dir):
    one, two = doubled(2048)
    texts = [f"x y {one}", f"x y {two}", f"x y {one}"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    found = {r["doc_id"]: r["component_id"] for r in ngram_join.linked(docs, 3, 90, 100).collect()}
    assert found == {0: 0, 1: 1, 2: 0}
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    binary_output.write_ids(docs, f"{tmp_dir}/ids", path)
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), dtype="<u4").tolist()
           for r in binary_output.read_ids(spark, f"{tmp_dir}/ids").collect()}
    assert got == {k: [*library.encode(t, add_special_tokens=False).ids, 1] for k, t in enumerate(texts)}
    path = public_tokenizers.path("byte_bpe_50k.json")
    totals = {r["doc_id"]: r["doc_tokens"] for r in packing.pack_digest(packing.pack(docs, path)).collect()}
    library = Tokenizer.from_file(path)
    assert totals == {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in enumerate(texts)}
