"""Texts that quote the added tokens of a vocabulary file get the ids that the
library gives them as it stands."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lodgeflow.llm import binary_output, packing, tokens

TEXTS = ["a <|endoftext|> b", "x<|startoftext|><|endoftext|>", "<|EndOfText|> <|endoftext |>", "<|endoftext|>",
         "plain words", "漢字 <|endoftext|> é", "<|", "endoftext|>", ""]


def _plain(name, text):
    return Tokenizer.from_file(public_tokenizers.path(name)).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_library(name):
    got = tokens.Encoder(public_tokenizers.path(name)).encode(TEXTS)
    assert [np.frombuffer(x, "<u4").tolist() for x in got] == [_plain(name, t) for t in TEXTS]


def test_packing_and_binary_output_keep_them(spark, tmp_dir):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    byte, word = "byte_bpe_50k.json", "word_bpe_49k.json"
    rows = packing.pack(docs, public_tokenizers.path(byte), length=8).collect()
    assert sum(r["length"] for r in rows) == sum(len(_plain(byte, t)) + 1 for t in TEXTS)
    binary_output.write_ids(docs, f"{tmp_dir}/added", public_tokenizers.path(word))
    got = {r["doc_id"]: np.frombuffer(bytes(r["ids"]), "<u4")[:-1].tolist()
           for r in binary_output.read_ids(spark, f"{tmp_dir}/added").collect()}
    assert got == {k: _plain(word, t) for k, t in enumerate(TEXTS)}
