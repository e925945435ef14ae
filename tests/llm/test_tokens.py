"""Token counts: pieces against the library on whole texts."""

import random

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from marketlake.llm.common import table
from marketlake.llm.token_counts import Library, token_counts

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")
PIECE = public_tokenizers.path("piece_bpe_32k.model")
DOCS = "doc_id long, text string, n_tokens string, n_bytes string, digest string"
PARTS = [
    "a", "b", " ", " ", "  ", "'s", "'re", "'", "!", "1", "\n", "\n\n", "é", "漢", "<|endoftext|>", "<|endof", "the ", " word",
    "　", "\x85", "\x1c", "́", "᠎", "\xa0", "​",
]


def _plain(path, text):
    if path.endswith(".model"):
        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text))
    return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False))


def _texts(seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.choice([0, 5, 50, 300, 900]))) for _ in range(150)]


@pytest.mark.parametrize("chunk, overlap", [(64, 24), (40, 1), (200, 90)])
def test_pieces_equal_whole_texts(spark, chunk, overlap):
    docs = list(enumerate(_texts(chunk)))
    # long words have no boundary in the overlap; both pieces next to a cut can fail
    docs += [(900, "a" * 3000), (901, ("b" * 900 + " ") * 5), (902, "'" * 2000 + "s" * 500), (903, " " * 2500 + "x")]
    docs += [(None, None), (None, "x y"), (None, "x y"), (904, "q" * 100 + " w" * 400), (904, "q" * 100 + " w" * 400)]
    df = spark.createDataFrame([(*d, "x", "y", "z") for d in docs], DOCS)
    library = Tokenizer.from_file(BYTE)
    want = [(i, len((x or "").encode()), n := len(library.encode(x or "", add_special_tokens=False)), n > 100) for i, x in docs]
    got = [tuple(r) for r in token_counts(df, BYTE, limit=100, chunk=chunk, overlap=overlap).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_whole_table(spark, tables):
    docs = table(spark, tables, "documents")
    library = Tokenizer.from_file(BYTE)
    want = {r.doc_id: len(library.encode(r.text or "", add_special_tokens=False)) for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in token_counts(docs, BYTE, chunk=2000, overlap=100).collect()} == want


@pytest.mark.parametrize("path", [WORD, PIECE])
def test_other_files_are_encoded_whole(spark, path):
    docs = list(enumerate(["", "Hello  World's end.", "é" * 300, "no\nbreak 漢字"]))
    got = token_counts(spark.createDataFrame(docs, "doc_id long, text string"), path, chunk=16, overlap=4).collect()
    assert not Library(path).proven
    assert {r.doc_id: r.n_tokens for r in got} == {i: _plain(path, x) for i, x in docs}


def test_empty_table(spark):
    got = token_counts(spark.createDataFrame([], DOCS), BYTE)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and got.count() == 0


def test_one_text_with_most_rows(spark):
    text = "some words " * 30
    df = spark.createDataFrame([(k, text) for k in range(300)] + [(k, f"{k}") for k in range(300, 400)], "doc_id long, text string")
    got = token_counts(df, BYTE, chunk=50, overlap=20).collect()
    assert len(got) == 400 and {r.n_tokens for r in got if r.doc_id < 300} == {_plain(BYTE, text)}
