"""Byte-level BPE against the public tokenizer library, and round trips."""

import base64
import hashlib
import random
import tracemalloc

import public_tokenizers
import pytest
import tiktoken
from llm_helpers import docs_of, rows_of

from lamina.llm.bpe import Encoder, decode_documents, digests, encode_documents, replay, vocabulary

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [
    "", "a" * 3001, " " * 77, "aaaabbbbaaab" * 50, "\n\n\n  \t", "é漢字ß 😀😀", " !!!???---___===",
    "don't I'll  we've\n x", "\x00\x01 x   y", "abababab" * 40, " lead", "trail ", "a  b \n c",
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_ids_equal_the_library(library):
    picked = random.Random(5)
    alphabet = [" ", "  ", "\n", " \n", "\t", "a", "b", "the", "'s", "1", "23", "!", "é", "漢", "\x1c", "😀"]
    texts = ODD + ["".join(picked.choices(alphabet, k=picked.randint(0, 40))) for _ in range(3000)]
    encoder = Encoder(PATH, PATTERN)
    for text, ids in zip(texts, encoder.encode(texts)):
        assert ids.tolist() == library.encode_ordinary(text), repr(text)
    again = encoder.encode(texts[::-1])
    assert [a.tolist() for a in again] == [library.encode_ordinary(t) for t in texts[::-1]]


def test_replay_equals_the_definition():
    vocab, picked = vocabulary(PATH), random.Random(7)
    pieces = [bytes(picked.choices(b"abet ing", k=picked.randint(1, 30))) for _ in range(2000)]
    ids, held = replay(pieces, vocab)
    begin = 0
    for piece, count in zip(pieces, held.tolist()):
        assert ids[begin : begin + count].tolist() == vocab.one_by_one(piece)
        begin += count


def test_documents_and_digests(spark, library):
    pairs = [*enumerate(ODD), (None, "no id"), (900, None), (5, ODD[5]), (5, ODD[5])]
    docs = docs_of(spark, pairs)
    found = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in rows_of(digests(docs, PATH, PATTERN)) if r["doc_id"] is not None)
    expected = []
    for doc_id, text in pairs:
        if doc_id is not None:
            ids = library.encode_ordinary(text or "")
            packed = b"".join(i.to_bytes(4, "little") for i in ids)
            expected.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert found == sorted(expected)
    encoded = encode_documents(docs, PATH, PATTERN)
    contents = [bytes(r["content"]) for r in rows_of(decode_documents(encoded, PATH))]
    assert sorted(contents) == sorted((text or "").encode() for _, text in pairs)


def test_empty_table(spark):
    assert digests(docs_of(spark, []), PATH, PATTERN).collect() == []


def test_words_of_a_block_are_not_held_at_once():
    encoder = Encoder(PATH, PATTERN)
    texts = [f"{k} " + "word after word " * 2_000 for k in range(60)]
    tracemalloc.start()
    encoder.encode(texts)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 6 * sum(map(len, texts))


def test_long_stretches_are_forgotten_too(library):
    encoder = Encoder(PATH, PATTERN)
    picked = random.Random(3)
    for _ in range(6):
        text = "".join(picked.choices("abcdefgh", k=2_000_000))
        encoder.encode([text])
    assert len(encoder.ids) < 3_000_000
    short = text[:1000]
    assert encoder.encode([short])[0].tolist() == library.encode_ordinary(short)
