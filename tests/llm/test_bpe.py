import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from riskmart.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.read_ranks(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(encoder):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=encoder.vocabulary.ranks, special_tokens={}
    )


def texts():
    rng = random.Random(3)
    letters = "etaoin shrdlu\n\t0123ééßñ汉字🙂'.,-AZ<|>"
    made = ["".join(rng.choices(letters, k=rng.randrange(400))) for _ in range(200)]
    return [*made, "", "a" * 5000, " " * 3000, "ab" * 1000, "\r\n   x", "<|endoftext|>", "antidisestablishmentarianism" * 9]


def test_ids_equal_the_library(encoder, library):
    for text in texts():
        ids = encoder.encode(text)
        assert ids == library.encode_ordinary(text)
        assert encoder.decode(ids) == text.encode()


def test_append_and_edit_equal_encoding_anew(encoder):
    rng, vocabulary = random.Random(5), encoder.vocabulary
    for _ in range(60):
        data = bytes(rng.choices(b"abcde th in er  on", k=rng.randrange(1, 300)))
        cut = rng.randrange(len(data) + 1)
        table = bpe.PrefixTable(vocabulary, data[:cut])
        table.append(data[cut:])
        assert table.last == bpe.PrefixTable(vocabulary, data).last
        a, b = sorted(rng.choices(range(len(data) + 1), k=2))
        new = bytes(rng.choices(b"thinera ", k=rng.randrange(9)))
        table.replace(a, b, new)
        assert table.last == bpe.PrefixTable(vocabulary, data[:a] + new + data[b:]).last


def test_rows(spark, library):
    rows = [(1, "Hello  world", "x"), (1, "Hello  world", "x"), (None, None, "y"), (3, "", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = sorted(bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect(), key=str)
    assert len(found) == 4
    by_id = {r.doc_id: r for r in found}
    ids = library.encode_ordinary("Hello  world")
    assert by_id[1].n_tokens == len(ids)
    assert by_id[1].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert by_id[1].decoded_sha256 == hashlib.sha256(b"Hello  world").hexdigest()
    assert by_id[None].n_tokens == by_id[3].n_tokens == 0
    assert bpe.digests(docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
    ids_rows = bpe.encode(docs, PATH, public_tokenizers.PATTERN).where("doc_id = 1").first()
    assert list(ids_rows.ids) == ids and bytes(ids_rows.decoded) == b"Hello  world"


def test_whole_table_equals_the_library(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {r.doc_id: r for r in bpe.digests(docs, PATH, public_tokenizers.PATTERN).collect()}
    for row in docs.collect():
        ids = library.encode_ordinary(row.text)
        assert found[row.doc_id].n_tokens == len(ids)
        assert found[row.doc_id].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
