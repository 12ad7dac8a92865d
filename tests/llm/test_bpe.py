import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from plumbline.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    with open(PATH, "rb") as file:
        return bpe.Vocabulary(bpe.read_ranks(file.read()))


@pytest.fixture(scope="module")
def library(vocabulary):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})


def random_text(rng, size):
    alphabet = ["a", "e", "th", "ing", " ", "  ", "\n", "9", "13", "é", "ß", "漢", "😀", "!!", "'s", "\t", "--", "==", "ab" * 9, "A", "​"]
    return "".join(rng.choice(alphabet) for _ in range(size))


def test_equals_library(vocabulary, library):
    rng = random.Random(1)
    for _ in range(400):
        text = random_text(rng, rng.randint(0, 60))
        pieces = bpe.regex.findall(public_tokenizers.PATTERN, text)
        ids = [i for p in pieces for i in vocabulary.encode(p.encode())]
        assert ids == library.encode_ordinary(text)
        assert vocabulary.decode(ids) == text.encode()


def test_long_piece(vocabulary, library):
    for text in ("ab" * 20_000, "-" * 30_000, "x" * 5_001, "thention" * 2_000):
        assert vocabulary.encode(text.encode()) == library.encode_ordinary(text)


def test_append_and_edit(vocabulary, library):
    rng = random.Random(2)
    for _ in range(100):
        word = "".join(rng.choice(["th", "en", "x", "ing", "é", "q"]) for _ in range(rng.randint(1, 200)))
        data = word.encode()
        cut = rng.randint(0, len(data))
        table = bpe.PrefixTable(vocabulary, data[:cut])
        table.append(data[cut:])
        assert table.ids() == bpe.PrefixTable(vocabulary, data).ids()
        start = rng.randint(0, len(data))
        stop = min(len(data), start + rng.randint(0, 4))
        table.replace(start, stop, b"zen")
        fresh = bpe.PrefixTable(vocabulary, data[:start] + b"zen" + data[stop:])
        assert (table.ids(), table.last) == (fresh.ids(), fresh.last)


def test_edit_stays_local(vocabulary):
    table = bpe.PrefixTable(vocabulary, b"thentioner" * 2_000)
    assert table.replace(50, 51, b"Q") < 1_000


def test_rows(spark, library):
    rows = [(1, "The cat's 12 hats!\n\n ok", 5), (2, None, 6), (3, "", 7), (None, "x", 8), (1, "The cat's 12 hats!\n\n ok", 5), (5, "z" * 200_000, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = sorted(bpe.bpe_round_trip(df, PATH, public_tokenizers.PATTERN).collect(), key=str)
    want = []
    for key, text, _ in rows:
        ids = library.encode_ordinary(text or "")
        digest = [hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (text or "").encode())]
        want.append((key, len(ids), *digest))
    assert [tuple(r) for r in got] == [tuple(r) for r in sorted((spark.createDataFrame(want, got[0].__fields__ and "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string").collect()), key=str)]
    apart = bpe.bpe_decode(bpe.bpe_encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()
    assert sorted(bytes(r.decoded) for r in apart) == sorted((t or "").encode() for _, t, _ in rows)
    assert bpe.bpe_round_trip(df.limit(0), PATH, public_tokenizers.PATTERN).count() == 0
