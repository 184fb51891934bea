"""Token files and BPE against the library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from weftline.llm import bpe, tokenfile
from weftline.llm.text import Table

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", "a", "  a  b\n\n c \t\n d", " \x1c a\x1fb  ", "don't I'll 's  ’s x. Y,. Z.,.", "<|endoftext|>", "A <|endoftext|>.  b<|startoftext|>\n", "É" * 300 + "日本語 テスト   " + "x" * 500,
    "12345 67.8 $$$ ...  　 a​b", "ΑΣ. Σ İx, ǅ éa ÉA. ́x", "a\r\n\r\nb\u0085c ª º ÷ ×", " \n \n a", "👩‍👩‍👧 emoji", "<|ENDOFTEXT|> x",
]


@pytest.fixture(scope="module")
def libraries():
    return Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def codecs():
    return bpe.Codec(BYTES), tokenfile.Encoder(WORDS)


def ids(b):
    return np.frombuffer(b, "<u4").tolist()


@pytest.mark.parametrize("text", ODD)
def test_odd_texts(text, libraries, codecs):
    want = libraries[0].encode(text, add_special_tokens=False).ids
    got, decimals = codecs[0].encode([text])[0]
    assert ids(got) == want and decimals == ",".join(map(str, want)).encode()
    assert codecs[0].decode(got) == libraries[0].decode(want, skip_special_tokens=False)
    assert ids(codecs[1].encode([text])[0]) == libraries[1].encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("aAbé ÉßĳΣσ.,'\n\t \x1c1٣$-<|> ́")), max_size=40))
def test_any_texts(text):
    a, b = test_any_texts.made = getattr(test_any_texts, "made", None) or (bpe.Codec(BYTES), tokenfile.Encoder(WORDS))
    x, y = test_any_texts.libs = getattr(test_any_texts, "libs", None) or (Tokenizer.from_file(BYTES), Tokenizer.from_file(WORDS))
    assert ids(a.encode([text])[0][0]) == x.encode(text, add_special_tokens=False).ids
    assert ids(b.encode([text])[0]) == y.encode(text, add_special_tokens=False).ids


def test_long_words_and_short_ones_agree(codecs):
    rng = random.Random(1)
    for _ in range(100):
        word = "".join(rng.choices("abcdefgh", k=rng.randint(1, 64))).encode()
        assert codecs[0]._long(word).tolist() == codecs[0]._together([word])[0].tolist()


def test_table_is_bounded_and_right():
    rng = np.random.default_rng(5)
    table = Table(lambda keys: [np.arange(k, k + k % 7, dtype=np.uint32) for k in keys], 4000)
    for _ in range(60):
        keys = rng.integers(0, 2000, 150).astype(np.uint64)
        got, sizes = table.over(keys, lambda some, keys=keys: keys[some].tolist())
        assert sizes.tolist() == [k % 7 for k in keys.tolist()]
        assert got.tolist() == [x for k in keys.tolist() for x in range(k, k + k % 7)]
        assert table.flat.nbytes + 24 * len(table.names) <= 4000 + 150 * 48


def test_token_file_reads_any_place():
    rng = random.Random(2)
    for _ in range(60):
        sizes = [rng.randint(0, 40) for _ in range(rng.randint(1, 60))]
        values = np.array([rng.choice([rng.randrange(256), rng.randrange(65536), rng.randrange(1 << 32)]) for _ in range(sum(sizes))], np.uint32)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        file = tokenfile.TokenFile(tokenfile.pack(values, starts, [None if i % 7 == 3 else i for i in range(len(sizes))]))
        assert [file.token(i) for i in range(len(values))] == values.tolist()
        assert all((file.document(k) == values[starts[k] : starts[k + 1]]).all() for k in range(len(sizes)))
        assert file.names == [None if i % 7 == 3 else i for i in range(len(sizes))]
    with pytest.raises(IndexError):
        file.token(len(values))
    with pytest.raises(ValueError):
        tokenfile.TokenFile(b"x" * 40)


def test_queries(spark, monkeypatch, libraries):
    monkeypatch.setattr(tokenfile, "FILE_TOKENS", 40)
    rows = [(i * 7 % 31, t) for i, t in enumerate(ODD)] + [(None, "null id"), (50, None), (3, "tie"), (3, "tie")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit(1)).withColumn("n_tokens", F.lit(2))
    want = sorted(str((d, len(e), hashlib.sha256(",".join(map(str, e)).encode()).hexdigest(), hashlib.sha256(libraries[0].decode(e, skip_special_tokens=False).encode()).hexdigest())) for d, t in rows for e in [libraries[0].encode(t or "", add_special_tokens=False).ids])
    assert sorted(str(tuple(r)) for r in bpe.digest(df, BYTES).collect()) == want
    back = bpe.decode(bpe.encode(df, BYTES), BYTES).select("text", "decoded").collect()
    assert all(r["decoded"] == (r["text"] or "") for r in back)
    got = sorted((tuple(r) for r in tokenfile.digest(df, WORDS).collect()), key=lambda r: r[1])
    order = df.select("doc_id", "text").orderBy("doc_id", F.xxhash64("text")).collect()
    start = 0
    for (d, s, n, c), r in zip(got, order, strict=True):
        e = libraries[1].encode(r["text"] or "", add_special_tokens=False).ids + [1]
        assert (d, s, n, c) == (r["doc_id"], start, len(e), zlib.crc32(np.array(e, "<u4").tobytes()))
        start += n
    assert tokenfile.digest(df.filter("false"), WORDS).count() == 0 and bpe.digest(df.filter("false"), BYTES).count() == 0
