import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sparkloom.llm import token_counts, token_files
from sparkloom.llm.encoding import Encoder, default_vocabulary, safe_chunks

ODD = ["  a  b\n\n c <|endoftext|> d", "a  b\t\tc \n", "<|endoftext|><|endoftext|> x<|endoftext|>", " ", " \n", "", "a\x1c b\x85 c", "don't 'll  've\r\n\r\nx", "\rfoo", "\nfoo", "日本語 テキスト。 ок"]
DOCS = "doc_id long, text string, n_tokens string, start int"


def plain(texts, literal=False):
    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = literal
    return [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("literal", [False, True])
def test_encoder_gives_what_the_library_gives(literal):
    rng = random.Random(1)
    bits = ["a", "b", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "1", "é", "　", "\x1d", "!", "\xa0", "\r", "Ωx"]
    texts = ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 9))) for _ in range(3000)]
    e = Encoder(default_vocabulary(), literal)
    ids, n = e.encoded(pa.array(texts))
    want = plain(texts, literal)
    assert n.tolist() == [len(x) for x in want] == e.lengths(pa.array(texts)).tolist()
    assert ids.tolist() == [i for x in want for i in x]


def test_safe_chunks_join_to_the_same_ids():
    rng = random.Random(2)
    for _ in range(200):
        t = "".join(rng.choice(["ab", " ", "\n", "  ", "x'll", "9", "."]) for _ in range(30))
        assert "".join(safe_chunks(t, 5)) == t
        assert [i for x in plain(list(safe_chunks(t, 5))) for i in x] == plain([t])[0]


def test_token_counts(spark, monkeypatch):
    long = "word and more. " * 120_000
    rows = [(1, "one two", "x", 1), (1, "one two", "x", 1), (2, None, None, None), (3, "", "y", 2), (None, "null id", "z", 3), (4, long, "l", 4)]
    got = {(r.doc_id, r.n_bytes): r for r in token_counts.token_counts(spark.createDataFrame(rows, DOCS)).collect()}
    assert got[2, 0].n_tokens == got[3, 0].n_tokens == 0
    assert got[1, 7].n_tokens == 2 and got[None, 7].n_tokens == len(plain(["null id"])[0])
    assert got[4, len(long)].n_tokens == len(plain([long])[0]) and got[4, len(long)].over_limit
    assert token_counts.token_counts(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json"])
def test_other_vocabularies(spark, name):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path(name)
    texts = ["Hello there, world.", "", "  two  spaces ", "été"]
    got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path).collect()}
    if name.endswith(".model"):
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        want = [len(sp.encode(t)) for t in texts]
    else:
        t = Tokenizer.from_file(path)
        want = [len(t.encode(x, add_special_tokens=False).ids) for x in texts]
    assert [got[i] for i in range(len(texts))] == want


def test_file_round_trip():
    rng = np.random.default_rng(3)
    for n in (0, 1, 127, 128, 129, 5000):
        for top in (1, 2, 300, 50257, 2**32 - 1):
            ids = rng.integers(0, top, n, dtype=np.uint32, endpoint=True)
            ids[rng.random(n) < 0.03] = 2**32 - 1
            ends = np.unique(rng.integers(0, n + 1, 5)) if n else np.array([0])
            names = [int(x) if x % 2 else None for x in ends]
            a, b, c = token_files.unpacked(token_files.packed(ids, ends, names))
            assert a.tolist() == ids.tolist() and b.tolist() == ends.tolist() and c == names


def test_block_width_follows_the_percentile():
    ids = np.full(128, 7, np.uint32)
    ids[3], ids[9] = 7 + 1000, 7 + 3
    small = token_files.packed(ids, np.array([128]), [1])
    assert len(small) < len(token_files.packed(np.arange(128, dtype=np.uint32), np.array([128]), [1]))
    with pytest.raises(ValueError):
        token_files.unpacked(b"XXXX" + small[4:])


def test_token_files(spark):
    rng = random.Random(4)
    rows = [(i * 7 % 50, " ".join(rng.choice(["alpha", "beta", "x!", "ñ"]) for _ in range(rng.randint(0, 40))), None, 1) for i in range(50)] + [(3, None, None, None), (3, "", None, None), (None, "no id", None, None)]
    files = token_files.write_token_files(spark.createDataFrame(rows, DOCS), ids_per_file=200)
    assert files.count() > 3
    got = sorted(token_files.read_token_files(files).collect(), key=lambda r: r.start)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert [r.doc_id for r in got] == [r[0] for r in order]
    at = 0
    for r, (_, text, *_) in zip(got, order):
        ids = [*plain([text or ""])[0], 0]
        assert (r.start, r.n_tokens) == (at, len(ids))
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert token_files.token_files(spark.createDataFrame([], DOCS)).count() == 0
