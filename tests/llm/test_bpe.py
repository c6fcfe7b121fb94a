import base64
import hashlib
import random

import pytest
import public_tokenizers
import tiktoken

from voxlens.llm.bpe import BytePairEncoder, encode_texts, parse_ranks, read_ranks
from voxlens.llm.pretokens import GENERAL, Splitter
from voxlens.llm.q_bpe import RANKS


@pytest.fixture(scope="module")
def ranks():
    return parse_ranks(read_ranks(RANKS))


@pytest.fixture(scope="module")
def public(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_pattern_is_the_public_one():
    assert GENERAL == public_tokenizers.PATTERN


def test_same_ids(spark, sf, texts, public):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), texts):
        want = []
        for r in docs.collect():
            ids = public.encode_ordinary(r.text or "")
            want.append((r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                         hashlib.sha256((r.text or "").encode()).hexdigest(), ids))
        got = [tuple(r) for r in encode_texts(spark, docs, RANKS).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    assert encode_texts(spark, texts.limit(0), RANKS).count() == 0


def test_pieces_of_random_bytes(ranks, public):
    draw, bpe = random.Random(1), BytePairEncoder(ranks)
    pieces = ["".join(draw.choice("abcdeé漢 1") for _ in range(draw.randint(0, 40))) for _ in range(3000)]
    pieces += ["a" * 20000, "ab" * 20000, "".join(draw.choice("abcdefgh") for _ in range(50000))]
    got = bpe.encode_all([p.encode() for p in pieces])
    assert got == [tuple(public._core_bpe.encode_single_piece(p.encode())) if p else () for p in pieces]
    assert all(bpe.decode(ids) == p.encode() for p, ids in zip(pieces, got))


def test_a_lower_rank_that_comes_up_late_goes_first():
    # "bc" is worth less than "ab", but "abc" is worth more than both.
    ranks = {bytes([b]): 1000 + b for b in range(256)} | {b"ab": 20, b"abc": 5, b"abcab": 1}
    public = tiktoken.Encoding("own", pat_str=r".+", mergeable_ranks=ranks, special_tokens={})
    bpe = BytePairEncoder(ranks)
    for text in ("abcab", "abcabcab", "aabcabbc", "abab", "cabcabcabab"):
        assert list(bpe.encode(text.encode())) == public.encode_ordinary(text)


def test_splitting_of_latin_texts():
    import regex

    draw, split = random.Random(2), Splitter()
    for _ in range(3000):
        text = "".join(chr(draw.randrange(256)) for _ in range(draw.randint(0, 30)))
        assert split(text) == regex.findall(public_tokenizers.PATTERN, text)


def test_size_of_rank_file_is_checked(tmp_path, monkeypatch):
    from voxlens.llm import bpe

    path = tmp_path / "r"
    path.write_bytes(base64.b64encode(b"a") + b" 0\n")
    assert parse_ranks(read_ranks(str(path))) == {b"a": 0}
    monkeypatch.setattr(bpe, "RANK_FILE_BYTES", 3)
    with pytest.raises(ValueError):
        read_ranks(str(path))
