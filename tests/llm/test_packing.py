import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from voxlens.llm.packing import assign, pack
from voxlens.llm.q_packing import TOKENIZER


def check(spark, docs, least_fill, capacity=1024, **options):
    tokenizer = Tokenizer.from_file(TOKENIZER)
    want = defaultdict(list)
    for r in docs.collect():
        want[r.doc_id].append(np.array(tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4"))
    pieces = pack(spark, docs, TOKENIZER, capacity, **options).collect()
    places, of_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        places[p.sequence_id].append((p.offset, p.length))
        of_doc[p.doc_id].append(p)
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    assert of_doc.keys() == want.keys()
    for i, rows in of_doc.items():
        if len(want[i]) > 1:  # rows that repeat an id: the pieces of all of them together
            assert sum(p.length for p in rows) == sum(map(len, want[i]))
            continue
        at, ids = 0, want[i][0]
        for p in sorted(rows, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            at += p.length
            assert p.ids_crc32 == zlib.crc32(ids[p.start : at].tobytes())
        assert at == len(ids)
    assert sum(p.length for p in pieces) >= least_fill * capacity * len(places)


def test_whole_table(spark, sf):
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"), 0.99)


def test_small_groups_and_capacity(spark, sf):
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"), 0.9, capacity=64, docs_per_group=16)


def test_odd_texts(spark, texts):
    check(spark, texts, 0.5)
    special = spark.createDataFrame([(1, "a <|endoftext|> b"), (2, None)], "doc_id bigint, text string")
    check(spark, special, 0.0)
    assert pack(spark, texts.limit(0), TOKENIZER).count() == 0


def test_least_cost_first():
    lengths = np.array([600, 500, 400, 300, 200, 48])
    found = assign(lengths, 1024)
    assert [f[0] for f in found[:2]] == [0, 1] and found[0][3] != found[1][3]
    load = defaultdict(int)
    for _, _, length, sequence in found:
        load[sequence] += length
    assert sorted(load.values()) == [1024, 1024]


TEXTS = [
    "", " ", "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>x", " <|endoftext| >", "it's  two\n\n lines\t ",
    "漢字 ünï 😀 x<|pad|>y<|pad|>>z", "<|pad|>ding 123", "ab<x>c <x>  <x> d",
]


def same_ids(data: str):
    from voxlens.llm.packing import _of_text

    tokenizer, encode = Tokenizer.from_str(data), _of_text(data)
    for text in TEXTS:
        assert np.frombuffer(encode(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_added_tokens_get_their_ids():
    import json

    from voxlens.llm.packing import _ranks

    data = json.load(open(TOKENIZER))
    assert len(_ranks(data)) == 50256
    same_ids(json.dumps(data))
    plain = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    data["added_tokens"] += [{"id": 50257 + i, "content": c, **plain} for i, c in enumerate(["<|pad|>", "<|pad|>>", "<x>"])]
    assert _ranks(data) is not None
    same_ids(json.dumps(data))


def test_other_tokenizers_get_whole_texts():
    import json

    from voxlens.llm.packing import _ranks

    def changed(**parts):
        data = json.load(open(TOKENIZER))
        for name, value in parts.items():
            data[name] = value
        assert _ranks(data) is None
        same_ids(json.dumps(data))

    data = json.load(open(TOKENIZER))
    changed(model={**data["model"], "merges": data["model"]["merges"][::-1]})
    changed(pre_tokenizer={**data["pre_tokenizer"], "use_regex": False})
    changed(pre_tokenizer={**data["pre_tokenizer"], "add_prefix_space": True})
    changed(normalizer={"type": "Lowercase"})
    changed(added_tokens=data["added_tokens"] + [
        {"id": 50257, "content": "<x>", "single_word": False, "lstrip": True, "rstrip": True, "normalized": False, "special": True}])
