"""Cost-balanced packing of tokenized documents into sequences of a fixed capacity.

The cost of a piece of n tokens is estimated as linear plus quadratic attention cost. Pieces
go in descending order of cost to the sequence of least cost that has room for them. A full
window of a long document is a sequence of its own; a piece that no sequence has room for is
cut over the ones with the most room, so all sequences of a group but for less than one
capacity are filled.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from struct import pack as pack_ids

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.llm.pretokens import GENERAL, PieceCache, Splitter, worker_cache

#: Most bytes of a tokenizer file: it is read by the driver and sent to the executors whole.
TOKENIZER_BYTES = 64 << 20
#: Documents whose pieces are packed together. A group's ids are at most
#: DOCS_PER_GROUP * capacity, as full windows carry none.
DOCS_PER_GROUP = 2048
#: Tokens at which the quadratic part of the cost equals the linear part.
EVEN_COST_AT = 6144
#: Pre-tokens whose ids a worker keeps (about 30 MB).
CACHED = 1 << 17
#: Documents of one Arrow batch of pieces.
ROWS = 512


def read_tokenizer(path: str) -> str:
    with open(path, "rb") as f:
        data = f.read(TOKENIZER_BYTES + 1)
    if len(data) > TOKENIZER_BYTES:
        raise ValueError(f"{path} is larger than {TOKENIZER_BYTES} bytes")
    return data.decode()


def _ranks(tokenizer: dict) -> dict[bytes, int] | None:
    """Token bytes and ids of a byte-level BPE that splits by the usual pattern and whose ids
    follow the order of its merges, so that ids can serve as ranks; null for any other tokenizer."""
    model, before = tokenizer["model"], tokenizer.get("pre_tokenizer") or {}
    plain = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space")
    if not plain or model.get("type") != "BPE" or any(tokenizer.get(k) for k in ("normalizer", "truncation", "padding")):
        return None
    if any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix", "ignore_merges", "dropout")):
        return None
    if any(t.get(k) for t in tokenizer.get("added_tokens") or () for k in ("single_word", "lstrip", "rstrip")):
        return None
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    merged = [vocab[a + b] for a, b in pairs]
    if merged != sorted(merged):
        return None
    # The letters that stand for bytes in such files: printable ones for themselves, the others from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    byte_of = {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}
    made = {*byte_of, *(a + b for a, b in pairs)}
    return {bytes(map(byte_of.__getitem__, token)): i for token, i in vocab.items() if token in made}


def _of_text(data: str):
    """Ids of a text as little-endian unsigned 32-bit numbers, those that the file's tokenizer
    gives without special tokens of its own: strings of added tokens in a text get their ids.

    Where ids are ranks, a text is cut at the added tokens (the longest of those that begin at
    the same place) and into pre-tokens, and the merges of the same file are applied by a leaner
    library, once per pre-token. Other tokenizers get whole texts.
    """
    tokenizer = json.loads(data)
    ranks = _ranks(tokenizer)
    if ranks is None:
        from tokenizers import Tokenizer

        whole = Tokenizer.from_str(data)

        def encode_whole(text: str) -> bytes:
            ids = whole.encode(text, add_special_tokens=False).ids
            return pack_ids("<%dI" % len(ids), *ids)
        return encode_whole

    import tiktoken

    encode = tiktoken.Encoding("own", pat_str=GENERAL, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def made(piece: str) -> bytes:
        ids = encode(piece)
        return pack_ids("<%dI" % len(ids), *ids)

    ids_of, split = PieceCache(made, CACHED).__getitem__, Splitter()
    added = {t["content"]: pack_ids("<I", t["id"]) for t in tokenizer.get("added_tokens") or () if t["content"]}
    if not added:
        return lambda text: b"".join(map(ids_of, split(text)))
    cuts = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")

    def encode_text(text: str) -> bytes:
        parts = cuts.split(text)  # text, added token, text, ...
        return b"".join(added[part] if i % 2 else b"".join(map(ids_of, split(part))) for i, part in enumerate(parts))
    return encode_text


def _pieces(data, name: str, capacity: int, end_id: int):
    """Windows of ``capacity`` tokens, with their checksum, and the rest of each document
    with its ids."""
    def run(batches):
        made = worker_cache(f"tokenizer-{name}")
        if not made:
            made["encode"] = _of_text(data.value)
        encode = made["encode"]
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                rows = []
                for key, text in zip(batch.column(0).slice(at, ROWS), batch.column(1).slice(at, ROWS)):
                    key = key.as_py()
                    ids = np.frombuffer(encode(text.as_py() or "") + end, "<u4")
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity]
                        full = len(piece) == capacity
                        rows.append((key, start, len(piece), zlib.crc32(piece.tobytes()), len(ids),
                                     None if full else piece.tobytes()))
                columns = list(zip(*rows))
                kinds = [batch.schema.field(0).type, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["id", "start", "length", "crc", "tokens", "ids"],
                )
    return run


def assign(lengths: np.ndarray, capacity: int, even_at: int = EVEN_COST_AT) -> list[tuple[int, int, int, int]]:
    """(piece, from, length, sequence) for pieces given in descending length: the balanced
    assignment of one group, offsets follow from the order."""
    count = -(-int(lengths.sum()) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity, np.int64)
    out = []
    for piece, length in enumerate(lengths.tolist()):
        start = 0
        while length:
            fits = np.flatnonzero(room >= length)
            at = int(fits[np.argmin(cost[fits])]) if len(fits) else int(np.argmax(room))
            take = min(length, int(room[at]))
            out.append((piece, start, take, at))
            cost[at] += take * (1 + take / even_at)
            room[at] -= take
            start, length = start + take, length - take
    return out


def _pack(capacity: int, even_at: int, kind: str):
    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "id", "start"], ascending=[False, True, True], kind="stable")
        whole = rows[rows["length"] == capacity]
        parts = rows[rows["length"] < capacity]
        found = assign(parts["length"].to_numpy(np.int64), capacity, even_at)
        base = int(key[0]) << 32
        filled: dict[int, int] = {}
        out = []
        ids, starts, tokens, raw, sums = (parts[c].tolist() for c in ("id", "start", "tokens", "ids", "crc"))
        for piece, start, length, sequence in found:
            offset = filled.get(sequence, 0)
            filled[sequence] = offset + length
            data = raw[piece]
            crc = sums[piece] if 4 * length == len(data) else zlib.crc32(data[4 * start : 4 * (start + length)])
            out.append((ids[piece], starts[piece] + start, length, crc, tokens[piece], base + sequence, offset))
        first = base + len(filled)
        out.extend(
            (i, s, n, c, t, first + at, 0)
            for at, (i, s, n, c, t) in enumerate(zip(*(whole[c].tolist() for c in ("id", "start", "length", "crc", "tokens"))))
        )
        made = pd.DataFrame(out, columns=["id", "start", "length", "crc", "tokens", "sequence_id", "offset"])
        return made.astype({"id": "Int64"}) if kind in ("bigint", "int") else made
    return run


def pack(spark: SparkSession, docs: DataFrame, tokenizer_path: str, capacity: int = 1024, end_id: int = 0,
         id_col: str = "doc_id", text_col: str = "text", docs_per_group: int = DOCS_PER_GROUP,
         even_at: int = EVEN_COST_AT) -> DataFrame:
    """Pieces of the documents and their places: the id, ``start`` (tokens of the document
    before the piece), ``length``, ``ids_crc32`` (of little-endian unsigned 32-bit ids),
    ``doc_tokens``, ``sequence_id`` and ``offset`` (in the sequence, without gaps).

    A document is the ids of its text and ``end_id``; a null or empty text is ``end_id``
    alone. Rows with a null id and repeated rows are documents of their own. Other columns
    are not read. No rows give no pieces.

    Pieces are dealt into groups by hash, one group for every ``docs_per_group`` rows, so
    a group stays of one size however large the table or a document is. Each group leaves
    less than one capacity unfilled.
    """
    tokenizer = read_tokenizer(tokenizer_path)
    data, name = spark.sparkContext.broadcast(tokenizer), hashlib.sha256(tokenizer.encode()).hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()
    cut = docs.select(id_col, text_col).mapInArrow(
        _pieces(data, name, capacity, end_id),
        f"id {kind}, start bigint, length bigint, crc bigint, tokens bigint, ids binary",
    )
    groups = max(1, -(-docs.count() // docs_per_group))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("id", "start", "crc"), F.lit(groups)))
    packed = dealt.groupBy("group").applyInPandas(
        _pack(capacity, even_at, kind),
        f"id {kind}, start bigint, length bigint, crc bigint, tokens bigint, sequence_id bigint, offset bigint",
    )
    return packed.select(
        F.col("id").alias(id_col), "start", "length", F.col("crc").alias("ids_crc32"),
        F.col("tokens").alias("doc_tokens"), "sequence_id", "offset",
    )
