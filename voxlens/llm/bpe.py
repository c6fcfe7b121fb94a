"""Byte-level BPE by a rank queue with a hierarchical bitmap.

Every merge rank has a bucket of positions in a linked list of parts. A bitmap whose words
stand for words of the level below tells by find-first-set which rank is next. Entries are
never removed when a neighbour merges: an entry whose position is gone or has another rank by
now is stale and skipped. A pre-token of n bytes takes O(n log n) steps, whatever its length,
and many short ones share one run of the queue.
"""

from __future__ import annotations

import base64
import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from voxlens.llm.pretokens import CACHE_ENTRIES, Splitter, worker_cache

#: Most bytes of a rank file: it is read by the driver and sent to the executors whole.
RANK_FILE_BYTES = 64 << 20
#: Characters that are split and looked up together.
RUN_CHARS = 4 << 20
#: Pre-tokens that share one run of the queue.
PIECES = 1 << 14


def read_ranks(path: str) -> bytes:
    """The rank file (base64 token, rank per line), with its size checked."""
    with open(path, "rb") as f:
        data = f.read(RANK_FILE_BYTES + 1)
    if len(data) > RANK_FILE_BYTES:
        raise ValueError(f"{path} is larger than {RANK_FILE_BYTES} bytes")
    return data


def parse_ranks(data: bytes) -> dict[bytes, int]:
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


class RankQueue:
    """Buckets of positions per rank; the least rank that has one is found by the bitmap.
    Words of 256 bits make two levels of a vocabulary of 2^16 ranks."""

    BITS = 8

    def __init__(self, size: int):
        self.buckets: dict[int, list[int]] = {}
        self.levels: list[list[int]] = []
        while True:
            size = (size + (1 << self.BITS) - 1) >> self.BITS
            self.levels.append([0] * size)
            if size <= 1:
                break

    def push(self, rank: int, position: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.put(rank, [position])
        else:
            bucket.append(position)

    def put(self, rank: int, positions: list[int]) -> None:
        """A whole bucket for a rank that has none."""
        self.buckets[rank] = positions
        for level in self.levels:
            level[rank >> self.BITS] |= 1 << (rank & ((1 << self.BITS) - 1))
            rank >>= self.BITS

    def pop(self) -> tuple[int, list[int]] | None:
        """The least rank and its positions, leftmost first."""
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            if not word:
                return None
            rank = (rank << self.BITS) | ((word & -word).bit_length() - 1)
        positions, at = self.buckets.pop(rank), rank
        for level in self.levels:
            level[at >> self.BITS] &= ~(1 << (at & ((1 << self.BITS) - 1)))
            at >>= self.BITS
            if level[at]:
                break
        positions.sort()
        return rank, positions


class BytePairEncoder:
    """Encodes pre-tokens by ranks and decodes ids; the id of a token is its rank."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.queue = RankQueue(max(ranks.values(), default=0) + 1)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.double = np.full(1 << 16, -1, np.int64)
        for token, rank in ranks.items():
            if len(token) == 2:
                self.double[token[0] << 8 | token[1]] = rank

    def encode(self, piece: bytes) -> tuple[int, ...]:
        return self.encode_all([piece])[0]

    def encode_all(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Ids of each pre-token. All of them share one linked list and one queue; nothing
        merges across the places where one ends."""
        whole = [self.ranks.get(p) for p in pieces]
        rest = [p for p, rank in zip(pieces, whole) if rank is None]
        runs = (rest[at : at + PIECES] for at in range(0, len(rest), PIECES))
        parts = chain.from_iterable(map(self._merge, runs))
        return [next(parts) if rank is None else (rank,) for rank in whole]

    def _merge(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        text, queue, rank_of = b"".join(pieces), self.queue, self.ranks.get
        buckets, put = queue.buckets, queue.put
        if not text:
            return [()] * len(pieces)
        n = len(text)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        stops = np.cumsum(sizes)
        first = np.zeros(n + 1, np.uint8)
        first[stops] = first[0] = 1
        raw = np.frombuffer(text, np.uint8).astype(np.int64)
        token = self.single[raw].tolist()  # id of the part that starts here
        start = np.full(n, -1, np.int64)
        start[:-1] = self.double[raw[:-1] << 8 | raw[1:]]
        start[first[1:] == 1] = -1
        order = np.argsort(start, kind="stable")
        order = order[np.searchsorted(start[order], 0) :]
        if len(order):
            found = start[order]
            cuts = np.flatnonzero(np.diff(found)) + 1
            for rank, places in zip(found[np.r_[0, cuts]].tolist(), np.split(order, cuts)):
                queue.put(rank, places.tolist())
        first, pair = bytes(first), start.tolist()  # pair: rank of this part with the next
        end, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of parts that still exist
        while (top := queue.pop()) is not None:
            rank, places = top
            for k, i in enumerate(places):
                if pair[i] != rank:  # stale: merged away, or another neighbour by now
                    continue
                gone, low = end[i], rank
                stop = end[i] = end[gone]
                token[i], pair[gone], pair[i] = rank, -1, -1
                if not first[stop]:
                    before[stop] = i
                    new = rank_of(text[i : end[stop]])
                    if new is not None:
                        pair[i] = low = new
                        if new in buckets:
                            buckets[new].append(i)
                        else:
                            put(new, [i])
                if not first[i]:
                    left = before[i]
                    new = rank_of(text[left:stop])
                    if new is None:
                        pair[left] = -1
                    else:
                        pair[left] = new
                        if new in buckets:
                            buckets[new].append(left)
                        else:
                            put(new, [left])
                        if new < low:
                            low = new
                if low < rank:  # an earlier rank has come up: it goes first, the others wait
                    for j in places[k + 1 :]:
                        queue.push(rank, j)
                    break
        out, i = [], 0
        for stop in stops.tolist():
            ids = []
            while i < stop:
                ids.append(token[i])
                i = end[i]
            out.append(tuple(ids))
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class TextEncoder:
    """Whole texts: a pre-token is encoded once per worker and then looked up. ``of_pieces``
    gives what is kept of each of a list of pre-tokens, such as its ids."""

    def __init__(self, name: str, of_pieces):
        self.of_pieces, self.cache, self.split = of_pieces, worker_cache(f"ids-{name}"), Splitter()

    def look_up(self, texts: list[str]) -> list[list]:
        """Per text what is kept of its pre-tokens."""
        cut = [self.split(text) for text in texts]
        cache, seen = self.cache, set().union(*cut)
        missing = [p for p in seen if p not in cache]
        if len(cache) + len(missing) > CACHE_ENTRIES:
            cache.clear()
            missing = list(seen)
        cache.update(zip(missing, self.of_pieces(missing)))
        return [list(map(cache.__getitem__, pieces)) for pieces in cut]


def text_runs(texts, chars: int = RUN_CHARS):
    """(start, texts) runs of an Arrow column of at most ``chars`` characters or one text."""
    run, size, start = [], 0, 0
    for at in range(len(texts)):
        text = texts[at].as_py() or ""
        if run and size + len(text) > chars:
            yield start, run
            run, size, start = [], 0, at
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def _tasks(data, name: str, with_ids: bool):
    def run(batches):
        made = worker_cache(f"bpe-{name}")
        if not made:
            made["bpe"] = BytePairEncoder(parse_ranks(data.value))
        bpe = made["bpe"]

        def of_pieces(pieces):
            found = bpe.encode_all([p.encode() for p in pieces])
            return [(len(ids), ",".join(map(str, ids)), bpe.decode(ids), ids if with_ids else None) for ids in found]

        encoder = TextEncoder(f"bpe-{name}-{with_ids}", of_pieces)
        for batch in batches:
            keys = batch.column(0)
            for at, texts in text_runs(batch.column(1)):
                counts, id_sums, text_sums, lists = [], [], [], []
                for parts in encoder.look_up(texts):
                    sizes, texts_of_ids, decoded, ids = zip(*parts) if parts else ((), (), (), ())
                    counts.append(sum(sizes))
                    id_sums.append(hashlib.sha256(",".join(texts_of_ids).encode()).hexdigest())
                    text_sums.append(hashlib.sha256(b"".join(decoded)).hexdigest())
                    if with_ids:
                        lists.append(list(chain.from_iterable(ids)))
                columns = {"id": keys.slice(at, len(texts)), "n_tokens": pa.array(counts, pa.int64()),
                           "ids_sha256": pa.array(id_sums, pa.string()),
                           "decoded_sha256": pa.array(text_sums, pa.string())}
                if with_ids:
                    columns["ids"] = pa.array(lists, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_pydict(columns)
    return run


def encode_texts(spark: SparkSession, docs: DataFrame, ranks_path: str, id_col: str = "doc_id",
                 text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Per row of ``docs``: the id, ``n_tokens``, ``ids_sha256`` (of the decimal ids joined by
    commas), ``decoded_sha256`` (of the bytes that the ids decode to) and, if asked for, ``ids``.

    A null text is the empty text, which has no ids. Rows with a null id, repeated rows and
    other columns are no special case: each row is encoded on its own. Only the two columns
    are read. The rank file (size checked) is sent to the executors once.
    """
    ranks = read_ranks(ranks_path)
    data, name = spark.sparkContext.broadcast(ranks), hashlib.sha256(ranks).hexdigest()
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    out = docs.select(id_col, text_col).mapInArrow(
        _tasks(data, name, with_ids), schema + (", ids array<int>" if with_ids else "")
    )
    return out.withColumnRenamed("id", id_col)
