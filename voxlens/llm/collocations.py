"""Phrase collocations by stripes: each prefix keys a counter of its next words.

The map side cuts runs of text into words and gives one stripe per prefix and run: the next
words and how often each follows. Stripes are shuffled by prefix and merged element by element.
All facts come from the merged stripes: the extensions of a prefix are its counters, the total
of a prefix is its own counter in the stripe of its words but the last (that of the empty prefix
for one word), and a counter is also the count by which the extension may subsume its prefix
and its last words.

A phrase can only be frequent if all its parts are. So words are counted first; then pairs of
frequent words and triples of frequent pairs are counted by 64-bit hash alone, never too low,
and give filters of what may be frequent. Only counters that pass them are carried in stripes
and shuffled as text. A filter has at most FILTER_BITS bits; a crowded one, or two phrases of
one hash, let more through, which the exact counts then drop.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.llm.groups import join_salted
from voxlens.llm.shingles import byte_runs, mix, word_hashes
from voxlens.llm.spans import byte_set, lowered, owners, words
from voxlens.operators.ranking import top_per_group
from voxlens.session import stage

MIN_COUNT = 30
#: A longer phrase subsumes a part of it at this share of its count, in hundredths.
SUBSUMED = 80
TOP = 2000
#: Bits of the filter per frequent phrase, and at most (32 MB).
BITS_PER_PHRASE = 16
FILTER_BITS = 1 << 28
#: Prefixes with more than this share of all words (fewer than 2,000 by construction) have
#: their stripes split by next word.
HOT_SHARE = 0.0005
SHARDS = 64
#: Bytes of text whose stripes are combined before they move (or one text, if longer).
RUN_BYTES = 4 << 20

_BREAKS = byte_set(*b".,;:!?", range(0x0A, 0x0E))
_CUTS = _BREAKS | byte_set(0x20, 0x09)
_U = np.uint64
_STEP = _U(0xD1342543DE82EF95)
STRIPES = "lang string, prefix string, level int, shard int, next array<string>, n array<bigint>"


def _lang_hash(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def _joined(head: np.ndarray, tail: np.ndarray) -> np.ndarray:
    """Hash of a phrase and a further word, from their hashes."""
    return mix(head * _STEP + tail)


def _hashes(array: pa.StringArray) -> np.ndarray:
    """Hash of every word of an array of words."""
    if not len(array):
        return np.zeros(0, _U)
    offsets = np.frombuffer(array.buffers()[1], np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(array.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return word_hashes(data, offsets - offsets[0])[0]


class Filter:
    """Bits of two places per hash; the size is a power of two."""

    def __init__(self, slots: np.ndarray):
        self.slots = slots

    @staticmethod
    def places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        low = _U(bits - 1)
        return hashes & low, (hashes >> _U(32)) & low

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), bool)
        for place in self.places(hashes, len(self.slots) * 64):
            found &= (self.slots[(place >> _U(6)).astype(np.int64)] >> (place & _U(63))) & _U(1) == 1
        return found


def filter_of(hashes: DataFrame, bits: int | None = None) -> Filter:
    """Filter of a table with a column ``hash``. At most FILTER_BITS / 64 words come to the driver."""
    if bits is None:
        bits = min(FILTER_BITS, 1 << max(20, (BITS_PER_PHRASE * hashes.count() - 1).bit_length()))
    low = F.lit(bits - 1)
    places = F.array(F.col("hash").bitwiseAND(low), F.shiftrightunsigned("hash", 32).bitwiseAND(low))
    marked = hashes.select(F.explode(places).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place & 63 as int))")
    found = marked.groupBy(F.shiftright("place", 6).alias("slot")).agg(F.bit_or(bit).alias("bits")).toArrow()
    slots = np.zeros(bits // 64, _U)
    slots[found["slot"].to_numpy()] = found["bits"].to_numpy().view(_U)
    return Filter(slots)


class _Run:
    """The words of a run of texts: language, number in the run's dictionary, piece."""

    def __init__(self, langs: pa.Array, data: np.ndarray, bounds: np.ndarray):
        starts, found = words(lowered(data), bounds, _CUTS)
        of_text = langs.dictionary_encode()
        self.langs = of_text.dictionary
        self.words, self.word = found.dictionary, found.indices.to_numpy().astype(np.int64)
        owner = owners(bounds, starts)
        # Breaks before a word and texts before it: both only grow, so equal sums are one piece.
        piece = np.cumsum(_BREAKS[data])[starts] + owner if len(starts) else np.zeros(0, np.int64)
        self.pairs = piece[1:] == piece[:-1]
        self.size = len(self.words)
        lang = of_text.indices.to_numpy()[owner].astype(np.int64)
        self.heads, self.head = np.unique(lang * max(1, self.size) + self.word, return_inverse=True)
        self.word_hash = _hashes(self.words)
        lang_hash = np.array([_lang_hash(x) for x in self.langs.to_pylist()], _U)
        self.head_hash = _joined(lang_hash[self.heads // max(1, self.size)], self.word_hash[self.heads % max(1, self.size)])

    def pair_hash(self) -> np.ndarray:
        """Hash of every word and the next one."""
        return _joined(self.head_hash[self.head[:-1]], self.word_hash[self.word[1:]])

    def stripes(self, level: int, at: np.ndarray, prefix: np.ndarray, following: np.ndarray, shard: np.ndarray) -> pa.RecordBatch:
        """``at``: first word of each occurrence; ``prefix``: number of its prefix; ``following``:
        its next word, -1 for all of them; ``shard``: the part of the stripe."""
        shards = int(shard.max(initial=0)) + 1
        width = self.size + 1
        key = (prefix * shards + shard) * width + following + 1
        cell, where, count = np.unique(key, return_index=True, return_counts=True)
        stripe = cell // width
        begins = np.flatnonzero(np.r_[True, stripe[1:] != stripe[:-1]]) if len(cell) else np.zeros(0, np.int64)
        offsets = pa.array(np.r_[begins, len(cell)].astype(np.int32))
        first = at[where[begins]]
        code = cell % width
        following = self.words.take(pa.array(code - 1, mask=code == 0))
        parts = [self.words.take(pa.array(self.word[first + k])) for k in range(level)]
        text = pc.binary_join_element_wise(*parts, " ") if level > 1 else parts[0] if level else pa.array([""] * len(first))
        lang = self.langs.take(pa.array(self.heads[self.head[first]] // max(1, self.size)))
        return pa.RecordBatch.from_arrays([
            lang, text, pa.array(np.full(len(first), level, np.int32)), pa.array((stripe[begins] % shards).astype(np.int32)),
            pa.ListArray.from_arrays(offsets, following), pa.ListArray.from_arrays(offsets, pa.array(count, pa.int64())),
        ], names=["lang", "prefix", "level", "shard", "next", "n"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[_Run]:
    for batch in batches:
        for at, data, bounds in byte_runs(batch.column(1), RUN_BYTES):
            run = _Run(batch.column(0).slice(at, len(bounds) - 1), data, bounds)
            if len(run.word):
                yield run


def _word_stripes(shards: int):
    """The stripe of the empty prefix, in shards; next word null counts all words."""
    def run(batches):
        for r in _runs(batches):
            n = len(r.word)
            at = np.tile(np.arange(n), 2)
            following = np.r_[r.word, np.full(n, -1, np.int64)]
            shard = np.r_[(r.word_hash % _U(shards)).astype(np.int64)[r.word], np.zeros(n, np.int64)]
            yield r.stripes(0, at, r.heads[r.head[at]] // r.size, following, shard)
    return run


def _counted(buckets: int, hashes: np.ndarray) -> pa.RecordBatch:
    """Counts of the hashes, in rows by range of the hash."""
    found, count = np.unique(hashes, return_counts=True)
    bucket = ((found >> _U(32)) * _U(buckets)) >> _U(32)
    begins = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(found) else np.zeros(0, np.int64)
    offsets = pa.array(np.r_[begins, len(found)].astype(np.int32))
    return pa.RecordBatch.from_arrays([
        pa.array(bucket[begins].astype(np.int32)), pa.ListArray.from_arrays(offsets, pa.array(found.view(np.int64))),
        pa.ListArray.from_arrays(offsets, pa.array(count.astype(np.int32))),
    ], names=["bucket", "hash", "n"])


def _pair_counts(words_known, buckets: int):
    """Hashed counts of the pairs of words that may both be frequent."""
    def run(batches):
        for r in _runs(batches):
            fine = words_known.value.has(r.head_hash)[r.head]
            at = np.flatnonzero(r.pairs & fine[:-1] & fine[1:])
            yield _counted(buckets, r.pair_hash()[at])
    return run


def _triples(r: _Run, pairs_known: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Flags of the pairs that may be frequent and of the triples of such pairs, by first word,
    and the hashes of the triples."""
    pair_hash, n = r.pair_hash(), len(r.word)
    fine = r.pairs & pairs_known.has(pair_hash)
    both = fine[:-1] & fine[1:]
    return fine, both, _joined(pair_hash[: max(0, n - 2)], r.word_hash[r.word[2:]])


def _triple_counts(pairs_known, buckets: int):
    """Hashed counts of the triples of words whose pairs may both be frequent."""
    def run(batches):
        for r in _runs(batches):
            _, both, triple_hash = _triples(r, pairs_known.value)
            yield _counted(buckets, triple_hash[both])
    return run


def frequent_hashes(counts: DataFrame, min_count: int) -> DataFrame:
    """(hash, n) of the hashes that occur at least ``min_count`` times."""
    placed = counts.repartition("bucket").select("bucket", F.explode(F.arrays_zip("hash", "n")).alias("x"))
    summed = placed.select("bucket", "x.hash", "x.n").groupBy("bucket", "hash").agg(F.sum("n").alias("n"))
    return stage(summed.where(F.col("n") >= min_count).select("hash", "n"), "phrase-hashes")


def _phrase_stripes(pairs_known, triples_known, hot_words: np.ndarray, hot_pairs: np.ndarray):
    """Stripes of prefixes of one to three words, with the next words that may be frequent."""
    def run(batches):
        for r in _runs(batches):
            fine, both, triple_hash = _triples(r, pairs_known.value)
            both &= triples_known.value.has(triple_hash)
            spread = (r.word_hash % _U(SHARDS)).astype(np.int64)
            hot_head = np.isin(r.head_hash, hot_words)[r.head]
            hot_pair = np.isin(r.pair_hash(), hot_pairs)
            at = np.flatnonzero(fine)
            following = r.word[at + 1]
            yield r.stripes(1, at, r.head[at], following, np.where(hot_head[at], spread[following], 0))
            prefix = np.zeros(len(r.word), np.int64)
            prefix[at] = np.unique(r.head[at] * r.size + following, return_inverse=True)[1]
            at = np.flatnonzero(both)
            following = r.word[at + 2]
            yield r.stripes(2, at, prefix[at], following, np.where(hot_pair[at], spread[following], 0))
            longer = np.zeros(len(r.word), np.int64)
            longer[at] = np.unique(prefix[at] * r.size + following, return_inverse=True)[1]
            at = np.flatnonzero(both[:-1] & both[1:])
            following = r.word[at + 3]
            yield r.stripes(3, at, longer[at], following, np.where(hot_pair[at], spread[following], 0))
    return run


def merged(stripes: DataFrame) -> DataFrame:
    """(lang, prefix, level, next, n): stripes merged element by element. They move by prefix
    (and shard), what is merged stays where it is."""
    placed = stripes.repartition("lang", "prefix", "shard")
    cells = placed.select("lang", "prefix", "level", "shard", F.explode(F.arrays_zip("next", "n")).alias("x"))
    cells = cells.select("lang", "prefix", "level", "shard", "x.next", "x.n")
    return cells.groupBy("lang", "prefix", "level", "shard", "next").agg(F.sum("n").alias("n")).drop("shard")


def phrase_facts(cells: DataFrame) -> DataFrame:
    """(lang, phrase, f, cover) from the frequent cells of merged stripes: the count of the phrase
    of prefix and next word, and for what such a phrase may subsume, its count."""
    phrase = F.concat_ws(" ", "prefix", "next")
    tail = F.substring(phrase, F.locate(" ", phrase) + 1, F.length(phrase))
    none = F.lit(None).cast("bigint")

    def fact(text, f, cover):
        return F.struct(text.alias("phrase"), f.alias("f"), cover.alias("cover"))

    shorter = [F.when(F.col("level") > 1, fact(text, none, F.col("n"))) for text in (F.col("prefix"), tail)]
    return cells.select("lang", F.explode(F.array_compact(F.array(fact(phrase, F.col("n"), none), *shorter))).alias("x")).select("lang", "x.*")


def _head_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A column ``hash`` of (lang, phrase) rows of one word."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        of_lang = np.array([_lang_hash(x) for x in langs.dictionary.to_pylist()], _U)
        hashes = _joined(of_lang[langs.indices.to_numpy()], _hashes(batch.column(1))) if batch.num_rows else np.zeros(0, _U)
        yield batch.append_column("hash", pa.array(hashes.view(np.int64)))


def _hot(counted: DataFrame, total: int) -> np.ndarray:
    """Hashes above HOT_SHARE of all words: fewer than 1 / HOT_SHARE."""
    rows = counted.where(F.col("n") > HOT_SHARE * total).select("hash").collect()
    return np.array([r["hash"] for r in rows], np.int64).view(_U)


def mine(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, text_col: str = "text",
         lang_col: str = "lang", filter_bits: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, f, cover) of all phrases of one to four words with at least ``min_count``
    occurrences ``f``; ``cover`` is the largest count of such a phrase of one word more that holds
    it (phrases of two and three words). And (lang, n): words per language.

    A-Z count as a-z. Texts are cut into pieces at ``. , ; : ! ?`` and line breaks, pieces into
    words at spaces and tabs; phrases lie within a piece, overlapping ones count. A null text is
    empty, a null language is ``und``.
    """
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).alias("text"))
    share, buckets = spark.sparkContext.broadcast, int(spark.conf.get("spark.sql.shuffle.partitions"))
    cells = merged(texts.mapInArrow(_word_stripes(max(SHARDS, buckets)), STRIPES))
    found = stage(
        cells.where(f"next is null or n >= {int(min_count)}").select("lang", F.col("next").alias("phrase"), "n"), "phrase-words")
    sizes = found.where("phrase is null").select("lang", "n")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    single = found.where("phrase is not null")
    hashed = stage(single.mapInArrow(_head_hashes, "lang string, phrase string, n bigint, hash bigint"), "phrase-hashes")

    counts = "bucket int, hash array<bigint>, n array<int>"
    pairs = frequent_hashes(texts.mapInArrow(_pair_counts(share(filter_of(hashed, filter_bits)), buckets), counts), min_count)
    pairs_known = share(filter_of(pairs, filter_bits))
    triples = frequent_hashes(texts.mapInArrow(_triple_counts(pairs_known, buckets), counts), min_count)
    stripes = _phrase_stripes(pairs_known, share(filter_of(triples, filter_bits)), _hot(hashed, total), _hot(pairs, total))
    cells = merged(texts.mapInArrow(stripes, STRIPES)).where(F.col("n") >= min_count)
    facts = single.select("lang", "phrase", F.col("n").alias("f"), F.lit(None).cast("bigint").alias("cover"))
    facts = facts.unionByName(phrase_facts(cells)).groupBy("lang", "phrase").agg(F.max("f").alias("f"), F.max("cover").alias("cover"))
    return stage(facts, "phrase-facts"), sizes


def collocations(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, subsumed: int = SUBSUMED,
                 top: int = TOP, text_col: str = "text", lang_col: str = "lang", filter_bits: int | None = None) -> DataFrame:
    """The first ``top`` phrases of two to four words per language: ``lang``, ``rank``, ``phrase``,
    ``a`` (count), ``l`` and ``r`` (counts of the parts of its worst cut), ``n`` (words of the
    language), ``score`` = floor(2000000 * a / (l + r)), in exact arithmetic.

    Phrases of at least ``min_count`` occurrences count. The cut of the least score holds, the
    first of equal ones. A phrase goes if a longer one that holds it has ``subsumed`` hundredths
    of its count; as a part is never rarer, those of one word more tell. Order: score and count
    descending, then phrase by bytes.

    Null texts are empty, null languages ``und``; repeated rows count each time; other columns
    are not read, whatever their names. No rows, or nothing frequent, give no rows.
    """
    facts, sizes = mine(spark, docs, min_count, text_col, lang_col, filter_bits)
    return rank_phrases(facts, sizes, subsumed, top)


def rank_phrases(facts: DataFrame, sizes: DataFrame, subsumed: int = SUBSUMED, top: int = TOP) -> DataFrame:
    """The report of ``collocations`` from the facts of ``mine``. A part of very many phrases meets
    them in several tasks; products are decimals, as they may pass 64 bits."""
    found = facts.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    m = F.size("w")
    found = found.where(m > 1)

    def part(k: int, side: int, begin, length):
        text = F.array_join(F.slice("w", begin, length), " ")
        return F.struct(F.lit(2 * k + side).alias("at"), text.alias("part"))

    whole = F.when(m < 4, F.struct(F.lit(0).alias("at"), F.col("phrase").alias("part")))
    cuts = [F.when(m > k, part(k, side, *span)) for k in (1, 2, 3)
            for side, span in enumerate([(F.lit(1), F.lit(k)), (F.lit(k + 1), F.greatest(m - k, F.lit(0)))])]
    parts = found.select("lang", F.col("phrase").alias("of"), "a", F.explode(F.array_compact(F.array(whole, *cuts))).alias("x"))
    parts = parts.select("lang", "of", "a", "x.at", F.col("x.part").alias("phrase"))
    met = join_salted(parts, facts.select("lang", "phrase", "f", "cover"), ["lang", "phrase"], F.col("of"))
    counts = {f"c{at}": F.max(F.when(F.col("at") == at, F.col("f"))) for at in range(2, 8)}
    rows = met.groupBy("lang", "of", "a").agg(
        F.max(F.when(F.col("at") == 0, F.col("cover"))).alias("cover"), *[c.alias(name) for name, c in counts.items()])
    rows = rows.where(F.col("cover").isNull() | (F.col("cover") * 100 < F.col("a") * subsumed))

    def cut(k: int):
        score = F.expr(f"(cast(a as decimal(26, 0)) * 2000000) div cast(c{2 * k} + c{2 * k + 1} as decimal(26, 0))")
        made = F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"c{2 * k}").alias("l"), F.col(f"c{2 * k + 1}").alias("r"))
        return F.when(F.col(f"c{2 * k}").isNotNull(), made)

    rows = rows.select("lang", F.col("of").alias("phrase"), "a", F.array_min(F.array(cut(1), cut(2), cut(3))).alias("cut"))
    rows = rows.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    first = top_per_group(rows, ["lang"], [F.desc("score"), F.desc("a"), F.asc("phrase")], top)
    return first.join(sizes, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
