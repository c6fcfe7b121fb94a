"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, look-alike letters of other scripts, digits and signs that
stand for letters, and one form for i and l; what is no letter becomes a single space. The
lexicon holds words and word beginnings with the log odds of toxic texts, learned from labels,
and exception phrases that cancel the entries inside them. All are matched by one Aho-Corasick
automaton; the weights found are normalised by length and turned into a score.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxlens.llm.labels import sample, score_rows
from voxlens.llm.pretokens import worker_cache
from voxlens.session import stage

#: Bound of the labelled sample that is learned from; a third of it calibrates the score.
TRAIN_DOCS = 12288
#: Most entries of the lexicon, and of the exceptions.
LEXICON = 4096
#: Lengths of word beginnings that may become entries.
STEMS = (4, 5, 6, 7)
#: Entries considered are in at least so many toxic texts, and their odds are at least MIN_ODDS times higher there.
MIN_TOXIC, MIN_ODDS = 3, 4.0
#: Each entry that is taken leaves this share of a toxic text to be explained by others.
LEFT = 0.7
#: An entry is taken while it explains so many more toxic texts than odds of MIN_ODDS account for.
MIN_GAIN = 3.0
#: Characters that are folded and matched together (or one text, if longer).
RUN_CHARS = 512 << 10

# Look-alike letters of other scripts, after lower-casing.
LOOK_ALIKE = dict(zip(
    "авеёкмнорстухіјѕԁɡıαβεικνορτυχ",
    "abeekmhopctyxijsdgiabeikvoptux",
))
# Digits and signs that stand for letters.
STAND_IN = dict(zip("0134578@$", "oieastbas"))
_SPACE, _GONE = 32, 0


def _table() -> tuple[np.ndarray, np.ndarray]:
    """Per code point the folded letter (space: no letter, 0: leave out), and the letter that
    a digit or sign stands for between letters."""
    fold, stand = np.full(0x110000, _SPACE, np.uint32), np.zeros(0x110000, np.uint32)
    for code in range(0x30000):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind in ("Mn", "Cf"):
            fold[code] = _GONE
            continue
        if kind[0] != "L" and kind[0] != "N" and char not in STAND_IN:
            continue
        plain = unicodedata.normalize("NFKC", char)
        plain = plain.lower() if len(plain) == 1 else char.lower()
        plain = LOOK_ALIKE.get(plain, plain)[:1]
        if plain in STAND_IN:
            stand[code] = ord("i" if STAND_IN[plain] == "l" else STAND_IN[plain])
        elif plain.isalpha():
            fold[code] = ord("i") if plain == "l" else ord(plain)
    return fold, stand


def fold(texts: list[str]) -> tuple[str, np.ndarray]:
    """All texts folded into one string, `` word word ``, and where each begins. A text
    begins with a space, and no match runs over one that ends a text."""
    tables = worker_cache("fold-tables")
    if not tables:
        tables["fold"], tables["stand"] = _table()
    raw = np.frombuffer("\n\n".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), "<u4")
    starts = np.cumsum([1] + [len(t) + 2 for t in texts])[:-1] if texts else np.zeros(0, np.int64)
    folded, stand = tables["fold"][raw], tables["stand"][raw]
    letter = folded > _SPACE
    beside = np.zeros(len(raw), bool)
    beside[1:] |= letter[:-1]
    beside[:-1] |= letter[1:]
    sign = (raw == ord("@")) | (raw == ord("$"))
    if sign.any():  # a sign stands for a letter only before one
        beside[:-1] &= ~sign[:-1] | letter[1:]
    folded = np.where((stand > 0) & beside, stand, folded)
    folded[starts] = _SPACE
    space = folded == _SPACE
    keep = folded != _GONE
    last = np.ones(len(raw), bool)
    last[1:] = space[:-1]
    keep &= ~(space & last)
    keep[starts] = True
    places = np.cumsum(keep) - keep
    return folded[keep].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), places[starts]


def _runs(column):
    run, size, start = [], 0, 0
    for at in range(len(column)):
        text = column[at].as_py() or ""
        if run and size + len(text) > RUN_CHARS:
            yield start, run
            run, size, start = [], 0, at
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def _words(texts: list[str]) -> list[list[str]]:
    folded, starts = fold(texts)
    return [folded[a:b].split() for a, b in zip(starts, [*starts[1:], len(folded)])]


def _entries(words: list[str]) -> set[str]:
    found = set()
    for word in set(words):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in STEMS if len(word) >= n)
    return found


def _count_entries(batches):
    for batch in batches:
        counts = Counter()
        labels = batch.column("label")
        for at, texts in _runs(batch.column("text")):
            for k, words in enumerate(_words(texts)):
                label = labels[at + k].as_py()
                counts.update((entry, label) for entry in _entries(words))
        rows = [(e, n if y else 0, 0 if y else n) for (e, y), n in counts.items()]
        columns = list(zip(*rows)) or [[], [], []]
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
            names=["entry", "toxic", "clean"])


class Matcher:
    """The automaton of a lexicon (entry -> weight) and exceptions (phrases)."""

    def __init__(self, lexicon: dict[str, float], exceptions: list[str]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for entry, weight in lexicon.items():
            self.automaton.add_word(entry, (len(entry), weight))
        for phrase in exceptions:
            self.automaton.add_word(phrase, (len(phrase), None))
        if len(self.automaton):
            self.automaton.make_automaton()

    def hits(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight) of the words with an entry, the heaviest entry of each, without
        those that lie inside an exception."""
        best: dict[int, float] = {}
        spared: list[tuple[int, int]] = []
        if len(self.automaton):
            for end, (size, weight) in self.automaton.iter(folded):
                start = end - size + 1
                if weight is None:
                    spared.append((start, end))
                elif weight > best.get(start, 0.0):
                    best[start] = weight
        for start, end in spared:
            for at in [at for at in best if start <= at < end] if len(best) < 64 else range(start, end):
                best.pop(at, None)
        return sorted(best.items())


def _features(folded: str, starts: np.ndarray, matcher: Matcher) -> np.ndarray:
    """Per text: logarithms of the weight found, and of the weight per word."""
    n = len(starts)
    found = matcher.hits(folded)
    weight = np.zeros(n)
    if found:
        places, weights = (np.array(x) for x in zip(*found))
        weight = np.bincount(np.searchsorted(starts, places, "right") - 1, weights, n)
    ends = np.append(starts[1:], len(folded))
    codes = np.frombuffer(folded.encode("utf-32-le", "surrogatepass"), "<u4")
    begins = np.append((codes[:-1] == _SPACE) & (codes[1:] != _SPACE), False)
    sums = np.concatenate([[0], np.cumsum(begins)])
    words = np.maximum(1, sums[ends] - sums[starts])
    return np.stack([np.log1p(weight), np.log1p(1000 * weight / words)], 1)


def _map_features(data):
    def run(batches):
        matcher = Matcher(*data.value)
        for batch in batches:
            for at, texts in _runs(batch.column("text")):
                x = _features(*fold(texts), matcher)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(at, len(texts)), pa.array(x[:, 0]), pa.array(x[:, 1])],
                    names=["label", "weight", "density"])
    return run


def _contexts(data):
    """Phrases of two words around the entries, per label."""
    def run(batches):
        matcher = Matcher(data.value, [])
        for batch in batches:
            counts = Counter()
            labels = batch.column("label")
            for at, texts in _runs(batch.column("text")):
                for k, text in enumerate(texts):
                    folded, _ = fold([text])
                    phrases = set()
                    for start, _ in matcher.hits(folded):
                        stop = folded.find(" ", start + 1)
                        if stop < 0:
                            continue
                        phrases.add(folded[start : stop + 1])
                        before, after = folded.rfind(" ", 0, start), folded.find(" ", stop + 1)
                        if before >= 0:
                            phrases.add(folded[before : stop + 1])
                        if after > 0:
                            phrases.add(folded[start : after + 1])
                    counts.update((p, labels[at + k].as_py()) for p in phrases)
            rows = [(p, n if y else 0, 0 if y else n) for (p, y), n in counts.items()]
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.int64())],
                names=["entry", "toxic", "clean"])
    return run


def _present(data):
    """Per text the numbers of the entries that are in it."""
    def run(batches):
        entries = {entry: k for k, entry in enumerate(data.value)}
        for batch in batches:
            labels = batch.column("label")
            for at, texts in _runs(batch.column("text")):
                found = [sorted(entries[e] for e in _entries(words) if e in entries) for words in _words(texts)]
                yield pa.RecordBatch.from_arrays(
                    [labels.slice(at, len(texts)), pa.array(found, pa.list_(pa.int32()))], names=["label", "entries"])
    return run


def _explain(count: int, found: list) -> list[int]:
    """Entries that explain the toxic texts, greedily: what is in a text only because it comes
    along with a stronger entry, as in copies of one text, is not taken."""
    toxic = [r.entries for r in found if r.label == 1]
    held = np.zeros((len(toxic), count), np.float32)
    for k, entries in enumerate(toxic):
        held[k, entries] = 1
    clean = np.zeros(count)
    for r in found:
        if r.label != 1:
            clean[r.entries] += 1
    clean *= MIN_ODDS * len(toxic) / max(1, len(found) - len(toxic))
    open_, taken, free = np.ones(len(toxic), np.float32), [], np.ones(count, bool)
    while free.any():
        gain = np.where(free, open_ @ held - clean, -np.inf)
        best = int(np.argmax(gain))
        if gain[best] < MIN_GAIN:
            break
        taken.append(best)
        free[best] = False
        open_ *= np.where(held[:, best] > 0, np.float32(LEFT), np.float32(1))
    return taken


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Weights and intercept of a ridge logistic regression, by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w, penalty = np.zeros(x.shape[1]), np.diag([ridge] * (x.shape[1] - 1) + [1e-6])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, x.T @ (p - y) + penalty @ w)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def learn(docs: DataFrame, labels: DataFrame, held, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", bound: int = TRAIN_DOCS) -> dict:
    """Lexicon, exceptions and calibration from at most ``bound`` labelled texts outside
    ``held`` (a condition on ``id``). Without labels of both kinds the lexicon is empty and
    every score 0."""
    spark = docs.sparkSession
    rows = sample(docs, labels, label_col, held, bound, id_col, text_col).dropDuplicates(["text", "label"])
    rows = stage(rows, "toxicity-sample")  # read several times; the documents only once
    third = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(3)) == 0
    train = rows.where(~third).select("text", "label")
    sizes = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    model = {"lexicon": {}, "exceptions": [], "weights": None}
    if not n_toxic or not n_clean:
        return model
    smooth = 0.5
    odds = F.log((F.col("toxic") + smooth) / (n_toxic + 1)) - F.log((F.col("clean") + smooth) / (n_clean + 1))
    counted = train.mapInArrow(_count_entries, "entry string, toxic bigint, clean bigint")
    counted = counted.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    best = counted.where((F.col("toxic") >= MIN_TOXIC) & (odds >= math.log(MIN_ODDS))).select(
        "entry", odds.alias("weight")).orderBy(F.desc("toxic"), F.length("entry"), "entry").limit(LEXICON).collect()
    held = train.mapInArrow(
        _present(spark.sparkContext.broadcast([r.entry for r in best])), "label int, entries array<int>").collect()
    lexicon = {best[k].entry: best[k].weight for k in _explain(len(best), held)}
    if not lexicon:
        return model
    seen = train.mapInArrow(_contexts(spark.sparkContext.broadcast(lexicon)), "entry string, toxic bigint, clean bigint")
    seen = seen.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    spare = seen.where((F.col("clean") >= 2) & (odds <= 0)).orderBy(F.desc("clean"), "entry").limit(LEXICON)
    exceptions = [r.entry for r in spare.collect() if r.entry not in lexicon]
    data = spark.sparkContext.broadcast((lexicon, exceptions))
    found = rows.where(third).select("text", "label").mapInArrow(
        _map_features(data), "label int, weight double, density double").collect()
    x, y = np.array([[r.weight, r.density] for r in found]).reshape(-1, 2), np.array([r.label for r in found], float)
    if len(set(y)) < 2:
        return model
    return {"lexicon": lexicon, "exceptions": exceptions, "weights": _logistic(x, y)}


def scorer(data):
    """A function from an Arrow column of texts to scores, for tasks; ``data`` is a broadcast
    (lexicon, exceptions, weights)."""
    lexicon, exceptions, weights = data.value
    matcher = Matcher(lexicon, exceptions)

    def of(column) -> np.ndarray:
        if weights is None:
            return np.zeros(len(column))
        parts = [_features(*fold(texts), matcher) @ weights[:-1] + weights[-1] for _, texts in _runs(column)]
        return 1 / (1 + np.exp(-np.clip(np.concatenate(parts), -30, 30))) if parts else np.zeros(0)
    return of


def broadcast(spark: SparkSession, model: dict):
    return spark.sparkContext.broadcast((model["lexicon"], model["exceptions"], model["weights"]))


def score(spark: SparkSession, docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ``score``) per row, from the whole text. Null and empty texts have no hits and get
    the score of a text without any; repeated rows and null ids are rows like any other."""
    return score_rows(docs, scorer, broadcast(spark, model), id_col, text_col)
