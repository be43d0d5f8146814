"""Toxicity by compression distance: how well words compress against toxic and ordinary text."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import slices, stored

#: The classifier is fitted on at most this many labelled documents of each class, and on so many code
#: points of each: of a longer one on a part at a place that its id's hash chooses.
SAMPLE_PER_CLASS, SAMPLE_CHARS = {1: 6000, 0: 12_000}, 20_000
#: Words enter the toxic text if in so many sample documents, so many times as frequent there, and
#: with a log-likelihood ratio against chance of so many nats.
LEAST_DOCS, LEAST_RATIO, LEAST_EVIDENCE = 3, 8.0, 7.0
#: Words that the dictionaries are trained on at most, and the dictionaries' bytes: toxic, ordinary.
WORDS = (20_000, 60_000)
DICTIONARY = (16_384, 100_000)
#: A window counts from one of these many nats of log odds; below, it is the noise of rare lengths. The
#: fit takes the one whose logistic does best on rows of the sample that it was not fitted on.
LEAST_ODDS = (0.0, 0.5, 1.0, 1.5, 2.0)
#: Text without a space for so many characters is cut into windows of so many, one every so many.
UNSPACED, PIECE, STEP = 32, 8, 4
#: Score from which a document is rejected.
THRESHOLD = 0.3
#: Rows of the toxicity training fold: crc32(doc_id as text) mod FOLDS is not HELD_OUT.
FOLDS, HELD_OUT = 4, 2
#: Words a worker remembers, and characters of text whose words are looked up together.
REMEMBERED, TOGETHER = 100_000, 2_000_000

# A window is one word between spaces after a carrier that both dictionaries end with: the carrier
# makes zstd emit a compressed block at any length, and is paid for equally on both sides.
_CARRIER = bytes(range(128, 192))
_EDGES = ".,;:!?\"'()[]"
_LETTER = re.compile(r"[^\W\d_]")
_SEARCH = dict(
    window_log=17, chain_log=16, hash_log=15, search_log=5, min_match=3, target_length=32,
    strategy=zstandard.STRATEGY_BTOPT, write_content_size=False, write_dict_id=False, format=zstandard.FORMAT_ZSTD1_MAGICLESS,
)
_BINS = (16, 32, 18)
#: Windows without a letter or under three bytes share a bin of their own: their lengths tell nothing.
_PLAIN = 16 * 32 * 18
_ALL_BINS = _PLAIN + 1


@dataclass(frozen=True)
class Model:
    """Two dictionaries, the log odds of each pair of window lengths, and a logistic over a text."""

    toxic: bytes = b""
    ordinary: bytes = b""
    odds: bytes = b""
    least: float = 0.0
    weights: tuple[float, ...] = ()
    prior: float = 0.0
    key: int = field(default=0)


class Scorer:
    """A model at work in one process."""

    def __init__(self, model: Model):
        self.model = model
        self.compressors = [
            zstandard.ZstdCompressor(
                compression_params=zstandard.ZstdCompressionParameters(**_SEARCH),
                dict_data=zstandard.ZstdCompressionDict(d + _CARRIER, dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for d in (model.toxic, model.ordinary)
        ]
        self.empty = [self._lengths(c, [_CARRIER])[0] for c in self.compressors]
        self.odds = np.frombuffer(model.odds, "<f4") if model.odds else None
        self.known: dict[str, float] = {}

    @staticmethod
    def _lengths(compressor, windows: list[bytes]) -> np.ndarray:
        out = compressor.multi_compress_to_buffer(windows, threads=1)
        return np.array([len(out[i]) for i in range(len(windows))])

    def bins(self, words: list[str]) -> np.ndarray:
        """Bin of each word: its window's length against the toxic and the ordinary dictionary, and its own."""
        out = np.full(len(words), _PLAIN, np.int64)
        telling = [i for i, w in enumerate(words) if _tells(w)]
        if telling:
            out[telling] = self._compressed([words[i] for i in telling])
        return out

    def _compressed(self, words: list[str]) -> np.ndarray:
        raw = [b" %b " % w.encode() for w in words]
        windows = [_CARRIER + w for w in raw]
        costs = [self._lengths(c, windows) - e for c, e in zip(self.compressors, self.empty)]
        a, b, n = (np.clip(x, 0, top - 1) for x, top in zip((*costs, [len(w) for w in raw]), _BINS))
        return (a * _BINS[1] + b) * _BINS[2] + n

    def remember(self, words: set[str]) -> None:
        """Score new words; many at once, since each call loads the dictionaries."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        new = [w for w in words if w not in self.known]
        for start in range(0, len(new), 20_000):
            part = new[start : start + 20_000]
            found = self.odds[self.bins(part)] if self.odds is not None else np.zeros(len(part))
            self.known.update(zip(part, found.tolist()))

    def features(self, texts: list[str | None], least: tuple[float, ...] | None = None) -> np.ndarray:
        """Per text and bound the mean log odds from that bound on, over the windows of the whole text, and their number."""
        bounds = (self.model.least,) if least is None else least
        out = np.zeros((len(texts), len(bounds) + 1))
        start = 0
        while start < len(texts):
            # texts are taken together up to TOGETHER characters
            end, size = start + 1, len(texts[start] or "")
            while end < len(texts) and size < TOGETHER:
                size += len(texts[end] or "")
                end += 1
            split = [_split(t) for t in texts[start:end]]
            self.remember(set().union(*split))
            for i, words in enumerate(split, start):
                values = np.fromiter(map(self.known.__getitem__, words), float, len(words))
                out[i, :-1] = [values[values >= bound].sum() / max(1, len(values)) for bound in bounds]
                out[i, -1] = len(values)
            start = end
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        return _sigmoid(_design(self.features(texts)) @ np.array(self.model.weights))


def words_of(text: str | None) -> list[str]:
    return [w for w in _split(text) if _tells(w)]


def _split(text: str | None) -> list[str]:
    out = []
    for word in (text or "").lower().split():
        if len(word) > UNSPACED:
            out.extend(word[i : i + PIECE] for i in range(0, len(word) - PIECE + STEP, STEP))
        else:
            out.append(word.strip(_EDGES))
    return out


def _tells(word: str) -> bool:
    """A letter and at least three bytes: the length of a shorter window tells nothing."""
    return len(word.encode()) > 2 and _LETTER.search(word) is not None


def _design(found: np.ndarray) -> np.ndarray:
    mean, n = found[:, 0], np.log1p(found[:, 1])
    return np.stack([np.ones(len(found)), np.log1p(20 * mean), np.log1p(20 * mean) ** 2, n, n * np.log1p(20 * mean)], axis=1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@lru_cache(maxsize=2)
def _scorer(model: Model) -> Scorer:
    return Scorer(model)


def held_out(doc_id: Column) -> Column:
    """Whether a row belongs to the fold that no label is learnt from; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, toxic, part, longer: a bounded, repeatable sample of the labelled rows outside the held-out fold.

    Of each class the SAMPLE_PER_CLASS ids first in a hash order. The id list is bounded, so it is
    joined by broadcast and the corpus is not shuffled. Of copies and near copies in the sample one
    stays, or their words would pass for toxic ones. part 0 to 9 splits the sample for the three fits;
    longer is how many times as long the whole text is.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    one = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))  # repeated labels: toxic wins
    order = F.xxhash64("doc_id", F.lit(5))
    picked = [one.where(F.col("toxic") == c).orderBy(order, "doc_id").limit(n) for c, n in SAMPLE_PER_CLASS.items()]
    ids = stored(picked[0].unionByName(picked[1]), "sample-ids")
    length, whole = F.char_length("text"), F.char_length("text") <= SAMPLE_CHARS
    start = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.greatest(length - SAMPLE_CHARS, F.lit(1))).cast("int") + 1
    part = F.when(whole, F.col("text")).otherwise(F.substring("text", start, F.lit(SAMPLE_CHARS)))
    longer = F.when(whole, 1.0).otherwise(length / SAMPLE_CHARS).cast("double")
    texts = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(ids), "doc_id")
    found = stored(texts.select("doc_id", part.alias("text"), "toxic", longer.alias("longer")), "sample-texts")
    kept = "doc_id bigint, text string, toxic int, longer double"
    found = found.mapInArrow(_with_least_hashes, f"{kept}, least0 bigint, least1 bigint")
    for key in ("least0", "least1"):  # copies and near copies share at least one, as a rule
        found = found.withColumn("copy", F.row_number().over(Window.partitionBy(key).orderBy("doc_id", "text"))).where("copy = 1")
    found = found.select("doc_id", "text", "toxic", "longer")
    part = F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(10))
    return stored(found.withColumn("part", part), "sample")


def _with_least_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add the least hash, under two seeds, of a text's runs of three words."""
    for batch in batches:
        least: tuple[list[int], list[int]] = ([], [])
        for text in batch.column("text").to_pylist():
            words = (text or "").lower().encode().split()
            runs = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
            for seed, out in enumerate(least):
                out.append(min(xxhash.xxh64_intdigest(r, seed) for r in runs) - 2**63)
        ids, texts, toxic, longer = batch.columns
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), texts, toxic.cast(pa.int32()), longer, *[pa.array(x, pa.int64()) for x in least]],
            names=["doc_id", "text", "toxic", "longer", "least0", "least1"],
        )


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train the dictionaries, then the window log odds, then the logistic, on separate parts of the sample."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    total = known.agg(F.avg("toxic").alias("share")).first().share
    prior = min(max(total or 0.0, 1e-3), 1 - 1e-3)
    sample = training_sample(docs, labels)
    per_class = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if min(per_class.get(0, 0), per_class.get(1, 0)) < 2:
        return Model(weights=(math.log(prior / (1 - prior)), 0.0, 0.0, 0.0, 0.0), prior=prior)  # nothing to learn from
    toxic, ordinary = _dictionaries(sample.where("part < 6"))
    base = Model(toxic, ordinary)
    odds = _fit_odds(sample.where("part >= 6 AND part < 8"), base)
    model = Model(toxic, ordinary, odds)
    means = ", ".join(f"mean{i} double" for i in range(len(LEAST_ODDS)))
    features = sample.where("part >= 8").select("doc_id", "text", "toxic", "longer").mapInArrow(
        _features(model), f"{means}, n double, toxic int, doc_id bigint"
    )
    found = np.array(sorted((tuple(r) for r in features.collect()), key=lambda r: r[-1]), float)  # a fifth of the sample
    found = found.reshape(-1, len(LEAST_ODDS) + 3)
    by_bound = [found[:, [i, -3, -2]] for i in range(len(LEAST_ODDS))]
    best = min(range(len(LEAST_ODDS)), key=lambda i: (_loss_on_others(by_bound[i], prior), i))
    return Model(toxic, ordinary, odds, LEAST_ODDS[best], _logistic(by_bound[best], prior), prior)


def _weights(y: np.ndarray, prior: float) -> np.ndarray:
    """Rows weighted so that the classes stand as in all labels."""
    return np.where(y == 1, prior / max(1, (y == 1).sum()), (1 - prior) / max(1, (y == 0).sum())) * len(y)


def _loss_on_others(rows: np.ndarray, prior: float, folds: int = 5) -> float:
    """Log loss of each part of the rows under a logistic fitted on the other parts."""
    total = 0.0
    for fold in range(folds):
        out = np.arange(len(rows)) % folds == fold
        if not out.any() or out.all():
            continue
        at = _design(rows[out, :2]) @ np.array(_logistic(rows[~out], prior))
        y = rows[out, 2]
        total += float(_weights(rows[:, 2], prior)[out] @ np.logaddexp(0, np.where(y == 1, -1, 1) * at))
    return total


def _dictionaries(sample: DataFrame) -> tuple[bytes, bytes]:
    """Contents of two trained dictionaries: words over-represented in toxic documents, and ordinary words."""
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    words = sample.select("text", "toxic").mapInArrow(_distinct_words, "word string, toxic int")
    counts = words.groupBy("word").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("o"))
    t, o, share = F.col("t"), F.col("o"), sizes.get(1, 0) / max(1, sum(sizes.values()))
    ratio = (t / max(1, sizes.get(1, 0))) / ((o + 0.3) / max(1, sizes.get(0, 0)))
    expected = (t + o) * share
    evidence = t * F.ln(t / expected) + F.when(o > 0, o * F.ln(o / (t + o - expected))).otherwise(0)
    bad = counts.where((t >= LEAST_DOCS) & (ratio >= LEAST_RATIO) & (evidence >= LEAST_EVIDENCE) & (F.length("word") > 2))
    bad = [r.word for r in bad.orderBy(F.desc("t"), "word").limit(WORDS[0]).collect()]
    plain = counts.where((F.col("o") >= LEAST_DOCS) & (ratio < 1)).orderBy(F.desc("o"), "word").limit(WORDS[1])
    return _trained(bad, DICTIONARY[0]), _trained([r.word for r in plain.collect()], DICTIONARY[1])


def _trained(words: list[str], size: int) -> bytes:
    """A zstd dictionary trained on lines of the words, which are in falling order of weight.

    Training keeps each run of letters once and may break words up; words that it lost are put
    before it as far as the size allows. Too few lines to train on are the dictionary themselves.
    """
    rng = np.random.default_rng(11)
    raw = [w.encode() for w in words]
    lines = []
    for _ in range(4):
        order = [raw[i] for i in rng.permutation(len(raw))]
        lines += [b" " + b" ".join(order[i : i + 12]) + b" " for i in range(0, len(order), 12)]
    kept = b""
    if sum(map(len, lines)) > size:
        kept = zstandard.train_dictionary(size, lines, k=64, d=6).as_bytes()
    room, lost = size - len(kept), []
    for w in raw:
        if b" %b " % w not in kept:
            room -= len(w) + 1
            if room < 1:
                break
            lost.append(w)
    return b" " + b" ".join(lost[::-1]) + b" " + kept


def _distinct_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, list] = ([], [])
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = set(words_of(text))
            out[0].extend(found)
            out[1].extend([toxic] * len(found))
        yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.string()), pa.array(out[1], pa.int32())], names=["word", "toxic"])


def _fit_odds(sample: DataFrame, model: Model) -> bytes:
    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        held, sums = (Counter(), Counter()), np.zeros((2, _ALL_BINS))
        for frame in frames:
            for text, toxic in zip(frame["text"], frame["toxic"]):
                held[int(toxic)].update(_split(text))
        for kind, counts in enumerate(held):
            if counts:
                np.add.at(sums[kind], scorer.bins(list(counts)), list(counts.values()))
        toxic, place = np.nonzero(sums)
        yield pd.DataFrame({"toxic": toxic.astype(np.int32), "bin": place.astype(np.int32), "n": sums[toxic, place]})

    rows = sample.select("text", "toxic").mapInPandas(count, "toxic int, bin int, n double")
    sums = np.zeros((2, _ALL_BINS))
    for r in rows.groupBy("toxic", "bin").agg(F.sum("n").alias("n")).collect():
        sums[r.toxic, r.bin] = r.n
    ordinary = (sums[0] + 0.1) / (sums[0].sum() + 0.1 * sums.shape[1])
    toxic = (sums[1] + 20 * ordinary) / (sums[1].sum() + 20)
    return np.log(toxic / ordinary).astype("<f4").tobytes()


def _features(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts, toxic, longer = batch.columns
            found = _scorer(model).features(texts.to_pylist(), LEAST_ODDS)
            found[:, -1] *= longer.to_numpy(zero_copy_only=False)
            names = [*(f"mean{i}" for i in range(len(LEAST_ODDS))), "n", "toxic", "doc_id"]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(column) for column in found.T.copy()), toxic.cast(pa.int32()), ids.cast(pa.int64())], names=names
            )

    return run


def _logistic(rows: np.ndarray, prior: float) -> tuple[float, ...]:
    """Ridge logistic by Newton steps, classes weighted to the prior of all labels."""
    x, y = _design(rows[:, :2]), rows[:, 2]
    weight = _weights(y, prior)
    w = np.zeros(x.shape[1])
    w[0] = math.log(prior / (1 - prior))

    def loss(v: np.ndarray) -> float:
        return float(weight @ np.logaddexp(0, np.where(y == 1, -1, 1) * (x @ v)) + 0.25 * v[1:] @ v[1:])

    ridge = np.r_[0.0, np.full(len(w) - 1, 0.5)]
    for _ in range(100):
        p = _sigmoid(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge + 1e-6)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-7:
            break
    return tuple(w.tolist())


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_score``, a double from 0 to 1; null and empty texts score like a text without words.

    Every word of the whole text counts. Rows are scored alone, so repeated rows get equal scores;
    labels, source, language and id play no part. Extra columns pass through.
    """
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = _scorer(model).score(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(values), *batch.columns[1:]], names=["_score", *batch.schema.names[1:]])

    source = docs.select(F.col("text").alias("_in"), *[F.col(n).alias(f"_c{i}") for i, n in enumerate(names)])
    types = ", ".join(["_score double", *[f"_c{i} {docs.schema[n].dataType.simpleString()}" for i, n in enumerate(names)]])
    out = source.mapInArrow(run, types)
    return out.select(*[F.col(f"_c{i}").alias(n) for i, n in enumerate(names)], "_score")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below THRESHOLD, columns unchanged."""
    return scored(docs, fit(docs, labels)).where(F.col("_score") < THRESHOLD).select(*docs.columns)
