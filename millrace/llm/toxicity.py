"""Toxicity by compression: dictionaries trained on toxic and on ordinary text, compared window by window.

A window is a run of several words, as they stand in the text, and windows overlap. Each is compressed by zstandard
twice: with a dictionary of ordinary text, and with the same text behind what zstandard's trainer takes from windows
that are telling of toxic text. The bytes that the second saves are the evidence: ordinary passages take as many bytes
either way, since both dictionaries hold the same ordinary text, and only what is typical of toxic text and not of
ordinary text becomes shorter. The toxic part stands first, and the search for matches reaches so far back only where
the ordinary text has nothing that begins alike; that is what keeps chance matches out.

Most windows have no run of bytes that the toxic part holds and the newest ordinary text does not. Both dictionaries
serve them alike, so they save nothing and are not compressed at all.

Training reads a bounded sample of labelled rows. Two thirds of it make the dictionaries. On the other third savings
are calibrated: by classes of window length, how rare a saving is among ordinary windows, and from that a probability
for the rarest window of a document, given how many windows it has.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import held_out, released, saved, small_batches, steps

#: Labelled documents of either kind that training reads at most, and their bytes.
SAMPLE_DOCUMENTS = 4000
SAMPLE_BYTES = 32 << 20
#: From this score on a document is called toxic.
THRESHOLD = 0.3

#: Words of a window, and from one window to the next.
WORDS, STRIDE = 6, 3
#: A longer run without blanks is cut, between characters, into words of about this many bytes.
LONGEST = 24
ORDINARY_BYTES = 400 << 10
#: Ordinary documents that are added to what any stretch of evidence shows before its probability is taken.
DOUBT = 5
#: Bytes and segments of the first dictionary of toxic text and of the final one; windows that the trainer reads.
FIRST, FINAL, TRAINED_WINDOWS = (32 << 10, 64), (2 << 10, 64), 40_000
#: A saving that at most one of this many ordinary windows shows makes a window telling.
TELLING = 20
#: Windows below this many bytes stand behind so many bytes of ordinary text: both dictionaries have those, and what
#: the first match of a frame costs is paid there.
SHORT, LEAD = 24, 32
#: Classes of window length are this wide, the last open; savings are counted up to the largest.
LENGTH_CLASS, LENGTH_CLASSES, MOST_SAVED = 12, 8, 24
#: A task remembers what up to so many windows have shown, about 30 MB; repeated lines and near copies bring them again.
REMEMBERED = 1 << 17
#: zstandard finds matches from so many bytes on, and its tree (``chain_log``) holds so many of the newest positions; the
#: last bytes of a dictionary are in none.
SHORTEST_MATCH, TREE, UNINDEXED = 4, (1 << 16) - 1, 8
#: Room for what zstandard's trainer writes before the text of a dictionary.
HEADER = 1 << 10
_PIECES = re.compile(rb"(?s).{%d}[\x80-\xBF]*" % LONGEST)


def _words(text: str) -> list[bytes]:
    """Lower-case words; runs without blanks, as in scripts that have none, in pieces of whole characters."""
    out = []
    for word in text.lower().encode("utf-8", "surrogatepass").split():
        if len(word) <= 2 * LONGEST:
            out.append(word)
        else:
            pieces = _PIECES.findall(word)
            out += [*pieces, *([rest] if (rest := word[sum(map(len, pieces)) :]) else [])]
    return out


def windows(text: str, words: int = WORDS, stride: int = STRIDE) -> list[bytes]:
    """Overlapping runs of words; a shorter text is one window, one without words none."""
    own = _words(text)
    last = max(len(own) - words, 0)
    starts = [*range(0, last + 1, stride), *([last] if last % stride else [])]
    # A blank on either side: the edge of a word belongs to what is typical of it.
    return [b" " + b" ".join(own[k : k + words]) + b" " for k in starts] if own else []


_PARAMETERS = {
    "format": zstandard.FORMAT_ZSTD1_MAGICLESS, "window_log": 19, "hash_log": 17, "chain_log": 17, "search_log": 4,
    "min_match": 3, "target_length": 32, "strategy": zstandard.STRATEGY_BTLAZY2, "write_content_size": False,
    "write_checksum": False, "write_dict_id": False,
}


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters(**_PARAMETERS)
    dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=parameters)
    return zstandard.ZstdCompressor(compression_params=parameters, dict_data=dictionary)


def _typical(samples: list[bytes], size: int, segment: int) -> bytes:
    """The segments that zstandard's trainer takes from windows, without its header; of few windows all that fit."""
    try:
        return zstandard.train_dictionary(size + HEADER, samples, k=segment, d=6).as_bytes()[-size:]
    except zstandard.ZstdError:
        # The trainer wants more text than there is.
        return b"".join(reversed(samples))[-size:]


def _eights(data: bytes) -> np.ndarray:
    """The eight bytes from every place on as one number, in the order of the bytes; zeros follow the last."""
    return np.ndarray((len(data),), ">u8", data + bytes(7), 0, (1,)).astype(np.uint64)


class _Runs:
    """Finds windows that a typical part may serve better than the ordinary text behind it does.

    A match in the typical part, which is older, is taken only where it is longer than what the newest ordinary text
    has. So it holds a run of bytes that is in the one and not in the other. Runs of four to eight bytes are looked
    for; those of eight count in any case, since what follows them may differ.
    """

    LONGEST = 8

    def __init__(self, ordinary: bytes, typical: bytes):
        self.known = np.unique(_eights(typical + ordinary[: self.LONGEST])[: len(typical)])
        newest = _eights(ordinary[-TREE:])[:-UNINDEXED]
        #: Bits that may differ where a place goes on like a known one for as long as it has to.
        self.free = np.ones(len(self.known), np.uint64)
        for length in range(self.LONGEST - 1, SHORTEST_MATCH - 1, -1):
            cut = np.uint64(64 - 8 * length)
            self.free[~np.isin(self.known >> cut, newest >> cut)] = np.uint64(1) << cut
        self.begins = np.zeros(1 << 16, bool)
        self.begins[self._slot(self.known)] = True

    @staticmethod
    def _slot(eights: np.ndarray) -> np.ndarray:
        return ((eights >> np.uint64(32)) * np.uint64(2654435761) >> np.uint64(16)).astype(np.uint16)

    def within(self, windows: list[bytes]) -> list[int]:
        """Places of the windows that hold such a run."""
        # What begins in one window and ends in the next only adds a window that need not be tried.
        eights = _eights(b"\0".join(windows))
        at = np.flatnonzero(self.begins[self._slot(eights)])
        near = eights[at]
        # Of all known runs those beside a place in their order have most in common with it.
        above = np.searchsorted(self.known, near)
        found = np.zeros(len(at), bool)
        for k in (np.maximum(above - 1, 0), np.minimum(above, len(self.known) - 1)):
            found |= (self.known[k] ^ near) < self.free[k]
        ends = np.cumsum([len(w) + 1 for w in windows])
        return np.unique(np.searchsorted(ends, at[found], side="right")).tolist()


class Model:
    """Two dictionaries and the calibration. Sent to the workers as it is."""

    def __init__(self, ordinary: bytes, typical: bytes):
        self.ordinary, self.typical = ordinary, typical
        self.telling_runs = _Runs(ordinary, typical)
        #: By class of length and bytes saved: how rare that is among ordinary windows, as a negative logarithm.
        self.rarity = np.zeros((LENGTH_CLASSES, MOST_SAVED + 1))
        self.steps: tuple[list[float], list[float]] = ([], [])
        self.prior = 0.0
        self._compressors = None
        self._known: dict[bytes, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"_compressors": None, "_known": {}}

    def savings(self, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Class of length and bytes saved of each window."""
        if self._compressors is None:
            self._compressors = _compressor(self.ordinary), _compressor(self.typical + self.ordinary)
        plain, toxic = (c.compress for c in self._compressors)
        lead = self.ordinary[-LEAD:]
        framed = [w if len(w) >= SHORT else lead + w for w in runs]
        saved = np.zeros(len(runs), np.int64)
        for k in self.telling_runs.within(framed):
            saved[k] = len(plain(framed[k])) - len(toxic(framed[k]))
        length = np.array([len(w) for w in runs], np.int64) // LENGTH_CLASS
        return np.minimum(length, LENGTH_CLASSES - 1), np.clip(saved, 0, MOST_SAVED)

    def calibrate(self, runs: Iterator[list[bytes]]) -> Model:
        """Learn how rare savings are from the windows of ordinary texts."""
        counts = np.zeros_like(self.rarity)
        for own in runs:
            if own:
                np.add.at(counts, self.savings(own), 1)
        # Classes of few windows borrow from what all classes show.
        above = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]
        every = above.sum(axis=0)
        tail = (above + (every + 0.5) / (every[0] + 1)) / (above[:, :1] + 1)
        # Nothing can be called rarer than one in all the windows that were seen.
        self.rarity = -np.log(np.clip(tail, 0.5 / (every[0] + 1), 1.0))
        self._known = {}
        return self

    def evidence(self, text: str) -> float:
        """How rare the document's most telling window is among as many ordinary ones."""
        runs = windows(text)
        if not runs:
            return 0.0
        known = self._known
        if len(known) > REMEMBERED:
            known.clear()
        fresh = [w for w in dict.fromkeys(runs) if w not in known]
        if fresh:
            known.update(zip(fresh, self.rarity[self.savings(fresh)].tolist(), strict=True))
        rarest = max(map(known.__getitem__, runs))
        return max(0.0, rarest - math.log(len(runs)))

    def score(self, text: str) -> float:
        """The probability of being toxic."""
        at, values = self.steps
        return float(np.interp(self.evidence(text), at, values)) if at else self.prior


def _shingles(text: str) -> set[int]:
    """An eighth of the hashes of five words each, or all where that leaves none."""
    words = text.split()
    own = {zlib.crc32(" ".join(words[k : k + 5]).encode("utf-8", "surrogatepass")) for k in range(max(1, len(words) - 4))}
    return {x for x in own if x % 8 == 0} or own


def _apart(texts: list[str]) -> list[str]:
    """Texts without exact and near copies of earlier ones, which would pass for evidence many times."""
    seen: set[int] = set()
    out = []
    for text in texts:
        own = _shingles(text)
        if len(own & seen) * 2 < len(own):
            out.append(text)
        seen |= own
    return out


def _drawn(texts: list[str], size: int = 2 << 20) -> Iterator[str]:
    """The first texts, up to a number of code points."""
    total = 0
    for text in texts:
        if total < size:
            yield text
        total += len(text)


def fit(toxic: list[str], ordinary: list[str]) -> Model:
    """A model of labelled texts: two thirds of either train the dictionaries, the rest calibrates."""
    toxic, ordinary = _apart(toxic), _apart(ordinary)
    if not toxic or not ordinary:
        model = Model(bytes(64), bytes(64))
        model.prior = float(bool(toxic))
        return model
    split = lambda texts: ([t for k, t in enumerate(texts) if k % 3], texts[::3])
    (toxic_a, toxic_b), (ordinary_a, ordinary_b) = split(toxic), split(ordinary)
    # Texts come in the order of a hash, so a prefix of them is a fair draw of all languages.
    content = b""
    for text in ordinary_a[1::2]:
        content += b" " + b" ".join(_words(text))
        if len(content) > ORDINARY_BYTES:
            break
    content = content[:ORDINARY_BYTES].ljust(64)
    # A first dictionary takes whatever is frequent in one half of the toxic texts. Windows of the other half that it
    # serves better than any but a few ordinary ones are telling: the final dictionary is trained on those alone.
    halves = [[w for t in toxic_a[k::2] for w in windows(t)][:TRAINED_WINDOWS] for k in (0, 1)]
    telling = []
    for known, other in (halves, halves[::-1]):
        first = Model(content, _typical(known, *FIRST)).calibrate(windows(t) for t in _drawn(ordinary_a[::2]))
        rarity = first.rarity[first.savings(other)] if other else np.zeros(0)
        telling += [w for w, r in zip(other, rarity.tolist(), strict=True) if r >= math.log(TELLING)]
    shown = halves[0] + halves[1]
    model = Model(content, _typical(telling or shown, *FINAL)).calibrate(windows(t) for t in ordinary_b)
    n1, n0 = len(toxic_b), len(ordinary_b)
    # Probabilities that rise with the evidence: neighbours that fall are pooled.
    share = len(toxic) / (len(toxic) + len(ordinary))
    weight = {1: share / n1, 0: (1 - share) / n0}
    rows = sorted([(model.evidence(t), 1) for t in toxic_b] + [(model.evidence(t), 0) for t in ordinary_b])
    pools: list[list[float]] = []
    for at, label in rows:
        pools.append([at, at, label * weight[label], weight[label]])
        while len(pools) > 1 and (pools[-2][1] == pools[-1][0] or pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]):
            _, last, a, b = pools.pop()
            pools[-1][1], pools[-1][2], pools[-1][3] = last, pools[-1][2] + a, pools[-1][3] + b
    at, values, unit = [], [], 1 / (n1 + n0)
    for first, last, a, b in pools:
        for x in {first, last}:
            at.append(x)
            # A few documents are no proof: each pool counts as if so many more ordinary ones were in it.
            values.append(a / (b + DOUBT * unit))
    order = np.argsort(at, kind="stable")
    model.steps = ([at[k] for k in order], sorted(values))
    return model


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE_DOCUMENTS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on a sample of the labelled rows that are not held out.

    Null labels and texts teach nothing; a document with several labels is sampled with each, and a text that occurs
    often with a label once. The sample has at most ``sample`` texts of either label, and of those as many as fit into
    ``sample_bytes``, in the order of a hash: the same whatever the partitioning.
    """
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int").alias("_toxic")).where("_toxic in (0, 1)").where(~held_out())
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).where("text is not null")
    # Only numbers are shuffled to draw the sample: hashes of ids and texts, each text of a label once.
    drawn = texts.select("doc_id", F.xxhash64("text").alias("_h")).join(known.distinct(), "doc_id")
    drawn = drawn.groupBy("_toxic", "_h").agg(F.min("doc_id").alias("doc_id"))
    chosen = None
    for toxic in (0, 1):
        part = drawn.where(F.col("_toxic") == toxic).orderBy(F.xxhash64("_h", F.lit(3)), "_h").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    chosen = saved(chosen, "sample")
    # At most twice ``sample`` rows; the byte limit is applied by sizes before any text is fetched.
    sizes = texts.withColumn("_h", F.xxhash64("text")).join(F.broadcast(chosen), ["doc_id", "_h"])
    sizes = sizes.groupBy("_toxic", "doc_id", "_h").agg(F.first(F.octet_length("text")).alias("n"), F.first("text").alias("text"))
    order = Window.partitionBy("_toxic").orderBy(F.xxhash64("_h", F.lit(3)), "_h")
    fitting = sizes.withColumn("_total", F.sum("n").over(order)).where(F.col("_total") <= sample_bytes)
    found = [(r["_toxic"], r["text"]) for r in fitting.orderBy(F.xxhash64("_h", F.lit(3)), "_h").select("_toxic", "text").collect()]
    return fit(*([text for label, text in found if label == toxic] for toxic in (1, 0)))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row; a null text is empty, and every row has a score."""
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            values = [model.score(t or "") for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text")).mapInArrow(released(run), "doc_id long, score double")


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents by a model of their labelled, not held out rows.

    Repeated rows are scored each for itself; an empty table gives no rows, and without labels of both kinds every
    score is the share of toxic labels that there is: 0 or 1. Other columns are ignored.
    """
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_ordinary(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not called toxic, with all their columns."""
    small_batches(docs.sparkSession)
    model = train(docs, labels)
    position = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 1000):
                piece = batch.slice(first, 1000)
                keep = [model.score(t or "") < THRESHOLD for t in piece.column(position).to_pylist()]
                yield piece.filter(pa.array(keep))

    return docs.mapInArrow(released(run), docs.schema)
