"""Toxicity: support vector machine on a gap-weighted subsequence kernel, with Nystroem landmarks."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.llm.common import TwoAges, hold, release, slices

_LONGEST = 16  # characters of a kernel string; longer words are scored in overlapping pieces
_BORDER = float(np.log(0.3 / 0.7))  # a margin of 0 scores 0.3
_CACHED = 24 << 20  # bytes of an age of the memo
_STRIP = " \t\n\r\x0b\x0c.,;:!?\"'()[]{}<>«»¡¿…-–—*_#/\\"
_JOIN = re.compile(r"(?<!\w)(?:\w[\W_]{1,2}){3,}\w(?!\w)")
_INNER = re.compile(r"[\W_]+")


def candidates(text: str) -> set[str]:
    """The strings of a text that are scored: its words, lower-cased and without marks at their
    ends, words with marks inside once more without them, and spaced-out letters joined."""
    text = text.lower()
    words = {w.strip(_STRIP) for w in set(text.split())}
    for w in [w for w in words if not w.isalnum()]:
        words.add(_INNER.sub("", w))
    for m in _JOIN.finditer(text):
        words.add(_INNER.sub("", m[0]))
    words.discard("")
    return words


def _pieces(word: str) -> list[str]:
    if len(word) <= _LONGEST:
        return [word]
    step = _LONGEST // 2
    return [word[i : i + _LONGEST] for i in range(0, len(word) - step, step)]


class StringKernel:
    """Weighted common subsequences of three characters, where each place that a subsequence
    spans costs ``decay``, so gaps and inserted characters are tolerated at a price; normalised.

    A string's features are its character triples, with their weights summed. Those of the
    landmarks fill a table by triple, so a string is compared with all of them by looking up its
    own triples; other characters than the landmarks' match nothing.
    """

    def __init__(self, landmarks: list[str], decay: float = 0.6):
        self.decay, self.landmarks = decay, landmarks
        self.letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(landmarks))))}
        self.size = len(self.letters) + 1
        self.table = np.zeros((self.size**3, len(landmarks)), np.float32)
        for m, word in enumerate(landmarks):
            triples, weights = self._triples(self._codes([word], len(word)))
            np.add.at(self.table[:, m], triples[0], weights)
        self.table /= np.sqrt((self.table**2).sum(0)).clip(1e-9)

    def _codes(self, words: list[str], length: int) -> np.ndarray:
        get = self.letters.get
        return np.array([get(c, 0) for w in words for c in w], np.int64).reshape(len(words), length)

    def _triples(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each string's triples of positions i < j < k as table rows, and the positions' weights."""
        i, j, k = _positions(codes.shape[1])
        rows = (codes[:, i] * self.size + codes[:, j]) * self.size + codes[:, k]
        known = (codes[:, i] > 0) & (codes[:, j] > 0) & (codes[:, k] > 0)
        return np.where(known, rows, 0), (self.decay ** (k - i + 1)).astype(np.float32)

    def _norms(self, words: list[str], length: int) -> np.ndarray:
        """Length of each string's own feature vector."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), "<u4").reshape(len(words), length).astype(np.uint64)
        i, j, k = _positions(length)
        if not len(i):
            return np.ones(len(words))
        names = (points[:, i] << np.uint64(42)) | (points[:, j] << np.uint64(21)) | points[:, k]
        order = np.argsort(names, 1, kind="stable")
        names = np.take_along_axis(names, order, 1)
        sums = np.cumsum((self.decay ** (k - i + 1))[order], 1)
        last = np.ones(names.shape, bool)
        last[:, :-1] = names[:, 1:] != names[:, :-1]
        ends = np.where(last, sums, 0)
        before = np.maximum.accumulate(np.hstack([np.zeros((len(words), 1)), ends[:, :-1]]), 1)
        return np.sqrt((np.where(last, sums - before, 0) ** 2).sum(1))

    def compare(self, words: list[str], table: np.ndarray) -> np.ndarray:
        """The normalised strings' features times a table of one row per triple."""
        out = np.zeros((len(words), *table.shape[1:]), np.float32)
        by_length: dict[int, list[int]] = defaultdict(list)
        for at, w in enumerate(words):
            by_length[len(w)].append(at)
        for length, rows in by_length.items():
            for at in range(0, len(rows), 256):
                some = rows[at : at + 256]
                part = [words[x] for x in some]
                triples, weights = self._triples(self._codes(part, length))
                if table.ndim == 1:
                    raw = table[triples] @ weights
                else:
                    raw = np.zeros((len(part), table.shape[1]), np.float32)
                    for c in range(len(weights)):
                        raw += weights[c] * table[triples[:, c]]
                out[some] = raw / self._norms(part, length).reshape(-1, *[1] * (table.ndim - 1))
        return out

    def against(self, words: list[str]) -> np.ndarray:
        return self.compare(words, self.table)


@cache
def _positions(length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    i, j, k = np.meshgrid(*[np.arange(length)] * 3, indexing="ij")
    keep = (i < j) & (j < k)
    return i[keep], j[keep], k[keep]


class ToxicityModel:
    """Scores words by a linear machine on Nystroem features; a text scores as its worst word."""

    def __init__(self, kernel: StringKernel, weights: np.ndarray, bias: float, slope: float):
        # one weight per triple: the landmarks' features times the machine's weights
        self.kernel, self.table, self.bias, self.slope = kernel, kernel.table @ weights.astype(np.float32), bias, slope
        kernel.table = None
        self.memo = None

    def margins(self, words: list[str]) -> np.ndarray:
        return self.kernel.compare(words, self.table) + self.bias

    def score(self, texts: list[str]) -> list[float]:
        if self.memo is None:
            self.memo = TwoAges(_CACHED, "toxicity")
        out = []
        for first in range(0, len(texts), 200):
            cut = [candidates(t) for t in texts[first : first + 200]]
            self.memo.turn()
            new = list(self.memo.missing({w for words in cut for w in words}))
            pieces = [(w, p) for w in new for p in _pieces(w)]
            worst: dict[str, float] = {}
            for (w, _), m in zip(pieces, self.margins([p for _, p in pieces]).tolist() if pieces else []):
                worst[w] = max(m, worst.get(w, -np.inf))
            self.memo.update(worst)
            tops = [max(map(self.memo.__getitem__, words), default=-np.inf) for words in cut]
            out += [0.0 if m == -np.inf else float(1 / (1 + np.exp(-np.clip(self.slope * m + _BORDER, -30, 30)))) for m in tops]
        return out


def _machine(x: np.ndarray, y: np.ndarray, weight: np.ndarray, c: float = 10.0, rounds: int = 40, seed: int = 1) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss) by dual coordinate ascent; the bias is a column."""
    x = np.hstack([x, np.ones((len(x), 1), x.dtype)]).astype(np.float64)
    alpha, w, q = np.zeros(len(x)), np.zeros(x.shape[1]), (x * x).sum(1)
    rng, top = np.random.default_rng(seed), c * weight
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            old = alpha[i]
            alpha[i] = min(max(old - (y[i] * (x[i] @ w) - 1) / q[i], 0), top[i])
            if alpha[i] != old:
                w += (alpha[i] - old) * y[i] * x[i]
    return w[:-1], float(w[-1])


def train(texts: list[str], toxic: list[int], landmarks: int = 128, negatives: int = 3000, seed: int = 1) -> ToxicityModel | None:
    """Learns from labelled texts. None if they hold no toxic or no clean text.

    Which words make a text toxic is not given. A cover finds them: again and again the word that
    is in most toxic texts not yet explained and hardly in clean ones. These words
    are the positive examples; words of clean texts are the negative ones, to which the worst
    mistakes among all clean words are added twice. The machine's border stands for a score of 0.3.
    """
    # only the toxic texts' words stay, each string once; clean texts are counted and let go
    clean, bad, n_clean, rng = Counter(), [], 0, np.random.default_rng(seed)
    pool: dict[str, str] = {}
    for t, y in dict(zip(texts, toxic)).items():
        words = {pool.setdefault(w, w) for w in candidates(t)}
        if y:
            bad.append(words)
        else:
            clean.update(words)
            n_clean += 1
    del pool
    if not bad or not n_clean:
        return None
    holders: dict[str, set[int]] = defaultdict(set)
    for i, words in enumerate(bad):
        for w in words:
            holders[w].add(i)
    allowed = {w: set(h) for w, h in holders.items() if len(h) >= 3 and clean[w] / n_clean < 0.02 * len(h) / len(bad)}
    shown, left = [], set(range(len(bad)))
    while allowed and left:
        word = max(allowed, key=lambda w: (len(allowed[w] & left), w))
        hit = allowed.pop(word) & left
        if len(hit) < 2:
            break
        shown.append(word)
        left -= hit
    if not shown:
        return None
    positive = [w for w in shown if len(w) <= _LONGEST]
    spread = [w[:i] + x + w[i:] for w in positive for i, x in zip(rng.integers(1, max(2, min(map(len, positive))), 2), "x*")]
    examples = positive + spread  # each once more with a character inserted
    clean_words = sorted(w for w in clean if len(w) <= _LONGEST)
    order = rng.permutation(len(clean_words))
    negative = [clean_words[i] for i in order[:negatives]]
    marks = positive[: landmarks // 2]
    # the first machine finds the clean words that come closest, and these become landmarks
    # and examples of the second, whose own worst mistakes are added once more
    model = _fit(marks + negative[: landmarks - len(marks)], examples, negative)
    for _ in range(2):
        margin = model.margins(clean_words)
        worst = [clean_words[i] for i in np.argsort(-margin, kind="stable")[:1500]]
        negative = list(dict.fromkeys(negative + worst))
        closest = [w for w in worst if len(w) >= 3][: landmarks - len(marks)]
        model = _fit(marks + closest, examples, negative)
    return model


def _fit(marks: list[str], positive: list[str], negative: list[str]) -> ToxicityModel:
    kernel = StringKernel(marks)
    values, vectors = np.linalg.eigh(kernel.against(marks).astype(np.float64))
    keep = values > 1e-6 * values.max()
    project = vectors[:, keep] / np.sqrt(values[keep])
    x = kernel.against(positive + negative) @ project
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    w, b = _machine(x, y, np.r_[np.full(len(positive), 2.0), np.ones(len(negative))])
    return ToxicityModel(kernel, project @ w, b, 2.0)


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_class: int = 2000, max_chars: int = 20_000) -> ToxicityModel | None:
    """Trains on at most ``per_class`` toxic and as many clean rows of ``labels`` joined with
    ``docs``: those of the smallest hash of their doc_id, of texts up to ``max_chars``
    characters. These bounds hold for training alone; scoring reads whole texts. The training runs
    in a task: the driver gets the model and no text."""
    rows = labels.where("toxic in (0, 1)").select("doc_id", "toxic").dropDuplicates(["doc_id"])
    h = F.xxhash64("doc_id", F.lit(7))
    some = rows.where("toxic = 1").orderBy(h).limit(per_class).unionAll(rows.where("toxic = 0").orderBy(h).limit(per_class))
    texts = docs.select("doc_id", "text").where((F.char_length("text") <= max_chars)).join(F.broadcast(some), "doc_id")

    def run(batches):
        hold("toxicity training")
        got = sorted(row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "toxic"))))
        model = train([t for _, t, _ in got], [y for _, _, y in got])
        del got
        yield pa.RecordBatch.from_arrays([pa.array([cloudpickle.dumps(model)], pa.binary())], names=["model"])
        release()

    # the chosen rows meet in one task, as many as the bounds allow
    made = texts.select("doc_id", "text", "toxic").repartition(1).mapInArrow(run, "model binary")
    row = made.first()  # none if no row was chosen
    return cloudpickle.loads(row["model"]) if row else None


def score_toxicity(docs: DataFrame, model: ToxicityModel | None, column: str = "score") -> DataFrame:
    """``docs`` with ``column``, from 0 to 1: the higher, the likelier toxic.

    A text scores as the worst of its words under the string kernel, which sees common
    subsequences with gaps, so inserted characters and unseen endings of an insult still score.
    Null and empty texts score 0, and all texts do if there was nothing to learn from. Every row
    is kept, repeated ones too; a column of the same name is replaced. One pass, no shuffle.
    """
    schema = docs.drop(column).withColumn(column, F.lit(0.0)).schema
    names = [f.name for f in schema]
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        hold("toxicity")
        m = shared.value
        for batch in slices(batches, 800):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            scores = m.score(texts) if m else [0.0] * len(texts)
            yield pa.RecordBatch.from_arrays([pa.array(scores, pa.float64()) if n == column else batch.column(n) for n in names], names=names)

    return docs.drop(column).mapInArrow(run, schema)
