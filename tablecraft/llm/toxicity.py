"""Toxicity by a subsequence string kernel, Nyström landmarks and a linear support vector machine.

A sentence is as toxic as its worst unit, and a text as its worst sentence.  Units are
words, and runs of single letters that spell one.  The kernel of two units counts the
subsequences of ``LENGTH`` letters that they share, each weighted by ``DECAY`` per
letter of the stretches it spans, up to ``SPAN`` letters: letters put in between cost
little.  Marks inside a unit are left out and look-alike digits are read as letters.

The kernel is taken to landmarks only, so the machine is linear in a fixed number of
coordinates.  The landmarks, weights and whitening fold into one table with a weight
per subsequence; scoring a unit adds up table entries and divides by a norm that
depends on its length.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.spans import cut
from tablecraft.llm.text import LOWER, as_bytes, fields_of, map_rows
from tablecraft.plans.storage import written

LENGTH, SPAN, DECAY = 3, 6, 0.6
LANDMARKS = 256
RIDGE = 2e-5
HARMLESS = 4.0
HARD_ROUNDS = 1
INSERTED = 1_000
#: Labelled documents that the classifier is fitted on: those with the least hashes of their id.
SAMPLE = 12_000
#: Units of each kind that it is fitted on.
UNITS = 6_000
CUT = 0.7

#: Letter classes. Accents by base letter, look-alikes.
_CLASSES = ["aA4@", "b", "c", "d", "e3", "f", "g", "h", "i1", "j", "k", "l", "m", "n", "o0", "p", "q", "r", "s5$", "t7", "u", "v",
            "w", "x", "y", "z", "áàâäãåÁÀÂÄÃÅ", "éèêëÉÈÊË", "íìîïÍÌÎÏ", "óòôöõÓÒÔÖÕ", "úùûüÚÙÛÜ", "ñÑ", "çÇ", "ß"]
_START, _STOP = len(_CLASSES), len(_CLASSES) + 1
_SIZE = _STOP + 1
_LONGEST, _STRIDE = 24, 12
_SPELLED = re.compile(rb"(?<!\S)(?:[a-z][\s.*_-]+){2,}[a-z](?!\S)")
_BY_POINT = np.full(0x250, -1, np.int64)
for _k, _letters in enumerate(_CLASSES):
    for _c in _letters:
        _BY_POINT[ord(_c)] = _k
for _c in "abcdefghijklmnopqrstuvwxyz":
    _BY_POINT[ord(_c.upper())] = _BY_POINT[ord(_c)]


def units_of(text: bytes) -> set[bytes]:
    low = text.translate(LOWER)
    found = set(low.split())
    for m in _SPELLED.finditer(low):
        found.add(re.sub(rb"[^a-z]", b"", m[0]))
    return found


def contexts(text: bytes) -> list[tuple[bytes, int]]:
    """Units of each sentence of a text with a hash of their neighbours in it; long units are left out."""
    out, (starts, _) = [], cut(text)
    for a, z in zip(starts, [*starts[1:], len(text)]):
        sentence = text[a:z].translate(LOWER)
        words = [b"", *sentence.split(), b""]
        for before, unit, after in zip(words, words[1:], words[2:]):
            if len(unit) <= 64:
                out.append((unit, xxhash.xxh64_intdigest(before + b" " + after) >> 1))
        out += [(re.sub(rb"[^a-z]", b"", m[0]), a) for m in _SPELLED.finditer(sentence)]
    return out


def _ragged(units: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
    """(indices, letters) by length, with start and stop marks; long units as overlapping windows."""
    texts = [u.decode() for u in units]
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    owner = np.repeat(np.arange(len(units)), [len(t) for t in texts])
    code = _BY_POINT[np.minimum(points, 0x24F)]
    owner, code = owner[code >= 0], code[code >= 0]
    sizes = np.bincount(owner, minlength=len(units))
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
    out = []
    for size in np.unique(sizes):
        own = np.flatnonzero(sizes == size)
        windows = [0] if size <= _LONGEST else [*range(0, size - _LONGEST, _STRIDE), size - _LONGEST]
        for w in windows:
            at = starts[own] + w
            letters = code[at[:, None] + np.arange(min(size, _LONGEST))] if size else np.zeros((len(own), 0), np.int64)
            if w == 0:
                letters = np.concatenate([np.full((len(own), 1), _START), letters], axis=1)
            out.append((own, letters))
    return out


def _subsequences(n: int) -> list[tuple[tuple[int, ...], float]]:
    """Places of the subsequences of a unit of n letters, and their weights."""
    return [(p, DECAY ** (p[-1] - p[0] + 1)) for p in combinations(range(n), LENGTH) if p[-1] - p[0] < SPAN]


def _entry(letters: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(letters), np.int64)
    for p in places:
        out = out * _SIZE + letters[:, p]
    return out


def project(units: list[bytes], table: np.ndarray, empty: float = 0.0) -> np.ndarray:
    """Sum of the table rows of each unit's subsequences over its norm; the largest of its windows.

    Units with too few letters give ``empty``.  The norm is that of a unit without
    equal subsequences, so it depends on the length only and the kernel stays one.
    """
    out = np.full((len(units), *table.shape[1:]), -np.inf, table.dtype)
    for own, letters in _ragged(units):
        places = _subsequences(letters.shape[1])
        if not places:
            out[own] = np.maximum(out[own], empty)
            continue
        total = np.zeros((len(own), *table.shape[1:]), table.dtype)
        for p, weight in places:
            total += weight * table[_entry(letters, p)]
        out[own] = np.maximum(out[own], total / np.sqrt(sum(w * w for _, w in places)))
    return out


def profiles(units: list[bytes]) -> np.ndarray:
    """One column per unit: its normed weight of every subsequence, so that project() gives kernel values."""
    out = np.zeros((_SIZE**LENGTH, len(units)), np.float32)
    for own, letters in _ragged(units):
        places = _subsequences(letters.shape[1])
        norm = np.sqrt(sum(w * w for _, w in places)) if places else 1
        for p, weight in places:
            np.add.at(out, (_entry(letters, p), own), weight / norm)
    return out


@dataclass
class Model:
    """A weight per subsequence, the offset, and the two numbers that turn a margin into a chance."""

    table: np.ndarray
    offset: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, units: list[bytes]) -> np.ndarray:
        return project(units, self.table) + self.offset

    def chance(self, margin):
        return 1 / (1 + np.exp(-np.clip(self.slope * np.asarray(margin) + self.shift, -40, 40)))


def _squared_hinge(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = RIDGE) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, by Newton steps on the violated rows."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w = np.zeros(x.shape[1])
    keep = np.eye(x.shape[1]) * ridge
    keep[-1, -1] = 1e-6
    weight = weight / weight.sum()
    for _ in range(30):
        bad = y * (x @ w) < 1
        xb = x[bad] * weight[bad, None]
        new = np.linalg.solve(xb.T @ x[bad] + keep, xb.T @ y[bad])
        if np.allclose(new, w, atol=1e-7):
            break
        w = new
    return w


def fit_machine(
    units: list[bytes], toxic: np.ndarray, clean: np.ndarray, landmarks: int = LANDMARKS
) -> tuple[Model, list[bytes]]:
    """Fit on units with the number of documents whose toxic and whose clean sentences speak for them.

    Most units of toxic sentences are harmless, so labels of units are fitted too: a
    unit is toxic at first if its sentences are so clearly more often than all are,
    and later if the machine says so and no clean sentence speaks against it.  Also
    returned are the toxic units with a letter put in, which the fit counts as toxic.
    """
    share = toxic.sum() / (toxic.sum() + clean.sum())
    expected = share * (toxic + clean)
    surplus = (toxic - expected) / np.sqrt(expected + 1)
    y = np.where((surplus > 2) & (toxic >= 3) & (clean <= toxic / 20), 1.0, -1.0)
    by_surplus = np.argsort(-surplus * (y > 0), kind="stable")
    half = landmarks // 2
    head = by_surplus[: 4 * half][y[by_surplus[: 4 * half]] > 0]
    body = profiles([units[i] for i in head]) if len(head) else None
    chosen: list[int] = []
    if body is not None:
        # Farthest first: each landmark is the candidate least like those before it.
        near = body.T @ body[:, :1]
        chosen = [0]
        closest = near[:, 0].copy()
        while len(chosen) < min(half, len(head)):
            k = int(closest.argmin())
            if k in chosen:
                break
            chosen.append(k)
            closest = np.maximum(closest, body.T @ body[:, k])
    others = np.flatnonzero(y < 0)
    rest = others[np.linspace(0, len(others) - 1, min(len(others), landmarks - len(chosen))).astype(int)] if len(others) else []
    marks = [units[head[k]] for k in chosen] + [units[i] for i in rest]
    basis = profiles(marks)
    kernel = (basis.T @ basis).astype(np.float64)
    values, vectors = np.linalg.eigh(kernel)
    kept = values > 1e-4 * values.max()
    whiten = vectors[:, kept] / np.sqrt(values[kept])
    features = project(units, basis).astype(np.float64) @ whiten
    for _ in range(3):
        # Positive units also count with a letter put in, at every place and with every fifth letter.
        bent = [u for i in np.flatnonzero(y > 0)[:INSERTED] for u in _with_a_letter(units[i])]
        more = project(bent, basis).astype(np.float64) @ whiten
        # A text has many units and one is enough, so harmless ones weigh more.
        weight = np.where(y > 0, 1 / max(1, (y > 0).sum()), HARMLESS / max(1, (y < 0).sum()))
        w = _squared_hinge(
            np.concatenate([features, more]), np.concatenate([y, np.ones(len(bent))]),
            np.concatenate([weight, np.full(len(bent), 1 / max(1, len(bent)))]),
        )
        said = features @ w[:-1] + w[-1]
        again = np.where((y > 0) & (said < -0.5), -1.0, np.where((said > 0.3) & (clean == 0) & (toxic > 0), 1.0, y))
        if not (again > 0).any() or (again == y).all():
            break
        y = again
    return Model(basis.astype(np.float64) @ (whiten @ w[:-1]), float(w[-1])), bent


def _with_a_letter(unit: bytes) -> list[bytes]:
    text = unit.decode()
    return [(text[:i] + c + text[i:]).encode() for i in range(1, len(text)) for c in "afkpuz"[i % 2 :: 2]]


def _logistic(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift by Newton steps, with a small ridge so that separable labels give finite ones."""
    x = np.stack([margin, np.ones(len(margin))], axis=1)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y <= 0).sum()))
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -40, 40)))
        grad = x.T @ (weight * (p - y)) + 1e-3 * np.array([w[0], 0])
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


class TextScorer:
    """Largest unit margin of each text, with a bounded cache over units."""

    def __init__(self, model: Model, most: int = 400_000):
        self.model, self.most, self.known = model, most, {}

    def __call__(self, texts: list[bytes]) -> list[float]:
        out = []
        for start in range(0, len(texts), 500):
            own = [units_of(t) for t in texts[start : start + 500]]
            if len(self.known) > self.most:
                self.known = {}
            new = list(set().union(*own).difference(self.known))
            self.known.update(zip(new, self.model.margins(new).tolist()))
            out += [max(map(self.known.__getitem__, u), default=self.model.offset) for u in own]
        return out


def project_margins(units: DataFrame, model: Model) -> DataFrame:
    def worker(batches):
        for b in batches:
            yield b | {"margin": model.margins(b["unit"]).tolist()}

    return map_rows(units, [*fields_of(units, *units.columns), T.StructField("margin", T.DoubleType())], worker)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Model | None:
    """Fit on at most ``sample`` labelled documents of ``labels(id, toxic)``; None without both labels.

    An id with several labels counts as toxic if one of them says so.
    """
    chosen = (
        labels.filter("toxic IS NOT NULL").groupBy(id_col).agg(F.max("toxic").alias("_toxic"))
        .filter(F.col(id_col).isNotNull()).orderBy(F.xxhash64(id_col), id_col).limit(sample)
    )
    # At most ``sample`` ids.
    rows = written(
        docs.select(F.col(id_col), as_bytes(text_col).alias("_text")).join(F.broadcast(chosen), id_col)
        .select("_text", "_toxic", F.xxhash64("_text").alias("_doc")),
        "labelled",
    )

    def votes(batches):
        for b in batches:
            seen = {}
            for text, toxic, doc in zip(b["_text"], b["_toxic"], b["_doc"]):
                vote = (int(toxic > 0), doc)
                for key in contexts(text):
                    seen[key] = min(vote, seen.get(key, vote))
            units, own = zip(*seen) if seen else ((), ())
            toxic, docs = zip(*seen.values()) if seen else ((), ())
            yield {"unit": list(units), "context": list(own), "toxic": list(toxic), "doc": list(docs)}

    # A unit between two neighbours is evidence once, for the least document that has it
    # there, as clean if it ever is; and a document is evidence for a unit once.  So
    # neither copies of a document nor repeats inside one count.
    fields = [
        T.StructField("unit", T.BinaryType()), T.StructField("context", T.LongType()),
        T.StructField("toxic", T.IntegerType()), T.StructField("doc", T.LongType()),
    ]
    units = written(
        map_rows(rows, fields, votes).groupBy("unit", "context").agg(F.min("toxic").alias("toxic"), F.min("doc").alias("doc"))
        .groupBy("unit", "doc").agg(F.min("toxic").alias("toxic"))
        .groupBy("unit").agg(F.sum(1 - F.col("toxic")).alias("clean"), F.sum("toxic").cast("long").alias("toxic")),
        "units",
    )
    order = F.xxhash64("unit"), F.col("unit")
    kinds = [
        units.filter("toxic > 0").orderBy(F.desc("toxic"), *order), units.filter("clean > 0").orderBy(F.desc("clean"), *order),
        units.orderBy(*order),
    ]
    found = {r.unit: (r.toxic, r.clean) for kind in kinds for r in kind.limit(UNITS).collect()}
    if not any(t for t, _ in found.values()) or not any(c for _, c in found.values()):
        return None
    names = sorted(map(bytes, found))
    counts = np.array([found[u] for u in names], float)
    model, bent = fit_machine(names, counts[:, 0], counts[:, 1])
    for _ in range(HARD_ROUNDS):
        # The harmless units that the machine finds worst, of all units of the sample.
        worst = project_margins(units.filter("clean > 0"), model).orderBy(F.desc("margin"), "unit").limit(UNITS)
        found |= {r.unit: (r.toxic, r.clean) for r in worst.collect()}
        names = sorted(map(bytes, found))
        counts = np.array([found[u] for u in names], float)
        model, bent = fit_machine(names, counts[:, 0], counts[:, 1])

    def margins(batches):
        score = TextScorer(model)
        for b in batches:
            yield {"margin": score(b["_text"]), "toxic": b["_toxic"]}

    fields = [T.StructField("margin", T.DoubleType()), T.StructField("toxic", T.IntegerType())]
    pairs = map_rows(rows, fields, margins).collect()
    # A text with a bent unit alone is to count as toxic too, so these set the chances as well.
    margin = np.concatenate([[p.margin for p in pairs], model.margins(bent)])
    model.slope, model.shift = _logistic(margin, np.array([float(p.toxic > 0) for p in pairs] + [1.0] * len(bent)))
    return model


def score_texts(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text", cut_at: float = CUT
) -> DataFrame:
    """``(id, score, predicted)`` per document row; without a model every score is 0.

    A text without a word (empty, null) has the score of a unit without letters.
    """

    def worker(batches):
        scorer = TextScorer(model) if model else None
        for b in batches:
            chance = model.chance(scorer(b["_text"])).tolist() if scorer else [0.0] * len(b["_text"])
            yield {id_col: b[id_col], "score": chance, "predicted": [int(c >= cut_at) for c in chance]}

    fields = [*fields_of(docs, id_col), T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return map_rows(docs.select(id_col, as_bytes(text_col).alias("_text")), fields, worker)
