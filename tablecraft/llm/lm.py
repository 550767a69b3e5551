"""Log-likelihood of whole documents under a gated recurrent model with a class-factored softmax.

Words are counted over all training documents.  The ``HEAD`` most frequent words are
the model's own vocabulary, in classes of ``CLASS_WORDS`` by rank; all other words fall
in classes by their first letter.  The recurrent unit predicts the class of the next
token, and for classes of the head the word too.  Inside a tail class a word has its
counted share less a discount, and what the discounts leave is for unseen words; so
the chances of all words and of one unseen word per class add up to one.

Training is data-parallel: each task runs truncated backpropagation over its share of
the training documents from the same weights, and Spark averages the weights.
Scoring runs many documents side by side and carries their states from window to
window, so every document is read from its first to its last token.

Tasks hold the ``KNOWN`` most frequent words.  Rarer words of a document go to a join
with the table of all counts, so the vocabulary may grow without a bound.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tablecraft.llm.text import as_bytes, fields_of, map_rows
from tablecraft.plans.storage import written

HEAD, CLASS_WORDS, TAIL_CLASSES, HIDDEN = 1024, 32, 32, 24
KNOWN = 200_000
LANES, WINDOW = 512, 32
#: Targets whose softmaxes are held at once, so that they stay in a core's cache.
TOGETHER = 2_048
#: Logits up to FAR need no shift before their exponentials.
FAR = 80.0
#: Rows of an input from which their sum is a product with ones.
MANY_ROWS = 16
#: Bytes of texts that a task cuts into words at once; a longer text is a part of its own.
PART_BYTES = 8_000_000
#: Tokens from which a task scores the texts it holds, side by side; the longest of them goes on alone for fewer of all steps then.
SCORED_TOKENS = 4_000_000
#: The training documents are dealt out to the rounds, so that these cover all of them: ROUNDS rounds for up to
#: MANY replicas, and one more for each eight times as many. PASSES: of a task over its documents.
ROUNDS, MANY, PASSES = 2, 32, 1
#: Tokens that a replica holds and trains on at once; more replicas than MOST train on several such parts in turn.
REPLICA_TOKENS, MOST = 2_500_000, 2_048
TRAIN_LANES, RATE, CLIP = 128, 0.015, 1.0
#: Training reads documents in stretches of so many tokens in mixed order, so that no step is of one document alone.
STRETCH = 1_024
#: Smoothing of the base score, a fixed value.
ADD = 0.1
#: The end token; no word is empty.
END = b""


def parts_of(texts: list[bytes]) -> Iterator[slice]:
    """Neighbouring texts of together about PART_BYTES."""
    at = held = 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= PART_BYTES or k + 1 == len(texts):
            yield slice(at, k + 1)
            at, held = k + 1, 0


def words_in(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after the other, as :func:`tablecraft.llm.text.words_of` has them, and how many each text has.

    Arrow's kernels for ASCII leave all other bytes as they are.
    """
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pa.array(texts, pa.binary()).view(pa.string())))
    words, ends = lists.flatten(), lists.offsets.to_numpy()
    real = pc.binary_length(words).to_numpy() > 0  # space at either end of a text gives an empty word
    if real.all():
        return words, np.diff(ends)
    return words.filter(pa.array(real)), np.diff(np.concatenate([[0], np.cumsum(real)])[ends])


def count_words(train: DataFrame) -> DataFrame:
    """``(word, n)`` over all texts of ``_text``, the end token included; tasks add up before they send."""

    def worker(batches):
        for b in batches:
            for part in parts_of(b["_text"]):
                texts = b["_text"][part]
                found = pc.value_counts(words_in(texts)[0])
                yield {"word": found.field("values").view(pa.binary()), "n": found.field("counts")}
                yield {"word": [END], "n": [len(texts)]}

    fields = [T.StructField("word", T.BinaryType()), T.StructField("n", T.LongType())]
    return map_rows(train.select("_text"), fields, worker).groupBy("word").agg(F.sum("n").alias("n")).filter("n > 0")


def first_letter(word: bytes) -> bytes:
    lead = word[0]
    return word[: 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4]


@dataclass
class Vocabulary:
    """What tasks know of the counts. Sizes are bounded by KNOWN and by the number of letters."""

    ranks: dict[bytes, int]
    counts: np.ndarray
    head: int
    letters: dict[bytes, int]
    mass: np.ndarray
    kinds: np.ndarray
    discount: float
    total: int
    distinct: int

    def __post_init__(self):
        self.head_classes = -(-self.head // CLASS_WORDS)
        self.classes = self.head_classes + len(self.mass)
        words = list(self.ranks)
        self.words = pa.array(words, pa.binary()).view(pa.string())
        #: Input number and class of each known word.
        self.symbol = np.arange(len(words), dtype=np.int32)
        self.symbol[self.head :] = [self.head + self.tail_class(w) for w in words[self.head :]]
        tail = self.symbol[self.head :] - self.head
        self.inner = np.zeros(len(words))
        self.inner[self.head :] = np.log10((self.counts[self.head :] - self.discount) / (self.mass[tail] + 1))
        self.base = np.log10(self.counts + ADD)
        self.inputs = self.head + len(self.mass) + 1
        numbers = np.arange(self.inputs)
        self.class_of = np.where(numbers < self.head, numbers // CLASS_WORDS, numbers - self.head + self.head_classes).astype(np.int16)

    def tail_class(self, word: bytes) -> int:
        return self.letters.get(first_letter(word), len(self.mass) - 1)

    def tail_classes(self, words: pa.Array) -> np.ndarray:
        """Tail classes of binary words without gaps or nulls; those that begin with ASCII by their first byte."""
        ends = np.frombuffer(words.buffers()[1], np.int32, len(words) + 1, 4 * words.offset)
        lead = np.frombuffer(words.buffers()[2], np.uint8)[ends[:-1]] if len(words) else np.zeros(0, np.uint8)
        out = np.array([self.letters.get(bytes([k]), len(self.mass) - 1) for k in range(128)], np.int32)[lead & 127]
        wide = np.flatnonzero(lead > 127)
        out[wide] = [self.tail_class(w) for w in words.take(pa.array(wide)).to_pylist()]
        return out

    def unseen(self, tail: int) -> float:
        return float(np.log10((self.discount * self.kinds[tail] + 1) / (self.mass[tail] + 1)))

    def class_mass(self) -> np.ndarray:
        own = np.add.reduceat(self.counts[: self.head], np.arange(0, self.head, CLASS_WORDS)) if self.head else np.zeros(0)
        return np.concatenate([own, self.mass]) + 1.0


def frequent_words(counts: DataFrame, head: int = HEAD, known: int = KNOWN) -> DataFrame:
    """At most ``known`` words, the most frequent ones: all above a count, so that no task sorts more than these.

    Words of the count at the edge are left out together; they are rare words then.
    Only where that leaves fewer than ``head`` words are the first ``head`` sorted out.
    """
    # Counts up to 4096 one by one, larger ones in steps of 2%: a few thousand rows.
    step = F.when(F.col("n") < 4096, F.col("n")).otherwise(4096 + F.floor(F.log2(F.col("n") / 4096) * 32)).cast("long")
    sizes = counts.groupBy(step.alias("step")).agg(F.count("*").alias("kinds")).orderBy(F.desc("step")).collect()
    held = least = 0
    for r in sizes:
        if held + r.kinds > known:
            break
        held, least = held + r.kinds, r.step
    if held >= head or held == sum(r.kinds for r in sizes):
        return counts.filter(step >= least)
    return counts.orderBy(F.desc("n"), "word").limit(head)


def build_vocabulary(counts: DataFrame, head: int = HEAD, known: int = KNOWN) -> Vocabulary:
    """At most ``known`` words and one row per letter come to the driver."""
    top = frequent_words(counts, head, known).orderBy(F.desc("n"), "word").toArrow()
    words, n = top.column("word").to_pylist(), top.column("n").to_numpy().astype(np.float64)
    head = min(head, len(words))
    # END is a head word whatever its rank: it has no first letter.
    if END in words[head:]:
        at = words.index(END)
        words.insert(head - 1, words.pop(at))
        n = np.insert(np.delete(n, at), head - 1, n[at])
    all_of = counts.agg(F.sum("n"), F.count("*")).first()
    heads = counts.sparkSession.createDataFrame([(w,) for w in words[:head]], "word binary")
    tail = counts.join(F.broadcast(heads), "word", "left_anti")
    letter = F.substring(F.col("word").cast("string"), 1, 1)
    per = tail.groupBy(letter.alias("letter")).agg(
        F.sum("n").alias("n"), F.count("*").alias("kinds"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("once"),
        F.sum(F.when(F.col("n") == 2, 1).otherwise(0)).alias("twice"),
    ).orderBy(F.desc("n"), "letter").collect()
    own = per[: TAIL_CLASSES - 1]
    rest = per[TAIL_CLASSES - 1 :]
    mass = np.array([r.n for r in own] + [sum(r.n for r in rest)], float)
    kinds = np.array([r.kinds for r in own] + [sum(r.kinds for r in rest)], float)
    once, twice = sum(r.once for r in per), sum(r.twice for r in per)
    discount = min(0.9, max(0.1, once / (once + 2 * twice))) if once + twice else 0.5
    return Vocabulary(
        dict(zip(map(bytes, words), range(len(words)))), n, head, {r.letter.encode(): i for i, r in enumerate(own)},
        mass, kinds, discount, int(all_of[0] or 0), int(all_of[1]),
    )


class Network:
    """Gated recurrent unit over input numbers, softmax over classes and over words of head classes."""

    def __init__(self, v: Vocabulary, weights: dict[str, np.ndarray] | None = None):
        self.v = v
        if weights is None:
            rng = np.random.default_rng(7)
            mass = v.class_mass()
            bias = np.full(v.head_classes * CLASS_WORDS, -30.0)
            bias[: v.head] = np.log(np.maximum(v.counts[: v.head], ADD))
            weights = {
                "inputs": rng.normal(0, 0.1, (v.inputs, 3 * HIDDEN)), "state": rng.normal(0, HIDDEN**-0.5, (HIDDEN, 3 * HIDDEN)),
                "classes": np.zeros((HIDDEN, v.classes)), "class_bias": np.log(mass / mass.sum()),
                "words": np.zeros((v.head_classes * CLASS_WORDS, HIDDEN)), "word_bias": bias,
            }
        self.w = {k: np.asarray(x, np.float32) for k, x in weights.items()}
        self.moments: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        self.steps = 0

    def gates(self):
        """Table of the inputs, and that of the state turned, gates side by side: update, reset, new.

        Those of the first two are halved, as their sigmoid is taken by tanh of the half.
        """
        half = np.repeat(np.array([0.5, 0.5, 1.0], self.w["state"].dtype), HIDDEN)
        return self.w["inputs"] * half, np.ascontiguousarray((self.w["state"] * half).T)

    def step(self, x, h, state, g, n, new):
        """The next state, with what it came from, into ``g`` (gates and the state's part of the third), ``n`` and ``new``.

        A column per lane, so that what belongs to a gate lies in one piece; ``x`` has a row per lane.
        """
        np.matmul(state, h, out=g)
        gates, z, r, rest = g[: 2 * HIDDEN], g[:HIDDEN], g[HIDDEN : 2 * HIDDEN], g[2 * HIDDEN :]
        x = np.ascontiguousarray(x.T)
        gates += x[: 2 * HIDDEN]
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(r, rest, out=n)
        n += x[2 * HIDDEN :]
        np.tanh(n, out=n)
        np.subtract(h, n, out=new)
        new *= z
        new += n
        return new

    def layers(self):
        """The words' weights turned, by class, and whether logits may be beyond FAR: states lie between -1 and 1."""
        w = self.w
        words = np.ascontiguousarray(w["words"].reshape(-1, CLASS_WORDS, HIDDEN).swapaxes(1, 2))
        reach = np.abs(w["classes"]).sum(axis=0) + np.abs(w["class_bias"]), np.abs(w["words"]).sum(axis=1) + np.abs(w["word_bias"])
        return words, max(x.max(initial=0) for x in reach) > FAR

    def outputs(self, hs, targets, grads=None, layers=None, rows=None):
        """Natural-log chance of each target given its state; with ``grads`` also the gradient of the loss.

        Targets are taken by class, TOGETHER at a time. ``rows``: those of the targets in ``hs``, if not all.
        """
        w, own = self.w, self.v.class_of[targets]
        words, far = layers or self.layers()
        order = np.argsort(own, kind="stable")
        rows, whole = order if rows is None else rows[order], len(hs)
        own, hit, hs = own[order], targets[order] % CLASS_WORDS, hs[rows]
        out = np.empty(len(hs), hs.dtype)
        turned, back = np.ascontiguousarray(w["classes"].T), np.empty_like(hs)
        biases = w["word_bias"].reshape(-1, CLASS_WORDS)
        for a in range(0, len(hs), TOGETHER):
            x, at = hs[a : a + TOGETHER], own[a : a + TOGETHER]
            p = x @ w["classes"]
            p += w["class_bias"]
            out[a : a + len(x)], norm = _softmax(p, at, far)
            if grads is not None:
                _less_hits(p, at, norm)
                grads["classes"] += x.T @ p
                grads["class_bias"] += np.ones(len(x), p.dtype) @ p
                np.matmul(p, turned, out=back[a : a + len(x)])
            # targets of a class are neighbours; those of the head come first
            first, last = at[0], min(at[-1] + 1, self.v.head_classes)
            ends = np.searchsorted(at, np.arange(first, last + 1)).tolist() if first < last else [0]
            if not ends[-1]:
                continue
            x, at = x[: ends[-1]], slice(a, a + ends[-1])
            spans = [(c, slice(i, j)) for c, i, j in zip(range(first, last), ends, ends[1:]) if i < j]
            q = np.empty((len(x), CLASS_WORDS), hs.dtype)
            for c, part in spans:
                np.matmul(x[part], words[c], out=q[part])
            q += biases.take(own[at], axis=0)
            inner, norm = _softmax(q, hit[at], far)
            out[at] += inner
            if grads is not None:
                _less_hits(q, hit[at], norm)
                flow, ones = np.empty_like(x), np.ones(len(x), x.dtype)
                for c, part in spans:
                    block, some = slice(c * CLASS_WORDS, (c + 1) * CLASS_WORDS), q[part]
                    grads["words"][block] += some.T @ x[part]
                    grads["word_bias"][block] += ones[part] @ some
                    np.matmul(some, w["words"][block], out=flow[part])
                back[at] += flow
        return _placed(out, order, len(order)) if grads is None else (_placed(out, order, len(order)), _placed(back, rows, whole))

    def window(self, inputs, fresh, h, targets, live):
        """Loss gradient over one window of truncated backpropagation; returns the state after it."""
        w, (steps, lanes) = self.w, inputs.shape
        table, state = self.gates()
        keep, starts = (~fresh).astype(state.dtype), fresh.any(axis=1)
        before, n, hs = np.empty((3, steps, HIDDEN, lanes), state.dtype)
        gates = np.empty((steps, 3 * HIDDEN, lanes), state.dtype)
        h = h.T
        for t in range(steps):
            np.multiply(h, keep[t], out=before[t])
            h = self.step(table.take(inputs[t], axis=0), before[t], state, gates[t], n[t], hs[t])
        grads = {k: np.zeros_like(x) for k, x in w.items()}
        at = np.flatnonzero(live)
        out, back = self.outputs(hs.swapaxes(1, 2).reshape(-1, HIDDEN), targets.ravel()[at], grads, rows=at)
        dhs = np.ascontiguousarray(back.reshape(steps, lanes, HIDDEN).swapaxes(1, 2))
        # what a state's gradient is multiplied by, for all steps at once
        z, r, g = (gates[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(3))
        by_z, by_n, by_r, rest = before - n, n * n, 1 - r, 1 - z
        by_z *= z
        by_z *= rest
        np.subtract(1, by_n, out=by_n)
        by_n *= rest
        by_r *= r
        by_r *= g
        # one below the other: the first three are of the inputs, the last three of the state
        flow = np.empty((steps, 4 * HIDDEN, lanes), state.dtype)
        dn, dz, dr, dg = (flow[:, k * HIDDEN : (k + 1) * HIDDEN] for k in range(4))
        dh = np.zeros_like(dhs[0])
        for t in reversed(range(steps)):
            dh += dhs[t]
            np.multiply(dh, by_z[t], out=dz[t])
            np.multiply(dh, by_n[t], out=dn[t])
            np.multiply(dn[t], by_r[t], out=dr[t])
            np.multiply(dn[t], r[t], out=dg[t])
            dh *= z[t]
            dh += w["state"] @ flow[t, HIDDEN:]
            if starts[t]:
                dh *= keep[t]
        grads["state"] = np.matmul(flow[:, HIDDEN:], before.swapaxes(1, 2)).sum(axis=0).T
        rows = np.empty((steps, lanes, 3 * HIDDEN), state.dtype)
        for k, part in enumerate((dz, dr, dn)):
            rows[:, :, k * HIDDEN : (k + 1) * HIDDEN] = part.swapaxes(1, 2)
        used, sums = sums_by(inputs.ravel()[at], rows.reshape(-1, 3 * HIDDEN), at)
        grads["inputs"][used] = sums
        return h.T.copy(), grads, float(-out.sum()), len(out)

    def train(self, docs: list[np.ndarray], passes: int = PASSES, lanes: int = TRAIN_LANES) -> int:
        """Adam over windows of lanes of documents; returns the number of tokens seen in a pass.

        States are carried over the windows of a stretch.  A step waits until half of a full
        window's tokens are seen: where few lanes go on, their windows are one step together.
        """
        docs = [d[a : a + STRETCH] for d in docs for a in range(0, len(d), STRETCH)]
        docs = [docs[i] for i in np.random.default_rng(len(docs)).permutation(len(docs))]
        lanes = min(lanes, max(1, len(docs)))
        tokens = 0
        for _ in range(passes):
            tokens = 0
            ids, fresh, _ = lay_out(docs, lanes, self.v.inputs - 1, mixed=True)
            h = np.zeros((ids.shape[1], HIDDEN), np.float32)
            active = np.array([np.flatnonzero(~c)[-1] for c in fresh.T])
            sums, seen = None, 0
            for t in range(0, len(ids) - 1, WINDOW):
                width = int(np.count_nonzero(active > t))  # lanes are in falling order of length
                part = slice(t, min(t + WINDOW, len(ids) - 1))
                ahead = slice(part.start + 1, part.stop + 1)
                h, grads, _, n = self.window(ids[part, :width], fresh[part, :width], h[:width], ids[ahead, :width], ~fresh[ahead, :width])
                sums = grads if sums is None else {k: sums[k] + g for k, g in grads.items()}
                seen += n
                if 2 * seen >= lanes * WINDOW or part.stop == len(ids) - 1 and seen:
                    self.descend(sums, seen)
                    tokens, sums, seen = tokens + seen, None, 0
        return tokens

    def descend(self, grads: dict[str, np.ndarray], n: int) -> None:
        """One step of Adam by gradients summed over n tokens."""
        if not self.moments:
            self.moments = {k: (np.zeros_like(x), np.zeros_like(x)) for k, x in self.w.items()}
        self.steps += 1
        size = np.sqrt(sum(float(g @ g) for g in map(np.ravel, grads.values()))) / n
        scale = min(1.0, CLIP / max(size, 1e-12)) / n
        # moments of ten and a hundred times the size, with what sets them right in two factors
        root = np.sqrt((1 - 0.99**self.steps) / 0.01)
        rate = RATE * 0.1 / (1 - 0.9**self.steps) * root
        for name, g in grads.items():
            first, second = self.moments[name]
            g *= scale
            first *= 0.9
            first += g
            second *= 0.99
            g *= g
            second += g
            np.sqrt(second, out=g)
            g += 1e-6 * root
            np.divide(first, g, out=g)
            g *= rate
            self.w[name] -= g

    def score(self, docs: list[np.ndarray]) -> np.ndarray:
        """Log10 chance of each document's classes and head words, states carried over windows."""
        if not docs:
            return np.zeros(0)
        ids, fresh, owner = lay_out(docs, min(LANES, len(docs)), self.v.inputs - 1)
        total = np.zeros(len(docs))
        h = np.zeros((HIDDEN, ids.shape[1]), np.float32)
        active = np.array([np.flatnonzero(~c)[-1] for c in fresh.T])
        table, state = self.gates()
        layers = self.layers()
        for t in range(0, len(ids) - 1, WINDOW):
            steps = min(WINDOW, len(ids) - 1 - t)
            width = int(np.count_nonzero(active > t))  # lanes are in falling order of length
            h, hs = h[:, :width], np.empty((steps, HIDDEN, width), np.float32)
            g, n = np.empty((3 * HIDDEN, width), np.float32), np.empty((HIDDEN, width), np.float32)
            keep = (~fresh[t : t + steps, :width]).astype(np.float32)
            for s in range(steps):
                h = self.step(table.take(ids[t + s, :width], axis=0), h * keep[s], state, g, n, hs[s])
            use = ~fresh[t + 1 : t + 1 + steps, :width]
            out = self.outputs(hs.swapaxes(1, 2)[use], ids[t + 1 : t + 1 + steps, :width][use], layers=layers)
            total += np.bincount(owner[t + 1 : t + 1 + steps, :width][use], out, len(docs))
        return total / np.log(10)


def _softmax(p: np.ndarray, hit: np.ndarray, far: bool) -> tuple[np.ndarray, np.ndarray]:
    """Exponentials in place of the rows of ``p``; the log share of column ``hit`` of each, and the sums. ``far``: they may be beyond FAR."""
    if far:
        p -= p.max(axis=1, keepdims=True)
    own = p.reshape(-1).take(np.arange(len(p)) * p.shape[1] + hit)
    np.exp(p, out=p)
    norm = p @ np.ones(p.shape[1], p.dtype)
    return own - np.log(norm), norm


def _less_hits(p: np.ndarray, hit: np.ndarray, norm: np.ndarray) -> None:
    """Exponentials made shares, less one in column ``hit``: the gradient of the loss."""
    p *= (1 / norm)[:, None]
    p.reshape(-1)[np.arange(len(p)) * p.shape[1] + hit] -= 1


def _placed(values: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """``values`` at their places among ``n``, zero elsewhere."""
    out = np.zeros((n, *values.shape[1:]), values.dtype)
    out[at] = values
    return out


def sums_by(keys: np.ndarray, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each key once, the most frequent first, and the sum of its rows; ``at`` has the row of each key."""
    keys = keys.astype(np.int16)
    order = np.argsort(keys, kind="stable")
    keys, at = keys[order], at[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    sizes = np.diff(starts, append=len(keys))
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    sums = np.zeros((len(starts), rows.shape[1]), rows.dtype)
    many = int(np.count_nonzero(sizes >= MANY_ROWS))
    ones = np.ones(sizes.max(initial=0), rows.dtype)
    for k, (a, n) in enumerate(zip(starts[:many].tolist(), sizes[:many].tolist())):
        np.matmul(ones[:n], rows[at[a : a + n]], out=sums[k])
    for j in range(MANY_ROWS - 1):  # the others: first rows, second rows and so on
        more = int(np.count_nonzero(sizes > j))
        sums[many:more] += rows[at[starts[many:more] + j]]
    return keys[starts], sums


def lay_out(docs: list[np.ndarray], lanes: int, start: int, mixed: bool = False):
    """Documents end to end in lanes, each after a start mark: ids, fresh (no target), owner.

    Longest first (``mixed``: in the order given), each to the shortest lane; lanes come in
    falling order of length.
    """
    heap = [(0, i, []) for i in range(lanes)]
    for d in range(len(docs)) if mixed else sorted(range(len(docs)), key=lambda d: -len(docs[d])):
        size, i, own = heap[0]
        own.append(d)
        heapq.heapreplace(heap, (size + len(docs[d]) + 1, i, own))
    rows = sorted(heap, key=lambda x: (-x[0], x[1]))
    ids = np.full((rows[0][0], lanes), start, np.int32)
    owner = np.zeros(ids.shape, np.int32)
    for lane, (_, _, own) in enumerate(rows):
        at = 0
        for d in own:
            end = at + 1 + len(docs[d])
            ids[at + 1 : end, lane], owner[at:end, lane] = docs[d], d
            at = end
    return ids, ids == start, owner


@dataclass
class Encoded:
    """Texts as numbers: ``symbols`` are the input numbers of each text with its end.

    ``ranks`` are those of the known words, ``owner`` the texts they are in.  Of the other
    words, ``unknown`` has the different ones and ``tails`` their classes; ``at`` says which
    ones follow each other, ``within`` the texts they are in.
    """

    symbols: list[np.ndarray]
    ranks: np.ndarray
    owner: np.ndarray
    unknown: pa.Array
    tails: np.ndarray
    at: np.ndarray
    within: np.ndarray

    def rare_counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each text and unknown word in it, by text: the text, the word's place in ``unknown``, how often."""
        pairs, k = np.unique(self.within.astype(np.int64) * max(1, len(self.unknown)) + self.at, return_counts=True)
        return *np.divmod(pairs, max(1, len(self.unknown))), k

    @property
    def rare(self) -> list[Counter]:
        """The unknown words of each text with their counts."""
        own, words = [Counter() for _ in self.symbols], self.unknown.to_pylist()
        for text, word, k in zip(*(x.tolist() for x in self.rare_counts())):
            own[text][words[word]] = k
        return own

    def rare_lists(self, kind: pa.DataType) -> pa.Array:
        """The unknown words of each text as structs ``word``, ``k`` and ``tail``; null where there are none."""
        text, word, k = self.rare_counts()
        structs = pa.StructArray.from_arrays(
            [self.unknown.take(pa.array(word)), pa.array(k.astype(np.int32)), pa.array(self.tails[word].astype(np.int32))],
            fields=list(kind.value_type),
        )
        ends = np.searchsorted(text, np.arange(len(self.symbols) + 1)).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), structs, type=kind, mask=pa.array(np.diff(ends) == 0))


def encode_words(words: pa.Array, counts: np.ndarray, v: Vocabulary) -> Encoded:
    """Texts given by their words one after the other and the number of words of each."""
    ranks = pc.fill_null(pc.index_in(words, value_set=v.words), -1).to_numpy()
    owner, known = np.repeat(np.arange(len(counts), dtype=np.int32), counts), ranks >= 0
    others = words.filter(pa.array(~known)).dictionary_encode()
    unknown, at = others.dictionary.view(pa.binary()), others.indices.to_numpy()
    tails = v.tail_classes(unknown)
    coded = np.empty(len(ranks), np.int32)
    coded[known] = v.symbol[ranks[known]]
    coded[~known] = v.head + tails[at]
    ends = np.cumsum(counts)
    flat = np.insert(coded, ends, v.ranks.get(END, v.head + len(v.mass) - 1))
    cuts = np.concatenate([[0], ends + np.arange(1, len(counts) + 1)])
    return Encoded([flat[a:b] for a, b in zip(cuts, cuts[1:])], ranks[known], owner[known], unknown, tails, at, owner[~known])


def encode(words: list[bytes], v: Vocabulary) -> tuple[np.ndarray, np.ndarray, dict[bytes, int]]:
    """Input numbers of a text with its end, ranks of its known words, and its rare words with their counts."""
    done = encode_words(pa.array(words, pa.binary()).view(pa.string()), np.array([len(words)]), v)
    return done.symbols[0], done.ranks, done.rare[0]


def rounds_for(tokens: int) -> int:
    """Rounds of averaging for so many training tokens."""
    replicas = tokens / max(1, ROUNDS) / REPLICA_TOKENS
    return ROUNDS + int(np.ceil(np.log(replicas / MANY) / np.log(8))) if ROUNDS and replicas > MANY else ROUNDS


def train_network(train: DataFrame, v: Vocabulary) -> dict[str, np.ndarray]:
    """Rounds of local training from the same weights, averaged by the tokens of each task; together they see every row."""
    net = Network(v)
    shapes = {k: x.shape for k, x in net.w.items()}
    size = sum(x.size for x in net.w.values())
    rounds = rounds_for(v.total)
    replicas = min(MOST, max(1, round(v.total / max(1, rounds) / REPLICA_TOKENS)))
    for k in range(rounds):
        # Drawn and dealt out by row, not by text: copies of a document spread over shards and tasks.
        shard = train.filter(F.pmod(F.xxhash64("_row", "_text"), F.lit(rounds)) == k).select("_text")
        weights = net.w

        def worker(batches, weights=weights):
            own, docs, held, n = Network(v, weights), [], 0, 0
            for texts in (b["_text"][part] for b in batches for part in parts_of(b["_text"])):
                docs += encode_words(*words_in(texts), v).symbols
                held = sum(map(len, docs))
                if held >= 1.5 * REPLICA_TOKENS:
                    n += own.train(docs)
                    docs, held = [], 0
            n += own.train(docs) if docs else 0
            if n:
                flat = np.concatenate([x.ravel() for x in own.w.values()])
                yield {"at": pa.array(np.arange(size, dtype=np.int32)), "value": pa.array(flat.astype(np.float64) * n), "n": pa.array(np.full(size, float(n)))}

        fields = [T.StructField("at", T.IntegerType()), T.StructField("value", T.DoubleType()), T.StructField("n", T.DoubleType())]
        mean = (
            map_rows(shard.repartition(replicas), fields, worker)
            .groupBy("at").agg((F.sum("value") / F.sum("n")).alias("value")).orderBy("at").toArrow()
        )
        if mean.num_rows:  # one row per weight
            flat, at, new = mean.column("value").to_numpy(), 0, {}
            for name, shape in shapes.items():
                new[name] = flat[at : at + int(np.prod(shape))].reshape(shape)
                at += int(np.prod(shape))
            net = Network(v, new)
    return net.w


def held_together(parts: Iterator[tuple[dict, list[np.ndarray]]]) -> Iterator[list[tuple[dict, list[np.ndarray]]]]:
    """Neighbouring parts until their texts have SCORED_TOKENS."""
    held, tokens = [], 0
    for part in parts:
        held.append(part)
        tokens += sum(map(len, part[1]))
        if tokens >= SCORED_TOKENS:
            yield held
            held, tokens = [], 0
    if held:
        yield held


def score_documents(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row; the model learns from rows where ``held_out`` (a column) is false.

    Columns: id, held_out, n_tokens, n_known, train_tokens, base_score, score.  Null
    and empty texts are their end token.  Without training rows nothing is known:
    both scores then come from the smoothing alone.
    """
    rows = docs.select(F.col(id_col), held_out.alias("held_out"), as_bytes(text_col).alias("_text"))
    train = rows.filter("NOT held_out").select(F.col(id_col).alias("_row"), "_text")
    counts = written(count_words(train), "word-counts")
    v = build_vocabulary(counts)
    weights = train_network(train, v)
    base_norm = float(np.log10(v.total + ADD * (v.distinct + 1)))

    def encoded(batches):
        """Parts of rows with all but the network's share of their scores, and their texts as numbers."""
        for b in batches:
            for part in parts_of(b["_text"]):
                done = encode_words(*words_in(b["_text"][part]), v)
                counts = np.array([len(x) - 1 for x in done.symbols])
                end, texts, tail = v.ranks.get(END), len(counts), done.ranks >= v.head
                sums = lambda of, values: np.bincount(of, values, texts)
                base = sums(done.owner, v.base[done.ranks]) + (v.base[end] if end is not None else np.log10(ADD)) - (counts + 1) * base_norm
                yield {
                    **{n: b[n][part] for n in (id_col, "held_out", "row")}, "n_tokens": pa.array(counts + 1),
                    "n_known": pa.array(np.bincount(done.owner, minlength=texts) + (end is not None)), "base_score": pa.array(base),
                    "score": sums(done.owner[tail], v.inner[done.ranks[tail]]), "rare": done.rare_lists(rare_arrow),
                }, done.symbols

    def worker(batches):
        net = Network(v, weights)
        for held in held_together(encoded(batches)):
            scores, at = net.score([x for _, symbols in held for x in symbols]), 0
            for out, symbols in held:
                yield out | {"score": pa.array(out["score"] + scores[at : at + len(symbols)])}
                at += len(symbols)

    rare_type = T.ArrayType(T.StructType([
        T.StructField("word", T.BinaryType()), T.StructField("k", T.IntegerType()), T.StructField("tail", T.IntegerType()),
    ]))
    rare_arrow = to_arrow_type(rare_type)
    fields = [
        *fields_of(rows, id_col, "held_out"), T.StructField("row", T.LongType()), T.StructField("n_tokens", T.LongType()),
        T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
        T.StructField("rare", rare_type),
    ]
    # The row number is written with the row, so it stays the same in both uses.
    scored = written(map_rows(rows.withColumn("row", F.monotonically_increasing_id()), fields, worker), "scored")
    rare = scored.filter("rare IS NOT NULL").select("row", F.inline("rare"))
    found = rare.join(counts, "word", "left")
    # One value per tail class.
    of_class = lambda values: F.element_at(F.array(*[F.lit(float(x)) for x in values]), F.col("tail") + 1)
    unseen, norm = of_class([v.unseen(k) for k in range(len(v.mass))]), of_class(np.log10(v.mass + 1))
    inner = F.when(F.col("n").isNull(), unseen).otherwise(F.log10(F.col("n") - v.discount) - norm)
    late = found.groupBy("row").agg(
        F.sum(F.when(F.col("n").isNull(), 0).otherwise(F.col("k"))).alias("_known"),
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + ADD)).alias("_base"), F.sum(F.col("k") * inner).alias("_inner"),
    )
    add = lambda name, more: (F.col(name) + F.coalesce(more, F.lit(0))).alias(name)
    return scored.drop("rare").join(late, "row", "left").select(
        id_col, "held_out", "n_tokens", add("n_known", "_known"), F.lit(v.total).cast("long").alias("train_tokens"),
        add("base_score", "_base"), add("score", "_inner"),
    )
