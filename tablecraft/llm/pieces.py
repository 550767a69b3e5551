"""SentencePiece ids of whole texts, by vectorised merge rounds, and texts of ids.

The model file is read once, where the query starts; tasks get its merges as sorted
arrays.  A text is cut where no piece can reach across: before a blank that follows
something else, and at characters that no longer piece holds.  What lies between is a
word.  Equal words of a slice of rows are found by sorting pointers to them, and a task
merges each distinct word once, all new ones side by side in flat numpy arrays:

* every two neighbours are looked up in the table of merges, which gives the rank of
  the piece they make;
* a word's round takes its least rank, at all places from left to right that do not
  overlap.  One place at a time is what the model means, so a word stops after the
  first place whose new piece has a neighbour of the same or a lesser rank: that merge
  would come before the next place;
* words without a pair leave, the others move together, until none is left.

Characters outside the vocabulary become their bytes.  Supported are models of the
byte-pair kind with byte fallback that leave texts as they are but for blanks.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm.multikey import padded, sorted_runs
from tablecraft.llm.text import as_bytes

#: Fixed values of the format.
BLANK, UNKNOWN_TEXT = "▁", " ⁇ "
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BPE = 2
#: Bytes of text that a task cuts and merges at once; a longer text is a slice of its own.
SLICE_BYTES = 1_000_000
#: More words than this are forgotten together; longer words are not kept.
CACHE_WORDS, CACHE_BYTES = 150_000, 64

_NONE = np.int32(2**31 - 1)
#: Slots of the table of merges for each merge, at least.
_SPARE = 8
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_CODES = 0x110000


@dataclass
class Merges:
    """Bounded by the vocabulary: what tasks need to encode and to decode."""

    chars: np.ndarray  # code points of one-character pieces
    char_ids: np.ndarray
    slots: np.ndarray  # hash table of left id * (pieces + code points) + right id, -1 where free
    made: np.ndarray  # by slot: id of the piece that the pair makes
    ranks: np.ndarray  # by slot: rank of that piece; equal scores have equal ranks
    joined: np.ndarray  # first * 2^21 + second code point of neighbours inside some piece, ascending
    texts: list[bytes]  # what each id stands for
    kinds: np.ndarray
    byte_ids: list[int]
    blank_first: np.ndarray  # ids whose piece begins with a blank
    cut_blanks: bool  # no piece holds a blank after something else
    cut_lines: bool  # no longer piece holds a line end

    @property
    def size(self) -> int:
        return len(self.texts)


def _home(keys: np.ndarray, slots: int) -> np.ndarray:
    """Where a key's search begins; slots are a power of two."""
    return ((keys.astype(np.uint64) * _SPREAD) >> np.uint64(65 - slots.bit_length())).astype(np.int64)


def _table(keys: np.ndarray) -> tuple[np.ndarray, int]:
    """Slot of each distinct key, the first free one from its home on, and the number of slots."""
    slots = 1 << (len(keys) * _SPARE).bit_length()
    taken, place, todo = np.zeros(slots, bool), np.empty(len(keys), np.int64), np.arange(len(keys))
    at = _home(keys, slots)
    while len(todo):
        free = ~taken[at]
        _, first = np.unique(at, return_index=True)
        wins = np.zeros(len(todo), bool)
        wins[first] = True
        wins &= free
        place[todo[wins]] = at[wins]
        taken[at[wins]] = True
        todo, at = todo[~wins], (at[~wins] + 1) % slots
    return place, slots


def read_merges(path: str) -> Merges:
    """The merges of a model file."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm, kinds = model.normalizer_spec, [p.type for p in model.pieces]
    plain = norm.name == "identity" and not norm.precompiled_charsmap and norm.add_dummy_prefix and norm.escape_whitespaces
    bpe = model.trainer_spec.model_type == BPE and model.trainer_spec.byte_fallback and not model.trainer_spec.treat_whitespace_as_suffix
    if not (plain and bpe) or norm.remove_extra_whitespaces or set(kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
        raise ValueError(f"{path}: only byte-pair models with byte fallback and unchanged texts are supported")
    ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
    if set("".join(ids)) - ids.keys():
        raise ValueError(f"{path}: a character of a piece is no piece")
    wide = len(kinds) + _CODES
    order = {s: r for r, s in enumerate(sorted({p.score for p in model.pieces if p.type == NORMAL}, reverse=True))}
    pairs = sorted(
        (ids[w[:k]] * wide + ids[w[k:]], i, order[model.pieces[i].score])
        for w, i in ids.items() for k in range(1, len(w)) if w[:k] in ids and w[k:] in ids
    )
    found = np.array(pairs, np.int64).reshape(-1, 3)
    place, size = _table(found[:, 0])
    keys, made, ranks = np.full(size, -1), np.full(size, -1, np.int32), np.full(size, _NONE)
    keys[place], made[place], ranks[place] = found.T
    single = sorted((ord(w), i) for w, i in ids.items() if len(w) == 1)
    joined = np.unique([(ord(a) << 21) + ord(b) for w in ids for a, b in zip(w, w[1:])])
    texts = []
    for i, p in enumerate(model.pieces):
        shown = {NORMAL: p.piece.replace(BLANK, " "), UNKNOWN: UNKNOWN_TEXT, CONTROL: ""}.get(p.type)
        texts.append(bytes([int(p.piece[1:-1], 16)]) if shown is None else shown.encode())
    of_byte = {texts[i][0]: i for i, k in enumerate(kinds) if k == BYTE}
    return Merges(
        np.array([c for c, _ in single]), np.array([i for _, i in single]), keys, made, ranks, joined, texts, np.array(kinds),
        [of_byte[b] for b in range(256)], np.array([p.piece.startswith(BLANK) for p in model.pieces]),
        not any(re.search(f"[^{BLANK}]{BLANK}", w) for w in ids), not any("\n" in w and len(w) > 1 for w in ids),
    )


class WordMerger:
    """``encode(texts)``: ids of UTF-8 texts one after the other, and where each text's ids end."""

    def __init__(self, merges: Merges):
        self.m = merges
        self.of_code = np.arange(_CODES, dtype=np.int64) + merges.size  # a code point outside the vocabulary is itself, above all ids
        self.of_code[merges.chars] = merges.char_ids
        self.words: dict[bytes, bytes] = {}

    def pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What neighbours make and its rank; ``_NONE`` where they make nothing."""
        key = left * (self.m.size + _CODES) + right
        slots = self.m.slots
        at = _home(key, len(slots))
        held = slots[at]
        other = np.flatnonzero((held != key) & (held >= 0))
        while len(other):
            at[other] = (at[other] + 1) & (len(slots) - 1)
            held[other] = slots[at[other]]
            other = other[(held[other] != key[other]) & (held[other] >= 0)]
        return self.m.made[at], np.where(held == key, self.m.ranks[at], _NONE)

    def stretches(self, codes: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Number of the stretch of each symbol: words, cut again between characters that no piece holds side by side."""
        beside = (codes[:-1] << 21) + codes[1:]
        at = np.minimum(np.searchsorted(self.m.joined, beside), len(self.m.joined) - 1)
        new = np.ones(len(codes), bool)
        new[1:] = (word[1:] != word[:-1]) | (self.m.joined[at] != beside)
        return (np.cumsum(new) - 1).astype(np.int32)

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian 32-bit numbers; no word is empty."""
        flat = b"".join(words)
        lead = (np.frombuffer(flat, np.uint8) & 0xC0) != 0x80
        begin = np.cumsum([0, *(len(w) for w in words[:-1])])
        codes = np.frombuffer(flat.decode().encode("utf-32-le"), "<u4").astype(np.int64)
        codes[codes == 32] = ord(BLANK)
        word = np.repeat(np.arange(len(words)), np.add.reduceat(lead.astype(np.int64), begin))
        symbols, part = self.of_code[codes], self.stretches(codes, word)
        place, done = np.arange(len(codes), dtype=np.int32), []
        last = np.append(part[1:] != part[:-1], True)
        made, rank = self.pairs(symbols, np.append(symbols[1:], 0))
        rank[last] = _NONE
        while len(symbols):
            starts = np.flatnonzero(np.append(True, last[:-1]))
            sizes = np.diff(np.append(starts, len(symbols)))
            least = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            live = least < _NONE
            if not live.all():
                done.append((place[~live], symbols[~live]))
            chosen = self.choose(symbols, part, made, rank, np.flatnonzero(live & (rank == least)))
            symbols[chosen] = made[chosen]
            fresh = np.zeros(len(symbols), bool)
            fresh[chosen] = fresh[np.maximum(chosen - 1, 0)] = True
            live[chosen + 1] = False
            symbols, part, place, made, rank, fresh = (x[live] for x in (symbols, part, place, made, rank, fresh))
            last = np.append(part[1:] != part[:-1], True)[: len(part)]
            rank[fresh & last] = _NONE
            at = np.flatnonzero(fresh & ~last)
            made[at], rank[at] = self.pairs(symbols[at], symbols[at + 1])
        return self.gathered(len(words), word, done)

    def choose(self, symbols, part, made, rank, at):
        """Of the places of each word's least rank those that merge in this round."""
        if not len(at):
            return at
        # Of overlapping places every second one, from the left.
        first = np.append(True, at[1:] != at[:-1] + 1)
        run = np.arange(len(at)) - np.flatnonzero(first)[np.cumsum(first) - 1]
        at = at[run % 2 == 0]
        own = part[at]
        again = np.append(own[1:] == own[:-1], False)
        if not again.any():
            return at
        # A later place waits where the new piece of an earlier one goes on merging before it.
        near = np.full(len(at), _NONE)
        new, here, size = made[at].astype(np.int64), rank[at], len(symbols)
        before = np.maximum(at - 1, 0)
        left = symbols[before]
        touch = np.flatnonzero(np.append(False, at[1:] == at[:-1] + 2))
        left[touch] = new[touch - 1]
        inside = (at > 0) & (part[before] == own)
        near[inside] = self.pairs(left[inside], new[inside])[1]
        after = np.minimum(at + 2, size - 1)
        inside = (at + 2 < size) & (part[after] == own)
        near[inside] = np.minimum(near[inside], self.pairs(new[inside], symbols[after[inside]])[1])
        stop = near <= here
        stops = np.cumsum(stop) - stop
        begin = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        base = np.repeat(stops[begin], np.diff(np.append(begin, len(at))))
        return at[stops == base]

    def gathered(self, n: int, word: np.ndarray, done: list) -> list[bytes]:
        """Symbols back in their places, code points outside the vocabulary as bytes."""
        place, symbols = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(place, kind="stable")
        place, symbols = place[order], symbols[order]
        strange = symbols >= self.m.size
        if strange.any():
            spelled = [[self.m.byte_ids[b] for b in chr(c - self.m.size).encode()] for c in symbols[strange].tolist()]
            counts = np.ones(len(symbols), np.int64)
            counts[strange] = [len(s) for s in spelled]
            wide = np.repeat(strange, counts)
            symbols, place = np.repeat(symbols, counts), np.repeat(place, counts)
            symbols[wide] = [i for s in spelled for i in s]
        ends = np.searchsorted(word[place], np.arange(n), side="right") * 4
        flat = symbols.astype("<i4").tobytes()
        return [flat[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def cut(self, buffer: np.ndarray, size: int, text_starts: np.ndarray) -> np.ndarray:
        """Where words start in texts that begin with a blank."""
        new = np.zeros(size, bool)
        new[text_starts] = True
        text = buffer[:size]
        if self.m.cut_blanks:
            blank = text == 32
            new[1:] |= blank[1:] & ~blank[:-1]
        if self.m.cut_lines:
            line = text == 10
            new |= line
            new[1:] |= line[:-1]
        return np.flatnonzero(new)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        shown = [b" " + t.replace(BLANK.encode(), b" ") if t else t for t in texts]
        size = np.array([len(t) for t in shown], np.int64)
        ends = np.cumsum(size)
        flat = b"".join(shown)
        if not flat:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        buffer = padded(flat)
        start = self.cut(buffer, len(flat), (ends - size)[size > 0])
        length = np.diff(np.append(start, len(flat)))
        # Equal words are runs of the pointers sorted by length and bytes.
        by_length = np.argsort(length.astype(np.uint16) if length.max() < 1 << 16 else length, kind="stable")
        order, new = sorted_runs(buffer, start[by_length], length[by_length], length[by_length])
        order = by_length[order]
        kind = np.empty(len(order), np.int64)
        kind[order] = np.cumsum(new) - 1
        first = order[new]
        words = [flat[a : a + n] for a, n in zip(start[first].tolist(), length[first].tolist())]
        missing = [w for w in words if w not in self.words]
        long = {}
        for w, ids in zip(missing, self.merge(missing) if missing else ()):
            (self.words if len(w) <= CACHE_BYTES else long)[w] = ids
        ids = [self.words.get(w) or long[w] for w in words]
        if len(self.words) > CACHE_WORDS:
            self.words = {}
        own = np.array([len(x) // 4 for x in ids])
        begin = (np.cumsum(own) - own)[kind]
        count = own[kind]
        total = np.cumsum(count)
        places = np.repeat(begin - (total - count), count) + np.arange(total[-1])
        words_before = np.searchsorted(start, ends)
        return np.frombuffer(b"".join(ids), "<i4")[places], np.append(0, total)[words_before]


def _each_byte(error: UnicodeError):
    return "�", error.start + 1


def text_of(ids: np.ndarray, merges: Merges) -> str:
    """The text of ids, as the library gives it: one leading blank goes, each invalid byte is U+FFFD."""
    if len(ids) and (ids.min() < 0 or ids.max() >= merges.size):
        raise ValueError(f"ids must be 0 to {merges.size - 1}")
    flat = b"".join(map(merges.texts.__getitem__, ids.tolist()))
    real = np.flatnonzero(merges.kinds[ids] != CONTROL)
    if len(real) and merges.blank_first[ids[real[0]]]:
        flat = flat[1:]
    try:
        return flat.decode()
    except UnicodeDecodeError:
        codecs.register_error("each-byte", _each_byte)
        return flat.decode(errors="each-byte")


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about SLICE_BYTES."""
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > SLICE_BYTES:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(sizes):
        yield start, len(sizes)


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """``docs`` with the ids of each whole text instead of the text, one row per row.

    Null and empty texts have no ids; repeated rows stay.  A column already named
    ``ids_col`` is replaced.  No begin or end ids are added.
    """
    merges = read_merges(path)
    kept = [c for c in docs.columns if c not in (text_col, ids_col)]
    schema = T.StructType([*(docs.schema[c] for c in kept), T.StructField(ids_col, T.ArrayType(T.IntegerType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger = WordMerger(merges)
        for batch in batches:
            texts = batch.column(len(kept))
            sizes = pc.binary_length(texts).to_pylist()
            for a, b in _slices(sizes):
                flat, ends = merger.encode(texts.slice(a, b - a).to_pylist())
                ids = pa.ListArray.from_arrays(pa.array(np.append(0, ends), pa.int32()), pa.array(flat, pa.int32()))
                columns = [batch.column(i).slice(a, b - a) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*columns, ids], names=[*kept, ids_col])

    return docs.select(*kept, as_bytes(text_col).alias("_text_of_pieces")).mapInArrow(run, schema)


def decode_ids(rows: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """``rows`` with the text of each list of ids in ``text_col``, all other columns kept.

    Null and empty lists give an empty text; an id outside the model is an error.
    """
    merges = read_merges(path)
    kept = [c for c in rows.columns if c != text_col]
    schema = T.StructType([*(rows.schema[c] for c in kept), T.StructField(text_col, T.StringType())])
    given = F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(kept))
            offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            texts = pa.array([text_of(flat[a:b], merges) for a, b in zip(offsets, offsets[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], texts], names=[*kept, text_col])

    return rows.select(*kept, given.alias("_ids_of_text")).mapInArrow(run, schema)


def digests(ids_col: str = "ids", text_col: str = "text") -> tuple[Column, Column, Column]:
    """Number of ids, SHA-256 of the ids as decimal numbers with commas, SHA-256 of the decoded text."""
    ids = F.array_join(F.col(ids_col).cast("array<string>"), ",")
    return (
        F.size(ids_col).cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col(text_col).cast("binary"), 256).alias("decoded_sha256"),
    )
