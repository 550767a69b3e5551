"""Quality rules: document statistics, two fixed rules and boosted trees for the rest."""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecraft.llm import trees
from tablecraft.llm.text import as_bytes, fields_of, map_rows
from tablecraft.plans.skew import join_keys
from tablecraft.plans.storage import written

#: Fixed values of the base rules.
LEAST_WORDS = 50
MOST_REPEATED = 50
SYMBOLS = b"#*$%&|<>"

#: Labelled documents that the trees are fitted on: those with the least hashes of their id.
SAMPLE = 20_000
#: Documents with at least this chance of being good are kept.
CUT = 0.5

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
#: Features and the direction in which each may move the chance of being good.
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "digit_share": 0, "punctuation_share": 0, "bang_share": -1, "bar_share": -1,
    "distinct_share": 0, "top_word_share": 0, "same_next_share": -1, "words_per_line": 0, "long_word_share": 0,
    "non_ascii_share": 0,
}
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_MARKS = b".,;:!?"


def count_repeats(words: list[bytes], size: int = 3) -> int:
    """Words inside windows of ``size`` words that the text holds twice or more, each word once."""
    windows = list(zip(*(words[i:] for i in range(size))))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    starts = np.fromiter((seen[w] > 1 for w in windows), bool, len(windows))
    covered = np.zeros(len(words), bool)
    for i in range(size):
        covered[i : len(windows) + i] |= starts
    return int(covered.sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The counts of the contract and the features, of one text."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    n, size = len(words), max(1, len(text))
    joined = b"".join(words)
    holds = lambda chars: len(text) - len(text.translate(None, chars))
    counts = [n, len(joined.decode()), holds(SYMBOLS), len(lines) - len(set(lines)), count_repeats(words)]
    tally = Counter(words)
    per = 1 / max(1, n)
    features = [
        np.log1p(n), counts[1] * per, counts[2] * per, counts[3] / max(1, len(lines)), counts[4] * per,
        holds(_UPPER) / size, holds(_DIGITS) / size, holds(_MARKS) / size, holds(b"!") * per, holds(b"|") * per,
        len(tally) * per, max(tally.values(), default=0) * per, sum(map(bytes.__eq__, words, words[1:])) * per,
        n / max(1, len(lines)), sum(len(w) > 20 for w in words) * per, 1 - len(text.decode()) / size,
    ]
    return counts, [float(v) for v in features]


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    def worker(batches):
        for b in batches:
            both = [statistics(t) for t in b["_text"]]
            out = {name: [c[i] for c, _ in both] for i, name in enumerate(COUNTS)}
            yield out | {id_col: b[id_col], "features": [f for _, f in both]}

    fields = [
        *fields_of(docs, id_col), *[T.StructField(c, T.LongType()) for c in COUNTS],
        T.StructField("features", T.ArrayType(T.DoubleType())),
    ]
    return map_rows(docs.select(id_col, as_bytes(text_col).alias("_text")), fields, worker)


def fit_trees(stats: DataFrame, labels: DataFrame, id_col: str = "doc_id", sample: int = SAMPLE) -> trees.Forest | None:
    """Trees for ``labels.quality``, or None where the sample lacks one of the two labels.

    At most ``sample`` labelled ids, so at most as many feature rows reach the driver
    (an id with several labels has their least; an id with several rows counts once).
    """
    chosen = (
        labels.filter("quality IS NOT NULL").groupBy(id_col).agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64(id_col), id_col).limit(sample)
    )
    rows = (
        join_keys(stats.select(id_col, "features"), chosen, [id_col], "inner")
        .groupBy(id_col).agg(F.min(F.struct("quality", "features")).alias("_row")).orderBy(id_col)
        .select("_row.*").collect()
    )
    y = np.array([r.quality for r in rows], float)
    if len(set(y)) < 2:
        return None
    return trees.fit(np.array([r.features for r in rows]), y, np.array(list(FEATURES.values())))


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE
) -> DataFrame:
    """One row per document row: id, the counts, base_failed, kept.

    A null or empty text has no words and fails the base rules.  Without labels of
    both kinds the base rules decide alone.
    """
    stats = written(document_statistics(docs, id_col, text_col), "statistics")
    forest = fit_trees(stats, labels, id_col, sample)

    def worker(batches):
        for b in batches:
            x = np.array(b["features"], float).reshape(-1, len(FEATURES))
            good = np.ones(len(x), bool) if forest is None else forest.chance(x) >= CUT
            yield {n: b[n] for n in (id_col, *COUNTS, "base_failed")} | {
                "kept": [not failed and bool(g) for failed, g in zip(b["base_failed"], good)]
            }

    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    fields = [
        *fields_of(stats, id_col, *COUNTS), T.StructField("base_failed", T.BooleanType()),
        T.StructField("kept", T.BooleanType()),
    ]
    return map_rows(stats.withColumn("base_failed", failed), fields, worker)


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose id is kept, all columns; an id is rejected if one of its rows is."""
    verdicts = judge(docs.select(id_col, text_col), labels, id_col, text_col)
    bad = verdicts.filter("NOT kept").select(id_col).distinct()
    return join_keys(docs, bad, [id_col], "left_anti")
