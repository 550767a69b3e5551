import random

from tablecraft.llm import spans
from common import WORDS


def run_of(rng, n):
    return [rng.choice(WORDS) + str(rng.randrange(900)) for _ in range(n)]


def test_passages_of_51_words_are_found_at_any_offset(spark):
    rng, rows, passages = random.Random(12), [], {}
    for k in range(200):
        passage = run_of(rng, rng.choice((51, 51, 60, 81, 186)))
        if k % 2:  # sentences of their own, begun and ended inside others
            for at in range(rng.randrange(4, 20), len(passage), rng.randrange(8, 24)):
                passage[at] += "."
        passages[k] = " ".join(passage)
        for doc in (2 * k, 2 * k + 1):
            rows.append((doc, " ".join([*run_of(rng, rng.randrange(40)), passages[k], *run_of(rng, rng.randrange(40))])))
    text = dict(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = {r.doc_id: r for r in spans.dedup_substrings(docs).collect()}
    for k, passage in passages.items():
        assert out[2 * k].text == text[2 * k]
        lost = len(text[2 * k + 1].split()) - len(out[2 * k + 1].text.split())
        assert len(passage.split()) - 2 * spans.REACH - spans.WORDS < lost <= len(passage.split()), k


def test_no_part_is_longer_than_the_reach():
    rng = random.Random(2)
    for n in (1, 10, 11, 21, 400):
        starts, parts = spans.cut(" ".join(run_of(rng, n)).encode())
        assert sum(map(len, parts)) == n and len(starts) == len(parts) and max(map(len, parts)) <= spans.REACH
