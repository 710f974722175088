"""Importance resampling against counting every feature one by one."""

import hashlib
import math
import re
from collections import Counter
from zlib import crc32

import pytest

from tessera.llm import resample as R

SCHEMA = "doc_id long, text string"
LONG = "the quick brown fox Jumps over the lazy dog " * 4000
ROWS = [(i, " ".join(f"w{(i * k) % 17}" for k in range(5 + 3 * (i % 12)))) for i in range(60)] + [
    (100, None), (101, ""), (102, " --  "), (103, "Élan ÉLAN élan x" * 12), (104, LONG), (None, "w1 w2 " * 15),
    (None, "w1 w2 " * 15), (7, "again w3 " * 20), (105, "a" * 200 + " " + "b " * 30)]
TARGET = [(1, "w3 w3 w4 the fox"), (2, None), (3, "Élan w5 w6")]


def brute(docs, target, ngrams, buckets, min_words, percent, seed):
    def features(text):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        runs = [" ".join(words[i:i + n]) for n in range(1, ngrams + 1) for i in range(len(words) - n + 1)]
        return words, [crc32(r.encode()) % buckets for r in runs]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for _, text in target:
        t.update(features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out, able = [], []
    for doc_id, text in docs:
        words, own = features(text)
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, own))
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None])
        if len(words) >= min_words:
            able.append(out[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, row in enumerate(able[:len(able) * percent // 100], 1):
        row[4] = k
    return sorted(map(tuple, out), key=str)


@pytest.mark.parametrize("ngrams,buckets,percent,head", [(1, 10_000, 10, 20_000), (1, 10, 50, 3), (2, 500, 30, 4),
                                                         (3, 1000, 100, 50)])
def test_equals_brute_force(spark, ngrams, buckets, percent, head):
    docs = spark.createDataFrame(ROWS, SCHEMA).selectExpr("text AS weight", "doc_id", "text", "1 AS score", "2 AS rank")
    target = spark.createDataFrame(TARGET, "item_id long, text string")
    got = R.resample(docs.repartition(5), target, ngrams, buckets, 20, percent, head=head)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS, TARGET, ngrams, buckets, 20, percent, 2024)


def test_empty_tables(spark):
    none, some = spark.createDataFrame([], SCHEMA), spark.createDataFrame(ROWS[:30], SCHEMA)
    assert R.resample(none, some).count() == 0
    got = R.resample(some, none, percent=40)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(ROWS[:30], [], 1, 10_000, 20, 40, 2024)
    assert R.resample(some, some, min_words=10 ** 9).where("rank IS NOT NULL").isEmpty()


def test_head_holds_frequent_words(spark):
    rows = [(i, f"often often u{i} v{i} also often") for i in range(500)]
    words, pairs = R.head_vocabulary(spark.createDataFrame(rows, SCHEMA).repartition(4), 2, head=5)
    assert words[:2] == [b"often", b"also"] and len(words) <= 5
    assert pairs[0] in [(b"often", b"often"), (b"also", b"often")] and len(pairs) <= 5


def test_summary_keeps_what_is_frequent():
    summary, truth = Counter(), Counter()
    for i in range(5000):
        item = "hot" if i % 3 == 0 else f"x{i}"
        summary[item] += 1
        truth[item] += 1
        R.shrink(summary, 10)
    assert summary["hot"] >= truth["hot"] - 5000 / 10 and len(summary) <= 10


def test_states_go_on():
    v = R.Vocabulary([b"new", b"york"], [(b"new", b"york")], 997)
    for run in [(b"new", b"york"), (b"new", b"x", b"york"), (b"tail", b"new")]:
        assert v.bucket(run, len(run)) == crc32(b" ".join(run)) % 997
    assert v.bucket(b"new", 1) == crc32(b"new") % 997 and v.bucket(b"tail", 1) == crc32(b"tail") % 997
