"""Near duplicates, embeddings and benchmark leaks against brute force."""

import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import common, decontaminate as dec, embedding_dedup as emb, minhash

DATA = "/root/testdata/sf0.001"


def closure(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


# --- MinHash ---------------------------------------------------------------

def shingles(text, width):
    words = (text or "").translate({i: i + 32 for i in range(65, 91)})
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ")
             .replace("\x0c", " ").split(" ") if w]
    n = min(width, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def near_by_brute_force(rows, width, percent=80):
    sets = {}
    for doc, text in rows:
        sets.setdefault(doc, []).append(shingles(text, width))
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i:]
             if any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b])]
    return closure(ids, links)


def near_copies(seed=3, groups=6, size=8, words=120):
    rng = random.Random(seed)
    rows, doc = [], 0
    for _ in range(groups):
        base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randint(0, 12)):
                copy[rng.randrange(words)] = f"x{rng.randint(0, 999)}"
            rows.append((doc, " ".join(copy)))
            doc += 1
    return rows


@pytest.mark.parametrize("width", [2, 5])
def test_near_copies_of_words(spark, width):
    rows = near_copies()
    got = {r.doc_id: (r.component_id, r.kept, r.n_shingles)
           for r in minhash.near_components(spark.createDataFrame(rows, "doc_id long, text string"), width).collect()}
    want = near_by_brute_force(rows, width)
    assert got == {d: (want[d], want[d] == d, len(shingles(t, width))) for d, t in rows}


def test_near_odd_rows(spark):
    long = " ".join(f"v{i}" for i in range(30000))
    rows = [(5, "A b\tc  D"), (2, "a B c d"), (9, None), (8, ""), (7, " \n"), (6, "one"), (4, "ONE"), (3, "Éa éa"),
            (2, "a B c d"), (1, long), (11, long + " tail"), (None, "a b c d"), (5, "other words here now")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).withColumn("doc", F.lit(2))
    got = minhash.near_components(df, 2).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {
        (5, 2, False), (2, 2, True), (9, 9, True), (8, 8, True), (7, 7, True), (6, 4, False), (4, 4, True),
        (3, 3, True), (1, 1, True), (11, 1, False), (None, None, True)}
    assert minhash.near_components(df.limit(0), 2).count() == 0
    kept = sorted(str(r.doc_id) for r in minhash.keep_first(df, 2).collect())
    assert kept == ["1", "2", "3", "4", "7", "8", "9", "None"]


def test_near_documents_of_the_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = near_by_brute_force(rows, 2)
    got = {r.doc_id: r.component_id for r in minhash.near_components(docs, 2).collect()}
    assert got == want and len(set(want.values())) < len(want)


def test_large_lists_are_tiled(spark, monkeypatch):
    rows = near_copies(seed=5, groups=2, size=40)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    got = {r.doc_id: r.component_id
           for r in minhash.near_components(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()}
    assert got == near_by_brute_force(rows, 2)


def test_least_shared_bounds_the_miss():
    for size in (24, 32, 64):
        m = minhash.least_shared(size, 0.8)
        tail = lambda k: sum(math.comb(size, i) * 0.8 ** i * 0.2 ** (size - i) for i in range(k))
        assert tail(m) <= 2e-6 < tail(m + 1)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, i) for i in range(100, 130)] + [(7, 7)]
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in [*range(100, 130), 1000]}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_range_cuts_split_a_hot_key(spark):
    df = spark.range(3000).select(F.lit("hot").alias("k"), F.xxhash64("id").alias("s"))
    cuts = common.range_cuts(df, ["k", "s"], 6)
    sizes = Counter(common.part_of(cuts, tuple(r)) for r in df.collect())
    assert len(sizes) == 6 and max(sizes.values()) < 1200


# --- embeddings --------------------------------------------------------------

def vectors_by_brute_force(rows, threshold=0.93):
    links = Counter()
    pairs = []
    fine = {}
    for i, (vec, e, label) in enumerate(rows):
        if vec is not None and e and label is not None and all(x is not None and math.isfinite(x) for x in e) and any(e):
            m = np.array(e, np.float64)
            m /= np.abs(m).max()
            fine[i] = m / np.linalg.norm(m)
    for i in fine:
        for j in fine:
            if i < j and rows[i][2] == rows[j][2] and len(fine[i]) == len(fine[j]) and fine[i] @ fine[j] >= threshold:
                links[rows[i][0]] += 1
                links[rows[j][0]] += 1
                pairs.append((rows[i][0], rows[j][0]))
    ids = [r[0] for r in rows if r[0] is not None]
    return links, closure(ids, pairs)


def test_vectors_of_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    links, comp = vectors_by_brute_force([(r.vec_id, r.embedding, r.label) for r in table.collect()])
    got = emb.near_vectors(table).collect()
    assert sum(min(r.n_links, links[r.vec_id]) for r in got) >= 0.98 * sum(links.values())
    assert all(r.n_links <= links[r.vec_id] for r in got)
    assert sum(r.component_id != comp[r.vec_id] for r in got) <= 0.01 * len(got)


def test_vectors_in_one_dense_group_and_odd_rows(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=16)
    rows = [(i, (base + rng.normal(size=16) * 0.08).tolist(), 1) for i in range(10, 90)]
    rows += [(i, rng.normal(size=16).tolist(), i % 3) for i in range(100, 160)]
    e = rng.normal(size=16).tolist()
    rows += [(200, e, 2), (3, [2 * x for x in e], 2), (201, e, 2), (202, e, None), (203, None, 2), (204, [0.0] * 16, 2),
             (205, e[:15] + [float("nan")], 2), (206, e[:15] + [None], 2), (207, e[:8], 2), (208, [], 2),
             (None, e, 2), (209, e, 7), (210, [x * 1e200 for x in e], 2)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1))
    df = df.unionByName(df.where("vec_id = 200"))
    links, comp = vectors_by_brute_force(rows)
    got = emb.near_vectors(df, width=8).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_links, r.component_id) == (links[r.vec_id], comp.get(r.vec_id)), r
        assert r.kept == (r.vec_id is None or r.vec_id == comp[r.vec_id])
    assert emb.near_vectors(df.limit(0)).count() == 0


def test_isolated_pairs_beside_a_dense_group_in_a_hot_label(spark):
    rng = np.random.default_rng(11)

    def unit(*shape):
        v = rng.normal(size=shape)
        return v / np.linalg.norm(v, axis=-1, keepdims=True)

    def at_cosine(base, cosine):
        side = unit(*base.shape)
        side -= (side * base).sum(1, keepdims=True) * base
        return cosine * base + np.sqrt(1 - cosine ** 2) * side / np.linalg.norm(side, axis=1, keepdims=True)

    base = unit(3000, 64)
    dense = unit(64) + unit(400, 64) * 0.1
    vectors = np.concatenate([base, at_cosine(base[:1500], 0.94), dense, unit(2000, 64)])
    label = [0] * (4500 + len(dense)) + [1 + i % 400 for i in range(2000)]
    table = pa.table({"vec_id": np.arange(len(vectors)), "embedding": vectors.tolist(), "label": label})
    got = {r.vec_id: r for r in emb.near_vectors(spark.createDataFrame(table)).collect()}
    pairs = [(got[i].component_id, got[3000 + i].component_id) == (i, i) for i in range(1500)]
    assert np.mean(pairs) >= 0.98
    assert {got[i].n_links for i in range(4500, 4900)} == {399}
    assert not any(got[i].n_links for i in range(1500, 3000))


def test_trees_follow_the_label():
    for count in (1, 100, 10_000, 1_000_000):
        bits, trees = emb.label_trees(count, 0.93, 0.01, 8)
        assert count / 2 ** bits <= emb.LEAF // 2 and trees >= 8
        assert (1 - (1 - math.acos(0.93) / math.pi) ** bits) ** trees <= 0.01 or not bits


def test_audit_weighs_vectors_not_links(spark):
    rng = np.random.default_rng(12)
    base, group = rng.normal(size=(60, 64)), rng.normal(size=64)
    vectors = np.concatenate([base, base + rng.normal(size=base.shape) * 0.1, group + rng.normal(size=(60, 64)) * 0.1])
    reps = spark.createDataFrame([("l", i, 1, v.tolist()) for i, v in enumerate(vectors)],
                                 "label string, id long, size long, vec array<double>")
    dense = spark.createDataFrame([(i, 59) for i in range(120, 180)], "id long, links long")
    reached, audited = emb._audit(reps, dense, dense.where("false").select("id"), 0.93, 256)
    assert audited == 180 and abs(reached - 1 / 3) < 1e-9  # by links it would be 0.97
    assert emb._audit(reps, dense, dense.select("id"), 0.93, 256) == (0.0, 120)


# --- benchmark leaks -----------------------------------------------------------

def lists_of(items):
    """Posting lists by the formula: shares of an item's BM25 weight."""
    words = [Counter(dec.words_of(t)) for _, t in items]
    counts, mean = Counter(w for tf in words for w in tf), sum(tf.total() for tf in words) / len(items)
    lists = {}
    for at, tf in enumerate(words):
        weight = {w: math.log(1 + (len(items) - counts[w] + 0.5) / (counts[w] + 0.5)) * n * 2.2
                  / (n + 1.2 * (0.25 + 0.75 * tf.total() / mean)) for w, n in tf.items()}
        for w in tf:
            at_, scores = lists.setdefault(w, ([], []))
            at_.append(at)
            scores.append(weight[w] / sum(weight.values()))
    return lists


def index_of(items):
    return dec.BlockMaxIndex(items, [(w, *r) for w, r in lists_of(items).items()])


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_stored_index_by_the_formula(spark, shard_bytes):
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    rows = [(r.item_id, r.text) for r in items.collect()]
    want = {(rows[at][0], w): s for w, r in lists_of(rows).items() for at, s in zip(*r)}
    path, shards = dec.store_index(items, shard_bytes)
    assert len(shards) == 1 if shard_bytes > 2000 else len(shards) > 3
    got = {}
    for index in (dec.load_index(path, k) for k in shards):
        for w, n in index.number.items():
            p = index.postings[n]
            assert p.items == sorted(p.items) and p.bound == max(p.scores)
            got |= {(index.ids[at], w): s for at, s in zip(p.items, p.scores, strict=True)}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(6)
    vocabulary = [f"w{int(rng.paretovariate(0.8)) % 300}" for _ in range(2000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.randint(8, 40)))) for i in range(90)]
    index = index_of(items)
    hits = 0
    for trial in range(60):
        text = rng.choices(vocabulary, k=rng.randint(0, 300))
        if trial % 2:
            at = rng.randint(0, len(text))
            text[at:at] = dec.words_of(rng.choice(items)[1])
        numbers = np.array([index.number.get(w, len(index.postings)) for w in text], np.int64)
        for threshold in (0.35, 0.6):
            got = {(s, i) for s, e, terms, live in (index.passages(numbers, threshold) if len(numbers) else ())
                   for i, _ in index.search(terms, threshold, live)}
            step = max(16, -(-index.longest // 2))
            want = set()
            for p in range(max(1, -(-len(text) // step) - 2) if text else 0):
                score = Counter()
                for t in set(numbers[p * step:(p + 3) * step].tolist()) - {len(index.postings)}:
                    for i, s in zip(index.postings[t].items, index.postings[t].scores, strict=True):
                        score[i] += s
                want |= {(p * step, i) for i, s in score.items() if s >= threshold - 1e-9}
            assert got == want
            hits += len(want)
    assert hits > 30


def leaks_by_brute_force(docs, items):
    out = set()
    for doc, text in docs:
        words = dec.words_of(text)
        for item, body in items:
            question, answer = dec.question_and_answer(body or "")
            sizes = {len(r) for r in question | answer}
            have = {tuple(words[i:i + n]) for n in sizes for i in range(len(words) - n + 1)}
            if question and len(question & have) >= 0.8 * len(question) and len(answer & have) >= 0.8 * len(answer):
                out.add((doc, item))
    return out


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_leaks_of_the_table(spark, shard_bytes):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = leaks_by_brute_force(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    got = {(r.doc_id, r.item_id) for r in dec.find_leaks(docs, items, shard_bytes=shard_bytes).collect()}
    assert want and got == want


def test_leaks_odd_rows(spark):
    item = "What colour is the northern sky at dawn in winter? It is a very pale and silent green."
    rows = [(1, f"Some words. {item.upper()} More."), (1, f"Some words. {item.upper()} More."), (2, item[:50]), (3, None),
            (4, ""), (5, "filler words " * 20000 + item), (None, item), (6, "nothing of it")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    items = spark.createDataFrame([(10, item), (10, item), (11, None), (12, ""), (13, "...")], "item_id long, text string")
    got = sorted(str((r.doc_id, r.item_id)) for r in dec.find_leaks(docs, items).collect())
    assert got == ["(1, 10)", "(5, 10)", "(None, 10)"]
    assert dec.find_leaks(docs, items.limit(0)).count() == 0 == dec.find_leaks(docs.limit(0), items).count()
    assert sorted(str(r.doc_id) for r in dec.remove_leaks(docs, items).collect()) == ["2", "3", "4", "6", "None"]
