"""Reply trees and url rules: round trips, brute force and SQL."""

import hashlib
import random

import duckdb
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tessera.llm import chat_format as chat, registry, url_rules

DATA = "/root/testdata/sf0.01"


def digest(rows):
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_queries_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("pages", "conversations", "documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    want = con.execute(registry.ORACLE[name])
    columns = [c[0] for c in want.description]
    got = registry.QUERIES[name](spark, DATA)
    assert sorted(got.columns) == sorted(columns)
    assert digest(got.select(*columns).collect()) == digest(want.fetchall())


TEXT = st.text(alphabet=st.sampled_from(list("ab\n\\<>[]|/sSINTim_end start")), max_size=40)


@given(st.lists(st.tuples(TEXT, TEXT), max_size=5))
@settings(max_examples=300, deadline=None)
def test_template_is_reversible(turns):
    text, loss = chat.format_turns(turns, trained=turns[0][0] if turns else "a")
    assert chat.read_turns(text) == turns
    said = [t for r, t in turns if r == turns[0][0]]
    assert [chat.unescape(text[s:e]) for s, e in loss] == said
    inside = [chat.escape(t) for _, t in turns]
    assert not any(mark in t for t in inside for mark in ("<|im_end|>", "<|im_start|>", "</s>", "[INST]", "[/INST]"))


def test_trees_take_the_best_branch(spark):
    rng = random.Random(8)
    rows, best = [], {}
    for conv in range(12):
        parent, score = {0: None}, {0: rng.randint(0, 9)}
        for node in range(1, rng.randint(2, 25)):
            parent[node], score[node] = rng.randrange(node), rng.randint(-5, 9)
        paths = {}
        for leaf in set(parent) - set(parent.values()):
            path = [leaf]
            while parent[path[-1]] is not None:
                path.append(parent[path[-1]])
            paths[leaf] = path
        top = max(paths, key=lambda n: (sum(score[x] for x in paths[n]), len(paths[n]), -n))  # noqa: B023
        best[str(conv)] = (top, paths[top][::-1], paths)
        rows += [(str(conv), n, parent[n], float(score[n]), "user" if n % 2 else "assistant", f"{conv}.{n}") for n in parent]
    schema = "conv string, node long, parent long, score double, role string, text string"
    df = spark.createDataFrame(rows, schema).withColumn("leaf", F.lit("clash"))
    got = {r.conv: (r.leaf, [int(t.split(".")[1]) for _, t in chat.read_turns(r.formatted)])
           for r in chat.format_trees(df).collect()}
    assert got == {c: b[:2] for c, b in best.items()}
    every = {(r.conv, r.leaf): chat.read_turns(r.formatted) for r in chat.format_trees(df, keep="all").collect()}
    assert {k: len(v) for k, v in every.items()} == {(c, n): len(p) for c, b in best.items() for n, p in b[2].items()}


def test_trees_odd_rows(spark):
    schema = "conv string, node long, parent long, score double, role string, text string"
    rows = [("a", 1, None, None, None, None), ("a", 2, 99, 1.0, "user", "orphan"),  # both are roots
            ("c", 1, 2, 1.0, "user", "x"), ("c", 2, 1, 1.0, "user", "y"), ("c", 3, 2, 1.0, "user", "z")]  # a circle
    got = sorted((r.conv, r.leaf, r.formatted) for r in chat.format_trees(spark.createDataFrame(rows, schema)).collect())
    assert [g[:2] for g in got] == [("a", 1), ("a", 2)] and chat.read_turns(got[0][2]) == [("", "")]
    chain = [("d", i, i - 1 if i else None, 0.0, "user", str(i)) for i in range(300)]
    one = chat.format_trees(spark.createDataFrame(chain, schema)).collect()
    assert len(one) == 1 and [t for _, t in chat.read_turns(one[0].formatted)] == [str(i) for i in range(300)]
    with pytest.raises(ValueError):
        chat.reply_paths(spark.createDataFrame(rows, schema), "some")


def test_conversations_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, None, None, "late"),
            (None, 0, "assistant", "of none"), (2, 0, "assistant", "x" * 50000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("node", F.lit(0))
    got = {r.conv_id: r for r in chat.conversation_digest(df).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(got) == {1, None, 2} and got[1].n_turns == 4
    assert got[1].turns_sha256 == sha("user\nhi\nuser\nhi\nassistant\n\n\nlate\n") and got[1].loss_chars == 0
    assert got[None].loss_sha256 == sha("of none") and got[2].loss_chars == 50000
    assert chat.conversation_digest(df.limit(0)).count() == 0


# --- urls -------------------------------------------------------------------

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "", "block"), ("net", "/en/x", "allow"),
         ("org", "/", "block"), ("org", "/", "allow"), ("-x.net", "/", "allow"), (None, "/", "block"), ("com", None, "block"),
         ("example.org", "/", None)]


def judge(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:cut].translate({i: i + 32 for i in range(65, 91)})
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(-len(h) - len(p or ""), -len(h), v, h + (p or "")) for h, p, v in rules
            if h is not None and v is not None and ("." + host).endswith("." + h) and path.startswith(p or "")]
    best = min(fits, default=None)
    return (host, path, best[3], best[2]) if best else (host, path, None, "allow")


@pytest.mark.parametrize("parts", [2, 7])
def test_urls_against_brute_force(spark, parts):
    rng = random.Random(9)
    names = ["a", "B", "example", "net", "org", "com", "-x", "é", ""]
    urls = [None, "", "no scheme", "http://", "http://net", "http://NET/?q", "x://a.example.net#/en/", "http://net:80/"]
    for _ in range(400):
        host = ".".join(rng.choice(names) for _ in range(rng.randint(1, 4)))
        urls.append(f"https://{host}{rng.choice(['', '/', '/en/', '/en/x/1', '/de?x=/en/', '#a', '?b'])}")
    urls += ["http://hot.example.net/en/1"] * 200
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("key", F.lit(1))
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in url_rules.judge_urls(df, rules, parts=parts).collect()}
    assert got == {i: judge(u, RULES) for i, u in enumerate(urls)}


def test_urls_without_rules_or_rows(spark):
    df = spark.createDataFrame([(None, "http://a/b"), (None, "http://a/b")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in url_rules.judge_urls(df, none, "block").collect()] == [(None, "a", "/b", None, "block")] * 2
    assert url_rules.judge_urls(df.limit(0), none).count() == 0
