"""Automaton, token files: against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tessera.llm import bpe, token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
ALPHABET = "aaabcdehilnorstth  \t\n'’.,!?éßñÉΣσςİ\x1c\x85  ́中日1²½٣🙂‍<|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def texts(n, seed):
    rng = random.Random(seed)
    for _ in range(n):
        t = "".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 40)))
        yield t[:5] + "<|endoftext|>" + t[5:] + "<|startoftext|>" if rng.random() < 0.2 else t


def test_encoders_match_the_library(library):
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    automaton, labels, words = bpe.WordBpe(spec), bpe.ArcLabels(spec), token_files.LibraryEncoder(spec)
    for text in [*texts(4000, 1), "a" * 700, "the quick brown fox's"]:
        want = ids(library, text)
        raw = np.asarray(want, "<u4").tobytes()
        assert automaton.encode(text) == raw and words.encode(text) == raw, text
        assert labels.decode(raw) == library.decode(want, skip_special_tokens=False)


def test_all_code_points(library):
    """Each code point between letters, at a start and alone: those that Python's
    tables know otherwise, and those that normalizing joins with others."""
    with open(PATH, encoding="utf-8") as f:
        spec = f.read()
    automaton, words = bpe.WordBpe(spec), token_files.LibraryEncoder(spec)
    points = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000] + [chr(0xE0041), chr(0x10FFFF)]
    for at in range(0, len(points), 2000):
        some = [t for c in points[at:at + 2000] for t in (f"a{c}b", f"{c} x", c)]
        for text, want in zip(some, library.encode_batch(some, add_special_tokens=False)):
            raw = np.asarray(want.ids, "<u4").tobytes()
            assert automaton.encode(text) == raw and words.encode(text) == raw, ascii(text)


def test_merge_gadgets_by_brute_force():
    """All strings over a small alphabet, merged rule by rule."""
    merges = [("a", "a"), ("a", "b"), ("aa", "b"), ("b", "a"), ("aa", "ab"), ("b</w>", "x")][:5]
    base = ["a", "b", "a</w>", "b</w>"]
    vocab = {t: i for i, t in enumerate(base + [u + v for u, v in merges])}
    machine = bpe.MergeAutomaton(vocab, merges, "</w>")
    names = {i: t for t, i in vocab.items()}
    rng = random.Random(2)
    for _ in range(2000):
        word = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        parts = [*word[:-1], word[-1] + "</w>"]
        for u, v in merges:
            i = 0
            while i + 1 < len(parts):
                if parts[i:i + 2] == [u, v]:
                    parts[i:i + 2] = [u + v]
                i += 1
        assert [names[i] for i in machine.encode(word)] == parts


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.check_spec({"model": {"type": "Unigram"}})


def rows(spark):
    data = [(3, "Hello, wörld!", 1), (1, None, 2), (2, "", 3), (3, "Hello, wörld!", 1), (-5, "x" * 30000, 4),
            (7, "<|endoftext|> the end", 5)]
    return spark.createDataFrame(data, "doc_id long, text string, ids int")  # a clashing extra column


def test_round_trip_rows(spark, library):
    got = bpe.round_trip(rows(spark).unionByName(spark.createDataFrame([(None, "a b", 0)], rows(spark).schema)), PATH)
    found = sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect())
    want = []
    for doc, text, _ in [*rows(spark).collect(), (None, "a b", 0)]:
        i = ids(library, text)
        want.append((str(doc), len(i), hashlib.sha256(np.asarray(i, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(i, skip_special_tokens=False).encode()).hexdigest()))
    assert found == sorted(want)
    assert bpe.round_trip(rows(spark).limit(0), PATH).count() == 0
    apart = bpe.bpe_decode(bpe.bpe_encode(rows(spark), PATH), PATH).collect()
    assert sorted(map(tuple, apart)) == sorted(map(tuple, bpe.encode_and_decode(rows(spark), PATH).collect()))


@pytest.mark.parametrize("parts", [1, 5])
def test_token_files(spark, library, parts):
    folder = token_files.write_token_files(rows(spark), PATH, 1, parts=parts)
    got = [tuple(r) for r in token_files.read_token_files(spark, folder).orderBy("start").collect()]
    start, want = 0, []
    for doc, text, _ in sorted(rows(spark).collect(), key=lambda r: r.doc_id):
        i = ids(library, text) + [1]
        want.append((doc, start, len(i), zlib.crc32(np.asarray(i, "<u4").tobytes())))
        start += len(i)
    assert got == want


def test_token_files_of_nothing_and_of_null_ids(spark):
    folder = token_files.write_token_files(rows(spark).limit(0), PATH, 1)
    assert token_files.read_token_files(spark, folder).count() == 0
    given = [(None, "a b"), (-3, "c"), (None, None), (0, "d e f"), (None, "a b")]
    folder = token_files.write_token_files(spark.createDataFrame(given, "doc_id long, text string"), PATH, 1, parts=3)
    got = [tuple(r) for r in token_files.read_token_files(spark, folder).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, None, None, -3, 0]
    assert sorted(r[2] for r in got[:3]) == [1, 3, 3] and [r[1] for r in got[3:]] == [7, 9]
    with pytest.raises(ValueError):
        token_files.local_folder("s3://bucket/x")


def test_whole_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in token_files.token_file_round_trip(docs, PATH).collect()}
    start = 0
    for r in docs.orderBy("doc_id").collect():
        own = [*ids(library, r.text), 1]
        crc = zlib.crc32(np.asarray(own, "<u4").tobytes())
        assert (got[r.doc_id].start, got[r.doc_id].n_tokens, got[r.doc_id].ids_crc32) == (start, len(own), crc)
        start += len(own)
