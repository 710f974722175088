"""BPE encoding and decoding by a tokenization automaton.

The merges are compiled in rank order into a deterministic automaton over
token labels that accepts exactly the token sequences BPE can produce.  It
starts with one state that loops on every base symbol.  The gadget of the
merge ``u v -> uv`` splits the state that ``u`` leads to: the copy that ``u``
now reaches has no arc ``v``, and every state with the arc ``u`` gets an arc
``uv`` to where ``v`` led.  A state is fixed by the label that was read last,
so a split is stored as one entry (u, v, step) on top of the state it copies:
the state of ``u`` holds u's own splits over those its right part had when
``u`` was made, and an arc's label exists in a state unless a split removed it
or, before it was made, its left part.

A word is encoded from left to right.  Every prefix has exactly one accepted
path, so one live state per position is kept; a position takes the label whose
arc leaves the live state at the label's start.  Transitions are looked up in
a table that is filled on first use.  Decoding emits the arc labels of the ids.

Tokenizer files are read on the driver and broadcast (their size is that of
the vocabulary, never of the corpus).  Supported: BPE files whose words are
matched by a split pattern that leaves white space out, with byte-level
symbols and a word-end suffix.
"""

from __future__ import annotations

import json
import re
import sys
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T
from tokenizers import Tokenizer

from tessera.llm.common import emit, give_back, worker_cache

START = -1
LATEST = 1 << 30  # after every merge
CACHE_BYTES = 160 << 20  # of known chunks and words that a worker keeps
# Unicode White_Space; str.split() would also cut at U+001C..U+001F.
_SPACE = re.compile("[\t-\r \x85\xa0  -     　]+")
_SEPARATORS = "\x1c\x1d\x1e\x1f"


def uint32_bytes(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class MergeAutomaton:
    """Deterministic automaton over token ids, made from merges in rank order."""

    def __init__(self, vocab: dict[str, int], merges: list[tuple[str, str]], suffix: str,
                 table_limit: int = 200_000):
        self.suffix, self.table_limit = suffix, table_limit
        none = [-1] * (max(vocab.values(), default=-1) + 1)
        # Of each label: the merge that made it and its two parts; -1 for base symbols.
        self.step, self.left, self.right = array("i", none), array("i", none), array("i", none)
        self.splits: dict[int, dict[int, int]] = {}
        self.table: dict[int, bool] = {}  # last label << 32 | next one
        self.dead: set[int] = set()
        for step, (u, v) in enumerate(merges):
            self._gadget(step, vocab[u], vocab[v], vocab[u + v])
        live = {s: i for s, i in vocab.items() if i not in self.dead}
        self.final = {s[:-len(suffix)]: i for s, i in live.items() if s.endswith(suffix)}
        self.ends = _by_end(self.final)
        self.inside = _by_end({s: i for s, i in live.items() if not s.endswith(suffix)})

    def _gadget(self, step: int, u: int, v: int, uv: int) -> None:
        if self.step[uv] >= 0 or max(self.step[u], self.step[v]) >= step:
            raise ValueError(f"merge {step} makes a token twice or uses a later one")
        if u in self.dead or v in self.dead or not self._arc(u, v):
            self.dead.add(uv)  # no state has the arcs u, v in a row any more
        self.splits.setdefault(u, {})[v] = step
        self.step[uv], self.left[uv], self.right[uv] = step, u, v

    def _arc(self, last: int, label: int) -> bool:
        """Whether the state after ``last`` has an arc ``label``."""
        state, seen_before = last, LATEST
        while state >= 0:
            if own := self.splits.get(state):
                part, made = label, LATEST
                while part >= 0:
                    at = own.get(part)
                    if at is not None and at < seen_before and at <= made:
                        return False
                    made, part = self.step[part], self.left[part]
            seen_before, state = self.step[state], self.right[state]
        return True

    def goes(self, last: int, label: int) -> bool:
        if last == START:
            return True
        key = last << 32 | label
        known = self.table.get(key)
        if known is None:
            if len(self.table) >= self.table_limit:
                self.table.clear()
            known = self.table[key] = self._arc(last, label)
        return known

    def encode(self, word: str) -> list[int]:
        """Ids of one word of symbols; the word end belongs to the last one."""
        n = len(word)
        if (whole := self.final.get(word)) is not None:
            return [whole]
        last, back, table = [START] * (n + 1), [0] * (n + 1), self.table
        for i in range(1, n + 1):
            node, j, found = self.inside if i < n else self.ends, i, []
            while j:
                j -= 1
                node = node.get(word[j])
                if node is None:
                    break
                if "" in node:
                    found.append((j, node[""]))
            for j, label in reversed(found):  # longest first
                known = table.get(last[j] << 32 | label)
                if known or known is None and self.goes(last[j], label):
                    last[i], back[i] = label, j
                    break
            else:
                raise ValueError(f"no accepted path in {word[:80]!r}")
        out, i = [], n
        while i:
            out.append(last[i])
            i = back[i]
        return out[::-1]


def _by_end(labels: dict[str, int]) -> dict:
    """Trie of the labels read from their last symbol; "" holds the id."""
    root: dict = {}
    for s, i in labels.items():
        node = root
        for c in reversed(s):
            node = node.setdefault(c, {})
        node[""] = i
    return root


class IdCache(dict):
    """Ids, as little-endian uint32 bytes, of white-space free chunks (str keys)
    and of words of byte symbols (bytes keys).  Holds about ``limit`` bytes, in
    two halves: when the younger one is full it becomes the older one, and
    what is used again of that moves over."""

    ENTRY = 180  # bytes of an entry besides its texts

    def __init__(self, chunk: Callable[[str], bytes], word: Callable[[str], bytes], limit: int):
        super().__init__()
        self.chunk, self.word, self.half, self.held, self.old = chunk, word, limit // 2, 0, {}

    def __missing__(self, key: str | bytes) -> bytes:
        out = self.old.get(key)
        if out is None:
            out = self.chunk(key) if isinstance(key, str) else self.word(key.decode())
        if len(key) <= 100:
            size = self.ENTRY + len(key) + len(out)
            if self.held + size > self.half:
                self.old = dict(self)
                self.clear()
                self.held = 0
            self.held += size
            self[key] = out
        return out


class ChunkEncoder:
    """Encodes texts by white-space free chunks and words, which are kept.

    Chunks of printable ASCII are lower-cased and split here.  All others go
    through the library's own normalizer and pre-tokenizer, whose character
    tables are not those of Python.  ``word`` gives the ids (little-endian
    uint32) of one word of byte symbols."""

    def __init__(self, text: str, word: Callable[[str], bytes], limit: int = CACHE_BYTES):
        spec = json.loads(text)
        self.pieces = regex.compile(check_spec(spec))
        self.special = special_ids(spec)
        self.at_special = special_pattern(self.special)
        library = Tokenizer.from_str(text)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        self.word = word
        self.known = IdCache(self._chunk, word, limit)

    def _chunk(self, chunk: str) -> bytes:
        known = self.known
        if not chunk.isascii() or not chunk.isprintable():
            return b"".join([known[piece.encode()] for piece, _ in self.split(self.normalize(chunk))])
        low = chunk.lower()
        # Letters, and letters before one other mark, need no matching.
        if low.isalpha():
            return self.word(low) if low == chunk else known[low]
        if low[:-1].isalpha() and not low[-1].isalnum():
            return known[low[:-1]] + known[low[-1].encode()]
        return b"".join([known[p if p.isalpha() else p.encode()] for p in self.pieces.findall(low)])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian uint32 bytes; null gives none."""
        return encode_chunks(text, self.known, self.special, self.at_special)


class WordBpe:
    """Encoder of one tokenizer file by its merge automaton."""

    def __init__(self, text: str, spec: dict | None = None, cache_bytes: int = CACHE_BYTES):
        spec = spec or json.loads(text)
        model = spec["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.automaton = MergeAutomaton(model["vocab"], merges, model["end_of_word_suffix"])
        self.chunks = ChunkEncoder(text, lambda symbols: uint32_bytes(self.automaton.encode(symbols)),
                                   cache_bytes)
        self.encode = self.chunks.encode


class ArcLabels(dict):
    """Token id -> arc label, for decoding."""

    def __init__(self, text: str, spec: dict | None = None):
        spec = spec or json.loads(text)
        check_spec(spec)
        super().__init__({i: s for s, i in spec["model"]["vocab"].items()}
                         | {i: s for s, i in special_ids(spec).items()})

    def decode(self, ids: bytes) -> str:
        """The arc labels, joined as the library does without a decoder."""
        return " ".join(map(self.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def special_ids(spec: dict) -> dict[str, int]:
    return {a["content"]: a["id"] for a in spec["added_tokens"]}


def special_pattern(special: dict[str, int]) -> re.Pattern | None:
    by_length = sorted(special, key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None


def encode_chunks(text: str | None, chunks: IdCache, special: dict[str, int],
                  at_special: re.Pattern | None) -> bytes:
    """The ids of a text are those of its white-space free chunks in a row;
    strings of special tokens are cut out first and give their own id."""
    if not text:
        return b""
    if at_special is not None and at_special.search(text):
        return b"".join(np.asarray([special[t]], "<u4").tobytes() if t in special
                        else encode_chunks(t, chunks, special, None) for t in at_special.split(text))
    odd = any(c in text for c in _SEPARATORS)
    parts = [c for c in _SPACE.split(text) if c] if odd else text.split()
    return b"".join(map(chunks.__getitem__, parts))


def check_spec(spec: dict) -> str:
    """The split pattern of a tokenizer file in which white space only parts
    words; ValueError for any other file."""
    try:
        normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        ok = (normal == ["NFC", "Replace", "Lowercase"]
              and spec["normalizer"]["normalizers"][1]["pattern"] == {"Regex": r"\s+"}
              and split["behavior"] == "Removed" and split["invert"] and "\\s" in split["pattern"]["Regex"]
              and level["type"] == "ByteLevel" and not level["use_regex"] and not level["add_prefix_space"]
              and spec["model"]["type"] == "BPE" and spec["model"]["end_of_word_suffix"]
              and not spec["model"].get("dropout") and spec["decoder"] is None
              and not any(a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"]
                          for a in spec["added_tokens"]))
    except (KeyError, TypeError, ValueError):
        ok = False
    if not ok:
        raise ValueError("not a byte-level BPE file whose words are parted by white space")
    return split["pattern"]["Regex"]


def built(kind: type, text: str, *options: int):
    """``kind`` made from a tokenizer file, kept by the Python worker."""
    def make():
        out = kind(text, *options)
        give_back()  # what only the building took
        return out

    return worker_cache((kind, text, options), make)


def bpe_encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids)`` per row, ``ids`` the token ids of the whole text as
    little-endian uint32 bytes.

    Null and empty texts give no ids; rows that repeat give a row each; a null
    id is kept; very long texts are encoded whole; other columns are left out.
    No shuffle.
    """
    spec = docs.sparkSession.sparkContext.broadcast(_read(tokenizer_path))
    schema = pa.schema([("id", pa.string() if _is_text(docs, id_col) else pa.int64()), ("ids", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = built(WordBpe, spec.value)

        def rows():
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = bpe.encode(text.as_py())
                    yield (key, ids), len(ids)
        yield from emit(schema, rows())

    kind = T.StringType() if _is_text(docs, id_col) else T.LongType()
    out = docs.select(F.col(id_col).cast(kind).alias("id"), F.col(text_col).cast("string").alias("text"))
    return out.mapInArrow(encode, T.StructType([T.StructField("id", kind), T.StructField("ids", T.BinaryType())])) \
        .withColumnRenamed("id", id_col)


def bpe_decode(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id") -> DataFrame:
    """``(id_col, ids, decoded)``: the labels of the ids; null ids give ''."""
    spec = encoded.sparkSession.sparkContext.broadcast(_read(tokenizer_path))
    text_id = _is_text(encoded, id_col)
    schema = pa.schema([("id", pa.string() if text_id else pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labels = built(ArcLabels, spec.value)

        def rows():
            for batch in batches:
                for key, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = ids.as_py() or b""
                    text = labels.decode(ids)
                    yield (key, ids, text), len(ids) + len(text)
        yield from emit(schema, rows())

    kind = T.StringType() if text_id else T.LongType()
    out = encoded.select(F.col(id_col).cast(kind).alias("id"), "ids")
    return out.mapInArrow(decode, T.StructType([T.StructField("id", kind), T.StructField("ids", T.BinaryType()),
                                               T.StructField("decoded", T.StringType())])) \
        .withColumnRenamed("id", id_col)


def _is_text(df: DataFrame, col: str) -> bool:
    return isinstance(df.schema[col].dataType, T.StringType)


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


class Both:
    """Encoder and arc labels of one tokenizer file."""

    def __init__(self, text: str, cache_bytes: int):
        spec = json.loads(text)
        self.bpe, self.labels = WordBpe(text, spec, cache_bytes), ArcLabels(text, spec)


def encode_and_decode(docs: DataFrame, tokenizer_path: str, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """``doc_id, ids, decoded`` per row: ``bpe_decode`` of ``bpe_encode``, both
    in one Python step, so that a task needs one worker and the ids travel
    once.  ``cache_bytes`` bounds what a worker remembers: less takes more time,
    the result is the same."""
    spec = docs.sparkSession.sparkContext.broadcast(_read(tokenizer_path))
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("decoded", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = built(Both, spec.value, cache_bytes)

        def rows():
            for batch in batches:
                for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    ids = both.bpe.encode(text.as_py())
                    decoded = both.labels.decode(ids)
                    yield (key, ids, decoded), len(ids) + len(decoded)
        yield from emit(schema, rows())

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, ids binary, decoded string")


def round_trip(docs: DataFrame, tokenizer_path: str, cache_bytes: int = CACHE_BYTES) -> DataFrame:
    """Digest of encoding and decoding: ``doc_id, n_tokens, ids_sha256,
    decoded_sha256``."""
    return encode_and_decode(docs, tokenizer_path, cache_bytes).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
