"""Language identification by a bidirectional gated recurrent network.

The network reads UTF-8 bytes, each with the one before it, labels every
position and is trained in numpy by backpropagation through time.  A text is
read in pieces of 96 bytes with 16 more on both sides, so that no position
stands at a border; a document's probabilities are the mean of those of all
its positions, first to last.

Training takes windows of at most ``sample`` labelled documents, as many of
each language, a bounded table on the driver; the weights (about three
megabytes) are broadcast.  Scoring is one pass without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessera.llm.common import emit, worker_cache

CODES = 1 << 14
NOTHING = 0    # code of two zero bytes: its inputs stay 0, as those of pairs never seen
DROPPED = 0.3  # share of the positions that training shows as such
BLANK = 32
SEGMENT = 64   # longest training window
BODY = 96      # bytes of a text that are labelled at once
CONTEXT = 16   # bytes that are read before and behind them
SLAB = 4096    # pieces that are scored at once
UNKNOWN = "und"
LEAST_SHARE = 1e-4  # of a language at a position, as it counts in a document's mean
LEAST_STEPS = 200
LEAST_WINDOW = 3
_SCORED = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()),
                     ("score", pa.float64())])


def codes(data: np.ndarray, before: np.ndarray) -> np.ndarray:
    """The network's input at bytes: each with the byte before it as one of
    ``CODES`` values; pairs of ASCII letters never share one."""
    return ((before.astype(np.intp) << 6) ^ data) & (CODES - 1)


def text_codes(raw: np.ndarray) -> np.ndarray:
    """The codes of one text; a blank stands before it."""
    return codes(raw, np.concatenate([[BLANK], raw[:-1]]))


@dataclass
class Direction:
    """One gated recurrent layer; units are rows, segments are columns."""

    inputs: np.ndarray  # (3H, CODES): reset, update and candidate input of each code
    gates: np.ndarray   # (2H, H)
    state: np.ndarray   # (H, H)

    def run(self, x: np.ndarray, mask: np.ndarray, keep: list | None = None) -> Iterator[tuple[int, np.ndarray]]:
        """States for the code rows of ``x`` (T, S) in turn; masked ones are 0."""
        n = self.state.shape[0]
        h = np.zeros((n, x.shape[1]), self.state.dtype)
        for t in range(len(x)):
            a = self.inputs.take(x[t], axis=1)
            g = self.gates @ h
            g += a[:2 * n]
            g *= 0.5
            np.tanh(g, out=g)
            g *= 0.5
            g += 0.5
            q = self.state @ h
            c = g[:n] * q
            c += a[2 * n:]
            np.tanh(c, out=c)
            new = h - c
            new *= g[n:]
            new += c
            if not mask[t].all():
                new *= mask[t]
            if keep is not None:
                keep.append((h, g, q, c))
            h = new
            yield t, h

    def back(self, x: np.ndarray, mask: np.ndarray, kept: list, outer: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients, from those of the states (T, H, S)."""
        n = self.state.shape[0]
        d_gates, d_state = np.zeros_like(self.gates), np.zeros_like(self.state)
        d_in = np.empty((len(x), 3 * n, x.shape[1]), self.state.dtype)
        d_h = np.zeros_like(outer[0])
        for t in range(len(x) - 1, -1, -1):
            before, g, q, c = kept[t]
            r, z = g[:n], g[n:]
            d_h = (d_h + outer[t]) * mask[t]
            d_c = d_h * (1 - z) * (1 - c * c)
            d_q = d_c * r
            d_g = np.concatenate([d_c * q, d_h * (before - c)]) * g * (1 - g)
            d_in[t, :2 * n], d_in[t, 2 * n:] = d_g, d_c
            d_gates += d_g @ before.T
            d_state += d_q @ before.T
            d_h = d_h * z + self.state.T @ d_q + self.gates.T @ d_g
        flat, rows = x.ravel(), d_in.transpose(1, 0, 2).reshape(3 * n, -1)
        d_inputs = np.stack([np.bincount(flat, row, CODES) for row in rows])
        return {"inputs": d_inputs, "gates": d_gates, "state": d_state}


@dataclass
class ByteNetwork:
    languages: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray   # (L, 2H)
    bias: np.ndarray  # (L, 1)

    def positions(self, x: np.ndarray, mask: np.ndarray) -> Iterator[np.ndarray]:
        """Language probabilities (L, S) of each byte row, first to last."""
        n = self.forward.state.shape[0]
        part = np.empty((len(x), len(self.languages), x.shape[1]), self.out.dtype)
        for t, h in self.backward.run(x[::-1], mask[::-1]):
            part[len(x) - 1 - t] = self.out[:, n:] @ h
        for t, h in self.forward.run(x, mask):
            p = part[t]
            p += self.out[:, :n] @ h
            p += self.bias
            p -= p.max(axis=0)
            np.exp(p, out=p)
            p /= p.sum(axis=0)
            yield p

    def slabs(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[tuple]:
        """The documents' bytes in pieces of ``BODY``, each read with ``CONTEXT``
        bytes more on both sides, ``SLAB`` pieces at a time: the pieces'
        documents, the byte of each step, whether it is in the body, and the
        steps' language probabilities."""
        pieces = -(-(ends - starts) // BODY)
        owner = np.repeat(np.arange(len(starts)), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        first = starts[owner] + nth * BODY
        last = np.minimum(first + BODY, ends[owner])
        for at in range(0, len(owner), SLAB):
            here, begin, end = owner[at:at + SLAB], first[at:at + SLAB], last[at:at + SLAB]
            low, high = np.maximum(begin - CONTEXT, starts[here]), np.minimum(end + CONTEXT, ends[here])
            place = low[None, :] + np.arange(min(int((high - low).max()), BODY + 2 * CONTEXT))[:, None]
            mask, body = place < high[None, :], (place >= begin[None, :]) & (place < end[None, :])
            at_byte = np.minimum(place, high[None, :] - 1)
            before = np.where(at_byte > starts[here][None, :], data[at_byte - 1], BLANK)
            x = codes(data[at_byte], before)
            yield here, place, body, self.positions(x, mask.astype(self.out.dtype))

    def pooled(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Probabilities (documents, L) of each document: the geometric means of
        those of all its bytes, made to sum to 1.  One telling word counts
        for more than many bytes that say little."""
        sums = np.zeros((len(starts), len(self.languages)))
        for owner, _, body, steps in self.slabs(data, starts, ends):
            total = np.zeros((len(self.languages), len(owner)), self.out.dtype)
            for p, m in zip(steps, body, strict=True):
                np.log(np.maximum(p, LEAST_SHARE, out=p), out=p)
                total += p if m.all() else p * m
            for k, row in enumerate(total):
                sums[:, k] += np.bincount(owner, row, len(starts))
        sums /= np.maximum(ends - starts, 1)[:, None]
        sums = np.exp(sums - sums.max(axis=1, keepdims=True))
        return sums / sums.sum(axis=1, keepdims=True)

    def label_positions(self, text: str) -> list[str]:
        """The language of every byte of ``text``."""
        data = np.frombuffer(text.encode(), np.uint8)
        best = np.zeros(len(data), int)
        for _, place, body, steps in self.slabs(data, np.array([0]), np.array([len(data)])):
            for p, at, m in zip(steps, place, body, strict=True):
                best[at[m]] = p.argmax(axis=0)[m]
        return [self.languages[k] for k in best]


def train(windows: list[tuple[bytes, str]], hidden: int = 6, epochs: int = 4, batch: int = 256,
          rate: float = 0.02, seed: int = 7) -> ByteNetwork | None:
    """Fits the network to (bytes, language) windows; None without any."""
    languages = sorted({lang for _, lang in windows})
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    rows = len(windows)
    x, mask = np.zeros((rows, SEGMENT), np.intp), np.zeros((rows, SEGMENT), np.float32)
    for i, (raw, _) in enumerate(windows):
        own = np.frombuffer(raw[:SEGMENT], np.uint8)
        x[i, :len(own)], mask[i, :len(own)] = text_codes(own), 1
    y = np.array([languages.index(lang) for _, lang in windows])
    weight = (rows / len(languages) / np.bincount(y, minlength=len(languages)))[y].astype(np.float32)

    def layer():
        # Inputs start at 0: a pair of bytes that was never seen says nothing.
        normal = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        return Direction(np.zeros((3 * hidden, CODES), np.float32), normal(2 * hidden, hidden), normal(hidden, hidden))

    net = ByteNetwork(languages, layer(), layer(), rng.normal(0, 0.3, (len(languages), 2 * hidden)).astype(np.float32),
                      np.zeros((len(languages), 1), np.float32))
    if len(languages) == 1:
        return net
    arrays = [getattr(d, k) for d in (net.forward, net.backward) for k in ("inputs", "gates", "state")] \
        + [net.out, net.bias]
    moment = [(np.zeros_like(a), np.zeros_like(a)) for a in arrays]
    epochs = max(epochs, -(-LEAST_STEPS // -(-rows // batch)))  # a small sample is gone over more often
    steps = epochs * -(-rows // batch)
    step = 0
    for _ in range(epochs):
        order = rng.permutation(rows)
        for at in range(0, rows, batch):
            pick = order[at:at + batch]
            seen = x[pick].T.copy()
            seen[rng.random(seen.shape) < DROPPED] = NOTHING
            grads = _gradients(net, seen, mask[pick].T.copy(), y[pick], weight[pick])
            step += 1
            now = rate * (1 - 0.9 * step / steps)
            for a, (m, v), g in zip(arrays, moment, grads, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                a -= (now * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)).astype(a.dtype)
            for d in (net.forward, net.backward):
                d.inputs[:, NOTHING] = 0
    return net


def _gradients(net: ByteNetwork, x, mask, y, weight) -> list[np.ndarray]:
    n, steps = net.forward.state.shape[0], len(x)
    kept_f: list = []
    kept_b: list = []
    states = np.empty((steps, 2 * n, x.shape[1]), np.float32)
    for t, h in net.forward.run(x, mask, kept_f):
        states[t, :n] = h
    for t, h in net.backward.run(x[::-1], mask[::-1], kept_b):
        states[steps - 1 - t, n:] = h
    p = np.einsum("lh,ths->tls", net.out, states) + net.bias
    p -= p.max(axis=1, keepdims=True)
    np.exp(p, out=p)
    p /= p.sum(axis=1, keepdims=True)
    p[:, y, np.arange(len(y))] -= 1
    p *= (mask * (weight / max(float(mask.sum()), 1.0)))[:, None, :]
    d_out = np.einsum("tls,ths->lh", p, states)
    outer = np.einsum("lh,tls->ths", net.out, p)
    f = net.forward.back(x, mask, kept_f, outer[:, :n])
    b = net.backward.back(x[::-1], mask[::-1], kept_b, outer[::-1, n:])
    return [d[k] for d in (f, b) for k in ("inputs", "gates", "state")] + [d_out, p.sum(axis=(0, 2))[:, None]]


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 by 4; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, sample: int = 3000, windows: int = 12_000) -> ByteNetwork | None:
    """Trains on about ``windows`` windows of at most ``sample`` documents that
    are not held out and have text and a language: an equal share of each
    language, those with the smallest hash of their id.  A rare language thus
    has as many documents as there are, up to its share.  Windows are 3 to 64
    characters long, short ones as often as long ones, so that short texts are
    learned, too."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                        F.col("lang").cast("string").alias("lang"))
            .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return None
    share = max(1, sample // len(counts))
    order = F.pmod(F.xxhash64("doc_id", "lang"), F.lit(1 << 30))
    # Rows far above a language's share are left out by their hash before they are ranked.
    likely = F.lit(False)
    for lang, n in counts.items():
        likely |= (F.col("lang") == lang) & (order < int(min(1.0, 2 * share / n) * (1 << 30)))
    ranked = rows.where(likely).withColumn("_n", F.row_number().over(
        Window.partitionBy("lang").orderBy(order, "doc_id", F.xxhash64("text"))))
    kept = sum(min(n, share) for n in counts.values())
    per_doc = max(4, min(16, windows // kept))
    spots = []
    for k in range(per_doc):
        u = F.pmod(F.xxhash64(F.lit(k), F.lit("length"), "doc_id"), F.lit(1 << 20)) / float(1 << 20)
        size = F.round(F.lit(float(LEAST_WINDOW)) * F.pow(F.lit(SEGMENT / LEAST_WINDOW), u)).cast("int")
        room = F.greatest(F.length("text") - size, F.lit(0)) + 1
        spots.append(F.substring(F.col("text"), (F.pmod(F.xxhash64(F.lit(k), "doc_id"), room) + 1).cast("int"), size))
    picked = ranked.where(F.col("_n") <= share).select("lang", F.array(*spots).alias("spots")) \
        .orderBy("lang", "spots").collect()
    return train([(s.encode(), r["lang"]) for r in picked for s in r["spots"] if s])


def identify(docs: DataFrame, model: ByteNetwork | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of
    ``docs(doc_id, text)``.

    Null, empty and letterless texts, and all texts without a model, give
    ``und`` and 0.  Every byte of a long text counts.  Repeated rows and null
    ids stay; of equal probabilities the first language by name wins; other
    columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.col("text").cast("string").alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        worker_cache("bytes", lambda: None)  # lets go of other operators' words

        def out():
            for b in batches:
                text = b.column(2).cast(pa.large_string())
                ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
                raw = text.buffers()[2]
                data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(1, np.uint8)
                known = net is not None and ends[-1] > ends[0]
                odds = net.pooled(data, ends[:-1], ends[1:]) if known else None
                for i, (doc, held, letters) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(),
                                                             b.column(3).to_pylist(), strict=True)):
                    if odds is None or not letters:
                        yield (doc, held, UNKNOWN, 0.0), 40
                    else:
                        best = int(odds[i].argmax())
                        yield (doc, held, net.languages[best], min(1.0, float(odds[i][best]))), 40
        yield from emit(_SCORED, out())

    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def language_id(docs: DataFrame) -> DataFrame:
    """Learns from the documents that are not held out and judges all."""
    return identify(docs, fit(docs))
