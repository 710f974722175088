"""Line numbers and offsets over any splits."""

import io
import random

import pyarrow as pa
import pytest

from tessera.sources import lines as L
from tessera.sources.files import list_tree


def whole(body):
    """(offset, line) of a body read in one piece."""
    out, at = [], 0
    while at < len(body):
        ends = [e for e in (body.find(b"\n", at), body.find(b"\r", at)) if e >= 0]
        if not ends:
            out.append((at, body[at:]))
            break
        e = min(ends)
        out.append((at, body[at:e]))
        at = e + (2 if body[e:e + 2] == b"\r\n" else 1)
    return out


@pytest.mark.parametrize("buffer", [1, 2, 3, 7, 1 << 20])
def test_splits_give_each_line_once(monkeypatch, buffer):
    monkeypatch.setattr(L, "BUFFER", buffer)
    deal = random.Random(buffer)
    for _ in range(150):
        body = b"".join(deal.choices([b"a", b"bcd", b"\n", b"\r", b"\r\n", b"", b"\n\r"], k=deal.randint(0, 25)))
        for split in (1, 2, 3, 5, 100):
            got = [x for s in range(0, len(body), split)
                   for x in L._split_lines(io.BytesIO(body), s, min(s + split, len(body)))]
            assert got == whole(body), (body, split)


@pytest.mark.parametrize("split", [1, 10, 1000, 1 << 20])
def test_numbered_lines(spark, tmp, split):
    deal, bodies = random.Random(8), {}
    for name, n in (("a", 60), ("b", 0), ("c", 1), ("d e", 200)):
        bodies[name] = "".join(deal.choice(["é", "xy", "line of words ", "\n", "\r\n"]) for _ in range(n)).encode()
        with open(f"{tmp}/{name}", "wb") as f:
            f.write(bodies[name])
    got = sorted(tuple(r) for r in L.numbered_lines(list_tree(spark, tmp), split).collect())
    want = sorted((f"{tmp}/{name}", k, at, line.decode()) for name, body in bodies.items()
                  for k, (at, line) in enumerate(whole(body)))
    assert got == want


def test_a_line_over_many_splits(spark, tmp):
    with open(f"{tmp}/one", "wb") as f:
        f.write(b"x" * 500_000 + b"\nend")
    rows = L.numbered_lines(list_tree(spark, tmp), 1000).collect()
    assert sorted((r.line_no, r.start, len(r.value)) for r in rows) == [(0, 0, 500_000), (1, 500_001, 3)]


def test_bytes_that_are_not_text_fail(spark, tmp):
    with open(f"{tmp}/bad", "wb") as f:
        f.write(b"ok\n\xff\xfe\n")
    with pytest.raises(Exception, match="UnicodeDecodeError"):
        L.numbered_lines(list_tree(spark, tmp)).collect()
    empty = list_tree(spark, tmp).limit(0)
    assert L.numbered_lines(empty).count() == 0


def test_a_split_reads_little_beyond_its_end():
    body = b"some words\n" * 100_000

    class Counted(io.BytesIO):
        taken = 0

        def read(self, n=-1):
            out = super().read(n)
            self.taken += len(out)
            return out

    f = Counted(body)
    assert [at for at, _ in L._split_lines(f, 10_000, 20_000)] == [at for at, _ in whole(body[:22_000]) if 10_000 <= at < 20_000]
    assert f.taken <= 10_000 + 2 * L.TAIL


def test_splits_are_counted_a_batch_at_a_time(tmp):
    with open(f"{tmp}/f", "wb") as f:
        f.write(b"a\nb\nc\n")
    splits = pa.record_batch([pa.array([f"{tmp}/f"] * 3), pa.array([0, 2, 3]), pa.array([2, 3, 6])],
                             names=["path", "split", "split_end"])
    assert [b.column("lines").to_pylist() for b in L._count([splits])] == [[1, 1, 1]]
