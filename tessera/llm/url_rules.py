"""URL filters: sort-merge range join of urls with nested host rules.

A host's canonical key is its labels in reverse order, each followed by a dot
(``www.example.net`` -> ``net.example.www.``).  The hosts under a rule's host
are then the keys in one interval: from the rule's key up to that key with
its last dot replaced by the next character.  Intervals nest or are disjoint.

Urls and rules are cut into the same key ranges.  Cut points are (key, row
hash), taken from a bounded sample, so a host with a third of all urls spans
many ranges; a rule goes to every range that its interval meets.  In each
range a sweep in key order keeps a stack of the rules whose interval is open;
the url takes the longest of them whose path starts the url's path.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tessera.llm.common import emit, lower_ascii, part_count, part_of, range_cuts

_LEAST = -(1 << 63)
_EVENT = "part int, key string, kind int, until string, page_id long, host string, path string, verdict string"
_EVENTS = pa.schema([("part", pa.int32()), ("key", pa.string()), ("kind", pa.int32()), ("until", pa.string()),
                     ("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()),
                     ("verdict", pa.string())])
_JUDGED = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()),
                     ("verdict", pa.string())])


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in
    lower case; empty for null or without ``://``."""
    return lower_ascii(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.", -1)), "."), F.lit("."))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", parts: int | None = None) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of
    ``pages(page_id, url)`` under ``rules(host, path, verdict)``.

    A rule fits its host and all subdomains if the url's path starts with the
    rule's; the rule with the longest text wins, then the longer host, then
    the lesser verdict.  Without a rule: null and ``default``.  Null and odd
    urls have an empty host and path.  Rules with a null host or verdict do
    not count, a null path is empty.  Repeated rows and null ids stay; other
    columns are ignored.
    """
    spark = pages.sparkSession
    parts = parts or part_count(spark)
    urls = (pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"))
            .select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
            .withColumn("key", host_key(F.col("host"))).withColumn("salt", F.xxhash64("page_id", "path")))
    cuts = spark.sparkContext.broadcast(range_cuts(urls, ["key", "salt"], parts))

    def place_urls(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for b in batches:
                for page, host, path, key, salt in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    yield (part_of(cuts.value, (key, salt)), key, 1, "", page, host, path, None), len(path) + 150
        yield from emit(_EVENTS, out())

    def place_rules(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            for b in batches:
                for host, path, verdict, key in zip(*(c.to_pylist() for c in b.columns), strict=True):
                    until = key[:-1] + "/"  # the character after the dot
                    first, last = part_of(cuts.value, (key, _LEAST)), part_of(cuts.value, (until, _LEAST))
                    for part in range(first, last + 1):
                        yield (part, key, 0, until, None, host, path, verdict), 200
        yield from emit(_EVENTS, out())

    given = (rules.select(lower_ascii(F.col("host").cast("string")).alias("host"),
                          F.coalesce(F.col("path").cast("string"), F.lit("")).alias("path"),
                          F.col("verdict").cast("string").alias("verdict"))
             .where("host IS NOT NULL AND verdict IS NOT NULL").distinct()
             .withColumn("key", host_key(F.col("host"))))
    events = urls.mapInArrow(place_urls, _EVENT).unionByName(given.mapInArrow(place_rules, _EVENT))

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            here, stack = None, []
            for b in batches:
                for part, key, kind, until, page, host, path, verdict in zip(*(c.to_pylist() for c in b.columns),
                                                                             strict=True):
                    if part != here:
                        here, stack = part, []
                    while stack and stack[-1][0] <= key:
                        stack.pop()
                    if kind == 0:
                        stack.append((until, host, path, verdict))
                        continue
                    fits = [(-len(h) - len(p), -len(h), v, h + p) for _, h, p, v in stack if path.startswith(p)]
                    best = min(fits, default=None)
                    row = (page, host, path, best[3], best[2]) if best else (page, host, path, None, default)
                    yield row, len(host) + len(path) + 60
        yield from emit(_JUDGED, out())

    return (events.repartitionById(parts, F.col("part")).sortWithinPartitions("part", "key", "kind")
            .mapInArrow(sweep, "page_id long, host string, path string, rule string, verdict string"))
