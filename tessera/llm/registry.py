"""Registered queries of the corpus operators and their DuckDB SQL.

Each query reads whole tables, calls one operator with its production
parameters and returns the full result.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import (bpe, chat_format, decontaminate, dialog_repair, embedding_dedup, language_id, license_scan,
                         main_text, minhash, resample, token_files, toxicity, url_rules)
from tessera.llm.common import read_table

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded by the merge automaton and decoded again."""
    return bpe.round_trip(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text's ids written to flat files and read back from them."""
    return token_files.token_file_round_trip(read_table(spark, sf_dir, "documents"), TOKENIZER, END_ID)


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All paragraphs of all documents that are licence notices."""
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, learned from the labelled ones."""
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from those not held out."""
    return language_id.language_id(read_table(spark, sf_dir, "documents"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of all embeddings at cosine 0.93 or more."""
    return embedding_dedup.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents that hold a benchmark item's question and answer."""
    return decontaminate.find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations formatted, digested from what is read back, with one
    more whose texts hold control strings."""
    more = spark.sql("SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text "
                     "FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    given = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.conversation_digest(given.unionByName(more))


URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"),
             ("org", "/fr/", "allow"))


def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the four nested rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_rules.judge_urls(read_table(spark, sf_dir, "pages"), rules)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 0.8 of their two-word shingles."""
    return minhash.near_components(read_table(spark, sf_dir, "documents"), width=2)


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents, drawn by how much they resemble the benchmark."""
    return resample.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return main_text.extract_text(read_table(spark, sf_dir, "pages"))


def op13_dialog_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations damaged by rule and repaired by the lightest edits."""
    return dialog_repair.repair_digest(read_table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline over all documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_token_files": op2_token_files,
    "op3_license_scan": op3_license_scan,
    "op4_toxicity": op4_toxicity,
    "op5_language_id": op5_language_id,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_chat_format": op8_chat_format,
    "op9_url_rules": op9_url_rules,
    "op10_minhash": op10_minhash,
    "op11_resample": op11_resample,
    "op12_main_text": op12_main_text,
    "op13_dialog_repair": op13_dialog_repair,
    "pipeline": pipeline,
}


def _crc32_sql(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes: each byte is added to the
    state, then eight bits are shifted out (-1)."""
    steps = (f"flatten([[CAST('0x' || substr(hex({text}), 2 * i - 1, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1] "
             f"FOR i IN range(1, strlen({text}) + 1)])")
    step = "CASE WHEN x < 0 THEN xor(c >> 1, 3988292384 * (c & 1)) ELSE xor(c, x) END"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {steps}), lambda c, x: {step}), 4294967295::BIGINT)"


def _insert_sql(level: int) -> str:
    """One more row put in before the rows read so far, if that is cheaper."""
    put = lambda q: f"{{'c': s{q}.c + 2, 'a': 'I' || s{q}.a}}"
    states = ", ".join(f"list_min([s{p}, {put(q)}]) AS s{p}" for p, q in ((0, 2), (1, 2), (2, 3), (3, 2)))
    return f"i{level} AS (SELECT * EXCLUDE (s0, s1, s2, s3), {states} FROM i{level - 1})"


def _read_sql(p: int, arcs: str) -> str:
    """Lightest repair from state ``p`` with one row more: it is deleted, kept
    or given another role; ``arcs`` are pairs of an initial and the next state."""
    ways = [f"{{'c': s{p}.c + 3, 'a': 'D' || s{p}.a}}"]
    for r, q in arcs.split():
        ways.append(f"CASE WHEN can AND ini = '{r}' THEN {{'c': s{q}.c + cut, 'a': 'K' || s{q}.a}} END")
        if r != "s":
            ways.append(f"CASE WHEN can THEN {{'c': s{q}.c + 2 + cut, 'a': 'R' || s{q}.a}} END")
    return f"list_min([{', '.join(ways)}]) AS s{p}"


ORACLE: dict[str, str] = {
    "op11_resample": rf"""
        WITH d AS (
            SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
        dw AS (SELECT k, unnest(w) AS word FROM d),
        own AS (SELECT k, word, count(*) AS n FROM dw GROUP BY ALL),
        tw AS (SELECT word, count(*) AS n FROM b GROUP BY word),
        words AS (SELECT word, {_crc32_sql('word')} % 10000 AS bucket
                  FROM (SELECT word FROM own UNION SELECT word FROM tw)),
        s AS (SELECT bucket, sum(n) AS s FROM own JOIN words USING (word) GROUP BY bucket),
        t AS (SELECT bucket, sum(n) AS t FROM tw JOIN words USING (word) GROUP BY bucket),
        z AS (SELECT coalesce((SELECT sum(s) FROM s), 0) AS s_all, coalesce((SELECT sum(t) FROM t), 0) AS t_all),
        gain AS (
            SELECT bucket, CAST(floor(1000 * ln((CAST(coalesce(t, 0) AS DOUBLE) + 1) * (CAST(s_all AS DOUBLE) + 10000)
                / ((CAST(coalesce(s, 0) AS DOUBLE) + 1) * (CAST(t_all AS DOUBLE) + 10000)))) AS BIGINT) AS gain
            FROM s FULL JOIN t USING (bucket), z),
        weight AS (SELECT k, CAST(sum(n * gain) AS BIGINT) AS weight
                   FROM own JOIN words USING (word) JOIN gain USING (bucket) GROUP BY k),
        scored AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:'
                    || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))
                    AS BIGINT) AS score
            FROM d LEFT JOIN weight USING (k)),
        r AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20
                ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (n_features >= 20) OVER () AS able FROM scored)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END AS rank FROM r""",
    "op12_main_text": r"""
        WITH a AS (
            SELECT page_id, url, regexp_replace(regexp_extract(coalesce(html, ''),
                '(?s)<article>(.*?)(?:</article>|$)', 1), '(?s)<[^>]*$', '') AS inner_html
            FROM pages),
        b AS (
            SELECT page_id, url, [trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(
                x, '</?[a-z0-9]+>', ' ', 'g'), '&(quot|amp|copy|lt|gt)$', '&\1;'), '&quot;', '"'), '&copy;', '©'),
                '&middot;', '·'), '&amp;', '&'), '\s+', ' ', 'g'))
                FOR x IN regexp_split_to_array(inner_html, '</?(?:p|h1)>')] AS blocks
            FROM a),
        c AS (SELECT page_id, url, array_to_string([x FOR x IN blocks IF x <> ''], chr(10)) AS text FROM b)
        SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM c""",
    "op13_dialog_repair": rf"""
        WITH RECURSIVE g AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations),
        d AS (SELECT * EXCLUDE (key), {_crc32_sql('key')} % 20 AS kind FROM g),
        e AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
            FROM d WHERE kind <> 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM e),
        f AS (
            SELECT conv_id, turn, role, text, i, role[1] AS ini, count(*) OVER (PARTITION BY conv_id) AS n,
                CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN again > 1 THEN 'duplicate'
                    WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                role[1] || lead(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS pair
            FROM o),
        p AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS can, CAST(fault = 'truncated' AS BIGINT) AS cut FROM f),
        i0 AS (
            SELECT conv_id, n, n AS i, {{'c': 0::BIGINT, 'a': ''}} AS s0, NULL::STRUCT(c BIGINT, a VARCHAR) AS s1,
                NULL::STRUCT(c BIGINT, a VARCHAR) AS s2, {{'c': 0::BIGINT, 'a': ''}} AS s3
            FROM (SELECT DISTINCT conv_id, n FROM f)),
        {_insert_sql(1)}, {_insert_sql(2)}, {_insert_sql(3)},
        r AS (
            SELECT conv_id, n, i, s0, s1, s2, s3 FROM i3
            UNION ALL
            (WITH i0 AS (
                SELECT r.conv_id, r.n, r.i - 1 AS i, {_read_sql(0, 's1 u2')}, {_read_sql(1, 'u2')},
                    {_read_sql(2, 'a3')}, {_read_sql(3, 'u2')}
                FROM r JOIN p ON p.conv_id IS NOT DISTINCT FROM r.conv_id AND p.i = r.i),
            {_insert_sql(1)}, {_insert_sql(2)}, {_insert_sql(3)}
            SELECT conv_id, n, i, s0, s1, s2, s3 FROM i3)),
        best AS (SELECT conv_id, s0.c AS cost, s0.a AS audit FROM r WHERE i = 0),
        ops AS (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS k FROM best),
        x AS (
            SELECT conv_id, k, audit[k] AS op, length(translate(audit[1:k], 'I', '')) AS i,
                length(translate(audit[1:k], 'D', '')) AS out FROM ops),
        y AS (
            SELECT x.*, p.role, p.text,
                coalesce(max(op = 'K' AND out = 1 AND p.ini = 's') OVER (PARTITION BY x.conv_id), false) AS led
            FROM x LEFT JOIN p ON p.conv_id IS NOT DISTINCT FROM x.conv_id AND p.i = x.i AND op <> 'I'),
        said AS (
            SELECT conv_id, string_agg(CASE WHEN op = 'K' THEN role
                    WHEN (out + CAST(led AS BIGINT)) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                    || CASE WHEN op = 'I' THEN '' ELSE text END, chr(10) ORDER BY k) AS lines
            FROM y WHERE op <> 'D' GROUP BY conv_id),
        sums AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                count(*) FILTER (fault = 'truncated') AS truncated,
                count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM f GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
            coalesce(audit, '') AS audit, sha256(coalesce(lines, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) AS c
        LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "op6_embedding_dedup": r"""
        WITH RECURSIVE v AS (
            SELECT vec_id, label, [CAST(x AS DOUBLE) FOR x IN embedding] AS e FROM embeddings
            WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
                AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)),
        l AS (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        n AS (SELECT a, count(*) AS n FROM l GROUP BY a),
        c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
        SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(c, vec_id)) AS component_id,
            vec_id = least(vec_id, coalesce(c, vec_id)) AS kept
        FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id""",
    "op10_minhash": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        s AS (
            SELECT doc_id, list_distinct(CASE WHEN len(w) = 1 THEN w ELSE
                [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] END) AS s FROM w),
        z AS (SELECT doc_id, len(s) AS n FROM s),
        u AS (SELECT doc_id, unnest(s) AS g FROM s),
        i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
              FROM u AS a JOIN u AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
        p AS (SELECT a, b FROM i JOIN z AS x ON x.doc_id = a JOIN z AS y ON y.doc_id = b
              WHERE 100 * i.n >= 80 * (x.n + y.n - i.n)),
        l AS (SELECT a, b FROM p UNION ALL SELECT b, a FROM p),
        r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        c AS (SELECT a, min(b) AS c FROM r GROUP BY a)
        SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(c, doc_id)) AS component_id,
            doc_id = least(doc_id, coalesce(c, doc_id)) AS kept
        FROM z LEFT JOIN c ON c.a = doc_id""",
    "op8_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
                AS loss_sha256,
            CAST(sum(24 + length(role) + length(regexp_replace(role, '[^<\[\\\n]', '', 'g')) + length(text)
                + length(regexp_replace(text, '[^<\[\\]', '', 'g'))) AS BIGINT) AS formatted_chars
        FROM c GROUP BY conv_id""",
    "op9_url_rules": r"""
        WITH p AS (
            SELECT page_id, CASE WHEN position('://' IN url) > 0
                THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest
            FROM pages),
        q AS (
            SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM p),
        r AS (
            SELECT page_id, host, path, CASE
                WHEN ends_with('.' || host, '.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ends_with('.' || host, '.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ends_with('.' || host, '.net') AND starts_with(path, '/') THEN 'net/' END AS rule
            FROM q)
        SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict FROM r""",
}
