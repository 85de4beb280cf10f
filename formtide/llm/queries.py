"""One query per operator over its whole table, and the same in SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formtide.llm import audit, bpe, decontaminate, jaccard, katz, licenses, lines, pii, prefixes, quality, shards, substrings, urls


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def read_bytes(path: str) -> bytes:
    with open(path, "rb") as file:
        return file.read()


def op1_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Boilerplate lines of each source, dropped from the texts of ``documents``."""
    docs = table(spark, folder, "documents").select("doc_id", "source", "text")
    kept = lines.drop_boilerplate(docs, host="source", counts=True)
    return kept.select("doc_id", "source", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Items of ``benchmark`` in each of the ``documents``."""
    docs, benchmark = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return decontaminate.contamination(docs, benchmark)


def op3_substrings(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of ``documents`` without the 50-byte strings of documents with smaller ids."""
    rest = substrings.remove_repeats(table(spark, folder, "documents"))
    return rest.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger of ``documents`` under the base policy and the full one."""
    entries = quality.ledger(table(spark, folder, "documents"))
    judged = quality.apply_policy(entries, quality.FULL).withColumn(
        "base_failed", F.col("failed").bitwiseAND(F.lit(quality.BASE.mask)) != 0
    )
    return judged.select("doc_id", *quality.MEASURES, "failed", "base_failed", "kept")


RULES = (
    urls.Rule("allow", "com/"),
    urls.Rule("block", "example.com/en/"),
    urls.Rule("allow", "www.example.com/en/"),
    urls.Rule("block", "net/es/"),
    urls.Rule("block", "net/fr/"),
)


def op5_urls(spark: SparkSession, folder: str) -> DataFrame:
    """Rules and template purity for every url of ``pages``."""
    return urls.filter_urls(table(spark, folder, "pages"), RULES)


def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Base spans of every text of ``documents``, and those that a model of them adds."""
    return pii.fit_and_scan(table(spark, folder, "documents"))


def op7_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Encodes and decodes every text of ``documents``."""
    vocabulary = read_bytes(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return bpe.round_trip(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN)


def op8_shards(spark: SparkSession, folder: str) -> DataFrame:
    """All ``documents`` in 24 shards, and where they stand with one shard more."""
    return shards.shard_documents(table(spark, folder, "documents"), 24)


def op9_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate components of ``documents``."""
    return jaccard.similar_groups(table(spark, folder, "documents"))


def op10_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and template spans of every text of ``documents``."""
    return licenses.scan(table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The prefix trie of ``conversations`` after each takes its first turns from another."""
    return prefixes.trie(table(spark, folder, "conversations"))


def op12_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    """What each of five filters does at every step of every order, by source of ``documents``."""
    return audit.interactions(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op13_katz(spark: SparkSession, folder: str) -> DataFrame:
    """Every text of ``documents`` under a Katz backoff model of the six sevenths that it is trained on."""
    return katz.score_documents(table(spark, folder, "documents"))


QUERIES = {
    "op1_lines": op1_lines,
    "op2_decontamination": op2_decontamination,
    "op3_substrings": op3_substrings,
    "op4_quality": op4_quality,
    "op5_urls": op5_urls,
    "op6_pii": op6_pii,
    "op7_bpe": op7_bpe,
    "op8_shards": op8_shards,
    "op9_jaccard": op9_jaccard,
    "op10_licenses": op10_licenses,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_katz": op13_katz,
}

LINES_SQL = """
WITH docs AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS page, string_split(coalesce(text, ''), chr(10)) AS parts
              FROM documents),
     lines AS (SELECT doc_id, host, page, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM docs),
     boiler AS (
         SELECT host, trim(line) AS line FROM lines JOIN (SELECT host, count(DISTINCT page) AS total FROM docs GROUP BY host) USING (host)
         WHERE trim(line) <> '' GROUP BY host, trim(line), total
         HAVING count(DISTINCT page) > 1 AND count(DISTINCT page) > 0.1 * total),
     flags AS (
         SELECT l.doc_id, l.line, l.pos, trim(l.line) <> '' AS solid, b.line IS NOT NULL AS hit
         FROM lines l LEFT JOIN boiler b ON b.host = l.host AND b.line = trim(l.line)),
     pages AS (
         SELECT doc_id, count(*) FILTER (solid) AS n_lines, count(*) FILTER (hit) AS n_dropped,
                coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT hit), '') AS rest
         FROM flags GROUP BY doc_id)
"""
ORACLES: dict[str, str] = {
    "op1_lines": LINES_SQL
    + """
SELECT doc_id, source, n_lines, n_dropped, sha256(CASE WHEN text IS NULL THEN '' ELSE rest END) AS kept_sha256
FROM pages JOIN documents USING (doc_id)
""",
}

QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
     w AS (SELECT doc_id, t, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
     grams AS (SELECT doc_id, i, w[i] || chr(31) || w[i + 1] || chr(31) || w[i + 2] AS g
               FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
     twice AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
     covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(3) t(k) GROUP BY doc_id),
     lines AS (SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
               FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
               WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
     m AS (
         SELECT doc_id, len(w) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                coalesce(lines.n, 0) AS n_lines, coalesce(dup, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words,
                length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper
         FROM w LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
     f AS (
         SELECT *, CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
                + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
                + CASE WHEN word_chars > 10 * n_words THEN 8 ELSE 0 END + CASE WHEN word_chars < 3 * n_words THEN 16 ELSE 0 END
                + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 32 ELSE 0 END
                + CASE WHEN 100 * n_upper > 30 * word_chars THEN 64 ELSE 0 END AS failed
         FROM m)
"""
ORACLES["op4_quality"] = (
    QUALITY_SQL
    + """
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_lines::BIGINT AS n_lines, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       n_upper::BIGINT AS n_upper, failed::BIGINT AS failed, failed & 3 <> 0 AS base_failed, failed = 0 AS kept
FROM f
"""
)


def _urls_sql(depth: int = 6) -> str:
    """Down to ``depth`` segments; the given paths have two."""
    fits = lambda r: f"((host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}'))"
    by_length = sorted(RULES, key=lambda r: -len(r.text))
    rule = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.text}'" for r in by_length) + " END"
    given = "CASE " + " ".join(f"WHEN {fits(r)} THEN '{r.verdict}'" for r in by_length) + " END"
    sql = f"""
WITH split AS (
         SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
         FROM pages),
     judged AS (
         SELECT page_id, host, path, {rule} AS rule, {given} AS given,
                list_filter(string_split(regexp_replace(path, '[0-9]+', '{{n}}', 'g'), '/'), lambda s: s <> '') AS s FROM split),
     counts AS (
         SELECT host, s, count(*) AS pages, count(*) FILTER (given = 'allow') AS good, count(*) FILTER (given = 'block') AS bad
         FROM judged GROUP BY host, s),
     t0 AS (
         SELECT *, '' AS template,
                (SELECT coalesce(sum(good)::DOUBLE / nullif(sum(good + bad), 0), 1.0::DOUBLE) FROM counts) AS above FROM counts)"""
    for k in range(1, depth + 1):
        sql += f""",
     b{k} AS (
         SELECT host, template, s[{k}] AS seg, sum(pages) AS pages, sum(good) AS good, sum(bad) AS bad
         FROM t{k - 1} WHERE len(s) >= {k} GROUP BY ALL),
     n{k} AS (
         SELECT host, template, count(*) AS n, sum(pages) AS total, sum(good) AS g, sum(good) + sum(bad) AS known,
                (sum(good) + 0.5::DOUBLE) / (sum(good) + sum(bad) + 1) AS node
         FROM b{k} GROUP BY ALL),
     c{k} AS (
         SELECT b.host, b.template, seg, n, g, known, (good + 0.5::DOUBLE) / (good + bad + 1) AS rate,
                CASE WHEN n > 20 AND pages * 20 < total THEN '*'
                     WHEN n > 1 AND good + bad >= 5
                          AND (rate - node) * (rate - node) * (good + bad)::DOUBLE <= 3.84::DOUBLE * node * (1 - node) THEN '*'
                     ELSE seg END AS step
         FROM b{k} b JOIN n{k} n ON n.host = b.host AND n.template = b.template),
     t{k} AS (
         SELECT t.host, s, pages, good, bad, t.template || coalesce('/' || step, '') AS template,
                CASE WHEN c.n > 1 THEN (g::DOUBLE + 5.0::DOUBLE * above) / (known::DOUBLE + 5.0::DOUBLE) ELSE above END AS above
         FROM t{k - 1} t LEFT JOIN c{k} c ON c.host = t.host AND c.template = t.template AND c.seg = s[{k}])"""
    return (
        sql
        + f""",
     purity AS (
         SELECT host, template, sum(good + bad)::BIGINT AS n_labels,
                (sum(good)::DOUBLE + 5.0::DOUBLE * min(above)) / (sum(good + bad)::DOUBLE + 5.0::DOUBLE) AS purity
         FROM t{depth} GROUP BY host, template)
SELECT page_id, j.host, path, rule,
       coalesce(given, CASE WHEN n_labels >= 5 AND purity < 0.5 THEN 'block' ELSE 'allow' END) AS verdict, k.template, n_labels, purity
FROM judged j JOIN t{depth} k ON k.host = j.host AND k.s = j.s JOIN purity p ON p.host = k.host AND p.template = k.template
"""
    )


ORACLES["op5_urls"] = _urls_sql()

ORACLES["op12_filter_audit"] = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
     marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
               FROM labels GROUP BY doc_id),
     f AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                  CASE WHEN len(w) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
                  + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
                  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
                  + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS bits
           FROM d LEFT JOIN marks ON marks.doc_id = d.doc_id),
     cells AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
     letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
     orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
                FROM letters a, letters b, letters c, letters d, letters e
                WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
     bit AS (SELECT filter_order, step::INT AS step,
                    (1 << (ascii(filter_order[step]) - 65)) AS own,
                    coalesce(list_sum(list_transform(range(1, step), lambda k: 1 << (ascii(filter_order[k]) - 65))), 0)::INT AS before
             FROM orders, (SELECT unnest(range(1, 6)) AS step)),
     steps AS (
         SELECT part, filter_order, step, own,
                coalesce(sum(n) FILTER (bits & (own | before) = 0), 0)::BIGINT AS kept,
                coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before = 0), 0)::BIGINT AS removed,
                coalesce(sum(n) FILTER (bits & own <> 0 AND bits & before <> 0), 0)::BIGINT AS redundant,
                coalesce(sum(n) FILTER (bits = own), 0)::BIGINT AS unique_fails,
                coalesce(sum(good) FILTER (bits & own <> 0 AND bits & before = 0), 0)::BIGINT AS good_lost,
                coalesce(sum(toxic) FILTER (bits & own <> 0 AND bits & before = 0), 0)::BIGINT AS toxic_lost
         FROM cells, bit GROUP BY ALL)
SELECT * EXCLUDE (own), (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM steps
"""

ORACLES["op11_prefix_trie"] = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
     k AS (SELECT *, strlen(text) AS size, strlen(role) || ':' || role || text AS kind FROM t),
     turns AS (SELECT conv_id, size, dense_rank() OVER (ORDER BY kind) AS id,
                      row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(kind)) AS pos FROM k),
     convs AS (SELECT conv_id, conv_id - conv_id % 5 AS base, list_reduce(list_concat([4294967295::BIGINT],
                      list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                      lambda a, b: list_reduce(list_concat([xor(a, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                               lambda x, y: xor(x >> 1, (x & 1) * 3988292384::BIGINT + y))) AS crc
               FROM (SELECT DISTINCT conv_id FROM turns)),
     h AS (SELECT conv_id, base, xor(crc, 4294967295::BIGINT) % 9 AS h FROM convs),
     whole AS (SELECT h.conv_id, 0 AS own, pos, id, size FROM h JOIN turns ON turns.conv_id = h.base WHERE pos <= h
               UNION ALL SELECT h.conv_id, 1, pos, id, size FROM h JOIN turns USING (conv_id) WHERE pos > h),
     lists AS (SELECT conv_id, list(id ORDER BY own, pos) AS ids, list(size ORDER BY own, pos) AS sizes FROM whole GROUP BY conv_id),
     paths AS (SELECT conv_id, coalesce(ids, []) AS ids, coalesce(sizes, []) AS sizes FROM h LEFT JOIN lists USING (conv_id)),
     steps AS (SELECT conv_id, depth, depth = len(ids) AS ends, sha256(ids[1:depth]::VARCHAR) AS node,
                      CASE WHEN depth > 0 THEN sha256(ids[1:depth - 1]::VARCHAR) END AS parent, coalesce(sizes[depth], 0) AS size
               FROM (SELECT *, unnest(range(0, len(ids) + 1)) AS depth FROM paths)),
     nodes AS (SELECT node, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(size) AS weight,
                      sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
               FROM steps GROUP BY node, parent, depth),
     below AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
     family AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN below USING (node)),
     sums AS (SELECT s.node, count(*) FILTER (f.n_children = 0) AS n_leaves, sum(f.weight) AS saved
              FROM family f JOIN steps s ON s.conv_id = f.conv_id AND s.depth <= f.depth GROUP BY s.node)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves,
       saved::BIGINT AS saved_tokens, f.ends_sha256
FROM family f JOIN sums ON sums.node = f.node LEFT JOIN nodes p ON p.node = f.parent
"""
