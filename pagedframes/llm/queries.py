"""The registered queries of the corpus operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagedframes.llm import (
    audit,
    backoff,
    decontaminate,
    exact,
    jaccard,
    lines,
    merkle,
    packing,
    quality,
    substring,
    token_counts,
    urls,
    warc,
)
from pagedframes.llm.common import documents
from pagedframes.llm.tokens import tokenizer_path

RULES = (
    urls.Rule("block", "net/"),
    urls.Rule("allow", "example.net/en/"),
    urls.Rule("block", "example.com/de/"),
    urls.Rule("allow", "org/fr/"),
)
#: weights of sources in percent; all others share the rest
MIXTURE = {"src0": 30, "src1": 10, "src2": 10, "src3": 5}
REST = 45


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), RULES)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(documents(spark, sf_dir), tokenizer_path(), MIXTURE, REST, ids=False)
    return packed.drop("ids")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.find_copies(documents(spark, sf_dir))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_repeated_lines(documents(spark, sf_dir))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    records = warc.read_records(index, payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(documents(spark, sf_dir), n=4, percent=85)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    trees = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality.score(docs, trees)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = token_counts.length_histogram(documents(spark, sf_dir), tokenizer_path())
    return token_counts.limits(histogram)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(documents(spark, sf_dir)).drop("proof")


def op13_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_texts(documents(spark, sf_dir))


_NORMAL = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')"
_SPACE = "concat(chr(9), chr(10), chr(11), chr(12), chr(13), ' ')"
_FIELD = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
_LEAF = " || ".join(map(_FIELD.format, ("doc_id", "source", "lang", "{n}", "text")))
# CRC-32 bit by bit: a byte goes in by xor, and a -1 stands for a shift
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(
    string_split(doc_id::VARCHAR, ''), lambda c: list_prepend(ascii(c)::BIGINT, list_transform(range(8), lambda k: -1::BIGINT))))),
    lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, (a & 1) * 3988292384) END))"""
_ABOVE = "list_transform(range((len(nodes) + 1) // 2), lambda k: sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], '')))"
_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE = {
    "op4_exact_dedup": f"""
        WITH t AS (SELECT doc_id, {_NORMAL} AS body FROM documents)
        SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = min(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body)""",
    "op5_line_dedup": f"""
        WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS held FROM documents),
        l AS (SELECT doc_id, unnest(held) AS line, unnest(range(len(held))) AS pos FROM d),
        k AS (SELECT *, {_LOW.format(f"trim(line, {_SPACE})")} AS key FROM l),
        c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
              GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        j AS (SELECT k.doc_id, line, pos, keeper IS NOT NULL AND keeper <> k.doc_id AS lost FROM k LEFT JOIN c USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
        m AS (SELECT page_id, strlen(body) AS n, sha1(body) AS digest, max(page_id) OVER (PARTITION BY body) AS last FROM p)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest,
               CASE WHEN n >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND last <> page_id THEN last END AS refers_to
        FROM m""",
    "op11_filter_audit": r"""
        WITH RECURSIVE l AS (
            SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic
            FROM labels GROUP BY doc_id),
        t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents),
        w AS (SELECT *, list_filter(regexp_split_to_array(body, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
                     min(doc_id) OVER (PARTITION BY body) AS first FROM t),
        m AS (SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                     (len(words) < 100)::INT + 2 * (100 * len(list_distinct(words)) < 80 * len(words))::INT
                     + 4 * (100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 10 * length(body))::INT
                     + 8 * regexp_matches(body, '[#$%&*|]')::INT + 16 * coalesce(first < w.doc_id, false)::INT AS fails
              FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
        c AS (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
        o AS (SELECT '' AS filter_order, 0 AS done
              UNION ALL
              SELECT filter_order || chr(65 + k::INT), done + (1 << k::INT) FROM o, range(5) f(k) WHERE (done >> k::INT) & 1 = 0),
        s AS (SELECT whole.filter_order, length(o.filter_order) + 1 AS step, o.done AS earlier,
                     1 << (ascii(whole.filter_order[length(o.filter_order) + 1]) - 65) AS bit
              FROM o JOIN o AS whole ON whole.done = 31 AND o.done < 31 AND starts_with(whole.filter_order, o.filter_order)),
        r AS (SELECT part, filter_order, step::INT AS step, bit,
                     sum(n) FILTER (fails & (earlier | bit) = 0) AS kept,
                     sum(n) FILTER (fails & earlier = 0 AND fails & bit > 0) AS removed,
                     sum(n) FILTER (fails & earlier > 0 AND fails & bit > 0) AS redundant,
                     sum(n) FILTER (fails = bit) AS unique_fails,
                     sum(n) FILTER (fails & earlier = 0 AND fails & bit > 0 AND good) AS good_lost,
                     sum(n) FILTER (fails & earlier = 0 AND fails & bit > 0 AND toxic) AS toxic_lost
              FROM c, s GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
               coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
               coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
               sum(coalesce(removed, 0)) OVER (PARTITION BY part, bit)::BIGINT AS shapley
        FROM r""",
    "op12_merkle": f"""
        WITH RECURSIVE d AS (
            SELECT doc_id, lang, sha256({_LEAF.format(n="n_chars")}) AS leaf, {_CRC} % 7 = 0 AS hit,
                   sha256({_LEAF.format(n="(n_chars::HUGEINT + 1)")}) AS changed
            FROM documents),
        p AS (SELECT doc_id, lang, leaf, CASE WHEN hit THEN changed ELSE leaf END AS start,
                     row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
        trees AS (
            SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS nodes FROM p GROUP BY lang
            UNION ALL SELECT lang, level + 1, {_ABOVE} FROM trees WHERE len(nodes) > 1),
        parts AS (
            SELECT lang, max(level) AS height, max_by(nodes[1], level) AS subroot,
                   row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM trees GROUP BY lang),
        top AS (
            SELECT 0 AS level, list(subroot ORDER BY pos) AS nodes FROM parts
            UNION ALL SELECT level + 1, {_ABOVE} FROM top WHERE len(nodes) > 1),
        steps AS (
            SELECT lang, level, nodes, pos FROM trees JOIN (SELECT lang AS l, height FROM parts) h
                ON h.l IS NOT DISTINCT FROM lang AND level < height, (SELECT -1 AS pos)
            UNION ALL SELECT lang, height + level, nodes, pos FROM parts, top WHERE len(nodes) > 1),
        folded AS (
            SELECT doc_id, p.lang, leaf, pos, 0 AS level, start AS node, '' AS proof FROM p
            UNION ALL
            SELECT doc_id, f.lang, leaf, k // 2, f.level + 1,
                   CASE WHEN k % 2 = 1 THEN sha256(nodes[k] || node) ELSE sha256(node || coalesce(nodes[k + 2], '')) END,
                   proof || CASE WHEN k % 2 = 1 THEN nodes[k] ELSE coalesce(nodes[k + 2], '') END
            FROM (SELECT f.*, s.nodes, CASE WHEN f.level = height THEN parts.pos ELSE f.pos END AS k
                  FROM folded f JOIN steps s ON s.lang IS NOT DISTINCT FROM f.lang AND s.level = f.level
                  JOIN parts ON parts.lang IS NOT DISTINCT FROM f.lang) f)
        SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
        FROM folded f JOIN parts ON parts.lang IS NOT DISTINCT FROM f.lang,
             (SELECT max_by(nodes[1], level) AS root, max(level) AS more FROM top)
        WHERE f.level = height + more""",
}

QUERIES = {
    query.__name__: query
    for query in (
        op1_url_filter,
        op2_packing,
        op3_substring_dedup,
        op4_exact_dedup,
        op5_line_dedup,
        op6_warc,
        op7_decontamination,
        op8_jaccard_join,
        op9_quality,
        op10_token_counts,
        op11_filter_audit,
        op12_merkle,
        op13_lm_scoring,
    )
}
