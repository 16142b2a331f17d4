"""One query per operator over whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pairlab.llm import (
    bpe,
    decontaminate,
    fm_dedup,
    html,
    merkle,
    minhash,
    quality,
    sharding,
    spelling,
    suffix_dedup,
    token_counts,
    topk_search,
    url_filter,
)

URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=4, percent=80)


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=16)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return token_counts.token_counts(docs, public_tokenizers.path("byte_bpe_50k.json"), limit=512).drop("fits")


def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_products(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), k=10, every=100)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return decontaminate.contaminated(docs, items)


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), width=100)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return bpe.digest(docs, public_tokenizers.path("word_bpe_49k.json"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fm_dedup.digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), window=20)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return quality.classify(docs, labels, threshold=0.7)


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), URL_RULES)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return merkle.audit(docs, changed=merkle.lower_cased_third())


QUERIES = {name: made for name, made in list(globals().items()) if name.startswith("op")}


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text column, bit by bit."""
    codes = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    shifted = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda d, z: xor(d >> 1, (d & 1) * 3988292384))"
    return f"xor(list_reduce([4294967295] || {codes}, lambda c, b: {shifted}), 4294967295)"


LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(text: str) -> str:
    return f"translate({text}, '{LETTERS}', '{LETTERS.lower()}')"


def _spelling_sql() -> str:
    """Near words by what is left of them without one code point: equal remains, or one word the remains of the other."""
    return f"""
        WITH
        runs AS (SELECT doc_id, {_lower("r")} AS r, count(*) AS n
                 FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS r FROM documents)
                 GROUP BY ALL),
        hashed AS (SELECT r, n, {_crc32("doc_id || ':' || r")} AS h FROM runs WHERE length(r) >= 5),
        damaged AS (SELECT CASE WHEN h % 97 = 0 THEN r[:h % length(r)] || r[h % length(r) + 2:] ELSE r END AS word, n
                    FROM hashed),
        w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 5
              GROUP BY word HAVING sum(n) >= 3),
        cut AS (SELECT word, i, word[:i - 1] || word[i + 1:] AS rest
                FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
        nearby AS (SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
                 UNION SELECT cut.word, w.word FROM cut JOIN w ON w.word = cut.rest
                 UNION SELECT w.word, cut.word FROM cut JOIN w ON w.word = cut.rest),
        best AS (SELECT nearby.word, count(*) AS n_near, min({{'minus': -w.n, 'word': w.word}}) AS b
                 FROM nearby JOIN w ON w.word = nearby.other GROUP BY nearby.word),
        known AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                         CASE WHEN -b.minus >= 2 * w.n THEN b.word END AS form,
                         CASE WHEN -b.minus >= 2 * w.n THEN -b.minus END AS form_n
                  FROM w LEFT JOIN best ON best.word = w.word),
        up AS (WITH RECURSIVE u AS (SELECT word, word AS root FROM known
                                    UNION ALL SELECT u.word, k.form FROM u JOIN known k ON k.word = u.root AND k.form IS NOT NULL)
               SELECT u.word, u.root FROM u JOIN known k ON k.word = u.root AND k.form IS NULL)
        SELECT known.word, form, root, n, n_near, form_n FROM known JOIN up ON up.word = known.word"""


def _url_sql() -> str:
    """Each term as a pattern between boundaries, each rule as a row."""

    def distinct(terms) -> str:
        edge = r"[^a-z0-9\x{80}-\x{10FFFF}]"
        return " + ".join(f"CAST(regexp_matches(low, '(^|{edge}){t}($|{edge})') AS BIGINT)" for t in terms)

    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
        WITH p AS (SELECT page_id, coalesce(url, '') AS url, {_lower("coalesce(url, '')")} AS low, strpos(coalesce(url, ''), '://') AS mark
                   FROM pages),
        cut AS (SELECT *, CASE WHEN mark > 0 THEN regexp_extract(url[mark + 3:], '^[^?#]*') ELSE '' END AS rest FROM p),
        parts AS (SELECT page_id, low, {_lower("regexp_extract(rest, '^[^/]*')")} AS host,
                         regexp_extract(rest, '^[^/]*((?s:.*))$', 1) AS path FROM cut),
        rules(verdict, host, path) AS (VALUES {rules}),
        fits AS (SELECT page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule,
                        max_by(r.verdict, length(r.host || r.path)) AS verdict
                 FROM parts JOIN rules r ON (parts.host = r.host OR ends_with(parts.host, '.' || r.host)) AND starts_with(parts.path, r.path)
                 GROUP BY page_id),
        counted AS (SELECT page_id, host, path, {distinct(url_filter.STRICT)} AS n_strict, {distinct(url_filter.SOFT)} AS n_soft
                    FROM parts)
        SELECT c.page_id, host, path, rule,
               coalesce(verdict, CASE WHEN n_strict > 0 OR n_soft >= {url_filter.DISTINCT_SOFT} THEN 'block' ELSE 'allow' END) AS verdict,
               n_strict, n_soft
        FROM counted c LEFT JOIN fits ON fits.page_id = c.page_id"""


def _merkle_sql(levels: int = 8, upper_levels: int = 3) -> str:
    """Level by level: a run's hash is its nodes' digests joined; each node knows those before and after it in its run."""

    def fields(text: str) -> str:
        columns = ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)
        return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in columns) + ")"

    def tree(name: str, key: str, depth: int) -> str:
        parts = []
        for k in range(depth):
            run = f"PARTITION BY {key}, i // 8 ORDER BY i ROWS BETWEEN"
            parts.append(f"""
        {name}{k}x AS (SELECT {key}, i, h, n,
                coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
                coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
            FROM {name}{k}),
        {name}{k + 1} AS (SELECT {key}, i // 8 AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h,
                (any_value(n) + 7) // 8 AS n
            FROM {name}{k} GROUP BY {key}, i // 8)""")
        return ",".join(parts)

    def climb(name: str, prefix: str, start: str, key: str, depth: int) -> str:
        parts, at = [], start
        for k in range(depth):
            parts.append(f"""
        {prefix}{k} AS (SELECT f.* EXCLUDE (proof, folded), f.proof || CASE WHEN x.n > 1 THEN x.before || x.after ELSE '' END AS proof,
                CASE WHEN x.n > 1 THEN sha256(x.before || f.folded || x.after) ELSE f.folded END AS folded
            FROM {at} f JOIN {name}{k}x x ON x.{key} = f.{key} AND x.i = f.{"place" if name == "t" else "i"} // {8**k})""")
            at = f"{prefix}{k}"
        return ",".join(parts)

    return f"""
        WITH
        d AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {fields("text")} AS h,
                     CASE WHEN {_crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN {fields(_lower("text"))} END AS changed
              FROM documents),
        l0 AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, h) - 1 AS i, count(*) OVER (PARTITION BY g) AS n
               FROM d),
        {tree("l", "g", levels)},
        t0 AS (SELECT 0 AS one, g, h, row_number() OVER (ORDER BY g) - 1 AS i, count(*) OVER () AS n FROM l{levels}),
        {tree("t", "one", upper_levels)},
        s AS (SELECT l0.doc_id, l0.g, l0.i, l0.h AS leaf, t0.h AS subroot, 0 AS one, t0.i AS place, '' AS proof,
                     coalesce(l0.changed, l0.h) AS folded
              FROM l0 JOIN t0 ON t0.g = l0.g),
        {climb("l", "a", "s", "g", levels)},
        {climb("t", "b", f"a{levels - 1}", "one", upper_levels)}
        SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
        FROM b{upper_levels - 1} b JOIN t{upper_levels} t ON t.i = 0"""


ORACLES: dict[str, str] = {
    "op11_spelling": _spelling_sql(),
    "op12_url_filter": _url_sql(),
    "op13_merkle": _merkle_sql(),
    "op4_topk_search": """
        WITH v AS (SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE) FOR x IN embedding] AS e
                   FROM embeddings),
        s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
              FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
        SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= 10""",
}
