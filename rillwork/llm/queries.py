"""The registered queries of the training-data operators, with DuckDB SQL where SQL can express them.

A query derives the digest columns that its contract asks for from
the real outputs of its operator.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillwork.llm import langid, mixing, toxicity
from rillwork.llm.common import table
from rillwork.llm.decontaminate import contamination
from rillwork.llm.exact_dedup import exact_groups
from rillwork.llm.html_extract import main_text
from rillwork.llm.line_dedup import dedup_lines
from rillwork.llm.minhash_dedup import near_duplicates
from rillwork.llm.mixing import production_mixture
from rillwork.llm.pii import pseudonymise
from rillwork.llm.suffix_dedup import remove_repeats


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents"), length=50)
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def _crc(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels.where(_crc(5) != 0)))
    held_out = F.coalesce(_crc(5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(_crc(3) != 1).select("text", "lang"))
    held_out = F.coalesce(_crc(3) == 1, F.lit(False))
    return langid.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = dedup_lines(table(spark, sf_dir, "documents"), min_docs=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=13, min_share=20)
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production_mixture(table(spark, sf_dir, "documents")).drop("__th")


#: The session's setting that holds the pseudonyms' key, and the key of test tables.
PII_KEY, TEST_KEY = "spark.rillwork.pii.key", "rillwork"


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents"), key=spark.conf.get(PII_KEY, TEST_KEY))


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2, percent=80).drop("__th")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_toxicity,
        op3_langid,
        op4_html_extract,
        op5_line_dedup,
        op6_decontaminate,
        op7_exact_dedup,
        op8_mix_sources,
        op9_pii,
        op10_minhash_dedup,
    )
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLD = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"


def _mixing_sql() -> str:
    """The same tree, budgets and prefixes in SQL, level by level."""
    case = lambda column, weights: "CASE " + " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in weights.items()) + " ELSE 1 END"

    def level(depth: int, path: list[str], weight: str) -> str:
        keys, parent = ", ".join(path), ", ".join(path[:-1])
        source = f"(SELECT {keys}, sum(n_tokens) * {mixing.MAX_EPOCHS} AS capacity FROM tokens GROUP BY {keys})"
        joined = f"{source} JOIN (SELECT {parent}, budget AS parent_budget FROM level{depth - 1}) USING ({parent})" if parent else f"{source}, (SELECT CAST(floor(sum(n_tokens) * {mixing.BUDGET_SHARE}) AS BIGINT) AS parent_budget FROM tokens)"
        over = f"PARTITION BY {parent} " if parent else ""
        return f"""nodes{depth} AS (SELECT *, {weight} AS weight FROM {joined}),
        steps{depth} AS (SELECT *, (parent_budget - coalesce(sum(capacity) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS lev
            FROM nodes{depth} WINDOW w AS ({over}ORDER BY capacity / CAST(weight AS DOUBLE), {keys})),
        level{depth} AS (SELECT {keys}, greatest(0, least(CAST(capacity AS BIGINT), CAST(floor(weight * max(lev) OVER ({over.strip()})) AS BIGINT))) AS budget FROM steps{depth})"""

    number = "nullif(regexp_extract(source, '([0-9]{1,9})$', 1), '')"
    domain = f"CASE WHEN {number} IS NULL THEN NULL WHEN CAST({number} AS INT) < 5 THEN 'web' WHEN CAST({number} AS INT) < 10 THEN 'books' WHEN CAST({number} AS INT) < 15 THEN 'forums' ELSE 'news' END"
    return f"""
        WITH tokens AS (SELECT doc_id, coalesce({domain}, '(none)') AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
            CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t-\\r]+')) AS BIGINT) AS n_tokens FROM documents),
        {level(1, ["domain"], case("domain", mixing.DOMAINS))},
        {level(2, ["domain", "lang"], case("lang", mixing.LANGS))},
        {level(3, ["domain", "lang", "source"], "1")},
        leaves AS (SELECT domain, lang, source, CAST(sum(n_tokens) AS BIGINT) AS leaf FROM tokens GROUP BY ALL),
        plan AS (SELECT *, CASE WHEN leaf > 0 THEN CAST(budget // leaf AS INT) ELSE 0 END AS whole FROM leaves JOIN level3 USING (domain, lang, source)),
        placed AS (SELECT tokens.*, whole, budget - whole * leaf AS rest FROM tokens JOIN plan USING (domain, lang, source)),
        ranked AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source
            ORDER BY md5(concat_ws(':', '{mixing.SEED}', CAST(whole AS VARCHAR), coalesce(CAST(doc_id AS VARCHAR), ''))), doc_id ROWS UNBOUNDED PRECEDING) AS running FROM placed WHERE rest > 0)
        SELECT doc_id, domain, lang, source, n_tokens, CAST(unnest(range(whole)) AS INT) AS epoch FROM placed
        UNION ALL SELECT doc_id, domain, lang, source, n_tokens, whole AS epoch FROM ranked WHERE running <= rest"""


ORACLE: dict[str, str] = {
    "op5_line_dedup": f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        exploded AS (SELECT rid, doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM docs),
        keyed AS (SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'), '{_UPPER}', '{_LOWER}') AS k FROM exploded),
        frequent AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10),
        marked AS (SELECT keyed.*, frequent.k IS NOT NULL AS gone FROM keyed LEFT JOIN frequent ON keyed.k = frequent.k)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY rid""",
    "op6_decontaminate": f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLD}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM documents),
        items AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLD}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+') AS w FROM benchmark),
        sized AS (SELECT item, w, least(13, len(w)) AS size FROM items WHERE len(w) > 0),
        starts AS (SELECT item, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS p FROM sized),
        windows AS (SELECT DISTINCT item, size, array_to_string(w[p:p + size - 1], ' ') AS phrase FROM starts),
        sizes AS (SELECT DISTINCT size FROM sized),
        grams AS (SELECT rid, size, p, array_to_string(w[p:p + size - 1], ' ') AS phrase
                  FROM (SELECT rid, w, size, unnest(range(1, CAST(len(w) - size + 2 AS BIGINT))) AS p FROM docs JOIN sizes ON len(w) >= size)),
        found AS (SELECT rid, p, size, item FROM grams JOIN windows USING (size, phrase)),
        hit AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(p, p + size)) AS pos FROM found) GROUP BY rid),
        named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)""",
    "op7_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256({_FOLD}) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY {_FOLD})""",
    "op8_mix_sources": _mixing_sql(),
    "op10_minhash_dedup": f"""
        WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_FOLD}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
        sets AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
                   ELSE list_distinct(list_transform(range(1, CAST(len(w) AS BIGINT)), lambda i: w[i] || ' ' || w[i + 1])) END) AS s FROM docs),
        sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
        pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
        edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
        reach(doc_id, other) AS (SELECT doc_id, doc_id FROM docs UNION SELECT reach.doc_id, edges.b FROM reach JOIN edges ON edges.a = reach.other)
        SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
        FROM reach LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
}
