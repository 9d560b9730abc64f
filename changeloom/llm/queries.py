"""One query per operator, with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from changeloom.llm import (
    bpe, chat, html_text, language, line_windows, mixing, negatives, quality, ranking, simhash, substrings, units, vectors,
)
from changeloom.plans.catalog import Query

#: Vocabulary of the byte-level encoding.
VOCABULARY = "byte_bpe_50k.tiktoken"

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def add(plan):
        QUERIES[name] = Query(name, plan, sql)
        return plan

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op3_quality_rules")
def op3(spark, sf_dir):
    return quality.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good", "votes"
    )


@query(
    "op10_line_dedup",
    r"""
    WITH line AS (
        SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS nr
        FROM documents WHERE text IS NOT NULL),
    full_line AS (
        SELECT doc_id, line, nr, row_number() OVER (PARTITION BY doc_id ORDER BY nr) AS k
        FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
    win AS (
        SELECT a.doc_id, a.nr AS n1, b.nr AS n2, c.nr AS n3, a.line AS l1, b.line AS l2, c.line AS l3
        FROM full_line a JOIN full_line b ON a.doc_id = b.doc_id AND b.k = a.k + 1
        JOIN full_line c ON a.doc_id = c.doc_id AND c.k = a.k + 2),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY l1, l2, l3 ORDER BY doc_id, n1) AS seen FROM win),
    gone AS (
        SELECT DISTINCT doc_id, unnest([n1, n2, n3]) AS nr FROM ranked WHERE seen > 1),
    kept AS (
        SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.nr) FILTER (g.nr IS NULL) AS text,
               count(g.nr) AS n_removed
        FROM line l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.nr = g.nr GROUP BY l.doc_id),
    counts AS (SELECT doc_id, count(*) AS n_lines FROM full_line GROUP BY doc_id)
    SELECT d.doc_id, coalesce(c.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed,
           CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
    FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN counts c ON d.doc_id = c.doc_id
    """,
)
def op10(spark, sf_dir):
    done = line_windows.dedup_lines(table(spark, sf_dir, "documents"))
    return done.select(
        "row.doc_id", "info.n_lines", "info.n_removed", F.sha2("row.text", 256).alias("kept_sha256")
    )


@query("op9_simhash_near_dedup")
def op9(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op5_byte_bpe")
def op5(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)


@query("op6_mix_sources")
def op6(spark, sf_dir):
    return mixing.taken(table(spark, sf_dir, "documents"))


@query(
    "op2_embedding_near_dedup",
    """
    WITH RECURSIVE v AS (
        SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
          AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    link AS (
        SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
        WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
    reach AS (
        SELECT x AS node, x AS seen FROM link UNION SELECT r.node, l.y FROM reach r JOIN link l ON r.seen = l.x),
    root AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node),
    counts AS (SELECT x AS node, count(*) AS n_links FROM link GROUP BY x)
    SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, coalesce(r.component_id, e.vec_id) AS component_id,
           e.vec_id = coalesce(r.component_id, e.vec_id) AS kept
    FROM embeddings e LEFT JOIN counts c ON e.vec_id = c.node LEFT JOIN root r ON e.vec_id = r.node
    """,
)
def op2(spark, sf_dir):
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op1_html_text")
def op1(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query(
    "op4_unit_dedup",
    r"""
    WITH marked AS (
        SELECT doc_id, text, regexp_replace(text, '([.!?])[\x20\x09-\x0D]', '\1' || chr(10), 'g') AS cut
        FROM documents WHERE text IS NOT NULL),
    part AS (
        SELECT doc_id, text, unnest(string_split(cut, chr(10))) AS part,
               generate_subscripts(string_split(cut, chr(10)), 1) AS k FROM marked),
    placed AS (
        SELECT doc_id, k, length(part) AS n,
               substr(text, CAST(1 + sum(length(part) + 1) OVER (PARTITION BY doc_id ORDER BY k) - length(part) - 1 AS BIGINT),
                      length(part) + 1) AS piece,
               len(regexp_extract_all(part, '[^\x20\x09-\x0D]+')) AS words,
               md5(translate(regexp_replace(part, '[\x20\x09-\x0D!-/:-@\[-`{-~]', '', 'g'),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS h,
               length(regexp_replace(part, '[\x20\x09-\x0D!-/:-@\[-`{-~]', '', 'g')) > 0 AS is_full
        FROM part),
    unit AS (
        SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k) AS nr,
               row_number() OVER (PARTITION BY h ORDER BY doc_id, k) > 1 AS is_later
        FROM placed WHERE is_full),
    run AS (
        SELECT *, nr - row_number() OVER (PARTITION BY doc_id, is_later ORDER BY nr) AS island FROM unit),
    sized AS (
        SELECT *, is_later AND sum(words) OVER (PARTITION BY doc_id, is_later, island) >= 25 AS goes FROM run),
    kept AS (
        SELECT p.doc_id, string_agg(p.piece, '' ORDER BY p.k) FILTER (NOT coalesce(s.goes, false)) AS text,
               count(s.k) AS n_units, count(*) FILTER (s.goes) AS n_removed,
               CAST(coalesce(sum(s.words) FILTER (s.goes), 0) AS BIGINT) AS n_removed_words
        FROM placed p LEFT JOIN sized s ON p.doc_id = s.doc_id AND p.k = s.k GROUP BY p.doc_id)
    SELECT d.doc_id, coalesce(k.n_units, 0) AS n_units, coalesce(k.n_removed, 0) AS n_removed,
           coalesce(k.n_removed_words, 0) AS n_removed_words,
           CASE WHEN d.text IS NULL THEN NULL ELSE sha256(coalesce(k.text, '')) END AS kept_sha256
    FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
    """,
)
def op4(spark, sf_dir):
    done = units.dedup_units(table(spark, sf_dir, "documents"))
    return done.select(
        "row.doc_id", "info.n_units", "info.n_removed", "info.n_removed_words", F.sha2("row.text", 256).alias("kept_sha256")
    )


@query("op8_language_id")
def op8(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return language.predict(docs, language.learn(docs))


@query(
    "op7_substring_dedup",
    r"""
    WITH doc AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    place AS (
        SELECT doc_id, unnest(generate_series(0, CAST(length(x) // 2 - 200 AS BIGINT))) AS pos, x
        FROM doc WHERE length(x) >= 400),
    win AS (SELECT doc_id, pos, md5(substr(x, CAST(2 * pos + 1 AS BIGINT), 400)) AS h FROM place),
    again AS (SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY h) AS n FROM win) WHERE n > 1),
    run AS (
        SELECT doc_id, min(pos) AS a, max(pos) + 200 AS b FROM (
            SELECT *, sum(is_new) OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM (
                SELECT *, CASE WHEN pos > lag(pos, 1, -1000) OVER (PARTITION BY doc_id ORDER BY pos) + 200 THEN 1 ELSE 0 END AS is_new
                FROM again))
        GROUP BY doc_id, g),
    gap AS (
        SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM run
        UNION ALL SELECT d.doc_id, length(x) // 2, coalesce(max(r.b), 0)
        FROM doc d LEFT JOIN run r ON d.doc_id = r.doc_id GROUP BY d.doc_id, x),
    kept AS (
        SELECT g.doc_id, string_agg(substr(d.x, CAST(2 * g.z + 1 AS BIGINT), CAST(2 * (g.a - g.z) AS BIGINT)), '' ORDER BY g.a, g.z) AS x
        FROM gap g JOIN doc d ON g.doc_id = d.doc_id GROUP BY g.doc_id),
    sums AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM run GROUP BY doc_id)
    SELECT d.doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, coalesce(s.n_removed, 0) AS n_removed,
           coalesce(s.n_spans, 0) AS n_spans, sha256(unhex(k.x)) AS kept_sha256
    FROM doc d JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN sums s ON d.doc_id = s.doc_id
    """,
)
def op7(spark, sf_dir):
    done = substrings.dedup_substrings(table(spark, sf_dir, "documents"))
    return done.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


@query(
    "op11_hard_negatives",
    """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS e
        FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    pair AS (
        SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same,
               CAST(list_inner_product(CAST(a.e AS DOUBLE[]), CAST(b.e AS DOUBLE[])) AS BIGINT) AS score
        FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
    pos AS (
        SELECT a, b, score FROM pair WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5),
    neg AS (
        SELECT p.a, p.b AS p, n.b AS n, p.score AS ps, n.score AS ns,
               row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS rank
        FROM pos p JOIN pair n ON p.a = n.a AND NOT n.same
         AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score)
    SELECT a AS anchor_id, p AS positive_id, CAST(rank AS INTEGER) AS rank, n AS negative_id, ps AS positive_score, ns AS negative_score
    FROM neg WHERE rank <= 3
    """,
)
def op11(spark, sf_dir):
    seventh = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, label=seventh)


_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@query(
    "op12_ranked_search",
    rf"""
    WITH word AS (
        SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term
        FROM documents WHERE text IS NOT NULL),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM word GROUP BY 1, 2),
    size AS (SELECT doc_id, count(*) AS n FROM word GROUP BY 1),
    total AS (SELECT count(*) AS nn, CAST(sum(n) AS BIGINT) AS ll FROM size),
    norm AS (SELECT doc_id, 10 + (90 * n * nn) // ll AS m FROM size, total),
    item AS (
        SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_TERM}')) AS term
        FROM benchmark WHERE text IS NOT NULL),
    weight AS (
        SELECT term, CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w
        FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), total),
    score AS (
        SELECT item_id, tf.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
        FROM item JOIN weight USING (term) JOIN tf USING (term) JOIN norm ON tf.doc_id = norm.doc_id GROUP BY 1, 2),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM score WHERE score > 0)
    SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
    """,
)
def op12(spark, sf_dir):
    return ranking.search(ranking.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


@query(
    "op13_chat_trees",
    r"""
    WITH turn AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    loss AS (
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
               CAST(sum(4 + 2 + 8 + length(regexp_replace(role, '([\\#: \n])', '\\\1', 'g')) + length(regexp_replace(text, '([\\#])', '\\\1', 'g'))
                        + len(string_split(text, '</turn>')) - 1 + len(string_split(role, '</turn>')) - 1) AS BIGINT) AS formatted_chars
        FROM turn GROUP BY conv_id)
    SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM loss
    """,
)
def op13(spark, sf_dir):
    """A conversation is a tree with one branch: each turn replies to the one before."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = [(-7, k, role, r"\### Assistant: </turn> ok") for k, role in enumerate(("user", "assistant"))]
    rows = rows.unionByName(spark.createDataFrame(own, rows.schema))
    node = F.struct("turn").alias("node")
    turns = rows.select(F.col("conv_id").alias("tree"), node).distinct()
    links = turns.select("tree", "node", F.lag("node").over(Window.partitionBy("tree").orderBy("node")).alias("parent"), F.lit(0).alias("score"))
    messages = rows.select(F.col("conv_id").alias("tree"), node, "role", "text", F.lit(0).alias("score"))
    done = chat.format_trees(messages, links)
    turns = F.array_join(F.transform(chat.read_turns(F.col("text")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        F.col("tree").alias("conv_id"), F.size(chat.read_turns(F.col("text"))).cast("long").alias("n_turns"), F.sha2(turns, 256).alias("turns_sha256"),
        chat.read_loss(F.col("text"), F.col("spans")).alias("loss"), F.char_length("text").cast("long").alias("formatted_chars"),
    ).select(
        "conv_id", "n_turns", "turns_sha256", F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        "formatted_chars",
    )
