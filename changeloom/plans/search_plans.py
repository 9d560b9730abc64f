"""Queries over search documents, message quality and pipeline metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import envelope, postings, quality, search
from ..schemas import ORDER_ITEMS, ORDERS, PRODUCTS
from ..session import scratch_path
from ..sinks.logs import write_dlq
from ..sources import changes, fixtures
from .catalog import query, ts_text

# ---- product index: all products, then price updates for every fifth and deletes of every eleventh

_INDEX_SQL = """
    + idx AS (
        SELECT id AS product_id, name, lower(name) AS name_lower, description,
               CAST((price + CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END) * 100 AS BIGINT) AS price,
               '$' || CAST(price + CASE WHEN id % 5 = 0 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS price_display,
               CAST(stock_quantity AS BIGINT) AS stock_quantity,
               list_sort(list_distinct(regexp_extract_all(lower(name || ' ' || description),
                                                          '[\\p{L}\\p{N}_]+'))) AS tokens
        FROM prod WHERE id % 11 <> 0)
"""

_DOC = "product_id, name, name_lower, description, price, price_display, stock_quantity"
_DOC_SQL = f"SELECT {_DOC}, array_to_string(tokens, ' ') AS search_tokens FROM idx"


def product_changes(spark: SparkSession, sf: str) -> DataFrame:
    products = fixtures.spread(fixtures.products(spark, sf))
    updated = products.filter("id % 5 = 0").withColumn("price", (F.col("price") + 1).cast("decimal(12,2)"))
    later = F.col("event_ts") + F.expr("INTERVAL 1 DAY")
    last = F.col("event_ts") + F.expr("INTERVAL 2 DAYS")
    log = (
        changes.snapshot_as_changes(products, PRODUCTS, F.col("event_ts"))
        .unionByName(changes.to_change_log(updated, PRODUCTS, "u", later, "standard"))
        .unionByName(changes.to_change_log(products.filter("id % 11 = 0"), PRODUCTS, "d", last, "bare"))
    )
    return envelope.parse_rows(log, PRODUCTS)


def product_index(spark: SparkSession, sf: str) -> DataFrame:
    return search.search_index(product_changes(spark, sf))


def _docs(df: DataFrame) -> DataFrame:
    return df.select(*_DOC.split(", "), "search_tokens")


@query("search_index", _INDEX_SQL + _DOC_SQL, ("prod",))
def _search_index(spark, sf):
    return _docs(product_index(spark, sf))


def _lookup(name, condition, find):
    query(name, _INDEX_SQL + _DOC_SQL + f" WHERE {condition}", ("prod",))(
        lambda spark, sf: _docs(find(product_index(spark, sf)))
    )


_lookup("search_by_id", "product_id = 7", lambda i: search.by_id(i, 7))
_lookup("search_by_name", "name_lower = 'small ring'", lambda i: search.by_name(i, "Small RING"))
_lookup("search_by_price", "price = 90010", lambda i: search.by_price(i, 90010))
_lookup(
    "search_by_price_range", "price BETWEEN 95000 AND 105000",
    lambda i: search.by_price_range(i, 95000, 105000),
)
_lookup("search_by_token", "list_contains(tokens, 'ring')", lambda i: search.by_token(i, "Ring"))


@query(
    "search_ranked",
    _INDEX_SQL + """
    SELECT product_id, name, CAST(len(list_intersect(tokens, ['ring', 'red', 'economy'])) AS BIGINT)
               AS matched_tokens
    FROM idx WHERE list_has_any(tokens, ['ring', 'red', 'economy'])
    """,
    ("prod",),
)
def _search_ranked(spark, sf):
    found = search.search(product_index(spark, sf), "red ECONOMY ring", require_all=False)
    return found.select("product_id", "name", "matched_tokens")


@query(
    "search_all_tokens",
    _INDEX_SQL + "SELECT product_id, name FROM idx WHERE list_has_all(tokens, ['ring', 'small'])",
    ("prod",),
)
def _search_all(spark, sf):
    return search.search(product_index(spark, sf), "small ring").select("product_id", "name")


@query(
    "price_facets",
    _INDEX_SQL + """
    SELECT CAST(CASE WHEN price >= 150000 THEN 150000 WHEN price >= 100000 THEN 100000 ELSE 0 END AS BIGINT)
               AS band_from,
           count(*) AS products
    FROM idx GROUP BY 1
    """,
    ("prod",),
)
def _price_facets(spark, sf):
    return search.price_facets(product_index(spark, sf), [0, 100_000, 150_000])


# ---- search text at scale: whole documents

_WORDS_SQL = """
    WITH t AS (
        SELECT doc_id AS product_id,
               list_sort(list_distinct(regexp_extract_all(lower(source || ' ' || text), '[\\p{L}\\p{N}_]+')))
                   AS tokens
        FROM documents)
"""


@query(
    "document_tokens",
    _WORDS_SQL + "SELECT product_id, len(tokens) AS n_tokens, array_to_string(tokens, ' ') AS search_tokens FROM t",
)
def _document_tokens(spark, sf):
    docs = search.search_documents(fixtures.documents(spark, sf))
    return docs.select("product_id", F.size("search_tokens").alias("n_tokens"), "search_tokens")


@query(
    "inverted_index",
    _WORDS_SQL + """
    SELECT token, product_id // 256 AS block, array_to_string(list_sort(list(product_id)), ' ') AS product_ids,
           count(*) AS doc_count
    FROM (SELECT unnest(tokens) AS token, product_id FROM t) GROUP BY 1, 2
    """,
)
def _inverted_index(spark, sf):
    docs = search.search_documents(fixtures.documents(spark, sf))
    return search.inverted_index(docs, block=256)


@query(
    "token_counts",
    _WORDS_SQL + """
    SELECT token, count(*) AS doc_count FROM (SELECT unnest(tokens) AS token, product_id FROM t) GROUP BY 1
    """,
)
def _token_counts(spark, sf):
    docs = search.search_documents(fixtures.documents(spark, sf))
    return search.token_counts(search.inverted_index(docs, block=256))


@query(
    "search_document_times",
    """
    + t AS (SELECT id, CASE WHEN id % 2 = 0 THEN strftime(event_ts + INTERVAL 1 DAY, '%Y-%m-%dT%H:%M:%S.%f')
                            WHEN id % 3 = 0 THEN strftime(event_ts, '%Y-%m-%dT%H:%M:%S.%f') ELSE '' END AS cdc_timestamp FROM prod)
    SELECT id AS product_id, cdc_timestamp, '2025-01-15T10:30:00.000000' AS indexed_at FROM t
    """,
    ("prod",),
)
def _search_document_times(spark, sf):
    """The first time known: of the update, else of the creation, else none."""
    at = F.col("event_ts")
    products = fixtures.products(spark, sf).withColumns({
        "updated_at": F.when(F.col("id") % 2 == 0, at + F.expr("INTERVAL 1 DAY")),
        "created_at": F.when(F.col("id") % 3 == 0, at),
    })
    docs = search.search_documents(products, "2025-01-15 10:30:00")
    return docs.select("product_id", "cdc_timestamp", "indexed_at")


# ---- messages: five kinds of events, of which three fail in different ways


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """Messages with their topic, derived from the event table.

    signup: product events.  purchase: sold items.  view: item updates, which the stock service
    cannot handle.  click: JSON cut short.  error: tombstones, or orders (an unknown table there).
    """
    events = fixtures.spread(fixtures.order_events(spark, sf))
    product = events.select(
        "id", F.col("status").alias("name"), F.col("status").alias("description"),
        F.col("total_amount").alias("price"), F.lit(1).alias("stock_quantity"),
        "created_at", "updated_at", "event_ts", "status",
    )
    item = events.select(
        "id", F.col("id").alias("order_id"), F.col("customer_id").alias("product_id"),
        F.lit(1).alias("quantity"), F.col("total_amount").alias("price"), "created_at", "event_ts", "status",
    )
    at = F.col("event_ts")

    def log(rows: DataFrame, table, op: str, layout: str, kind: str, topic: str) -> DataFrame:
        found = rows.filter(F.col("status") == kind)
        return changes.to_change_log(found, table, op, at, layout, keep=("id", "event_ts")).withColumn(
            "topic", F.lit(topic)
        )

    parts = [
        log(product, PRODUCTS, "r", "wrapped", "signup", "products"),
        log(item, ORDER_ITEMS, "c", "standard", "purchase", "order_items"),
        log(item, ORDER_ITEMS, "u", "bare", "view", "order_items"),
        log(product, PRODUCTS, "c", "wrapped", "click", "products").withColumn(
            "value", F.expr("left(value, length(value) - 2)")
        ),
        log(events, ORDERS, "c", "wrapped", "error", "orders").withColumn(
            "value", F.when(F.col("id") % 2 == 1, F.col("value"))
        ),
    ]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    return union


_MESSAGES_SQL = """
    + m AS (
        SELECT id, event_ts,
               CASE status WHEN 'signup' THEN 'products' WHEN 'click' THEN 'products'
                    WHEN 'error' THEN 'orders' ELSE 'order_items' END AS topic,
               CASE WHEN status = 'error' AND id % 2 = 0 THEN 'tombstone'
                    WHEN status = 'click' THEN 'JSON decode error'
                    WHEN status IN ('view', 'error') THEN 'Processing failed' ELSE 'ok' END AS outcome
        FROM ev)
"""


@query(
    "message_counts",
    _MESSAGES_SQL + """
    SELECT topic, 'stock' AS service, outcome, count(*) AS messages FROM m GROUP BY 1, 3
    """,
    ("ev",),
)
def _message_counts(spark, sf):
    return quality.message_counts(messages(spark, sf), "stock")


@query(
    "dead_letters",
    _MESSAGES_SQL + """
    SELECT topic, outcome AS error, 'stock' AS service,
           '2025-01-15T10:30:00.000000' AS "timestamp", count(*) AS letters
    FROM m WHERE outcome NOT IN ('ok', 'tombstone') GROUP BY 1, 2
    """,
    ("ev",),
)
def _dead_letters(spark, sf):
    """Dead letters as written to their folders, read back."""
    root = scratch_path(spark, "dlq")
    write_dlq(quality.dead_letters(messages(spark, sf), "stock", "2025-01-15 10:30:00"), root)
    rows = spark.read.schema(
        "message string, error string, timestamp string, service string, topic string"
    ).json(root)
    return rows.groupBy("topic", "error", "service", "timestamp").agg(F.count("message").alias("letters"))


@query(
    "valid_split",
    _MESSAGES_SQL + """
    SELECT 'good' AS part, count(*) AS messages FROM m WHERE outcome NOT IN ('tombstone', 'JSON decode error')
    UNION ALL SELECT 'bad', count(*) FROM m WHERE outcome = 'JSON decode error'
    """,
    ("ev",),
)
def _valid_split(spark, sf):
    good, bad = envelope.split_valid(messages(spark, sf))
    count = F.count(F.lit(1)).alias("messages")
    return good.agg(count).select(F.lit("good").alias("part"), "messages").unionByName(
        bad.agg(count).select(F.lit("bad").alias("part"), "messages")
    )


@query(
    "unknown_tables",
    """
    SELECT 'orders' AS topic, 'Processing failed' AS error, count(*) AS messages
    FROM ev WHERE status = 'error' AND id % 2 = 1
    """,
    ("ev",),
)
def _unknown_tables(spark, sf):
    routed = envelope.route(messages(spark, sf), ("products", "order_items"), unknown="dlq")
    return routed["unknown"].groupBy("topic", "error").agg(F.count(F.lit(1)).alias("messages"))


@query(
    "heartbeats_dropped",
    "SELECT status AS topic, count(*) AS messages FROM ev WHERE status <> 'view' GROUP BY 1",
    ("ev",),
)
def _heartbeats(spark, sf):
    events = fixtures.order_events(spark, sf)
    beat = F.concat(F.lit(changes.HEARTBEAT_PREFIX), F.lit(".shop"))
    log = events.select(F.when(F.col("status") == "view", beat).otherwise(F.col("status")).alias("topic"))
    return changes.drop_heartbeats(log).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))


_BOUNDS = ", ".join(f"({float(b)})" for b in quality.BATCH_BOUNDS)


@query(
    "bucket_counts",
    f"""
    SELECT status, CAST(coalesce(le, -1) AS DOUBLE) AS le, count(*) FILTER (le IS NULL OR total_amount <= le) AS cumulative_count
    FROM ev, (VALUES {_BOUNDS}, (NULL)) AS b(le) GROUP BY 1, 2
    """,
    ("ev",),
)
def _bucket_counts(spark, sf):
    counts = quality.bucket_counts(
        fixtures.order_events(spark, sf), "total_amount", quality.BATCH_BOUNDS, ["status"]
    )
    return counts.select("status", F.coalesce("le", F.lit(-1.0)).alias("le"), "cumulative_count")


@query(
    "latency",
    """
    SELECT status, count(*) AS messages, CAST(sum(id % 7 + 1) AS DOUBLE) AS seconds_sum,
           CAST(quantile_disc(id % 7 + 1, 0.5) AS DOUBLE) AS p50,
           CAST(quantile_disc(id % 7 + 1, 0.95) AS DOUBLE) AS p95,
           CAST(quantile_disc(id % 7 + 1, 0.99) AS DOUBLE) AS p99
    FROM ev GROUP BY 1
    """,
    ("ev",),
)
def _latency(spark, sf):
    """Processing follows each event by one to seven whole seconds."""
    events = fixtures.order_events(spark, sf)
    later = F.col("event_ts") + F.make_dt_interval(secs=(F.col("id") % 7 + 1).cast("decimal(18,6)"))
    return quality.latency(events.withColumn("done_ts", later), "event_ts", "done_ts", ["status"])


@query(
    "consumer_lag",
    """
    + e AS (SELECT status AS topic, id % 3 AS "partition", id, event_ts FROM ev)
    SELECT a.topic, a."partition", a.n - coalesce(b.n, 0) AS consumer_lag
    FROM (SELECT topic, "partition", max(id) + 1 AS n FROM e GROUP BY 1, 2) a
    LEFT JOIN (SELECT topic, "partition", max(id) + 1 AS n FROM e
               WHERE event_ts < TIMESTAMP '2024-01-20' AND topic <> 'view' GROUP BY 1, 2) b
           ON a.topic = b.topic AND a."partition" = b."partition"
    """,
    ("ev",),
)
def _consumer_lag(spark, sf):
    log = fixtures.order_events(spark, sf).select(
        F.col("status").alias("topic"), (F.col("id") % 3).alias("partition"), "id", "event_ts"
    )
    keys = ["topic", "partition"]
    ends = log.groupBy(*keys).agg((F.max("id") + 1).alias("end_offset"))
    seen = log.filter((F.col("event_ts") < "2024-01-20") & (F.col("topic") != "view"))
    return quality.lag_by_partition(ends, seen.groupBy(*keys).agg((F.max("id") + 1).alias("committed_offset")))


@query(
    "sustained_threshold",
    f"""
    + g AS (
        SELECT *, total_amount > 20 AS up,
               sum(CASE WHEN total_amount > 20 THEN 0 ELSE 1 END)
                   OVER (PARTITION BY customer_id ORDER BY event_us ROWS UNBOUNDED PRECEDING) AS island
        FROM ev)
    SELECT customer_id, {ts_text("min(event_ts)")} AS started_at, {ts_text("max(event_ts)")} AS ended_at,
           count(*) AS samples
    FROM g WHERE up GROUP BY customer_id, island
    HAVING max(event_us) - min(event_us) >= 21600000000
    """,
    ("ev",),
)
def _sustained(spark, sf):
    return quality.sustained(
        fixtures.order_events(spark, sf), F.col("total_amount") > 20, "6 hours", "customer_id", "event_ts"
    )


def alert_states_sql(edge: str) -> str:
    """Alerts of customers whose events stay above 20 for six hours, up to an edge in microseconds."""
    return f"""
    + g AS (
        SELECT *, total_amount > 20 AS up, coalesce(lag(total_amount > 20) OVER (PARTITION BY customer_id ORDER BY event_us, id), false) AS before
        FROM ev),
    s AS (SELECT customer_id, up, event_us AS t, lead(event_us) OVER (PARTITION BY customer_id ORDER BY event_us, id) AS e FROM g WHERE up <> before),
    k AS (
        SELECT *, t + 21600000000 AS f, (t + 21600000000 <= {edge}) AND (e IS NULL OR e > t + 21600000000) AS fires
        FROM s WHERE up),
    m AS (
        SELECT customer_id, 'pending' AS state, t AS at_us FROM k UNION ALL SELECT customer_id, 'firing', f FROM k WHERE fires
        UNION ALL SELECT customer_id, CASE WHEN fires THEN 'resolved' ELSE 'inactive' END, e FROM k WHERE e IS NOT NULL)
    SELECT customer_id, state, at_us FROM m WHERE at_us <= {edge}
    """


@query("alert_states", alert_states_sql("(SELECT max(event_us) FROM ev)"), ("ev",))
def _alert_states(spark, sf):
    found = quality.alert_states(fixtures.order_events(spark, sf), F.col("total_amount") > 20, "6 hours", "customer_id", "event_ts", order=["id"])
    return found.select("customer_id", "state", F.unix_micros("at").alias("at_us"))


@query(
    "counter_rate",
    f"""
    + g AS (
        SELECT *, lag(total_amount) OVER (PARTITION BY customer_id ORDER BY event_us) AS before FROM ev),
    h AS (
        SELECT *, CASE WHEN before IS NULL THEN 0 WHEN total_amount >= before THEN total_amount - before
                       ELSE total_amount END AS grown FROM g)
    SELECT customer_id, {ts_text("event_ts")} AS ts,
           CAST(sum(grown) OVER (PARTITION BY customer_id ORDER BY event_us
                                 RANGE BETWEEN 43199999999 PRECEDING AND CURRENT ROW) AS DOUBLE) / 43200
               AS rate_per_second
    FROM h
    """,
    ("ev",),
)
def _counter_rate(spark, sf):
    return quality.rate(
        fixtures.order_events(spark, sf), "total_amount", "12 hours", "customer_id", "event_ts"
    )


@query(
    "metric_slope",
    f"""
    SELECT customer_id, {ts_text("event_ts")} AS ts,
           round(regr_slope(CAST(total_amount AS DOUBLE), (event_us // 1000 - 1704067200000) / 1000.0) OVER w, 8)
               AS slope_per_second
    FROM ev
    WINDOW w AS (PARTITION BY customer_id ORDER BY event_us
                 RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW)
    """,
    ("ev",),
)
def _metric_slope(spark, sf):
    found = quality.slope(
        fixtures.order_events(spark, sf), "total_amount", "1 day", "customer_id", "event_ts"
    )
    return found.select("customer_id", "ts", F.round("slope_per_second", 8).alias("slope_per_second"))


@query(
    "full_image_check",
    """
    SELECT 'orders' AS "table", operation, count(*) AS events,
           count(*) FILTER (operation = 'u') AS without_old_image
    FROM ev WHERE operation IN ('u', 'd') GROUP BY 2
    """,
    ("ev",),
)
def _full_images(spark, sf):
    events = fixtures.order_events(spark, sf)
    log = changes.to_change_log(events, ORDERS, F.col("operation"), F.col("event_ts"), "standard")
    return quality.check_full_images(envelope.parse_changes(log, ORDERS))


# ---- stored postings

_QUERY = "the inan hein thentionor"


def _scored_sql(least: int) -> str:
    return f"""
    WITH word AS (
        SELECT doc_id AS product_id, unnest(regexp_extract_all(lower(source || ' ' || text), '[\\p{{L}}\\p{{N}}_]+')) AS token FROM documents),
    tf AS (SELECT product_id, token, count(*) AS tf FROM word GROUP BY 1, 2),
    w AS (
        SELECT token, CAST(floor(1000 * ln((2 * (SELECT count(*) FROM documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
        FROM tf GROUP BY 1),
    score AS (
        SELECT product_id, count(*) AS matched_tokens, CAST(sum(w * (1000 * tf // (tf + 1))) AS BIGINT) AS score
        FROM tf JOIN w USING (token) WHERE token IN ({', '.join(f"'{t}'" for t in _QUERY.split())}) GROUP BY 1)
    SELECT product_id, matched_tokens, score FROM score WHERE matched_tokens >= {least} ORDER BY score DESC, product_id LIMIT 10
    """


def document_postings(spark: SparkSession, sf: str) -> postings.PostingIndex:
    index = postings.PostingIndex(scratch_path(spark, "postings"), buckets=16, block=64)
    index.add_documents(fixtures.documents(spark, sf))
    return index


@query("search_scored", _scored_sql(1))
def _search_scored(spark, sf):
    return document_postings(spark, sf).search(spark, _QUERY)


@query("search_scored_all_tokens", _scored_sql(3).replace(", 'thentionor'", ""))
def _search_scored_all(spark, sf):
    return document_postings(spark, sf).search(spark, _QUERY.rsplit(" ", 1)[0], require_all=True)


# ---- postings after changes: all products; then new names for some and deletes of others; then some return

_AFTER = """
    + step AS (
        SELECT id, CASE WHEN id % 5 = 0 THEN name || ' new ring ring' ELSE name END AS name, description FROM prod
        WHERE id % 11 <> 0 OR id % 33 = 0),
    word AS (SELECT id, unnest(regexp_extract_all(lower(name || ' ' || description), '[\\p{L}\\p{N}_]+')) AS token FROM step),
    tf AS (SELECT id, token, count(*) AS tf FROM word GROUP BY 1, 2)
"""
_AFTER_SQL = _AFTER + """
    SELECT token, count(*) AS products, CAST(sum(tf) AS BIGINT) AS occurrences, CAST(sum(id * tf) AS BIGINT) AS checked FROM tf GROUP BY 1
    """


def product_batches(spark: SparkSession, sf: str) -> list[DataFrame]:
    """The product log in three parts, updates and deletes with their old images."""
    products = fixtures.spread(fixtures.products(spark, sf)).withColumn("before", F.struct(*PRODUCTS.columns))
    renamed = products.withColumn("name", F.concat("name", F.lit(" new ring ring")))
    old = F.col("before")

    def part(rows: DataFrame, op: str, day: int, before=None) -> DataFrame:
        at = F.col("event_ts") + F.expr(f"INTERVAL {day} DAYS")
        return changes.to_change_log(rows, PRODUCTS, op, at, "standard", before)

    gone = renamed.filter("id % 5 = 0 AND id % 11 = 0").unionByName(products.filter("id % 5 <> 0 AND id % 11 = 0"))
    return [
        part(products, "c", 0),
        part(renamed.filter("id % 5 = 0"), "u", 1, old).unionByName(part(gone, "d", 2)),
        part(renamed.filter("id % 5 = 0 AND id % 33 = 0").unionByName(products.filter("id % 5 <> 0 AND id % 33 = 0")), "c", 3),
    ]


def parsed_products(log: DataFrame) -> DataFrame:
    return envelope.parse_rows(log, PRODUCTS, old=postings.FIELDS)


def posting_sums(stored: DataFrame) -> DataFrame:
    return stored.groupBy("token").agg(
        F.count(F.lit(1)).alias("products"), F.sum("tf").alias("occurrences"), F.sum(F.col("product_id") * F.col("tf")).alias("checked")
    )


@query("index_after_changes", _AFTER_SQL, ("prod",))
def _index_after_changes(spark, sf):
    """Postings kept up batch by batch, one of them written twice: the same as a rebuild."""
    index = postings.PostingIndex(scratch_path(spark, "postings"), buckets=16, block=64)
    for n, log in enumerate(product_batches(spark, sf)):
        index.add(parsed_products(log), n)
        if n == 1:
            index.add(parsed_products(log), n)
    return posting_sums(index.postings(spark))


@query(
    "token_counts_after_changes",
    _AFTER + "SELECT token, count(*) AS products FROM tf GROUP BY 1",
    ("prod",),
)
def _counts_after_changes(spark, sf):
    """Products per token from the blocks' heads alone."""
    index = postings.PostingIndex(scratch_path(spark, "postings"), buckets=16, block=64)
    for n, log in enumerate(product_batches(spark, sf)):
        index.add(parsed_products(log), n)
    counts = index.rows(spark).filter(F.col("token") != postings.ALL).groupBy("token").agg(F.sum("products").alias("products"))
    return counts.filter("products > 0")
