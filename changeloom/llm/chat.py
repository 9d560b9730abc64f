r"""Chat formatting of reply trees, with DataFrame functions only.

A message has a tree, a node, its parent's node and a score.  Iterative self-joins by pointer doubling give every node its
ancestor 1, 2, 4, ... steps up, and with it the length and the total score of its path to the root, in as many rounds as the
longest path has binary digits.  Leaves are ranked within their tree by total score, the chosen ones' paths are enumerated by
the same tables from the longest jump to the shortest, and each path becomes one conversation.  Only ids and scores
take part in the rounds; texts move once to their node's place in the paths and once to their path.

Template: a turn is ``### role: text</turn>`` and ``\n``.  In texts and roles ``\``, ``#`` and the ``/`` of ``</turn>`` get a
backslash before them, in roles ``:``, blank and ``\n`` too, so control strings stand only where the template puts them, and dropping
each escaping backslash gives the text back.  ``spans`` says where each turn's text stands (code points, escaped
form) and whether it is under the loss mask.

Defined results: null texts and roles are empty; a null tree is a tree; a node whose parent is null or not in the tree is a root;
rows that repeat a node are turns at its place, ordered by role, text and score, the node has the least of their parents and the sum of their
scores; null scores count 0; equal totals are ranked by leaf; messages whose parents form a
circle, and those below them, are on no path from a root and in no conversation; a tree without a leaf gives no row; an empty table gives an
empty table; other columns are not looked at.  A conversation is one row, whatever its length; no tree is ever
collected, and a node with a third of all replies is only a skewed join key.
"""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, Window, functions as F

from changeloom.session import written

OPEN, MIDDLE, END = "### ", ": ", "</turn>\n"
LOSS_ROLES = ("assistant",)


def escape(text: Column) -> Column:
    """Text in which no control string of the template stands."""
    return F.replace(F.regexp_replace(text, r"([\\#])", r"\\$1"), F.lit("</turn>"), F.lit("<\\/turn>"))


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "([: \n])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def nodes_of(links: DataFrame) -> DataFrame:
    """``tree, node, parent, total``, one row for each node of ``links`` (``tree, node, parent, score``)."""
    score = F.sum(F.coalesce(F.col("score").cast("double"), F.lit(0.0)))
    return links.groupBy("tree", "node").agg(F.min("parent").alias("parent"), score.alias("total"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Tables of jumps of 1, 2, 4, ... steps (``tree, node, up``), and the length and total of each node's path from its root."""
    parents = nodes.select(F.col("tree").alias("t"), F.col("node").alias("p"))
    own = nodes.join(parents, F.col("tree").eqNullSafe(F.col("t")) & (F.col("parent") == F.col("p")), "left")
    now = written(own.select("tree", "node", F.col("p").alias("up"), "total", F.lit(1).cast("bigint").alias("length")), "climb-0")
    jumps, ended = [], [now.filter("up IS NULL")]
    # A path without a circle has at most as many steps as nodes have a parent.
    steps = now.filter("up IS NOT NULL").count()
    while steps >> len(jumps):
        a = now.filter("up IS NOT NULL").alias("a")
        jumps.append(now.filter("up IS NOT NULL").select("tree", "node", "up"))
        b = _union([*ended, now.filter("up IS NOT NULL")]).alias("b")
        joined = a.join(b, F.col("a.tree").eqNullSafe(F.col("b.tree")) & (F.col("a.up") == F.col("b.node")))
        now = written(joined.select(
            "a.tree", "a.node", "b.up", (F.col("a.total") + F.col("b.total")).alias("total"), (F.col("a.length") + F.col("b.length")).alias("length")
        ), f"climb-{len(jumps)}")
        ended.append(now.filter("up IS NULL"))
        if now.filter("up IS NOT NULL").isEmpty():
            break
    return jumps, _union(ended).drop("up")


def paths(links: DataFrame, best: int = 1) -> DataFrame:
    """``tree, leaf, rank, total, length, node, place``: the nodes of the ``best`` root-to-leaf paths of each tree, roots at place 0."""
    nodes = written(nodes_of(links), "nodes")
    jumps, ends = _climb(nodes)
    inner = nodes.filter("parent IS NOT NULL").select(F.col("tree").alias("t"), F.col("parent").alias("p")).distinct()
    leaves = ends.join(inner, F.col("tree").eqNullSafe(F.col("t")) & F.col("node").eqNullSafe(F.col("p")), "left_anti")
    order = Window.partitionBy("tree").orderBy(F.desc("total"), F.asc_nulls_first("node"))
    chosen = leaves.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= best)
    at = chosen.select("tree", F.col("node").alias("leaf"), "rank", "total", "length", "node", (F.col("length") - 1).alias("place"))
    for k in reversed(range(len(jumps))):
        jump = jumps[k].select(F.col("tree").alias("t"), F.col("node").alias("from"), F.col("up"))
        both = at.join(jump, F.col("tree").eqNullSafe(F.col("t")) & F.col("node").eqNullSafe(F.col("from")), "left")
        above = F.when(F.col("up").isNotNull(), F.struct(F.col("up").alias("node"), (F.col("place") - (1 << k)).alias("place")))
        here = F.struct("node", "place")
        at = both.select(
            "tree", "leaf", "rank", "total", "length", F.explode(F.array_compact(F.array(here, above))).alias("at")
        ).select("tree", "leaf", "rank", "total", "length", "at.node", "at.place")
    return at


def format_paths(messages: DataFrame, nodes: DataFrame, loss_roles: Collection[str] = LOSS_ROLES) -> DataFrame:
    """``tree, leaf, rank, total, n_turns, text, spans``: one conversation for each path of ``nodes`` (rows of ``paths``)."""
    said = messages.select(
        F.col("tree").alias("t"), F.col("node").alias("n"), F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"), F.col("score").cast("double").alias("score"),
    )
    turns = nodes.join(said, F.col("tree").eqNullSafe(F.col("t")) & F.col("node").eqNullSafe(F.col("n")))
    grouped = turns.groupBy("tree", "leaf", "rank", "total").agg(
        F.sort_array(F.collect_list(F.struct("place", "role", "text", "score"))).alias("turns")
    )
    cut = F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(OPEN), escape_role(t["role"]), F.lit(MIDDLE)).alias("head"), escape(t["text"]).alias("body"),
        t["role"].isin(*loss_roles).alias("loss"),
    ))
    kept = grouped.select("tree", "leaf", "rank", "total", F.explode(F.array(cut)).alias("turns"))

    def step(done: Column, t: Column) -> Column:
        start = done["at"] + F.char_length(t["head"])
        stop = start + F.char_length(t["body"])
        span = F.struct(start.cast("bigint").alias("from_char"), stop.cast("bigint").alias("to_char"), t["loss"].alias("loss"))
        return F.struct((stop + len(END)).cast("bigint").alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    none = F.lit(0).cast("bigint")
    start = F.struct(none.alias("at"), F.array().cast("array<struct<from_char: bigint, to_char: bigint, loss: boolean>>").alias("spans"))
    return kept.select(
        "tree", "leaf", "rank", "total", F.size("turns").cast("bigint").alias("n_turns"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["head"], t["body"], F.lit(END))), "").alias("text"),
        F.aggregate("turns", start, step)["spans"].alias("spans"),
    )


def format_trees(
    messages: DataFrame, links: DataFrame | None = None, best: int = 1, loss_roles: Collection[str] = LOSS_ROLES,
) -> DataFrame:
    """The ``best`` branches of each reply tree as conversations.

    ``messages`` has ``tree, node, role, text, score`` and, unless ``links`` gives them, ``parent``; nodes may be of any type that can
    be ordered.
    """
    if links is None:
        links = messages.select("tree", "node", "parent", "score")
    return format_paths(messages, paths(links, best), loss_roles)


def read_turns(text: Column) -> Column:
    """``role, text`` of every turn of a formatted conversation."""
    return F.transform(_bodies(text), lambda b: F.struct(
        unescape(F.substring_index(F.substring(b, len(OPEN) + 1, _ALL), MIDDLE, 1)).alias("role"), unescape(_after(b)).alias("text")
    ))


#: Longer than any string.
_ALL = (1 << 31) - 1


def _bodies(text: Column) -> Column:
    """Turns without their end marks."""
    parts = F.split(text, F.lit(END))
    return F.slice(parts, F.lit(1), F.greatest(F.size(parts) - 1, F.lit(0)))


def _after(turn: Column) -> Column:
    """What follows the first mark between role and text."""
    return F.substring(turn, F.char_length(F.substring_index(turn, MIDDLE, 1)) + len(MIDDLE) + 1, F.lit(_ALL))


def read_loss(text: Column, spans: Column) -> Column:
    """The text under the loss mask, unescaped: each span is cut from its own turn, so a long conversation is read once."""
    turn_starts = F.concat(F.array(F.lit(0).cast("bigint")), F.transform(spans, lambda s: s["to_char"] + len(END)))
    cut = F.transform(
        F.arrays_zip(_bodies(text).alias("body"), spans.alias("span"), F.slice(turn_starts, F.lit(1), F.size(spans)).alias("start")),
        lambda t: F.when(t["span"]["loss"], F.substring(
            t["body"], (t["span"]["from_char"] - t["start"] + 1).cast("int"), (t["span"]["to_char"] - t["span"]["from_char"]).cast("int")
        )),
    )
    return unescape(F.array_join(cut, ""))
