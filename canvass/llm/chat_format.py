"""Chat formatting of reply trees, in DataFrame functions only.

A message table (tree, id, parent, role, text, score) holds reply trees.
Iterative self-joins by doubling enumerate root-to-leaf paths: round k joins
the table of 2^k-step ancestors to itself, so a tree of depth d takes about
log2(d) rounds whatever its width, and the sums carried along give every
leaf the depth and score of its branch. Branches are ranked per tree by mean
message score, then length, then leaf id; the best ``branches`` are walked
back over the same ancestor tables (each ancestor is reached exactly once)
and written as one conversation each.

Template: ``<|turn|>role<|text|>text<|end|>`` per message. Control strings
inside roles and texts get a backslash after their first character and
backslashes are doubled, so the output never contains a control string that
the template did not write, and ``unescape`` restores the input exactly.

Edge cases: null role or text is the empty string, null score 0; a message
whose parent is absent starts a tree of its own; messages on or below a
parent cycle are on no root-to-leaf path and are left out; rows that repeat
a (tree, id) collapse to the smallest (parent, role, text, score); ties in
rank go to the smaller leaf id; an empty table gives no conversations; other
input columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from canvass.llm.common import materialise

TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>"
# Control strings of this template ("<|") and of common chat tokenizers.
CONTROL = ["<|", "<s>", "</s>", "[INST]", "[/INST]"]


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    for s in CONTROL:
        c = F.replace(c, F.lit(s), F.lit(f"{s[0]}\\{s[1:]}"))
    return c


def unescape(c: Column) -> Column:
    """Inverse of :func:`escape`: after doubling, a single backslash between
    the first character and the rest of a control string was inserted."""
    for s in reversed(CONTROL):
        c = F.replace(c, F.lit(f"{s[0]}\\{s[1:]}"), F.lit(s))
    return F.replace(c, F.lit("\\\\"), F.lit("\\"))


def _same(a: DataFrame, b: DataFrame, left: str, right: str) -> Column:
    return a["t"].eqNullSafe(b["t"]) & (a[left] == b[right])


def reply_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """``t, leaf, pos, id, role, text`` of the chosen branches; ``pos`` is 0
    at the root. Input columns: tree, id, parent, role, text, score."""
    m = messages.select(
        F.col("tree").alias("t"),
        F.col("id"),
        F.struct(
            F.col("parent"),
            F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
            F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score"),
        ).alias("m"),
    ).where(F.col("id").isNotNull())
    m = m.groupBy("t", "id").agg(F.min("m").alias("m")).select("t", "id", "m.*")
    m = materialise(m, "messages")
    ids = m.select("t", F.col("id").alias("parent_id"))
    links = m.select("t", "id", "parent", "score").alias("a")
    jump = links.join(ids.alias("b"), F.col("a.t").eqNullSafe(F.col("b.t")) & (F.col("a.parent") == F.col("b.parent_id")), "left")
    jump = jump.select(
        F.col("a.t").alias("t"), F.col("a.id").alias("id"), F.col("b.parent_id").alias("up"),
        F.lit(1).cast("long").alias("n"), F.col("a.score").alias("s"),
    )
    # up: the ancestor 2^k steps above (null beyond the root); n and s: the
    # messages from this one up to that ancestor (not included), their score.
    # A round joins only messages that have not reached their root yet.
    state = materialise(jump, "jump")
    jumps, reached = [state.where(F.col("up").isNotNull())], state.where(F.col("up").isNull())
    rows = m.count()
    while jumps[-1].limit(1).count() and (1 << (len(jumps) - 1)) <= rows:
        a, b = jumps[-1].alias("a"), jumps[-1].unionByName(reached).alias("b")
        step = a.join(b, F.col("a.t").eqNullSafe(F.col("b.t")) & (F.col("a.up") == F.col("b.id"))).select(
            F.col("a.t").alias("t"), F.col("a.id").alias("id"), F.col("b.up").alias("up"),
            (F.col("a.n") + F.col("b.n")).alias("n"), (F.col("a.s") + F.col("b.s")).alias("s"),
        )
        state = materialise(step, "jump")
        jumps.append(state.where(F.col("up").isNotNull()))
        reached = reached.unionByName(state.where(F.col("up").isNull()))
    parents = jumps[0].select("t", F.col("up").alias("id")).distinct()
    # Messages that hang on a cycle are never among ``reached``.
    leaves = reached.alias("a").join(
        parents.alias("b"), F.col("a.t").eqNullSafe(F.col("b.t")) & (F.col("a.id") == F.col("b.id")), "left_anti"
    )
    rank = F.row_number().over(Window.partitionBy("t").orderBy((F.col("s") / F.col("n")).desc(), F.col("n").desc(), "id"))
    paths = leaves.withColumn("_r", rank).where(F.col("_r") <= branches)
    paths = paths.select("t", F.col("id").alias("leaf"), "id", (F.col("n") - 1).alias("pos"))
    for k, j in enumerate(jumps):
        a, b = paths.alias("a"), j.alias("b")
        more = a.join(b, F.col("a.t").eqNullSafe(F.col("b.t")) & (F.col("a.id") == F.col("b.id"))).select(
            F.col("a.t").alias("t"), F.col("a.leaf").alias("leaf"), F.col("b.up").alias("id"),
            (F.col("a.pos") - F.lit(1 << k)).alias("pos"),
        )
        paths = paths.unionByName(more)
        if k % 2:
            paths = materialise(paths, "paths")
    return (
        paths.alias("a")
        .join(m.alias("b"), F.col("a.t").eqNullSafe(F.col("b.t")) & (F.col("a.id") == F.col("b.id")))
        .select(F.col("a.t").alias("t"), "leaf", "pos", F.col("a.id").alias("id"), "role", "text")
    )


def format_conversations(messages: DataFrame, branches: int = 1, trained_role: str = "assistant") -> DataFrame:
    """One row per chosen branch: ``tree, leaf, formatted, loss_spans``.
    ``loss_spans`` lists the [start, stop) code points of every
    ``trained_role`` text within ``formatted`` (the loss mask)."""
    p = reply_paths(messages, branches)
    head = F.concat(F.lit(TURN), escape(F.col("role")), F.lit(TEXT))
    p = p.withColumn("_head", head).withColumn("_body", escape(F.col("text")))
    p = p.withColumn("_len", F.length("_head") + F.length("_body") + F.lit(len(END)))
    before = Window.partitionBy("t", "leaf").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_len").over(before), F.lit(0)) + F.length("_head")
    p = p.withColumn("_start", start)
    turn = F.struct(
        "pos",
        F.concat("_head", "_body", F.lit(END)).alias("block"),
        F.struct(F.col("_start").alias("start"), (F.col("_start") + F.length("_body")).alias("stop")).alias("span"),
        (F.col("role") == F.lit(trained_role)).alias("trained"),
    )
    g = p.groupBy("t", "leaf").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    return g.select(
        F.col("t").alias("tree"),
        "leaf",
        F.array_join(F.col("turns.block"), "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["trained"]), lambda x: x["span"]).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    blocks = F.split(formatted, r"<\|end\|>")
    blocks = F.slice(blocks, 1, F.greatest(F.size(blocks) - 1, F.lit(0)))
    return F.transform(
        blocks,
        lambda b: F.struct(
            unescape(F.substring_index(F.substr(b, F.lit(len(TURN) + 1)), TEXT, 1)).alias("role"),
            unescape(F.substring_index(b, TEXT, -1)).alias("text"),
        ),
    )


def conversation_messages(conversations: DataFrame) -> DataFrame:
    """Conversations (rows by ``turn``) as reply trees without branches: each
    row replies to the row before it. Rows of equal turn follow in order of
    role, then text; null turns come first; repeated rows stay apart."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").alias("tree"),
        F.row_number().over(order).cast("long").alias("id"),
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        F.lit(0.0).alias("score"),
    ).withColumn("parent", F.col("id") - 1)


def conversation_digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of each conversation, read back from ``formatted``
    and ``loss_spans`` alone."""
    turns = read_turns(F.col("formatted"))
    said = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    spans = F.transform(
        "loss_spans",
        lambda x: unescape(F.substr(F.col("formatted"), (x["start"] + 1).cast("int"), (x["stop"] - x["start"]).cast("int"))),
    )
    out = formatted.withColumn("turns", turns).withColumn("loss", F.array_join(spans, ""))
    return out.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escape(c: str) -> str:
    c = f"replace({c}, '\\', '\\\\')"
    for s in CONTROL:
        c = f"replace({c}, '{s}', '{s[0]}\\{s[1:]}')"
    return c


ORACLE_SQL = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' ORDER BY turn NULLS FIRST, r, t)) AS turns_sha256,
  CAST(coalesce(sum(length(t)) FILTER (WHERE r = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(t, '' ORDER BY turn NULLS FIRST, r, t) FILTER (WHERE r = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(TURN) + len(TEXT) + len(END)} + length({_sql_escape("r")}) + length({_sql_escape("t")})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
