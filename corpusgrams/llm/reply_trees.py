"""Chat formatting of reply trees, with DataFrame functions only.

Messages form trees (each names its parent).  Iterative self-joins over a jump
table (parent, grandparent, fourth, eighth ... ancestor, doubling with each
iteration) give every message its root, depth and score summed up from the root,
then every chosen leaf its whole path; the number of iterations is the logarithm
of the longest path.  The branches (leaves) of a tree are ranked by score, and
each chosen path becomes one conversation.

Template: each message is ``### role: text</turn>`` and a line feed.  Within
texts and roles ``\\``, ``#``, ``<`` (in roles also ``:``) are written as
``\\s``, ``\\h``, ``\\l``, ``\\c``, so no text holds a control string and
``unescape`` gives back every character.  The loss mask lists the spans of the
assistant's texts in the formatted conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

OPEN, MIDDLE, CLOSE = "### ", ": ", "</turn>\n"
LEARNED = "assistant"  # the role whose texts are under the loss mask


# --- template ------------------------------------------------------------------


def _replace(text: Column, *pairs: tuple[str, str]) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escape(text: Column) -> Column:
    return _replace(text, ("\\", "\\s"), ("#", "\\h"), ("<", "\\l"))


def escape_role(role: Column) -> Column:
    return _replace(escape(role), (":", "\\c"))


def unescape(text: Column) -> Column:
    return _replace(text, ("\\c", ":"), ("\\h", "#"), ("\\l", "<"), ("\\s", "\\"))


def format_messages(messages: Column) -> Column:
    """struct<formatted, loss> of an array of struct<role, text>: the text, and
    the spans (code points, end exclusive) of the learned texts in it."""
    written = F.transform(messages, lambda m: F.struct(
        F.concat(F.lit(OPEN), escape_role(m["role"]), F.lit(MIDDLE)).alias("head"),
        escape(m["text"]).alias("body"), (m["role"] == LEARNED).alias("learned")))

    def step(acc: Column, m: Column) -> Column:
        start = acc["at"] + F.length(m["head"])
        end = start + F.length(m["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct((end + len(CLOSE)).alias("at"),
                        F.when(m["learned"], F.concat(acc["loss"], span)).otherwise(acc["loss"]).alias("loss"))

    first = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("loss"))
    return F.struct(
        F.array_join(F.transform(written, lambda m: F.concat(m["head"], m["body"], F.lit(CLOSE))), "").alias("formatted"),
        F.aggregate(written, first, step, lambda acc: acc["loss"]).alias("loss"))


def read_back(formatted: Column) -> Column:
    """The array of struct<role, text> that a formatted conversation was made of."""
    parts = F.split(formatted, CLOSE)
    turns = F.slice(parts, F.lit(1), F.size(parts) - 1)  # nothing stands behind the last mark

    def turn(t: Column) -> Column:
        role = F.substring_index(t, MIDDLE, 1)
        start = F.length(role) + len(MIDDLE) + 1
        return F.struct(unescape(F.substring(role, F.lit(len(OPEN) + 1), F.length(role))).alias("role"),
                        unescape(F.substring(t, start, F.length(t))).alias("text"))

    return F.transform(turns, turn)


def learned_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(
        loss, lambda s: unescape(F.substring(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


# --- reply trees -----------------------------------------------------------------


def _ancestors(nodes: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(node, depth, total) for every node that hangs on a root, and the jump
    tables: the k-th gives each node's ancestor 2**k steps up, if it has one.

    Each iteration joins the table with itself.  Depth and score of a node are
    those of the steps so far plus its ancestor's; a node in a cycle, or below a
    parent that is not there, never reaches a root and is left out."""
    now = nodes.select("tree", "node", F.col("parent").alias("up"), F.lit(0).alias("depth"), F.col("score").alias("total"),
                       F.col("parent").isNull().alias("done"))
    jumps, most = [], nodes.count()
    while True:
        now = cut_lineage(now)
        jumps.append(now.filter("up IS NOT NULL").select("tree", "node", "up"))
        if 2 ** (len(jumps) - 1) > most or not now.filter("NOT done").take(1):
            break
        above = now.select("tree", F.col("node").alias("up"), F.col("up").alias("up_up"), F.col("depth").alias("up_depth"),
                           F.col("total").alias("up_total"), F.col("done").alias("up_done"))
        # a node whose ancestor is not there drops out: its path has no root
        now = now.filter("NOT done").join(above, ["tree", "up"]).select(
            "tree", "node", F.col("up_up").alias("up"), (F.col("depth") + F.col("up_depth") + 1).alias("depth"),
            (F.col("total") + F.col("up_total")).alias("total"), F.col("up_done").alias("done"),
        ).unionByName(now.filter("done"))
    return now.filter("done").select("tree", "node", "depth", "total"), jumps


def branch_paths(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """The best root-to-leaf paths of each tree.

    ``messages``: tree, node (unique in its tree), parent (null: root), score,
    role, text.  Branches rank by mean score along the path, then by length
    (longer first), then by the leaf's node; ``branches`` of each tree are
    chosen (None: all).  Returns tree, branch (rank), messages (array of
    struct<role, text> from root to leaf).  A null score counts as 0.
    """
    nodes = cut_lineage(messages.withColumn("score", F.coalesce(F.col("score").cast("double"), F.lit(0.0))))
    reached, jumps = _ancestors(nodes.select("tree", "node", "parent", "score"))
    parents = nodes.filter("parent IS NOT NULL").select("tree", F.col("parent").alias("node")).distinct()
    leaves = reached.join(parents, ["tree", "node"], "left_anti")
    rank = Window.partitionBy("tree").orderBy(F.desc(F.col("total") / (F.col("depth") + 1)), F.desc("depth"), "node")
    chosen = leaves.withColumn("branch", F.row_number().over(rank))
    if branches is not None:
        chosen = chosen.filter(F.col("branch") <= branches)
    path = cut_lineage(chosen.select("tree", "branch", "depth", F.col("node"), F.lit(0).alias("steps")))
    for k, jump in enumerate(jumps):
        further = path.filter(F.col("depth") >= F.col("steps") + 2**k).join(jump, ["tree", "node"]).select(
            "tree", "branch", "depth", F.col("up").alias("node"), (F.col("steps") + 2**k).alias("steps"))
        path = cut_lineage(path.unionByName(further))
    whole = path.join(nodes.select("tree", "node", "role", "text"), ["tree", "node"])
    row = F.struct((-F.col("steps")).alias("place"), "role", "text")
    return whole.groupBy("tree", "branch").agg(F.sort_array(F.collect_list(row)).alias("rows")).select(
        "tree", "branch", F.transform("rows", lambda r: F.struct(r["role"].alias("role"), r["text"].alias("text"))).alias("messages"))


def format_trees(messages: DataFrame, branches: int | None = 1) -> DataFrame:
    """tree, branch, formatted, loss: one formatted conversation for each chosen
    branch.  Null roles and texts count as empty."""
    clean = messages.withColumns({"role": F.coalesce("role", F.lit("")), "text": F.coalesce("text", F.lit(""))})
    paths = branch_paths(clean, branches)
    return paths.select("tree", "branch", format_messages(F.col("messages")).alias("f")).select("tree", "branch", "f.*")


def as_trees(turns: DataFrame) -> DataFrame:
    """Conversations (conv_id, turn, role, text) as trees of one branch: each row
    answers the one before it, by turn (null first), then role, then text, so
    rows of the same turn, and repeated rows, all stay.  A null conv_id is a
    conversation too.  A conversation becomes one output row, so its rows also
    meet in one window here."""
    by = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.select(turns["conv_id"].cast("bigint").alias("conv_id"), turns["turn"].cast("bigint").alias("turn"),
                        turns["role"].cast("string").alias("role"), turns["text"].cast("string").alias("text"))
    named = rows.withColumn("tree", F.coalesce(F.col("conv_id").cast("string"), F.lit("none")))
    return named.withColumn("node", F.row_number().over(by)).select(
        "tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), F.lit(0.0).alias("score"),
        "role", "text", "conv_id")


# --- registered query --------------------------------------------------------

#: The contract's conversation with control strings (fixed values).
EXTRA = "SELECT -7L conv_id, n turn, r role, '\\\\### Assistant: </turn> ok' text FROM VALUES (0L, 'user'), (1L, 'assistant') t(n, r)"


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    done = format_trees(as_trees(turns.unionByName(spark.sql(EXTRA))).drop("conv_id"))
    back = read_back(F.col("formatted"))
    learned = learned_text(F.col("formatted"), F.col("loss"))
    return done.select(
        F.col("tree").try_cast("bigint").alias("conv_id"), F.size(back).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(F.transform(back, lambda m: F.concat(m["role"], F.lit("\n"), m["text"], F.lit("\n"))), ""), 256)
        .alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"), F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


OP3_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), e AS (
  SELECT *, 14 + length(role) + length(text) + length(text) - length(replace(replace(replace(text, '\', ''), '#', ''), '<', ''))
    + length(role) - length(replace(replace(replace(replace(role, '\', ''), '#', ''), '<', ''), ':', '')) AS written
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
         CAST(sum(written) AS BIGINT) AS formatted_chars
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars
FROM g
"""
