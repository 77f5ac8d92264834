"""Chat formatting over reply trees.

Messages form trees: each names its parent, a message without one (or whose parent is not in the
table) is a root. Paths from root to leaf are enumerated by iterative self-joins with doubling
hops: after k rounds every message knows the sum of the scores of the 2^k messages from it upwards,
and which one stands above these, so that a thread of a thousand messages takes ten rounds. Branches
are ranked by the mean score of their messages (ties: the smaller leaf). Only the chosen leaves are
then expanded, by the hops of the same rounds, and each path is formatted as one conversation.

Template: `<turn ROLE>`, a line end, the text, a line end, `</turn>`, a line end. Inside roles
and texts a backslash, `<` and `>` are written as `\\\\`, `\\l` and `\\g`, so that nothing in them can
look like the template, and reading back is exact. The loss mask covers the assistant's texts.

Every round is a table in the shared folder. Only ids and scores take part in the rounds; texts are
joined to the chosen paths, and dealt by path. The messages of one path meet in one task, as they
become one value: a path is bounded by what one value can hold (2 GB), a tree is not.

Defined results: a null text or role is empty, a null score is 0, a null tree id is a tree of its
own. Of messages of a tree with the same id the first by parent, role and text stays. Parents
that form a cycle are an error. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoweave.llm.common import saved

ASSISTANT = "assistant"
_ESCAPES = {"\\": "\\\\", "<": "\\l", ">": "\\g"}
_PLAIN = {v: k for k, v in _ESCAPES.items()}
_TURN = re.compile(r"<turn ([^<>]*)>\n([^<>]*)\n</turn>\n")


def escaped(text: str) -> str:
    return re.sub(r"[\\<>]", lambda m: _ESCAPES[m.group()], text)


def unescaped(text: str) -> str:
    return re.sub(r"\\[\\lg]", lambda m: _PLAIN[m.group()], text)


def formatted(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The conversation, and the spans of the loss mask in it."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"<turn {escaped(role)}>\n", escaped(text)
        if role == ASSISTANT:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, "\n</turn>\n"]
        at += len(head) + len(body) + len("\n</turn>\n")
    return "".join(parts), spans


def read_back(conversation: str) -> list[tuple[str, str]]:
    turns, at = [], 0
    for m in _TURN.finditer(conversation):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        turns.append((unescaped(m[1]), unescaped(m[2])))
        at = m.end()
    if at != len(conversation):
        raise ValueError(f"no turn at {at}")
    return turns


def messages_of_turns(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Rows by turn as trees with one branch: each message replies to the one before it."""
    rows = conversations.select(F.col(id_col).alias("tree"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    node = F.row_number().over(W.partitionBy("tree").orderBy("turn", "role", "text")).cast("long")
    rows = rows.withColumn("node", node)
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text", F.lit(0.0).alias("score"))


def chosen_paths(structure: DataFrame, branches: int = 1) -> DataFrame:
    """structure: key, node, parent, score, each node once. Every message of the best paths: key, leaf, rank, node, distance to the leaf."""
    known = structure.select("key", F.col("node").alias("up")).withColumn("there", F.lit(True))
    state = structure.select("key", "node", F.col("parent").alias("up"), F.col("score").alias("total"), F.lit(1).cast("long").alias("n")).join(known, ["key", "up"], "left")
    state = saved(state.select("key", "node", F.when(F.col("there"), F.col("up")).alias("up"), "total", "n"), "scores")
    leaves = state.select("key", "node").join(state.where("up IS NOT NULL").select("key", F.col("up").alias("node")).distinct(), ["key", "node"], "left_anti")
    hops, most = [], structure.count()
    while not (open_ := state.where("up IS NOT NULL")).isEmpty():
        if 1 << len(hops) > most:
            raise ValueError("the parents of some messages form a cycle")
        hops.append(open_.select("key", "node", "up"))
        above = state.select("key", F.col("node").alias("up"), F.col("up").alias("next"), F.col("total").alias("more"), F.col("n").alias("m"))
        state = state.join(above, ["key", "up"], "left").select("key", "node", F.col("next").alias("up"), (F.col("total") + F.coalesce("more", F.lit(0.0))).alias("total"), (F.col("n") + F.coalesce("m", F.lit(0))).alias("n"))
        state = saved(state, "scores")
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc(F.col("total") / F.col("n")), "node"))
    ranked = state.join(leaves, ["key", "node"]).withColumn("rank", rank).where(F.col("rank") <= branches)
    members = saved(ranked.select("key", F.col("node").alias("leaf"), "rank", "node", F.lit(0).cast("long").alias("distance")), "paths")
    for k, hop in enumerate(hops):
        above = members.join(hop, ["key", "node"]).select("key", "leaf", "rank", F.col("up").alias("node"), (F.col("distance") + (1 << k)).alias("distance"))
        members = saved(members.union(above), "paths")
    return members


def _key(tree: str) -> Column:
    return F.coalesce(F.concat(F.lit("t"), F.col(tree).cast("string")), F.lit("")).alias("key")


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """messages: tree, node, parent, role, text, score. Per chosen path: tree, leaf, rank, conversation, loss_spans."""
    rows = messages.select(_key("tree"), "tree", "node", "parent", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"), F.coalesce("score", F.lit(0.0)).alias("score"))
    if not rows.groupBy("key", "node").count().where("count > 1").isEmpty():
        one = F.row_number().over(W.partitionBy("key", "node").orderBy(F.col("parent").asc_nulls_first(), "role", "text"))
        rows = saved(rows.withColumn("one", one).where("one = 1").drop("one"), "messages")
    return _formatted_paths(saved(rows.select("key", "node", "parent", "score"), "structure"), rows.select("key", "tree", "node", "role", "text"), branches)


def format_turns(conversations: DataFrame, *, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Like format_trees(messages_of_turns(...)). Where each turn of a conversation is there once, the turns are numbered without their texts."""
    light = saved(conversations.select(_key(id_col), F.col(turn_col).cast("long").alias("node")), "turns")
    if not light.groupBy("key", "node").count().where("count > 1 OR node IS NULL").isEmpty():
        return format_trees(messages_of_turns(conversations, id_col=id_col, turn_col=turn_col, role_col=role_col, text_col=text_col))
    structure = saved(light.withColumn("parent", F.lag("node").over(W.partitionBy("key").orderBy("node"))).withColumn("score", F.lit(0.0)), "structure")
    texts = conversations.select(_key(id_col), F.col(id_col).alias("tree"), F.col(turn_col).cast("long").alias("node"), F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return _formatted_paths(structure, texts, 1)


def _formatted_paths(structure: DataFrame, texts: DataFrame, branches: int) -> DataFrame:
    kind = dict(texts.dtypes)["tree"]
    # The members are a table whose size Spark knows: it is broadcast if small, and texts are dealt once, by path.
    told = texts.join(chosen_paths(structure, branches), ["key", "node"])
    turns = told.groupBy("key", "leaf", "rank").agg(F.first("tree").alias("tree"), F.sort_array(F.collect_list(F.struct((-F.col("distance")).alias("at"), "role", "text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for b in batches:
            made = [formatted([(t["role"], t["text"]) for t in row.as_py()]) for row in b.column("turns")]
            spans = [[{"start": s, "end": e} for s, e in x] for _, x in made]
            yield pa.RecordBatch.from_arrays([b.column("tree"), b.column("leaf"), b.column("rank"), pa.array([x for x, _ in made], pa.string()), pa.array(spans, span)], names=["tree", "leaf", "rank", "conversation", "loss_spans"])

    return turns.select("tree", "leaf", "rank", "turns").mapInArrow(run, f"tree {kind}, leaf long, rank int, conversation string, loss_spans array<struct<start:long,end:long>>")


def chat_report(made: DataFrame, id_name: str = "conv_id") -> DataFrame:
    """Digests of what reading the conversations back gives."""
    kind = dict(made.dtypes)["tree"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for text, spans in zip(b.column("conversation").to_pylist(), b.column("loss_spans").to_pylist(), strict=True):
                turns = read_back(text)
                loss = "".join(unescaped(text[s["start"] : s["end"]]) for s in spans)
                every = "".join(f"{role}\n{said}\n" for role, said in turns)
                rows.append((len(turns), hashlib.sha256(every.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            cols = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("tree"), *(pa.array(c, t) for c, t in zip(cols, types, strict=True))], names=[id_name, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return made.select("tree", "conversation", "loss_spans").mapInArrow(run, f"{id_name} {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def _escaped_sql(x: str) -> str:
    return f"replace(replace(replace({x}, '\\', '\\\\'), '<', '\\l'), '>', '\\g')"


REPORT_SQL = f"""
WITH every AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), told AS (
  SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    sum(length({_escaped_sql('role')}) + length({_escaped_sql('text')}) + {len('<turn >') + len('</turn>') + 3}) AS formatted_chars
  FROM every GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM told
"""
