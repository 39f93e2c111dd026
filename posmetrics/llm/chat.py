"""Chat formatting with prefix-target expansion, in SQL expressions only.

A turn is written as ``<s>[INST] role [/INST]text</s>``. Inside roles and texts every
control string gets one more backslash after its first sign, which is taken away when the
text is read back; so a text can say anything, backslashes included.

Every assistant turn is an example of its own: all turns before it are its context and
only its reply is trainable. :func:`format_turns` writes each turn once, with the place of
its reply and of its context in the conversation; :func:`expand` joins every reply with the
turns up to it and makes the examples' full texts, whose size grows with the square of a
conversation's length. The query makes all examples and reads its figures back from them.

Defined cases: a null text or role counts as empty; a null turn comes first, equal turns
are ordered by role and text; repeated rows stay; a null conversation id is a conversation
of its own; a conversation without an assistant turn has no example; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from posmetrics.llm.common import table

# fixed values: the control strings of the template
OPEN, ROLE_END, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
_CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]))"
_ESCAPED = r"([<\[])(\\*)\\(/?(?:s>|INST\]))"
REPLY = "assistant"
PROBE = "</s>[INST] ok [/INST]"


def escape(text: F.Column) -> F.Column:
    return F.regexp_replace(text, _CONTROL, r"$1$2\\$3")


def unescape(text: F.Column) -> F.Column:
    return F.regexp_replace(text, _ESCAPED, "$1$2$3")


def format_turns(
    conversations: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per turn: ``conv_id, position, formatted, start`` (code points of the
    conversation before it, which are the context of its reply), ``loss_from`` and
    ``loss_until`` (the reply within ``formatted``; null where nothing is trained)."""
    rows = conversations.select(
        F.col(conv).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    head = F.concat(F.lit(OPEN), escape(F.col("role")), F.lit(ROLE_END))
    ready = (
        rows.withColumn("head", head)
        .withColumn("formatted", F.concat("head", escape(F.col("text")), F.lit(CLOSE)))
        .withColumn("size", F.length("formatted").cast("long"))
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    trained = F.col("role") == REPLY
    return ready.select(
        "conv_id",
        F.row_number().over(order).cast("long").alias("position"),
        "formatted",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"),
        F.when(trained, F.length("head")).alias("loss_from"),
        F.when(trained, F.length("formatted") - len(CLOSE)).alias("loss_until"),
    )


def expand(formatted: DataFrame) -> DataFrame:
    """The examples in full: ``conv_id, example, text, loss_from, loss_until``. Every reply
    meets the turns up to it, so its size is that of all contexts; a row is one example."""
    replies = formatted.where("loss_from is not null").select(
        F.col("conv_id").alias("own"),
        F.col("position").alias("example"),
        (F.col("start") + F.col("loss_from")).alias("loss_from"),
        (F.col("start") + F.col("loss_until")).alias("loss_until"),
    )
    turns = formatted.select("conv_id", "position", "formatted")
    met = turns.join(replies, F.expr("conv_id <=> own and position <= example"))
    own = F.sort_array(F.collect_list(F.struct("position", "formatted")))
    return (
        met.groupBy("conv_id", "example", "loss_from", "loss_until")
        .agg(own.alias("turns"))
        .select("conv_id", "example", F.array_join("turns.formatted", "").alias("text"), "loss_from", "loss_until")
    )


def read_back(text: F.Column) -> F.Column:
    """Roles and texts of all turns of an example or conversation, unescaped."""
    parts = F.split(text, CLOSE)  # control strings of a text are escaped: it cannot hold one
    body = lambda x: F.substr(x, F.lit(len(OPEN) + 1), F.length(x))
    return F.transform(
        F.slice(parts, F.lit(1), F.size(parts) - 1),
        lambda x: F.struct(
            unescape(F.substr(body(x), F.lit(1), F.instr(body(x), ROLE_END) - 1)).alias("role"),
            unescape(F.substr(body(x), F.instr(body(x), ROLE_END) + len(ROLE_END), F.length(x))).alias("text"),
        ),
    )


def read_turns(formatted: DataFrame) -> DataFrame:
    """Roles, texts and trained replies back from formatted turns, unescaped."""
    body = F.substr(F.col("formatted"), F.lit(len(OPEN) + 1), F.length("formatted") - len(OPEN) - len(CLOSE))
    at = F.instr(body, ROLE_END)
    reply = F.substr(F.col("formatted"), F.col("loss_from") + 1, F.col("loss_until") - F.col("loss_from"))
    return formatted.select(
        "conv_id",
        "position",
        unescape(F.substr(body, F.lit(1), at - 1)).alias("role"),
        unescape(F.substr(body, at + len(ROLE_END), F.length(body))).alias("text"),
        unescape(F.coalesce(reply, F.lit(""))).alias("reply"),
        F.length("formatted").alias("size"),
        (F.col("start") + F.col("loss_until")).alias("expanded"),
    )


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(REPLY).alias("role"),
        F.lit(PROBE).alias("text"),
    )
    formatted = format_turns(given.unionByName(probe))
    examples = expand(formatted)
    reply = F.substr("text", F.col("loss_from") + 1, F.col("loss_until") - F.col("loss_from"))
    # turns after the last reply are in no example
    replied = F.max(F.when(F.col("loss_from").isNotNull(), F.col("position")))
    rest = formatted.withColumn("last", F.coalesce(replied.over(Window.partitionBy("conv_id")), F.lit(0)))
    parts = examples.select(
        "conv_id",
        "example",
        "text",
        unescape(reply).alias("reply"),
        (F.length("text") - len(CLOSE)).cast("long").alias("expanded"),
        F.lit(None).cast("struct<position:bigint,formatted:string>").alias("rest"),
    ).unionAll(
        rest.where("position > last").select(
            "conv_id",
            F.lit(None).cast("long"),
            F.lit(None).cast("string"),
            F.lit(None).cast("string"),
            F.lit(None).cast("long"),
            F.struct("position", "formatted"),
        )
    )
    answer = F.when(F.col("example").isNotNull(), F.struct("example", "reply"))
    grouped = parts.groupBy("conv_id").agg(
        F.coalesce(F.max_by("text", "example"), F.lit("")).alias("longest"),
        F.sort_array(F.collect_list("rest")).alias("rest"),
        F.sort_array(F.collect_list(answer)).alias("replies"),
        F.coalesce(F.sum(F.length("reply")), F.lit(0)).alias("loss_chars"),
        F.count("example").alias("n_examples"),
        F.coalesce(F.sum("expanded"), F.lit(0)).alias("expanded_chars"),
    )
    # the longest example holds all turns up to the last reply
    whole = grouped.withColumn("whole", F.concat("longest", F.array_join("rest.formatted", "")))
    said = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    return whole.withColumn("turns", read_back(F.col("whole"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(said, ""), 256).alias("turns_sha256"),
        "loss_chars",
        F.sha2(F.array_join("replies.reply", ""), 256).alias("loss_sha256"),
        F.length("whole").cast("long").alias("formatted_chars"),
        "n_examples",
        "expanded_chars",
    )


OP4_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), sized AS (
  SELECT *,
         length('<s>[INST] ' || regexp_replace(role, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\2\\\3', 'g') || ' [/INST]')
           AS head,
         length(regexp_replace(text, '([<\[])(\\*)(/?(?:s>|INST\]))', '\1\2\\\3', 'g')) AS body
  FROM given
), placed AS (
  SELECT *, sum(head + body + 4) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text
                                       ROWS UNBOUNDED PRECEDING) AS until
  FROM sized
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(head + body + 4) AS BIGINT) AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       CAST(coalesce(sum(until - 4) FILTER (role = 'assistant'), 0) AS BIGINT) AS expanded_chars
FROM placed GROUP BY conv_id
"""
