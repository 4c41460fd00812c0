"""Chat formatting by event-sourced reconstruction, in DataFrame functions alone.

A log of events is dealt by conversation, sorted by sequence and folded into final messages;
the messages are then rendered with a template whose control strings are escaped inside texts,
and can be read back from the output.

Events have the columns conv_id, seq, turn, kind, role, text:
  open        a message begins at this turn, with a role
  delta       text is appended to the message of this turn
  edit        the text of the message so far is replaced; later turns opened before it go
  regenerate  the text of the message so far is dropped; later turns opened before it go
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table, whole_text

#: The template's control strings. A turn is <s>[INST]role[/INST]text</s>.
OPEN, ROLE_OPEN, ROLE_CLOSE, CLOSE = "<s>", "[INST]", "[/INST]", "</s>"
MASKED_ROLE = "assistant"
#: Size of the pieces in which a stored turn is replayed as streamed deltas.
DELTA_CHARS = 512


def escaped(text: Column) -> Column:
    """Text in which no control string occurs: backslashes are doubled, control strings get one inside."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in (OPEN, ROLE_OPEN, ROLE_CLOSE, CLOSE):
        text = F.replace(text, F.lit(control), F.lit(control[0] + "\\" + control[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def fold_events(events: DataFrame) -> DataFrame:
    """The final messages of each conversation: conv_id, turn, role, text.

    Null text is empty, a null role too. Ties in seq are settled by kind (open, regenerate,
    edit, delta), then text. A message without deltas is empty; one that is never opened has
    an empty role; a conversation without events has no rows. A null conv_id is a
    conversation of its own. Other columns are ignored.
    """
    events = events.select(
        "conv_id", F.col("seq").cast("long").alias("seq"), F.col("turn").cast("long").alias("turn"), "kind", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), whole_text().alias("text")
    )
    rank = F.array_position(F.array(*[F.lit(k) for k in ("open", "regenerate", "edit", "delta")]), F.col("kind"))
    events = events.withColumn("at", F.struct("seq", rank.alias("rank"), "text"))
    message = Window.partitionBy("conv_id", "turn")
    so_far = message.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    resets = F.col("kind").isin("edit", "regenerate")
    folded = (
        events.withColumn("version", F.sum(resets.cast("int")).over(so_far))
        .withColumn("last_version", F.max("version").over(message))
        .groupBy("conv_id", "turn")
        .agg(
            F.coalesce(F.max(F.when(F.col("kind") == "open", F.struct("at", "role")))["role"], F.lit("")).alias("role"),
            F.max(F.when(F.col("kind") == "open", F.col("at"))).alias("opened"),
            F.max(F.when(resets, F.col("at"))).alias("reset"),
            F.collect_list(F.when((F.col("version") == F.col("last_version")) & F.col("kind").isin("delta", "edit"), F.struct("at"))).alias("pieces"),
        )
        .withColumn("text", F.array_join(F.transform(F.array_sort("pieces"), lambda p: p["at"]["text"]), ""))
    )
    earlier = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    last_reset = F.max("reset").over(earlier)
    return folded.withColumn("cut", last_reset).filter(F.col("cut").isNull() | F.col("opened").isNull() | (F.col("opened") > F.col("cut"))).select("conv_id", "turn", "role", "text")


#: A text in UTF-32, of which places are found without reading what is before them.
WIDE = "UTF-32"


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, and mask, the spans (start, end in code points, from 0) that a model is to learn."""
    lead = F.concat(F.lit(OPEN + ROLE_OPEN), escaped(F.col("role")), F.lit(ROLE_CLOSE))
    before = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        messages.select("conv_id", "turn", lead.alias("lead"), escaped(F.col("text")).alias("body"), (F.col("role") == MASKED_ROLE).alias("learn"))
        .withColumn("chars", (F.length("lead") + F.length("body") + len(CLOSE)).cast("int"))
        .withColumn("start", (F.coalesce(F.sum("chars").over(before), F.lit(0)) + F.length("lead")).cast("int"))
        .select("conv_id", "turn", F.concat("lead", "body", F.lit(CLOSE)).alias("whole"), F.when(F.col("learn"), F.struct("start", (F.col("start") + F.length("body")).alias("end"))).alias("span"))
    )
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "whole", "span"))).alias("turns"))
    return turns.select("conv_id", F.array_join("turns.whole", "").alias("formatted"), F.array_compact("turns.span").alias("mask"))


def read_back(rendered: DataFrame) -> DataFrame:
    """From rendered conversations their turns (role, text) and the unescaped texts under the mask."""
    turn = r"(?s)<s>\[INST\](.*?)\[/INST\](.*?)</s>"
    roles, texts = (F.regexp_extract_all("formatted", F.lit(turn), F.lit(i)) for i in (1, 2))
    under = lambda wide, m: unescaped(F.decode(F.substring(wide, 4 * m["start"] + 1, 4 * (m["end"] - m["start"])), WIDE))
    # The outer transform holds the wide text once for all spans.
    learned = F.get(F.transform(F.array(F.encode("formatted", WIDE)), lambda wide: F.transform("mask", lambda m: under(wide, m))), F.lit(0))
    return rendered.select(
        "conv_id",
        "formatted",
        F.arrays_zip(F.transform(roles, unescaped).alias("role"), F.transform(texts, unescaped).alias("text")).alias("turns"),
        learned.alias("learned"),
    )


def own_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with a turn number of its own for each row, from 1 in its conversation.

    Rows go by turn, null turns last, then role, then text (null as empty): rows that repeat a turn
    are turns one after the other, and so are rows without one.
    """
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_last("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")), whole_text())
    return conversations.select("conv_id", F.row_number().over(order).cast("long").alias("turn"), "role", "text")


def events_of(conversations: DataFrame, delta_chars: int = DELTA_CHARS) -> DataFrame:
    """A log as a chat server would have streamed these turns: open, then deltas. No two rows have the same conv_id and turn (see own_turns)."""
    pieces = F.regexp_extract_all(whole_text(), F.lit(f"(?s).{{1,{delta_chars}}}"), F.lit(0))
    log = F.concat(F.array(F.lit("")), pieces)  # the first entry opens the message
    width = 1 << 20
    return conversations.select("conv_id", "turn", "role", F.posexplode(log).alias("k", "text")).select(
        "conv_id", (F.col("turn") * width + F.col("k")).alias("seq"), "turn", F.when(F.col("k") == 0, "open").otherwise("delta").alias("kind"), "role", "text"
    )


def format_chats(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, mask of stored conversations (conv_id, turn, role, text), by replaying them as events.

    Each row is a message, in the order that own_turns defines: by turn, null turns last, then role, then text.
    """
    return render(fold_events(events_of(own_turns(conversations))))


#: A conversation whose texts look like control strings, formatted beside the others as a standing check.
HOSTILE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    hostile = spark.range(len(HOSTILE)).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, HOSTILE[0][2]).otherwise(HOSTILE[1][2]).alias("role"), F.lit(HOSTILE[0][3]).alias("text")
    )
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(hostile)
    learned = F.array_join("learned", "")
    return read_back(format_chats(chats)).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length(learned).cast("long").alias("loss_chars"),
        F.sha2(learned, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = {
    "op6_chat_formatting": r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, replace(replace(replace(replace(replace(text, '\', '\\'), '<s>', '<\s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]'), '</s>', '<\/s>') AS safe FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(safe) + length(role) + length('<s>[INST][/INST]</s>')) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
}
