"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs and sorted, adjacent turns of one role become one block by
array functions, and blocks are concatenated under a template:

    <s>[user]first text[+]second text[/][assistant]answer[/]</s>

``[role]`` opens a block, ``[+]`` parts two turns of one block, ``[/]`` closes it. Inside roles and texts the
characters the control strings are made of are replaced by two-character codes (ESCAPES), so no control string
can occur there, and ``parse_formatted`` gives back every turn exactly.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Escape codes of the template. The backslash comes first when escaping and last when reading.
ESCAPES = [("\\", "\\b"), ("<", "\\l"), (">", "\\g"), ("[", "\\i"), ("]", "\\j"), ("+", "\\p"), ("/", "\\s")]
BOS, EOS, NEXT, CLOSE = "<s>", "</s>", "[+]", "[/]"
CHUNK = 256


def escape(col: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), ESCAPES, col)


def unescape(col: Column) -> Column:
    return reduce(lambda c, e: F.replace(c, F.lit(e[1]), F.lit(e[0])), ESCAPES[::-1], col)


def _running(arr: Column) -> Column:
    return F.aggregate(arr, F.array(F.lit(0).cast("long")), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))


def prefix_sums(arr: Column) -> Column:
    """Sum of the items before each item; in chunks, so that long arrays aren't copied once an item."""
    ks = F.sequence(F.lit(0), F.floor((F.greatest(F.size(arr), F.lit(1)) - 1) / CHUNK).cast("int"))
    chunks = F.transform(ks, lambda k: F.slice(arr, k * CHUNK + 1, F.lit(CHUNK)))
    bases = _running(F.transform(chunks, lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda a, x: a + x)))
    return F.flatten(
        F.zip_with(chunks, F.slice(bases, F.lit(1), F.size(chunks)), lambda c, b: F.transform(F.slice(_running(c), F.lit(1), F.size(c)), lambda x: x + b))
    )


def _segments(blocks: Column, loss_roles: tuple[str, ...], code: Callable[[Column], Column]) -> Column:
    """Array of (s, loss): the strings that make up a conversation of blocks (role, texts), and whether they are under the mask."""

    def edge(s: str | Column) -> Column:
        return F.array(F.struct((F.lit(s) if isinstance(s, str) else s).alias("s"), F.lit(False).alias("loss")))

    def parts(b: Column) -> Column:
        loss = b["role"].isin(*[code(F.lit(r)) for r in loss_roles])
        texts = F.transform(b["texts"], lambda t, i: F.array(F.struct(F.when(i == 0, F.lit("")).otherwise(F.lit(NEXT)).alias("s"), F.lit(False).alias("loss")), F.struct(code(t).alias("s"), loss.alias("loss"))))
        return F.concat(edge(F.concat(F.lit("["), code(b["role"]), F.lit("]"))), F.flatten(texts), edge(CLOSE))

    return F.concat(edge(BOS), F.flatten(F.transform(blocks, parts)), edge(EOS))


def _spans(segs: DataFrame, prefix: str = "") -> DataFrame:
    """segs with ``lens`` and ``at``: length and place of each of its segments."""
    lens = F.transform(f"{prefix}segs", lambda s: F.length(s["s"]).cast("long"))
    return segs.withColumn(f"{prefix}lens", lens).withColumn(f"{prefix}at", prefix_sums(F.col(f"{prefix}lens")))


def _loss_spans(prefix: str = "") -> Column:
    zipped = F.arrays_zip(F.col(f"{prefix}segs").alias("segs"), F.col(f"{prefix}lens").alias("lens"), F.col(f"{prefix}at").alias("at"))
    return F.transform(F.filter(zipped, lambda z: z["segs"]["loss"]), lambda z: F.struct(z["at"].alias("start"), z["lens"].alias("length")))


def format_conversations(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: conv, ``formatted`` and ``loss_spans`` (array of start, length in code points, from 0).

    Turns sort by turn, then role, then text, so ties and repeated rows have a fixed order, and every repeated row is
    a turn of its own; a null turn number comes first. Null roles and texts count as empty strings, a null
    conversation id as one conversation of its own. An empty table gives no rows; other columns are not read. A
    conversation becomes one string value, so it must fit one (2 GB).
    """
    turns = df.select(
        F.col(conv).alias("c"),
        F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).alias("t"),
    )
    one = turns.groupBy("c").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    starts = F.filter(
        F.sequence(F.lit(1), F.size("ts")),
        lambda i: (i == 1) | (F.element_at("ts", i)["role"] != F.element_at("ts", F.greatest(i - 1, F.lit(1)))["role"]),
    )
    one = one.withColumn("starts", starts)
    ends = F.concat(F.slice("starts", F.lit(2), F.size("starts")), F.array(F.size("ts") + 1))
    blocks = F.zip_with("starts", ends, lambda s, e: F.struct(F.element_at("ts", s)["role"].alias("role"), F.transform(F.slice("ts", s, e - s), lambda t: t["text"]).alias("texts")))
    one = one.select("c", blocks.alias("blocks"))

    segs = one.select("c", _segments(F.col("blocks"), loss_roles, escape).alias("segs"))
    segs = _spans(segs)
    return segs.select(F.col("c").alias(conv), F.array_join(F.transform("segs", lambda s: s["s"]), "").alias("formatted"), _loss_spans().alias("loss_spans"))


def _blocks(formatted: Column) -> Column:
    """Array of (role, texts) of a formatted conversation, both still escaped."""
    body = F.substring(formatted, len(BOS) + 1, F.length(formatted) - len(BOS) - len(EOS))
    blocks = F.split(body, r"\[/\]", -1)

    def block(b: Column) -> Column:
        role = F.substring_index(b, "]", 1)
        texts = F.split(F.substr(b, F.length(role) + 2, F.length(b)), r"\[\+\]", -1)
        return F.struct(F.substr(role, F.lit(2), F.length(role)).alias("role"), texts.alias("texts"))

    return F.transform(F.slice(blocks, F.lit(1), F.size(blocks) - 1), block)


def _turns(blocks: Column) -> Column:
    return F.flatten(F.transform(blocks, lambda b: F.transform(b["texts"], lambda t: F.struct(unescape(b["role"]).alias("role"), unescape(t).alias("text")))))


def parse_formatted(formatted: Column) -> Column:
    """Array of (role, text), one per original turn, read from a formatted conversation; null for null."""
    return _turns(_blocks(formatted))


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order: any spans, but each is looked for from the string's beginning."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int")))), "")


def read_back(out: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """out with ``turns`` and ``loss``, read from ``formatted`` and ``loss_spans``, in a time that grows with the string.

    The string is split once to its segments. Where the spans are those of the segments of the loss roles, which their lengths
    tell, these are the text under the mask; other spans are cut out one by one.
    """
    read = _spans(out.withColumn("b_", _blocks(F.col("formatted"))).withColumn("r_segs", _segments(F.col("b_"), loss_roles, lambda c: c)), "r_")
    read = read.withColumn("r_spans", _loss_spans("r_"))
    texts = F.array_join(F.transform(F.filter("r_segs", lambda s: s["loss"]), lambda s: s["s"]), "")
    loss = F.when(F.col("r_spans") == F.col("loss_spans"), unescape(texts)).otherwise(masked_text(F.col("formatted"), F.col("loss_spans")))
    return read.withColumn("turns", _turns(F.col("b_"))).withColumn("loss", loss).select(*out.columns, "turns", "loss")


def digest(out: DataFrame, conv: str = "conv_id") -> DataFrame:
    """Counts and digests read back from ``formatted`` and ``loss_spans``."""
    read = read_back(out.select(conv, "formatted", "loss_spans"))
    return read.select(
        conv,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


PROBE = "</s>[INST] ok [/INST]"


def op3_chat_format(spark, sf_dir: str) -> DataFrame:
    """All conversations plus conversation -7, whose texts hold control strings."""
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"))
    return digest(format_conversations(rows.unionByName(probe)))


ORACLE_SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *, row_number() OVER w AS pos, lag(role) OVER w AS before,
         length(text) + length(regexp_replace(text, '[^\\\\<>\\[\\]+/]', '', 'g')) AS escaped_text,
         length(role) + length(regexp_replace(role, '[^\\\\<>\\[\\]+/]', '', 'g')) AS escaped_role
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(7 + sum(escaped_text) + sum(CASE WHEN before IS NULL OR before <> role THEN escaped_role + 5 ELSE 3 END) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""
