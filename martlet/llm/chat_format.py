"""Chat formatting with a grammar round trip, in DataFrame functions only.

    conversation := turn*
    turn         := "<|im_start|>" role "\\n" text "<|im_end|>" "\\n"
    role, text   := (any character but "\\", no control string inside | "\\" any character)*

Rendering starts with the texts as they are. A deterministic parser reads the result back and
compares it with the source; where it differs, or a control string stands inside a text, the
conflicting turn is escaped and rendered again, until source and reading are identical. An
escape is a backslash that makes the next character stand for itself: every backslash gets
one, and every control string gets one after its first character, which breaks it up.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martlet.llm.common import land

START, END = "<|im_start|>", "<|im_end|>"
# Strings that some chat template or tokenizer gives a meaning.
CONTROL = (START, END, "<|endoftext|>", "<|startoftext|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
CONTROL_RE = "|".join(map(re.escape, CONTROL))
ROLE_RE = r"(?s)^((?:[^\\\n]|\\.)*+)\n"


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, f"(?=({CONTROL_RE}))(.)", r"$2\\")


def escape_role(role: Column) -> Column:
    """As `escape`; a line break, which would end the role, gets a backslash too."""
    return F.regexp_replace(escape(role), "\n", r"\\\n".replace(r"\n", "\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(f"{END}\n"))


def _body(turn: Column) -> Column:
    return F.substring_index(F.substring(turn, len(START) + 1, 1 << 30), f"{END}\n", 1)


def _role(turn: Column) -> Column:
    return F.regexp_extract(_body(turn), ROLE_RE, 1)


def parse_turn(turn: Column) -> Column:
    """Role and text of one rendered turn; null where it is no turn of the grammar."""
    body, role = _body(turn), _role(turn)
    text = body.substr(F.length(role) + 2, F.length(body))
    fits = (
        turn.startswith(START)
        & turn.endswith(f"{END}\n")
        & (F.length(turn) == F.length(body) + F.lit(len(START) + len(END) + 1))
        & F.rlike(body, F.lit(ROLE_RE))
        & ~F.rlike(body, F.lit(CONTROL_RE))
    )
    return F.when(fits, F.struct(unescape(role).alias("role"), unescape(text).alias("text")))


def format_turns(turns: DataFrame) -> DataFrame:
    """Add `rendered` to rows of `role`, `text`: the first form, of raw and escaped, that reads back as the source.

    Which form was taken needs no flag, since reading always takes escapes away. A turn that no form
    brings back stops the job rather than going out changed.
    """
    role, text = F.col("role"), F.col("text")
    out = turns
    tried = []
    for level, form in enumerate((render(role, text), render(escape_role(role), escape(text)))):
        name = f"_form{level}"
        out = out.withColumn(name, form)
        read = parse_turn(F.col(name))
        tried.append(F.when((read["role"] == role) & (read["text"] == text), F.col(name)))
    stuck = F.raise_error(F.concat(F.lit("no form of this turn reads back: "), role)).cast("string")
    return out.withColumn("rendered", F.coalesce(*tried, stuck)).drop("_form0", "_form1")


def format_conversations(
    conversations: DataFrame, trained: str = "assistant", id_col: str = "conv_id", turn_col: str = "turn"
) -> DataFrame:
    """One row per conversation: `conv_id`, `formatted`, and `loss_spans`, the places of the trained texts in it.

    A span is (start, length) in code points and holds one text as rendered. Turns are ordered by turn
    number, null first, then role and text; repeated rows stay. A null text or role is empty. A null id is a
    conversation of its own. Very long texts are one value each, as in the source; an empty table gives no
    rows. Other columns are ignored. A conversation is one row of the result, so its turns meet in one task.
    """
    empty = F.lit("")
    rows = conversations.select(
        F.col(f"`{id_col}`").alias("conv_id"),
        F.col(f"`{turn_col}`").alias("turn"),
        F.coalesce(F.col("`role`"), empty).alias("role"),
        F.coalesce(F.col("`text`"), empty).alias("text"),
    )
    formed = format_turns(rows).withColumn(
        "lead", F.when(F.col("role") == trained, F.length(_role(F.col("rendered"))) + F.lit(len(START) + 1))
    )
    turns = formed.select("conv_id", F.struct("turn", "role", "text", "rendered", "lead").alias("t"))
    grouped = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    placed = F.aggregate(
        "ts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:long,length:long>>").alias("spans")),
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["rendered"])).alias("at"),
            F.when(
                t["lead"].isNotNull(),
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + t["lead"]).alias("start"),
                            (F.length(t["rendered"]) - t["lead"] - F.lit(len(END) + 1)).cast("long").alias("length"),
                        )
                    ),
                ),
            )
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )
    return grouped.select(
        "conv_id",
        F.concat_ws("", F.transform("ts", lambda t: t["rendered"])).alias("formatted"),
        placed["spans"].alias("loss_spans"),
    )


def parse_conversation(formatted: Column) -> Column:
    """Turns of a rendered conversation, in order."""
    pieces = F.filter(F.split(formatted, f"(?<={re.escape(END)}\n)", -1), lambda p: p != "")
    return F.transform(pieces, parse_turn)


def chat_digest(conversations: DataFrame) -> DataFrame:
    """Format all conversations, write them, and sum up what is read back."""
    written = land(format_conversations(conversations), "chat")
    turns = parse_conversation(F.col("formatted"))
    loss = F.concat_ws(
        "",
        F.transform(
            "loss_spans",
            lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ),
    )
    read = written.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    said = F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def marked_conversation(spark) -> DataFrame:
    """Conversation -1: both sides say what ends a turn in another template."""
    side = F.col("id")
    return spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        side.alias("turn"),
        F.when(side == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
