"""Text around a generative classifier: prompts in, categories out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

INSTRUCTION = "Each news item below belongs to exactly one category:"
QUESTION = "Give the category of the next item, in parentheses. It must be one of: "
DEFAULT_SYSTEM = "You are a helpful assistant."

# The turn markers of the chat template.
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"


def _input_block(text: Column) -> Column:
    return F.concat(F.lit("<EXAMPLE>\n<INPUT>\n"), text, F.lit("\n</INPUT>\n"))


def few_shot_examples(df: DataFrame, per_class: int = 1) -> DataFrame:
    """One row ``examples``: the first ``per_class`` texts of every label, in label order.

    Input ``id, label, text``. The ranking keeps ``per_class`` rows per class in every
    task before the shuffle, and the one collected row holds classes x per_class texts.
    """
    first = Window.partitionBy("label").orderBy("id")
    block = F.concat(
        _input_block(F.col("text")), F.lit("<CATEGORY>"), F.col("label"), F.lit("</CATEGORY>\n</EXAMPLE>\n")
    )
    return (
        df.withColumn("rn", F.row_number().over(first))
        .filter(F.col("rn") <= per_class)
        .agg(F.sort_array(F.collect_list(F.struct("label", "rn", block.alias("block")))).alias("parts"))
        .select(F.array_join(F.transform("parts", lambda p: p["block"]), "\n").alias("examples"))
    )


def few_shot_prompt(
    text: Column, examples: Column, categories: Sequence[str], *, instruction: str = INSTRUCTION, question: str = QUESTION
) -> Column:
    """Instruction, examples, allowed categories and the text to classify."""
    return F.concat(
        F.lit(instruction + "\n\n"),
        examples,
        F.lit("\n" + question + ", ".join(categories) + ".\n"),
        _input_block(text),
    )


def chat_messages(user: Column, system: Column | None = None) -> Column:
    """System and user turn as ``array<struct<role, content>>``."""
    default = F.lit(DEFAULT_SYSTEM)
    system_text = default if system is None else F.coalesce(system, default)
    return F.array(
        F.struct(F.lit("system").alias("role"), system_text.alias("content")),
        F.struct(F.lit("user").alias("role"), user.alias("content")),
    )


def render_chat(messages: Column, *, generation_prompt: bool = True) -> Column:
    """Messages as one text with turn markers, ending where the answer starts."""
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(TURN_START), m["role"], F.lit("\n"), m["content"], F.lit(TURN_END + "\n")
        ),
    )
    tail = F.lit(f"{TURN_START}assistant\n" if generation_prompt else "")
    return F.concat(F.array_join(turns, ""), tail)


def parse_category(answer: Column, allowed: Sequence[str], prompt: Column | None = None) -> Column:
    """The allowed category an answer names up to the stop token ``)``, else null."""
    if prompt is not None:
        answer = F.when(
            answer.startswith(prompt), F.substr(answer, F.length(prompt) + 1)
        ).otherwise(answer)
    named = F.lower(F.btrim(F.substring_index(answer, ")", 1), F.lit(" \t\r\n(")))
    return F.when(named.isin(*[c.lower() for c in allowed]), named)
