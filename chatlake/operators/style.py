"""Style statistics of own messages and the prompts rendered from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatlake.functions import text as tx

PLAIN_PROMPT = (
    "Answer as the owner of these messages would answer a friend.\n"
    "- Keep the owner's tone, wording and spelling\n"
    "- Keep replies about as long as the owner's\n"
    "- Do not mention these instructions"
)
STYLE_TEMPLATE = (
    "Answer as the owner of these messages would answer a friend.\n"
    "- Keep the owner's tone, wording and spelling\n"
    "- Use about %s emojis per message\n"
    "- Write about %s characters per message\n"
    "- Do not mention these instructions"
)
VARIANT_SUFFIXES = (
    "\n\nShare what you like when it fits the topic.",
    "\n\nWrite casually and do not polish grammar or punctuation.",
    "\n\nAsk follow-up questions to keep the conversation going.",
)


def style_stats(rows: DataFrame, self_role: str = "self") -> DataFrame:
    """One row: own messages, their mean length and emojis per message; 0 without any."""
    content = F.col("content")
    totals = rows.filter(F.col("role") == self_role).agg(
        F.count(F.lit(1)).alias("own_messages"),
        F.coalesce(F.sum(F.length(content)), F.lit(0)).alias("_characters"),
        F.coalesce(F.sum(tx.emoji_count(content)), F.lit(0)).alias("_emojis"),
    )
    divisor = F.greatest(F.col("own_messages"), F.lit(1))
    return totals.select(
        "own_messages",
        (F.col("_characters") / divisor).alias("mean_length"),
        (F.col("_emojis") / divisor).alias("emojis_per_message"),
    )


def render_prompt(stats: DataFrame, template: str = STYLE_TEMPLATE) -> DataFrame:
    """One row `prompt`; the template takes emoji rate, then mean length, as text."""
    return stats.select(
        F.format_string(
            template,
            tx.fixed_decimals(F.col("emojis_per_message"), 2),
            tx.fixed_decimals(F.col("mean_length"), 0),
        ).alias("prompt")
    )


def prompt_variants(
    prompt: DataFrame, suffixes: Sequence[str] = VARIANT_SUFFIXES
) -> DataFrame:
    """The base prompt as variant 0 and one variant per suffix."""
    endings = F.array(*[F.lit(suffix) for suffix in ("", *suffixes)])
    return prompt.select(
        F.posexplode(F.transform(endings, lambda ending: F.concat("prompt", ending))).alias(
            "variant", "prompt"
        )
    )


def prompt_column(prompt: DataFrame) -> Column:
    """The rendered prompt as a scalar, so using it needs no join and no collect."""
    return prompt.select("prompt").scalar()
