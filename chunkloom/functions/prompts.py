"""Prompts for a summary model."""

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv

DEFAULT_SYSTEM = "You summarise texts."
DEFAULT_INSTRUCTION = "Write a short summary of this text, in its language:\n\n"


@dataclass(frozen=True)
class ChatTemplate:
    """How a model wants its turns written.

    `turn` holds the placeholders {role} and {content}, role first;
    `opening` is what invites the answer.
    """

    turn: str
    opening: str = ""


def _turn(template: ChatTemplate | None, role: str, content: Column) -> Column:
    if template is None:
        return F.concat(F.lit(role.upper() + ": "), content)
    before, after = template.turn.replace("{role}", role).split("{content}")
    return F.concat(F.lit(before), content, F.lit(after))


def render(
    context: Column,
    system: str = DEFAULT_SYSTEM,
    instruction: str = DEFAULT_INSTRUCTION,
    template: ChatTemplate | None = None,
    max_chars: int = fv.CONTEXT_CHARS,
) -> Column:
    """Prompt text for a context, which the model sees up to `max_chars` characters."""
    asked = F.concat(F.lit(instruction), F.substring(context, 1, max_chars))
    turns = [_turn(template, "system", F.lit(system)), _turn(template, "user", asked)]
    if template is None:
        return F.concat_ws("\n", *turns)
    return F.concat(*turns, F.lit(template.opening))
