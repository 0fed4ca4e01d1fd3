"""Letters without case and accents, one by one, as a database's LIKE compares them."""

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Beyond, there are no letters with case or accents.
_END = 0x20000


def _plain(letter: str) -> str:
    """The letter without accents and case where that is one letter, else as it is."""
    base = "".join(c for c in unicodedata.normalize("NFD", letter) if not unicodedata.combining(c))
    for form in (base.lower(), base.lower().casefold()):
        base = form if len(form) == 1 else base
    return base if len(base) == 1 else letter


@functools.cache
def _table() -> tuple[str, str]:
    """Letters that change and what they become; accents that stand by themselves come last and go."""
    letters = [chr(c) for c in range(_END) if not 0xD800 <= c < 0xE000]
    changed = [(c, _plain(c)) for c in letters if not unicodedata.combining(c)]
    changed = [(c, p) for c, p in changed if c != p and not unicodedata.combining(p)]
    accents = [c for c in letters if unicodedata.combining(c)]
    return "".join(c for c, _ in changed) + "".join(accents), "".join(p for _, p in changed)


def fold_literal(text: str) -> str:
    return text.translate(_translation())


@functools.cache
def _translation() -> dict:
    source, target = _table()
    return {ord(c): target[i] if i < len(target) else None for i, c in enumerate(source)}


def fold(text: Column) -> Column:
    """The text without case and accents."""
    source, target = _table()
    return F.translate(text, source, target)
