"""Text columns: stripping, normalising, phrase matching, generated-text clean-up."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from chunkloom import fixed_values as fv

# (?U) makes \s and \b follow Unicode, (?d) leaves "\n" as the only line end.
_SPACES = r"[\s\x1c-\x1f]"
_ECHO = (
    r"(?Uimsd)"
    rf"###{_SPACES}*(?:{'|'.join(fv.HEADING_WORDS)}){_SPACES}*:?.*?$"
    rf"|{re.escape(fv.CHAT_OPEN)}.*?{re.escape(fv.CHAT_CLOSE)}"
    rf"|^{_SPACES}*(?:{'|'.join(fv.ROLE_WORDS)})\b.*$"
)
_SENTENCE_GAP = rf"(?U)(?<=[.!?]){_SPACES}+"


def or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def strip(text: Column) -> Column:
    """Remove white space of any script from both ends."""
    return F.btrim(text, F.lit(fv.WHITESPACE))


def normalise(text: Column) -> Column:
    """Letters and digits only, lower case."""
    return F.lower(F.regexp_replace(text, fv.NOT_LETTER_OR_DIGIT, ""))


def _normalise_literal(phrase: str) -> str:
    return "".join(ch for ch in phrase if ch.isalnum()).lower()


def _contains_any(value: Column, words) -> Column:
    """The value is bound to a lambda variable, as a filter would compute it anew for every word."""
    if not words:
        return F.lit(False)
    words = F.lit(words)
    return F.exists(F.array(value), lambda bound: F.exists(words, lambda word: F.contains(bound, word)))


def has_stop_phrase(text: Column, phrases) -> Column:
    """True where any phrase occurs, as written (ignoring case) or after normalising both sides.

    The cheaper layer comes first, so rows it drops never pay for the second
    one. A phrase without letters or digits takes part in the first layer only.
    """
    raw = sorted({p.lower() for p in phrases if p})
    bare = sorted({_normalise_literal(p) for p in phrases} - {""})
    hit = _contains_any(F.lower(text), raw) | _contains_any(normalise(text), bare)
    return F.coalesce(hit, F.lit(False))


def _after_marker(text: Column) -> Column:
    at = F.instr(text, fv.SUMMARY_MARKER)
    return F.when(at > 0, F.substr(text, at + F.lit(len(fv.SUMMARY_MARKER)))).otherwise(text)


def sentences(text: Column) -> Column:
    """Non-blank sentences, split at white space that follows '.', '!' or '?'."""
    parts = F.transform(F.split(strip(text), _SENTENCE_GAP), strip)
    return F.filter(parts, lambda s: s != "")


def strip_echo(text: Column, max_sentences: int = fv.MAX_SENTENCES) -> Column:
    """Drop prompt remains from generated text and keep its first sentences."""
    body = F.regexp_replace(_after_marker(text), _ECHO, "")
    return F.array_join(F.slice(sentences(body), 1, max_sentences), " ")


def is_blank(text: Column) -> Column:
    return strip(or_empty(text)) == ""
