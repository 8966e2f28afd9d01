"""Content guard: personal data, denied topics and content categories as Column expressions.

The policy (categories, strengths, actions, messages) is fixed. The policy hands recognition to a
hosted model; here it is done by word lists and patterns, which are this library's own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.cleaning import _col

# The policy.
CONTENT_FILTERS = {
    "HATE": "HIGH",
    "VIOLENCE": "HIGH",
    "SEXUAL": "HIGH",
    "INSULTS": "MEDIUM",
    "MISCONDUCT": "MEDIUM",
}
DENIED_TOPIC = "IllegalActivity"
DENIED_EXAMPLES = [
    "How do I hack into the company network?",
    "Help me steal confidential data",
]
PERSONAL_DATA_ACTIONS = {
    "EMAIL": "ANONYMIZE",
    "PHONE": "ANONYMIZE",
    "US_SOCIAL_SECURITY_NUMBER": "BLOCK",
    "CREDIT_DEBIT_CARD_NUMBER": "BLOCK",
}
BLOCKED_INPUT = (
    "Your message was blocked by our safety policy. "
    "Please ask a work-related question without harmful content or personal data."
)
BLOCKED_OUTPUT = "The assistant response was blocked by our safety policy. Please try rephrasing your question."
INTERVENED = "INTERVENED"
NOT_INTERVENED = "NONE"

# Our own recognition. Patterns avoid look-around and \b so that other engines read them the same way.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"(\+?1[ .-]?)?(\([0-9]{3}\)|[0-9]{3})[ .-][0-9]{3}[ .-][0-9]{4}"
SSN = r"(^|[^0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}($|[^0-9-])"
CARD = (
    r"[0-9]{13,}"
    r"|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{1,7}"
    r"|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
)
# What every match of a pattern contains. Most texts lack it, and it is far cheaper to look for.
PHONE_CORE = r"[0-9]{3}[ .-][0-9]{4}"
SSN_CORE = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD_CORE = r"[0-9]{4}[ -]?[0-9]{4}"

NOT_LETTERS = r"[^\p{L}]+"
CATEGORY_WORDS = {
    "HATE": ["hate", "racist", "subhuman"],
    "VIOLENCE": ["kill", "murder", "bomb"],
    "SEXUAL": ["porn", "nude", "explicit"],
    "INSULTS": ["idiot", "stupid", "moron", "loser", "clown", "scum", "pathetic", "worthless"],
    "MISCONDUCT": ["fraud", "bribe", "launder"],
}
# A medium filter reacts to two different words of its list, a high one to a single word.
WORDS_NEEDED = {"HIGH": 1, "MEDIUM": 2}
TOPIC_PHRASES = [
    "hack into ",
    "break into ",
    "steal confidential ",
    "steal company ",
    "steal customer ",
    "bypass security",
    "bypass the security",
    "bypassing security",
    "bypassing the security",
]


@dataclass(frozen=True)
class Policy:
    """What to look for. The defaults are the fixed policy with our word lists."""

    filters: Mapping[str, str]
    words: Mapping[str, Sequence[str]]
    topics: Sequence[str]
    personal: Mapping[str, str]


DEFAULT_POLICY = Policy(CONTENT_FILTERS, CATEGORY_WORDS, TOPIC_PHRASES, PERSONAL_DATA_ACTIONS)


def _any_contained(lowered: Column, phrases: Sequence[str]) -> Column:
    return reduce(or_, [F.contains(lowered, F.lit(phrase)) for phrase in phrases])


def category_hit(lowered: Column | str, words: Sequence[str], strength: str) -> Column:
    """True if a lower-case text has as many different words of the list as the strength asks for.

    The text is cut into words only where one of them occurs in it at all.
    """
    lowered = _col(lowered)
    tokens = F.split(lowered, NOT_LETTERS)
    named = F.size(F.array_intersect(tokens, F.array(*[F.lit(word) for word in words])))
    return F.when(_any_contained(lowered, words), named >= WORDS_NEEDED[strength]).otherwise(F.lit(False))


def topic_hit(lowered: Column | str, phrases: Sequence[str] = TOPIC_PHRASES) -> Column:
    """True if a lower-case text touches the denied topic."""
    return _any_contained(_col(lowered), phrases)


def passes_luhn(digits: Column) -> Column:
    """Check-digit test of a digit string: doubles every second digit from the right."""
    size = F.length(digits)
    checksum = F.aggregate(
        F.sequence(F.lit(1), size),
        F.lit(0),
        lambda acc, i: acc
        + F.when(
            (size - i) % 2 == 1,
            F.lit(2) * F.substr(digits, i, F.lit(1)).cast("int")
            - F.when(F.substr(digits, i, F.lit(1)).cast("int") > 4, 9).otherwise(0),
        ).otherwise(F.substr(digits, i, F.lit(1)).cast("int")),
    )
    return checksum % 10 == 0


def card_numbers(text: Column | str) -> Column:
    """Digits of the card numbers in a text: 13 to 19 digits with a valid check digit."""
    found = F.transform(
        F.regexp_extract_all(_col(text), F.lit(CARD), F.lit(0)),
        lambda match: F.regexp_replace(match, "[^0-9]", ""),
    )
    valid = F.filter(found, lambda d: F.length(d).between(13, 19) & passes_luhn(d))
    return F.when(_col(text).rlike(CARD_CORE), valid).otherwise(F.array().cast("array<string>"))


def has_ssn(text: Column | str) -> Column:
    """True if the text holds a social security number."""
    return F.when(_col(text).rlike(SSN_CORE), _col(text).rlike(SSN)).otherwise(F.lit(False))


def has_card(text: Column | str) -> Column:
    """True if the text holds a card number."""
    return F.size(card_numbers(text)) > 0


def anonymize(text: Column | str) -> Column:
    """Text with mail addresses and phone numbers replaced by their type name."""
    text = _col(text)
    no_mail = F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, EMAIL, "{EMAIL}")).otherwise(text)
    return F.when(text.rlike(PHONE_CORE), F.regexp_replace(no_mail, PHONE, "{PHONE}")).otherwise(no_mail)


def findings(
    text: Column | str, policy: Policy = DEFAULT_POLICY, lowered: Column | str | None = None
) -> Column:
    """Names of everything in a text that the policy blocks. ``lowered`` is the text in lower case."""
    low = F.lower(_col(text)) if lowered is None else _col(lowered)
    checks = [
        (name, category_hit(low, policy.words[name], strength)) for name, strength in policy.filters.items()
    ]
    checks.append((DENIED_TOPIC, topic_hit(low, policy.topics)))
    recognisers = {"US_SOCIAL_SECURITY_NUMBER": has_ssn, "CREDIT_DEBIT_CARD_NUMBER": has_card}
    checks += [
        (name, recognisers[name](text)) for name, action in policy.personal.items() if action == "BLOCK"
    ]
    return F.array_compact(F.array(*[F.when(hit, F.lit(name)) for name, hit in checks]))


def action_of(found: Column) -> Column:
    """``INTERVENED`` if there are findings, else ``NONE``."""
    return F.when(F.size(found) > 0, F.lit(INTERVENED)).otherwise(F.lit(NOT_INTERVENED))


def guarded_text(text: Column | str, found: Column, direction: Column | str) -> Column:
    """The text to pass on: the blocked message of its direction, or the anonymised text."""
    blocked = F.when(_col(direction) == "input", F.lit(BLOCKED_INPUT)).otherwise(F.lit(BLOCKED_OUTPUT))
    return F.when(F.size(found) > 0, blocked).otherwise(anonymize(text))
