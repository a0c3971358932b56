"""Text cleaning and predicates as column expressions (no Python in the path)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Characters without width or with a direction only, that split a word for a scanner.
INVISIBLE = "".join(map(chr, [0x00AD, 0x180E, *range(0x200B, 0x2010), *range(0x202A, 0x202F), *range(0x2060, 0x2065), 0xFEFF]))
#: Punctuation that may stand at a term's edges.
EDGES = " \t\r\n.,;:!?()[]{}\"'*-–—"
#: Letters that only Vietnamese spelling uses, and how many make a text Vietnamese.
VIETNAMESE = "ăâđêôơưạảấầẩẫậắằẳẵặẹẻẽếềểễệỉịọỏốồổỗộớờởỡợụủứừửữựỳỵỷỹ"
VIETNAMESE_LETTERS = 5
#: The same letters in both cases, as ranges: a class of many letters without regard to case is tried one by one.
VIETNAMESE_RANGES = "\u1ea0-\u1ef9ăĂâÂđĐêÊôÔơƠưƯ"
#: Phrases of legal notices under a message.
FOOTER_NOTICE = (
    r"confidential(?:ity)?(?: and privilege)? (?:notice|warning)|statement of confidentiality|"
    r"intended recipient|the preceding (?:e-?mail )?message|privileged and confidential"
)
#: A quote header left in the middle of a line, in text whose addresses are already tags.
FLAT_QUOTE = r"\bOn\b[^\n]{0,120}?(?:<EMAIL_ADDRESS>|\d{1,2}:\d{2})[^\n]{0,120}?\bwrote:|From:[^\n]{0,150}?(?:Sent|Date):[^\n]{0,80}?(?:To|Subject):"
#: What precedes an answer's subject, and what marks mail that no person wrote.
REPLY_SUBJECT = r"(?i)^\s*(?:fwd?\s*:\s*)*re\s*:"
AUTO_SUBJECT = (
    r"(?i)^\s*(?:automatic reply|auto[- ]?(?:reply|response)|autoreply|out of (?:the )?office|undeliverable|"
    r"delivery status|returned mail|mail delivery)"
)
AUTO_BODY = (
    r"(?i)\bout of (?:the )?office\b|\bautomatic reply\b|\bauto[- ]?(?:reply|response)\b|"
    r"\blimited access to (?:my )?e-?mail\b|\bthis is an automated\b"
)
#: A tag that stands for a redacted span, and the fewest words of two letters that make content.
TAG, CONTENT_WORDS = r"<[A-Z_]+>", 3


#: No ASCII letter, digit or underscore before, and none after.
NO_WORD_BEFORE, NO_WORD_AFTER = r"(?<![0-9A-Za-z_])", r"(?![0-9A-Za-z_])"


def ascii_edges(pattern: str) -> str:
    r"""A pattern whose \b beside a letter mean what RE2, hence the SQL, means by them; Java's take letters beyond ASCII as well."""
    return re.sub(r"\\b(?=[A-Za-z])", lambda _: NO_WORD_BEFORE, pattern).replace(r"\b", NO_WORD_AFTER)


def words(text: Column) -> Column:
    """Whitespace-separated words, by Unicode white space."""
    return F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != "")


def n_words(text: Column) -> Column:
    return F.size(words(text))


def collapsed(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def dedupe_key(text: Column) -> Column:
    return collapsed(F.lower(text))


def normalized_term(text: Column) -> Column:
    """One space between words, no punctuation at the edges, lower case."""
    return F.lower(F.btrim(collapsed(text), F.lit(EDGES)))


def without_invisible(text: Column) -> Column:
    return F.translate(text, INVISIBLE, "")


def has_content(text: Column) -> Column:
    return F.regexp_count(F.regexp_replace(text, TAG, " "), F.lit(r"\p{L}{2,}")) >= CONTENT_WORDS


def is_vietnamese(text: Column) -> Column:
    return F.regexp_count(text, F.lit(f"[{VIETNAMESE_RANGES}]")) >= VIETNAMESE_LETTERS


def has_footer_notice(text: Column) -> Column:
    return text.rlike(f"(?i){FOOTER_NOTICE}")


def without_flat_quote(text: Column) -> Column:
    """The text before the first quote header in mid-line, without white space at its end."""
    quote = ascii_edges(FLAT_QUOTE)
    return F.when(text.rlike(quote), F.regexp_replace(F.regexp_replace(text, f"(?s)(?:{quote}).*$", ""), r"(?U)\s+$", "")).otherwise(text)


def is_reply(subject: Column) -> Column:
    return subject.rlike(REPLY_SUBJECT)


def is_auto_reply(subject: Column, body: Column) -> Column:
    return subject.rlike(AUTO_SUBJECT) | body.rlike(ascii_edges(AUTO_BODY))


def sender_address(header: Column) -> Column:
    return F.lower(F.regexp_extract(header, r"(?U)[\w.+-]+@[\w.-]+", 0))


def trimmed(text: Column, most: int = 300) -> Column:
    flat = collapsed(text)
    return F.when(F.length(flat) > most, F.concat(F.substring(flat, 1, most - 1), F.lit("…"))).otherwise(flat)


def venue_part(value: Column) -> Column:
    """What stands before the first comma of a label's value."""
    return F.btrim(F.split(value, ",")[0], F.lit(" \t.;:-"))


def is_place_term(term: Column) -> Column:
    return term.rlike(r"^[A-Za-z][A-Za-z .'\-]{3,}\z")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once, as a lambda's variable; named in a lambda itself it is computed each time."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def shingles(text: Column, size: int = 5) -> Column:
    """The distinct runs of ``size`` words (letters only, lower case) of a text without its tags."""
    tokens = F.regexp_extract_all(F.lower(F.regexp_replace(text, TAG, " ")), F.lit(r"(\p{L}+)"), 1)

    def runs(w: Column) -> Column:
        starts = F.when(F.size(w) >= size, F.sequence(F.lit(1), F.size(w) - (size - 1))).otherwise(F.array().cast("array<int>"))
        return F.array_distinct(F.transform(starts, lambda i: F.array_join(F.slice(w, i, size), " ")))

    return let(tokens, runs)


def message_time(date: Column) -> Column:
    """ISO dates with their own offset; one without is UTC (the session's zone must be UTC), an invalid one null."""
    return F.try_to_timestamp(date)
