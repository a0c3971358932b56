"""What happens to a span: redact or keep, and the rule that said so. CASE expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from askmine.functions.text import normalized_term

#: Parts of dates.
MONTH = r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
DAY, ORDINAL = r"(?:[12]?\d|3[01])", r"(?:st|nd|rd|th)"
#: A certain day.
CALENDAR = "|".join((
    rf"\b{MONTH}\.?\s+{DAY}{ORDINAL}?\b",
    rf"\b{DAY}{ORDINAL}?\s+(?:of\s+)?{MONTH}\b",
    r"\b\d{1,2}/\d{1,2}(?:/\d{2,4})?\b",
    r"\b\d{1,2}-\d{1,2}-\d{2,4}\b",
    r"\b\d{1,2}\.\d{1,2}\.\d{2,4}\b",
    r"\b\d{4}-\d{2}-\d{2}\b",
    rf"\b{DAY}{ORDINAL}\b",
))
#: A length of time.
COUNT = (
    r"(?:\d+(?:\.\d+)?|an?|one|two|three|four|five|six|seven|eight|nine|ten|fifteen|twenty|thirty|forty(?:[- ]five)?|fifty|sixty|ninety|"
    r"half(?: an?)?|a half|a couple(?: of)?|a few|few|several)"
)
DURATION = rf"\b{COUNT}(?:\s*(?:-|–|—|to|or)\s*{COUNT})?\s*\+?\s*(?:min|mins|minutes?|hrs?|hours?)\b"
BARE_YEAR = r"^(?:19|20)\d{2}$"
#: A time of day; {end} stands for "no letter follows", which some engines must consume.
CLOCK = r"\b\d{{1,2}}(?::\d{{2}}){{0,2}}\s*(?:am|pm|a\.m\.?|p\.m\.?){end}|\b\d{{1,2}}:\d{{2}}\b|\b\d{{1,2}}\s*o'?clock\b|\bnoon\b|\bmidnight\b"
AMBIGUOUS, AMBIGUOUS_FROM = "denylist_ambiguous", 0.6


def decide(entity: Column, text: Column, score: Column, recognizer: Column, common: dict[str, list[str]] | None = None) -> Column:
    """A struct (decision, rule); the first rule that holds. common: by entity, whole terms to keep (normalised)."""
    term = normalized_term(text)
    is_common = F.lit(False)
    for kind, terms in (common or {}).items():
        if kind in ("DATE_TIME", "LOCATION") and terms:
            is_common = is_common | ((entity == kind) & term.isin(*terms))
    is_date = entity == "DATE_TIME"
    rules = (
        ((entity == "PERSON") & (recognizer == AMBIGUOUS) & score.isNotNull() & (score < AMBIGUOUS_FROM), "keep", "ambiguous_word"),
        (entity == "PERSON", "redact", "person_always"),
        (entity == "URL", "redact", "url_always"),
        (is_common, "keep", "common_word"),
        (is_date & term.rlike(BARE_YEAR), "keep", "bare_year"),
        (is_date & term.rlike("(?i)" + CALENDAR), "redact", "calendar_date"),
        (is_date & term.rlike("(?i)" + CLOCK.format(end="(?![a-z])")), "keep", "clock_time"),
        (is_date & term.rlike("(?i)" + DURATION), "keep", "duration"),
        (is_date, "redact", "datetime_other"),
        (entity == "LOCATION", "redact", "location_always"),
    )
    out = F
    for holds, decision, rule in rules:
        out = out.when(holds, F.struct(F.lit(decision).alias("decision"), F.lit(rule).alias("rule")))
    return out.otherwise(F.struct(F.lit("redact").alias("decision"), F.lit("default").alias("rule")))


#: Shares from which a cluster of questions is skipped or reviewed, and the number of markup terms.
VIETNAMESE_SHARE, TEMPLATE_SHARE, FOOTER_SHARE, MARKUP_TERMS, QUESTION_SHARE = 0.5, 0.5, 0.3, 3, 0.10


def triage(question: Column, vietnamese: Column, template: Column, footer: Column, markup: Column) -> Column:
    """A struct (decision, reason) of a cluster, from its shares and its number of markup terms."""
    pick = lambda decision, reason: F.struct(F.lit(decision).alias("decision"), F.lit(reason).alias("reason"))
    return (
        F.when(vietnamese >= VIETNAMESE_SHARE, pick("skip", "non_english"))
        .when(template >= TEMPLATE_SHARE, pick("skip", "template"))
        .when(footer >= FOOTER_SHARE, pick("skip", "footer"))
        .when(markup >= MARKUP_TERMS, pick("review", "markup"))
        .when(question <= QUESTION_SHARE, pick("review", "few_questions"))
        .otherwise(pick("faq", ""))
    )
