"""Scanners for personal data: shapes, labels and word lists, each giving (start, end, score) in code points.

There is no language model here: names and places that only a reader can tell come from a provider, a function of a text
giving (start, end, label, score), none by default. Without one, words of the ambiguous list keep their list score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from itertools import islice

import regex
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

I, S = regex.I | regex.M | regex.S, regex.M | regex.S
#: Scores of lists, labelled shapes, venue names, carriers, weak numbers and loose shapes.
LISTED, LABELLED, VENUE, CARRIER, WEAK, LOOSE = 0.85, 0.6, 0.5, 0.8, 0.4, 0.3
#: The recognizer of names that are everyday words too, and most entries of the lists that a text is scanned by.
AMBIGUOUS, LONGEST_LIST = "denylist_ambiguous", 200_000
#: What context adds to a score, and how many words around a hit are context.
CONTEXT_GAIN, CONTEXT_WORDS = 0.35, 5
#: Scores of an ambiguous word in no name, alone, and beside another name.
ORDINARY, ALONE, PAIRED = 0.2, 0.6, 0.85
#: States before a zip code of five digits (California's are known by their own digits), kinds of streets, kinds of venues, words before a venue's name that are no part of it, and words that name no venue by themselves.
STATES = [
    "AL", "AK", "AZ", "AR", "CO", "CT", "DE", "DC", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD", "MA", "MI", "MN", "MS", "MO",
    "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
STREETS = {
    "Avenue": "Ave", "Boulevard": "Blvd", "Circle": "Cir", "Court": "Ct", "Drive": "Dr", "Highway": "Hwy", "Lane": "Ln", "Parkway": "Pkwy", "Place": "Pl", "Plaza": "",
    "Road": "Rd", "Square": "Sq", "Street": "St", "Terrace": "Ter", "Trail": "Trl", "Way": "",
}
VENUES = [
    "Academy", "Ballroom", "Barn", "Center", "Centre", "Chapel", "Church", "Club", "College", "Commons", "Elementary", "Estate", "Estates", "Exchange", "Farm", "Garden",
    "Gardens", "Hall", "Hotel", "Inn", "Library", "Lodge", "Mall", "Manor", "Market", "Marketplace", "Museum", "Park", "Pavilion", "Plaza", "Promenade", "Ranch", "Resort",
    "Restaurant", "School", "Square", "Temple", "Terrace", "Theater", "Theatre", "University", "Village", "Winery",
]
#: Words near a number that raise its score.
EIN_CONTEXT = ("ein", "fein", "tax", "employer", "federal", "tin")
POLICY_CONTEXT = ("policy", "insurance", "certificate", "coi", "coverage", "insured")
ORDER_CONTEXT = ("order", "invoice", "receipt", "tracking", "shipped", "purchase", "payment")
#: Words before a venue's name that are no part of it, and words that name no venue by themselves.
FILLERS = frozenset(["A", "An", "And", "At", "Dear", "For", "From", "Fw", "Fwd", "Hello", "Hi", "In", "My", "Or", "Our", "Re", "Thanks", "That", "The", "Their", "This", "To", "With", "Your"])
GENERIC = frozenset(["Elementary", "High", "Junior", "Main", "Middle", *VENUES])
#: A phone number, a word of a capitalised name, what numbers and codes look like, and what may end a link.
PHONE = r"(?<!\d)(?:\+?1[\s.-]?)?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]\d{4}(?!\d)"
CAPITALISED, ZIP, LINK_END = r"[A-Z][\w'&.-]*", r"\d{5}(?:-\d{4})?", r"[^\s<>.,;:!?)\]'\"]"
NUMBER_LABEL = r"(?:no\.?|number|#)"
_WORD_BEFORE = regex.compile(r"(?r)\w+")


@dataclass(frozen=True)
class Recognizer:
    name: str
    entity: str
    shapes: tuple[tuple[str, float], ...]
    flags: int = I
    context: tuple[str, ...] = ()
    check: Callable[[str, int, int], tuple[int, int] | None] | None = None
    needs: str = ""
    compiled: tuple = field(default=(), compare=False)

    def __post_init__(self):
        object.__setattr__(self, "compiled", tuple((regex.compile(shape, self.flags), score) for shape, score in self.shapes))

    def __reduce__(self):
        return Recognizer, (self.name, self.entity, self.shapes, self.flags, self.context, self.check, self.needs)

    def hits(self, text: str) -> Iterator[tuple[int, int, float]]:
        if self.needs and not regex.search(self.needs, text, regex.I):  # a cheap test that every hit passes
            return
        for shape, score in self.compiled:
            for m in shape.finditer(text):
                span = self.check(text, *m.span()) if self.check else m.span()
                if span and span[0] < span[1]:
                    yield *span, min(1.0, score + CONTEXT_GAIN) if self._in_context(text, *span) else score

    def _in_context(self, text: str, start: int, end: int) -> bool:
        """Whether one of the last words before a hit is a word of context; they are read backwards from the hit."""
        before = islice(_WORD_BEFORE.finditer(text, 0, start), CONTEXT_WORDS) if self.context else ()
        return any(m.group().lower() in self.context for m in before)


def _venue(text: str, start: int, end: int) -> tuple[int, int] | None:
    """A match without the fillers at its start, if any word but the last is a name of its own."""
    words = text[start:end].split()
    first = next((i for i, w in enumerate(words[:-1]) if w not in FILLERS), len(words) - 1)
    if GENERIC.issuperset(words[first:-1]):
        return None
    return text.index(words[first], start) if first == 0 else _after(text, start, first), end


def _after(text: str, start: int, n_words: int) -> int:
    """Where the word after n_words words begins."""
    return regex.compile(rf"(?:\S+\s+){{{n_words}}}").match(text, start).end()


def _card(text: str, start: int, end: int) -> tuple[int, int] | None:
    """Luhn's test: every second digit from the right counts double, less nine where that has two digits."""
    digits = [int(c) for c in reversed(text[start:end]) if c.isdigit()]
    total = sum(digits[::2]) + sum(2 * d - 9 * (d > 4) for d in digits[1::2])
    return None if total % 10 else (start, end)


def _labelled(labels: str, value: str) -> str:
    """A value behind one of some labels."""
    return rf"(?<=\b(?:{labels})\s*)(?:{value})\b"


def shapes() -> list[Recognizer]:
    """The recognizers without lists, in the order that settles ties. Their patterns are fixed values."""
    streets = "|".join(x for pair in STREETS.items() for x in pair if x)
    unit = r"(?:[,\s]+(?:Apt|Apartment|Suite|Ste|Unit|#)\s*[\w-]+)?"
    policy = rf"(?:policy|certificate|cert)\s*{NUMBER_LABEL}\s*[:#-]?"
    order = r"(?:order|invoice|receipt|confirmation|tracking|transaction|reservation|booking)\s*(?:no\.?|number|num|id|#)?\s*[:#-]?"
    code = lambda least, most: rf"[A-Za-z0-9][A-Za-z0-9-]{{{least},{most}}}"
    month, day, year = r"(?:0?[1-9]|1[0-2])", r"(?:0?[1-9]|[12]\d|3[01])", r"(?:\d{4}|\d{2})"
    digit, domain = r"\d", r"[\w-]+(?:\.[\w-]+)+"
    return [
        Recognizer("credit_card", "CREDIT_CARD", ((r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-])", LABELLED),), check=_card, needs=digit),
        Recognizer("us_ssn", "US_SSN", ((r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])", VENUE),), context=("social", "security", "ssn"), needs=digit),
        Recognizer("street_address", "STREET_ADDRESS", ((rf"\b\d{{1,6}}\s+(?:[A-Za-z][\w.'-]*\s+){{0,4}}(?:{streets})\b\.?{unit}", VENUE), (r"\bP\.?\s?O\.?\s?Box\s+\d+\b", LABELLED)), needs=digit),
        Recognizer("social_handle", "SOCIAL_HANDLE", ((r"(?<![\w.@])@[A-Za-z0-9_](?:[A-Za-z0-9_.]{1,28}[A-Za-z0-9_])?\b", WEAK),), needs="@"),
        Recognizer("us_ein", "US_EIN", ((r"\b\d{2}-\d{7}\b", WEAK),), context=EIN_CONTEXT, needs=digit),
        Recognizer("insurance_policy", "INSURANCE_POLICY", ((_labelled(policy, rf"(?=[A-Za-z0-9-]*\d){code(3, 19)}"), LABELLED), (r"\bNAEP\d{4,10}\b", CARRIER)), context=POLICY_CONTEXT, needs="policy|cert|naep"),
        Recognizer("order_id", "ORDER_ID", ((_labelled(order, rf"(?!(?:19|20)\d{{2}}(?![\w-]))(?=(?:[A-Za-z-]*\d){{4}}){code(3, 29)}"), LABELLED),), context=ORDER_CONTEXT, needs="order|invoice|receipt|confirmation|tracking|transaction|reservation|booking"),
        Recognizer("dotted_date", "DATE_TIME", ((rf"(?<!\d)(?<!\d\.){month}\.{day}\.{year}(?!\d)(?!\.\d)", LABELLED),), needs=r"\d\."),
        Recognizer("us_zip", "LOCATION", ((r"(?<![\d$.,/#-])\b9[0-6]\d{3}(?:-\d{4})?\b(?![\d,.]*\d)", LABELLED), (rf"(?<=\b(?:{'|'.join(STATES)})\.?,?\s{{1,3}}){ZIP}\b", LABELLED)), flags=S, needs=r"\d{5}"),
        Recognizer("venue_name", "LOCATION", ((rf"\b(?:{CAPITALISED}\s+){{1,4}}(?:{'|'.join(VENUES)})\b", VENUE),), flags=S, check=_venue, needs="|".join(VENUES)),
        Recognizer("label_location", "LOCATION", ((r"(?<=^[ \t]*(?:Event[ \t]+)?(?:Location|Venue)[ \t]*:[ \t]*)\S(?:[^\r\n]*\S)?", LABELLED),), needs="location|venue"),
        Recognizer("loose_phone", "PHONE_NUMBER", ((rf"(?:(?<![A-Za-z\d])[A-Za-z]+)?{PHONE}[A-Za-z]*", LOOSE),), needs=r"\d{3}"),
        Recognizer("loose_url", "URL", ((rf"\b(?:https?://|www\.)[^\s<>]*{LINK_END}", LOOSE),), needs=r"https?://|www\."),
        Recognizer("loose_email", "EMAIL_ADDRESS", ((rf"(?<![\w.+-])[\w.+-]+@(?![0-9A-Fa-f]{{8}}\.[0-9A-Fa-f]{{8}}\b){domain}", LOOSE),), needs="@"),
    ]


def _listed(name: str, entity: str, entries: list[str], flags: int, overlapping: bool = False) -> list[Recognizer]:
    known = [e for e in dict.fromkeys(entries) if e]
    if not known:
        return []
    whole = lambda x: rf"(?:^|(?<=\W))(?:{x})(?:(?=\W)|$)"
    kinds = [regex.escape(e, special_only=True, literal_spaces=True) for e in known]
    return [Recognizer(name, entity, tuple((whole(x), LISTED) for x in (kinds if overlapping else ["|".join(sorted(kinds, key=len, reverse=True))])), flags)]


def recognizers(names: list[str] = (), ambiguous: list[str] = (), venues: list[str] = (), places: list[str] = (), capitalized: list[str] = ()) -> list[Recognizer]:
    """All recognizers, lists first; of equal finds the earlier one counts."""
    return [
        *_listed("denylist_names", "PERSON", list(names), I),
        *_listed(AMBIGUOUS, "PERSON", list(ambiguous), S),
        *_listed("denylist_venues", "LOCATION", list(venues), I, overlapping=True),
        *_listed("denylist_places", "LOCATION", list(places), I),
        *_listed("denylist_places_capitalized", "LOCATION", list(capitalized), S),
        *shapes(),
    ]


def ambiguous_score(tokens: list[tuple[int, int, str, str]] | None, start: int) -> float | None:
    """The score of an ambiguous word from a parse, (start, end, part of speech, entity) per token; None without one."""
    for i, (low, high, speech, entity) in enumerate(tokens or ()):
        if not low <= start < high:
            continue
        if not speech:
            return None
        beside_name = i + 1 < len(tokens) and tokens[i + 1][2] == "PROPN"
        is_name = speech == "PROPN" and not entity
        return PAIRED if entity == "PERSON" or (is_name and beside_name) else ALONE if is_name else ORDINARY
    return None


Find = tuple[int, int, str, float, str]


def without_inner(found: list[Find]) -> list[Find]:
    """Finds by place; of one entity, one inside another of a higher score, or of the same score and earlier, goes.

    A sweep over the starts, with the finds that are still open: linear but for what overlaps at one place.
    """
    rank = {i: r for r, i in enumerate(sorted(range(len(found)), key=lambda i: (-found[i][3], i)))}
    open_: dict[str, list[tuple[int, int]]] = {}
    kept = []
    for i in sorted(rank, key=lambda i: (found[i][0], -found[i][1], rank[i])):
        start, end, entity, _, _ = found[i]
        holders = [(b, r) for b, r in open_.get(entity, ()) if b > start]
        if not any(b >= end and r < rank[i] for b, r in holders):
            kept.append(i)
        open_[entity] = [*holders, (end, rank[i])]
    return sorted((found[i] for i in sorted(kept, key=rank.get)), key=lambda f: (f[0], -f[3]))


def scan(text: str, known: list[Recognizer], allowed: frozenset[str] = frozenset(), reader: Callable | None = None, parser: Callable | None = None) -> list[Find]:
    """(start, end, entity, score, recognizer) by place; of finds of one entity, one inside another of no lower score goes.

    parser: a function of a text to its tokens (see ambiguous_score), by which words of the ambiguous list are scored anew.
    """
    found = [(a, b, r.entity, score, r.name) for r in known for a, b, score in r.hits(text)]
    if parser is not None and any(f[4] == AMBIGUOUS for f in found):
        tokens = parser(text)
        found = [(a, b, e, ambiguous_score(tokens, a) or score, r) if r == AMBIGUOUS else (a, b, e, score, r) for a, b, e, score, r in found]
    if reader is not None:
        found += [(a, b, label, score, "reader") for a, b, label, score in reader(text)]
    return without_inner([f for f in found if text[f[0] : f[1]] not in allowed])


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """section, entry of a word list, in its order (place): [section] lines, one entry a line, # starts a comment.

    A list that isn't there is empty. Lines are told apart in Spark, so that the path may be any that Spark reads.
    """
    schema = "place bigint, section string, entry string"
    try:
        lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", r"\r?\n")).alias("place", "line"))
    except AnalysisException:
        return spark.createDataFrame([], schema)
    line = F.trim(F.split("line", "#")[0])
    marked = lines.select(F.col("place").cast("bigint"), line.alias("entry"), F.regexp_extract(line, r"^\[(.*)\]$", 1).alias("_opens"))
    so_far = W.partitionBy(F.lit(0)).orderBy("place")  # one short file
    named = marked.withColumn("section", F.coalesce(F.last(F.nullif("_opens", F.lit("")), ignorenulls=True).over(so_far), F.lit("")))
    return named.filter((F.col("entry") != "") & (F.col("_opens") == "")).select("place", "section", "entry")


def from_lists(lists: DataFrame) -> list[Recognizer]:
    """Recognizers of word lists: the sections names, ambiguous, venues, places and capitalized (a list of a bounded size)."""
    rows = lists.orderBy("place").limit(LONGEST_LIST + 1).collect()
    if len(rows) > LONGEST_LIST:
        raise ValueError(f"more than {LONGEST_LIST} entries are no list to scan by")
    sections = {name: [r["entry"] for r in rows if r["section"] == name] for name in ("names", "ambiguous", "venues", "places", "capitalized")}
    return recognizers(**sections)
