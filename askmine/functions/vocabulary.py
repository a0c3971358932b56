"""Words by which the lines of a message are told apart, and the patterns that look for them in a line's words.

A line's words are in lower case, each with a space on both sides; phrases are whole runs of words.
"""

from __future__ import annotations

from collections.abc import Iterable

#: A word of a line.
WORD = r"\p{L}+(?:['’]\p{L}+)*"


def either(phrases: Iterable[str]) -> str:
    return "(?:" + "|".join(phrases) + ")"


#: Who speaks or is spoken to, words of thanks and hope, and who speaks or is spoken to in Vietnamese.
VOICE = (
    "i", "i'm", "i've", "i'll", "i'd", "me", "my", "mine", "we", "we're", "we've", "we'll", "we'd", "us", "our", "ours",
    "you", "you're", "you've", "you'll", "you'd", "your", "yours", "he", "she", "they", "him", "her", "his", "hers", "them", "their", "theirs",
    "sorry", "thank", "thanks", "thank you", "hope", "appreciate", "looking forward",
    "tôi", "toi", "chúng", "mình", "bạn", "anh", "chị", "chi", "em", "con", "cháu", "ông", "bà", "cô", "chú", "quý",
)
#: Phrases that close a message.
SIGN_OFF = (
    "best", "best regards", "best wishes", "all the best", "kind regards", "kindest regards", "kindly", "warm regards", "warmest regards",
    "warm wishes", "warmly", "warmest", "regards", "sincerely", "sincerely yours", "respectfully", "respectfully yours", "cheers",
    "thanks", "thanks so much", "thanks again", "thank you", "thank you so much", "thank you again", "thank you very much", "thank you kindly", "many thanks",
    "ty", "thx", "with gratitude", "with love", "gratefully", "love", "take care", "talk soon", "xoxo", "xo",
    "have a great day", "have a great weekend", "have a great evening", "have a great night", "have a great one",
    "have a good day", "have a good weekend", "have a good evening", "have a good night", "have a good one",
    "have a nice day", "have a nice weekend", "have a nice evening", "have a nice night", "have a nice one",
    "have a wonderful day", "have a wonderful weekend", "have a wonderful evening", "have a wonderful night", "have a wonderful one",
    "have a blessed day", "have a blessed weekend", "have a blessed evening", "have a blessed night", "have a blessed one",
    "bless", "blessings", "god bless", "god blessings", "many bless", "many blessings",
)
#: Greetings, and the days' parts that one may wish.
GREETING = ("hi", "hello", "hey", "dear", "greetings", "good morning", "good afternoon", "good evening")
#: What a call to action asks for.
CALL = ("follow", "like", "visit", "find", "check", "add", "connect with")
#: Postscripts, as their letters are written.
POSTSCRIPT = ("p s", "ps", "p p s", "pps", "pp s")
#: Parts of legal notices.
NOTICES = (
    "confidential", "sole use of", "intended for", "intended only for", "intended recipient", "protect your privacy", "clicking the link does not work", "unsubscribe",
)
#: Fields of an event's form, what may follow two of them, and most words before one. Labels of contacts are none.
FIELDS = (
    "date", "time", "location", "venue", "event", "performance", "guest", "guests", "budget", "insurance", "coordinator", "notes", "message", "total", "lion", "lions",
)
AFTER_FIELD = ("insurance required", "insurance needed", "coordinator name", "coordinator contact number")
LEAD_WORDS = 5

#: The patterns, over a line's words.
SPEAKS = f" {either(VOICE)} "
CLOSES = f"^ {either(SIGN_OFF)} (?:(?:and )?{either(SIGN_OFF)} )*$"
GREETS = f"^ {either(GREETING)} "
ADDS = f"^ {either(POSTSCRIPT)} "
LABELS = rf"^ (?:\S+ ){{0,{LEAD_WORDS}}}{either((*AFTER_FIELD, *FIELDS))} (?:of (?:(?:the|your|our) )?(?:\S+ )?)?$"
#: Over a line in lower case: a call to action, which asks for something with "us" or "our" soon after.
CALLS = rf"^\P{{L}}*(?:please\P{{L}}+)?{either(c.replace(' ', '[^a-z]+') for c in CALL)}(?!\p{{L}}).{{0,27}}?(?<!\p{{L}})(?:us|our)(?!\p{{L}})"
NOTIFIES = either(NOTICES)
