"""Where a message's signature lies, told from its lines and spans as rows.

A message with spans becomes rows of one timeline: its lines and its spans. Marks of a line are columns over what its spans
leave visible; what depends on other lines or spans (places, runs of lines, spans that lie together) comes from windows by
message, all on one shuffle; an aggregate gathers the marks, by which the zone is chosen beside the text. Nothing runs in Python.

Two readings are tried. A run of spans of several kinds, a contact among them, makes all from its first line to the text's
end a signature, but for lines that are the message's own. Without one, a name line or a closing with a name near the end does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from askmine.functions import vocabulary as v
from askmine.operators.dedupe import cut

#: Reach of a run of spans in characters, kinds of spans that make one, and those of which one must be there.
REACH, KINDS_NEEDED = 200, 2
CONTACTS = ("EMAIL_ADDRESS", "PHONE_NUMBER", "URL", "STREET_ADDRESS", "SOCIAL_HANDLE")
PARTS = (*CONTACTS, "PERSON", "ORGANIZATION", "LOCATION")
#: Strings of the website's form.
FORM = ("Date/Time of Event", "Message (Please", "Day of Contact", "Total: $")
#: Lines among which a name may open a signature, and words of a name line, a short line, a voice and a sentence.
TAIL, NAME, SHORT, SPOKEN, SENTENCE = 4, 6, 4, 4, 10

LINE, SPAN = 1, 2
ZONE = "struct<start:int,end:int>"


def _words(line: Column) -> Column:
    return F.regexp_extract_all(line, F.lit(v.WORD), F.lit(0))


def _spaced(words: Column) -> Column:
    """Words in lower case, a space on both sides of each."""
    return F.concat(F.lit(" "), F.lower(F.translate(F.array_join(words, " "), "’", "'")), F.lit(" "))


def _small(words: Column) -> Column:
    """How many of the words are in lower case."""
    return F.regexp_count(_spaced_as_is(words), F.lit(r" (?=\p{Ll})[^\p{Lu}\p{Lt} ]+(?= )"))


def _spaced_as_is(words: Column) -> Column:
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _contains_any(line: Column, parts: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for part in parts:
        found = found | F.contains(line, F.lit(part))
    return found


def _is_label(line: Column) -> Column:
    """A field of the event's form: some words, the field's name with what specifies it, and a colon."""
    head = F.regexp_replace(F.substring_index(line, ":", 1), r"\([^)]*\)", " ")
    return F.contains(line, F.lit(":")) & _spaced(_words(head)).rlike(v.LABELS)


def _speech(said: Column, words: Column) -> dict[str, Column]:
    """closes, greets, prose, says: what a line, or the part of it before a contact, is by its words."""
    spaced, n = _spaced(words), F.size(words)
    prose = (n >= SENTENCE) & (5 * _small(words) >= 3 * n)
    closes = spaced.rlike(v.CLOSES) & ~said.rlike(r"\d")
    low = F.lower(said)
    voice = (n >= SPOKEN) & spaced.rlike(v.SPEAKS) | prose & said.rlike(r"^\s*(?:[-*•·]|\d{1,2}[.)])\s")
    says = F.contains(said, F.lit("?")) | spaced.rlike(v.ADDS) | (voice & ~closes & ~low.rlike(v.NOTIFIES) & ~low.rlike(v.CALLS))
    return {"closes": closes, "greets": spaced.rlike(v.GREETS), "prose": prose & ~low.rlike(v.NOTIFIES), "says": says}


def timeline(rows: DataFrame) -> DataFrame:
    """A row for each line and span of (key, text, spans): key, event, no, shown, said, at, till, kind."""
    blank = lambda t, s: F.regexp_replace(F.substring(t, s["start"] + 1, s["end"] - s["start"]), r"[^\n]", " ")
    said = F.aggregate("spans", F.col("text"), lambda t, s: F.overlay(t, blank(t, s), s["start"] + 1, s["end"] - s["start"]))
    # zipped by split, as blanks stand for all but line ends
    rows = rows.withColumn("said", said).withColumn("lines", F.arrays_zip(F.split("text", "\n").alias("shown"), F.split("said", "\n").alias("said")))
    none = {"no": "int", "shown": "string", "said": "string", "at": "int", "till": "int", "kind": "string"}

    def event(which: int, **known: Column) -> Column:
        return F.struct(F.lit(which).alias("event"), *[known.get(c, F.lit(None)).cast(t).alias(c) for c, t in none.items()])

    of_lines = F.transform("lines", lambda x, i: event(LINE, no=i, shown=x["shown"], said=x["said"]))
    of_spans = F.transform("spans", lambda s: event(SPAN, at=s["start"], till=s["end"], kind=s["kind"]))
    return rows.select("key", F.explode(F.concat(of_lines, of_spans)).alias("x")).select("key", "x.*")


def placed(events: DataFrame) -> DataFrame:
    """The timeline with each line's start and end, the line of each span, and the runs of spans that lie together."""
    line, span, part = F.col("event") == LINE, F.col("event") == SPAN, F.col("kind").isin(*PARTS)
    by = W.partitionBy("key")
    so_far, before = (W.unboundedPreceding, W.currentRow), (W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.when(line, F.length("shown") + 1)).over(by.orderBy("event", "no").rowsBetween(*before)), F.lit(0)).cast("int")
    out = events.withColumn("at", F.when(line, start).otherwise(F.col("at"))).withColumn("till", F.when(line, F.col("at") + F.length("shown")).otherwise(F.col("till")))
    in_order = by.orderBy("at", "event", "till", "kind")
    out = out.withColumn("line", F.max(F.when(line, F.col("no"))).over(in_order.rowsBetween(*so_far)))
    near = F.collect_set(F.when(part, F.col("kind"))).over(by.orderBy("at").rangeBetween(0, REACH))
    reached = F.max(F.when(part, F.col("till"))).over(in_order.rowsBetween(*before))
    out = out.withColumns({"_near": near, "_opens": part & (reached.isNull() | (F.col("at") >= reached + REACH))})
    out = out.withColumn("_run", F.sum(F.when(F.col("_opens"), 1).otherwise(0)).over(in_order.rowsBetween(*so_far)))
    makes_one = span & part & (F.size("_near") >= KINDS_NEEDED) & F.arrays_overlap("_near", F.array(*map(F.lit, CONTACTS)))
    of_run = W.partitionBy("key", "_run")
    first = F.min(F.when(makes_one, F.col("at"))).over(of_run)
    out = out.withColumns({"_first": first, "_end": F.max(F.when(span & part, F.col("till"))).over(of_run)})
    return out.withColumn("block", F.when(makes_one & (F.col("at") == F.col("_first")), F.struct(F.col("_first").alias("start"), F.col("_end").alias("end")))).drop("_near", "_opens", "_run", "_first", "_end")


def marked(rows: DataFrame) -> DataFrame:
    """The placed timeline with the marks of each line as a struct, null for other rows."""
    line, span = F.col("event") == LINE, F.col("event") == SPAN
    of_line = W.partitionBy("key", "line")
    rows = rows.withColumns({
        "contact": F.min(F.when(span & F.col("kind").isin(*CONTACTS), F.col("at"))).over(of_line),
        "people": F.collect_set(F.when(span & (F.col("kind") == "PERSON"), F.col("at"))).over(of_line),
    })
    lone = F.when(line, F.col("said"))
    before = F.when(line & F.col("contact").isNotNull(), F.expr("substring(said, 1, contact - at)"))
    rows = rows.withColumn("_head", before).withColumns({"_words": _words(lone), "_head_words": _words(F.col("_head"))})
    of, head = _speech(F.col("said"), F.col("_words")), _speech(F.col("_head"), F.col("_head_words"))
    own = {"closes": F.col("_closes"), "speaks": F.col("_says") | F.col("_greets")}
    head = {k: F.when(F.col("_head").isNull(), own[k]).otherwise(c) for k, c in {"closes": head["closes"], "speaks": head["says"] | head["greets"]}.items()}
    n, blank, label = F.size("_words"), F.trim(F.regexp_replace("shown", r"\s+", " ")) == "", _is_label(F.col("said"))
    rows = rows.withColumns({**{f"_{k}": c for k, c in of.items()}, "_label": label, "_blank": blank, "_titled": (n <= NAME) & (2 * _small(F.col("_words")) <= n)})
    talks = F.col("_says") | F.col("_label") | F.col("_greets") | _contains_any(F.col("said"), FORM)
    # a run of lines: each but the first goes on, in lower case, where the one before it stops without an end
    in_order = W.partitionBy("key", "event").orderBy("no")
    goes_on = F.coalesce(F.lag("said").over(in_order).rlike(r"[^\s.!?:;]\s*$") & F.col("said").rlike(r"^\s*\p{Ll}"), F.lit(False))
    rows = rows.withColumn("_goes_on", goes_on).withColumn("_run", F.sum(F.when(F.col("_goes_on"), 0).otherwise(1)).over(in_order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    run_ends = F.max("no").over(W.partitionBy("key", "event", "_run"))
    shown_words = F.size(_words(F.col("shown")))
    asks = F.contains("shown", F.lit("?"))
    is_short = ~(F.col("_blank") | F.col("_says") | asks | _is_label(F.col("shown")) | (shown_words > SHORT) | F.col("shown").rlike(r"[.!:]\s*$"))
    opens_with = F.col("at") + F.length(F.regexp_extract("shown", r"^[^\p{L}\p{N}]*", 0))
    marks = {
        "no": F.col("no"), "at": F.col("at"), "till": F.col("till"), "blank": F.col("_blank"), "contact": F.col("contact"), "run_ends": run_ends,
        "own": F.col("_says") | F.col("_label"), "prose": F.col("_prose"), "form": _contains_any(F.col("shown"), FORM), "short": is_short, "talks": talks,
        "closes": F.col("_closes"), "stands_over": F.col("_closes") & ~asks, "head_closes": head["closes"], "head_speaks": head["speaks"],
        "titled": F.col("_titled"), "wordy": n > 0, "signed": F.col("_closes") & ~F.contains("said", F.lit("?")) & (F.size("people") > 0),
        "named": F.array_contains("people", opens_with) & F.col("_titled") & ~talks,
    }
    return rows.withColumn("marks", F.when(line, F.struct(*[c.alias(k) for k, c in marks.items()])))


def _numbers(found: Column) -> Column:
    return F.transform(found, lambda x: x["no"])


def _under_closings(lines: Column, no: Column) -> Column:
    """The topmost of the closings over a line, blank lines between them or not; else the line."""
    stop = F.coalesce(F.array_max(_numbers(F.filter(lines, lambda x: (x["no"] < no) & ~x["blank"] & ~x["stands_over"]))), F.lit(-1))
    # by slice: a lambda would look for the stop anew at each line
    above = F.slice(lines, stop + 2, no - stop - 1)
    return F.coalesce(F.array_min(_numbers(F.filter(above, lambda x: ~x["blank"] & x["stands_over"]))), no)


def chosen(gathered: DataFrame) -> DataFrame:
    """zone of each message, from its lines' marks, spans and blocks."""
    lines, n = F.col("lines"), F.size("lines")
    line_of = lambda at: F.size(F.filter(lines, lambda x: x["at"] <= at)) - 1
    within = lambda low, high: F.filter(lines, lambda x: (x["no"] >= low) & (x["no"] <= high))
    contact_in = lambda found: F.array_min(F.transform(found, lambda x: x["contact"]))

    def step(df: DataFrame, *names: str, keep=None, **more) -> DataFrame:
        """The blocks with the named fields and more, those left out that are not kept."""
        blocks = F.transform("blocks", lambda b: F.struct(*[b[c].alias(c) for c in names], *[f(b).alias(k) for k, f in more.items()]))
        return df.withColumn("blocks", F.filter(blocks, keep) if keep else blocks)

    def holds_no_form(b: Column) -> Column:
        goes_on = F.exists(lines, lambda x: x["own"] & (x["no"] > b["bottom"]))
        return ~goes_on & ~F.exists(lines, lambda x: x["form"] & (x["no"] >= b["top"]) & (x["no"] <= b["bottom"]))

    def below_own(b: Column) -> Column:
        own = F.filter(within(b["top"], b["bottom"]), lambda x: x["own"] | (x["prose"] & (x["at"] <= b["contact"])))
        return F.coalesce(F.array_max(F.transform(own, lambda x: F.least(x["run_ends"], b["bottom"]))) + 1, b["top"])

    df = step(gathered, "start", "end", top=lambda b: line_of(b["start"]), bottom=lambda b: line_of(b["end"]), keep=holds_no_form)
    df = step(df, "end", "top", "bottom", contact=lambda b: contact_in(within(b["top"], b["bottom"])))
    df = step(df, top=below_own, keep=lambda b: b["top"] < n)
    df = step(df, top=lambda b: F.coalesce(F.array_max(_numbers(F.filter(lines, lambda x: (x["no"] < b["top"]) & ~x["short"]))) + 1, F.lit(0)))
    df = step(df, "top", last=lambda b: F.array_min(_numbers(F.filter(lines, lambda x: (x["no"] >= b["top"]) & x["contact"].isNotNull()))), keep=lambda b: b["last"].isNotNull())
    df = step(
        df, "top", closing=lambda b: F.array_max(_numbers(F.filter(within(b["top"], b["last"]), lambda x: x["head_closes"]))), speaks=lambda b: F.exists(within(b["top"], b["last"]), lambda x: x["head_speaks"]),
        keep=lambda b: b["closing"].isNotNull() | ~b["speaks"],
    )
    df = step(df, top=lambda b: _under_closings(lines, F.coalesce(b["closing"], b["top"])))
    df = step(df, at=lambda b: F.get(lines, b["top"])["at"])
    df = step(df, at=lambda b: F.least(b["at"], F.array_min(F.transform(F.filter("spans", lambda s: (s["at"] < b["at"]) & (b["at"] < s["till"])), lambda s: s["at"]))))
    from_blocks = F.array_min(F.transform("blocks", lambda b: b["at"] - F.length(F.regexp_extract(F.substring(F.col("text"), F.lit(1), b["at"]), r"<*\z", 0))))

    full = F.filter(lines, lambda x: ~x["blank"])
    df = df.withColumns({"full": full, "block_at": from_blocks})
    last_quiet = F.array_max(F.transform("full", lambda x, i: F.when(~x["talks"], i + 1)))
    df = df.withColumn("quiet", F.slice("full", F.lit(1), F.coalesce(last_quiet, F.lit(0))))
    df = df.withColumn("tails", F.filter(F.slice("quiet", F.greatest(F.size("quiet") - TAIL + 1, F.lit(1)), F.lit(TAIL)), lambda x: x["signed"] | x["named"]))
    after = lambda no: F.coalesce(F.array_min(F.transform(F.filter("full", lambda y: (y["no"] > no) & y["talks"]), lambda y: y["at"])), F.length("text"))
    df = df.withColumn("tails", F.transform("tails", lambda x: F.struct(x["no"].alias("no"), x["signed"].alias("signed"), _under_closings(lines, x["no"]).alias("top"), after(x["no"]).alias("end"))))

    def ends_there(x: Column) -> Column:
        inside = F.filter("full", lambda y: (y["no"] >= x["top"]) & (y["at"] < x["end"]))
        starts_below = F.get(F.col("full"), F.lit(0))["no"] < x["top"]
        return starts_below & ~(x["signed"] & F.exists(inside, lambda y: (y["no"] > x["no"]) & ~y["titled"])) & F.exists(inside, lambda y: y["wordy"] & ~y["closes"])

    df = df.withColumn("tail", F.get(F.filter("tails", ends_there), F.lit(0)))
    df = df.withColumn("tail_at", F.get(lines, F.col("tail.top"))["at"])
    joined = (F.col("tail_at") < F.col("block_at")) & (F.col("block_at") <= F.col("tail.end"))
    zone = F.when(F.col("block_at").isNotNull(), F.struct(F.when(joined, F.col("tail_at")).otherwise(F.col("block_at")).alias("start"), F.length("text").alias("end")))
    return df.withColumn("zone", F.coalesce(zone, F.when(F.col("tail").isNotNull(), F.struct(F.col("tail_at").alias("start"), F.col("tail.end").alias("end")))).cast(ZONE))


def with_zone(messages: DataFrame, text: str, spans: Column, name: str = "zone") -> DataFrame:
    """messages with a struct of the signature's start and end, null where there is none.

    spans: array of (start, end, entity_type) in characters. A null text is empty; null spans are none. A message's lines and
    spans are sorted within one task; choosing takes time by its lines times its blocks. Blanks for spans take time by the text
    times its spans. Columns of messages may have the names that are used here.
    """
    kinds = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["entity_type"].alias("kind")))
    row = F.struct(*[F.col(f"`{c}`") for c in messages.columns])
    # kept once, so that spans are found once; messages without any have no zone, and the others' texts stay out of the windows
    rows = cut(messages.select(F.monotonically_increasing_id().alias("key"), row.alias("row"), F.coalesce(kinds, F.array().cast("array<struct<start:int,end:int,kind:string>>")).alias("spans")))
    body = F.coalesce(F.col("row")[text], F.lit(""))
    held = rows.filter(F.size("spans") > 0)
    events = marked(placed(timeline(held.select("key", body.alias("text"), "spans"))))
    gathered = events.groupBy("key").agg(
        F.sort_array(F.collect_list("marks")).alias("lines"), F.collect_set("block").alias("blocks"), F.collect_list(F.when(F.col("event") == SPAN, F.struct("at", "till"))).alias("spans"),
    )
    found = chosen(gathered.join(held.select("key", "row", body.alias("text")), "key")).select("row", "zone")
    found = found.unionByName(rows.filter(F.size("spans") == 0).select("row", F.lit(None).cast(ZONE).alias("zone")))
    return found.select(*[F.col("row")[c].alias(c) for c in messages.columns], F.col("zone").alias(name))
