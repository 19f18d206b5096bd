r"""Personal data: base patterns, and information-theoretic sanitisation of what gives them away.

Base patterns find e-mail addresses, IP addresses, card and phone numbers.  Each distinct value found is a *protected
entity*, and so is what recurs where the values do not: its group (the mail domain, the first digits of a card or phone
number, the first two numbers of an IP address) and its kind.  Terms near a value (a few words to either side) co-occur with its
entities; counted once per distinct text, the pointwise mutual information of term and entity says how much the term
reveals.  The probability of the entity given the term is smoothed towards its overall probability by ``smoothing`` texts, so
that a term counts from its first text on, but the less the fewer texts speak for it.  A term whose information
reaches a share ``disclosure`` of the entity's own information content gives it away.  Such terms are found wherever they
stand in a text that holds the entity, near or far: those that also occur without the entity are *generalised*, the
others *removed*.

All of it is DataFrame and SQL functions.  Patterns use possessive groups, which the regex engine runs without recursion,
and look behind themselves so that long runs are read once; they match what the plain patterns match.

Results: NULL counts as empty text and has no spans.  Every row comes back; repeated rows are alike, and count once in
the corpus.  Extra columns pass through ``sanitise``; only the text changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mastlight.session import passing_tables, written

KINDS = ("email", "ip", "card", "phone")
#: Equal in effect to the plain patterns: a match can only begin where its run begins, or where the last match ended.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
SIGNS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
#: What takes the place of a removed span.
MARKS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "general": "[TERM]", "remove": ""}
#: Terms to either side of a span, within so many characters, are its surroundings.
AROUND, REACH = 5, 120
SMOOTHING, DISCLOSURE = 0.5, 0.9
TERM = r"\p{L}{3,}"
#: Stands for every character of a span in a masked text; a whole term has neither it nor a letter beside it.
MASK = "\x01"
WHOLE = r"(?<=[^\p{L}\x01])\p{L}{3,}+(?=[^\p{L}\x01])"
#: Characters, and list elements, that are handled at a time.
CHUNK = 512
SPAN = "struct<kind:string,start:int,end:int,value:string>"
#: Digits that name the group of a card or phone number.
PREFIX = {"card": 6, "phone": 4}


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether a digit string passes the check sum: from the right, every second digit is doubled."""
    places = F.sequence(F.lit(1), F.length(digits))
    doubled = F.transform(places, lambda i: F.substr(F.reverse(digits), i, F.lit(1)).cast("int") * (F.lit(2) - i % 2))
    return F.aggregate(doubled, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    if kind == "ip":
        parts = F.split(value, r"\.")
        return F.forall(parts, lambda p: (F.length(F.regexp_replace(p, "^0+", "")) <= 3)
                        & (F.coalesce(F.substr(p, F.greatest(F.length(p) - 2, F.lit(1))).cast("int"), F.lit(0)) <= 255))
    if kind == "card":  # most matches are short numbers
        n = F.length(_digits(value))
        return F.when(F.length(value) < 16, False).when((n >= 16) & (n <= 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.when(F.length(value) < 9, False).otherwise(F.length(_digits(value)).between(8, 15))
    return F.lit(True)


def _named(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _folded(items: Column, zero: Column, step: Callable[[Column, Column], tuple[Column, Column]], kind: str) -> Column:
    """Walk over an array with a state and gather what ``step`` gives: the next state, and an element or NULL.

    Elements are gathered in stretches, as a list is copied for each element that is added to it.
    """
    none = F.array().cast(f"array<{kind}>")

    def inner(seen: Column, x: Column) -> Column:
        after, got = step(seen["state"], x)
        return F.struct(after.alias("state"), F.when(got.isNull(), seen["out"]).otherwise(F.concat(seen["out"], F.array(got))).alias("out"))

    def outer(seen: Column, i: Column, all_: Column) -> Column:
        part = F.aggregate(F.slice(all_, i * CHUNK + 1, F.lit(CHUNK)), F.struct(seen["state"].alias("state"), none.alias("out")), inner)
        return _named(part, lambda r: F.struct(r["state"].alias("state"), F.concat(seen["out"], F.array(r["out"])).alias("out")))

    start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
    return _named(items, lambda all_: F.when(F.size(all_) > 0, F.aggregate(
        F.sequence(F.lit(0), F.floor((F.size(all_) - 1) / CHUNK).cast("int")), start,
        lambda seen, i: outer(seen, i, all_), lambda seen: F.flatten(seen["out"]))).otherwise(none))


def _matches(text: Column, pattern: str) -> Column:
    """Array of (gap, value): each match, and the number of characters since the one before."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s))
    return _named(values, lambda v: F.zip_with(
        F.slice(between, 1, F.size(v)), v, lambda gap, value: F.struct(gap.alias("gap"), value.alias("value"))))


def _found(kind: str, text: Column) -> Column:
    """Array of (kind, start, end, value) of one kind: the text between matches tells where they lie."""
    def step(at: Column, x: Column) -> tuple[Column, Column]:
        begin = at + x["gap"]
        end = begin + F.length(x["value"])
        span = F.struct(F.lit(kind).alias("kind"), begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        return end, F.when(_holds(kind, x["value"]), span)

    sign = SIGNS[kind]
    likely = text.contains(sign) if sign else text.rlike("[0-9]")
    return F.when(likely, _folded(_matches(text, PATTERNS[kind]), F.lit(0), step, SPAN)).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds ``found``: array of (kind, start, end, value), kinds in their order, each by start."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,value:string>>")
    # Only texts with a digit or an @ can hold anything: the others skip all patterns.
    any_ = F.concat(*[_found(kind, F.col("__text")) for kind in KINDS])
    return docs.withColumn("__text", value).withColumn(
        "found", F.when(F.col("__text").rlike("[0-9@]"), any_).otherwise(none)).drop("__text")


def _chunks(text: Column) -> Column:
    """A text in parts of CHUNK characters, so that a place far in is reached without walking there."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _cut(chunks: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` to ``end`` of a text in parts."""
    first, last = F.floor(start / CHUNK).cast("int"), F.floor(end / CHUNK).cast("int")
    part = lambda i: F.coalesce(F.try_element_at(chunks, i + 1), F.lit(""))
    between = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
    return F.when(first == last, F.substr(part(first), start % CHUNK + 1, end - start)).otherwise(
        F.concat(F.substr(part(first), start % CHUNK + 1, F.lit(CHUNK)), between, F.substr(part(last), F.lit(1), end % CHUNK)))


def _outlines(spans: Column) -> Column:
    """Array of (start, end, kind) that lie apart, of spans sorted by start: one that begins inside the last moves its end."""
    kind = "struct<start:int,end:int,kind:string>"
    zero = F.expr(f"cast(named_struct('start', -1, 'end', -1, 'kind', '') AS {kind})")
    after = F.expr(f"cast(named_struct('start', 2147483647, 'end', 2147483647, 'kind', '') AS {kind})")

    def step(seen: Column, s: Column) -> tuple[Column, Column]:
        apart = s["start"] >= seen["end"]
        moved = F.struct(seen["start"].alias("start"), F.greatest(s["end"], seen["end"]).alias("end"), seen["kind"].alias("kind"))
        return F.when(apart, s).otherwise(moved), F.when(apart & (seen["start"] >= 0), seen)

    return _folded(F.concat(spans, F.array(after)), zero, step, kind)


def _replaced(text: Column, spans: Column, by: Callable[[Column], Column]) -> Column:
    """The text with each outline of the sorted spans replaced; its pieces are joined once."""
    def whole(outlines: Column, chunks: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), F.transform(outlines, lambda s: s["end"]))
        ends = F.concat(F.transform(outlines, lambda s: s["start"]), F.array(F.length(text)))
        kept = F.zip_with(starts, ends, lambda a, b: _cut(chunks, a, b))
        return F.array_join(F.zip_with(kept, F.concat(F.transform(outlines, by), F.array(F.lit(""))), lambda k, m: F.concat(k, m)), "")

    return _named(_outlines(spans), lambda outlines: _named(_chunks(text), lambda chunks: whole(outlines, chunks)))


def _plain(spans: Column) -> Column:
    """Spans of any kind as (start, end, kind), sorted."""
    return F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))


def _entities(span: Column) -> Column:
    """Array of the entities of a span: its value, its group and its kind, as strings."""
    kind, value = span["kind"], span["value"]
    group = (F.when(kind == "email", F.lower(F.substring_index(value, "@", -1)))
             .when(kind == "ip", F.substring_index(value, ".", 2)))
    for name, n in PREFIX.items():
        group = group.when(kind == name, F.substring(_digits(value), 1, n))
    return F.array(F.concat(F.lit("value "), kind, F.lit(" "), value), F.concat(F.lit("group "), kind, F.lit(" "), group),
                   F.concat(F.lit("kind "), kind))


def _near(masked: Column, found: Column) -> Column:
    """Array of distinct entities and terms, a newline between: the whole terms around each span, none that touches a span."""
    def around(span: Column, chunks: Column, size: Column) -> Column:
        # One character more than the reach, and one of the span: a term that takes them in is cut, or touches it.
        left = F.concat(F.when(span["start"] <= REACH, " ").otherwise(""),
                        _cut(chunks, F.greatest(span["start"] - (REACH + 1), F.lit(0)), span["start"] + 1))
        right = F.concat(_cut(chunks, span["end"] - 1, F.least(span["end"] + REACH + 1, size)),
                         F.when(span["end"] + REACH + 1 > size, " ").otherwise(""))
        before = _named(F.regexp_extract_all(left, F.lit(WHOLE), F.lit(0)), lambda t: F.slice(
            t, F.greatest(F.size(t) - (AROUND - 1), F.lit(1)), F.lit(AROUND)))
        after = F.slice(F.regexp_extract_all(right, F.lit(WHOLE), F.lit(0)), 1, AROUND)
        return _named(_entities(span), lambda entities: F.flatten(F.transform(
            F.concat(before, after), lambda t: F.transform(entities, lambda e: F.concat(e, F.lit("\n"), F.lower(t))))))

    return _named(_chunks(masked), lambda chunks: _named(F.length(masked), lambda size: F.array_distinct(F.flatten(F.transform(
        found, lambda s: around(s, chunks, size))))))


def _places(masked: Column) -> Column:
    """Array of (term, start, end): every whole term of a masked text."""
    def step(at: Column, x: Column) -> tuple[Column, Column]:
        begin = at + x["gap"]
        end = begin + F.length(x["value"])
        return end, F.struct(F.lower(x["value"]).alias("term"), begin.alias("start"), end.alias("end"))

    edged = F.concat(F.lit(" "), masked, F.lit(" "))  # a term may stand at either end
    return _folded(_matches(edged, WHOLE), F.lit(-1), step, "struct<term:string,start:int,end:int>")


def disclosing_terms(texts: DataFrame, holding: DataFrame, *, smoothing: float = SMOOTHING, disclosure: float = DISCLOSURE) -> DataFrame:
    """(entity, term, action): the terms that give an entity away, and what is to be done with them.

    ``texts`` has the ``words`` of every distinct text, ``holding`` the ``entities`` and ``near`` of those that hold any.
    """
    joint = (
        holding.select(F.explode("near").alias("pair")).groupBy("pair").agg(F.count("*").alias("n_joint"))
        .select(F.substring_index("pair", "\n", 1).alias("entity"), F.substring_index("pair", "\n", -1).alias("term"), "n_joint")
    )
    entities = holding.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    counts = texts.select(F.explode("words").alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    texts = texts.agg(F.count("*").alias("n_texts"))
    n, pair, term, entity = (F.col(c).cast("double") for c in ("n_texts", "n_joint", "n_term", "n_entity"))

    def given(share: Column) -> Column:
        """Probability of an entity of this share of the texts, given the term."""
        return (pair + smoothing * share) / (term + smoothing)

    # What cannot reach the bound of the rarest possible entity goes before entities are joined; the terms of a common one are
    # then few.  A joint entity holds at least ``pair`` and at most all texts.
    likely = written(
        joint.join(counts, "term").join(F.broadcast(texts))  # one row
        .where(given(F.lit(1.0)) >= F.pow(pair / n, F.lit(1 - disclosure))), "likely-terms")
    # Information log(given / share) against a share of the entity's own: - disclosure * log(share).
    return written(
        likely.join(entities, "entity")
        .where((n > entity) & (F.log(given(entity / n) * n / entity) >= disclosure * F.log(n / entity)))
        .select("entity", "term", F.when(term > pair, "general").otherwise("remove").alias("action")), "disclosing")


def find_spans(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per distinct text: ``mark`` (its digest), ``found`` (base spans) and ``extra`` (kind, start, end) spans."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(F.md5(value).alias("mark"), value.alias("__value")).groupBy("mark").agg(F.first("__value").alias("__value"))
    held = F.size("found") > 0
    words = F.regexp_extract_all("__value", F.lit(TERM), F.lit(0))
    with passing_tables(docs.sparkSession):
        spans = written(
            base_spans(texts, "__value")
            .select("mark", "found", F.when(held, F.col("__value")).alias("text"),
                    F.array_distinct(F.transform(words, lambda w: F.lower(w))).alias("words")), "spans")
        hidden = _replaced(F.col("text"), _plain(F.col("found")), lambda s: F.repeat(F.lit(MASK), s["end"] - s["start"]))
        masked = written(spans.where(held).select("mark", "found", "words", hidden.alias("masked")), "masked")
        holding = written(masked.select(
            "mark", "words", F.array_distinct(F.flatten(F.transform("found", _entities))).alias("entities"),
            _near(F.col("masked"), F.col("found")).alias("near"), _places(F.col("masked")).alias("places")), "holding")
        telling = disclosing_terms(spans, holding)
        actions = (
            holding.select("mark", F.explode("words").alias("term")).join(telling, "term")
            .join(holding.select("mark", F.explode("entities").alias("entity")), ["mark", "entity"], "left_semi")
            .groupBy("mark", "term").agg(F.min("action").alias("kind"))
        )
        places = holding.join(actions.select("mark").distinct(), "mark", "left_semi").select("mark", F.explode("places").alias("p"))
        extra = (
            places.select("mark", "p.term", "p.start", "p.end").join(actions, ["mark", "term"])
            .groupBy("mark").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("extra"))
        )
        no_extra = F.array().cast("array<struct<kind:string,start:int,end:int>>")
        return written(spans.select("mark", "found").join(extra, "mark", "left").withColumn(
            "extra", F.coalesce("extra", no_extra)), "all-spans")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, the number of spans of each base kind, SHA-256 of the base spans, all spans."""
    spans = find_spans(docs, text)
    plain = F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    kinds = F.transform("found", lambda s: s["kind"])
    counts = [(F.size("found") - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    shown = spans.select("mark", *counts, F.sha2(_listed(F.col("found")), 256).alias("base_sha256"),
                         _listed(F.concat(plain, "extra")).alias("spans"))
    rows = docs.select(F.col(key), F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("mark"))
    return rows.join(shown, "mark").drop("mark")


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with all spans replaced by the mark of their kind; texts without spans, and NULL, stay as they are."""
    spans = find_spans(docs, text).where("size(found) + size(extra) > 0")
    marks = spans.select(F.col("mark").alias("__mark"), _plain(F.concat(
        F.transform("found", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))), "extra")).alias("__spans"))
    signs = F.create_map(*[F.lit(x) for pair in MARKS.items() for x in pair])
    value = F.col(text).cast("string")
    changed = _replaced(value, F.col("__spans"), lambda s: signs[s["kind"]])
    rows = docs.withColumn("__own", F.md5(F.coalesce(value, F.lit(""))))
    joined = rows.join(marks, rows["__own"] == marks["__mark"], "left")
    return joined.withColumn(text, F.when(F.col("__spans").isNull(), F.col(text)).otherwise(changed)).select(*docs.columns)
