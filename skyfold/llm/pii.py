"""Personal data by voting labelers, written in SQL functions only.

The base patterns find e-mail addresses, IP addresses, card and phone numbers; what they
find always counts.  Wider patterns propose further spans.  On each proposal labelers
vote for or against: the base pattern, words of a gazetteer before the span, the form
of the number, its check digit, and the letters right beside it.  How far each labeler
can be trusted is estimated by expectation maximisation over the counts of vote
patterns, of which there are few however many documents there are; the posteriors then
weight the training of a classifier of features (naive Bayes on the span's shape
and its surroundings), whose score decides on the wider proposals.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm import weak
from skyfold.llm.common import stored, tucked, untucked

#: Fixed by the definition of the base, in the order in which kinds are listed.  Lookbehinds and possessive
#: quantifiers change no match: they keep a long run of letters or digits from being tried from each of its places.
KINDS = ("email", "ip", "card", "phone")
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a base pattern to be tried at all.
NEEDS = {"email": "@", "ip": ".", "card": "", "phone": "+"}
#: Wider patterns: addresses that are spelled out, and numbers in groups.
WIDE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9._%+-]++[\x20]?(?:\(at\)|\[at\]|\x20at\x20)[\x20]?[a-z0-9-]++(?:[\x20]?(?:\(dot\)|\[dot\]|\x20dot\x20)[\x20]?[a-z0-9-]++)++",
    "number": r"\+?\(?[0-9]++(?:[\x20().-]{1,3}[0-9]++)*+",
}
#: Words before a span that speak for a kind.
GAZETTEER = {
    "email": "e-?mail|mail|contact|correo|courriel|write",
    "ip": "ip|host|server|address|adresse|client",
    "card": "card|visa|mastercard|credit|debit|karte|carte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|telefon|cell",
}
#: Letters of context on either side that a proposal keeps.
CONTEXT = 24

_MATCH = "array<struct<s:int,e:int,value:string,before:string,after:string>>"
_SPAN = "array<struct<s:int,e:int,kind:int>>"
_PROPOSAL = "array<struct<s:int,e:int,kind:int,votes:string,features:array<string>>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _before(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each int of an array, ``merge`` (associative, 0 its neutral element) of all before it.

    A fold copies its array at every step.  Here n values are folded in parts of about the
    cube root of n, so all copies are of n^(4/3) values and not of n^2.
    """

    def fold(part: Column, start: Column) -> Column:
        kind = "struct<at:int,out:array<int>>"
        first = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out")).cast(kind)
        return F.aggregate(part, first, lambda acc, x: F.struct(merge(acc["at"], x).alias("at"), F.concat(acc["out"], F.array(acc["at"])).alias("out")).cast(kind))["out"]

    def by_parts(whole: Column) -> Column:
        width = F.greatest(F.lit(1), F.ceil(F.cbrt(F.size(whole))).cast("int"))
        last = F.greatest(F.lit(0), F.floor((F.size(whole) - 1) / width).cast("int"))
        parts = F.transform(F.sequence(F.lit(0), last), lambda k: F.slice(whole, k * width + 1, width))
        sums = lambda parts: F.transform(parts, lambda part: F.aggregate(part, F.lit(0), lambda a, x: merge(a, x).cast("int")))
        return _let(parts, lambda parts: F.flatten(F.zip_with(parts, fold(sums(parts), F.lit(0)), fold)))

    return _let(values.cast("array<int>"), by_parts)


def _add(a: Column, b: Column) -> Column:
    return a + b


def _most(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def _apart(matches: Column, base: Column) -> Column:
    """The matches that share no character with a span of the base: in one order, none before ends later and none after starts earlier."""
    end = 2**31 - 1
    own = lambda x, mine: F.struct(x["s"].alias("s"), x["e"].alias("e"), F.lit(mine).alias("mine"), *((x[c] if mine else F.lit("")).alias(c) for c in ("value", "before", "after")))
    every = F.array_sort(F.concat(F.transform(base, lambda b: own(b, False)), F.transform(matches, lambda m: own(m, True))))

    def split(every: Column) -> Column:
        ends = _before(F.transform(every, lambda x: F.when(x["mine"], 0).otherwise(x["e"])), _most)
        starts = F.reverse(_before(F.reverse(F.transform(every, lambda x: F.when(x["mine"], 0).otherwise(end - x["s"]))), _most))
        beside = F.zip_with(ends, starts, lambda e, s: F.struct(e.alias("e"), (end - s).alias("s")))
        return F.filter(F.zip_with(every, beside, lambda x, b: F.when(x["mine"] & (b["e"] <= x["s"]) & (b["s"] >= x["e"]), x)), lambda x: x.isNotNull())

    kept = lambda x: F.struct(*(x[c].alias(c) for c in ("s", "e", "value", "before", "after")))
    return F.transform(_let(every, split), kept).cast(_MATCH)


def _matches(text: Column, pattern: str) -> Column:
    """Start, end (code points), value and context of each match, in order."""
    gaps = F.split(text, pattern, -1)
    beside = F.zip_with(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), gaps, lambda v, g: F.struct(F.length(g).alias("gap"), F.length(v).alias("n"), v.alias("value"), F.right(g, F.lit(CONTEXT)).alias("before")))
    between = F.zip_with(beside, F.slice(gaps, 2, F.size(gaps)), lambda c, g: F.struct(*(c[x].alias(x) for x in ("gap", "n", "value", "before")), F.left(g, F.lit(1)).alias("after")))
    cells = F.filter(between, lambda c: c["n"].isNotNull())
    placed = lambda c, at: F.struct((at + c["gap"]).alias("s"), (at + c["gap"] + c["n"]).alias("e"), c["value"].alias("value"), c["before"].alias("before"), c["after"].alias("after"))
    walked = _let(cells, lambda cells: F.zip_with(cells, _before(F.transform(cells, lambda c: c["gap"] + c["n"]), _add), placed))
    return F.when(text.rlike(pattern), walked.cast(_MATCH))


def _cut(chain: Column) -> Column:
    """Proposals out of a chain of more digits than any number has, as an array.

    From each group of digits on, the longest run of groups with at most 12 digits and
    with at most 16 are proposed, where they have 7 and 13 at least.  They may overlap.
    Groups of the chain beside a run are its context.
    """
    groups = lambda c: F.regexp_extract_all(c["value"], F.lit(r"[+(]*+[0-9]++[\x20().-]*+"), F.lit(0))
    kind = "struct<digits:int,text:string,open:boolean>"

    def run(some: Column, most: int) -> Column:
        def step(acc: Column, g: Column) -> Column:
            longer = acc["digits"] + F.length(_digits(g))
            more = F.struct(longer.alias("digits"), F.concat(acc["text"], g).alias("text"), F.lit(True).alias("open"))
            stop = F.struct(acc["digits"].alias("digits"), acc["text"].alias("text"), F.lit(False).alias("open"))
            return F.when(acc["open"] & (longer <= most), more.cast(kind)).otherwise(stop.cast(kind))

        first = F.struct(F.lit(0).alias("digits"), F.lit("").alias("text"), F.lit(True).alias("open")).cast(kind)
        return F.aggregate(some, first, step)["text"]

    def proposed(c: Column, parts: Column, places: Column) -> Column:
        def at(place: Column, i: Column) -> Column:
            def one(text: Column) -> Column:
                value = F.regexp_replace(text, r"[^0-9]+$", "")
                start = c["s"] + place
                before = F.when(i == 0, c["before"]).otherwise(F.coalesce(F.regexp_extract(F.get(parts, i - 1), "[0-9]+$", 0), F.lit("")))
                beside = F.when(i == 0, before).otherwise(F.lit("0"))
                after = F.when(start + F.length(value) >= c["e"], c["after"]).otherwise(F.lit("0"))
                return F.struct(start.alias("s"), (start + F.length(value)).alias("e"), value.alias("value"), beside.alias("before"), after.alias("after"))

            some = F.slice(parts, i + 1, 16)
            each = F.transform(F.array_distinct(F.array(run(some, 12), run(some, 16))), one)
            return F.filter(each, lambda m: F.length(_digits(m["value"])).between(7, 16))

        return F.flatten(F.transform(places, at))

    return _let(groups(chain), lambda parts: proposed(chain, parts, _before(F.transform(parts, F.length), _add)))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit counts twice."""
    each = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d, i: F.coalesce(d.try_cast("int"), F.lit(0)) * (1 + i % 2))
    return F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _passes(kind: str, value: Column) -> Column:
    digits = F.length(_digits(value))
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(F.regexp_replace(p, "^0+", "").try_cast("int"), F.when(p.rlike("^0+$"), 0).otherwise(256)) <= 255)
    if kind == "card":
        return digits.between(12, 19) & _luhn(value)
    return digits.between(9, 15) if kind == "phone" else F.lit(True)


def _keeps(kind: str) -> Callable[[Column], Column]:
    return lambda m: _passes(kind, m["value"])


def _bare(kind: int) -> Callable[[Column], Column]:
    return lambda m: F.struct(m["s"].alias("s"), m["e"].alias("e"), F.lit(kind).alias("kind"))


def _judges(kind: int) -> Callable[[Column], Column]:
    return lambda m: _judged(m, F.lit(kind), True)


def is_kind(kind: int) -> Callable[[Column], Column]:
    return lambda x: x["kind"] == kind


def _class(c: Column) -> Column:
    """What stands beside a span: nothing or white space, a letter, a digit, or a mark."""
    return F.when((c == "") | c.rlike(r"\s"), "space").when(c.rlike(r"\p{L}"), "letter").when(c.rlike("[0-9]"), "digit").otherwise("mark")


def _judged(match: Column, kind: Column, base: bool) -> Column:
    """A proposal with its votes (+, - or 0 of each labeler) and features."""
    value, before, after = match["value"], match["before"], match["after"]
    digits = F.length(_digits(value))
    cue = F.lower(before)
    said = {k: cue.rlike(rf"(?:^|[^a-z])(?:{words})[^a-z]{{0,3}}$") for k, words in GAZETTEER.items()}
    by_kind = lambda of: F.element_at(F.array(*(of(k) for k in KINDS)), kind + 1)
    own = by_kind(lambda k: said[k])
    other = by_kind(lambda k: F.array_contains(F.array(*(said[x] for x in KINDS if x != k)), True))
    form = by_kind(lambda k: {"email": F.lit(True), "ip": value.rlike(r"^[0-9]{1,3}(\.[0-9]{1,3}){3}$"), "card": digits.between(15, 16), "phone": digits.between(10, 12) & value.rlike(r"[\x20().-]")}[k])
    check = by_kind(lambda k: F.when(F.lit(k == "card"), F.when(_luhn(value), "+").otherwise("-")).otherwise("0"))
    left, right = _class(F.right(before, F.lit(1))), _class(after)
    votes = F.concat(
        F.lit("+" if base else "-"),
        F.when(own, "+").when(other, "-").otherwise("0"),
        F.when(form, "+").otherwise("-"),
        check,
        F.when(left.isin("letter", "digit") | right.isin("letter", "digit"), "-").otherwise("+"),
    )
    groups = F.size(F.regexp_extract_all(value, F.lit("[0-9]+"), F.lit(0)))
    features = F.array(
        F.concat(F.lit("digits "), F.least(digits, F.lit(20)).cast("string")),
        F.concat(F.lit("groups "), F.least(groups, F.lit(6)).cast("string")),
        F.concat(F.lit("mark "), F.regexp_extract(value, r"([@+(.-])", 1)),
        F.concat(F.lit("left "), left),
        F.concat(F.lit("right "), right),
        F.concat(F.lit("cue "), F.when(own, "own").when(other, "other").otherwise("none")),
        F.concat(F.lit("check "), check),
        F.concat(F.lit("form "), F.when(form, "yes").otherwise("no")),
    )
    return F.struct(match["s"].alias("s"), match["e"].alias("e"), kind.cast("int").alias("kind"), votes.alias("votes"), features.alias("features"))


def proposals(docs: DataFrame, chains: bool = False) -> DataFrame:
    """``row``, the spans of the base (``_base``) and all proposals (``_proposed``), in the order of kinds, of ``row`` and ``_text``.

    With ``chains``, numbers in a row that have over 19 digits together give proposals too (see ``_cut``).
    """
    none = F.array().cast(_MATCH)
    found = docs
    for kind in KINDS:
        hits = F.filter(_matches(F.col("_text"), BASE[kind]), _keeps(kind))
        found = found.withColumn(f"_{kind}", F.coalesce(F.when(F.contains("_text", F.lit(NEEDS[kind])), hits), none))
    low = F.lower("_text")
    spelled = low.contains("at") & low.contains("dot")
    found = found.withColumn("_spelled", F.coalesce(F.when(spelled, _matches(F.col("_text"), WIDE["email"])), none))
    size = lambda m: F.length(_digits(m["value"]))
    numbers = _matches(F.col("_text"), WIDE["number"])
    if chains:
        numbers = F.flatten(F.transform(numbers, lambda m: F.when(size(m) > 19, _cut(m)).when(size(m) >= 7, F.array(m)).otherwise(none)))
    else:
        numbers = F.filter(numbers, lambda m: size(m).between(7, 19))
    found = found.withColumn("_number", F.coalesce(numbers, none))
    base = F.concat(*(F.transform(F.col(f"_{k}"), _bare(i)) for i, k in enumerate(KINDS)))
    found = found.withColumn("_base", base.cast(_SPAN))
    guess = lambda m: F.when(m["value"].rlike(r"^[0-9]+(\.[0-9]+){3}$"), 1).when(F.length(_digits(m["value"])) >= 13, 2).otherwise(3)
    judged = [F.transform(F.col(f"_{k}"), _judges(i)) for i, k in enumerate(KINDS)]
    judged.append(F.transform(_apart(F.col("_spelled"), F.col("_base")), lambda m: _judged(m, F.lit(0), False)))
    judged.append(F.transform(_apart(F.col("_number"), F.col("_base")), lambda m: _judged(m, guess(m), False)))
    found = found.withColumn("_proposed", F.concat(*(j.cast(_PROPOSAL) for j in judged)))
    return found.select("row", "_base", "_proposed")


def fit(found: DataFrame) -> dict[str, float]:
    """Weights of the classifier's features, by kind and name, from all proposals.

    The driver gets counts of vote patterns and sums for features: both are bounded by
    the labelers and the feature classes, not by the documents.
    """
    each = found.select(F.explode("_proposed").alias("p")).select("p.kind", "p.votes", "p.features")
    counts = {(r["kind"], r["votes"]): r["n"] for r in each.groupBy("kind", "votes").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return {}
    posterior = {}
    for kind in range(len(KINDS)):
        own = {v: n for (k, v), n in counts.items() if k == kind}
        majority = {v: 1 / (1 + math.exp(v.count("-") - v.count("+"))) for v in own}
        posterior |= {f"{kind} {v}": p for v, p in weak.posteriors(own, majority)[0].items()}
    chance = F.create_map(*(x for v, p in sorted(posterior.items()) for x in (F.lit(v), F.lit(p))))
    weighed = each.select("kind", F.element_at(chance, F.concat_ws(" ", F.col("kind").cast("string"), "votes")).alias("p"), F.explode(F.concat(F.array(F.lit("all")), "features")).alias("feature"))
    sums = weighed.groupBy("kind", "feature").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")).collect()
    total = {r["kind"]: (r["yes"] + 1, r["no"] + 1) for r in sums if r["feature"] == "all"}
    weights = {}
    for r in sums:
        yes, no = total[r["kind"]]
        weights[f"{r['kind']} {r['feature']}"] = math.log(yes / no) if r["feature"] == "all" else math.log((r["yes"] + 1) / (yes + 20)) - math.log((r["no"] + 1) / (no + 20))
    return weights


def spans(docs: DataFrame, text: str = "text", keep: list[str] | None = None, chains: bool = False) -> DataFrame:
    """``row`` (the columns in ``keep``, else all), ``base`` and ``spans``: arrays of start, end (code points, end exclusive) and the number of the kind, in order.

    ``spans`` holds the base and the proposals that the classifier takes.  The table with
    the proposals is stored, so the texts are searched once; nothing is shuffled but
    counts.  Null texts count as empty; ids, repeated rows and other columns are not
    looked at; an empty table gives no rows.
    """
    whole = docs.select(tucked(docs.select(*(keep or docs.columns))), F.coalesce(docs[text], F.lit("")).alias("_text"))
    found = stored(proposals(whole, chains), "proposals")
    weights = fit(found)
    taken = F.array().cast(_SPAN)
    if weights:
        table = F.create_map(*(x for k, w in sorted(weights.items()) for x in (F.lit(k), F.lit(w))))
        weight = lambda kind, name: F.coalesce(F.element_at(table, F.concat_ws(" ", kind.cast("string"), name)), F.lit(0.0))
        score = lambda p: F.aggregate(p["features"], weight(p["kind"], F.lit("all")), lambda a, f: a + weight(p["kind"], f))
        extra = F.filter("_proposed", lambda p: ~p["votes"].startswith("+") & (score(p) > 0))
        taken = F.transform(extra, lambda p: F.struct(p["s"].alias("s"), p["e"].alias("e"), p["kind"].alias("kind"))).cast(_SPAN)
    order = lambda spans: F.transform(F.array_sort(F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["kind"].alias("kind"), x["e"].alias("e")))), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"), x["kind"].alias("kind")))
    return found.select("row", order(F.col("_base")).alias("base"), order(F.concat("_base", taken)).alias("spans"))


def listed(column: str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.col(column), lambda x: F.concat_ws(":", F.get(names, x["kind"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redacted(docs: DataFrame, text: str = "text", chains: bool = False) -> DataFrame:
    """The documents with each span replaced by its kind in angle brackets; where spans overlap, the first stands for all."""
    found = spans(docs, text, chains=chains)
    body = F.coalesce(F.col(f"row.`{text}`"), F.lit(""))
    names = F.array(*map(F.lit, KINDS))
    piece = lambda x, at: F.when(x["s"] >= at, F.concat(F.substring(body, at + 1, x["s"] - at), F.lit("<"), F.get(names, x["kind"]), F.lit(">")))
    ends = F.transform("spans", lambda x: x["e"])
    pieces = F.array_join(F.zip_with("spans", _before(ends, _most), piece), "")
    walked = F.concat(pieces, F.substring(body, F.array_max(ends) + 1, F.length(body)))
    return untucked(found, docs.columns, **{text: F.when(F.size("spans") > 0, walked).otherwise(F.col(f"row.`{text}`"))})
