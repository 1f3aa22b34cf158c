"""Personal data in texts: patterns, and terms that give protected values away; DataFrame functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanledger.llm.common import texts
from spanledger.session import materialize

KINDS = ("email", "ip", "card", "phone", "general", "removed")
# The base patterns with possessive repeats, which match the same and need no stack for long runs. A run is entered at its start or
# where the last match ended: inside a run that failed no later start can match.
_EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# what a text with a match must hold, found faster
_HOLDS = {"ip": r"[0-9]\.[0-9]", "card": r"(?:[0-9][\x20-]?){13}[0-9]"}
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
_TERM = r"[\p{L}\p{N}]+"


@dataclass(frozen=True)
class DisclosureParams:
    """``window``: terms on either side of a protected value, within ``reach`` characters, which may give it away. ``deviations``: standard
    deviations of the lower confidence bound by which they are judged. ``generalise``/``remove``: shares of a value's information that a
    term may give away. ``broadcast_rows``: larger tables of terms are joined by a shuffle."""

    window: int = 5
    deviations: float = 1.96
    generalise: float = 0.75
    remove: float = 0.9
    broadcast_rows: int = 200_000
    reach: int = 160


def _located(text: Column, pattern: Column, kind: Column | None = None) -> Column:
    """Array of (start, end, value) of all matches: what lies between matches and the matches themselves give the positions in code
    points."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,value:string>>").alias("out"))

    def step(state, pair):
        start = state["at"] + F.length(pair["gap"])
        end = start + F.length(pair["value"])
        span = F.struct(start.alias("start"), end.alias("end"), pair["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda g, v: F.struct(g.alias("gap"), v.alias("value")))
    return F.aggregate(pairs, empty, step, lambda state: state["out"])


_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _of_kind(located: Column, place: int) -> Column:
    return F.transform(
        located, lambda s: F.struct(s["start"].alias("start"), F.lit(place).alias("kind"), s["end"].alias("end"), s["value"].alias("value"))
    )


def _only_valid(located: Column, kind: str) -> Column:
    return F.filter(located, lambda s: _valid(kind, s["value"]))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)

    def step(total, place):
        digit = F.substr(back, place, F.lit(1)).cast("int") * F.when(place % 2 == 0, 2).otherwise(1)
        return total + digit - F.when(digit > 9, 9).otherwise(0)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), step) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        size = F.length(_digits(value))
        return F.when(size.between(14, 19), _luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """Sorted array of (start, place of the kind in ``KINDS``, end, value)."""
    likely = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    every = []
    for place, (kind, pattern) in enumerate(zip(KINDS, (_EMAIL, _IP, _CARD, _PHONE))):
        spans = _of_kind(_only_valid(_located(text, F.lit(pattern)), kind), place)
        maybe = likely[kind] if kind in likely else text.rlike(_HOLDS[kind])
        every.append(F.when(maybe, spans).otherwise(F.array().cast(_SPANS)))
    return F.array_sort(F.concat(*every))


def _spelled(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    one = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")))
    return F.concat_ws(",", one)


def _terms(text: Column) -> Column:
    """Lower-case runs of letters and digits that hold a letter and three characters."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: (F.length(t) >= 3) & t.rlike(r"\p{L}"))


def _entity(span: Column) -> Column:
    """A protected value by kind and spelling: case of e-mail addresses and blanks within numbers do not count."""
    plain = F.when(span["kind"] == 0, F.lower(span["value"])).when(span["kind"] == 1, span["value"]).otherwise(_digits(span["value"]))
    return F.concat(span["kind"].cast("string"), F.lit(":"), plain)


def _surroundings(text: Column, spans: Column, params: DisclosureParams) -> Column:
    """Array of distinct (entity, term): the terms around each base span."""

    def around(span):
        low = F.greatest(F.lit(0), span["start"] - params.reach)
        left = _terms(F.substr(text, low + 1, span["start"] - low))
        # a cut word at the far end is not a term
        left = F.when(low > 0, F.slice(left, 2, 1000)).otherwise(left)
        left = F.slice(left, F.greatest(F.lit(1), F.size(left) - params.window + 1), F.lit(params.window))
        right = _terms(F.substr(text, span["end"] + 1, F.lit(params.reach)))
        cut = F.length(text) > span["end"] + params.reach
        right = F.when(cut, F.slice(right, F.lit(1), F.greatest(F.lit(0), F.size(right) - 1))).otherwise(right)
        near = F.concat(left, F.slice(right, 1, params.window))
        return F.transform(near, lambda t: F.struct(_entity(span).alias("entity"), t.alias("term")))

    return F.array_distinct(F.flatten(F.transform(spans, around)))


def _joined(left: DataFrame, right: DataFrame, key: str, how: str, params: DisclosureParams) -> DataFrame:
    return left.join(F.broadcast(right) if right.count() <= params.broadcast_rows else right, key, how)


def _disclosure(total: int, shared: Column, texts_shared: Column, params: DisclosureParams) -> Column:
    """Share of a value's information that a term gives away, from below; columns entity_docs, term_docs.

    ``shared``: documents that hold both. The bound is Wilson's for p(value | term), where only different texts
    (``texts_shared``) are trials, so that copies of a text do not add confidence.
    """
    bits = -F.log2(F.col("entity_docs") / F.lit(total))
    hits, z = texts_shared.cast("double"), params.deviations
    trials = hits * F.col("term_docs") / shared
    spread = F.sqrt(F.greatest(F.lit(0.0), hits * (trials - hits) / trials) + z * z / 4)
    surely = (hits + z * z / 2 - z * spread) / (trials + z * z)
    return (F.log2(surely) + bits) / bits


def _possible(total: int, params: DisclosureParams) -> Column:
    """The largest disclosure that counts of value and term allow; grows as term_docs falls."""
    return _disclosure(total, F.least("entity_docs", "term_docs"), F.col("entity_texts"), params)


def revealing_terms(found: DataFrame, keyed: DataFrame, params: DisclosureParams) -> tuple[DataFrame, DataFrame]:
    """(terms, uses): term and its largest disclosure; key of a text and term for texts that hold one.

    A term t discloses PMI(t; e) / IC(e) of a value e, with IC(e) = -log2 p(e) and PMI = log2 p(e|t) / p(e), p over whole documents and
    p(e|t) taken at its lower confidence bound. Candidates are the terms that stand near e somewhere, a number in proportion to the
    values; how many documents hold term, value and both comes from all whole texts. The texts in which a term stands near any value
    bound its count from below and its disclosure from above, so terms that fall short already there, as common words do, are not
    counted in all texts; pairs that fall short with the whole counts are not looked up in the texts.
    """
    total = max(1, found.count())
    valued = found.filter(F.size("held") > 0)
    # one row for a value and a text, however many copies the text has
    holders = materialize(
        valued.select("key", F.explode("held").alias("entity")).groupBy("key", "entity").agg(F.count("*").alias("rows")), "value-texts"
    )
    entities = holders.groupBy("entity").agg(F.sum("rows").alias("entity_docs"), F.count("*").alias("entity_texts"))
    near = valued.select(F.explode("near").alias("n")).select("n.*").distinct()
    near_value = (
        valued.select(F.explode(F.array_distinct(F.col("near.term"))).alias("term")).groupBy("term").agg(F.count("*").alias("term_docs"))
    )
    known = near.join(entities, "entity").filter(F.col("entity_docs") < total).join(near_value, "term")
    pairs = materialize(known.filter(_possible(total, params) >= params.generalise).drop("term_docs"), "term-pairs")
    candidates = materialize(pairs.select("term").distinct(), "terms")
    words = keyed.select("key", F.explode(F.array_distinct(_terms(F.col("text")))).alias("term"))
    # counted first, within each task before the shuffle, and joined afterwards: a row per term, not per use
    counts = _joined(words.groupBy("term").agg(F.count("*").alias("term_docs")), candidates, "term", "inner", params)
    likely = materialize(pairs.join(counts, "term").filter(_possible(total, params) >= params.generalise), "likely-pairs")
    rare = materialize(likely.select("term").distinct(), "likely-terms")
    uses = materialize(_joined(words, rare, "term", "inner", params).select("key", "term").distinct(), "term-uses")
    together = (
        _joined(uses, likely.select("term", "entity"), "term", "inner", params).join(holders, ["key", "entity"])
        .groupBy("entity", "term").agg(F.sum("rows").alias("both"), F.count("*").alias("texts"))
    )
    judged = likely.join(together, ["entity", "term"]).withColumn("disclosure", _disclosure(total, F.col("both"), F.col("texts"), params))
    terms = judged.groupBy("term").agg(F.max("disclosure").alias("disclosure")).filter(F.col("disclosure") >= params.generalise)
    terms = materialize(terms, "revealing-terms")
    return terms, _joined(uses, terms.select("term"), "term", "inner", params)


def _added(docs: DataFrame, terms: DataFrame, uses: DataFrame, params: DisclosureParams) -> DataFrame:
    """key, added: spans of revealing terms outside the base spans, for the texts that hold any."""
    held = _joined(uses, terms, "term", "inner", params).groupBy("key").agg(
        F.collect_set(F.when(F.col("disclosure") < params.remove, F.col("term"))).alias("general"),
        F.collect_set(F.when(F.col("disclosure") >= params.remove, F.col("term"))).alias("removed"),
    )
    marked = _joined(docs, materialize(held, "held-terms"), "key", "inner", params)
    every = []
    for name in ("general", "removed"):
        pattern = F.concat(F.lit(r"(?iu)(?<![\p{L}\p{N}])(?:"), F.array_join(name, "|"), F.lit(r")(?![\p{L}\p{N}])"))
        spans = _of_kind(_located(F.col("text"), pattern), KINDS.index(name))
        every.append(F.when(F.size(name) > 0, spans).otherwise(F.array().cast(_SPANS)))
    free = F.filter(
        F.concat(*every), lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    return marked.withColumn("base", base_spans(F.col("text"))).select("key", free.alias("added")).groupBy("key").agg(F.first("added").alias("added"))


def find_private(docs: DataFrame, params: DisclosureParams = DisclosureParams(), id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, key, base and spans (arrays) of every whole text.

    Base spans are personal data by pattern. Terms that surely disclose at least ``remove`` of the information of some protected value are
    added as spans ``removed``, those from ``generalise`` on as spans ``general``, wherever they stand. Null and empty texts have no spans; a null
    id stays null; repeated rows give repeated rows; an empty table gives an empty one; other columns are not read. Texts are
    keyed by their SHA-256, so copies share their added spans. A frequent value or term is counted map-side first.
    """
    keyed = texts(docs, id_col, text_col).withColumn("key", F.sha2("text", 256))
    based = keyed.withColumn("base", base_spans(F.col("text")))
    near = F.when(F.size("base") > 0, _surroundings(F.col("text"), F.col("base"), params))
    held = F.array_distinct(F.transform("base", _entity))
    found = materialize(based.select("doc_id", "key", "base", held.alias("held"), near.alias("near")), "base-spans")
    terms, uses = revealing_terms(found, keyed.select("key", "text"), params)
    added = materialize(_added(keyed.select("key", "text"), terms, uses, params), "added-spans")
    spans = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(_SPANS))))
    return _joined(found.select("doc_id", "key", "base"), added, "key", "left", params).select("doc_id", "key", "base", spans.alias("spans"))


def private_digest(docs: DataFrame, params: DisclosureParams = DisclosureParams()) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans (kind:start:end), n_terms (added spans)."""
    found = find_private(docs, params)

    def count(place: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == place)).cast("long")

    return found.select(
        "doc_id", *[count(k).alias(f"n_{KINDS[k]}") for k in range(4)], F.sha2(_spelled(F.col("base")), 256).alias("base_sha256"),
        _spelled(F.col("spans")).alias("spans"), (F.size("spans") - F.size("base")).cast("long").alias("n_terms"),
    )


def sanitised(docs: DataFrame, params: DisclosureParams = DisclosureParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, text: every text with its spans replaced: base spans by their kind, general terms by what kind of word they are, removed terms
    by nothing. Overlapping spans become one, named after the first. Null and empty texts give empty texts, a null id stays null, repeated
    rows give repeated rows, an empty table gives an empty one; other columns are not read."""
    spans = find_private(docs, params, id_col, text_col).select("key", "spans").groupBy("key").agg(F.first("spans").alias("spans"))
    keyed = texts(docs, id_col, text_col).withColumn("key", F.sha2("text", 256))
    some = materialize(spans.filter(F.size("spans") > 0), "all-spans")
    marks = F.array(*[F.lit(f"[{k}]") for k in KINDS[:4]])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, span):
        word = F.when(span["value"].rlike("^[0-9]"), "[number]").when(span["value"].rlike(r"^\p{Lu}"), "[name]").otherwise("[term]")
        mark = F.when(span["kind"] < 4, F.get(marks, span["kind"])).when(span["kind"] == 4, word).otherwise("")
        gap = F.substr(F.col("text"), state["at"] + 1, span["start"] - state["at"])
        new = F.struct(span["end"].alias("at"), F.concat(state["out"], gap, mark).alias("out"))
        inside = F.struct(F.greatest(state["at"], span["end"]).alias("at"), state["out"].alias("out"))
        return F.when(span["start"] < state["at"], inside).otherwise(new)

    clean = F.aggregate("spans", start, step, lambda s: F.concat(s["out"], F.substr(F.col("text"), s["at"] + 1)))
    joined = _joined(keyed, some, "key", "left", params)
    return joined.select("doc_id", F.when(F.col("spans").isNull(), F.col("text")).otherwise(clean).alias("text"))
