"""PII: spans of personal data, and the terms that disclose them (information-theoretic sanitisation).

Protected entities are the e-mail addresses, IP addresses, card and phone numbers of the texts. How much a term ``t`` in a
document of an entity ``e`` tells about it is estimated from the corpus: ``PMI(t, e) = log2(n_te N / (n_t n_e))`` against
the entity's own information ``IC(e) = log2(N / n_e)``, all counts being whole documents. A term that gives away at least
``GENERALISE`` of that information is replaced by its kind, at least ``REMOVE`` of it is removed, wherever it stands in
the documents that hold the entity. A pair must be seen in ``SUPPORT`` documents: a single meeting is no evidence.

Everything is made of built-in functions. Positions come from a text split at a pattern: the lengths of the gaps and of
the matches add up. The patterns begin where a run of their signs begins, or where the last match ended, and have no
nested repetition over runs, so they are linear and need no deep stack however long a run is. Texts are cut at the edges
of spans in chunks and joined once, so masking takes time in proportion to text and spans. A document gives a row for
each of its distinct terms and each group of its entities (those that stand in the same ``SUPPORT`` or more documents; no
other can disclose or be disclosed); they are counted before they are shuffled. Only documents that hold a disclosing term
are searched for the places of their terms.

Defined results: null texts are empty and have no spans. Repeated rows and missing ids keep a row each; rows with the
same id and text share their spans. Spans are half-open, in code points. Empty tables give empty results. An entity in
every document has no information to give away and discloses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from filedrop.llm.registry import query
from filedrop.llm.text import lower_ascii, table, written

KINDS = ("email", "ip", "card", "phone", "term")
#: Share of an entity's information from which a term is generalised, and from which it is removed.
GENERALISE, REMOVE = 0.8, 0.95
#: Documents in which a term and an entity must have met.
SUPPORT = 2
#: Parts into which the documents of one entity are dealt.
SALTS = 16
#: Items summed in one go (lists grow by copying), and code points of a chunk of text.
BLOCK, CHUNK = 256, 256

_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A chain of digits, single blanks or dashes between them; only chains of 12 to 19 digits are of use.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: Stands for letters and digits within personal data, so that a term that crosses its edge is seen to.
COVER = "\uFFFF"
TERM = rf"[\p{{L}}\p{{N}}{COVER}]+"
PLACEHOLDER = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]"}


def _let(value: Column, body) -> Column:
    """``body(value)``, the value being computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _before(values: Column, combine, zero: int = 0) -> Column:
    """For each item of an int array, ``combine`` over all items before it. Lists grow by copying, so in blocks."""

    def grown(items, last):
        return F.aggregate(items, F.array(F.lit(zero)), lambda out, x: F.concat(out, F.array(combine(F.element_at(out, -1), last(x)))))

    def in_blocks(v):
        last = F.greatest(F.floor((F.size(v) - 1) / BLOCK).cast("int"), F.lit(0))
        return F.transform(F.sequence(F.lit(0), last), lambda b: grown(F.slice(v, b * BLOCK + 1, F.lit(BLOCK)), lambda x: x))

    def joined(blocks):
        firsts = F.slice(grown(blocks, lambda b: F.element_at(b, -1)), F.lit(1), F.size(blocks))
        return F.flatten(F.zip_with(blocks, firsts, lambda b, first: F.transform(
            F.slice(b, F.lit(1), F.size(b) - 1), lambda x: combine(x, first))))

    return _let(_let(values, in_blocks), joined)


def _located(text: Column, pattern: str, name: str = "value") -> Column:
    """``array<struct<start,end,value>>`` of all matches, in code points."""
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    pieces = F.zip_with(values, F.slice(gaps, F.lit(1), F.size(values)), lambda v, g: F.struct(v.alias("v"), g.alias("g")))

    def placed(p):
        firsts = _before(F.transform(p, lambda x: x["g"] + F.length(x["v"])), lambda a, b: a + b)
        return F.zip_with(p, firsts, lambda x, first: F.struct(
            (first + x["g"]).alias("start"), (first + x["g"] + F.length(x["v"])).alias("end"), x["v"].alias(name)))

    return _let(pieces, placed)


def _chunks(text: Column) -> Column:
    """The text in pieces of ``CHUNK`` code points: a part of it is found without walking the text from its start."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))


def _part(chunks: Column, start: Column, end: Column) -> Column:
    """Code points ``start`` to ``end`` of a text in chunks; nothing if the end is not after the start."""
    first = F.floor(start / CHUNK).cast("int")
    near = F.array_join(F.slice(chunks, first + 1, F.floor((end - 1) / CHUNK).cast("int") - first + 1), "")
    return F.when(end > start, F.substring(near, start - first * CHUNK + 1, end - start)).otherwise("")


def _rewritten(text: Column, spans: Column, new) -> Column:
    """``text`` with ``new(span, rest of it)`` for each span of at least one: the pieces are made apart and joined once.

    ``new`` is given the span, the code point from which no span before it covers the text, and the text in chunks.
    """
    def pieces(parts):
        chunks, found = parts["chunks"], parts["spans"]
        reached = _before(F.transform(found, lambda s: s["end"]), F.greatest)
        made = F.zip_with(found, reached, lambda s, at: F.concat(
            _part(chunks, at, s["start"]), F.when(s["end"] > at, new(s, at, chunks)).otherwise("")))
        end = F.array_max(F.transform(found, lambda s: s["end"]))
        return F.concat(F.array_join(made, ""), _part(chunks, end, parts["length"]))

    return _let(F.struct(_chunks(text).alias("chunks"), spans.alias("spans"), F.length(text).alias("length")), pieces)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(value: Column) -> Column:
    digits = F.reverse(_digits(value))
    at = F.sequence(F.lit(1), F.length(digits))

    def add(total, i):
        d = F.substring(digits, i, F.lit(1)).cast("int")
        doubled = F.when(i % 2 == 0, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)
        return total + doubled

    return F.aggregate(at, F.lit(0), add) % 10 == 0


def _accepted(kind: str, found: Column) -> Column:
    if kind == "ip":
        return F.filter(found, lambda s: F.rlike(s["value"], F.lit(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")))
    if kind == "card":
        return F.filter(found, lambda s: _luhn(s["value"]))
    if kind == "phone":
        return F.filter(found, lambda s: F.length(_digits(s["value"])).between(9, 15))
    return found


def with_base_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, _text`` (never null), ``n_<kind>``, ``_base``: spans ``start, rank, end, kind, value`` in order."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("_text"))
    text = F.col("_text")
    # Most texts hold no such sign at all and are not searched.
    might = {"email": F.contains(text, F.lit("@")), "phone": F.contains(text, F.lit("+"))}
    digit = F.rlike(text, F.lit("[0-9]"))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")
    for kind, pattern in PATTERNS.items():
        found = F.when(might.get(kind, digit), _accepted(kind, _located(text, pattern))).otherwise(none)
        docs = docs.withColumn(f"_{kind}", found)
    def of_kind(rank, kind):
        return F.transform(f"_{kind}", lambda s: F.struct(
            s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
            s["value"].alias("value")))

    spans = [of_kind(i, kind) for i, kind in enumerate(PATTERNS)]
    counts = {f"n_{kind}": F.size(f"_{kind}").cast("bigint") for kind in PATTERNS}
    return docs.withColumns(counts | {"_base": F.array_sort(F.concat(*spans))}).drop(*(f"_{k}" for k in PATTERNS))


def _entity(span: Column) -> Column:
    """One spelling per entity: addresses in lower case, numbers as digits."""
    same = F.when(span["kind"].isin("card", "phone"), _digits(span["value"])).otherwise(lower_ascii(span["value"]))
    return F.concat(span["kind"], F.lit(":"), same)


def _bare(base: Column, text: Column) -> Column:
    """The text in lower case, as long as before, with letters and digits of all spans of ``base`` covered."""
    covered = lambda s, at, chunks: F.regexp_replace(
        _part(chunks, F.greatest(s["start"], at), s["end"]), r"[\p{L}\p{N}]", COVER)
    return _rewritten(F.translate(lower_ascii(text), COVER, " "), base, covered)


def _terms(bare: Column) -> Column:
    """Distinct terms that belong to no span."""
    words = F.array_distinct(F.split(bare, rf"[^\p{{L}}\p{{N}}{COVER}]+"))
    return F.filter(words, lambda w: (w != "") & ~F.contains(w, F.lit(COVER)))


def _places(bare: Column) -> Column:
    """``array<struct<start,end,term>>`` of all terms that belong to no span, in code points."""
    return F.filter(_located(bare, TERM, "term"), lambda t: ~F.contains(t["term"], F.lit(COVER)))


def _salted(found: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join; the documents of a hot entity are dealt to ``SALTS`` keys."""
    salts = F.array(*map(F.lit, range(SALTS)))
    salt = F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int")
    return found.withColumn("_salt", salt).join(right.withColumn("_salt", F.explode(salts)), [*on, "_salt"]).drop("_salt")


def _disclosing(found: DataFrame, docs: DataFrame) -> DataFrame:
    """``doc_id, digest, term, share``: terms of a document that give away at least ``GENERALISE`` of one of its entities.

    Entities of the same documents are told by the same terms and count as one: a log of many addresses that was copied
    gives its terms once, not once for each address. Texts wait until the entities of each document are known.
    """
    each = found.select("rid", F.explode(F.array_distinct(F.transform("base", _entity))).alias("entity"))
    mark = lambda seed: F.sum(F.xxhash64(F.lit(seed), "rid").cast("decimal(20,0)"))
    entities = each.groupBy("entity").agg(F.count(F.lit(1)).alias("n_e"), mark(1).alias("m1"), mark(2).alias("m2"))
    n = docs.count()
    entities = entities.filter((F.col("n_e") >= SUPPORT) & (F.col("n_e") < n))
    same = F.md5(F.concat_ws(":", "n_e", "m1", "m2").cast("binary"))
    entities = written(entities.select("entity", "n_e", same.alias("group")), "entities")
    held = _salted(each, entities.select("entity", "group"), ["entity"]).groupBy("rid").agg(F.collect_set("group").alias("groups"))
    meeting = found.select("rid", "doc_id", "digest", "bare").join(held, "rid")
    meeting = written(meeting.select("rid", "doc_id", "digest", "groups", _terms(F.col("bare")).alias("terms")), "meeting")
    meeting = meeting.select("rid", "doc_id", "digest", "groups", F.explode("terms").alias("term"))
    meeting = meeting.select("rid", "doc_id", "digest", "term", F.explode("groups").alias("group"))
    pairs = meeting.groupBy("group", "term").agg(F.count(F.lit(1)).alias("n_te")).filter(F.col("n_te") >= SUPPORT)
    pairs = written(pairs, "pairs")
    # All texts are counted, each part of them before the shuffle.
    words = F.array_distinct(F.split(lower_ascii(F.col("text")), r"[^\p{L}\p{N}]+"))
    counted = docs.select(F.explode(words).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("n_t"))
    terms = written(counted.join(pairs.select("term").distinct(), "term"), "term-counts")
    known = F.log2(F.lit(float(max(n, 1))) / F.col("n_e"))
    told = F.log2(F.col("n_te") * F.lit(float(n)) / (F.col("n_t").cast("double") * F.col("n_e")))
    shares = pairs.join(entities.select("group", "n_e").distinct(), "group").join(terms, "term").filter(known > 0)
    shares = shares.select("group", "term", (told / known).alias("share")).filter(F.col("share") >= GENERALISE)
    told_in = _salted(meeting, written(shares, "disclosing"), ["group", "term"])
    return written(told_in.groupBy("doc_id", "digest", "term").agg(F.max("share").alias("share")), "told")


def find_spans(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns with ``n_<kind>, base, spans``; spans are ``start, rank, end, kind, value, share``.

    ``base`` are the spans of personal data; ``spans`` adds the disclosing terms, whose ``share`` is how much of the
    entity's information they give away. A kept column that is named like a result gives way to it.
    """
    digest = F.md5(F.col("_text").cast("binary"))
    counts = [f"n_{k}" for k in PATTERNS]
    base = with_base_spans(docs)
    found = written(
        base.filter(F.size("_base") > 0).select(
            F.monotonically_increasing_id().alias("rid"), "doc_id", digest.alias("digest"), F.col("_base").alias("base"), *counts,
            _bare(F.col("_base"), F.col("_text")).alias("bare"),
        ), "spans",
    )
    told = _disclosing(found, docs.select("text"))
    once = found.dropDuplicates(["doc_id", "digest"])
    t = told.withColumnsRenamed({c: f"t_{c}" for c in told.columns})
    same = F.col("doc_id").eqNullSafe(F.col("t_id")) & (F.col("digest") == F.col("t_digest"))
    t = t.withColumnRenamed("t_doc_id", "t_id")
    searched = once.select("doc_id", "digest", "bare").join(t.select("t_id", "t_digest"), same, "left_semi")
    places = searched.select("doc_id", "digest", F.inline(_places(F.col("bare"))))
    terms = places.join(t, same & (F.col("term") == F.col("t_term"))).select(
        "doc_id", "digest", "start", "end", "term", F.col("t_share").alias("share"))
    as_span = F.struct("start", F.lit(4).alias("rank"), "end", F.lit("term").alias("kind"), F.col("term").alias("value"), "share")
    terms = terms.groupBy("doc_id", "digest").agg(F.collect_list(as_span).alias("terms"))
    once = once.select("doc_id", "digest", "base", *counts)
    one = once.withColumnRenamed("doc_id", "_id").join(
        terms.withColumnsRenamed({"doc_id": "t_id", "digest": "t_digest"}),
        F.col("_id").eqNullSafe(F.col("t_id")) & (F.col("digest") == F.col("t_digest")), "left",
    )
    plain = F.transform("base", lambda s: F.struct(
        s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"),
        s["value"].alias("value"), F.lit(None).cast("double").alias("share")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string,share:double>>")
    one = written(one.select("_id", F.col("digest").alias("_digest"), "base", *counts, F.array_sort(
        F.concat(plain, F.coalesce("terms", none))).alias("spans")), "all-spans")
    rows = docs.select(F.struct(*keep).alias("_row"), F.md5(F.coalesce("text", F.lit("")).cast("binary")).alias("_own"), F.col("doc_id").alias("_own_id"))
    # Whole rows move once, at any size; a plan that turns to a broadcast for small inputs says nothing about large ones.
    joined = rows.join(one.hint("merge"), F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")), "left")
    no_base = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    named = {*counts, "base", "spans"}
    return joined.select(
        *(F.col("_row")[c].alias(c) for c in keep if c not in named),
        *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts),
        F.coalesce("base", no_base).alias("base"), F.coalesce("spans", none).alias("spans"),
    )


def _replacement(span: Column, original: Column) -> Column:
    """Personal data and generalised terms give way to their kind; terms that disclose nearly all are removed."""
    kind = F.when(F.rlike(original, F.lit(r"^\p{N}+$")), F.lit("[NUMBER]"))
    kind = kind.when(F.rlike(original, F.lit(r"^\p{Lu}")), F.lit("[NAME]")).otherwise(F.lit("[TERM]"))
    out = F.when(span["kind"] == "term", F.when(span["share"] >= REMOVE, F.lit("")).otherwise(kind))
    for name, sign in PLACEHOLDER.items():
        out = out.when(span["kind"] == name, F.lit(sign))
    return out


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with every span of ``text`` generalised or removed. Spans that overlap are covered by the first of them."""
    whole = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_whole"))
    found = find_spans(whole, keep=("_whole",))
    text = F.col("_whole")["text"]
    # What a span before it covers is not replaced once more.
    new = lambda s, at, chunks: F.when(s["start"] < at, "").otherwise(
        _replacement(s, _part(chunks, s["start"], s["end"])))
    clean = _rewritten(text, F.col("spans"), new)
    cleaned = F.when(F.size("spans") > 0, clean).otherwise(text)
    return found.select(*(cleaned.alias(c) if c == "text" else F.col("_whole")[c].alias(c) for c in docs.columns))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat(
        s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))), ",")


@query("op8_disclosure_pii")
def op8(spark, sf_dir):
    found = find_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *(f"n_{k}" for k in PATTERNS),
        F.sha2(_listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )
