r"""Information-theoretic sanitisation of personal data (DataFrame functions only).

*Base spans.* E-mail addresses, IP addresses, card numbers (Luhn) and phone
numbers are found by pattern, leftmost and non-overlapping per kind; matches
that fail their check are dropped. Positions are code points, end exclusive.
The patterns are written so that a search stays linear on long runs: a match
starts where a run starts or where the last match ended, and repeats are
possessive where nothing after them could need them back.

*Protected entities.* Each span names two: its value (address, number) and a
wider one that several values share (the domain of an e-mail address, the
/24 network of an IP address, the issuer digits of a card, the country and
area digits of a phone number), so that values which occur once still have
support.

*Disclosed terms.* Corpus co-occurrence estimates how strongly a term reveals
a protected entity. For entity e and term t, over documents,
PMI(t; e) = log(P(t, e) / (P(t) P(e))) and IC(e) = -log P(e); t occurs with e
when a document that mentions e has t anywhere outside its base spans. P(t)
counts ``SMOOTHING`` of a document more than have t, so the ratio PMI / IC
is just below 1 when t occurs with e only, and the lower the less often t was
seen. A pair counts if its log-likelihood ratio is significant (G^2 of at
least ``SIGNIFICANT``, 0.1 % for one degree of freedom): a word that only one
document has tells of that document's entities once the corpus has some
hundred documents, not before. Terms that reach ``generalise_at`` are
generalised to their class (code with a digit, acronym, capitalised name,
other word), those that reach ``remove_at`` are removed, wherever they stand
in a document that mentions e. Each such occurrence is an added span of kind
``term``; base spans stay. Terms are runs of letters and numbers with at least
one letter, hyphens inside.

*Scale.* The text is read once and written to the shared folder with its
spans and a row number. Words are pre-aggregated in their map tasks. Only
terms rare enough to reach the threshold for the most frequent entity are
looked up in documents with personal data. Entities that the same documents
mention are one class (their number and a 64-bit sum of the documents), and so
are terms that the same documents have: a log of many addresses and unique
words is one pair of classes, not all pairs. Positions are running sums kept
in chunks, and pieces are cut from blocks of the text, so a text costs time in
proportion to its length and its spans, however many they are.

Null text is empty. Documents without matches have zero counts and empty
strings. Rows are joined by their number, so equal rows get equal results and
no key is hot. An empty table gives an empty result. ``sanitise`` keeps all
input columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stored, text_or_empty

KINDS = ("email", "ip", "card", "phone")
_LOCAL = r"[A-Za-z0-9._%+-]"
_HOST = r"[A-Za-z0-9-]"
#: The patterns of the base kinds.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@{_HOST}++(?:\.{_HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must have for a kind to be searched.
HINTS = {"email": r"@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]"}
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
TERM = r"[\p{L}\p{N}]++(?:-[\p{L}\p{N}]++)*+"
GENERALISE_AT, REMOVE_AT = 0.8, 0.95
#: Documents that a term counts besides those that have it, and the least G^2 of a pair (chi-squared, 0.1 %).
SMOOTHING, SIGNIFICANT = 0.25, 10.83
SPAN = "struct<kind:string,start:int,end:int,entity:string,wider:string>"
PLACE = "struct<start:int,end:int,term:string>"
#: Matches in a chunk of a running sum, and characters in a block of a text.
CHUNK, BLOCK = 128, 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def walked(items: Column, out_type: str, step: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """struct<at, out>: a walk over an array that carries a position (from 0) and collects what is not null.

    ``step(at, item)`` gives the next position and a value of ``out_type`` or
    null. Values are appended in chunks, and the chunks to each other, as an
    append copies its array.
    """
    last = F.floor((F.size(items) - 1) / CHUNK).cast("int")
    chunks = F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(items, i * CHUNK + 1, CHUNK))).otherwise(F.array())

    def one(acc: Column, item: Column) -> Column:
        at, out = step(acc["at"], item)
        return F.struct(at.cast("int").alias("at"), let(out.cast(out_type), lambda o: F.when(o.isNotNull(), F.array_append(acc["out"], o)).otherwise(acc["out"])).alias("out"))

    def many(acc: Column, chunk: Column) -> Column:
        start = F.struct(acc["at"].alias("at"), F.array().cast(f"array<{out_type}>").alias("out"))
        return let(F.aggregate(chunk, start, one), lambda r: F.struct(r["at"].alias("at"), F.array_append(acc["out"], r["out"]).alias("out")))

    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<array<{out_type}>>").alias("out"))
    return F.aggregate(chunks, start, many, lambda acc: F.struct(acc["at"].alias("at"), F.flatten(acc["out"]).alias("out")))


def located(text: Column, pattern: str, out_type: str, put: Callable[[Column, Column, Column], Column]) -> Column:
    """array<out_type>: ``put(start, end, match)`` of a pattern's matches that is not null; places come from the pieces between them."""
    between = F.transform(F.split(text, pattern, -1), lambda p: F.length(p))
    zipped = F.arrays_zip(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"), between.alias("before"))
    # the last piece has no match after it
    found = F.filter(zipped, lambda z: z["match"].isNotNull())

    def step(at: Column, z: Column) -> tuple[Column, Column]:
        begin = (at + z["before"]).cast("int")
        end = (begin + F.length(z["match"])).cast("int")
        return end, put(begin, end, z["match"])

    return let(found, lambda f: walked(f, out_type, step)["out"])


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return match.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        return F.length(_digits(match)).between(13, 19) & F.call_function("luhn_check", _digits(match))
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    return F.lit(True)


def _entity(kind: str, match: Column) -> tuple[Column, Column]:
    """The value of a span, and what it shares with others."""
    if kind == "email":
        value, wider = F.lower(match), F.concat(F.lit("@"), F.lower(F.regexp_extract(match, "@(.*)", 1)))
    elif kind == "ip":
        value, wider = match, F.regexp_extract(match, r"^(.*\.)[0-9]+$", 1)
    else:
        value, wider = _digits(match), F.substring(_digits(match), 1, 6 if kind == "card" else 5)
    return F.concat(F.lit(kind + ":"), value), F.concat(F.lit(kind + " group:"), wider)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, entity, wider>> by kind as listed, then start."""

    def of(kind: str) -> Column:
        def put(start: Column, end: Column, match: Column) -> Column:
            entity, wider = _entity(kind, match)
            span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), entity.alias("entity"), wider.alias("wider"))
            return F.when(_valid(kind, match), span)

        return F.when(text.rlike(HINTS[kind]), located(text, PATTERNS[kind], SPAN, put)).otherwise(F.array().cast(f"array<{SPAN}>"))

    return F.concat(*map(of, KINDS))


def shown(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def replaced(text: Column, marks: Column, put: Callable[[Column, Column, Column], Column]) -> Column:
    """The text with each mark (start, end, ...) replaced by ``put(mark, uncovered, covered)``; marks may overlap.

    ``uncovered`` is the number of code points that no earlier mark covers,
    ``covered`` the text of the mark. Pieces are cut from blocks of ``BLOCK`` characters, not from the start of
    the text.
    """
    blocks = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def built(parts: Column) -> Column:
        def cut(begin: Column, length: Column) -> Column:
            first = F.floor(begin / BLOCK).cast("int")
            some = F.slice(parts, first + 1, F.floor((begin + length - 1) / BLOCK).cast("int") - first + 1)
            return F.when(length > 0, F.substring(F.array_join(some, ""), begin - first * BLOCK + 1, length)).otherwise("")

        def step(at: Column, m: Column) -> tuple[Column, Column]:
            begin = F.greatest(m["start"], at)
            return F.greatest(m["end"], at), F.concat(cut(at, begin - at), put(m, F.greatest(m["end"] - begin, F.lit(0)), cut(m["start"], m["end"] - m["start"])))

        whole = let(F.sort_array(marks), lambda ordered: walked(ordered, "string", step))
        return let(whole, lambda w: F.concat(F.array_join(w["out"], ""), cut(w["at"], F.length(text) - w["at"])))

    return let(blocks, built)


def rewritten(text: Column, marks: Column) -> Column:
    """The text with each mark (start, end, put) replaced; without ``put``, by the class of what it covers; nothing for what an earlier mark covers."""
    return replaced(text, marks, lambda m, uncovered, covered: F.when(uncovered < m["end"] - m["start"], "").otherwise(F.coalesce(m["put"], term_class(covered))))


def masked(text: Column, spans: Column) -> Column:
    """The text with every code point of a base span replaced by a space, so that positions stay."""
    marks = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return replaced(text, marks, lambda m, uncovered, _: F.repeat(F.lit(" "), uncovered))


def terms_of(text: Column) -> Column:
    """The distinct terms of a text, lower-cased."""
    found = F.filter(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda t: t.rlike(r"\p{L}"))
    return F.array_distinct(F.transform(found, lambda t: F.lower(t)))


def term_places(text: Column) -> Column:
    """array<struct<start, end, term>>: every occurrence of every term, lower-cased."""

    def put(start: Column, end: Column, match: Column) -> Column:
        return F.when(match.rlike(r"\p{L}"), F.struct(start.alias("start"), end.alias("end"), F.lower(match).alias("term")))

    return located(text, TERM, PLACE, put)


def term_class(term: Column) -> Column:
    """What a term is generalised to: its class by its characters."""
    return (
        F.when(term.rlike(r"\p{N}"), "[CODE]").when(term.rlike(r"^\p{Lu}{2,}$"), "[ACRONYM]").when(term.rlike(r"^\p{Lu}"), "[NAME]").otherwise("[WORD]")
    )


def scan(docs: DataFrame, text_col: str) -> DataFrame:
    """row (its number), doc (the whole input row), spans, rest (the text outside the spans, null without spans): read once, written once."""
    doc = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc")
    rows = docs.select(doc, text_or_empty(text_col).alias("t")).withColumn("spans", base_spans(F.col("t")))
    rest = F.when(F.size("spans") > 0, masked(F.col("t"), F.col("spans"))).alias("rest")
    return stored(rows.select(F.monotonically_increasing_id().alias("row"), "doc", "spans", rest), "privacy_rows")


def g2(both: Column, n_a: Column, n_b: Column, n: Column) -> Column:
    """Log-likelihood ratio of two events over n documents."""

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    cells = part(both, n_a * n_b / n) + part(n_a - both, n_a * (n - n_b) / n) + part(n_b - both, (n - n_a) * n_b / n)
    return 2 * (cells + part(n - n_a - n_b + both, (n - n_a) * (n - n_b) / n))


def disclosed(found: DataFrame, text_col: str, generalise_at: float = GENERALISE_AT, significant: float = SIGNIFICANT) -> DataFrame:
    """row, term, disclosure: the terms of a document whose PMI / IC reaches ``generalise_at`` for one of its entities."""
    number = F.xxhash64("row")
    named = found.where("rest is not null")
    both = F.array_distinct(F.flatten(F.transform("spans", lambda s: F.array(s["entity"], s["wider"]))))
    mentions = named.select("row", F.explode(both).alias("entity"))
    # one class of entities for each set of documents
    entities = stored(mentions.groupBy("entity").agg(F.count("*").alias("n_entity"), F.bit_xor(number).alias("entity_set")), "privacy_entities")
    classes = mentions.join(entities, "entity").select("row", "n_entity", "entity_set").distinct()
    limits = entities.agg(F.max("n_entity").alias("most")).first()
    total = max(found.count(), 1)
    # PMI / IC reaches the threshold for no entity if more documents have the term
    most = (limits["most"] or 0) ** generalise_at * total ** (1 - generalise_at)
    text = F.coalesce("rest", f"doc.`{text_col}`", F.lit(""))
    words = found.select("row", F.explode(terms_of(text)).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"), F.bit_xor(number).alias("term_set"))
    rare = stored(words.where(F.col("n_term") <= most), "privacy_words")
    tokens = stored(named.select("row", F.explode(terms_of(F.col("rest"))).alias("term")).join(rare, "term"), "privacy_terms")
    pairs = tokens.select("row", "n_term", "term_set").distinct().join(classes, "row")
    key = ["n_entity", "entity_set", "n_term", "term_set"]
    n = F.lit(float(total))
    pmi = F.log(F.col("together") * n / ((F.col("n_term") + SMOOTHING) * F.col("n_entity")))
    ratio = F.when(F.col("n_entity") >= n, F.lit(0.0)).otherwise(pmi / F.log(n / F.col("n_entity")))
    scored = pairs.groupBy(*key).agg(F.count("*").alias("together")).withColumn("disclosure", ratio)
    told = scored.where((F.col("disclosure") >= generalise_at) & (g2(F.col("together"), F.col("n_entity"), F.col("n_term"), n) >= significant))
    hits = pairs.join(stored(told.select(*key, "disclosure"), "privacy_told"), key).groupBy("row", "n_term", "term_set").agg(F.max("disclosure").alias("disclosure"))
    return stored(tokens.join(hits, ["row", "n_term", "term_set"]).select("row", "term", "disclosure"), "privacy_hits")


def marked(found: DataFrame, text_col: str, **rule) -> DataFrame:
    """row, added: the places of the disclosing terms of each document that has any, by start."""
    told = disclosed(found, text_col, **rule)
    places = found.where("rest is not null").join(told.select("row").distinct(), "row", "left_semi").select("row", F.explode(term_places(F.col("rest"))).alias("at"))
    each = places.select("row", "at.*").join(told, ["row", "term"]).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "end", "disclosure"))).alias("added"))
    return stored(each, "privacy_marks")


def with_marks(found: DataFrame, text_col: str, **rule) -> DataFrame:
    """The scanned rows and ``added``; rows without personal data have nothing to join."""
    named = found.where("rest is not null").join(marked(found, text_col, **rule), "row", "left")
    return named.unionByName(found.where("rest is null"), allowMissingColumns=True)


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **rule) -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term: a row per document."""
    joined = with_marks(scan(docs.select(id_col, text_col), text_col), text_col, **rule)

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    terms = F.coalesce(F.transform("added", lambda a: F.struct(F.lit("term").alias("kind"), a["start"].alias("start"), a["end"].alias("end"))), F.array().cast("array<struct<kind:string,start:int,end:int>>"))
    base = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return joined.select(
        F.col(f"doc.`{id_col}`").alias(id_col), *map(number, KINDS), F.sha2(shown(F.col("spans")), 256).alias("base_sha256"), shown(F.concat(base, terms)).alias("spans"), F.size(terms).cast("long").alias("n_term")
    )


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = "n_chars", remove_at: float = REMOVE_AT, **rule) -> DataFrame:
    """The input rows with base spans replaced by their kind and disclosed terms generalised or removed.

    Of marks that overlap, the first stands for all. ``length_col``, where the
    input has it, is set to the new text's length in the rows whose text
    changes.
    """
    text = F.col(f"doc.`{text_col}`")
    joined = with_marks(scan(docs, text_col), text_col, **rule)
    base = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("put")))

    def term(a: Column) -> Column:
        return F.struct(a["start"].alias("start"), a["end"].alias("end"), F.when(a["disclosure"] >= remove_at, "").alias("put"))

    terms = F.coalesce(F.transform("added", term), F.array().cast("array<struct<start:int,end:int,put:string>>"))
    marks = F.concat(base, terms)
    new = F.when(F.size(marks) > 0, rewritten(text, marks)).otherwise(text)
    done = joined.withColumn("new", new)
    out = []
    for c in docs.columns:
        value = F.col(f"doc.`{c}`")
        if c == text_col:
            value = F.col("new")
        elif c == length_col:
            value = F.when(F.size("spans") > 0, F.length("new").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return done.select(*out)
