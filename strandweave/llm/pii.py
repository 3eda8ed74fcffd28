"""Personal data: base patterns, then information-theoretic sanitisation of the terms that give it away.

Base spans are the leftmost non-overlapping matches of four patterns. The method protects a fifth kind besides,
``secret``: runs of twenty characters or more that mix letters and digits and whose characters hold at least
three bits each, as keys and tokens do. It then asks which terms disclose that such an entity is there. A term is
a run of letters, digits or characters beyond ASCII outside of all entities, A-Z lower-cased. With documents as
the unit of all counts, p the share of a term's documents in which it stands within five terms of an entity of
kind e, and IC(e) = -log2 P(e) the information of the entity, PMI(t; e) = IC(e) + log2 p. Chance is kept out by
taking for p the lower end of its Wilson interval at ``z`` standard deviations, so that no support has to be set:
the fewer documents a term is in, the less it is believed. A term is disclosing if PMI / IC reaches
``threshold`` (1: it never stands elsewhere), and then all its places in all texts become spans of kind
``term``. :func:`sanitised` generalises entities and terms to their kind or removes them.

All native. Only documents with entities are exploded to the few terms around them; the corpus counts of terms
are summed map-side before they meet the candidates, so frequent terms stay one row a task; texts meet the
disclosing terms by an equi-join of their distinct terms. No pattern can backtrack over a run: repeated groups
are possessive and start only where a run starts. Work within a text grows in proportion to it: places come from
scans in runs, texts are cut up once.

A null text is empty: no spans. A null id is kept. Repeated rows give repeated rows and count each. Empty
tables give empty results; columns besides the id and the text are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import TERM, let, lower_ascii, terms, whole_text
from strandweave.plans.cut import cut, release

KINDS = ("email", "ip", "card", "phone")
#: Each pattern finds what the plain one finds: possessive where nothing could be given back, and begun only
#: at a run's start or where the last match ended, since later starts within a run fail as its start does.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "secret": r"(?<![A-Za-z0-9_+=-])[A-Za-z0-9_+=-]{20,}+",
}
PART = r"^(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.|$)){4}$"
#: Terms on either side of an entity that count as near it.
NEAR = 5
#: Bits that each character of a secret holds at least, by the frequencies of its own characters.
BITS = 3.0
#: Characters of a text that are cut out at a time, and values of a scan that share an array.
CHUNK, STEP = 8192, 64


def scanned(values: Column, add: Callable[[Column, Column], Column]) -> Column:
    """What ``add`` makes of all values (int, from 0) before each. An array that grows is copied each time, so values
    are folded in runs of ``STEP``, then the runs' results, then each run from where it starts."""

    def folded(part: Column, start: Column) -> Column:
        return F.aggregate(part, F.array(start), lambda acc, x: F.concat(acc, F.array(add(F.element_at(acc, -1), x))))

    def joined(runs: Column) -> Column:
        starts = folded(F.transform(runs, lambda r: F.aggregate(r, F.lit(0), add)), F.lit(0))
        return F.flatten(F.zip_with(runs, F.slice(starts, 1, F.size(runs)), lambda r, start: F.slice(folded(r, start), 1, F.size(r))))

    def cut_up(v: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), (F.greatest(F.size(v) - 1, F.lit(0)) / STEP).cast("int")), lambda c: F.slice(v, c * STEP + 1, F.lit(STEP)))

    return let(values, lambda v: let(cut_up(v), joined))


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, -i, F.lit(1)).cast("int")
        twice = d * 2
        return total + F.when(i % 2 == 1, d).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _bits(match: Column) -> Column:
    """Shannon's entropy of the characters."""
    n = F.length(match)
    share = lambda c: (n - F.length(F.replace(match, c, F.lit("")))) / n
    return F.aggregate(F.array_distinct(F.split(match, "")), F.lit(0.0), lambda acc, c: F.when(c == "", acc).otherwise(acc - share(c) * F.log2(share(c))))


def _sound(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(PART)
    if kind == "phone":
        return F.length(_digits(match)).between(9, 15)
    if kind == "secret":
        return match.rlike("[0-9].*[0-9].*[0-9]") & match.rlike("[A-Za-z].*[A-Za-z].*[A-Za-z]") & (F.round(_bits(match), 9) >= BITS)
    return let(_digits(match), lambda d: F.when(F.length(d).between(13, 19), _luhn(d)).otherwise(F.lit(False)))


def _spans(kind: str, text: Column) -> Column:
    """Sound matches as (kind, start, end): the text between matches gives each one's place."""
    pattern = PATTERNS[kind]

    def place(found: Column) -> Column:
        gaps = F.slice(F.split(text, pattern, -1), 1, F.size(found))
        return let(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), _sound(kind, m).alias("sound"))), placed)

    def placed(both: Column) -> Column:
        def span(x: Column, before: Column) -> Column:
            start = before + x["gap"]
            return F.when(x["sound"], F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + x["size"]).alias("end")))

        before = scanned(F.transform(both, lambda x: x["gap"] + x["size"]), lambda n, x: n + x)
        return F.filter(F.zip_with(both, before, span), lambda s: s.isNotNull())

    none = F.expr("array()").cast("array<struct<kind:string,start:int,end:int>>")
    hint = {"email": text.contains("@"), "phone": text.contains("+")}.get(kind, text.rlike("[0-9]"))
    return F.when(hint, let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda m: F.when(F.size(m) > 0, place(m)).otherwise(none))).otherwise(none)


def found_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark (hash of the text, which tells texts of one id apart), text, base (spans by kind as listed, then start), secrets."""
    rows = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.select("doc_id", F.xxhash64("text").alias("mark"), "text", F.concat(*[_spans(kind, F.col("text")) for kind in KINDS]).alias("base"), _spans("secret", F.col("text")).alias("secrets"))


def _merged(spans: Column) -> Column:
    """Places of (kind, start, end) in order, overlapping ones as one with all their kinds, by start."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    def places(own: Column) -> Column:
        return let(scanned(F.transform(own, lambda s: s["end"]), lambda n, x: F.greatest(n, x)), lambda before: let(heads(own, before), lambda h: F.transform(h, lambda at, i: place(own, before, at, F.coalesce(F.get(h, i + 1), F.size(own))))))

    def heads(own: Column, before: Column) -> Column:
        """Where a span starts at or after the end of all before it."""
        return F.filter(F.transform(own, lambda s, i: F.when(s["start"] >= F.get(before, i), i)), lambda i: i.isNotNull())

    def place(own: Column, before: Column, at: Column, following: Column) -> Column:
        end = F.when(following < F.size(own), F.get(before, following)).otherwise(F.greatest(F.get(before, following - 1), F.get(own, following - 1)["end"]))
        return F.struct(F.get(own, at)["start"].alias("start"), end.alias("end"), F.transform(F.slice(own, at + 1, following - at), lambda s: s["kind"]).alias("kinds"))

    return let(ordered, places)


def _entities() -> Column:
    return _merged(F.concat("base", "secrets"))


def _pieces(text: Column, places: Column) -> Column:
    """What stands before, between and after the entities, as (at, text). The text is cut into chunks first, so that
    no piece is looked for from the text's start."""
    n = F.length(text)

    def cut_out(chunks: Column, start: Column, end: Column) -> Column:
        def part(c: Column) -> Column:
            chunk = F.get(chunks, c)
            low, high = F.greatest(start - c * CHUNK, F.lit(0)), F.least(end - c * CHUNK, F.lit(CHUNK))
            return F.when((low == 0) & (high == CHUNK), chunk).otherwise(F.substring(chunk, low + 1, high - low))

        every = F.sequence((start / CHUNK).cast("int"), ((end - 1) / CHUNK).cast("int"))
        return F.when(end > start, F.array_join(F.transform(every, part), "")).otherwise(F.lit(""))

    def piece(chunks: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(places, i - 1)["end"])
        end = F.coalesce(F.get(places, i)["start"], n)
        return F.struct(start.alias("at"), cut_out(chunks, start, end).alias("text"))

    chunked = F.transform(F.sequence(F.lit(0), (F.greatest(n - 1, F.lit(0)) / CHUNK).cast("int")), lambda c: F.substring(text, c * CHUNK + 1, F.lit(CHUNK)))
    return let(chunked, lambda chunks: F.transform(F.sequence(F.lit(0), F.size(places)), lambda i: piece(chunks, i)))


def _own_terms() -> Column:
    """A text's terms in order, those of its entities left out: one array a piece."""
    whole = F.array(terms(lower_ascii(F.col("text"))))
    parts = lambda low: let(_entities(), lambda places: F.transform(_pieces(low, places), lambda p: terms(p["text"])))
    return F.when(F.size("base") + F.size("secrets") == 0, whole).otherwise(let(lower_ascii(F.col("text")), parts))


def _surroundings(found: DataFrame) -> DataFrame:
    """(kind, term) of the terms near each document's entities, once a document."""
    parts = found.select(_entities().alias("places"), _own_terms().alias("parts"))
    flat = parts.select("places", F.flatten("parts").alias("terms"), scanned(F.transform("parts", lambda p: F.size(p)), lambda n, x: n + x).alias("before"))

    def near(place: Column, i: Column) -> Column:
        n = F.get("before", i + 1)  # terms before the entity
        first = F.greatest(n - NEAR, F.lit(0))
        return F.flatten(F.transform(F.array_distinct(place["kinds"]), lambda k: F.transform(F.slice("terms", first + 1, n - first + NEAR), lambda t: F.concat_ws(" ", k, t))))

    # as one string each: equal ones are found by hashing then; neither kinds nor terms hold spaces
    each = flat.select(F.explode(F.array_distinct(F.flatten(F.transform("places", near)))).alias("e"))
    return each.select(F.substring_index("e", " ", 1).alias("kind"), F.substring_index("e", " ", -1).alias("term"))


def disclosing_terms(found: DataFrame, threshold: float, z: float) -> DataFrame:
    """(kind, term, ratio) of the terms of ``found`` whose co-occurrence reaches the threshold."""
    private = cut(found.where(F.size("base") + F.size("secrets") > 0), "private")
    joint = cut(_surroundings(private).groupBy("kind", "term").agg(F.count("*").alias("n_joint")), "joint")
    entities = cut(private.select(F.explode(F.array_distinct(F.transform(F.concat("base", "secrets"), lambda s: s["kind"]))).alias("kind")).groupBy("kind").agg(F.count("*").alias("n_kind")), "kinds")
    seen = found.select(F.explode(F.array_distinct(F.flatten(_own_terms()))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    total = found.agg(F.count("*").alias("n"))
    share = F.expr(f"(double(n_joint) / n_term + {z * z} / (2.0D * n_term) - {z} * sqrt(double(n_joint) * (n_term - n_joint) / (double(n_term) * n_term * n_term) + {z * z} / (4.0D * n_term * n_term))) / (1 + {z * z} / n_term)")
    information = F.log2(F.expr("double(n) / n_kind"))
    # at most five kinds, and one total
    rated = joint.join(seen, "term").join(F.broadcast(entities), "kind").crossJoin(F.broadcast(total)).select("kind", "term", F.when(information > 0, 1 + F.log2(share) / information).otherwise(F.lit(0.0)).alias("ratio"))
    said = cut(rated.where(F.col("ratio") >= threshold), "disclosing")
    release(private, joint, entities)
    return said


def _placed(hits: Column) -> Column:
    """Where the terms of ``hits`` stand in the text, entities left out."""

    def places(piece: Column) -> Column:
        def within(found: Column) -> Column:
            gaps = F.slice(F.split(piece["text"], TERM, -1), 1, F.size(found))
            return let(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("size"), F.array_contains(hits, m).alias("hit"))), spans)

        def spans(both: Column) -> Column:
            def span(x: Column, before: Column) -> Column:
                start = piece["at"] + before + x["gap"]
                return F.when(x["hit"], F.struct(F.lit("term").alias("kind"), start.alias("start"), (start + x["size"]).alias("end")))

            before = scanned(F.transform(both, lambda x: x["gap"] + x["size"]), lambda n, x: n + x)
            return F.filter(F.zip_with(both, before, span), lambda s: s.isNotNull())

        return let(F.regexp_extract_all(piece["text"], F.lit(TERM), F.lit(0)), within)

    return let(lower_ascii(F.col("text")), lambda low: F.flatten(F.transform(let(_entities(), lambda e: _pieces(low, e)), places)))


def personal_data(docs: DataFrame, threshold: float = 0.8, z: float = 3.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, mark, base (spans), extra (the method's spans): one row a document."""
    every = found_spans(docs, id_col, text_col)
    said = disclosing_terms(every, threshold, z).select("term").distinct()
    if said.isEmpty():
        return every.select("doc_id", "mark", "base", F.col("secrets").alias("extra"))
    met = every.select("doc_id", "mark", F.explode(F.array_distinct(F.flatten(_own_terms()))).alias("term")).join(said, "term")
    hits = cut(met.groupBy(F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).agg(F.collect_set("term").alias("hits")), "hits")
    joined = every.join(hits, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("mark") == F.col("__mark")), "left")
    return joined.select("doc_id", "mark", "base", F.when(F.col("hits").isNull(), F.col("secrets")).otherwise(F.concat("secrets", _placed(F.col("hits")))).alias("extra"))


def digest(found: DataFrame) -> DataFrame:
    """Counts, the hash of the base spans and all spans as text."""
    spelt = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda spans, kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id",
        *[count("base", kind) for kind in KINDS],
        F.sha2(spelt(F.col("base")), 256).alias("base_sha256"),
        spelt(F.concat("base", "extra")).alias("spans"),
        count("extra", "secret"),
        count("extra", "term"),
        F.size(F.concat("base", "extra")).cast("long").alias("n_spans"),
    )


def sanitised(docs: DataFrame, found: DataFrame, mode: str = "generalise", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with entities and disclosing terms replaced by ``<kind>`` or, with mode ``remove``, cut out."""
    cuts = found.where(F.size("base") + F.size("extra") > 0).select(F.col("doc_id").alias("cut_id"), F.col("mark").alias("cut_mark"), _merged(F.concat("base", "extra")).alias("cuts")).distinct()
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs[f"`{id_col}`"].alias("id"), docs[f"`{text_col}`"].alias("text"))
    joined = rows.join(cuts, F.col("id").eqNullSafe(F.col("cut_id")) & (F.xxhash64(whole_text("text")) == F.col("cut_mark")), "left")
    # of entities that overlap the first names the place
    word = lambda place: F.concat(F.lit("<"), F.get(place["kinds"], F.lit(0)), F.lit(">")) if mode == "generalise" else F.lit("")
    spelt = F.zip_with(_pieces(F.col("text"), F.col("cuts")), F.col("cuts"), lambda p, c: F.concat(p["text"], F.when(c.isNull(), F.lit("")).otherwise(word(c))))
    kept = {text_col: F.when(F.col("cuts").isNull(), F.col("text")).otherwise(F.array_join(spelt, ""))}
    return joined.select(*[kept.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
