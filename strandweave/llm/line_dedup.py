"""Line deduplication by a log-template tree.

A line's path in the tree has a fixed depth: its number of tokens, then its first ``depth`` tokens; digits
anywhere in a token are a variable field. Within a leaf the most frequent line (earliest on ties) is a template;
lines of which at least ``similarity`` of the tokens equal it, position by position, join it, so other fields
that vary are generalised too. The most frequent of the lines left is the next template, and so on until every
line has one. A template that occurs in more than one document is dropped from all but the first document
(smallest id) that holds it.

Lines move between tasks as 64-bit hashes and a sketch of one character a token, in which unlike tokens look
equal once in 94; lines that the sketch cannot tell apart are fetched again from a document that holds them,
and 64-bit hashes of their tokens decide. Two lines alike enough differ
in so few tokens that one of a fixed number of stretches is equal in both: only lines that share a stretch with
another of their leaf are compared. The first templates of all leaves are taken round by round; what they leave
is compared pairwise within the stretches, and templates are then the lines that no template before them is like.
All native; copies of a line are combined before any shuffle of their statistics.

Lines of fewer than ``min_tokens`` tokens and blank ones are always kept. Null or empty texts have
no lines to drop and stay as they are. Rows with a null id count as one document, smaller than all others;
rows that repeat an id are the same document, and each is filtered alike. Empty tables give empty results.
All other columns pass through under their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import let
from strandweave.plans.cut import cut, release

#: Templates of a leaf that are taken one after another before the lines left are compared pairwise.
ROUNDS = 3


def normal(text: Column) -> Column:
    """One space between the tokens of a line, runs of digits as variable fields, lines as they are."""
    odd = text.contains("  ")
    for space in "\t\r\v\f":
        odd = odd | text.contains(space)
    # most texts have nothing to replace, and a plain search tells so sooner than a pattern
    spaced = F.when(odd, F.regexp_replace(text, r"\x20*[\x09\x0B-\x0D][\x20\x09\x0B-\x0D]*|\x20{2,}", " ")).otherwise(text)
    return F.when(spaced.rlike("[0-9]"), F.regexp_replace(spaced, "[0-9]+", "<*>")).otherwise(spaced)


def _tokens(form: Column) -> Column:
    return F.split(form, " ")


def _sketch(form: Column) -> Column:
    return F.array_join(F.transform(_tokens(form), lambda t: F.char(F.lit(33) + F.pmod(F.hash(t), F.lit(94)))), "")


def _forms(texts: DataFrame, min_tokens: int) -> DataFrame:
    """(k, line, form) of each line of (k, text) that is long enough; form is the normal text."""
    forms = texts.select("k", F.explode(F.split(normal(F.col("text")), "\n")).alias("form")).select("k", F.trim("form").alias("form")).where("form <> ''")
    if min_tokens > 1:
        forms = forms.where(_size(F.col("form")) >= min_tokens)
    return forms.select("k", F.xxhash64("form").alias("line"), "form")


def _size(form: Column) -> Column:
    """Tokens of a normal line that is not empty."""
    return F.length(form) - F.length(F.replace(form, F.lit(" "), F.lit(""))) + 1


def _stretches(tokens: Column, leaf: Column, depth: int, similarity: float) -> Column:
    """Keys of the stretches that the tokens after the first ``depth`` are split into: one more than may differ,
    so two lines of a leaf that are alike enough agree in one at least."""

    def keys(t: Column) -> Column:
        m = F.size(t)
        rest, parts = F.greatest(m - depth, F.lit(0)), m - F.ceil(similarity * m).cast("int") + 1
        edge = lambda i: F.floor(i * rest / parts).cast("int")
        return F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.xxhash64(leaf, i, F.slice(t, edge(i) + depth + 1, edge(i + 1) - edge(i))))

    return let(tokens, keys)


def _alike(a: str, b: str, similarity: float) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)) >= similarity * F.size(a)


def _templates(lines: DataFrame, depth: int, similarity: float) -> DataFrame:
    """(leaf, line, model): the template that each of ``lines`` (leaf, line, n, first, tokens) joins, itself if none."""
    order = lambda side="": F.struct(F.col(f"n{side}"), (F.lit(-1) - F.col(f"first{side}")).alias("first"), F.col(f"line{side}"))
    found, left = None, lines
    for _ in range(ROUNDS):
        best = left.groupBy("leaf").agg(F.max_by(F.struct(F.col("line").alias("model"), F.col("tokens").alias("body")), order()).alias("m")).select("leaf", "m.*")
        tried = cut(left.join(best, "leaf").withColumn("joins", _alike("tokens", "body", similarity)), "tried")
        took = tried.where("joins").select("leaf", "line", "model")
        found = took if found is None else found.unionByName(took)
        left = tried.where("NOT joins").drop("model", "body", "joins")
        if left.isEmpty():
            return found
    keyed = left.withColumn("key", F.explode(_stretches(F.col("tokens"), F.col("leaf"), depth, similarity)))
    other = keyed.select("key", *[F.col(c).alias(f"{c}_2") for c in left.columns])
    apart = keyed.join(other, "key").where((order() > order("_2")) & (F.col("leaf") == F.col("leaf_2")) & _alike("tokens", "tokens_2", similarity))
    pairs = cut(apart.select("leaf", "line", order().alias("rank"), F.col("line_2").alias("later")).distinct(), "pairs")
    while not pairs.isEmpty():
        # lines that no line still open comes before are templates; all that are like one of them are settled
        heads = pairs.select("leaf", "line").distinct().join(pairs.select("leaf", F.col("later").alias("line")), ["leaf", "line"], "left_anti")
        took = cut(pairs.join(heads, ["leaf", "line"], "left_semi").groupBy("leaf", "later").agg(F.max_by("line", "rank").alias("model")).withColumnRenamed("later", "line"), "took")
        found = found.unionByName(took)
        settled = took.select("leaf", "line")
        rest = pairs.join(heads, ["leaf", "line"], "left_anti").join(settled, ["leaf", "line"], "left_anti")
        pairs = cut(rest.join(settled.withColumnRenamed("line", "later"), ["leaf", "later"], "left_anti").select(*pairs.columns), "pairs")
    return found


def _texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return docs.select(F.coalesce(docs[f"`{id_col}`"].cast("long"), F.lit(-(1 << 63))).alias("k"), docs[f"`{text_col}`"].alias("text"), *more)


def recurring_lines(docs: DataFrame, depth: int = 4, similarity: float = 0.8, min_tokens: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, lines): for each document key the hashes of the lines that go."""
    texts = _texts(docs, id_col, text_col)
    met = _forms(texts, min_tokens)
    sketched = met.select("k", F.xxhash64(_size(F.col("form")), F.substring_index("form", " ", depth)).alias("leaf"), "line", _sketch(F.col("form")).alias("sketch"))
    forms = cut(sketched.groupBy("leaf", "line").agg(F.count("*").alias("n"), F.min("k").alias("first"), F.max("k").alias("last"), F.any_value("sketch").alias("sketch")), "forms")
    # leaves whose lines differ: their tokens decide which lines share a template
    mixed = cut(forms.groupBy("leaf").agg(F.count("*").alias("forms"), F.min("first").alias("lo"), F.max("last").alias("hi")).where("forms > 1 AND lo <> hi").select("leaf"), "mixed")
    rivals = cut(forms.join(mixed, "leaf").select("leaf", "line", "n", "first", "sketch"), "rivals")
    keyed = cut(rivals.select("line", F.explode(_stretches(F.split("sketch", ""), F.col("leaf"), depth, similarity)).alias("key")), "keyed")
    shared = keyed.groupBy("key").agg(F.count("*").alias("lines")).where("lines > 1").select("key")
    near = cut(rivals.drop("sketch").join(keyed.join(shared, "key").select("line").distinct(), "line", "left_semi"), "near")
    holders = cut(near.select(F.col("first").alias("k")).distinct(), "holders")
    held = _forms(texts.join(holders, "k", "left_semi"), min_tokens).join(near.select("line"), "line", "left_semi").groupBy("line").agg(F.any_value("form").alias("form"))
    hashes = F.transform(_tokens(F.col("form")), lambda t: F.xxhash64(t))
    open_lines = cut(near.join(held, "line").withColumn("tokens", hashes).drop("form"), "tokens")
    members = _templates(open_lines, depth, similarity)
    named = cut(forms.drop("sketch").join(members, ["leaf", "line"], "left").withColumn("template", F.coalesce("model", "line")).drop("model"), "templates")
    often = named.groupBy("leaf", "template").agg(F.min("first").alias("keeper"), F.max("last").alias("last")).where("keeper <> last")
    gone = cut(named.join(often.drop("last"), ["leaf", "template"]).select("line", "keeper"), "gone")
    release(forms, mixed, rivals, keyed, near, holders, open_lines, named)
    return met.select("k", "line").join(gone, "line").where("k <> keeper").groupBy("k").agg(F.collect_set("line").alias("lines"))


def line_dedup(docs: DataFrame, depth: int = 4, similarity: float = 0.8, min_tokens: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the text filtered, plus n_lines and n_dropped (replaced if ``docs`` has such columns)."""
    added = ("n_lines", "n_dropped")
    others = [c for c in docs.columns if c not in added]
    gone = recurring_lines(docs, depth, similarity, min_tokens, id_col, text_col)
    rows = _texts(docs, id_col, text_col, F.struct(*[docs[f"`{c}`"] for c in others if c != text_col], F.lit(1).alias("any")).alias("others"))
    joined = rows.join(gone.withColumnRenamed("lines", "gone"), "k", "left")
    text, lines = F.col("text"), F.split("text", "\n")
    # a blank line is never among those that go
    goes = lambda form: F.array_contains("gone", F.xxhash64(F.trim(form)))
    verdicts = F.zip_with(lines, F.split(normal(text), "\n"), lambda raw, form: F.when(~goes(form), raw))
    left = F.when(F.col("gone").isNull(), lines).otherwise(F.filter(verdicts, lambda x: x.isNotNull()))
    judged = joined.select("gone", "text", "others", left.alias("left"))
    n_lines, n_left = F.when(text.isNull(), 0).otherwise(F.size(lines)).cast("long"), F.when(text.isNull(), 0).otherwise(F.size("left")).cast("long")
    kept = {text_col: F.when(F.col("gone").isNull(), text).otherwise(F.array_join("left", "\n"))}
    return judged.select(*[kept.get(c, F.col(f"others.`{c}`")).alias(c) for c in others], n_lines.alias("n_lines"), (n_lines - n_left).alias("n_dropped"))
