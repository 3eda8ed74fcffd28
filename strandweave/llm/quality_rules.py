"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document; its failure is one bit of ``bits`` and the measurements behind
it stay beside it. A policy is a named, versioned set of rules: applying one is a bitwise AND over the
ledger, and its ablations (what each rule rejects, and what it alone rejects) are one bitwise aggregation.
Everything is native column expressions over whole texts; a row never leaves its partition.

Nulls, empty texts: a null text is an empty one (no words, fails ``few_words``). A null id is kept as it is.
Repeated rows give repeated rows; an empty table gives an empty ledger. Columns other than the id and the
text are ignored, so they may have any name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from strandweave.llm.common import NOT_SPACE, SPACE, let, whole_text, words
from strandweave.plans.cut import cut

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    name: str
    fails: str  # SQL over the measurements


#: The order fixes each rule's bit; append only, so that stored ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 14 * n_words"),
    Rule("capitals", "2 * n_capitals > word_chars"),
    Rule("exclamations", "10 * n_exclamations > 3 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 5 * n_lines"),
    Rule("stutter", "10 * n_stutters > 3 * n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}

#: Policies by version: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "capitals"),
    "v2": tuple(rule.name for rule in RULES),
}


def mask(policy: str | tuple[str, ...]) -> int:
    return sum(BIT[name] for name in (POLICIES[policy] if isinstance(policy, str) else policy))


def _repeated(tokens: Column) -> Column:
    """Words that lie in some window of eight words found at least twice.

    Window hashes come from three pairings of neighbours (2, 4, 8 words), so their cost does not depend on
    the window. Texts without a repeat, the usual case, stop at the distinct count; else the repeated
    windows' positions are merged in order.
    """

    def pair(h: Column, step: int) -> Column:
        return F.zip_with(h, F.slice(h, step + 1, F.greatest(F.size(h) - step, F.lit(0))), lambda a, b: F.xxhash64(a, b))

    def covered(h: Column) -> Column:
        ranked = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def twice(s: Column) -> Column:
            same = lambda e, j: F.coalesce(F.get(s, j)["h"] == e["h"], F.lit(False))
            return F.filter(s, lambda e, i: same(e, i - 1) | same(e, i + 1))

        at = F.sort_array(F.transform(let(ranked, twice), lambda e: e["i"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
        step = lambda acc, p: F.struct((acc["n"] + p + WINDOW - F.greatest(p, acc["end"])).alias("n"), (p + WINDOW).alias("end"))
        return F.aggregate(at, start, step, lambda acc: acc["n"])

    single = F.transform(tokens, lambda w: F.xxhash64(w))
    windows = let(single, lambda a: let(pair(a, 1), lambda b: let(pair(b, 2), lambda c: F.slice(pair(c, 4), 1, F.size(c) - WINDOW + 1))))
    counted = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))
    return F.when(F.size(tokens) < WINDOW + 1, F.lit(0)).otherwise(counted)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and the measurements of each row's whole text."""
    text = F.col("__text")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(NOT_SPACE))
    by_words = lambda w: F.struct(F.size(w).alias("n_words"), _repeated(w).alias("n_repeat_words"), F.size(F.filter(w, lambda x, i: F.get(w, i - 1) == x)).alias("n_stutters"))
    by_lines = lambda x: F.struct(F.size(x).alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines"))
    return docs.select(F.col(id_col), whole_text(text_col).alias("__text")).select(
        id_col,
        let(words(text), by_words).alias("w"),
        let(lines, by_lines).alias("l"),
        F.length(F.regexp_replace(text, SPACE, "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace(text, r"[^!]+", "")).cast("long").alias("n_exclamations"),
    ).select(
        id_col,
        F.col("w.n_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("l.n_dup_lines").cast("long").alias("n_dup_lines"),
        F.col("w.n_repeat_words").cast("long").alias("n_repeat_words"),
        F.col("l.n_lines").cast("long").alias("n_lines"),
        "n_capitals",
        "n_exclamations",
        F.col("w.n_stutters").cast("long").alias("n_stutters"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``bits``: one bit for each rule of :data:`RULES` that the document fails."""
    failed = [F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(F.lit(0)).cast("long") for rule in RULES]
    total = failed[0]
    for bit in failed[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs, id_col, text_col).withColumn("bits", total)


def rejected(policy: str | tuple[str, ...]) -> Column:
    """Whether ``policy`` rejects a ledger row."""
    return F.col("bits").bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablations(rows: DataFrame, policy: str | tuple[str, ...]) -> DataFrame:
    """For each rule of a policy: documents failing it, and documents that only this rule rejects.

    One aggregation over the stored bits: no text is read again.
    """
    names = POLICIES[policy] if isinstance(policy, str) else policy
    held = F.col("bits").bitwiseAND(F.lit(mask(names)).cast("long"))
    counts = []
    for name in names:
        counts += [
            F.count_if(held.bitwiseAND(F.lit(BIT[name]).cast("long")) != 0).alias(f"fail_{name}"),
            F.count_if(held == BIT[name]).alias(f"only_{name}"),
        ]
    one = rows.agg(F.count("*").alias("n"), *counts)
    each = F.array(*[F.struct(F.lit(name).alias("rule"), F.col(f"fail_{name}").alias("n_failed"), F.col(f"only_{name}").alias("n_only"), F.col("n").alias("n_rows")) for name in names])
    return one.select(F.explode(each).alias("r")).select("r.*")


def stored_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The ledger written to the shared folder: policies and ablations read it and no text again."""
    return cut(ledger(docs, id_col, text_col), "ledger")


def verdicts(rows: DataFrame, policy: str = "v2") -> DataFrame:
    """Ledger rows with ``base_failed`` (the base policy's verdict), ``kept`` (not rejected by ``policy`` or base) and
    ``sole_rule``, the rule of the policy that alone rejects the document, if one does."""
    held = F.col("bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    sole = F.coalesce(*[F.when(held == BIT[name], F.lit(name)) for name in POLICIES[policy]])
    return rows.withColumns({"base_failed": rejected("base"), "kept": ~rejected("base") & ~rejected(policy), "sole_rule": sole})


def quality_rules(docs: DataFrame, policy: str = "v2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The verdicts on all documents by one evaluation of the rules."""
    return verdicts(ledger(docs, id_col, text_col), policy)


def kept_documents(docs: DataFrame, policy: str = "v2", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, whose text passes. The verdict is a function of the row alone, so no join is needed."""
    whole = F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("__row")
    judged = quality_rules(docs.select(whole, F.col(text_col).alias("__judged")), policy, "__row", "__judged")
    return judged.where("kept").select("__row.*")
