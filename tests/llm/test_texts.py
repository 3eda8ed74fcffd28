"""Rules, spans, licences, lines, mixing, scores and pieces on small tables."""

import hashlib
import random
import re
from collections import Counter

import pytest

from strandweave.llm import compression_quality, license_scan, line_dedup, mixing, pii, quality_rules, sentencepiece, url_filter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def repeated(words):
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered |= {j for i in at for j in range(i, i + 8)}
    return len(covered)


def test_quality_measures_equal_brute_force(spark):
    draw = random.Random(1)
    texts = [None, "", " \n\t", "x" * 50_000, "a b c d e f g h " * 40]
    for _ in range(40):
        words = [draw.choice("ab É cd ef# *gh ij! KL".split()) for _ in range(draw.randrange(60))]
        texts.append(draw.choice([" ", "\n", "  "]).join(words + words[: draw.randrange(20)]))
    rows = {r.doc_id: r for r in quality_rules.quality_rules(spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, bits int")).collect()}
    for i, t in enumerate(texts):
        t, r = t or "", rows[i]
        words = WORD.findall(t)
        lines = [x for x in t.split("\n") if WORD.search(x)]
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)))
        assert (r.n_dup_lines, r.n_repeat_words) == (len(lines) - len(set(lines)), repeated(words))
        assert r.base_failed == (len(words) < 20 or 100 * r.n_repeat_words > 30 * len(words))
        assert not (r.base_failed and r.kept)


def test_quality_policies_and_ablations(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = quality_rules.ledger(spark.createDataFrame([(1, good), (2, "few"), (3, " ".join("w%s###" % chr(97 + i % 26) for i in range(30)))], "doc_id long, text string"))
    got = {r.rule: (r.n_failed, r.n_only) for r in quality_rules.ablations(rows, "v2").collect()}
    assert got["few_words"] == (1, 1) and got["symbols"] == (1, 1)
    docs = spark.createDataFrame([(1, good, "s"), (2, "few", "s")], "doc_id long, text string, kept string")
    assert [tuple(r) for r in quality_rules.kept_documents(docs).collect()] == [(1, good, "s")]


PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def sound(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
        return 13 <= len(digits) <= 19 and total % 10 == 0
    return True


def test_base_spans_equal_plain_patterns(spark):
    draw = random.Random(3)
    texts = [None, "", "a@b.c_d@e.f@g.h", "x@y", "1.2.3.4.5.6.7.8", "256.1.1.1 0255.01.1.1", "é 4111 1111 1111 1111 ü", "+1 (555) 123-4567.", "+123", "a." * 3000 + "@" + "b" * 3000, "1" * 5000, "+1" + "(" * 3000]
    for _ in range(300):
        texts.append("".join(draw.choice("a1.@+ -(_%é4") for _ in range(draw.randrange(40))))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.digest(pii.personal_data(docs)).collect()}
    for i, t in enumerate(texts):
        spans = [f"{k}:{m.start()}:{m.end()}" for k, p in PLAIN.items() for m in re.finditer(p, t or "") if sound(k, m.group())]
        assert got[i].base_sha256 == hashlib.sha256(",".join(spans).encode()).hexdigest(), t
        assert got[i].spans.startswith(",".join(spans))


def own_terms(text, places):
    """Terms of a text outside of its entities, with the number of the entity before each."""
    out, at = [], 0
    for k, (start, end) in enumerate([*places, (len(text), len(text))]):
        out += [(m.group().lower(), at + m.start(), k) for m in re.finditer(r"[A-Za-z0-9\x80-\U0010FFFF]+", text[at:start])]
        at = end
    return out


def brute_terms(texts, spans_of, threshold=0.8, z=3.0, near=5):
    """Terms whose Wilson-bounded PMI reaches the threshold: counts in documents, five terms either side."""
    import math

    n_term, n_kind, joint = Counter(), Counter(), Counter()
    for text in texts:
        spans = sorted(spans_of(text))
        places = []
        for start, end, kind in spans:
            if places and start < places[-1][1]:
                places[-1] = (places[-1][0], max(end, places[-1][1]), places[-1][2] | {kind})
            else:
                places.append((start, end, {kind}))
        terms = own_terms(text, [p[:2] for p in places])
        n_term.update({t for t, _, _ in terms})
        n_kind.update({kind for _, _, kind in spans})
        met = set()
        for k, (_, _, kinds) in enumerate(places):
            before, after = [t for t, _, p in terms if p <= k][-near:], [t for t, _, p in terms if p > k][:near]
            met |= {(kind, t) for kind in kinds for t in before + after}
        joint.update(met)
    out = set()
    for (kind, t), m in joint.items():
        n, p = n_term[t], m / n_term[t]
        low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
        if n_kind[kind] < len(texts) and 1 + math.log2(low) / math.log2(len(texts) / n_kind[kind]) >= threshold:
            out.add(t)
    return out


def test_disclosing_terms_equal_brute_force(spark):
    """Planted words beside addresses, some seldom, some also elsewhere; long words, two entities in a row, texts without any."""
    draw = random.Random(8)
    plain = [f"w{i}x" for i in range(60)]
    texts = []
    for i in range(240):
        words = [draw.choice(plain) for _ in range(30)]
        if i % 6 == 0:
            at = draw.randrange(25)
            words[at : at + 1] = ["Mailbox", "x" * 300, f"bob{i}@example.com,", "eve@example.org"]
        if i % 6 == 1:
            words[3:3] = [draw.choice(["Dial", "seldom" + str(i % 4)]), f"+1 555 010 {i:04d}"]
        if i % 80 == 3:
            words[9:9] = ["mailbox", "dial"]
        texts.append(" ".join(words))
    texts += [None, "", "k=2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = pii.personal_data(docs)
    got = {r.doc_id: r for r in found.collect()}
    spans_of = {t or "": [(s["start"], s["end"], s["kind"]) for s in [*got[i].base, *got[i].extra] if s["kind"] != "term"] for i, t in enumerate(texts)}
    want = brute_terms([t or "" for t in texts], lambda t: spans_of[t])
    assert {"mailbox", "x" * 300} <= want and "w1x" not in want
    for i, t in enumerate(texts):
        places = sorted(p[:2] for p in spans_of[t or ""])
        here = [(a, a + len(w)) for w, a, _ in own_terms(t or "", places) if w in want]
        assert [(s["start"], s["end"]) for s in got[i].extra if s["kind"] == "term"] == here
    assert any(s["kind"] == "secret" for s in got[len(texts) - 1].extra)
    assert [r.n_term for r in pii.digest(found).where("doc_id = 3").collect()] == [sum(w in want for w in ("mailbox", "dial"))]
    clean = {r.doc_id: r.text for r in pii.sanitised(docs, found).collect()}
    assert "<term>" in clean[0] and "<email>" in clean[0] and "Mailbox" not in clean[0] and "mailbox" not in clean[3]
    assert "@" not in {r.doc_id: r.text for r in pii.sanitised(docs, found, mode="remove").collect()}[0]


def test_personal_data_of_odd_tables(spark):
    long = "word " * 200_000 + "a@b.cd" + " 1.2.3.4 x" * 500
    docs = spark.createDataFrame([(1, long, 0), (1, "a@b.cd", 0), (1, "a@b.cd", 0), (None, "a@b.cd", 0), (2, None, 0)], "doc_id long, text string, base int")
    got = sorted((r.doc_id or 0, r.n_email, r.n_ip) for r in pii.digest(pii.personal_data(docs)).collect())
    assert got == [(0, 1, 0), (1, 1, 0), (1, 1, 0), (1, 1, 500), (2, 0, 0)]
    assert pii.digest(pii.personal_data(docs.limit(0))).isEmpty()


def test_twenty_thousand_entities_in_a_text(spark):
    """Places, surroundings and clean text of a long text beside short ones with the same term; overlapping entities in between."""
    draw = random.Random(6)
    parts = [draw.choice([f"mailbox é{i} a{i}@b{i}.com", f"mailbox 1.2.3.{i % 256}.9.8.7.6.x@y.z", f"ü 10.0.{i % 300}.1"]) for i in range(20_000)]
    long = "\n".join(parts)
    docs = spark.createDataFrame([(0, long)] + [(i, f"mailbox p{i}@q.r") for i in range(1, 40)] + [(40 + i, f"plain text {i}") for i in range(80)], "doc_id long, text string")
    found = pii.personal_data(docs)
    row = next(r for r in found.collect() if r.doc_id == 0)
    for kind, pattern in PLAIN.items():
        assert [(s["start"], s["end"]) for s in row.base if s["kind"] == kind] == [m.span() for m in re.finditer(pattern, long) if sound(kind, m.group())]
    terms = [(s["start"], s["end"]) for s in row.extra if s["kind"] == "term"]
    assert terms == [m.span() for m in re.finditer("mailbox", long)]
    clean, at, out = next(r.text for r in pii.sanitised(docs, found).collect() if r.doc_id == 0), 0, []
    for start, end, kind in sorted((s["start"], s["end"], s["kind"]) for s in [*row.base, *row.extra]):
        if start >= at:
            out.append(long[at:start] + f"<{kind}>")
        at = max(at, end)
    assert clean == "".join(out) + long[at:]


def test_licences(spark):
    filler = [(100 + i, f"plain text number {i} about nothing") for i in range(60)]
    rows = [(1, "Licensed under CC BY-NC 4.0."), (2, "This work is licensed under the GNU General Public License, version 3."), (3, "All rights reserved. ALL RIGHTS RESERVED"), (4, None), (5, ""), (6, "the Licensed under the Apache License, Version 2.0 x"), (7, "general public mention of a license")]
    docs = spark.createDataFrame([(*r, "x") for r in rows + filler + rows[:1]], "doc_id long, text string, labels string")
    got = {}
    for r in license_scan.digest(license_scan.scan(docs)).collect():
        assert got.setdefault(r.doc_id, r) == r
    assert (got[1].base_labels, got[1].labels, got[1].n_base) == ("cc-by", "cc-by,cc-by-nc-4.0", 1)
    assert (got[2].labels, got[2].first_word, got[2].n_words) == ("gpl,gpl-3.0", 7, 12)
    assert (got[3].n_base, got[3].first_word, got[3].last_word) == (2, 0, 3)
    assert (got[4].n_words, got[4].labels, got[4].score, got[4].first_word) == (0, "", 0.0, None)
    assert got[6].labels == "apache-2.0" and got[7].labels == "" and got[100].labels == ""


def test_licences_of_common_words_and_of_many_in_a_file(spark):
    few = spark.createDataFrame([(i, "Released under the MIT License.") for i in range(3)], "doc_id long, text string")
    assert {(r.labels, r.score) for r in license_scan.digest(license_scan.scan(few)).collect()} == {("mit-name", 1.0)}
    every = ". ".join(text for text, _ in license_scan.TEMPLATES.values())
    rows = [(i, f"plain text number {i} about nothing") for i in range(60)] + [(100 + i, "released under the mit license") for i in range(30)] + [(200, every)]
    got = {r.doc_id: r.labels for r in license_scan.digest(license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[1] == "" and got[100] == "mit-name" and set(license_scan.TEMPLATES) <= set(got[200].split(","))


def test_lines(spark):
    boiler = "Posted by the admin on day {} of the year"
    rows = [(1, "own line of the first doc\n" + boiler.format(1)), (2, boiler.format(22) + "\nanother line in the second doc"), (3, "Accept all cookies to read Alpha on this site today\nx"), (4, "x\nAccept all cookies to read Beta on this site today"), (5, None), (6, ""), (None, boiler.format(3))]
    out = {r.doc_id: r for r in line_dedup.line_dedup(spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, n_lines int")).collect()}
    assert out[None].text == boiler.format(3)  # a null id comes before all others
    assert out[1].text == "own line of the first doc" and out[2].text == "another line in the second doc"
    assert out[3].text == rows[2][1] and out[4].text == "x" and (out[4].n_lines, out[4].n_dropped) == (2, 1)
    assert out[5].text is None and out[6].text == ""
    twice = spark.createDataFrame([(1, "a line that is long enough"), (1, "a line that is long enough")], "doc_id long, text string")
    assert [r.text for r in line_dedup.line_dedup(twice).collect()] == ["a line that is long enough"] * 2
    assert line_dedup.line_dedup(twice.limit(0)).isEmpty()


def greedy(lines, similarity=0.8):
    """The template of each (tokens, n, first) of one leaf, taken one after another."""
    templates = []
    for tokens in sorted(lines, key=lambda t: (-lines[t][0], lines[t][1])):
        like = [t for t in templates if sum(a == b for a, b in zip(t, tokens, strict=True)) >= similarity * len(tokens)]
        templates += [] if like else [tokens]
    return templates


def test_every_family_of_a_leaf_is_found(spark):
    """Five families share a leaf; each variant but the first document's goes, and lines like no other stay."""
    heads = ["one two three four", "see all the news"]
    family = lambda h, f, i: f"{heads[h]} " + " ".join(f"{f}{c}" for c in "abcde") + f" v{chr(97 + i)}"
    rows, alone = [], []
    for i in range(6):
        for h in (0, 1):
            for f in "pqrst":
                rows.append((len(rows) + 1, family(h, f, i), i == 0))
        alone.append((1000 + i, f"{heads[0]} " + " ".join(f"{chr(97 + i)}z{c}" for c in "abcdef"), True))
    out = {r.doc_id: r.n_dropped for r in line_dedup.line_dedup(spark.createDataFrame([r[:2] for r in rows + alone], "doc_id long, text string")).collect()}
    assert all((out[i] == 0) == first for i, _, first in rows + alone)


def test_templates_equal_taking_them_one_by_one(spark):
    draw = random.Random(4)
    lines = {}
    while len(lines) < 60:
        tokens = ("a", "b", "c", "d", *(draw.choice("xy") for _ in range(6)))
        lines.setdefault(tokens, (draw.randrange(1, 4), len(lines)))
    rows = [(1, i, n, first, list(t)) for i, (t, (n, first)) in enumerate(lines.items())]
    found = line_dedup._templates(spark.createDataFrame(rows, "leaf long, line long, n long, first long, tokens array<string>"), 4, 0.8).collect()
    model = {r.line: r.model for r in found}
    assert len(model) == len(found)
    assert {model.get(i, i) for i in range(60)} == {list(lines).index(t) for t in greedy(lines)}


def test_short_lines_go_and_blank_ones_stay(spark, tmp_path):
    from strandweave.llm import queries

    rows = [(1, "All rights reserved.\n\nfirst own"), (2, "second own\n\nAll rights reserved.\n版权所有"), (3, "版权所有\n \nthird")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = {r.doc_id: r.text for r in queries.op9_line_dedup(spark, str(tmp_path)).collect()}
    assert out == {1: rows[0][1], 2: "second own\n\n版权所有", 3: " \nthird"}


def test_tokens_that_look_equal_in_the_sketch_are_told_apart(spark):
    from pyspark.sql import functions as F

    words = [f"{chr(97 + i)}{chr(97 + j)}" for i in range(26) for j in range(26)]
    marks = {}
    for r in spark.createDataFrame([(w,) for w in words], "w string").select("w", line_dedup._sketch(F.col("w")).alias("mark")).collect():
        marks.setdefault(r.mark, []).append(r.w)
    x, y = next(m for m in marks.values() if len(m) > 1)[:2]
    line = "one two three four five six seven {} {} {}"
    rows = [(1, line.format(x, "this", "that")), (2, line.format(y, "some", "other"))]
    out = {r.doc_id: r.text for r in line_dedup.line_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == dict(rows)


def shares(mixed, column):
    from pyspark.sql import functions as F

    total = mixed.agg(F.sum(F.col("tokens") * F.col("probability"))).first()[0]
    return {r[column]: r["t"] / total for r in mixed.groupBy(column).agg(F.sum(F.col("tokens") * F.col("probability")).alias("t")).collect()}


def test_raking_meets_the_marginals_at_the_production_budget(spark):
    draw = random.Random(1)
    rows = [(i, "word " * draw.randrange(10, 60) + f"topic{i % 3}x", draw.choice("aaaabc"), draw.choice(["en", "en", "fr"]), 1.0) for i in range(900)] + [(1000, None, None, None, 1.0), (None, "w w", "a", "en", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, probability double")
    mixed = mixing.mix(docs).cache()
    tokens = [(r.source, r.lang, r.topic, r.tokens) for r in mixed.select("source", "lang", "topic", "tokens").collect()]
    assert mixed.first().residual < 0.001 and mixed.count() == len(rows) and mixed.where("probability > 1").isEmpty()
    for at, column in ((0, "source"), (1, "lang"), (2, "topic")):
        have = Counter()
        for t in tokens:
            have[t[at]] += t[3]
        tempered = {v: n**0.85 for v, n in have.items() if n}
        rate, total = 1.0, sum(have.values())
        most = {v: 0.95 * have[v] for v in tempered}
        low, high = 0.0, total
        for _ in range(200):  # the rate at which values, each up to its most, sum to the budget
            rate = (low + high) / 2
            low, high = (rate, high) if sum(min(most[v], rate * x) for v, x in tempered.items()) < 0.8 * total else (low, rate)
        got = shares(mixed, column)
        for v, x in tempered.items():
            assert got[v] == pytest.approx(min(most[v], rate * x) / (0.8 * total), abs=0.002)
    again = mixing.mix(docs)
    assert {(r.row.doc_id, r.kept) for r in again.select("row", "kept").collect()} == {(r.row.doc_id, r.kept) for r in mixed.select("row", "kept").collect()}
    assert mixing.mixed_documents(docs.limit(0), rounds=1).isEmpty()
    assert mixing.mixed_documents(docs, rounds=1).columns == docs.columns


def test_plans_of_the_raking_do_not_grow_with_its_steps(spark, monkeypatch):
    joins, write = [], mixing.cut

    def noted(df, name="cut"):
        joins.append(df._jdf.queryExecution().optimizedPlan().toString().count("Join "))
        return write(df, name)

    monkeypatch.setattr(mixing, "cut", noted)
    cells = {("a", "en", "x"): 100, ("a", "fr", "y"): 50, ("b", "en", "y"): 10, ("b", "fr", "x"): 40, ("c", "en", "x"): 0}
    aims = {"source": {"a": 60.0, "b": 45.0}, "lang": {"en": 65.0, "fr": 40.0}, "topic": {"x": 70.0, "y": 35.0}}
    targets = {m: spark.createDataFrame(list(t.items()), f"{m} string, target double") for m, t in aims.items()}
    table = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    raked = mixing.rake(table, targets, 0.525, rounds=4)
    assert max(joins) <= len(targets)

    weights = {c: 0.525 * n for c, n in cells.items()}
    for at, aim in [*enumerate(aims.values())] * 4:
        for value, target in aim.items():
            of = [c for c in cells if c[at] == value]
            whole, full = sum(weights[c] for c in of), sum(weights[c] for c in of if weights[c] >= cells[c] * mixing.FULL)
            for c in of:
                if target <= whole:
                    weights[c] *= target / whole
                elif weights[c] < cells[c] * mixing.FULL:
                    weights[c] = min(cells[c], weights[c] * (target - full) / (whole - full))
    assert sorted(raked.columns) == ["lang", "source", "tokens", "topic", "weight"]
    assert {(r.source, r.lang, r.topic): r.weight for r in raked.collect()} == pytest.approx(weights)


def test_given_targets_lower_the_budget_to_what_the_scarcest_value_allows(spark):
    rows = [(i, "word " * 20, "a" if i % 10 else "b", "en") for i in range(400)] + [(1000, "z " * 500_000, "a", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    mixed = mixing.mix(docs, source_target={"a": 0.5, "b": 0.5}, lang_target={"en": 1.0}).cache()
    got = shares(mixed, "source")
    assert got["a"] == pytest.approx(0.5, abs=0.01) and got["b"] == pytest.approx(0.5, abs=0.01)
    assert all(r.probability == pytest.approx(1.0) for r in mixed.where("source = 'b'").select("probability").collect())
    assert mixed.where("lang = 'xx' AND kept").isEmpty()


def test_urls(spark):
    rows = [(i, f"https://www.site{i % 3}.net/x/{i}") for i in range(40)] + [(100 + i, f"http://a.example.net/en/{i}?q=1") for i in range(40)]
    rows += [(200, None), (201, "no scheme"), (202, "http://EXAMPLE.com/de/1"), (203, "http://other.dev/en/5"), (204, "x://net"), (205, "x://net/"), (206, "http://b.org/fr/x#y"), (206, "http://b.org/fr/x#y")]
    got = {r.page_id: r for r in url_filter.filter_urls(spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, host int")).collect()}
    assert got[0].rule == "net/" and got[0].verdict == "block"
    assert got[100].rule == "example.net/en/" and got[100].verdict == "allow"
    assert (got[200].host, got[200].path, got[200].verdict) == ("", "", "allow") and got[201].host == ""
    assert (got[202].host, got[202].rule) == ("example.com", "example.com/de/")
    assert got[203].verdict == "allow" and got[203].mined == "path:en"
    assert (got[204].path, got[204].rule, got[205].rule, got[206].rule) == ("", None, "net/", "org/fr/")
    assert url_filter.filter_urls(spark.createDataFrame([], "page_id long, url string")).isEmpty()


def test_scores_tell_held_out_texts_apart(spark):
    draw = random.Random(1)
    syllables = "an er in on th re st ou".split()
    word = lambda: "".join(draw.choice(syllables) for _ in range(draw.randrange(1, 4)))
    good = lambda: " ".join(word() for _ in range(80))
    bad = lambda: " ".join(word().upper() + "!!" for _ in range(80))
    rows = [(i, good() if i % 2 else bad(), i % 2) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(1000, None), (None, "x"), (1001, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows] + [(1, None), (None, 1), (5000, 0)], "doc_id long, quality int")
    got = {r.doc_id: r for r in compression_quality.quality_scores(docs, labels).collect()}
    assert len(got) == 403 and got[1000].score == got[1001].score
    held = [(got[i].predicted, q) for i, _, q in rows if got[i].held_out]
    assert len(held) > 50 and sum(p == q for p, q in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_one_bounded_text_an_id_teaches(spark, monkeypatch):
    taught = []
    monkeypatch.setattr(compression_quality, "fit_texts", lambda good, bad: taught.extend([good, bad]))
    docs = spark.createDataFrame([(1, "b"), (1, "a" * 40_000), (1, None)] * 20 + [(3, "c"), (4, None)], "doc_id long, text string")
    compression_quality.fit(docs, spark.createDataFrame([(1, 1), (3, 0), (4, 0)], "doc_id long, quality int").where(~compression_quality.held_out()))
    assert taught[0] == ["a" * compression_quality.SAMPLE] and sorted(taught[1]) == ["", "c"]


@pytest.fixture(scope="module")
def pieces():
    with open(sentencepiece.MODEL, "rb") as f:
        return sentencepiece.Model(f.read())


def best_sum(model, text):
    """The best score by a table over all pairs of positions."""
    number = {model.pieces[i]: j for j, i in enumerate(model.ids)}
    marked = sentencepiece.MARK + text.replace(" ", sentencepiece.MARK)
    best = [0.0] + [float("-inf")] * len(marked)
    for end in range(1, len(marked) + 1):
        for start in range(max(0, end - 20), end):
            piece = marked[start:end]
            if piece in number:
                best[end] = max(best[end], best[start] + model.scores[number[piece]])
            elif end - start == 1:
                best[end] = max(best[end], best[start] + model.unknown)
    return best[-1]


def test_viterbi_equals_a_full_table(pieces):
    draw = random.Random(1)
    score = {int(i): s for i, s in zip(pieces.ids, pieces.scores, strict=True)}
    for _ in range(150):
        text = "".join(draw.choice("ab cdeéß字😀\nthe ing  ") for _ in range(draw.randrange(1, 40)))
        ids = pieces.encode([text])[0].tolist()
        spelt = [pieces.text_of[i] for i in ids if i not in score]
        unknown = len(b"".join(spelt).decode("utf-8"))
        assert sum(score.get(i, 0.0) for i in ids) + unknown * pieces.unknown == pytest.approx(best_sum(pieces, text))


def test_round_trip(spark, pieces):
    import sentencepiece as library

    texts = [None, "", " ", "  two  spaces ", "▁ marker ▁▁x", "tab\tline\n\r", "字😀é" * 50, "word " * 200_000, "x" * 30_000, "\x00"]
    docs = spark.createDataFrame([(i, t, "i") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    coded = sentencepiece.encode(docs, same_col="same")
    rows = {r.doc_id: r for r in sentencepiece.decode(coded).collect()}
    assert [rows[i].decoded for i in range(len(texts))] == texts and all(r.same for r in rows.values())
    lib = library.SentencePieceProcessor(model_file=sentencepiece.MODEL)
    for i in (3, 5, 6):
        assert lib.decode(rows[i].ids) == texts[i]
    assert sentencepiece.encode(docs.limit(0)).isEmpty()


def test_trie_holds_exactly_its_pieces():
    draw = random.Random(1)
    words = list({bytes(draw.choice(b"abc\xc3\xa9") for _ in range(draw.randrange(1, 7))) for _ in range(400)})
    trie = sentencepiece.Trie(words)

    def find(raw):
        state = 0
        for b in raw:
            following = int(trie.base[state]) + b
            if trie.base[state] <= 0 or trie.check[following] != state:
                return -1
            state = following
        return int(trie.leaf[state])

    assert all(find(w) == i for i, w in enumerate(words))
    assert all(find(w + b"z") == -1 for w in words)


def brute_rules(rows, support, confidence, longest):
    """Every set of tokens and verdict that is sure enough, without those that a smaller set makes superfluous."""
    from itertools import combinations

    seen, least = {}, -(-support * len(rows) // 1)
    for tokens, verdict in rows:
        for k in range(1, longest + 1):
            for combo in combinations(sorted(tokens), k):
                seen.setdefault(combo, Counter())[verdict] += 1
    sure = {(c, v): n / sum(by.values()) for c, by in seen.items() for v, n in by.items() if n >= least and n / sum(by.values()) >= confidence}
    return {(c, v) for (c, v), p in sure.items() if not any(w == v and set(d) < set(c) and q >= p for (d, w), q in sure.items())}


def test_mined_rules_equal_brute_force(spark):
    draw = random.Random(6)
    rows = []
    for _ in range(300):
        tokens = {t for t in "abcdefg" if draw.random() < 0.5}
        rows.append((tokens, "block" if "a" in tokens and ("b" in tokens or draw.random() < 0.05) else "allow"))
    df = spark.createDataFrame([(sorted(t), v) for t, v in rows], "tokens array<string>, seed string")
    want = brute_rules(rows, 0.02, 0.9, 4)
    for wide in (12, 0):  # by FP-growth, and level by level
        assert {(tuple(r.antecedent), r.verdict) for r in url_filter.mine(df, 0.02, 0.9, 4, wide=wide).collect()} == want
    assert any(len(c) > 1 for c, _ in want)


def test_urls_equal_brute_force(spark):
    """Seeds, then the surest rule whose tokens all occur; very long urls, repeats and a url with very many names."""
    draw = random.Random(7)
    rows = []
    for i in range(400):
        host = draw.choice(["a.net", "example.net", "b.org", "c.dev", "example.com"])
        rows.append((i, f"https://{host}/{draw.choice(['en', 'de', 'fr', 'x'])}/{i}?" + "&".join(f"{n}=1" for n in "pqr" if draw.random() < 0.5)))
    rows += [(1000, "https://a.net/" + "y/" * 20_000), (1001, "https://a.net/?" + "&".join(f"n{i}=1" for i in range(40)))] * 6
    df = spark.createDataFrame(rows, "page_id long, url string")
    judged = url_filter.seeded(df.select("page_id", "url", url_filter.host_of(df.url).alias("host"), url_filter.path_of(df.url).alias("path"))).withColumn("tokens", url_filter.tokens(df.url)).collect()
    labelled = [(set(r.tokens), r.seed) for r in judged if r.seed]
    short = [(t if len(t) < 30 else {x for x in t if not x.startswith("query:n")}, v) for t, v in labelled]  # those are of one verdict
    counts = Counter()
    by = {}
    for t, v in labelled:
        for x in t:
            by.setdefault(x, Counter())[v] += 1
    rules = brute_rules(short, 0.01, 0.9, 4) | {((x,), next(iter(c))) for x, c in by.items() if len(c) == 1 and sum(c.values()) >= 0.01 * len(labelled)}
    share = lambda c, v: (n := sum(set(c) <= t and w == v for t, w in labelled)) and (n / sum(set(c) <= t for t, _ in labelled), n / len(labelled))
    rated = [(*share(c, v), len(c), v, c) for c, v in rules]
    got = {r.page_id: r for r in url_filter.filter_urls(df).collect()}
    for r in judged:
        if not r.seed:
            fitting = [x for x in rated if set(x[4]) <= set(r.tokens)]
            best = max(fitting) if fitting else None
            assert (got[r.page_id].verdict, got[r.page_id].mined) == ((best[3], " ".join(best[4])) if best else ("allow", None))
            counts["mined" if best else "none"] += 1
        else:
            assert got[r.page_id].verdict == r.seed and got[r.page_id].mined is None
    assert counts["mined"] > 20


def test_licences_of_odd_tables(spark):
    long = "filler " * 100_000 + "released under the mit license. " * 30
    docs = spark.createDataFrame([(1, long), (None, "released under the mit license"), (2, "x")] + [(3, None)] * 2, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_words, r.labels) for r in license_scan.digest(license_scan.scan(docs)).collect())
    assert got == [(0, 5, "mit-name"), (1, 100_150, "mit-name"), (2, 1, ""), (3, 0, ""), (3, 0, "")]
    assert license_scan.digest(license_scan.scan(docs.limit(0))).isEmpty()


def test_lines_of_odd_tables(spark):
    """Columns of any name, a text of very many lines, ties between the lines of a leaf."""
    boiler = "one two three four five six seven eight nine {}"
    rows = [(1, "\n".join(f"own line number {chr(97 + i % 26)}{i // 26} of a long text {i}" for i in range(20_000)), 5), (2, boiler.format("ten"), 5), (3, boiler.format("x") + "\n" + boiler.format("y"), 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, __gone int").withColumn("__k", docs_lit()).withColumn("k", docs_lit())
    got = {r.doc_id: r for r in line_dedup.line_dedup(docs, min_tokens=1).collect()}
    assert got[2].n_dropped == 0 and got[3].text == "" and got[1]['__gone'] == 5 and got[1].n_lines == 20_000


def docs_lit():
    from pyspark.sql import functions as F

    return F.lit("z")


def test_scores_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a" * 3_000_000, 0.5), (2, "word", 0.5), (2, "word", 0.5), (3, None, 0.5)], "doc_id long, text string, score double")
    one_class = compression_quality.quality_scores(docs, spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, quality int")).collect()
    assert len(one_class) == 4 and all(r.score > 0.99 and r.predicted == 1 for r in one_class)
    none = compression_quality.quality_scores(docs, spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert len(none) == 4 and len({r.score for r in none}) == 1
    assert compression_quality.quality_scores(docs.limit(0), spark.createDataFrame([(1, 1)], "doc_id long, quality int")).isEmpty()


def test_quality_rules_of_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, None)], "doc_id long, text string")
    assert [r.n_words for r in quality_rules.quality_rules(docs).orderBy("n_words").collect()] == [0, 2, 2]
    assert quality_rules.quality_rules(docs.limit(0)).isEmpty() and quality_rules.ablations(quality_rules.ledger(docs.limit(0)), "v2").count() == len(quality_rules.RULES)


def test_long_words_and_slices_keep_the_best_pieces(pieces, monkeypatch):
    """A word with its own table, and words where a slice of the text ends, cost what a table of all positions gives."""
    draw = random.Random(9)
    score = {int(i): s for i, s in zip(pieces.ids, pieces.scores, strict=True)}
    monkeypatch.setattr(sentencepiece, "SLICE", 16)
    monkeypatch.setattr(sentencepiece, "STRETCH", 50)
    for text in ("internationalization of  the international  things " * 3, "".join(draw.choice("abcdeinrt字é") for _ in range(700)), "a" * 400 + " " * 400):
        ids = pieces.encode([text])[0].tolist()
        unknown = len(b"".join(pieces.text_of[i] for i in ids if i not in score).decode("utf-8"))
        assert sum(score.get(i, 0.0) for i in ids) + unknown * pieces.unknown == pytest.approx(best_sum(pieces, text))
        assert pieces.decode(ids) == text


def test_repeated_label_rows_do_not_use_up_the_sample(spark):
    """One id that holds most label rows leaves the model as it is without the repeats."""
    docs = spark.createDataFrame([(i, ("good prose about things " if i % 2 else "BUY !!! now $$$ ") * (3 + i % 5) + str(i)) for i in range(60)], "doc_id long, text string")
    once = [(i, i % 2) for i in range(60)]
    fits = [compression_quality.fit(docs, spark.createDataFrame(rows, "doc_id long, quality int"), per_class=20) for rows in (once, once + [(1, 1)] * 500 + [(2, 0)] * 500)]
    assert (fits[0].slope, fits[0].intercept) == (fits[1].slope, fits[1].intercept) and fits[0].good == fits[1].good
