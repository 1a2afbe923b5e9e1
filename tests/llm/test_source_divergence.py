"""Divergence of sources against every term of every pair."""

from __future__ import annotations

import random
from collections import Counter

import pytest

import __spark_entry__ as contract
from checks.compare import sql_rows
from paylake.llm import source_divergence as sd
from paylake.llm.source_divergence import Rules


def terms_of(text):
    out, word = [], ""
    for c in (text or "") + " ":
        if c > "\x7f" or c.isalpha() and c.isascii():
            word += c.lower() if c.isascii() else c
        elif word:
            out.append(word)
            word = ""
    return out


def brute(rows, rules=Rules()):
    """Rows are (lang, source, text)."""
    counts, holders, groups = Counter(), Counter(), set()
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for term, n in Counter(terms_of(text)).items():
            counts[lang, source, term] += n
            holders[lang, term] += 1
    kept = {}
    for (lang, term), n in holders.items():
        if n >= rules.min_docs:
            kept.setdefault(lang, []).append(term)
    lang_counts = Counter()
    for (lang, _, term), n in counts.items():
        lang_counts[lang, term] += n

    def shares(count, terms):
        total = sum(count(t) for t in terms)
        return {t: 1 + rules.scale * (count(t) + 1) // (total + len(terms)) for t in terms}

    of = {g: shares(lambda t: counts[g[0], g[1], t], kept.get(g[0], [])) for g in groups}
    whole = {lang: shares(lambda t: lang_counts[lang, t], terms) for lang, terms in kept.items()}
    out = Counter()
    for lang, source in groups:
        p = of[lang, source]
        pairs = [
            (b, sum((p[t] - of[lang, b][t]) ** 2 // of[lang, b][t] for t in p)) for a, b in groups if a == lang and b != source
        ]
        above = [
            (t, (p[t] - whole[lang][t]) ** 2 // whole[lang][t]) for t in p if counts[lang, source, t] and p[t] > whole[lang][t]
        ]
        for part, items, top in (("pair", pairs, None), ("term", above, rules.top)):
            items.sort(key=lambda item: (-item[1], item[0].encode()))
            for rank, (item, value) in enumerate(items[:top], 1):
                out[lang, source, part, item, value, rank] += 1
    return out


def build(spark, rows):
    full = [(i, text, lang, source, "x", 1) for i, (lang, source, text) in enumerate(rows)]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, content string, n int").repartition(3)


def found(spark, rows, rules=Rules()):
    return Counter(map(tuple, sd.divergence(spark, build(spark, rows), rules).collect()))


@pytest.mark.parametrize("held", [sd.HELD, 10])
def test_random_sources_with_copies_and_ties(spark, monkeypatch, held):
    monkeypatch.setattr(sd, "HELD", held)
    rng = random.Random(held)
    words = ["the", "The", "ähnlich", "Ähnlich", "zug", "a1b", "x-y", "中文", "Ünï", "end.", "42", "rare"] + [f"w{chr(97 + i)}" for i in range(20)]
    texts = [" ".join(rng.choices(words, k=rng.randrange(12))) for _ in range(25)]
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["s1", "s2", "s3", None, ""]), rng.choice(texts)) for _ in range(150)]
    rows += [("en", "hot", texts[1])] * 120 + [("xx", "alone", "only one source here")] * 3
    rows += [("en", "silent", ""), ("en", "silent", None), ("yy", "a", "too rare"), ("yy", "b", "too rare"), ("yy", "c", None)]
    for rules in (Rules(), Rules(min_docs=1, top=3)):
        assert found(spark, rows, rules) == brute(rows, rules)


def test_a_text_is_handed_on_once_for_all_its_copies(spark):
    rows = [("en", "a", "same text")] * 50 + [("en", "b", "same text")] * 9 + [("de", "a", "same text"), ("en", "a", "other")]
    once = {(r["lang"], r["text"]): sorted(map(tuple, r["sources"])) for r in sd.collapsed(build(spark, rows)).collect()}
    assert once == {
        ("en", "same text"): [("a", 50), ("b", 9)], ("de", "same text"): [("a", 1)], ("en", "other"): [("a", 1)],
    }


def test_counts_beyond_a_long_stay_exact(spark):
    df = spark.createDataFrame([(9_000_000_000_000, 9_500_000_000_000, 77)], "n long, total long, vocabulary long")
    share = df.select(sd._probability("n", "total", Rules()).alias("p")).first()["p"]
    assert share == 1 + 10**9 * (9_000_000_000_000 + 1) // (9_500_000_000_000 + 77)


def test_odd_and_empty_documents(spark, odd_docs, empty_docs):
    rows = [(r["lang"], r["source"], r["text"]) for r in odd_docs.collect()]
    got = Counter(map(tuple, sd.divergence(spark, odd_docs, Rules(min_docs=1)).collect()))
    assert got == brute(rows, Rules(min_docs=1))
    assert sd.divergence(spark, empty_docs).collect() == []


def test_query_equals_sql(spark, duck, sf_dir):
    df = contract.queries()["op12_source_divergence"](spark, sf_dir)
    names, rows = sql_rows(duck, contract.oracle_sql()["op12_source_divergence"])
    assert sorted(df.columns) == names
    assert Counter(map(tuple, df.select(*names).collect())) == rows
