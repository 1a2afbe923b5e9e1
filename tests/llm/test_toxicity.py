"""Class models, scores and labels of the toxicity operator."""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from paylake.llm import toxicity as tox


def table(spark, name, sf="sf0.1"):
    return spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet")


def longest(words):
    out = Counter()
    for word in words:
        out.update(tox.grams(word, tox.ORDER))
    return dict(out)


def shared_of(words):
    """Shared probabilities of all pairs, counted anew."""
    three = Counter()
    for word in words:
        three.update(tox.grams(word, 3))
    pairs = Counter()
    for gram, n in three.items():
        if len(gram) == 2:
            pairs[gram] += n
        else:
            pairs[gram[1:]] += 1
    single, total, kinds = Counter(), Counter(), Counter()
    for pair, n in pairs.items():
        single[pair[1]] += 1
        total[pair[0]] += n
        kinds[pair[0]] += 1
    all_singles = sum(single.values())
    d = tox.DISCOUNT

    def p(pair):
        one = max(single[pair[1]] - d, 0) / all_singles + d * len(single) / all_singles / (len(single) + 1)
        return max(pairs[pair] - d, 0) / total[pair[0]] + d * kinds[pair[0]] / total[pair[0]] * one

    return {a + b: p(a + b) for a in total for b in single}


WORDS = ["idiot", "idiots", "ideas", "the", "then", "theme", "mean", "means", "meant", "été"]


def test_probabilities_behind_every_context_sum_to_one():
    shared = shared_of(WORDS)
    model = tox.ClassModel(longest(WORDS[:6]), shared)
    following = {pair[1] for pair in shared}
    unknown = 1 - sum(shared["t" + c] for c in following)  # mass of characters not seen at all
    assert 0 <= unknown < 0.1
    for context in model.total:
        known = sum(model.probability(context + c) for c in following if context[-1:] + c in shared)
        lost = 1 - sum(shared.get(context[-1:] + c, 0) for c in following)
        assert math.isclose(known, 1, abs_tol=abs(lost) + 1e-9), context


def test_word_ratios_are_sums_of_log_probabilities():
    shared = shared_of(WORDS)
    toxic, ordinary = tox.ClassModel(longest(WORDS[:3]), shared), tox.ClassModel(longest(WORDS[3:]), shared)
    ratios = tox.Scorer(tox.Ratios(toxic, ordinary))
    for word in [*WORDS, "idiotic", "zzz", "x"]:
        slow = sum(
            math.log(toxic.probability(g) / ordinary.probability(g)) for g in tox.grams(word, tox.ORDER) if len(g) > 2
        )
        # Where both classes back off to the shared orders, they say the same.
        assert math.isclose(ratios.word(word), slow, abs_tol=1e-9)
    assert ratios.word("idiot") > 1 > -1 > ratios.word("then")
    texts = ["the idiot, THE idiots!", "", "...", "mean"]
    mean = ratios.documents(pa.array(texts))
    by_hand = sum(ratios.word(w) for w in ("the", "idiot", "the", "idiots")) / 4
    assert np.allclose(mean, [by_hand, 0, 0, ratios.word("mean")])


def test_shared_counts_cover_the_whole_corpus(spark, docs):
    df = docs(*WORDS, " ".join(WORDS), None, "")
    expected = shared_of(WORDS * 2)
    pairs = sorted(p for p in expected if p in {g[-2:] for w in WORDS for g in tox.grams(w, 3)})
    found = tox.shared_backoff(spark, df, pairs)
    assert found.keys() == set(pairs)
    assert all(math.isclose(found[p], expected[p]) for p in pairs)


def test_class_counts_and_sample(spark, docs):
    labels = spark.createDataFrame(
        [(i, None if i == 4 else i % 2) for i in range(30)] + [(None, 1), (6, 1)], "doc_id long, toxic int"
    )
    learned = {i for i in range(30) if zlib.crc32(str(i).encode()) % 3 != 1 and i != 4}
    df = docs(*[f"word{i}" for i in range(30)], clashing=True)
    sample = tox.labelled_sample(df, labels, 100).collect()
    assert {r["text"]: r["toxic"] for r in sample} == {f"word{i}": 1 if i == 6 else i % 2 for i in learned}
    assert tox.labelled_sample(df, labels, 5).count() == 5
    counted = tox.class_counts(spark.createDataFrame([("ab ab", 1), ("ab", 0)], "text string, toxic int")).collect()
    assert {tuple(r) for r in counted} == {("^a", 2, 1), ("^ab", 2, 1), ("^ab$", 2, 1)}


def test_held_out_rows_are_told_by_their_id(spark):
    df = spark.createDataFrame([(i,) for i in [*range(200), -5, None]], "doc_id long")
    found = {r["doc_id"]: r["h"] for r in df.select("doc_id", tox.held_out("doc_id").alias("h")).collect()}
    assert found == {i: i is not None and zlib.crc32(str(i).encode()) % 3 == 1 for i in found}


def test_toxic_words_are_learned_and_held_out_labels_are_not_read(spark, docs):
    random = np.random.default_rng(1)
    plain = ["house", "garden", "river", "window", "paper", "stone", "letter", "morning"]
    texts, labels = [], []
    for i in range(400):
        own = random.choice(plain, 40).tolist()
        if i % 5 == 0:
            own[:6] = random.choice(["moron", "morons", "scumbag", "scummy"], 6).tolist()
        texts.append(" ".join(own))
        labels.append((i, int(i % 5 == 0)))
    df = docs(*texts, clashing=True)
    found = {r["doc_id"]: r for r in tox.toxicity(spark, df, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    out = [i for i in found if found[i]["held_out"]]
    assert len(out) > 80 and all(found[i]["predicted"] == int(i % 5 == 0) for i in out)
    turned = [(i, 1 - t if found[i]["held_out"] else t) for i, t in labels]
    again = tox.toxicity(spark, df, spark.createDataFrame(turned, "doc_id long, toxic int")).collect()
    assert all(math.isclose(r["score"], found[r["doc_id"]]["score"], rel_tol=1e-9) for r in again)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, None)], [(None, 0), (3, 0)], [(i, i % 2) for i in range(-3, 10)]])
def test_odd_documents_and_labels(spark, odd_docs, labels):
    found = tox.toxicity(spark, odd_docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    assert len(found) == odd_docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)
    same = {r["score"] for r in found if r["doc_id"] in (2, 3, 4)}  # null, empty and blank texts
    assert len(same) == 1


def test_empty_table(spark, empty_docs):
    labels = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert tox.toxicity(spark, empty_docs, labels).collect() == []


def test_held_out_accuracy(spark):
    """Documents with abusive words are told from others; labels without such words are noise here."""
    labels = table(spark, "labels")
    found = tox.toxicity(spark, table(spark, "documents"), labels).join(labels, "doc_id").where("held_out").collect()
    rejected = [r for r in found if r["predicted"]]
    assert sum(r["toxic"] for r in rejected) >= 0.9 * len(rejected)
    assert len(rejected) >= 0.3 * sum(r["toxic"] for r in found)


def test_word_ratios_back_off_to_the_corpus_and_leave_out_chance(spark, docs):
    texts = [f"both foo-bar Bad{'.' * (i % 2)} once{i} bad" for i in range(60)] + [f"both foo good other{i}" for i in range(60)]
    df = docs(*texts, None, "", "bad good rare rare")
    sample = df.where("doc_id < 120").selectExpr("text", "cast(doc_id < 60 as int) as toxic")
    counted = {r["word"]: (r["toxic"], r["ordinary"]) for r in tox.word_counts(sample).collect()}
    assert counted["bad"] == (60, 0) and counted["foo"] == (60, 60) and counted["once3"] == (1, 0)
    corpus = tox.corpus_grams(df)
    assert {r["gram"]: r["n"] for r in corpus.where("word").collect()}["bad"] == 121
    found = tox.word_ratios(spark, sample, corpus)
    assert found.keys() == {"bad", "bar", "good"} and found["bad"] > 0 > found["good"]
    toxic, ordinary, tokens = 60 * 5, 60 * 4, 120 + 120 + 60 + 121 + 61 + 120 + 2  # words of both, foo, bar, bad, good, own, rare
    odds, error = math.log(60.5 / 0.5) - math.log(toxic / ordinary), math.sqrt(1 / 60.5 + 1 / 0.5)
    share = 121 / tokens
    known = (60 - 0.75) / toxic + 0.75 * 64 / toxic * share
    ratio = math.log(known / (0.75 * 63 / ordinary * share))
    assert math.isclose(found["bad"], (1 - tox.ERRORS * error / odds) * ratio)


def test_words_nobody_knows_back_off_to_their_beginning(spark, docs):
    texts = [f"moron{'abcdefghij'[i % 10] * (1 + i // 10)} fine text" for i in range(60)] + ["fine mountain text"] * 60
    df = docs(*texts, "moronic moros", None)
    sample = df.where("doc_id < 120").selectExpr("text", "cast(doc_id < 60 as int) as toxic")
    corpus = tox.corpus_grams(df)
    begins = tox.word_ratios(spark, sample, corpus, 5)
    assert begins.keys() == {"moron", "mount"} and begins["moron"] > 0 > begins["mount"]
    # 61 different words begin with moron, one each with mount and moros: shares of different words.
    toxic, ordinary, d = 60, 60, tox.DISCOUNT
    odds, error = math.log(60.5 / 0.5), math.sqrt(1 / 60.5 + 1 / 0.5)
    ratio = math.log(((60 - d) / toxic + d / toxic * 61 / 63) / (d / ordinary * 61 / 63))
    assert math.isclose(begins["moron"], (1 - tox.ERRORS * error / odds) * ratio)
    model = tox.ClassModel({}, {})
    ratios = tox.Ratios(model, model, {"moroni": -1.0}, begins)
    assert [ratios.word(w) for w in ("moronic", "moroni", "moro", "other")] == [begins["moron"], -1.0, 0.0, 0.0]


def test_held_out_recall_of_words_by_language(spark):
    """Toxic words of German and French look like others by their characters, not as words."""
    docs, labels = table(spark, "documents"), table(spark, "labels")
    found = tox.toxicity(spark, docs, labels).where("held_out").join(labels, "doc_id")
    found = found.join(docs.select("doc_id", "lang"), "doc_id").collect()
    rejected = [r for r in found if r["predicted"]]
    assert sum(r["toxic"] for r in rejected) >= 0.95 * len(rejected)
    for lang, least in (("en", 0.85), ("de", 0.75), ("fr", 0.65), ("es", 0.6)):
        toxic = [r["predicted"] for r in found if r["toxic"] and r["lang"] == lang]
        assert sum(toxic) >= least * len(toxic), lang
    toxic = [r["predicted"] for r in found if r["toxic"]]
    assert sum(toxic) >= 0.75 * len(toxic)


def test_rows_that_repeat_an_id_and_its_text_teach_once(spark, docs):
    df = docs(*[(1, "the same text")] * 40, (1, "another text"), (7, "the same text"))  # ids that are not held out
    sample = tox.labelled_sample(df, spark.createDataFrame([(1, 1), (7, 0)], "doc_id long, toxic int"), 10)
    found = sorted((r["text"], r["toxic"]) for r in sample.collect())
    assert found == [("another text", 1), ("the same text", 0), ("the same text", 1)]
