"""Toxicity by pairs of Kneser-Ney models, one of toxic and one of ordinary text.

One pair predicts whole words: how many documents of a class hold a word, backed off to its frequency in
the whole corpus, and where neither class tells the word, how many hold its beginning, backed off to the
number of different words of the corpus that begin so. The other predicts the characters of words from up to four before
them. Their lower orders are shared: how many different characters precede a pair, counted over the
whole corpus. Where neither class knows an expression both back off to the same counts, so it says
nothing either way. A document has two values: the log-likelihood ratios of its words over the
square root of their number, as far as each can be told from chance, and the mean ratio of
their characters. A logistic curve over both, fitted on labelled documents that the models have not
seen, puts them on a 0-to-1 scale.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylake.llm import arrow
from paylake.llm.ordering import stored
from paylake.llm.memo import Memo

ORDER = 5
# Orders up to this one are shared by both classes.
SHARED = 2
DISCOUNT = 0.75
# Standard errors that the two classes' counts of a word must differ by before it says anything, and the
# characters of a beginning. Both were chosen by five-fold cross-validation over labelled rows that are
# not held out; see the README.
ERRORS = 3.0
BEGINNING = 5
THRESHOLD = 0.7
# Labelled documents that the classes are learned from, at most; chosen by a hash of their id.
MAX_LABELLED = 24_000
BEGIN, END = "^", "$"
# Distinct chunks of text, or grams, that a task holds at once.
MOST_CHUNKS = 200_000
MOST_MEMO = 50_000

# A word is a run of ASCII digits, ASCII letters and characters above ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

GRAMS = pa.schema([("gram", pa.string()), ("toxic", pa.int64()), ("ordinary", pa.int64())])
WORDS = pa.schema([("word", pa.string()), ("toxic", pa.int64()), ("ordinary", pa.int64())])
VALUES = pa.schema([("toxic", pa.int32()), ("characters", pa.float64()), ("words", pa.float64())])


def words(strings: pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Lower-cased chunks: text number and code of each, and the distinct chunks.

    Chunks end at ASCII blanks, and before a punctuation mark behind a letter, as most words
    occur both with and without one.
    """
    spaced = pc.replace_substring_regex(pc.utf8_lower(strings), "([a-z])([.,!*&%$#?;:])", r"\1 \2")
    split = pc.ascii_split_whitespace(spaced)
    sizes = pc.list_value_length(split).to_numpy(zero_copy_only=False)
    coded = split.flatten().dictionary_encode()
    return np.repeat(np.arange(len(strings)), sizes), coded.dictionary.to_pylist(), coded.indices.to_numpy()


def grams(word: str, order: int) -> Iterable[str]:
    """For each character and the end: itself behind as many characters as the order allows."""
    marked = BEGIN + word + END
    return (marked[max(0, i - order + 1) : i + 1] for i in range(1, len(marked)))


def class_counts(labelled: DataFrame) -> DataFrame:
    """Frequencies of the longest grams in toxic and in ordinary documents (text, toxic)."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, names, codes = words(arrow.texts(batch))
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False)[rows] == 1
        sums = defaultdict(lambda: [0, 0])
        n_toxic = np.bincount(codes[toxic], minlength=len(names)).tolist()
        n_all = np.bincount(codes, minlength=len(names)).tolist()
        for name, t, n in zip(names, n_toxic, n_all, strict=True):
            for word in WORD.findall(name):
                for gram in grams(word, ORDER):
                    both = sums[gram]
                    both[0] += t
                    both[1] += n - t
        return arrow.table(
            GRAMS,
            gram=list(sums),
            toxic=[x[0] for x in sums.values()],
            ordinary=[x[1] for x in sums.values()],
        )

    counted = arrow.map_slices(labelled.select("text", "toxic"), count, GRAMS)
    return counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def word_counts(labelled: DataFrame, beginning: int | None = None) -> DataFrame:
    """How many toxic and how many ordinary documents (text, toxic) hold each word.

    With ``beginning``, the same of the first so many characters of words that have as many.
    """

    def kept(name: str) -> list[str]:
        found = WORD.findall(name)
        return found if beginning is None else [word[:beginning] for word in found if len(word) >= beginning]

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, names, codes = words(arrow.texts(batch))
        split = [kept(name) for name in names]
        held = defaultdict(set)
        for row, code in zip(rows.tolist(), codes.tolist(), strict=True):
            held[row].update(split[code])
        sums = defaultdict(lambda: [0, 0])
        toxic = batch.column("toxic").to_pylist()
        for row, found in held.items():
            for word in found:
                sums[word][toxic[row] != 1] += 1
        return arrow.table(
            WORDS,
            word=list(sums),
            toxic=[x[0] for x in sums.values()],
            ordinary=[x[1] for x in sums.values()],
        )

    counted = arrow.map_slices(labelled.select("text", "toxic"), count, WORDS)
    return counted.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary"))


def corpus_grams(docs: DataFrame) -> DataFrame:
    """Frequencies in the whole corpus: every gram of one order above the shared ones, and every ``word``."""
    schema = pa.schema([("gram", pa.string()), ("word", pa.bool_()), ("n", pa.int64())])

    def count(chunks: Counter) -> pa.RecordBatch:
        sums: defaultdict[str, int] = defaultdict(int)
        whole: defaultdict[str, int] = defaultdict(int)
        for chunk, n in chunks.items():
            for word in WORD.findall(chunk):
                whole[word] += n
                marked = BEGIN + word + END
                for i in range(1, len(marked)):
                    sums[marked[max(0, i - SHARED) : i + 1]] += n
        return arrow.table(
            schema,
            gram=[*sums, *whole],
            word=[False] * len(sums) + [True] * len(whole),
            n=[*sums.values(), *whole.values()],
        )

    def run(batches):
        chunks: Counter = Counter()  # a word is taken apart once for as much text as fits
        for batch in arrow.text_slices(batches, limit=arrow.SLICE_BYTES):
            _, names, codes = words(arrow.texts(batch))
            for name, n in zip(names, np.bincount(codes, minlength=len(names)).tolist(), strict=True):
                chunks[name] += n
            if len(chunks) > MOST_CHUNKS:
                yield count(chunks)
                chunks.clear()
        yield count(chunks)

    found = arrow.map_batches(docs.select("text"), run, schema)
    return found.groupBy("gram", "word").agg(F.sum("n").alias("n"))


def word_ratios(
    spark: SparkSession, labelled: DataFrame, corpus: DataFrame, beginning: int | None = None
) -> dict[str, float]:
    """Log-likelihood ratios of the words of the labelled documents, or of their beginnings; 0 ones left out.

    Both classes back off to shared counts of the whole ``corpus`` (stored ``corpus_grams``): a word to its
    share of all words, a beginning to its share of all different words, as Kneser-Ney counts
    continuations. A ratio counts in part, down to nothing where ``ERRORS`` standard errors of the two
    counts explain it. Only words that say something reach the driver.
    """
    counts = stored(spark, word_counts(labelled, beginning), "words")
    sums = counts.agg(
        *[F.sum(kind).alias(kind) for kind in ("toxic", "ordinary")],
        *[F.count_if(F.col(kind) > 0).alias(f"{kind}_kinds") for kind in ("toxic", "ordinary")],
    ).first()
    if not sums["toxic"] or not sums["ordinary"]:
        return {}
    known = corpus.where("word").select(F.col("gram").alias("word"), "n")
    if beginning is not None:
        known = known.where(F.length("word") >= beginning)
        known = known.groupBy(F.left("word", F.lit(beginning)).alias("word")).agg(F.count(F.lit(1)).alias("n"))
    total = known.agg(F.sum("n").alias("n")).first()["n"]
    odds = F.log((F.col("toxic") + 0.5) / (F.col("ordinary") + 0.5)) - math.log(sums["toxic"] / sums["ordinary"])
    error = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("ordinary") + 0.5))
    told = counts.withColumn("weight", 1 - ERRORS * error / F.abs(odds)).where("weight > 0")
    shared = known.select("word", (F.col("n") / total).alias("share"))

    def probability(kind: str) -> F.Column:
        own = F.greatest(F.col(kind) - DISCOUNT, F.lit(0)) / sums[kind]
        return own + DISCOUNT * sums[f"{kind}_kinds"] / sums[kind] * F.col("share")

    ratio = F.col("weight") * F.log(probability("toxic") / probability("ordinary"))
    found = told.join(shared, "word").select("word", ratio.alias("ratio")).toArrow()  # bounded by the labelled rows
    return dict(zip(found.column("word").to_pylist(), found.column("ratio").to_pylist(), strict=True))


def shared_backoff(
    spark: SparkSession, docs: DataFrame, pairs: list[str], corpus: DataFrame | None = None
) -> dict[str, float]:
    """Shared probability of the second character of each pair behind the first.

    Counts are over all documents, or taken from their stored ``corpus_grams``; only the asked pairs,
    which the labelled sample bounds, and their sums reach the driver.
    """
    all_grams = (corpus or stored(spark, corpus_grams(docs), "grams")).where("not word")
    first = F.col("gram").startswith(BEGIN) & (F.length("gram") == 2)
    two = (
        all_grams.select(
            F.when(first, F.col("gram")).otherwise(F.expr("right(gram, 2)")).alias("pair"),
            F.when(first, F.col("n")).otherwise(F.lit(1)).alias("n"),
        )
        .groupBy("pair")
        .agg(F.sum("n").alias("n"))
        .withColumns({"context": F.expr("left(pair, 1)"), "next": F.expr("right(pair, 1)")})
    )
    two = stored(spark, two, "pairs")
    contexts = two.groupBy("context").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"))
    singles = two.groupBy("next").agg(F.count(F.lit(1)).alias("single"))
    sums = singles.agg(F.sum("single").alias("total"), F.count(F.lit(1)).alias("kinds")).first()
    asked = F.broadcast(spark.createDataFrame(pa.table({"pair": pa.array(pairs, pa.string())})))
    out = {}
    for row in two.join(asked, "pair").join(contexts, "context").join(singles, "next").toLocalIterator():
        floor = DISCOUNT * sums["kinds"] / sums["total"] / (sums["kinds"] + 1)
        single = max(row["single"] - DISCOUNT, 0) / sums["total"] + floor
        out[row["pair"]] = (
            max(row["n"] - DISCOUNT, 0) + DISCOUNT * row["kinds"] * single
        ) / row["total"]
    return out


class ClassModel:
    """Interpolated Kneser-Ney of one class above the shared orders."""

    def __init__(self, longest: dict[str, int], shared: dict[str, float]):
        self.shared = shared
        counts: list[dict[str, int]] = [{} for _ in range(ORDER + 1)]
        for gram, n in longest.items():
            counts[len(gram)][gram] = n  # shorter ones begin their word and keep their frequency
        for order in range(ORDER - 1, SHARED, -1):
            for gram in counts[order + 1]:
                counts[order][gram[1:]] = counts[order].get(gram[1:], 0) + 1
        self.counts = {g: n for order in counts[SHARED + 1 :] for g, n in order.items()}
        self.total: Counter = Counter()
        self.kinds: Counter = Counter()
        for gram, n in self.counts.items():
            self.total[gram[:-1]] += n
            self.kinds[gram[:-1]] += 1

    def backoff(self, context: str) -> float:
        total = self.total.get(context)
        return DISCOUNT * self.kinds[context] / total if total else 1.0

    def probability(self, gram: str) -> float:
        if len(gram) <= SHARED:
            return self.shared.get(gram, 1e-6)
        lower = self.backoff(gram[:-1]) * self.probability(gram[1:])
        n = self.counts.get(gram)
        return lower + max(n - DISCOUNT, 0) / self.total[gram[:-1]] if n else lower


class Ratios:
    """Log-likelihood ratios of grams and back-offs, and of whole words, for scoring words."""

    def __init__(
        self,
        toxic: ClassModel,
        ordinary: ClassModel,
        whole: dict[str, float] | None = None,
        beginnings: dict[str, float] | None = None,
    ):
        self.whole, self.beginnings = whole or {}, beginnings or {}
        known = toxic.counts.keys() | ordinary.counts.keys()
        self.gram = {g: math.log(toxic.probability(g) / ordinary.probability(g)) for g in known}
        self.backoff = {
            h: math.log(toxic.backoff(h) / ordinary.backoff(h)) for h in toxic.total.keys() | ordinary.total.keys()
        }

    def last(self, gram: str) -> float:
        """Ratio of the last character behind the others, over as many of them as either class knows."""
        total = 0.0
        while len(gram) > SHARED:
            ratio = self.gram.get(gram)
            if ratio is not None:
                return total + ratio
            total += self.backoff.get(gram[:-1], 0.0)
            gram = gram[1:]
        return total

    def word(self, word: str) -> float:
        """Ratio of a whole word, of its beginning where the word itself says nothing, or 0."""
        ratio = self.whole.get(word)
        return self.beginnings.get(word[:BEGINNING], 0.0) if ratio is None and len(word) >= BEGINNING else ratio or 0.0


class Scorer:
    """Scores of words and texts under a model, with what a task has met so far."""

    def __init__(self, ratios: Ratios):
        self.ratios = ratios
        self.told: dict[str, float] = {}
        self.memo = Memo(self.chunks, MOST_MEMO)

    def word(self, word: str) -> float:
        marked, total, told = BEGIN + word + END, 0.0, self.told
        for i in range(1, len(marked)):
            gram = marked[max(0, i - ORDER + 1) : i + 1]
            ratio = told.get(gram)
            if ratio is None:
                ratio = told[gram] = self.ratios.last(gram)
            total += ratio
        if len(told) > MOST_CHUNKS:
            told.clear()
        return total

    def chunks(self, names: list[str]) -> list[tuple[float, float, int]]:
        """Ratio by characters, ratio by words and number of words of each chunk."""
        split = [WORD.findall(name) for name in names]
        return [(sum(map(self.word, each)), sum(map(self.ratios.word, each)), len(each)) for each in split]

    def values(self, strings: pa.Array) -> np.ndarray:
        """Mean ratio by characters, and ratios by words over the root of their number; 0 without words.

        Chance adds up like the square root, so a few telling words count in long texts too.
        """
        rows, names, codes = words(strings)
        found = np.array(self.memo.get(names), np.float64).reshape(-1, 3)
        sums = [np.bincount(rows, found[codes, i], minlength=len(strings)) for i in range(3)]
        counts = np.maximum(sums[2], 1)
        return np.stack([sums[0] / counts, sums[1] / np.sqrt(counts)], axis=1)

    def documents(self, strings: pa.Array) -> np.ndarray:
        """Mean ratio by characters per word; 0 for a text without words."""
        return self.values(strings)[:, 0]


def logistic(values: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Slopes and offset of a logistic curve, by Newton steps with a weak pull to zero."""
    x = np.column_stack([values, np.ones(len(values))])
    at = np.zeros(x.shape[1])
    pull = np.eye(x.shape[1]) * 1e-3
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        step = np.linalg.solve(x.T * (p * (1 - p)) @ x + pull, x.T @ (labels - p) - pull @ at)
        at = at + np.clip(step, -5, 5)
    return at


def held_out(doc_id) -> F.Column:
    """Whether crc32 of the id's text leaves 1 when divided by 3; such rows are never learned from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, most: int) -> DataFrame:
    """Text and label of at most ``most`` ids outside the held-out part; ``tuning`` marks a quarter.

    Rows that repeat an id and its text count once. An id with several labels gets the larger one; ids and labels that are null teach nothing.
    """
    ids = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out("doc_id"))
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    tuning = F.pmod(F.xxhash64("doc_id", F.lit("tuning")), F.lit(4)) == 0
    found = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").distinct()
    return found.select("text", "toxic", tuning.alias("tuning"))


def _values(labelled: DataFrame, shared) -> DataFrame:
    """Label and both values of every row."""

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in arrow.text_slices(batches, limit=arrow.SLICE_BYTES):
            values = scorer.values(arrow.texts(batch))
            yield arrow.table(VALUES, toxic=batch.column("toxic"), characters=values[:, 0], words=values[:, 1])

    return arrow.map_batches(labelled.select("text", "toxic"), run, VALUES)


def _scores(docs: DataFrame, shared, curve: np.ndarray, column: str) -> DataFrame:
    """``docs`` with the score of ``text`` in ``column``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(docs.schema).append(pa.field(column, pa.float64()))

    def run(batches):
        scorer = Scorer(shared.value)
        for batch in arrow.text_slices(batches, limit=arrow.SLICE_BYTES):
            values = scorer.values(arrow.texts(batch))
            score = 1 / (1 + np.exp(-np.clip(values @ curve[:-1] + curve[-1], -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], schema=schema)

    return arrow.map_batches(docs, run, schema)


def score_toxicity(
    spark: SparkSession, docs: DataFrame, labels: DataFrame, column: str = "score", most: int = MAX_LABELLED
) -> DataFrame:
    """``docs`` with a toxicity score from 0 to 1 in ``column``, which must not be among its columns.

    Labels are taken only from rows outside ``held_out``, at most ``most`` of them; the shared
    back-off counts cover all documents. Null and empty texts, and texts without words, get the score of
    ratios of 0. Without labels of both classes every score is the share of toxic labels
    (0 without any). Every row and column stays, repeated rows too; scores use the text alone.
    """
    sample = stored(spark, labelled_sample(docs, labels, most), "labelled")
    sizes = {(r["tuning"], r["toxic"] == 1): r["n"] for r in sample.groupBy("tuning", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    toxic, ordinary = (sum(n for (_, t), n in sizes.items() if t == kind) for kind in (True, False))
    if not sizes.get((False, True)) or not sizes.get((False, False)):
        return docs.withColumn(column, F.lit(toxic / max(1, toxic + ordinary)))
    learned = sample.where("not tuning")
    counts = class_counts(learned).toArrow()  # bounded by ``most``
    names = counts.column("gram").to_pylist()
    pairs = sorted({g[-SHARED:] for g in names})
    corpus = stored(spark, corpus_grams(docs), "grams")
    shared = shared_backoff(spark, docs, pairs, corpus)
    models = [
        ClassModel({g: n for g, n in zip(names, counts.column(kind).to_pylist(), strict=True) if n}, shared)
        for kind in ("toxic", "ordinary")
    ]
    told = word_ratios(spark, learned, corpus), word_ratios(spark, learned, corpus, BEGINNING)
    ratios = spark.sparkContext.broadcast(Ratios(*models, *told))
    tuned = sample.where("tuning") if sizes.get((True, True)) and sizes.get((True, False)) else sample
    told = _values(tuned, ratios).toArrow()
    values = np.stack([told.column(name).to_numpy() for name in ("characters", "words")], axis=1)
    curve = logistic(values, (told.column("toxic").to_numpy() == 1).astype(float))
    return _scores(docs, ratios, curve, column)


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document; rejected from ``THRESHOLD`` on."""
    scored = score_toxicity(spark, docs.select("doc_id", "text"), labels)
    return scored.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
