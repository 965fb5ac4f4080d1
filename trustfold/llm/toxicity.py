"""Toxicity score: gradient-boosted trees over dense text features, with isotonic calibration.

* Features of a whole text, one pass in tasks: densities of a seed lexicon
  and of a lexicon learned from the training labels, how near such words
  stand to words of the second person, shares of capitals, punctuation and
  digits, shouting, repeated letters and words, obfuscated spellings
  (letters replaced by signs or digits, letters kept apart).
* The learned lexicon holds the words whose document frequency in toxic
  training documents exceeds what clean ones explain (log odds with a prior,
  at least ``min_support`` toxic documents); a word that stands in many
  documents on both sides never enters.
* Labels are split by crc32 of the id as text: remainder 0 modulo 5 is held
  out and never read by fitting; remainder 4 fits the calibration; 1 to 3
  fit lexicon and trees, the trees on features whose lexicon was learned
  without the row's own remainder.  Fitting takes at most ``max_fit_rows`` labelled
  documents (those with the smallest seeded hash); scoring takes all rows.
* Scores are the trees' probabilities through an isotonic (monotone)
  regression on the calibration rows, so 0.5 means that.

Labels, language, source and id are no features.  Cases: a null or empty
text has all features 0 and the score that the trees give it.  Several
labels of one id count as so many labelled rows, a null label as none.
Without both labels in the training rows the score is their mean (0.0
without any).  Extra columns are ignored by ``toxicity_scores`` and kept by
``drop_toxic``; repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trustfold.llm.tables import col, stored

#: Words of abuse to start from (fixed values); the labels add what they show.
SEEDS = frozenset("""
idiot idiots moron morons stupid dumb loser losers scum trash garbage pathetic worthless disgusting clown fool fools jerk
imbecile shut hate ugly liar coward vermin filth crap damn hell kill
idiota imbécil estúpido estúpida basura asqueroso odio mentiroso cobarde
idiote imbécile stupide ordure dégoûtant nul menteur lâche haine
dumm dummkopf trottel abschaum widerlich wertlos lügner feigling hass
""".split())
#: Second person, in the languages of the seeds (fixed values).
SECOND = frozenset("you your yours yourself u ur tú tu usted vosotros te toi vous ton votre du dich dir dein ihr euch euer sie".split())
#: Signs and digits that stand for letters (fixed values).
_PLAIN = str.maketrans("013457@$!|", "oieastasil")

FEATURES = ("seed_density", "seed_any", "learned_density", "learned_any", "learned_weight", "learned_max", "near_second",
            "second_density", "upper_share", "shout_share", "punct_share", "digit_share", "exclaim_density", "question_density",
            "obfuscated_density", "masked_density", "spaced_letters", "stretched", "repeat_share", "distinct_share",
            "mean_word", "log_words", "log_chars", "line_length")

_WORD = re.compile(r"[^\W_]+(?:['’*@$!|][^\W_]+)*")
_MASKED = re.compile(r"[^\W\d_]+[*@$!|01345]+[^\W\d_]+")
_LETTERS = re.compile(r"(?:\b\w[ .\-_*]){3,}\w\b")
_SPLIT_MARKS = re.compile(r"['’*@$!|]")

# kinds of characters
_OTHER, _LOWER, _UPPER, _DIGIT, _SPACE = range(5)
_kinds: list[np.ndarray] = []


def _kind_table() -> np.ndarray:
    """Kind of every character of the basic plane (the last entry stands for those beyond)."""
    if not _kinds:
        _kinds.append(np.array([_SPACE if c.isspace() else _UPPER if c.isupper() else _LOWER if c.isalpha() else _DIGIT if c.isdigit() else _OTHER
                                for c in map(chr, range(0x10000))] + [_OTHER], np.uint8))
    return _kinds[0]


def words_in(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Reader:
    """Features of texts under one learned lexicon; what a token says is worked out once and kept (``KEEP`` tokens at most)."""

    KEEP = 50_000

    def __init__(self, learned: dict[str, float]):
        self.learned, self.tokens = learned, {}

    def _token(self, token: str) -> tuple:
        """(words, letters in them, second person, seed, learned, weight, obfuscated, masked) of a lower-case token."""
        words = _WORD.findall(token)
        second = seed = known = obfuscated = masked = 0
        weight = 0.0
        for w in words:
            plain = w
            if not w.isalpha() and (_SPLIT_MARKS.search(w) or any(c.isdigit() for c in w)):
                plain = w.translate(_PLAIN)
                masked += _MASKED.search(w) is not None
            second += w in SECOND
            value = self.learned.get(w) or self.learned.get(plain)
            bad = w in SEEDS or plain in SEEDS
            seed += bad
            if value:
                known += 1
                weight = max(weight, value)
            obfuscated += plain != w and bool(bad or value)
        told = (second, seed, known, weight, obfuscated, masked) if second or seed or known or masked else None
        return len(words), sum(map(len, words)), told

    def __call__(self, text: str | None) -> list[float]:
        """The values of FEATURES for one whole text (null counts as empty)."""
        if not text:
            return [0.0] * len(FEATURES)
        points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        kinds = _kind_table()[np.minimum(points, 0x10000)]
        other, lower, upper, digit, space = np.bincount(kinds, minlength=5).tolist()
        same = points[1:] == points[:-1]
        stretched = int(np.count_nonzero(same[1:] & same[:-1] & ((kinds[2:] == _LOWER) | (kinds[2:] == _UPPER))))
        tokens = text.lower().split()
        counts = Counter(tokens)
        known = self.tokens
        n = size = second = seed = shown = obfuscated = masked = 0
        weight = top = 0.0
        hot = False
        for token, c in counts.items():
            told = known.get(token)
            if told is None:
                told = self._token(token)
                if len(known) < self.KEEP:  # frequent tokens come early
                    known[token] = told
            n += c * told[0]
            size += c * told[1]
            if told[2]:
                you, bad, value, w, hidden, mask = told[2]
                second += c * you
                seed += c * bad
                shown += c * value
                weight += c * w
                top = max(top, w)
                obfuscated += c * hidden
                masked += c * mask
                hot = hot or bad or value
        near = self._near(tokens) if hot and second else 0
        shout = sum(t.isupper() and len(t) > 2 for t in text.split()) if upper > 2 else 0
        chars, letters, n, m = len(text), max(1, lower + upper), max(1, n), max(1, len(tokens))
        apart = len(_LETTERS.findall(text))
        return [seed / n, float(seed > 0), shown / n, float(shown > 0), weight / n, top, near / n, second / n,
                upper / letters, shout / m, other / chars, digit / chars, text.count("!") / n, text.count("?") / n,
                obfuscated / n, masked / n, apart / n, stretched / chars, max(counts.values(), default=0) / m, len(counts) / m,
                size / n, float(np.log1p(n)), float(np.log1p(chars)), chars / (text.count("\n") + 1)]

    def _near(self, tokens: list[str]) -> int:
        """Lexicon words with a second-person word at most five tokens away."""
        told = [self.tokens.get(t) or self._token(t) for t in tokens]
        you = np.array([i for i, x in enumerate(told) if x[2] and x[2][0]])
        bad = np.array([i for i, x in enumerate(told) if x[2] and (x[2][1] or x[2][2])])
        right = np.searchsorted(you, bad)
        before = bad - you[np.maximum(right - 1, 0)]
        after = you[np.minimum(right, len(you) - 1)] - bad
        return int(np.count_nonzero(((right > 0) & (before <= 5)) | ((right < len(you)) & (after <= 5))))


def features(text: str | None, learned: dict[str, float]) -> list[float]:
    """The values of FEATURES for one text."""
    return Reader(learned)(text)


def _score_features(learned, at: int | None = None):
    """Features behind the columns of each row; its text is column ``at``, or else the last one, which goes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        read = Reader(learned.value)
        for b in batches:
            for start in range(0, b.num_rows, 256):
                part = b.slice(start, 256)
                rows = [read(t.as_py()) for t in part.column(b.num_columns - 1 if at is None else at)]
                flat = pa.array([x for r in rows for x in r], pa.float64())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, len(FEATURES), dtype=np.int32)), flat)
                kept = b.num_columns - (at is None)
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], lists], names=[*b.schema.names[:kept], "features"])

    return run


#: Words that a task counts before it sends their counts on (some 150 bytes each).
COUNTED_WORDS = 100_000
_TOXIC = 1 << 32


def _document_words(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct words of each labelled text, counted over the task: (word, toxic documents, clean documents)."""
    total: dict[str, int] = {}  # toxic documents in the upper 32 bits, clean ones in the lower
    for b in batches:
        for label, text in zip(b.column(0), b.column(1)):
            one = _TOXIC if label.as_py() else 1
            for w in set(words_in(text.as_py() or "")):
                total[w] = total.get(w, 0) + one
            if len(total) > COUNTED_WORDS:
                yield _counted(total)
                total = {}
    yield _counted(total)


def _counted(total: dict[str, int]) -> pa.RecordBatch:
    counts = np.fromiter(total.values(), np.int64, len(total))
    return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(counts >> 32), pa.array(counts & (_TOXIC - 1))],
                                      names=["word", "toxic", "clean"])


def fold(id_column: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(id_column.cast("string"), F.lit(""))), F.lit(5))


def learn_lexicon(labelled: DataFrame, *, min_support: int = 5, min_log_odds: float = 2.0, most: int = 2000) -> dict[str, float]:
    """Words of toxic documents and their log odds; ``labelled`` has toxic (0/1) and text.  ``most`` bounds the result."""
    sums = labelled.groupBy("toxic").count().collect()
    n = {int(r["toxic"]): r["count"] for r in sums}
    bad, good = n.get(1, 0), n.get(0, 0)
    if not bad or not good:
        return {}
    words = (labelled.select("toxic", "text").mapInArrow(_document_words, "word string, toxic long, clean long")
             .groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(F.col("toxic") >= min_support))
    prior = 0.5
    odds = F.log((F.col("toxic") + prior) / (bad + 2 * prior)) - F.log((F.col("clean") + prior) / (good + 2 * prior))
    # the difference must also stand out from its own noise
    noise = F.sqrt(1 / (F.col("toxic") + prior) + 1 / (F.col("clean") + prior))
    kept = (words.withColumn("odds", odds).filter(F.col("odds") >= min_log_odds).filter(F.col("odds") >= 2.5 * noise)
            .orderBy(F.desc("odds"), "word").limit(most))
    return {r["word"]: r["odds"] for r in kept.collect()}


class Scorer:
    """Trees and calibration fitted by Spark ML."""

    def __init__(self, trees, isotonic, constant: float):
        self.trees, self.isotonic, self.constant = trees, isotonic, constant

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` with features (array) -> the same rows with score instead."""
        if self.trees is None:
            return df.withColumn("score", F.lit(self.constant)).drop("features")
        from pyspark.ml.functions import vector_to_array

        raw = self.trees.transform(_vector(df))
        raw = raw.withColumn("raw", vector_to_array("probability")[1]).drop("features", "rawPrediction", "probability", "prediction")
        out = self.isotonic.transform(raw) if self.isotonic else raw.withColumn("calibrated", F.col("raw"))
        return out.withColumn("score", F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("calibrated")))).drop("raw", "calibrated")


def _vector(df: DataFrame) -> DataFrame:
    from pyspark.ml.functions import array_to_vector

    return df.withColumn("features", array_to_vector("features"))


def fit(featured: DataFrame, *, trees: int = 30, depth: int = 4, step: float = 0.25, seed: int = 5) -> Scorer:
    """Fit on rows (fold, toxic, features); fold 4 calibrates, the others grow the trees."""
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import IsotonicRegression

    rows = featured.withColumn("toxic", F.col("toxic").cast("double"))
    counts = {(r["calibrate"], r["toxic"]): r["n"] for r in
              rows.groupBy((F.col("fold") == 4).alias("calibrate"), "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    grown = {t: counts.get((False, t), 0) for t in (0.0, 1.0)}
    if not grown[0.0] or not grown[1.0]:
        n = sum(counts.values())
        return Scorer(None, None, sum(v for (_, t), v in counts.items() if t == 1.0) / n if n else 0.0)
    model = GBTClassifier(labelCol="toxic", featuresCol="features", maxIter=trees, maxDepth=depth, stepSize=step, seed=seed,
                          minInstancesPerNode=5, subsamplingRate=0.8, checkpointInterval=-1).fit(_vector(rows.filter("fold <> 4")))
    isotonic = None
    if counts.get((True, 1.0)) and counts.get((True, 0.0)):
        held = model.transform(_vector(rows.filter("fold = 4"))).withColumn("raw", vector_to_array("probability")[1])
        isotonic = IsotonicRegression(labelCol="toxic", featuresCol="raw", predictionCol="calibrated").fit(held.select("toxic", "raw"))
    return Scorer(model, isotonic, 0.0)


def _fitted(docs: DataFrame, labels: DataFrame, max_fit_rows: int):
    """Lexicon and scorer from the labelled rows that are not held out."""
    spark = docs.sparkSession
    wanted = (labels.filter("toxic is not null and id is not null").select("id", F.col("toxic").cast("int").alias("toxic"), fold(F.col("id")).alias("fold"))
              .filter("fold <> 0"))
    wanted = wanted.orderBy(F.xxhash64(F.lit(11), "id"), "id", "toxic").limit(max_fit_rows)
    # at most max_fit_rows short rows are sent, so that no text is shuffled to find its label
    rows = stored(docs.select("id", "text").join(F.broadcast(wanted), "id").select("toxic", "fold", "text"), "toxicity_fit")
    shared = spark.sparkContext.broadcast(learn_lexicon(rows.filter("fold <> 4")))
    schema = T.StructType([T.StructField("toxic", T.IntegerType()), rows.schema["fold"], T.StructField("features", T.ArrayType(T.DoubleType()))])
    # rows that grow the trees meet a lexicon learned without their fold, as any other text meets one learned without it
    featured = rows.filter("fold = 4").mapInArrow(_score_features(shared), schema)
    for f in (1, 2, 3):
        others = spark.sparkContext.broadcast(learn_lexicon(rows.filter(~F.col("fold").isin(f, 4))))
        featured = featured.union(rows.filter(F.col("fold") == f).mapInArrow(_score_features(others), schema))
    return shared, fit(stored(featured, "toxicity_features"))


def _plain(docs: DataFrame, labels: DataFrame, id_column: str, text_column: str):
    return (docs.select(col(id_column).alias("id"), col(text_column).cast("string").alias("text")),
            labels.select(col(id_column).alias("id"), col("toxic").alias("toxic")))


def toxicity_scores(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
                    max_fit_rows: int = 20_000) -> DataFrame:
    """Return per row of ``docs``: id, held_out, score, predicted."""
    plain, marks = _plain(docs, labels, id_column, text_column)
    lexicon, scorer = _fitted(plain, marks, max_fit_rows)
    schema = T.StructType([plain.schema["id"], T.StructField("features", T.ArrayType(T.DoubleType()))])
    scored = scorer.score(plain.mapInArrow(_score_features(lexicon), schema))
    return scored.select(F.col("id").alias(id_column), (fold(F.col("id")) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, *, id_column: str = "doc_id", text_column: str = "text",
               reject_from: float = 0.5, max_fit_rows: int = 20_000) -> DataFrame:
    """The rows of ``docs`` that score below ``reject_from``, all columns kept; nothing is shuffled for it, and each text goes to Python once."""
    plain, marks = _plain(docs, labels, id_column, text_column)
    lexicon, scorer = _fitted(plain, marks, max_fit_rows)
    names = [f"_{i}" for i in range(len(docs.columns))]
    rows = docs.toDF(*names)  # names of any kind: Arrow functions resolve them as text
    at = docs.columns.index(text_column) if text_column in docs.columns else -1
    if at < 0 or rows.schema[at].dataType != T.StringType():
        at, rows = len(names), docs.select("*", col(text_column).cast("string")).toDF(*names, "text")
    schema = T.StructType([*rows.schema.fields, T.StructField("features", T.ArrayType(T.DoubleType()))])
    scored = scorer.score(rows.mapInArrow(_score_features(lexicon, at), schema))
    return scored.filter(F.col("score") < reject_from).select(*(F.col(x).alias(c) for x, c in zip(names, docs.columns)))
