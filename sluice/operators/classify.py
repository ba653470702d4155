"""Bag-of-words baselines for document classes, on Spark ML: TF-IDF of word or character n-grams
with logistic regression, linear SVMs one against the rest, or naive Bayes, cross-validated.

Features are hashed, so the vocabulary never meets the driver. Folds are stratified exactly, by
ranks that no task takes for a whole class; models and out-of-fold predictions are kept in the
shared folder, so that what is returned holds no fitted model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes, OneVsRest
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer, StringIndexer
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_WORDS = "filter(split(lower(text), '[^\\\\p{L}\\\\p{N}]+'), w -> w <> '')"
#: Terms by kind of n-gram, over column text.
TERMS = {
    "word 1": f"SELECT *, {_WORDS} AS terms FROM __THIS__",
    "word 1-2": f"SELECT *, concat(w, zip_with(slice(w, 1, greatest(size(w) - 1, 0)), slice(w, 2, size(w)), (a, b) -> concat(a, ' ', b))) AS terms FROM (SELECT *, {_WORDS} AS w FROM __THIS__)",
    # joined from single characters: a substring by its place would be sought from the text's start
    "char 3-5": "SELECT *, flatten(transform(sequence(3, 5), n -> CASE WHEN size(c) >= n THEN transform(sequence(0, size(c) - n), i -> concat(c[i], c[i + 1], c[i + 2], CASE WHEN n > 3 THEN c[i + 3] ELSE '' END, CASE WHEN n > 4 THEN c[i + 4] ELSE '' END)) ELSE array() END)) AS terms FROM (SELECT *, filter(split(lower(regexp_replace(text, '\\\\s+', ' ')), ''), x -> x <> '') AS c FROM __THIS__)",
}
#: The shortest and the longest n-gram of kinds whose terms are counted from the text's bytes, and the text that they are of.
CHARS = {"char 3-5": (3, 5)}
_CHARS_OF = "lower(regexp_replace(text, '\\\\s+', ' '))"
#: Parts a class is dealt to on the way to its ranks.
PARTS = 256
#: Texts whose counts go to Spark at once, and bytes of a row group of counts: what a task holds of them, writing and reading.
TEXTS, GROUP = 256, 1 << 21


def counts(terms: str = "word 1-2", features: int = 1 << 12) -> PipelineModel:
    """Term counts of a text, ``tf``: nothing in it is fitted, so they are the same for all folds."""
    return PipelineModel([SQLTransformer(statement=TERMS[terms]), HashingTF(inputCol="terms", outputCol="tf", numFeatures=features)])


def _mixed(k: np.ndarray) -> np.ndarray:
    k = k * np.uint32(0xCC9E2D51)
    return (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)


def _char_counts(text: bytes, shortest: int, longest: int, features: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and counts by HashingTF's hash (32-bit Murmur 3, seed 42) of a UTF-8 text's n-grams of characters: all at once,
    none is made a string."""
    b = np.frombuffer(text + bytes(4), np.uint8).astype(np.uint32)
    words = b[:-3] | b[1:-2] << np.uint32(8) | b[2:-1] << np.uint32(16) | b[3:] << np.uint32(24)
    starts = np.append(np.flatnonzero((b[:-4] & 0xC0) != 0x80), len(text))
    sizes = [n for n in range(shortest, longest + 1) if n < len(starts)]
    if not sizes:
        return np.zeros(0, np.int32), np.zeros(0, np.float64)
    at = np.concatenate([starts[:-n] for n in sizes])
    size = np.concatenate([starts[n:] for n in sizes]) - at
    h = np.full(len(at), 42, np.uint32)
    for k in range(int(size.max()) // 4):
        has = size >= 4 * (k + 1)
        mixed = h[has] ^ _mixed(words[at[has] + 4 * k])
        h[has] = (mixed << np.uint32(13) | mixed >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
    rest = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF], np.uint32)[size & 3]
    h ^= _mixed(words[at + (size & ~3)] & rest) ^ size.astype(np.uint32)
    h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
    h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
    tally = np.bincount((h ^ h >> np.uint32(16)).view(np.int32) % features)
    places = np.flatnonzero(tally)
    return places.astype(np.int32), tally[places].astype(np.float64)


def _vectors(texts: pa.Array, shortest: int, longest: int, features: int) -> pa.Array:
    """Sparse vectors, as VectorUDT lays them out, of the counts of texts."""
    places, values = zip(*(_char_counts(t, shortest, longest, features) for t in texts.cast(pa.binary()).to_pylist()))
    ends = np.cumsum([0, *map(len, places)], dtype=np.int32)
    lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (places, values)]
    fixed = [pa.array(np.full(len(places), x, kind)) for x, kind in ((0, np.int8), (features, np.int32))]
    return pa.StructArray.from_arrays([*fixed, *lists], names=["type", "size", "indices", "values"])


def counted(rows: DataFrame, terms: str, features: int = 1 << 12) -> DataFrame:
    """rows (..., text) with the counts of their terms, ``tf``, instead of the text: those of ``counts``, whatever the way."""
    if terms not in CHARS:
        return counts(terms, features).transform(rows).select(*(c for c in rows.columns if c != "text"), "tf")
    source = rows.withColumn("text", F.expr(_CHARS_OF)).select(*(c for c in rows.columns if c != "text"), "text")
    shortest, longest = CHARS[terms]

    def run(batches):
        for whole in batches:
            for start in range(0, whole.num_rows, TEXTS):
                batch = whole.slice(start, TEXTS)
                *others, texts = batch.columns
                yield pa.RecordBatch.from_arrays([*others, _vectors(texts, shortest, longest, features)], names=[*batch.schema.names[:-1], "tf"])

    return source.mapInArrow(run, StructType(source.schema.fields[:-1]).add("tf", VectorUDT()))


def model(kind: str, classes: int = 3) -> Pipeline:
    svm = LinearSVC(maxIter=30, regParam=0.01, labelCol="y", featuresCol="x")
    learners = {
        "logistic": LogisticRegression(labelCol="y", featuresCol="x", maxIter=20, regParam=0.01),
        "svm": svm if classes == 2 else OneVsRest(classifier=svm, labelCol="y", featuresCol="x"),
        "bayes": NaiveBayes(labelCol="y", featuresCol="x", smoothing=0.2),
    }
    return Pipeline(stages=[IDF(inputCol="tf", outputCol="x"), learners[kind]])


def with_folds(docs: DataFrame, key: str, label: str, folds: int) -> DataFrame:
    """docs with column ``fold``: of each class every fold has as many rows, give or take one. A row's
    rank in its class is the size of the parts before its own and its rank there, so the
    largest task ranks a part of a class."""
    part = F.pmod(F.xxhash64(key), F.lit(PARTS))
    dealt = docs.withColumn("_part", part)
    sizes = dealt.groupBy(label, "_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(label).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select(F.col(label).alias("_label"), F.col("_part").alias("_of"), F.coalesce(before, F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy(label, "_part").orderBy(F.xxhash64(key), key))
    ranked = dealt.withColumn("_place", place).join(starts, F.col(label).eqNullSafe(F.col("_label")) & (F.col("_part") == F.col("_of")))
    return ranked.withColumn("fold", ((F.col("_start") + F.col("_place")) % folds).cast("int")).drop("_part", "_place", "_label", "_of", "_start")


def out_of_fold(docs: DataFrame, key: str, label: str, kinds: dict[str, tuple[str, str]], root: str, folds: int = 2) -> DataFrame:
    """(model, fold, key, label, predicted) of docs (key, text, label) with a text and a label, kept as a table
    under ``root``, a folder that all executors share. Rows of one key share a fold; folds are dealt without the texts,
    which docs already dealt by key move no more."""
    spark = docs.sparkSession
    kept = docs.select(key, "text", label).filter(F.col("text").isNotNull() & F.col(label).isNotNull())
    dealt = with_folds(kept.groupBy(key).agg(F.min(label).alias(label)), key, label, folds).select(key, "fold")
    kept.join(dealt, key, "left").withColumn("fold", F.coalesce("fold", F.lit(0))).write.parquet(f"{root}/rows")
    rows = spark.read.parquet(f"{root}/rows")
    indexer = StringIndexer(inputCol=label, outputCol="y", stringOrderType="alphabetAsc").fit(rows)
    names = F.array(*(F.lit(x) for x in indexer.labels))
    for n, terms in enumerate(used := sorted({t for _, t in kinds.values()})):  # counted once, read by every pass of every fold
        tallied = counted(indexer.transform(rows), terms).select("fold", key, label, "y", "tf")
        tallied.write.option("parquet.block.size", GROUP).parquet(f"{root}/counts-{n}")
    for parts, (name, (kind, terms)) in enumerate(kinds.items()):
        indexed = spark.read.parquet(f"{root}/counts-{used.index(terms)}")
        for k in range(folds):
            fitted = model(kind, classes=len(indexer.labels)).fit(indexed.filter(F.col("fold") != k))
            # as kept, a model has no training summary, which would take the session to the executors with it
            at = f"{root}/models/{parts}-{k}"
            fitted.write().save(at)
            fitted = PipelineModel.load(at)
            scored = fitted.transform(indexed.filter(F.col("fold") == k))
            scored.select(F.lit(name).alias("model"), "fold", key, label, F.get(names, F.col("prediction").cast("int")).alias("predicted")).write.mode("append").parquet(f"{root}/scores")
    return spark.read.parquet(f"{root}/scores")


def cross_validate(docs: DataFrame, key: str, label: str, kinds: dict[str, tuple[str, str]], root: str, folds: int = 2) -> DataFrame:
    """(model, n, correct) of the out-of-fold predictions."""
    scores = out_of_fold(docs, key, label, kinds, root, folds)
    return scores.groupBy("model").agg(F.count("*").alias("n"), F.count_if(F.col("predicted") == F.col(label)).alias("correct"))
