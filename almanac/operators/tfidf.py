"""Term counts, TF-IDF weights and the two leading principal components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DateType

from almanac.functions import text
from almanac.operators.keyed import PARTITION_ROWS, broadcast_days, hot_keys, lookup_join, split_join
from almanac.session import settle

LEMMA_BROADCAST_ROWS = 1_000_000
VOCABULARY_BROADCAST_ROWS = 1_000_000
TASK_BYTES = 4 << 20
COMPONENTS = 2
MOST_DOCS = 100_000
CHUNK_DOCS = 1024
PRODUCT_TASKS = 512
GRAM_DOCS = 4096
GRAM_ROWS = 64
GRAM_BYTES = 2 << 30
WIDE_WORDS = 512
PAIRS = 1 << 20
EXTRA_DIRECTIONS = 30
BASIS_BLOCKS = 6
MAX_ROUNDS = 100
TOLERANCE = 1e-9


def token_rows(df: DataFrame, doc: str, content: str) -> DataFrame:
    """(doc, token), one row per word occurrence; nothing is shuffled."""
    return df.select(doc, F.explode(text.tokens(F.col(content))).alias("token"))


def by_document(df: DataFrame, doc: str, content: str, marks: DataFrame | None = None) -> DataFrame:
    """Lay whole texts out by document, so that nothing per document is shuffled once words are rows.

    A text is the smallest form of its words. A task gets about TASK_BYTES of text, so that its words, many times as
    large, stay in memory. `marks`, rows (doc, token, mark) of what is known of some words of a document, are laid
    out with the texts: the frame is then (doc, content, token, mark), with the last two NULL in rows of texts.
    Days are left as they are: one may hold a third of all texts, and the map-side combine of its words does the
    work instead.
    """
    if isinstance(df.schema[doc].dataType, DateType):
        return df
    size = df.agg(F.coalesce(F.sum(F.octet_length(content).cast("long")), F.lit(0))).first()[0]
    tasks = max(df.sparkSession.sparkContext.defaultParallelism, -(-size // TASK_BYTES))
    if marks is not None:
        none = F.lit(None)
        texts = df.select(doc, content, none.cast("string").alias("token"), none.cast(marks.schema["mark"].dataType).alias("mark"))
        df = texts.unionByName(marks.select(doc, none.cast(df.schema[content].dataType).alias(content), "token", "mark"))
    return df.repartition(tasks, doc)


def distinct_words(df: DataFrame, doc: str, content: str) -> DataFrame:
    """(doc, token): each text's words once; nothing is shuffled."""
    return df.select(doc, F.explode(F.array_distinct(text.tokens(F.col(content)))).alias("token"))


def document_frequencies(df: DataFrame, content: str) -> DataFrame:
    """(token, df), settled: each text counts its distinct words itself, so only words are shuffled."""
    words = df.select(F.explode(F.array_distinct(text.tokens(F.col(content)))).alias("token"))
    kept = words.where(F.length("token") >= text.MIN_TERM_LENGTH)
    return settle(kept.groupBy("token").agg(F.count(F.lit(1)).alias("df")))


def lemma_counts(counts: DataFrame, lemmas: DataFrame, doc: str) -> DataFrame:
    """Counts per lemma from counts per token: the lookup runs on already aggregated rows."""
    merged = lookup_join(counts, lemmas.select("token", "lemma"), "token", LEMMA_BROADCAST_ROWS)
    return merged.groupBy(doc, F.coalesce("lemma", "token").alias("token")).agg(F.sum("tf").alias("tf"))


def term_counts(df: DataFrame, doc: str, content: str, lemmas: DataFrame | None = None) -> DataFrame:
    """(doc, token, tf) of words with two or more characters, as lemmas where a lemma table is given."""
    return word_counts(token_rows(by_document(df.select(doc, content), doc, content), doc, content), doc, lemmas)


def word_counts(words: DataFrame, doc: str, lemmas: DataFrame | None = None) -> DataFrame:
    """`term_counts` of rows (doc, token), one a word occurrence.

    A lemma table that may be broadcast meets the words before they are counted, which spares a second shuffle.
    """
    if lemmas is not None and lemmas.limit(LEMMA_BROADCAST_ROWS + 1).count() <= LEMMA_BROADCAST_ROWS:
        met = words.join(F.broadcast(lemmas.select("token", "lemma")), "token", "left")
        words, lemmas = met.select(doc, F.coalesce("lemma", "token").alias("token")), None
    counts = words.groupBy(doc, "token").agg(F.count(F.lit(1)).alias("tf"))
    if lemmas is not None:
        counts = lemma_counts(counts, lemmas, doc)
    return counts.where(F.length("token") >= text.MIN_TERM_LENGTH)


def lemmatised_text(
    df: DataFrame, doc: str, content: str, lemmas: DataFrame, broadcast_rows: int = LEMMA_BROADCAST_ROWS,
    partition_rows: int = PARTITION_ROWS,
) -> DataFrame:
    """(doc, processed_text): the words of a document replaced by their lemmas, in order; empty without words.

    A lemma table of at most `broadcast_rows` rows is broadcast. A larger one meets each document's distinct words in
    a shuffle, where a word of more than `partition_rows` documents is dealt over several tasks; only the lemmas that
    differ from their word go back to the documents.
    """
    texts, lemmas = df.select(doc, content), lemmas.select("token", "lemma")
    found = F.posexplode_outer(text.tokens(F.col(content))).alias("pos", "token")
    if lemmas.limit(broadcast_rows + 1).count() <= broadcast_rows:
        words = by_document(texts, doc, content).select(doc, found)
        met = words.join(F.broadcast(lemmas), "token", "left")
    else:
        words = distinct_words(texts, doc, content)
        known = split_join(words, lemmas, "token", hot_keys(words, "token", partition_rows))
        marks = known.where(F.col("lemma") != F.col("token")).select(doc, "token", F.col("lemma").alias("mark"))
        laid = by_document(texts, doc, content, marks)
        either = F.when(F.col("mark").isNull(), text.tokens(F.col(content))).otherwise(F.array("token"))
        words = laid.select(doc, "mark", F.posexplode_outer(either).alias("pos", "token"))
        met = words.withColumn("lemma", F.max("mark").over(W.partitionBy(doc, "token"))).where(F.col("mark").isNull())
    named = met.select(
        doc, F.struct("pos", F.coalesce("lemma", "token").alias("word")).alias("w")
    )
    # A group is one document, which was a single cell before.
    ordered = named.groupBy(doc).agg(F.array_sort(F.collect_list("w")).alias("ws"))
    return ordered.select(doc, text.token_text(F.col("ws")["word"]).alias("processed_text"))


def idf(df: Column, n_docs: Column | int) -> Column:
    return F.log((n_docs + F.lit(1.0)) / (df + 1.0)) + 1.0


def least_broadcast(frequencies: DataFrame) -> int:
    """The lowest df for which no more than VOCABULARY_BROADCAST_ROWS words of (token, df) have that much; 0 if all may."""
    if frequencies.limit(VOCABULARY_BROADCAST_ROWS + 1).count() <= VOCABULARY_BROADCAST_ROWS:
        return 0
    # One row per different df: their number is about the square root of the number of words, at most.
    sizes = frequencies.groupBy("df").count().withColumn("held", F.sum("count").over(W.orderBy(F.desc("df"))))
    return sizes.where(F.col("held") <= VOCABULARY_BROADCAST_ROWS).agg(F.coalesce(F.min("df"), F.lit(1 << 62))).first()[0]


def with_idf(counts: DataFrame, frequencies: DataFrame, n_docs: Column | int) -> DataFrame:
    """Adds df and idf to count rows; both frames are read more than once, so pass them settled.

    The most frequent words, nearly all rows, are met by a broadcast in place. Only rows of the words that a broadcast
    does not hold are shuffled; each of them is in few documents, as so many words are in more.
    """
    lookup, least = frequencies.withColumn("idf", idf(F.col("df"), n_docs)), least_broadcast(frequencies)
    often = F.broadcast(lookup.where(F.col("df") >= least))
    if not least:
        return counts.join(often, "token")
    seldom = counts.join(often.select("token"), "token", "left_anti").join(lookup.where(F.col("df") < least), "token")
    return counts.join(often, "token").unionByName(seldom)


def rare_marks(df: DataFrame, doc: str, content: str, frequencies: DataFrame, least: int) -> DataFrame | None:
    """(doc, token, mark): the df of the words of each document that a broadcast does not hold; None where it holds all."""
    if not least:
        return None
    words = distinct_words(df, doc, content).where(F.length("token") >= text.MIN_TERM_LENGTH)
    seldom = words.join(F.broadcast(frequencies.where(F.col("df") >= least).select("token")), "token", "left_anti")
    return seldom.join(frequencies.where(F.col("df") < least).withColumnRenamed("df", "mark"), "token").select(doc, "token", "mark")


def document_weights(df: DataFrame, doc: str, content: str) -> DataFrame:
    """(doc, token, tf, df, idf, weight) of whole texts, rows of unit length: `tfidf` for documents, any vocabulary.

    Only texts and the rare words of each document are shuffled; what is counted and weighed stays in place.
    """
    frequencies = document_frequencies(df, content)
    n_docs, least = df.count(), least_broadcast(frequencies)
    marks = rare_marks(df, doc, content, frequencies, least)
    if marks is None:
        words = token_rows(by_document(df.select(doc, content), doc, content), doc, content)
        words = words.select(doc, "token", F.lit(None).cast("long").alias("mark"))
    else:
        laid = by_document(df.select(doc, content), doc, content, marks)
        either = F.when(F.col("mark").isNull(), text.tokens(F.col(content))).otherwise(F.array("token"))
        words = laid.select(doc, "mark", F.explode(either).alias("token"))
    counts = words.where(F.length("token") >= text.MIN_TERM_LENGTH).groupBy(doc, "token").agg(
        F.count(F.when(F.col("mark").isNull(), 1)).alias("tf"), F.max("mark").alias("mark")
    )
    often = F.broadcast(frequencies.where(F.col("df") >= least))
    met = counts.join(often, "token", "left").withColumn("df", F.coalesce("mark", "df")).drop("mark").where(F.col("df").isNotNull())
    weighed = met.withColumn("idf", idf(F.col("df"), n_docs)).withColumn("weight", F.col("tf") * F.col("idf"))
    return _unit_length(weighed, doc)


def tfidf(counts: DataFrame, n_docs: Column | int, doc: str, frequencies: DataFrame | None = None) -> DataFrame:
    """(doc, token, tf, df, idf, weight) with rows of unit length, from (doc, token, tf).

    `n_docs` is the number of documents, those without words included: a number or a scalar column.
    Without `frequencies` (see `document_frequencies`) they are counted from `counts`, which should then
    be a settled frame, as it is for days. The rows of a word, one a day at most, then meet in one shuffle, and what
    groups them by word next finds them in place.
    """
    by_day = isinstance(counts.schema[doc].dataType, DateType)
    if frequencies is None and by_day:
        met = counts.withColumn("df", F.count(F.lit(1)).over(W.partitionBy("token"))).withColumn("idf", idf(F.col("df"), n_docs))
    else:
        if frequencies is None:
            frequencies = settle(counts.groupBy("token").agg(F.count(F.lit(1)).alias("df")))
        met = with_idf(counts, frequencies, n_docs)
    weighed = met.withColumn("weight", F.col("tf") * F.col("idf"))
    if by_day:
        # A day may hold a third of all words: sum per day with a map-side combine, then broadcast.
        norms = weighed.groupBy(doc).agg(F.sqrt(F.sum(F.col("weight") ** 2)).alias("norm"))
        normed = weighed.join(broadcast_days(norms, doc), doc)
        return normed.withColumn("weight", F.col("weight") / F.col("norm")).drop("norm")
    return _unit_length(weighed, doc)


def _unit_length(weighed: DataFrame, doc: str) -> DataFrame:
    # A document's words are bounded by its own text, so a window per document is enough.
    norm = F.sqrt(F.sum(F.col("weight") ** 2).over(W.partitionBy(doc)))
    return weighed.withColumn("weight", F.col("weight") / norm)


def principal_components(weights: DataFrame, docs: DataFrame, doc: str, k: int = COMPONENTS) -> DataFrame:
    """(doc, PCA1 … PCAk): scores of the mean-centred weight matrix on its leading components.

    Works on the sparse (doc, token, weight) rows over the whole vocabulary; the dense matrix never exists. A
    randomized block iteration on the products of documents with each other. Up to GRAM_DOCS documents these are added
    up once, in one pass over the words; beyond, each round is one pass over the words, in which every task multiplies
    its words' columns and their transposes with a broadcast block of document vectors. The driver holds the products
    or the block, and the basis that the rounds have spanned, one row a document. Rounds end when the scores stand still or the basis is
    closed, and raise when they do not. Documents are days as a rule; beyond MOST_DOCS the block is refused. Each
    component's sign makes its largest absolute score positive.
    """
    spark = docs.sparkSession
    docs = settle(docs.select(doc).distinct())
    if docs.limit(MOST_DOCS + 1).count() > MOST_DOCS:
        raise ValueError(f"more than {MOST_DOCS} documents: a block of their vectors is not broadcast")
    names = sorted(row[0] for row in docs.collect())
    n = len(names)
    index = spark.createDataFrame(list(enumerate(names)), f"i int, {doc} {docs.schema[doc].dataType.simpleString()}")
    cells = weights.join(F.broadcast(index), doc).select("token", "i", F.col("weight").alias("w"))
    # A word's column has at most one cell per document.
    columns = settle(cells.groupBy("token").agg(F.collect_list("i").alias("at"), F.collect_list("w").alias("w")).drop("token"))
    if n <= GRAM_DOCS:
        gram = _gram(columns, n)
        scores = _leading_scores(lambda block: gram @ block, n, k)
    else:
        scores = _leading_scores(lambda block: _gram_times(columns, block), n, k)
    rows = [(i, *map(float, scores[i])) for i in range(n)]
    placed = spark.createDataFrame(rows, "i int, " + ", ".join(f"PCA{j + 1} double" for j in range(k)))
    return index.join(F.broadcast(placed), "i").select(doc, *[f"PCA{j + 1}" for j in range(k)])


def _add_products(total: np.ndarray, at: np.ndarray, w: np.ndarray, sizes: np.ndarray) -> None:
    """Adds every word's products of its cells to the documents' matrix: `at` and `w` are the words' cells, `sizes` their counts."""
    n, starts = len(total), np.cumsum(sizes) - sizes
    wide = np.flatnonzero(sizes >= max(1, n // 16))
    for some in (wide[i : i + WIDE_WORDS] for i in range(0, len(wide), WIDE_WORDS)):
        cells = np.concatenate([np.arange(starts[word], starts[word] + sizes[word]) for word in some])
        row = np.repeat(np.arange(len(some)), sizes[some])
        dense = np.bincount(row * n + at[cells], weights=w[cells], minlength=len(some) * n).reshape(-1, n)
        total += dense.T @ dense
    for size in np.unique(sizes[(sizes > 0) & (sizes < max(1, n // 16))]).tolist():
        words, step = np.flatnonzero(sizes == size), max(1, PAIRS // size**2)
        for some in (words[i : i + step] for i in range(0, len(words), step)):
            cells = starts[some][:, None] + np.arange(size)
            here, values = at[cells].astype(np.int64), w[cells]
            pairs = here[:, :, None] * n + here[:, None, :]
            np.add.at(total.reshape(-1), pairs.ravel(), (values[:, :, None] * values[:, None, :]).ravel())


def _added(rows: pa.Table) -> pa.Table:
    whole = np.sum([x.values.to_numpy() for x in rows["part"].combine_chunks()], axis=0)
    return pa.table({"chunk": rows["chunk"][:1], "part": pa.array([whole], pa.list_(pa.float64()))})


def _gram(columns: DataFrame, n: int) -> np.ndarray:
    """The matrix times its transpose: documents by documents, in one pass over the words' columns.

    Every task adds up its words in a matrix of its own, so there are as many tasks as GRAM_BYTES of those allow.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n, n))
        for batch in batches:
            at, w = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()
            _add_products(total, at, w, np.diff(batch.column(0).offsets.to_numpy()))
        for chunk in range(0, n if total.any() else 0, GRAM_ROWS):
            part = total[chunk : chunk + GRAM_ROWS].ravel()
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part])], names=["chunk", "part"])

    schema = "chunk int, part array<double>"
    tasks = max(8, GRAM_BYTES // max(1, 8 * n * n))
    parts = columns.coalesce(min(PRODUCT_TASKS, tasks)).mapInArrow(run, schema).groupBy("chunk").applyInArrow(lambda rows: _added(rows), schema)
    out = np.zeros((n, n))
    for batch in parts.toArrow().to_batches():
        for chunk, part in zip(batch.column(0).to_pylist(), batch.column(1)):
            rows = part.values.to_numpy().reshape(-1, n)
            out[chunk : chunk + len(rows)] = rows
    return out


def _gram_times(columns: DataFrame, block: np.ndarray) -> np.ndarray:
    """The matrix times its transpose times `block`, in one pass over the words' columns."""
    n, width = block.shape
    held = columns.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u = held.value
        total = np.zeros((n, width))
        for batch in batches:
            at, w = batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()
            sizes = np.diff(batch.column(0).offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            if len(at):
                loads = np.repeat(np.add.reduceat(w[:, None] * u[at], starts, axis=0), sizes, axis=0) * w[:, None]
                for j in range(width):
                    total[:, j] += np.bincount(at, weights=loads[:, j], minlength=n)
        for chunk in range(0, n if total.any() else 0, CHUNK_DOCS):
            part = total[chunk : chunk + CHUNK_DOCS].ravel()
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([part])], names=["chunk", "part"])

    schema = "chunk int, part array<double>"
    # Every task returns up to a block of numbers, so their number is limited.
    parts = columns.coalesce(PRODUCT_TASKS).mapInArrow(run, schema).groupBy("chunk").applyInArrow(lambda rows: _added(rows), schema)
    out = np.zeros((n, width))
    for row in parts.collect():
        part = np.array(row["part"]).reshape(-1, width)
        out[row["chunk"] : row["chunk"] + len(part)] = part
    held.unpersist()
    return out


def _orthonormal(block: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The directions of a block that `basis` lacks."""
    scale = np.linalg.norm(block, axis=0).max(initial=0.0)
    for _ in range(2):
        block = block - basis @ (basis.T @ block)
    left, values, _ = np.linalg.svd(block, full_matrices=False)
    return left[:, values > max(scale, 1e-300) * 1e-11]


def _leading_scores(times: Callable[[np.ndarray], np.ndarray], n: int, k: int) -> np.ndarray:
    """Leading scores of a centred Gram matrix that is known by its product with a block of vectors.

    The basis grows by the images of its newest block. Once it holds BASIS_BLOCKS blocks it goes on from its best
    directions, so its size does not depend on the number of rounds.
    """
    if n < 2:
        return np.zeros((n, k))
    centred = lambda block: block - block.mean(axis=0)
    width = k + EXTRA_DIRECTIONS
    basis = np.zeros((n, 0))
    images = np.zeros((n, 0))
    block = _orthonormal(centred(np.random.default_rng(20).standard_normal((n, width))), basis)
    scores = np.zeros((n, k))
    for _ in range(MAX_ROUNDS):
        closed = not block.shape[1]
        if not closed:
            basis, images = np.hstack([basis, block]), np.hstack([images, centred(times(block))])
        if not basis.shape[1]:
            return scores
        inner = basis.T @ images
        values, vectors = np.linalg.eigh((inner + inner.T) / 2)
        values, vectors = np.maximum(values[::-1], 0.0), vectors[:, ::-1]
        found = basis @ vectors[:, :k] * np.sqrt(values[:k])
        found[:, values[:k] <= values[0] * 1e-12] = 0.0
        largest = found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])]
        found = np.pad(found * np.where(largest < 0, -1.0, 1.0), ((0, 0), (0, k - found.shape[1])))
        moved, scores = np.abs(found - scores).max(initial=0.0), found
        off = images @ vectors[:, :k] - basis @ vectors[:, :k] * values[:k]
        still = moved <= TOLERANCE * np.abs(scores).max(initial=0.0) and np.abs(off).max(initial=0.0) <= np.sqrt(TOLERANCE) * values[0]
        if closed or still or basis.shape[1] >= n - 1:
            return scores
        block = _orthonormal(images[:, -block.shape[1] :], basis)
        if basis.shape[1] >= BASIS_BLOCKS * width:
            best = vectors[:, : 2 * width]
            # The residuals of the best directions all lie in the span of the new block.
            basis, images = basis @ best, images @ best
    raise RuntimeError(f"the leading components still move after {MAX_ROUNDS} rounds")
