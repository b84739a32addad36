"""Whitening of embeddings with Spark MLlib's distributed block matrices.

Rows are numbered and their centred vectors laid into a BlockMatrix; the product of its transpose with
itself is the scatter, whose eigenvectors are found on the driver (one number for each pair of dimensions);
a second product with the scaled eigenvectors projects the rows. A third one, of the projections with
themselves, measures how far their covariance is from the identity.

The scatter is a single block, so its product is split along the rows: each split sums a number of row
blocks and sends one small matrix. Products and layout are stages over the written rows, and a lost
executor costs the tasks it held.

A vector that is null, empty, or has null or non-finite components takes no part, nor one with a component
beyond `LARGEST`. The table's dimension is the length that most vectors have, the shorter one of equals;
vectors of another length take no part. Null and repeated ids are rows like others. Directions without
variance, up to rounding, are no components: equal vectors, a single one or none give no rows. `deviation`
is null where it does not fit a long. Only the id and the vector are read of the columns.
"""

import math

import numpy as np
from pyspark import StorageLevel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.mllib.common import callMLlibFunc
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix, IndexedRowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.tables import numbered

SCALE, SHIFT = 64, 1_000_000
#: Components beyond this are taken as not finite, so that sums of whole numbers stay in range.
LARGEST = 2.0**31
#: Rows and columns of a block, and bytes of the row blocks that one task multiplies.
BLOCK, TASK_BYTES = 1024, 4 << 20
RESULT = "id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _usable(vector: Column) -> Column:
    return (F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= LARGEST))


def _indexed_rows(matrix: BlockMatrix) -> DataFrame:
    """A matrix as a table of `row` and `values`."""
    rows = callMLlibFunc("getIndexedRows", matrix.toIndexedRowMatrix()._java_matrix_wrapper._java_model)
    return rows.select(F.col("index").alias("row"), vector_to_array("vector").alias("values"))


def _gram(matrix: BlockMatrix, splits: int) -> np.ndarray:
    """The product of a matrix's transpose with itself, its sum over rows split into so many tasks."""
    model = matrix._java_matrix_wrapper
    product = matrix.transpose()._java_matrix_wrapper.call("multiply", model._java_model, splits)
    return BlockMatrix(product, BLOCK, BLOCK).toLocalMatrix().toArray()


def _components(covariance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, largest first, and their eigenvectors in columns, without those that are zero up to rounding."""
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    values, vectors = values[::-1], vectors[:, ::-1]
    kept = int((values > values[0] * len(values) * np.finfo(float).eps).sum()) if values[0] > 0 else 0
    return values[: min(kept, most)], vectors[:, : min(kept, most)]


def whiten(vectors: DataFrame, most: int = 32, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """`id`, `component`, `n`, `deviation`, `whitened`, `explained` and `identity_error` of each usable row and component.

    Entries are taken as the whole numbers floor(64 * c) + 1,000,000; sums of them are exact.
    """
    spark = vectors.sparkSession
    x = F.transform(F.col(vector), lambda c: F.floor(SCALE * c.cast("double")) + F.lit(SHIFT))
    usable = vectors.select(F.col(id).cast("long").alias("id"), F.when(_usable(F.col(vector)), x).alias("x")).filter("x is not null")
    lengths = usable.groupBy(F.size("x").alias("size")).count().orderBy(F.desc("count"), "size").first()
    if lengths is None:
        return spark.createDataFrame([], RESULT)
    size, n = lengths["size"], lengths["count"]
    table = numbered(usable.filter(F.size("x") == size), "whitening-rows")
    totals = table.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.sum("v").alias("s")).collect()
    sums = [s for _, s in sorted(map(tuple, totals))]
    apart = F.zip_with("x", F.array(*map(F.lit, sums)), lambda v, s: v * F.lit(n) - s)  # n times the distance from the mean

    splits = max(1, math.ceil(n * size * 8 / TASK_BYTES))
    centred = table.select("row", array_to_vector(F.transform(apart, lambda d: d.cast("double") / n)).alias("vector"))
    centred = centred.repartition(splits, F.floor(F.col("row") / BLOCK))
    centred = MLUtils.convertVectorColumnsFromML(centred, "vector")
    # three products read the blocks; one that is lost is laid out again from the written rows
    blocks = IndexedRowMatrix(centred, n, size).toBlockMatrix(BLOCK, BLOCK).persist(StorageLevel.MEMORY_AND_DISK)
    covariance = _gram(blocks, splits) / n
    values, directions = _components(covariance, most)
    if not len(values):
        return spark.createDataFrame([], RESULT)

    scaled = directions / np.sqrt(values)
    # the whitening matrix has no more blocks than the square of the dimension over that of a block
    parts = [((i, 0), scaled[i * BLOCK : (i + 1) * BLOCK]) for i in range(math.ceil(size / BLOCK))]
    matrix = spark.sparkContext.parallelize([(at, DenseMatrix(*part.shape, part.ravel("F"))) for at, part in parts], 1)
    projected = blocks.multiply(BlockMatrix(matrix, BLOCK, BLOCK, size, len(values))).persist(StorageLevel.MEMORY_AND_DISK)
    error = float(np.abs(_gram(projected, splits) / n - np.eye(len(values))).max())

    square = F.aggregate(apart, F.lit(0).cast("long"), lambda total, d: F.try_add(total, F.try_multiply(d, d)))
    shares = F.array(*[F.lit(float(v)) for v in values / np.trace(covariance)])
    rows = table.select("row", "id", square.alias("deviation")).join(_indexed_rows(projected), "row")
    return rows.select("id", "deviation", F.posexplode("values").alias("k", "whitened")).select(
        "id", (F.col("k") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("k")).alias("explained"), F.lit(error).alias("identity_error"))


def op11_embedding_whitening(spark, sf_dir: str) -> DataFrame:
    """The embeddings on their 32 strongest components, whitened."""
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")
