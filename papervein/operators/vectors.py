"""Sparse vectors of units in many dimensions, and their truncated singular value decomposition.

A term's dimension follows from its MD5, so every engine gives the same vectors.  Weights are
kept as rows ``(unit_id, index, weight)``: nothing has the width of the vocabulary, and the
number of dimensions costs nothing.

The decomposition is randomised subspace iteration (Halko, Martinsson and Tropp, 2011): a few
signs per dimension are multiplied by the matrix and its transpose in turn.  Both products are
joins and sums over the weights; the driver sees one square matrix a step, as wide as the
number of components asked for and a few more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from papervein.operators.checkpoints import cut_lineage
from papervein.operators.joins import sized

DIMS = 1 << 18
WORD = r"[\p{L}\p{N}_]{2,}"


def term_index(term: Column, dims: int = DIMS) -> Column:
    """The dimension of a term: the first 32 bits of its MD5, modulo the dimensions."""
    return F.conv(F.substring(F.md5(F.encode(term, "UTF-8")), 1, 8), 16, 10).cast("long") % dims


# Beyond so many dimensions their inverse frequencies are joined and not sent to the tasks (32 MB).
MAX_SENT_DIMS = 1 << 22
# Units are weighed in slices of about this many words, so that work arrays stay small.
SLICE_WORDS = 1 << 20


def _terms() -> Column:
    return F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0))


def _term_rows(units: DataFrame, dims: int) -> DataFrame:
    """``(unit_id, index, _tf)`` by a shuffle of the words, so rows that share an id are one unit."""
    terms = units.select("unit_id", F.explode_outer(_terms()).alias("_term"))
    indexed = terms.where(F.col("_term").isNotNull()).select("unit_id", term_index(F.col("_term"), dims).alias("index"))
    return cut_lineage(indexed.groupBy("unit_id", "index").agg(F.count(F.lit(1)).alias("_tf")))


def _unit_frequencies(counted: DataFrame) -> DataFrame:
    return counted.groupBy("index").agg(F.count(F.lit(1)).alias("_n"))


def _idf(frequencies: DataFrame, n: int) -> DataFrame:
    """``(index, _idf)`` of ``(index, _n)``, whose counts are summed, among n units."""
    summed = frequencies.groupBy("index").agg(F.sum("_n").alias("_n"))
    return cut_lineage(summed.select("index", F.log(F.lit(n + 1.0) / (F.col("_n") + 1)).alias("_idf")))


def _weighed_rows(counted: DataFrame, idf: DataFrame) -> DataFrame:
    raw = counted.join(sized(idf), "index").select("unit_id", "index", (F.col("_tf") * F.col("_idf")).alias("_raw"))
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy("unit_id")))
    return raw.where(F.col("_raw") != 0).select("unit_id", "index", (F.col("_raw") / length).alias("weight"))


def _places(words: pa.ListArray, dims: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, row, dimension, count) of slices of rows; a term is hashed once a slice."""
    offsets, start = words.offsets.to_numpy(), 0
    while start < len(words):
        end = int(np.searchsorted(offsets, offsets[start] + SLICE_WORDS, side="right")) - 1
        end = min(len(words), max(start + 1, end))
        own = offsets[start : end + 1]
        flat = words.values.slice(own[0], own[-1] - own[0]).dictionary_encode()
        terms = flat.dictionary.cast(pa.binary()).to_pylist()
        index = np.array([int.from_bytes(hashlib.md5(term).digest()[:4], "big") % dims for term in terms], np.int64)
        row = np.repeat(np.arange(end - start), np.diff(own))
        codes, count = np.unique(row * dims + index[flat.indices.to_numpy()], return_counts=True)
        yield start, codes // dims, codes % dims, count
        start = end


def _with_terms(units: DataFrame) -> DataFrame:
    return units.select("unit_id", F.coalesce(_terms(), F.array().cast("array<string>")).alias("_terms"))


def _unit_counts(units: DataFrame, dims: int) -> DataFrame:
    """``(unit_id, index, _n)``: rows of each id, without index, and units with each dimension, without id.

    Each row is taken as a unit; dimensions are summed where the text is read.
    """
    schema = StructType([units.schema["unit_id"], StructField("index", LongType()), StructField("_n", LongType())])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.nulls(len(ids), pa.int64()), pa.array(np.ones(len(ids), np.int64))], names=["unit_id", "index", "_n"]
            )
            for _, _, index, _ in _places(batch.column(1), dims):
                at, n = np.unique(index, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(len(at), ids.type), pa.array(at), pa.array(n.astype(np.int64))], names=["unit_id", "index", "_n"]
                )

    return _with_terms(units).mapInArrow(counted, schema).groupBy("unit_id", "index").agg(F.sum("_n").alias("_n"))


def _weighed_units(units: DataFrame, idf: DataFrame, dims: int) -> DataFrame:
    """Weights of units, each row a unit, made where the text is read: nothing is shuffled."""
    rows = idf.toArrow()
    table = np.zeros(dims)
    table[rows.column("index").to_numpy()] = rows.column("_idf").to_numpy()
    sent = units.sparkSession.sparkContext.broadcast(table)

    def weighed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, row, index, count in _places(batch.column(1), dims):
                raw = count * sent.value[index]
                length = np.sqrt(np.bincount(row, raw * raw))
                kept = np.flatnonzero(raw)
                row, index, raw = row[kept], index[kept], raw[kept]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + start)), pa.array(index), pa.array(raw / length[row])],
                    names=["unit_id", "index", "weight"],
                )

    schema = StructType([units.schema["unit_id"], StructField("index", LongType()), StructField("weight", DoubleType())])
    return _with_terms(units).mapInArrow(weighed, schema)


def unit_weights(units: DataFrame, dims: int = DIMS) -> DataFrame:
    """``(unit_id, index, weight)``: TF-IDF weights of unit length; zero weights are left out.

    idf = ln((n + 1) / (f + 1)) with n units, f of them with the dimension.  A unit without
    words, or whose words are in all units, has no rows.  Units are weighed where their text is
    read; only the words of rows that share an id meet by a shuffle.
    """
    if dims > MAX_SENT_DIMS:
        rows = _term_rows(units, dims)
        return _weighed_rows(rows, _idf(_unit_frequencies(rows), units.select("unit_id").count()))
    numbers = Observation()
    counted = _unit_counts(units, dims).observe(numbers, F.sum(F.when(F.col("index").isNull(), F.col("_n"))).alias("n"))
    # Of the ids only those of several rows are kept.
    counted = cut_lineage(counted.where(F.col("index").isNotNull() | (F.col("_n") > 1)))
    n = numbers.get["n"] or 0
    found = counted.where(F.col("index").isNotNull()).select("index", "_n")
    shared = counted.where(F.col("index").isNull()).select(F.col("unit_id").alias("_shared"))
    if shared.isEmpty():
        return _weighed_units(units, _idf(found, n), dims)
    together, same = sized(shared), F.col("unit_id").eqNullSafe(F.col("_shared"))
    single, several = units.join(together, same, "left_anti"), units.join(together, same, "left_semi")
    rows = _term_rows(several, dims)
    found = _unit_counts(single, dims).where(F.col("index").isNotNull()).select("index", "_n")
    idf = _idf(found.union(_unit_frequencies(rows)), n)
    return _weighed_units(single, idf, dims).union(_weighed_rows(rows, idf))


@dataclass(frozen=True)
class Decomposition:
    """Singular values, largest first; ``components (index, v)`` and ``reduced (unit_id, reduced)``.

    ``reduced`` holds the units' coordinates, the left singular vectors times the values.
    """

    values: list[float]
    components: DataFrame
    reduced: DataFrame


def _columns(width: int) -> list[str]:
    return [f"c{j}" for j in range(width)]


def _product(weights: DataFrame, on: str, to: str, vectors: DataFrame, width: int) -> DataFrame:
    """The matrix or its transpose times ``vectors (on, c0, c1 ...)``, summed by ``to``."""
    sums = [F.sum(F.col("weight") * F.col(c)).alias(c) for c in _columns(width)]
    return cut_lineage(weights.join(sized(vectors), on).groupBy(to).agg(*sums))


def _gram(vectors: DataFrame, width: int) -> np.ndarray:
    """Inner products of the columns: one small matrix on the driver."""
    pairs = [(i, j) for i in range(width) for j in range(i, width)]
    row = vectors.agg(*[F.sum(F.col(f"c{i}") * F.col(f"c{j}")).alias(f"g{i}_{j}") for i, j in pairs]).first()
    gram = np.zeros((width, width))
    for (i, j), value in zip(pairs, row):
        gram[i, j] = gram[j, i] = value or 0.0
    return gram


def _turned(vectors: DataFrame, key: str, turn: np.ndarray) -> DataFrame:
    """The columns times a small matrix."""
    columns = []
    for j in range(turn.shape[1]):
        terms = [F.col(f"c{i}") * float(turn[i, j]) for i in range(turn.shape[0]) if turn[i, j]]
        total = terms[0] if terms else F.lit(0.0)
        for term in terms[1:]:
            total = total + term
        columns.append(total.alias(f"c{j}"))
    return vectors.select(key, *columns)


def _orthonormal(vectors: DataFrame, key: str, width: int) -> DataFrame:
    """Columns of the same span, orthogonal and of unit length; surplus ones are zero."""
    values, axes = np.linalg.eigh(_gram(vectors, width))
    kept = values > max(values.max(), 0) * 1e-12
    scale = np.where(kept, 1 / np.sqrt(np.where(kept, values, 1)), 0)
    return _turned(vectors, key, axes * scale)


def decompose(weights: DataFrame, k: int, passes: int = 6, extra: int = 10, seed: int = 42) -> Decomposition:
    """The k largest singular values of ``(unit_id, index, weight)`` and what belongs to them.

    ``weights`` is read twice a pass: give a written table.
    """
    width = k + extra
    signs = F.xxhash64("index", F.lit(seed))
    start = weights.select("index").distinct().select("index", *[
        F.when(F.call_function("shiftright", signs, F.lit(j % 64)).bitwiseAND(F.lit(1)) == 1, 1.0).otherwise(-1.0).alias(c)
        for j, c in enumerate(_columns(width))
    ])
    basis = _orthonormal(cut_lineage(start), "index", width)
    for _ in range(passes):
        left = _orthonormal(_product(weights, "index", "unit_id", basis, width), "unit_id", width)
        basis = cut_lineage(_orthonormal(_product(weights, "unit_id", "index", left, width), "index", width))
    images = _product(weights, "index", "unit_id", basis, width)
    squares, axes = np.linalg.eigh(_gram(images, width))
    order = np.argsort(-squares)[:k]
    vector = F.array(*_columns(k))
    return Decomposition(
        [float(np.sqrt(max(s, 0.0))) for s in squares[order]],
        _turned(basis, "index", axes[:, order]).select("index", vector.alias("v")),
        _turned(images, "unit_id", axes[:, order]).select("unit_id", vector.alias("reduced")),
    )
