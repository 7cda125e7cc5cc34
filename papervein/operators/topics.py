"""Topics: unit vectors, reduced vectors, density or k-means clusters, names.

Density topics come from ``density.py``: points with enough others within a radius, and
whatever of those lies within the radius of each other; everything else is noise (-1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import IDF, PCA, HashingTF, Normalizer, PCAModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators.checkpoints import cut_lineage
from papervein.operators.density import NOISE, Density, attach_topics
from papervein.operators.joins import first_rows, sized
from papervein.operators import vectors as sparse
from papervein.operators.units import units as cut_units

WORD = r"[\p{L}\p{N}_]{2,}"


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))


def unit_vectors(units: DataFrame, dims: int = 256) -> DataFrame:
    """Add ``vector``: hashed TF-IDF of unit length, a sparse ML vector."""
    worded = units.withColumn("_words", words(F.col("text")))
    counted = HashingTF(numFeatures=dims, inputCol="_words", outputCol="_tf").transform(worded)
    weighted = IDF(inputCol="_tf", outputCol="_idf").fit(counted).transform(counted)
    scaled = Normalizer(inputCol="_idf", outputCol="vector").transform(weighted)
    return scaled.drop("_words", "_tf", "_idf")


def normalise_vector(vector: Column) -> Column:
    """The vector scaled to length 1; a zero vector stays as it is."""
    squares = F.aggregate(vector, F.lit(0.0), lambda total, x: total + x * x)
    return F.transform(vector, lambda x: F.coalesce(F.try_divide(x, F.sqrt(squares)), x))


def reduce_by_pca(vectors: DataFrame, dims: int) -> DataFrame:
    """``reduced ARRAY<DOUBLE>``: the first principal components of the ML ``vector``.

    The driver holds one matrix of columns by columns, whatever the number of rows.
    """
    return _reduced(pca(vectors, dims), vectors)


def pca(vectors: DataFrame, dims: int) -> PCAModel:
    return PCA(k=dims, inputCol="vector", outputCol="_pca").fit(vectors)


def _reduced(model: PCAModel, vectors: DataFrame) -> DataFrame:
    return model.transform(vectors).withColumn("reduced", vector_to_array("_pca")).drop("_pca")


def signed_sums(vector: Column, width: int, dims: int) -> list[Column]:
    """Feature hashing to few dimensions: pairs of components, added with opposite signs.

    Component i goes to dimension (i div 2) mod dims, odd ones negated.  Fixed order of
    addition, so the sums are the same on every engine.
    """
    sums = []
    for d in range(dims):
        total = F.lit(0.0)
        for i in range(width):
            if (i // 2) % dims == d:
                x = F.element_at(vector, i + 1)
                total = total - x if i % 2 else total + x
        sums.append(total)
    return sums


def kmeans_topics(vectors: DataFrame, k: int, cfg: Config) -> DataFrame:
    """Add ``topic`` by k-means on the ML ``vector``."""
    model = KMeans(k=k, seed=cfg.seed, featuresCol="vector", predictionCol="topic").fit(vectors)
    return model.transform(vectors)


def keyword_weights(units: DataFrame) -> DataFrame:
    """Class-based TF-IDF: ``(topic, term, tf, weight)``.

    weight = tf * ln(1 + A / f), with f the term's count over all topics and A the mean
    number of words per topic.
    """
    terms = units.select("topic", F.explode_outer(words(F.col("text"))).alias("term"))
    counts = terms.where(F.col("term").isNotNull()).groupBy("topic", "term").agg(F.count(F.lit(1)).alias("tf"))
    mean = counts.select(
        F.sum("tf").cast("double") / F.count_distinct("topic")
    ).scalar()
    total = F.sum("tf").over(Window.partitionBy("term"))
    weight = F.col("tf") * F.log(F.lit(1.0) + mean / total)
    return counts.select("topic", "term", "tf", F.round(weight, 6).alias("weight"))


def topic_names(units: DataFrame, n_terms: int = 4) -> DataFrame:
    """``(topic, n_units, name)``: the id and the heaviest words."""
    heaviest = first_rows(
        keyword_weights(units), "topic", n_terms, F.desc("weight"), F.asc("term")
    )
    ordered = F.sort_array(F.collect_list(F.struct(F.negative("weight").alias("w"), "term")))
    labels = heaviest.groupBy("topic").agg(ordered.alias("_terms"))
    name = F.concat_ws("_", F.col("topic").cast("string"), F.array_join("_terms.term", "_"))
    return sizes(units).join(labels, "topic", "left").select(
        "topic", F.col("n").alias("n_units"), name.alias("name")
    )


def scaled_position(vector: Column, spreads: Sequence[float]) -> Column:
    """The vector measured in the given spread of each dimension."""
    return F.array(*[F.element_at(vector, d + 1) / F.lit(s) for d, s in enumerate(spreads)])


def clustered_units(documents: DataFrame, cfg: Config) -> DataFrame:
    """The whole path from texts: units, vectors, reduction, density topics, names.

    The texts are read twice, to weigh their words and to write the units.
    """
    if cfg.reduction == "svd":
        return _clustered_by_svd(cut_lineage(cut_units(documents, cfg)), cfg)
    if cfg.reduction != "pca":
        raise ValueError(f"reduction must be 'pca' or 'svd', not {cfg.reduction!r}")
    return cluster(cut_lineage(unit_vectors(cut_units(documents, cfg))), cfg)


def _clustered_by_svd(units: DataFrame, cfg: Config) -> DataFrame:
    """The same from vectors of many dimensions, joined to the units at the end."""
    weights = cut_lineage(sparse.unit_weights(units))
    reduced = cut_lineage(sparse.decompose(weights, cfg.reduced_dims, seed=cfg.seed).reduced)
    density, cells, alone, spreads = _density_of(reduced.select("reduced"), cfg)
    position = scaled_position(F.col("reduced"), spreads)
    placed = attach_topics(reduced.withColumn("position", position), "position", density, cells, alone)
    topic = F.coalesce("_topic", F.lit(NOISE))
    tagged = units.join(sized(placed.select("unit_id", F.col("topic").alias("_topic"))), "unit_id", "left")
    labelled = cut_lineage(tagged.select("doc_id", "unit_id", "text", topic.alias("topic")))
    return attach_names(labelled, cut_lineage(topic_names(labelled)))


def _density_of(points: DataFrame, cfg: Config) -> tuple[Density, DataFrame, DataFrame, list[float]]:
    """The topics' places among written points ``(reduced)``, and the spread of each dimension."""
    deviations = [
        F.stddev(F.element_at("reduced", d + 1)).alias(f"s{d}") for d in range(cfg.reduced_dims)
    ]
    spreads = [s or 1.0 for s in points.agg(*deviations).first()]
    position = scaled_position(F.col("reduced"), spreads).alias("position")
    density = Density(cfg.reduced_dims, cfg.radius, cfg.min_points)
    cells, alone = density.topics(density.positions(points.select(position), "position"), cfg.min_topic_size)
    return density, cut_lineage(cells), cut_lineage(alone), spreads


def cluster(units: DataFrame, cfg: Config) -> DataFrame:
    """Topics and names of ``(doc_id, unit_id, text, vector)``, an ML vector from any source.

    ``units`` is read several times: pass a written table.  Texts are not shuffled.
    """
    model = pca(units, cfg.reduced_dims)
    points = cut_lineage(_reduced(model, units.select("vector")).select("reduced"))
    density, cells, alone, spreads = _density_of(points, cfg)
    placed = _reduced(model, units).withColumn("position", scaled_position(F.col("reduced"), spreads))
    tagged = attach_topics(placed, "position", density, cells, alone)
    labelled = tagged.select("doc_id", "unit_id", "text", "topic")
    return attach_names(labelled, cut_lineage(topic_names(labelled)))


def attach_names(units: DataFrame, names: DataFrame) -> DataFrame:
    return units.join(sized(names.select("topic", F.col("name").alias("topic_name"))), "topic", "left")


def named_trends(matrix: DataFrame, names: DataFrame) -> DataFrame:
    """A trend matrix by topic with the topics' names."""
    return attach_names(matrix, names)


def sizes(units: DataFrame) -> DataFrame:
    return units.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def largest(units: DataFrame, n: int = 12, selected: Sequence[int] = ()) -> DataFrame:
    """The n largest topics without noise, and whether the caller asked for them."""
    real = sizes(units).where(F.col("topic") != NOISE)
    return real.orderBy(F.desc("n"), F.asc("topic")).limit(n).withColumn(
        "is_selected", F.col("topic").isin(*selected)
    )
