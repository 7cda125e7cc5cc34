"""Document relevance by the number of domain terms a text contains."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from papervein.config import Config
from papervein.functions import text as tx
from papervein.operators import term_index
from papervein.operators.checkpoints import cut_lineage
from papervein.operators.joins import BROADCAST_BYTES, sized


def with_hits(documents: DataFrame, cfg: Config) -> DataFrame:
    """Append how many terms occur, as substrings in any case; each term counts once."""
    lowered = documents.withColumn("_lower", F.lower("text"))
    found = [
        F.coalesce(F.contains("_lower", F.lit(term.lower())), F.lit(False)).cast("int")
        for term in cfg.domain_terms
    ]
    hits = F.struct(reduce(add, found, F.lit(0)).alias("domain_term_hits"))
    # A generated column: filters on it are not copied below it, which would lower the
    # text once more for every term.
    return lowered.select("*", F.inline(F.array(hits))).drop("_lower")


def tag(documents: DataFrame, cfg: Config) -> DataFrame:
    """Mark every document; none is removed."""
    return with_hits(documents, cfg).withColumn(
        "is_relevant", F.col("domain_term_hits") >= cfg.relevance_threshold
    )


def relevant(documents: DataFrame, cfg: Config) -> DataFrame:
    return tag(documents, cfg).where("is_relevant")


def summary(tagged: DataFrame) -> DataFrame:
    return tagged.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("is_relevant").alias("relevant"),
        F.count_if(~F.col("is_relevant")).alias("not_relevant"),
    )


def status_list(tagged: DataFrame) -> DataFrame:
    """KEEP or DROP for each document, named by its file or else its id."""
    name = F.coalesce(tx.basename(F.col("source_path")), F.col("doc_id").cast("string"))
    return tagged.select(
        F.when(F.col("is_relevant"), "KEEP").otherwise("DROP").alias("status"),
        "domain_term_hits",
        name.alias("document"),
    )


# ---- term lists of any size ----------------------------------------------------

# What a term takes in the index of a list beside its own bytes.
TERM_BYTES = 24


def term_table(terms: DataFrame) -> DataFrame:
    """``(number, term, times)``: the distinct lower-cased terms of a list ``(term)``, blank ones left out.

    ``times`` is how often the list holds the term in any case.
    """
    lowered = terms.select(F.lower("term").alias("term")).where(F.trim("term") != "")
    counted = lowered.groupBy("term").agg(F.count(F.lit(1)).alias("times"))
    return cut_lineage(counted.select(F.monotonically_increasing_id().alias("number"), "term", "times"))


def _parts(listed: DataFrame, max_broadcast_bytes: int) -> list[DataFrame]:
    """A term table in parts of about ``max_broadcast_bytes``; none of an empty one.

    The parts are ranges of the sorted list, so that a place of a text is searched in the one
    or few parts that its first bytes lie in, and only compared with the bounds of the others.
    """
    size = listed.agg(F.sum(F.octet_length("term") + F.lit(TERM_BYTES)).alias("bytes")).first()["bytes"]
    parts = -(-(size or 0) // max_broadcast_bytes)
    if parts < 2:
        return [listed] * parts
    ranged = cut_lineage(listed.repartitionByRange(parts, "term").withColumn("_part", F.spark_partition_id()))
    return [ranged.where(F.col("_part") == part).drop("_part") for part in range(parts)]


def _sent(part: DataFrame) -> Broadcast:
    rows = part.orderBy("term").toArrow().combine_chunks()
    terms, number, times = (rows.column(name).combine_chunks() for name in ("term", "number", "times"))
    return part.sparkSession.sparkContext.broadcast(term_index.build(terms, number.to_numpy(), times.to_numpy()))


def _searched(documents: DataFrame, part: DataFrame) -> DataFrame:
    """``(doc_id, number)``: the terms of a part that each row's text contains, once a row."""
    shared = _sent(part)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, _, row, term in term_index.found(shared.value, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row + start)), pa.array(shared.value.number[term])], names=["doc_id", "number"]
                )

    texts = documents.select("doc_id", F.lower("text").alias("_text"))
    return texts.mapInArrow(searched, StructType([texts.schema["doc_id"], StructField("number", LongType())]))


def _counted(documents: DataFrame, part: DataFrame) -> DataFrame:
    """``(doc_id, _hits)``: how often the list holds the terms of a part that each row's text contains."""
    shared = _sent(part)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, end, row, term in term_index.found(shared.value, batch.column(1)):
                hits = np.zeros(end - start, np.int64)
                np.add.at(hits, row, shared.value.times[term])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array(hits)], names=["doc_id", "_hits"])

    texts = documents.select("doc_id", F.lower("text").alias("_text"))
    return texts.mapInArrow(counted, StructType([texts.schema["doc_id"], StructField("_hits", LongType())]))


def _listed(documents: DataFrame, parts: list[DataFrame]) -> DataFrame:
    found = [
        _searched(documents, part).distinct().join(F.broadcast(part), "number").select("doc_id", "term", "times") for part in parts
    ]
    nothing = documents.select("doc_id", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("times")).limit(0)
    return reduce(DataFrame.union, found) if found else nothing


def listed_terms(documents: DataFrame, terms: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc_id, term, times)``: every term of a list ``(term)`` that a text contains, once.

    Substrings in any case, as in :func:`with_hits`, without an expression for each term: every
    place of a text is looked up once in the sorted list (``term_index.py``).  Only numbers of
    terms are shuffled, never text.  A list beyond ``max_broadcast_bytes`` is taken in parts of
    about that size, one reading each.
    """
    return _listed(documents, _parts(term_table(terms), max_broadcast_bytes))


def hits_of_list(documents: DataFrame, terms: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``(doc_id, domain_term_hits)`` of every document for a list ``(term)`` of any size.

    Terms are counted where the text is read; only counts are shuffled.  Rows that share an id
    are one document: their terms meet, so that each counts once.
    """
    parts = _parts(term_table(terms), max_broadcast_bytes)
    known = documents.where(F.col("doc_id").isNotNull())
    repeated = cut_lineage(known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("doc_id"))
    none = documents.select("doc_id", F.lit(0).cast("long").alias("_hits")).limit(0)
    if repeated.isEmpty():
        counts = [_counted(known, part) for part in parts]
    else:
        together = sized(repeated)
        single, several = known.join(together, "doc_id", "left_anti"), known.join(together, "doc_id", "left_semi")
        counts = [_counted(single, part) for part in parts]
        counts.append(_listed(several, parts).select("doc_id", F.col("times").alias("_hits")))
    counted = reduce(DataFrame.union, counts, none).groupBy("doc_id").agg(F.sum("_hits").alias("_hits"))
    return documents.select("doc_id").join(counted, "doc_id", "left").select(
        "doc_id", F.coalesce("_hits", F.lit(0)).cast("int").alias("domain_term_hits")
    )


def tag_by_list(documents: DataFrame, terms: DataFrame, cfg: Config) -> DataFrame:
    """``(doc_id, domain_term_hits, is_relevant)`` of every document, by a list of any size."""
    return hits_of_list(documents, terms).withColumn(
        "is_relevant", F.col("domain_term_hits") >= cfg.relevance_threshold
    )
