"""Every registered query: a name and a function of (spark, table folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from papervein.config import GRADE_PATTERNS, MEASUREMENT_PATTERNS, Config
from papervein.functions import text as tx
from papervein.operators import (
    abbreviations, corpus, density, extraction, forest, neighbours, normalise, pricing, relevance, sampling, topics, trends, units,
    vectors,
)
from papervein.plans import views
from papervein.sources import readers

CFG = Config()
FOCUS_LABELS = ("APPLICATION", "COMPETING_MATERIAL")
SELECTED_TOPICS = (1, 4, 7)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    QUERIES[fn.__name__] = fn
    return fn


# ---- shared inputs -----------------------------------------------------------


def _relevant(spark, folder):
    return relevance.relevant(views.literature(spark, folder), CFG)


def _entities(spark, folder):
    return extraction.entity_table(_relevant(spark, folder), CFG, views.lexicon(spark))


def _normalised(spark, folder):
    return normalise.normalise(
        _entities(spark, folder), CFG,
        normalise.default_aliases(spark), normalise.default_bounds(spark),
    )


def _years(spark, folder):
    """Years of all documents: mentions come from relevant ones only, so joining them
    with these gives the same rows, and the text is not read a second time."""
    return views.literature(spark, folder).select("doc_id", "year")


def _bridge(spark, folder):
    return pricing.cost_bridge(
        _normalised(spark, folder), pricing.default_roles(spark), CFG, keep=("start_char",)
    )


def _ingested(spark, folder):
    return corpus.canonical_rows(views.raw_pages(spark, folder), views.INGEST_DATE)


def _year_table(spark, folder):
    return corpus.year_table(
        views.bibliography(spark, folder), views.manual_years(spark, folder)
    )


def _dated(spark, folder):
    described = corpus.described(_ingested(spark, folder))
    return corpus.attach_year(described, _year_table(spark, folder))


# ---- corpus ------------------------------------------------------------------


@query
def ingest_documents(spark, folder):
    return _ingested(spark, folder).withColumn("ingest_date", F.col("ingest_date").cast("string"))


@query
def decoded_documents(spark, folder):
    """Web pages through a caller's decoder; those it refuses have an error and no text."""
    decoded = readers.decode_documents(views.page_files(spark, folder), views.paragraphs)
    text = tx.clean_whitespace(F.array_join("pages", " "))
    return decoded.select("source_path", F.size("pages").alias("n_pages"), text.alias("text"), "error")


@query
def decode_summary(spark, folder):
    return readers.decode_summary(readers.decode_documents(views.page_files(spark, folder), views.paragraphs))


@query
def ingest_summary(spark, folder):
    return corpus.ingest_summary(_dated(spark, folder))


@query
def year_lookup(spark, folder):
    return _year_table(spark, folder)


@query
def documents_with_year(spark, folder):
    return _dated(spark, folder).select("doc_id", "source_path", "filename", "year")


@query
def missing_years(spark, folder):
    return corpus.missing_years(_dated(spark, folder))


@query
def bibliography_gaps(spark, folder):
    return corpus.bibliography_gaps(_ingested(spark, folder), views.bibliography(spark, folder))


@query
def corpus_tokens(spark, folder):
    counts = corpus.token_counts(views.documents(spark, folder))
    return counts.orderBy(F.desc("token_count"), "doc_id")


@query
def corpus_token_summary(spark, folder):
    return corpus.token_summary(corpus.token_counts(views.documents(spark, folder)))


@query
def lexicon_counts(spark, folder):
    lexicon = readers.lexicon_from_lines(
        views.lexicon_lines(spark, folder), views.line_file_labels(spark)
    )
    return readers.lexicon_counts(lexicon)


# ---- relevance ---------------------------------------------------------------


@query
def relevance_hits(spark, folder):
    return relevance.with_hits(views.literature(spark, folder), CFG).select("doc_id", "domain_term_hits")


@query
def relevance_hits_large(spark, folder):
    """A list of many thousand terms, looked up by runs of three characters."""
    return relevance.hits_of_list(views.documents(spark, folder), views.line_heads(spark, folder))


@query
def relevance_tag(spark, folder):
    tagged = relevance.tag(views.literature(spark, folder), CFG)
    status = relevance.status_list(tagged)
    return status


@query
def relevance_summary(spark, folder):
    return relevance.summary(relevance.tag(views.literature(spark, folder), CFG))


@query
def relevant_documents(spark, folder):
    return _relevant(spark, folder).select("doc_id", "year", "domain_term_hits")


# ---- extraction --------------------------------------------------------------


def _clean_documents(spark, folder):
    return views.documents(spark, folder).select(
        "doc_id", tx.clean_whitespace(F.col("text")).alias("text")
    )


@query
def tokens(spark, folder):
    return extraction.tokens(_clean_documents(spark, folder))


@query
def sentences(spark, folder):
    return extraction.sentences(_clean_documents(spark, folder))


def _abbreviated(spark, folder):
    texts = views.abbreviated_literature(spark, folder)
    return texts, abbreviations.learn(texts)


@query
def abbreviation_words(spark, folder):
    return abbreviations.abbreviations(abbreviations.word_counts(views.abbreviated_literature(spark, folder)))


@query
def sentence_openers(spark, folder):
    return abbreviations.openers(abbreviations.word_counts(views.abbreviated_literature(spark, folder)))


@query
def sentences_learnt(spark, folder):
    texts, bounds = _abbreviated(spark, folder)
    return extraction.sentences(texts, bounds)


@query
def scope_tags_learnt(spark, folder):
    """Mentions whose sentence an abbreviation would have cut."""
    texts, bounds = _abbreviated(spark, folder)
    found = extraction.entity_table(texts, CFG, views.lexicon(spark), bounds=bounds)
    return found.where(F.col("scope_tag").isNotNull()).select("doc_id", "start_char", "label", "scope_tag", "context")


@query
def lexicon_term_counts(spark, folder):
    """A lexicon of many thousand terms: how often each occurs, and in how many documents."""
    lexicon = views.line_heads(spark, folder).select(F.lit("HEAD").alias("label"), "term")
    found = extraction.candidates(_clean_documents(spark, folder), Config(patterns=()), lexicon)
    per_document = found.groupBy("entity_text", "doc_id").agg(F.count(F.lit(1)).alias("_n"))
    return per_document.groupBy("entity_text").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("n_docs"))


def _spans(spark, folder, patterns, lexicon=None):
    spans = extraction.candidates(
        views.literature(spark, folder), Config(patterns=patterns), lexicon
    )
    return spans.select("doc_id", "label", "start_char", "end_char", "entity_text").distinct()


@query
def grade_mentions(spark, folder):
    return _spans(spark, folder, GRADE_PATTERNS)


@query
def measure_mentions(spark, folder):
    return _spans(spark, folder, MEASUREMENT_PATTERNS)


@query
def lexicon_mentions(spark, folder):
    return _spans(spark, folder, (), views.lexicon(spark))


@query
def resolved_mentions(spark, folder):
    entities = extraction.entity_table(views.literature(spark, folder), CFG, views.lexicon(spark))
    return entities.select("doc_id", "start_char", "end_char", "label", "entity_text")


@query
def entity_table(spark, folder):
    return _entities(spark, folder)


@query
def scope_tags(spark, folder):
    tagged = _entities(spark, folder).where(F.col("scope_tag").isNotNull())
    return tagged.select("doc_id", "start_char", "label", "scope_tag")


@query
def scoped_mentions(spark, folder):
    return extraction.scoped_only(_entities(spark, folder), CFG)


@query
def entity_preview(spark, folder):
    return extraction.preview(_relevant(spark, folder), CFG, views.lexicon(spark))


@query
def label_counts(spark, folder):
    return extraction.label_counts(_entities(spark, folder))


@query
def scope_counts(spark, folder):
    return extraction.scope_counts(_entities(spark, folder))


@query
def entities_per_document(spark, folder):
    return extraction.per_document(_entities(spark, folder)).orderBy(F.desc("entity_count"), "doc_id")


@query
def zero_mention_documents(spark, folder):
    mixed = views.mixed_literature(spark, folder)
    entities = extraction.entity_table(mixed, CFG, views.lexicon(spark))
    return extraction.without_mentions(mixed, entities)


@query
def distinct_measures(spark, folder):
    return extraction.distinct_measures(_entities(spark, folder), CFG).orderBy("label", "entity_text")


# ---- normalisation -----------------------------------------------------------


@query
def domain_mentions(spark, folder):
    kept = normalise.domain_mentions(_entities(spark, folder), CFG)
    return kept.select("doc_id", "start_char", "label", "entity_text")


@query
def normalised_mentions(spark, folder):
    return _normalised(spark, folder)


def _normal(spark, folder, *columns):
    return _normalised(spark, folder).select("doc_id", "start_char", "label", "entity_text", *columns)


@query
def parsed_values(spark, folder):
    return _normal(spark, folder, "value_numeric", "unit")


@query
def canonical_forms(spark, folder):
    return _normal(spark, folder, "canonical_form")


@query
def resolved_properties(spark, folder):
    return _normal(spark, folder, "resolved_property").where(F.col("label") == "MPA_VALUE")


@query
def review_flags(spark, folder):
    flagged = _normal(spark, folder, "resolved_property", "value_numeric", "review_flag")
    return flagged.where(F.col("review_flag").isNotNull())


@query
def canonical_entities(spark, folder):
    return _normal(spark, folder, "canonical_entity")


@query
def subtypes(spark, folder):
    return _normal(spark, folder, "canonical_entity", "subtype").where(F.col("subtype").isNotNull())


@query
def alias_pairs(spark, folder):
    return normalise.alias_pairs(_normalised(spark, folder))


@query
def subtype_members(spark, folder):
    return normalise.subtype_members(_normalised(spark, folder))


@query
def label_samples(spark, folder):
    return sampling.label_samples(_normalised(spark, folder))


@query
def value_preview(spark, folder):
    return sampling.value_preview(_normalised(spark, folder))


@query
def unit_preview(spark, folder):
    return sampling.unit_preview(units.chunk_units(_relevant(spark, folder), CFG))


# ---- units and topics --------------------------------------------------------


@query
def document_units(spark, folder):
    return units.units(_relevant(spark, folder), Config(cluster_unit="document"))


@query
def chunk_units(spark, folder):
    return units.units(_relevant(spark, folder), CFG)


@query
def chunk_summary(spark, folder):
    return units.unit_summary(units.chunk_units(_clean_documents(spark, folder), CFG))


@query
def topic_sizes(spark, folder):
    return topics.sizes(views.assigned_topics(spark, folder, CFG))


@query
def topic_top_sizes(spark, folder):
    return topics.largest(views.assigned_topics(spark, folder, CFG), 12, SELECTED_TOPICS)


@query
def ctfidf_terms(spark, folder):
    return topics.keyword_weights(views.assigned_topics(spark, folder, CFG))


@query
def topic_labels(spark, folder):
    return topics.topic_names(views.assigned_topics(spark, folder, CFG))


@query
def density_topics(spark, folder):
    points = views.hashed_vectors(spark, folder, CFG)
    tagged = density.density_topics(
        points, "position", CFG.reduced_dims, views.RADIUS, views.MIN_POINTS, CFG.min_topic_size
    )
    return tagged.select("vec_id", "label", "topic")


def _neighbours(spark, folder):
    given = views.planted_vectors(spark, folder).select(F.col("vec_id").alias("id"), "vector", "label")
    distinct, members = neighbours.points(given)
    edges = neighbours.nearest(distinct, views.NEIGHBOURS, bucket=views.BUCKET)
    return given, distinct, members, edges


@query
def neighbour_graph(spark, folder):
    """The nearest vectors of each vector by cosine."""
    given = views.planted_vectors(spark, folder).select(F.col("vec_id").alias("id"), "vector")
    graph = neighbours.neighbour_graph(given, views.NEIGHBOURS, bucket=views.BUCKET)
    return graph.withColumn("similarity", F.round("similarity", 6))


@query
def spanning_forest(spark, folder):
    _, _, _, edges = _neighbours(spark, folder)
    return forest.minimum_forest(forest.mutual_edges(edges, views.CORE_NEIGHBOURS))


@query
def forest_topics(spark, folder):
    """Topics of varying density: the forest cut where an edge is long for its surroundings."""
    given, distinct, members, edges = _neighbours(spark, folder)
    found = forest.topics(distinct, edges, views.CORE_NEIGHBOURS, views.CUT_FACTOR, CFG.min_topic_size)
    named = members.join(found, "id").select(F.col("member").alias("id"), "topic")
    return given.join(named, "id").select(F.col("id").alias("vec_id"), "label", "topic")


@query
def unit_vectors(spark, folder):
    """Sparse TF-IDF vectors of 2^18 dimensions, one row for each weight."""
    weights = vectors.unit_weights(units.units(_relevant(spark, folder), CFG))
    return weights.select("unit_id", "index", F.round("weight", 6).alias("weight"))


def _ml_vectors(spark, folder):
    return views.planted_vectors(spark, folder).withColumn("vector", array_to_vector("vector"))


@query
def reduced_vectors(spark, folder):
    return topics.reduce_by_pca(_ml_vectors(spark, folder), CFG.reduced_dims).select(
        "vec_id", "reduced"
    )


@query
def kmeans_topics(spark, folder):
    return topics.kmeans_topics(_ml_vectors(spark, folder), 10, CFG).select(
        "vec_id", "label", "topic"
    )


@query
def units_clustered(spark, folder):
    return topics.clustered_units(_relevant(spark, folder), CFG)


# ---- trends ------------------------------------------------------------------


def _relevant_years(spark, folder):
    return _relevant(spark, folder).select("doc_id", "year")


@query
def period_spine(spark, folder):
    counts = trends.documents_per_period(_years(spark, folder), CFG)
    spine = trends.period_spine(spark, CFG)
    joined = spine.join(counts.select("bucket", "n_docs"), "bucket", "left")
    return joined.na.fill(0, ["n_docs"]).orderBy("bucket")


@query
def docs_per_bucket(spark, folder):
    return trends.documents_per_period(_relevant_years(spark, folder), CFG).orderBy("bucket")


@query
def bucketed_mentions(spark, folder):
    rows = _normalised(spark, folder).select("doc_id", "start_char", "label")
    return trends.with_period(rows, _years(spark, folder), CFG)


def _label_rows(spark, folder):
    return _normalised(spark, folder).where(F.col("label").isin(*FOCUS_LABELS))


def _competitors(spark, folder):
    return _normalised(spark, folder).where(F.col("label") == "COMPETING_MATERIAL")


def _subtype(spark, folder, name):
    return _normalised(spark, folder).where((F.col("label") == "APPLICATION") & (F.col("subtype") == name))


def _counts(spark, folder, rows, category="canonical_entity", mode="docs"):
    return trends.prevalence(rows, _years(spark, folder), category, CFG, mode)


@query
def prevalence_docs(spark, folder):
    return _counts(spark, folder, _label_rows(spark, folder))


@query
def prevalence_mentions(spark, folder):
    return _counts(spark, folder, _label_rows(spark, folder), mode="mentions")


@query
def competitor_trends(spark, folder):
    counts = _counts(spark, folder, _competitors(spark, folder))
    return trends.trend_matrix(counts, "canonical_entity", CFG)


@query
def application_trends(spark, folder):
    counts = _counts(spark, folder, _subtype(spark, folder, "application"))
    return trends.trend_matrix(counts, "canonical_entity", CFG)


@query
def component_trends(spark, folder):
    counts = _counts(spark, folder, _subtype(spark, folder, "component"))
    return trends.trend_matrix(counts, "canonical_entity", CFG)


@query
def application_top(spark, folder):
    counts = _counts(spark, folder, _subtype(spark, folder, "application"))
    return trends.top_categories(counts, "canonical_entity", CFG, 8)


@query
def component_top(spark, folder):
    counts = _counts(spark, folder, _subtype(spark, folder, "component"))
    return trends.top_categories(counts, "canonical_entity", CFG, 8)


@query
def entity_trends(spark, folder):
    counts = _counts(spark, folder, _label_rows(spark, folder), "label")
    return trends.period_matrix(counts, "label", FOCUS_LABELS, CFG)


@query
def period_shares(spark, folder):
    counts = _counts(spark, folder, _competitors(spark, folder))
    per_period = trends.documents_per_period(_relevant_years(spark, folder), CFG)
    return trends.period_shares(counts, per_period, "canonical_entity", CFG)


def _top_shares(spark, folder, subtype):
    counts = _counts(spark, folder, _subtype(spark, folder, subtype))
    per_period = trends.documents_per_period(_relevant_years(spark, folder), CFG)
    return trends.top_shares(counts, per_period, "canonical_entity", CFG)


@query
def application_shares(spark, folder):
    return _top_shares(spark, folder, "application")


@query
def component_shares(spark, folder):
    return _top_shares(spark, folder, "component")


@query
def topic_named_trends(spark, folder):
    matrix = trends.trend_matrix(_topic_counts(spark, folder), "topic", CFG)
    return topics.named_trends(matrix, topics.topic_names(views.assigned_topics(spark, folder, CFG)))


@query
def unitisation_comparison(spark, folder):
    return trends.unitisation_comparison(
        _competitors(spark, folder), _years(spark, folder), "label", CFG
    )


def _topic_counts(spark, folder):
    unit_table = views.assigned_topics(spark, folder, CFG)
    return trends.prevalence(unit_table, _years(spark, folder), "topic", CFG)


@query
def topic_trends(spark, folder):
    return trends.trend_matrix(_topic_counts(spark, folder), "topic", CFG)


@query
def topic_top_trends(spark, folder):
    real = _topic_counts(spark, folder).where(F.col("topic") != topics.NOISE)
    return trends.top_categories(real, "topic", CFG, 5)


@query
def topic_selected_trends(spark, folder):
    chosen = _topic_counts(spark, folder).where(F.col("topic").isin(*SELECTED_TOPICS))
    return trends.trend_matrix(chosen, "topic", CFG)


# ---- prices ------------------------------------------------------------------


@query
def cost_bridge(spark, folder):
    return pricing.cost_bridge(_normalised(spark, folder), pricing.default_roles(spark), CFG)


@query
def cost_role_counts(spark, folder):
    return pricing.role_counts(_bridge(spark, folder))


@query
def thickness_recall(spark, folder):
    return pricing.thickness_recall(_bridge(spark, folder), CFG)


@query
def unparsed_grades(spark, folder):
    return pricing.unparsed_grades(_bridge(spark, folder), CFG)


@query
def grade_prices(spark, folder):
    return pricing.grade_prices(_bridge(spark, folder))


@query
def thickness_groups(spark, folder):
    return pricing.thickness_groups(_bridge(spark, folder))


@query
def thickness_histogram(spark, folder):
    return pricing.thickness_histogram(_bridge(spark, folder))


@query
def price_stats(spark, folder):
    return pricing.price_stats(_bridge(spark, folder))


@query
def price_curve(spark, folder):
    return pricing.price_curve(_bridge(spark, folder), CFG)


@query
def price_sensitivity(spark, folder):
    return pricing.price_sensitivity(_bridge(spark, folder), CFG)


@query
def price_preview(spark, folder):
    return sampling.price_preview(pricing.grade_prices(_bridge(spark, folder)))


@query
def sensitivity_preview(spark, folder):
    return sampling.sensitivity_preview(pricing.price_sensitivity(_bridge(spark, folder), CFG))


# ---- samples -----------------------------------------------------------------


@query
def stratified_sample(spark, folder):
    return sampling.stratified(_entities(spark, folder), CFG)


@query
def scope_sample(spark, folder):
    return sampling.scope_groups(_entities(spark, folder), CFG)


@query
def annotation_precision(spark, folder):
    digit = F.substring(F.md5(F.concat_ws("|", "doc_id", "start_char")), 1, 1)
    mark = F.when(digit < "b", "Y").when(digit < "e", "N").otherwise("n/a")
    return sampling.precision(_entities(spark, folder).withColumn("mark", mark), "label")
