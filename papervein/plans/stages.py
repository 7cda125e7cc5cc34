"""The seven stages and the evaluation, each from tables to tables of a workspace.

Every stage writes what the next ones read, so the text is mined once and a lost executor
costs no more than the tasks it ran.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators import (
    abbreviations, corpus, extraction, normalise, pricing, relevance, sampling, topics, trends,
)
from papervein.operators.joins import sized
from papervein.sources.workspace import Workspace


def build_corpus(
    ws: Workspace, pages: DataFrame, bibliography: DataFrame, manual: DataFrame, ingest_date: str
) -> DataFrame:
    """Write the texts once, and beside them a narrow table with each document's year.

    Years are joined to the narrow table only, so no text is shuffled.
    """
    texts = ws.write(corpus.canonical_rows(pages, ingest_date), "corpus")
    years = ws.write(corpus.year_table(bibliography, manual), "years")
    documents = ws.write(corpus.attach_year(corpus.described(texts), years), "documents")
    ws.write(corpus.token_summary(documents), "corpus_token_summary")
    ws.write(corpus.ingest_summary(documents), "ingest_summary")
    ws.write(corpus.missing_years(documents), "missing_years")
    return documents


def filter_corpus(ws: Workspace, cfg: Config, terms: DataFrame | None = None) -> DataFrame:
    """Every document's tag and year, without its text; ``terms (term)`` replaces the built-in list."""
    corpus_texts = ws.required("corpus")
    if terms is None:
        hits = relevance.tag(corpus_texts, cfg).select("doc_id", "domain_term_hits", "is_relevant")
    else:
        hits = relevance.tag_by_list(corpus_texts, ws.write(terms, "relevance_terms"), cfg)
    documents = ws.required("documents").select("doc_id", "source_path", "year")
    tagged = ws.write(documents.join(hits, "doc_id"), "relevance")
    ws.write(relevance.summary(tagged), "relevance_summary")
    ws.write(relevance.status_list(tagged), "relevance_status")
    return tagged


def _relevant_texts(ws: Workspace, cfg: Config, by_list: bool = False) -> DataFrame:
    """Texts of relevant documents.  Counting the built-in terms again while the text is read
    is cheaper than joining it with the tags, which would shuffle it; tags by a list of terms
    (``by_list``) are joined."""
    if by_list:
        kept = ws.required("relevance").where("is_relevant").select("doc_id")
        return ws.required("corpus").select("doc_id", "text").join(sized(kept), "doc_id", "left_semi")
    return relevance.relevant(ws.required("corpus"), cfg).select("doc_id", "text")


def _relevant_years(ws: Workspace) -> DataFrame:
    return ws.required("relevance").where("is_relevant").select("doc_id", "year")


def extract_entities(
    ws: Workspace, cfg: Config, lexicon: DataFrame, lexicon_report: DataFrame | None = None,
    learn_sentences: bool = False, by_list: bool = False,
) -> DataFrame:
    """Mentions of the relevant texts; sentence bounds may be learnt from the whole corpus."""
    if lexicon_report is not None:
        ws.write(lexicon_report, "lexicon_report")
    bounds = None
    if learn_sentences:
        bounds = abbreviations.learn(ws.required("corpus").select("doc_id", "text"))
        ws.write(bounds.abbreviations, "abbreviations")
        ws.write(bounds.openers, "sentence_openers")
    table = extraction.entity_table(_relevant_texts(ws, cfg, by_list), cfg, lexicon, bounds=bounds)
    entities = ws.write(table, "entities", partition_by="label")
    ws.write(extraction.label_counts(entities), "label_counts")
    ws.write(extraction.scope_counts(entities), "scope_counts")
    ws.write(extraction.per_document(entities), "entities_per_document")
    ws.write(extraction.without_mentions(_relevant_years(ws), entities), "zero_mention_documents")
    return entities


def normalise_entities(
    ws: Workspace, cfg: Config, aliases: DataFrame | None = None, bounds: DataFrame | None = None
) -> DataFrame:
    aliases = normalise.default_aliases(ws.spark) if aliases is None else aliases
    bounds = normalise.default_bounds(ws.spark) if bounds is None else bounds
    table = normalise.normalise(ws.required("entities"), cfg, aliases, bounds)
    normalised = ws.write(table, "normalised", partition_by="label")
    ws.write(normalise.alias_pairs(normalised), "alias_pairs")
    ws.write(normalise.subtype_members(normalised), "subtype_members")
    ws.write(sampling.label_samples(normalised), "label_samples")
    ws.write(sampling.value_preview(normalised), "value_preview")
    return normalised


def cluster_units(
    ws: Workspace, cfg: Config, selected: tuple[int, ...] = (), by_list: bool = False
) -> DataFrame:
    """Topics of the relevant texts; names and sizes come from the written units."""
    units = ws.write(topics.clustered_units(_relevant_texts(ws, cfg, by_list), cfg), "units")
    named = units.groupBy("topic").agg(
        F.count(F.lit(1)).alias("n_units"), F.min("topic_name").alias("name")
    )
    ws.write(named, "topics")
    ws.write(topics.largest(units, 12, selected), "topic_top_sizes")
    return units


def trends_over_time(ws: Workspace, cfg: Config, selected: tuple[int, ...] = ()) -> None:
    """Trend tables of whatever is there: topics and entities are both optional."""
    documents = _relevant_years(ws)
    per_period = ws.write(trends.documents_per_period(documents, cfg), "docs_per_bucket")
    units = ws.optional("units")
    if units is not None:
        counts = ws.write(trends.prevalence(units, documents, "topic", cfg), "topic_counts")
        names = ws.required("topics")
        ws.write(topics.named_trends(trends.trend_matrix(counts, "topic", cfg), names), "topic_trends")
        real = counts.where(F.col("topic") != topics.NOISE)
        best = trends.top_categories(real, "topic", cfg, 5)
        ws.write(topics.named_trends(best, names), "topic_trends_top")
        if selected:
            chosen = counts.where(F.col("topic").isin(*selected))
            ws.write(topics.named_trends(trends.trend_matrix(chosen, "topic", cfg), names), "topic_trends_selected")
    entities = ws.optional("normalised")
    if entities is not None:
        is_application = F.col("label") == "APPLICATION"
        focus = {
            "competitor": F.col("label") == "COMPETING_MATERIAL",
            "application": is_application & (F.col("subtype") == "application"),
            "component": is_application & (F.col("subtype") == "component"),
        }
        for name, chosen in focus.items():
            found = trends.prevalence(entities.where(chosen), documents, "canonical_entity", cfg)
            counts = ws.write(found, f"{name}_counts")
            ws.write(trends.trend_matrix(counts, "canonical_entity", cfg), f"{name}_trends")
            if name == "competitor":
                shares = trends.period_shares(counts, per_period, "canonical_entity", cfg)
            else:  # shares among the eight largest
                shares = trends.top_shares(counts, per_period, "canonical_entity", cfg)
            ws.write(shares, f"{name}_shares")
        labels = ("APPLICATION", "COMPETING_MATERIAL")
        labelled = entities.where(F.col("label").isin(*labels))
        by_label = trends.prevalence(labelled, documents, "label", cfg)
        ws.write(trends.period_matrix(by_label, "label", labels, cfg), "entity_trends")


def bridge_costs(ws: Workspace, cfg: Config, roles: DataFrame | None = None) -> DataFrame:
    roles = pricing.default_roles(ws.spark) if roles is None else roles
    bridge = ws.write(
        pricing.cost_bridge(ws.required("normalised"), roles, cfg, keep=("start_char",)),
        "cost_bridge",
    )
    ws.write(pricing.role_counts(bridge), "cost_role_counts")
    ws.write(pricing.thickness_recall(bridge, cfg), "thickness_recall")
    ws.write(pricing.thickness_groups(bridge), "thickness_groups")
    ws.write(pricing.thickness_histogram(bridge), "thickness_histogram")
    ws.write(pricing.price_curve(bridge, cfg), "price_curve")
    ws.write(pricing.price_stats(bridge), "price_stats")
    ws.write(pricing.unparsed_grades(bridge, cfg), "unparsed_grades")
    return bridge


def evaluate(ws: Workspace, cfg: Config) -> None:
    bridge = ws.required("cost_bridge")
    ws.write(pricing.grade_prices(bridge), "grade_prices")
    ws.write(pricing.price_sensitivity(bridge, cfg), "price_sensitivity")
    documents = _relevant_years(ws)
    rivals = ws.required("normalised").where(F.col("label") == "COMPETING_MATERIAL")
    compared = trends.unitisation_comparison(rivals, documents, "label", cfg)
    ws.write(compared, "unitisation_comparison")
    entities = ws.required("entities")
    ws.write(sampling.stratified(entities, cfg), "precision_sample")
    ws.write(sampling.scope_groups(entities, cfg), "scope_sample")
