"""``spark-submit -m papervein`` style entry: run one stage of a workspace.

    python -m papervein corpus     --root OUT --documents DIR --bibliography CSV --manual CSV
    python -m papervein filter     --root OUT
    python -m papervein entities   --root OUT --lexicon DIR
    python -m papervein normalise  --root OUT
    python -m papervein topics     --root OUT
    python -m papervein trends     --root OUT
    python -m papervein bridge     --root OUT
    python -m papervein evaluate   --root OUT

Any stage takes --threshold, --unit, --start-year, --end-year, --period-years and the other
parameters listed by --help.  --terms is a text file with one relevance term a line, of any
length; give it to filter, entities and topics alike.  --learn-sentences lets the entities
stage learn abbreviations from the corpus.  --aliases, --bounds and --roles are CSV files with a header that
replace the built-in tables.
"""

from __future__ import annotations

import argparse
import datetime
import sys
from dataclasses import replace

from pyspark.sql import SparkSession

from papervein.config import Config
from papervein.plans import stages
from papervein.sources import readers
from papervein.sources.workspace import Workspace

STAGES = ("corpus", "filter", "entities", "normalise", "topics", "trends", "bridge", "evaluate")


# Parameters of ``Config`` that can be given, by option.
PARAMETERS = {
    "threshold": ("relevance_threshold", int), "unit": ("cluster_unit", str),
    "chunk-chars": ("chunk_chars", int), "chunk-min-chars": ("chunk_min_chars", int),
    "start-year": ("start_year", int), "end-year": ("end_year", int), "period-years": ("period_years", int),
    "min-topic-size": ("min_topic_size", int), "min-points": ("min_points", int),
    "radius": ("radius", float), "dims": ("reduced_dims", int),
    "reduction": ("reduction", str), "seed": ("seed", int),
    "price-constant": ("price_constant", float),
}
TABLES = {
    "aliases": "label STRING, surface STRING, canonical STRING",
    "bounds": "resolved_property STRING, low DOUBLE, high DOUBLE",
    "roles": "label STRING, cost_role STRING",
}


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="papervein")
    out.add_argument("stage", choices=STAGES)
    out.add_argument("--root", required=True)
    for name in ("documents", "bibliography", "manual", "lexicon", *TABLES):
        out.add_argument(f"--{name}")
    out.add_argument("--terms", help="text file of relevance terms in place of the built-in ones")
    out.add_argument("--learn-sentences", action="store_true", help="learn abbreviations from the corpus")
    out.add_argument("--glob", default="*.txt", help="file names to read below --documents")
    out.add_argument("--ingest-date", default=datetime.date.today().isoformat())
    out.add_argument("--selected-topics", type=lambda s: tuple(map(int, s.split(","))), default=())
    for option, (name, kind) in PARAMETERS.items():
        out.add_argument(f"--{option}", dest=name, type=kind)
    return out


def config(args: argparse.Namespace) -> Config:
    given = {name: getattr(args, name) for name, _ in PARAMETERS.values()}
    return replace(Config(), **{name: value for name, value in given.items() if value is not None})


def main(arguments: list[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    spark = SparkSession.builder.appName(f"papervein-{args.stage}").getOrCreate()
    ws, cfg = Workspace(spark, args.root), config(args)

    def given(name: str):
        path = getattr(args, name)
        return spark.read.csv(path, header=True, schema=TABLES[name]) if path else None

    if args.stage == "corpus":
        stages.build_corpus(
            ws,
            readers.read_text_documents(spark, args.documents, args.glob),
            readers.read_bibliography(spark, args.bibliography),
            readers.read_manual_years(spark, args.manual),
            args.ingest_date,
        )
    elif args.stage == "filter":
        stages.filter_corpus(ws, cfg, readers.read_terms(spark, args.terms) if args.terms else None)
    elif args.stage == "entities":
        report = readers.lexicon_report(spark, args.lexicon)
        stages.extract_entities(ws, cfg, readers.read_lexicon(spark, args.lexicon), report,
                                args.learn_sentences, bool(args.terms))
        for row in ws.required("lexicon_report").where("missing").collect():  # the expected files at most
            print(f"warning: no lexicon file {row['file']}, so no {row['label']} terms", file=sys.stderr)
    elif args.stage == "normalise":
        stages.normalise_entities(ws, cfg, given("aliases"), given("bounds"))
    elif args.stage == "topics":
        stages.cluster_units(ws, cfg, args.selected_topics, bool(args.terms))
    elif args.stage == "trends":
        stages.trends_over_time(ws, cfg, args.selected_topics)
    elif args.stage == "bridge":
        stages.bridge_costs(ws, cfg, given("roles"))
    else:
        stages.evaluate(ws, cfg)


if __name__ == "__main__":
    main()
