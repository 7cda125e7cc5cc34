"""Ingestion, years, relevance, lexicon files, units and stages."""

import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from papervein.config import Config
from papervein.operators import corpus, relevance, units
from papervein.operators.joins import fits_broadcast, literal_table
from papervein.plans import fixtures, stages
from papervein.sources import readers
from papervein.sources.workspace import Workspace
from papervein.streaming.arrivals import mine_arrivals

CFG = Config()


def pages(spark, rows):
    return spark.createDataFrame(rows, "source_path STRING, pages ARRAY<STRING>")


def test_canonical_rows(spark):
    rows = corpus.canonical_rows(
        pages(spark, [("/a/x.pdf", [" one\u00a0two\n", "\u2003three\x1c "]), ("/a/y.pdf", None)]), "2026-02-03"
    ).orderBy("source_path").collect()
    assert [r["text"] for r in rows] == ["one two three", None]
    assert rows[0]["doc_id"] == hashlib.md5(b"/a/x.pdf").hexdigest()
    assert rows[0]["ingest_date"] == datetime.date(2026, 2, 3)
    counts = corpus.token_counts(corpus.canonical_rows(pages(spark, [("a", ["x  y"]), ("b", None), ("c", [""])]), "2026-01-01"))
    assert sorted(r["token_count"] for r in counts.collect()) == [0, 0, 2]


def test_year_precedence(spark):
    listed = spark.createDataFrame(
        [(1, "/z/a.pdf", "2001.0"), (2, "/q/a.pdf", "2002"), (3, "/z/b.pdf", None), (4, None, "1999"),
         (5, "/z/c.pdf", "2003"), (6, "/z/d.pdf", "unknown")],
        "ordinal LONG, attachment STRING, year STRING",
    )
    manual = spark.createDataFrame(
        [(1, "c.pdf", "1990"), (2, "c.pdf", "1991"), (3, "e.pdf", None)],
        "ordinal LONG, filename STRING, year STRING",
    )
    years = corpus.year_table(listed, manual)
    assert {r[0]: r[1] for r in years.collect()} == {
        "a": 2002, "c": 1991, "d": None, "e": None,
    }
    docs = corpus.canonical_rows(pages(spark, [("/k/a.pdf", ["t"]), ("/k/b.pdf", ["t"]), ("/k/c.pdf", None)]), "2026-01-01")
    dated = corpus.attach_year(corpus.described(docs), years)
    assert {r["filename"]: r["year"] for r in dated.collect()} == {"a.pdf": 2002, "b.pdf": None, "c.pdf": 1991}
    assert [r[0] for r in corpus.missing_years(dated).collect()] == ["b.pdf"]
    assert tuple(corpus.ingest_summary(dated).first()) == (3, 2, 1, 1)
    gaps = {tuple(r) for r in corpus.bibliography_gaps(docs, listed).collect()}
    assert gaps == {("d.pdf", "file_absent")}


def test_relevance_counts_each_term_once_as_a_substring(spark):
    texts = ["Grain GRAIN and ingot ngo", None, "", "Non-Grain-Oriented", "unrelated words"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id LONG, text STRING")
    hits = {r["doc_id"]: r["domain_term_hits"] for r in relevance.with_hits(rows, CFG).collect()}

    def expected(text):
        return sum(t.lower() in (text or "").lower() for t in CFG.domain_terms)

    assert hits == {i: expected(t) for i, t in enumerate(texts)}
    tagged = relevance.tag(rows, Config(relevance_threshold=2))
    assert tuple(relevance.summary(tagged).first()) == (5, 2, 3)
    status = relevance.status_list(tagged.withColumn("source_path", F.lit(None).cast("string"))).collect()
    assert {(r["status"], r["document"]) for r in status} >= {("KEEP", "0"), ("DROP", "1")}


def test_lexicon_folder(spark, tmp_path):
    (tmp_path / "applications.txt").write_text(" traction motor \n\nγ-drive\n", encoding="utf-8")
    (tmp_path / "other.txt").write_text("ignored\n")
    lexicon = readers.read_lexicon(spark, str(tmp_path))
    assert sorted(tuple(r) for r in lexicon.collect()) == [
        ("APPLICATION", "traction motor"), ("APPLICATION", "γ-drive"),
    ]
    assert [tuple(r) for r in readers.lexicon_counts(lexicon).collect()] == [("APPLICATION", 2)]


def test_csv_years_keep_row_order(spark, tmp_path):
    bib, man = tmp_path / "b.csv", tmp_path / "m.csv"
    bib.write_text('Key,File Attachments,Publication Year\n1,"C:/x/a.pdf",1999\n2,"/x/a.pdf",2000\n3,,2001\n')
    man.write_text("filename,year\nb.pdf,2010\nb.pdf,2011\n")
    years = corpus.year_table(readers.read_bibliography(spark, str(bib)), readers.read_manual_years(spark, str(man)))
    assert {r[0]: r[1] for r in years.collect()} == {"a": 2000, "b": 2011}


def test_years_that_are_none(spark):
    odd = [("a", "NaN"), ("b", "inf"), ("c", "99999999999"), ("d", "1999.7"), ("e", "x"), ("f", "-Infinity"), ("g", None)]
    manual = spark.createDataFrame([(i, f"{n}.pdf", y) for i, (n, y) in enumerate(odd)], "ordinal LONG, filename STRING, year STRING")
    empty = spark.createDataFrame([], "ordinal LONG, attachment STRING, year STRING")
    got = {r[0]: r[1] for r in corpus.year_table(empty, manual).collect()}
    assert got == {n: 1999 if n == "d" else None for n, _ in odd}


NAMES = ("Bohn et al. - 2020 - Steel.txt", "50% +x (1).txt", "a+b%20c.TXT", "é ü.txt", "plain.txt")


def test_real_file_names_and_a_damaged_file(spark, tmp_path):
    for name in NAMES:
        (tmp_path / name).write_text(f"text of {name}\fpage two", encoding="utf-8")
    (tmp_path / "damaged.txt.gz").write_bytes(b"\x1f\x8bnot an archive")
    pages = readers.read_text_documents(spark, str(tmp_path), "*.{txt,TXT,gz}")
    got = {r["source_path"].rsplit("/", 1)[1]: r["pages"] for r in pages.collect()}
    assert got == {n: [f"text of {n}", "page two"] for n in NAMES} | {"damaged.txt.gz": None}
    listed = [(i, f"/lib/{n.rsplit('.', 1)[0]}.pdf", str(2000 + i)) for i, n in enumerate(NAMES)]
    bib = spark.createDataFrame(listed, "ordinal LONG, attachment STRING, year STRING")
    none = spark.createDataFrame([], "ordinal LONG, filename STRING, year STRING")
    described = corpus.described(corpus.canonical_rows(pages, "2026-01-01"))
    dated = corpus.attach_year(described, corpus.year_table(bib, none)).collect()
    assert {r["filename"]: r["year"] for r in dated} == {n: 2000 + i for i, n in enumerate(NAMES)} | {"damaged.txt.gz": None}
    assert [r["filename"] for r in dated if not r["extracted"]] == ["damaged.txt.gz"]


def test_lexicon_report(spark, tmp_path):
    (tmp_path / "standards.txt").write_text("A 1\n\nB 2\n")
    report = {r["file"]: (r["n_terms"], r["missing"]) for r in readers.lexicon_report(spark, str(tmp_path)).collect()}
    assert report["standards.txt"] == (2, False) and report["producers.txt"] == (0, True) and len(report) == 8


def test_chunks(spark):
    texts = {1: "ab🙂" * 400, 2: "x" * 99, 3: "y\n" * 260, 4: None, 5: ""}
    rows = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    got = {(r["doc_id"], r["unit_id"]): r["text"] for r in units.units(rows, CFG).collect()}
    want = {}
    for i, t in texts.items():
        for at in range(0, len(t or ""), 500):
            if len(t[at:at + 500]) >= 100:
                want[(i, f"{i}_chunk_{at}")] = t[at:at + 500]
    assert got == want
    every = units.units(rows, Config(chunk_min_chars=1)).where("doc_id = 3").collect()
    by_start = sorted(every, key=lambda r: int(r["unit_id"].rsplit("_", 1)[1]))
    assert "".join(r["text"] for r in by_start) == texts[3]
    assert units.units(rows, Config(cluster_unit="document")).count() == 4
    assert tuple(units.unit_summary(units.units(rows, CFG)).first()) == (2, 4)
    with pytest.raises(ValueError):
        units.units(rows, Config(cluster_unit="page"))


def test_measured_broadcast(spark):
    table = spark.range(1000).withColumn("s", F.lit("x" * 100))
    assert fits_broadcast(table) and not fits_broadcast(table, 100_000)
    assert fits_broadcast(table.limit(0), 0)
    odd = literal_table(spark, "a STRING,b INT", [("it's :v0_0 ? \\ \"q\"", 1)])
    assert tuple(odd.first()) == ("it's :v0_0 ? \\ \"q\"", 1)


def corpus_texts():
    pools = (fixtures.GRADE_SENTENCES, fixtures.USE_SENTENCES, fixtures.STRENGTH_SENTENCES, fixtures.SUBJECT_SENTENCES)
    return [" ".join(pool[i % len(pool)] for pool in pools) for i in range(40)]


def test_all_stages(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    for i, text in enumerate(corpus_texts()):
        (raw / f"p{i}.txt").write_text(text.replace(" the ", " the\f "), encoding="utf-8")
    (raw / "bib.csv").write_text(
        "File Attachments,Publication Year\n" + "".join(f"/lib/p{i}.txt,{1990 + i}\n" for i in range(35))
    )
    (raw / "man.csv").write_text("filename,year\np0.txt,2024\n")
    ws = Workspace(spark, str(tmp_path / "out"))
    with pytest.raises(FileNotFoundError):
        stages.filter_corpus(ws, CFG)
    dated = stages.build_corpus(
        ws, readers.read_text_documents(spark, str(raw)), readers.read_bibliography(spark, str(raw / "bib.csv")),
        readers.read_manual_years(spark, str(raw / "man.csv")), "2026-01-01",
    )
    assert dated.count() == 40
    assert sorted(r[0] for r in ws.required("missing_years").collect()) == [f"p{i}.txt" for i in range(35, 40)]
    cfg = Config(relevance_threshold=5)
    tagged = stages.filter_corpus(ws, cfg)
    assert tagged.count() == 40
    relevant = tagged.where("is_relevant").count()
    assert 0 < relevant < 40
    stages.trends_over_time(ws, cfg)
    assert ws.optional("competitor_trends") is None
    lexicon = literal_table(spark, "label STRING,term STRING", fixtures.LEXICON)
    entities = stages.extract_entities(ws, cfg, lexicon)
    assert ws.required("label_counts").agg(F.sum("n")).first()[0] == entities.count()
    normal = stages.normalise_entities(ws, cfg)
    assert normal.count() == entities.count()
    for name in ("alias_pairs", "subtype_members", "label_samples", "value_preview"):
        assert ws.required(name).count()
    stages.cluster_units(ws, Config(relevance_threshold=5, chunk_min_chars=10, min_topic_size=2, min_points=2))
    assert ws.required("topic_top_sizes").count() <= 12
    stages.trends_over_time(ws, cfg, (0, 1))
    assert ws.required("topic_trends").where("topic_name IS NULL").isEmpty()
    for name in ("competitor", "application", "component"):
        shares = ws.required(f"{name}_shares")
        for row in shares.groupBy("bucket_label").agg(F.sum("n").alias("n"), F.max("total").alias("t")).collect():
            assert row["n"] == row["t"]
        assert name == "competitor" or shares.select("canonical_entity").distinct().count() <= 8
    stages.bridge_costs(ws, cfg)
    stages.evaluate(ws, cfg)
    names = {r[0] for r in ws.required("grade_prices").select("entity_text").collect()}
    assert {"35A300", "M300-35A5", "NO30-1600", "50JNE300"} <= names
    ws.export_csv("price_sensitivity")
    assert list((tmp_path / "out/csv/price_sensitivity").glob("*.csv"))


def test_command_line(spark, tmp_path, capsys):
    from papervein import __main__ as cli

    raw, lex = tmp_path / "raw", tmp_path / "lex"
    raw.mkdir(), lex.mkdir()
    for i, text in enumerate(corpus_texts()):
        (raw / f"p {i}.txt").write_text(text, encoding="utf-8")
    (raw / "bib.csv").write_text("File Attachments,Publication Year\n" + "".join(f"/lib/p {i}.pdf,{1990 + i}\n" for i in range(40)))
    (raw / "man.csv").write_text("filename,year\n")
    (lex / "applications.txt").write_text("traction motor\n")
    (raw / "roles.csv").write_text("label,cost_role\nGRADE,other\n")
    root = str(tmp_path / "out")
    cli.main(["corpus", "--root", root, "--documents", str(raw), "--bibliography", str(raw / "bib.csv"), "--manual", str(raw / "man.csv")])
    assert spark.read.parquet(f"{root}/missing_years").count() == 0
    cli.main(["filter", "--root", root, "--threshold", "0"])
    assert spark.read.parquet(f"{root}/relevance").where("is_relevant").count() == 40
    (raw / "terms.lst").write_text("Traction Motor\n\nno such term at all\n")
    cli.main(["filter", "--root", root, "--threshold", "1", "--terms", str(raw / "terms.lst")])
    held = {i for i, t in enumerate(corpus_texts()) if "traction motor" in t.lower()}
    assert spark.read.parquet(f"{root}/relevance").where("is_relevant").count() == len(held)
    cli.main(["entities", "--root", root, "--threshold", "1", "--lexicon", str(lex), "--terms", str(raw / "terms.lst"), "--learn-sentences"])
    assert spark.read.parquet(f"{root}/entities").select("doc_id").distinct().count() == len(held)
    assert "word" in spark.read.parquet(f"{root}/abbreviations").columns
    cli.main(["filter", "--root", root, "--threshold", "0"])
    cli.main(["entities", "--root", root, "--threshold", "0", "--lexicon", str(lex)])
    assert "producers.txt" in capsys.readouterr().err
    cli.main(["normalise", "--root", root])
    cli.main(["bridge", "--root", root, "--roles", str(raw / "roles.csv")])
    assert [r[0] for r in spark.read.parquet(f"{root}/cost_role_counts").select("cost_role").collect()] == ["other"]
    cfg = cli.config(cli.parser().parse_args(["trends", "--root", "x", "--period-years", "10", "--radius", "0.25"]))
    assert (cfg.period_years, cfg.radius, cfg.seed) == (10, 0.25, 42)


def test_arrivals_match_batch(spark, tmp_path):
    from papervein.operators import extraction

    cfg = Config(relevance_threshold=5)
    broken = [t.replace(" of ", "\n of\t").replace(" MPa", "\n\nMPa") for t in corpus_texts()]
    docs, raw = (
        spark.createDataFrame([(str(i), t, 2000) for i, t in enumerate(texts)], "doc_id STRING, text STRING, year INT")
        for texts in (corpus_texts(), broken)
    )
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    raw.repartition(3).write.parquet(source)
    lexicon = literal_table(spark, "label STRING,term STRING", fixtures.LEXICON)
    for _ in range(2):  # a second run finds nothing new
        stream = mine_arrivals(spark, source, target, str(tmp_path / "cp"), cfg, lexicon, files_per_batch=1)
        stream.awaitTermination(120)
        got = spark.read.parquet(target).drop("batch_id")
        want = extraction.entity_table(relevance.relevant(docs, cfg), cfg, lexicon)
        key = ["doc_id", "start_char", "end_char", "label", "scope_tag", "entity_text", "context"]
        assert sorted(map(str, got.select(key).collect())) == sorted(map(str, want.select(key).collect()))


def test_a_callers_decoder(spark, tmp_path):
    """One bad file is one row with its error; the others are read."""
    from papervein.operators import corpus
    from papervein.sources import readers

    folder = tmp_path / "files"
    folder.mkdir()
    for name, content in {"a b.bin": b"one\x00two", "c+d.bin": b"\xff\xfe", "e.bin": b"?", "f.other": b"x"}.items():
        (folder / name).write_bytes(content)

    def decode(content):
        if content == b"?":
            raise KeyError("nothing in it")
        return [*content.decode().split("\x00"), None]

    rows = {r["source_path"].rsplit("/", 1)[1]: r for r in readers.read_decoded(spark, str(folder), decode, "*.bin").collect()}
    assert rows["a b.bin"]["pages"] == ["one", "two", None] and rows["a b.bin"]["error"] is None
    assert rows["c+d.bin"]["pages"] is None and rows["c+d.bin"]["error"].startswith("UnicodeDecodeError: ")
    assert rows["e.bin"]["error"] == "KeyError: 'nothing in it'" and len(rows) == 3
    decoded = readers.decode_documents(spark.createDataFrame([("x", None), ("y", b"z")], "source_path STRING, content BINARY"), decode)
    assert {r["error"]: r["n"] for r in readers.decode_summary(decoded).collect()} == {None: 1, "ValueError: no content": 1}
    texts = corpus.canonical_rows(decoded.select("source_path", "pages"), "2026-01-01").select("text").collect()
    assert sorted(r["text"] or "" for r in texts) == ["", "z"]
