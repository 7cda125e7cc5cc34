"""Mentions with character offsets: token patterns, lexicon phrases, overlaps, scope.

The text is read once.  Sentences and tokens are exploded inside the scan's stage and
dropped there unless a pattern or phrase starts at them; only found spans are shuffled,
grouped by sentence, so no group is larger than one sentence of one document.

Arrays are opened with the ``_outer`` generators and empty rows dropped behind them: for
the inner ones the optimizer adds a filter that computes the whole array a second time.

Input documents are ``(doc_id, text)`` with a unique id and cleaned whitespace
(``functions.text.clean_whitespace``).
"""

from __future__ import annotations

import math
import re
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from papervein.config import Config, TokenPattern, TokenTest
from papervein.functions import text as tx
from papervein.operators.abbreviations import Bounds, sentence_parts
from papervein.operators.checkpoints import cut_lineage
from papervein.operators.joins import BROADCAST_BYTES, fits_broadcast, literal_table, sized

ENTITY_COLUMNS = (
    "doc_id", "entity_text", "label", "scope_tag", "context", "start_char", "end_char",
)
SCOPED_COLUMNS = ("doc_id", "entity_text", "label", "scope_tag", "context")


def sentences(documents: DataFrame, bounds: Bounds | None = None) -> DataFrame:
    """``(doc_id, sent_id, sent_start, sentence)``; the sentences join back to the text.

    With ``bounds`` learnt from the corpus, a stop after an abbreviation ends none.
    """
    if bounds is None:
        parts = documents.select("doc_id", F.split("text", tx.SENTENCE_BREAK, -1).alias("_parts"))
    else:
        parts = sentence_parts(F.col("text"), bounds, documents)
    lengths = parts.withColumn("_lengths", F.transform("_parts", lambda part: F.length(part)))
    placed = lengths.withColumn("_starts", tx.running_starts(F.col("_lengths")))
    return placed.select(
        "doc_id", F.posexplode_outer(F.arrays_zip("_starts", "_parts")).alias("sent_id", "_s")
    ).select(
        "doc_id", "sent_id",
        F.col("_s._starts").alias("sent_start"),
        F.col("_s._parts").alias("sentence"),
    ).where(F.col("sentence") != "")


def _pieces() -> Column:
    return F.regexp_extract_all("sentence", F.lit(tx.PIECE), F.lit(0))


def with_tokens(sentence_table: DataFrame) -> DataFrame:
    """Add the token array, and the pieces (token and space) that offsets are read from."""
    pieces = sentence_table.withColumn("pieces", _pieces())
    return pieces.withColumn("tokens", F.transform("pieces", lambda piece: F.rtrim(piece)))


def tokens(documents: DataFrame) -> DataFrame:
    """``(doc_id, sent_id, token_id, token, start_char, end_char)``."""
    split = with_tokens(sentences(documents))
    sized = split.withColumn("_lengths", F.transform("pieces", lambda piece: F.length(piece)))
    placed = sized.withColumn("_starts", tx.running_starts(F.col("_lengths")))
    start = F.col("sent_start") + F.col("_t._starts")
    return placed.select(
        "doc_id", "sent_id", "sent_start",
        F.posexplode_outer(F.arrays_zip("_starts", "tokens")).alias("token_id", "_t"),
    ).select(
        "doc_id", "sent_id", "token_id",
        F.col("_t.tokens").alias("token"),
        start.alias("start_char"),
        (start + F.length("_t.tokens")).alias("end_char"),
    ).where(F.col("token").isNotNull())


def lexicon_phrases(lexicon: DataFrame) -> DataFrame:
    """Lexicon ``(label, term)`` as token sequences, cut by the same token grammar."""
    cut = lexicon.select(
        F.col("label").alias("phrase_label"),
        F.regexp_extract_all(
            tx.clean_whitespace(F.col("term")), F.lit(tx.TOKEN), F.lit(0)
        ).alias("phrase"),
    )
    # Terms that differ in spaces only are one sequence.
    return cut.where(F.size("phrase") > 0).distinct().select(
        "phrase_label", "phrase",
        F.element_at("phrase", 1).alias("first_token"),
        F.size("phrase").alias("phrase_tokens"),
    )


def _passes(token: Column, test: TokenTest) -> Column:
    if test.text is not None:
        return token == test.text
    if test.regex is not None:
        return token.rlike(test.regex)
    if test.one_of is not None:
        return token.isin(*test.one_of)
    return F.lower(token).isin(*test.lower_in)


def _may_start(token: Column, patterns: tuple[TokenPattern, ...]) -> Column:
    """Whether a token meets the first test of any pattern; regexes are tried as one.

    A common anchor in front lets the regex engine stop at the first character.
    """
    firsts = {p.tests[0] for p in patterns}
    regexes = sorted(t.regex for t in firsts if t.regex is not None)
    tests = [_passes(token, t) for t in firsts if t.regex is None]
    if regexes:
        anchor = "^" if all(regex.startswith("^") for regex in regexes) else ""
        tests.append(token.rlike(anchor + "(?:" + "|".join(f"(?:{r})" for r in regexes) + ")"))
    return reduce(or_, tests, F.lit(False))


def _matches_at(pattern: TokenPattern, position: Column) -> Column:
    each = [_passes(F.rtrim(F.get("pieces", position + i)), t) for i, t in enumerate(pattern.tests)]
    return reduce(and_, each)


# Up to so many first words of a lexicon, sentences are searched for each before they are cut
# into tokens.  More are tested token by token against a bitmap, at a cost that does not grow.
MAX_FIRST_WORDS = 40
# Bits of that bitmap for each first word, and the most in all (8 MB).
BITS_PER_WORD, MAX_BITS = 16, 1 << 26


def _first_characters(core: str) -> str | None:
    """What is inside a character class of all characters that a match may begin with, or None if unsure."""
    begins = re.match(r"(\\d|\[(?:[A-Za-z0-9](?:-[A-Za-z0-9])?)+\]|[A-Za-z0-9])(?![*?]|\{0)", core)
    if begins is None or "|" in re.sub(r"\([^()]*\)", "", core):
        return None
    return begins[1].strip("[]")


def _any_of(cores: list[str]) -> str:
    """One regex for all; a character that begins none of them is passed over by a single look."""
    begins = [_first_characters(core) for core in cores]
    look = "" if None in begins else f"(?=[{''.join(dict.fromkeys(begins))}])"
    return look + "(?:" + "|".join(f"(?:{core})" for core in cores) + ")"


def _may_hold(sentence: Column, cfg: Config, first_words: list[str]) -> Column | None:
    """A cheap condition that every sentence with a mention meets, or None if there is none.

    Tokens are pieces of the sentence, so what a first token must hold the sentence holds too.
    """
    tests = [sentence.contains(word) for word in sorted(first_words)]
    cores = []
    for test in {p.tests[0] for p in cfg.patterns}:
        if test.regex is not None:
            core = test.regex.removeprefix("^").removesuffix("$")
            if re.search(r"[$^]|\\[bBAzZG]|\(\?", core):  # may depend on what is around the token
                return None
            cores.append(core)
        elif test.text is not None:
            tests.append(sentence.contains(test.text))
        elif test.one_of is not None:
            tests += [sentence.contains(word) for word in test.one_of]
        else:
            tests += [F.lower(sentence).contains(word) for word in test.lower_in]
    if cores:
        tests.insert(0, sentence.rlike(_any_of(sorted(set(cores)))))
    return reduce(or_, tests, F.lit(False))


def first_word_bitmap(firsts: DataFrame, count: int) -> Column:
    """An array of 64-bit words with a bit set for the hash of every ``first_token``.

    Built by one aggregation; the array is a scalar of the plan, so the test below runs inside
    the scan's stage whatever the size of the lexicon.  Beyond ``MAX_BITS`` more tokens pass
    that begin nothing; the rows found are the same.
    """
    bits = 1 << max(10, math.ceil(math.log2(min(MAX_BITS, max(1, count) * BITS_PER_WORD))))
    at = F.pmod(F.xxhash64("first_token"), F.lit(bits))
    words = firsts.select(at.alias("_at")).groupBy(F.floor(F.col("_at") / 64).alias("id")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("_at") % 64).cast("int"))).alias("bits")
    )
    every = firsts.sparkSession.range(bits // 64).join(words, "id", "left")
    ordered = F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(ordered.alias("_all")).select(F.col("_all.bits")).scalar()


def _in_bitmap(token: Column, bitmap: Column) -> Column:
    at = F.pmod(F.xxhash64(token), F.size(bitmap).cast("long") * 64)
    return F.getbit(F.get(bitmap, F.floor(at / 64).cast("int")), (at % 64).cast("int")) == 1


def candidates(
    documents: DataFrame,
    cfg: Config,
    lexicon: DataFrame | None = None,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    bounds: Bounds | None = None,
) -> DataFrame:
    """Every span a pattern or phrase matches, overlaps included.

    ``(doc_id, sent_id, sentence, label, n_tokens, start_char, end_char, entity_text)``

    A lexicon is matched in two steps: a token that begins a phrase opens one candidate for
    each length of such phrases, and the candidate's whole token sequence is then looked up.
    So a first word that many phrases share costs no more than one that few do.  Phrases of a
    lexicon beyond ``max_broadcast_bytes`` are found where the text is read, by
    :func:`_found_where_read`; neither tokens nor spans are shuffled.  Only a lexicon that has
    phrases of more than ``MAX_KINDS`` labels and lengths is joined by shuffling the candidates
    or, if its first words alone exceed the bound, the tokens that pass the bitmap of them.
    """
    if lexicon is None and not cfg.patterns:
        raise ValueError("neither patterns nor a lexicon to match")
    parts = sentences(documents, bounds)
    phrases = firsts = bitmap = None
    first_words: list[str] = []
    if lexicon is not None:
        phrases = lexicon_phrases(lexicon)
        some = phrases.select("first_token").distinct().limit(MAX_FIRST_WORDS + 1).collect()
        whole = len(some) <= MAX_FIRST_WORDS and fits_broadcast(phrases, max_broadcast_bytes)
        if not whole:
            # Read several times below; what the lexicon is made from is not.
            phrases = cut_lineage(phrases)
            whole = fits_broadcast(phrases, max_broadcast_bytes)
        kinds = [] if whole else _kinds(phrases)
        if kinds and len(kinds) <= MAX_KINDS:
            return _found_where_read(parts, cfg, phrases, kinds, max_broadcast_bytes)
        length = F.struct(F.lit(None).cast("string").alias("label"), F.col("phrase_tokens").alias("n_tokens"))
        firsts = phrases.groupBy("first_token").agg(F.collect_set(length).alias("phrase_spans"))
        if len(some) <= MAX_FIRST_WORDS:
            first_words = [row[0] for row in some]
        else:
            bitmap = first_word_bitmap(firsts, firsts.count())
        if whole:
            phrases, firsts = F.broadcast(phrases), F.broadcast(firsts)
        elif fits_broadcast(firsts.select("first_token", F.to_json("phrase_spans")), max_broadcast_bytes):
            firsts = F.broadcast(firsts)
    # One test per token decides whether the full patterns are tried there.
    begins = _may_start(F.col("token"), cfg.patterns)
    if bitmap is None:
        hold = _may_hold(F.col("sentence"), cfg, first_words)
        rows = _placed_tokens(parts if hold is None else parts.where(hold))
    else:
        begins = begins | _in_bitmap(F.col("token"), bitmap)
        rows = _kept_tokens(parts, begins)
    return _looked_up(_opened(rows, cfg, firsts, begins), phrases)


def _placed_tokens(parts: DataFrame) -> DataFrame:
    """Every token ``(doc_id, sent_id, sentence, pieces, pos, token, start)``; offsets are summed once a sentence."""
    sized = with_tokens(parts).withColumn("_lengths", F.transform("pieces", lambda piece: F.length(piece)))
    placed = sized.withColumn("starts", tx.running_starts(F.col("_lengths")))
    return placed.select(
        "doc_id", "sent_id", "sent_start", "sentence", "pieces", "starts",
        F.posexplode_outer("tokens").alias("pos", "token"),
    ).withColumn("start", F.col("sent_start") + F.get("starts", F.col("pos")))


def _kept_tokens(parts: DataFrame, begins: Column) -> DataFrame:
    """The same rows of the tokens that may begin something; only these get an offset."""
    # A generated column: what is made of it does not cut the sentence again.
    cut = parts.select("doc_id", "sent_id", "sent_start", "sentence", F.inline(F.array(F.struct(_pieces().alias("pieces")))))
    tokens_of = cut.select("*", F.posexplode_outer("pieces").alias("pos", "_piece"))
    kept = tokens_of.withColumn("token", F.rtrim("_piece")).where(begins)
    before = F.array_join(F.slice("pieces", F.lit(1), F.col("pos")), "")
    return kept.withColumn("start", F.col("sent_start") + F.length(before))


def _opened(rows: DataFrame, cfg: Config, firsts: DataFrame | None, begins: Column) -> DataFrame:
    """Spans of matched patterns, and spans of the lengths a phrase may have, without label."""
    pos = F.col("pos")
    # No lambda over the sentence from here on: it would copy its arrays for every token.
    opened = nothing = F.array().cast("array<struct<label: string, n_tokens: int>>")
    if cfg.patterns:
        opened = F.array(*[
            F.when(_matches_at(p, pos), F.struct(F.lit(p.label).alias("label"), F.lit(p.n_tokens).alias("n_tokens")))
            for p in cfg.patterns
        ])
    if firsts is not None:
        rows = rows.join(firsts, F.col("token") == F.col("first_token"), "left")
        begins = begins | F.col("first_token").isNotNull()
        opened = F.concat(opened, F.coalesce("phrase_spans", nothing))
    hits = rows.where(begins).withColumn("_hit", F.explode_outer(opened)).where(F.col("_hit").isNotNull())
    count = F.col("_hit.n_tokens")
    # Near the end of a sentence fewer tokens may be left than a phrase of that length has.
    hits = hits.where(pos + count <= F.size("pieces"))
    spans = hits.select(
        "doc_id", "sent_id", "sentence",
        F.col("_hit.label").alias("label"), count.alias("n_tokens"), F.col("start").alias("start_char"),
        F.rtrim(F.array_join(F.slice("pieces", pos + 1, count), "")).alias("entity_text"),
        F.transform(F.slice("pieces", pos + 1, count), lambda piece: F.rtrim(piece)).alias("_sequence"),
    )
    return spans.withColumn("end_char", F.col("start_char") + F.length("entity_text"))


SPAN_COLUMNS = (
    "doc_id", "sent_id", "sentence", "label", "n_tokens", "start_char", "end_char", "entity_text",
)


def _looked_up(spans: DataFrame, phrases: DataFrame | None) -> DataFrame:
    """The spans with a label: a pattern's own, or that of the phrase they are."""
    if phrases is None:
        return spans.select(*SPAN_COLUMNS)
    # Spans of patterns look up a sequence that no phrase has, another for each document.
    unlike = F.array(F.lit(" "), F.col("doc_id").cast("string"))
    keyed = spans.withColumn("_sequence", F.when(F.col("label").isNull(), F.col("_sequence")).otherwise(unlike))
    joined = keyed.join(
        phrases.select(F.col("phrase").alias("_sequence"), "phrase_label"), "_sequence", "left"
    )
    label = F.coalesce("label", "phrase_label")
    return joined.withColumn("label", label).where(F.col("label").isNotNull()).select(*SPAN_COLUMNS)


# ---- lexicons beyond the broadcast bound ---------------------------------------

# Most labels and lengths of phrases that are told apart by bits, and most words of 64 bits in the
# table of first tokens (16 MB) and in that of phrases (32 MB).  Beyond that more spans pass the
# tables and are looked up by a join; the rows found are the same.
MAX_KINDS, MAX_FIRST_SLOTS, MAX_PHRASE_WORDS = 256, 1 << 21, 1 << 22
# Words of a table that one task puts in order.
RUN = 1 << 12
_HITS = "array<struct<label: string, n_tokens: int, kind: int>>"


def _kinds(phrases: DataFrame) -> list[tuple[str, int]]:
    """The labels and lengths of phrases, ``MAX_KINDS`` and one more at most."""
    labelled = phrases.where(F.col("phrase_label").isNotNull())
    found = labelled.select("phrase_label", "phrase_tokens").distinct().limit(MAX_KINDS + 1).collect()
    return sorted(tuple(row) for row in found)


def _power(least: int, most: int) -> int:
    return min(most, 1 << max(0, math.ceil(math.log2(max(1, least)))))


def _dense(words: DataFrame, size: int) -> Column:
    """``(id, word)`` as an array of ``size`` words, zero where there is none: a scalar of the plan."""
    every = words.sparkSession.range(size).join(words, "id", "left")
    word = F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    runs = every.groupBy(F.floor(F.col("id") / RUN).alias("run")).agg(F.sort_array(F.collect_list(word)).alias("_all"))
    whole = runs.agg(F.sort_array(F.collect_list(F.struct("run", F.col("_all.word").alias("words")))).alias("_all"))
    return cut_lineage(whole.select(F.flatten("_all.words").alias("words"))).scalar()


def _bit(position: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), position.cast("int"))


def _four_bits(code: Column) -> Column:
    """Four bits of a word that the upper 24 bits of a code choose."""
    return reduce(Column.bitwiseOR, [_bit(F.shiftrightunsigned(code, at).bitwiseAND(F.lit(63))) for at in (40, 46, 52, 58)])


def _low(code: Column, size: int) -> Column:
    return code.bitwiseAND(F.lit(size - 1).cast("long"))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Generated columns: what is made of them does not compute them again."""
    return df.select("*", F.inline(F.array(F.struct(*[column.alias(name) for name, column in columns.items()]))))


def _phrase_code(sequence_hash: Column, kind: Column) -> Column:
    """64 bits that stand for a token sequence with a label and a length."""
    return F.xxhash64(sequence_hash, kind)


def _pair_code(pair_hash: Column, kind: Column) -> Column:
    """64 bits that stand for the first two tokens of longer phrases with a label and a length."""
    return F.xxhash64(pair_hash, F.lit(-1) - kind)


def _found_where_read(
    parts: DataFrame, cfg: Config, phrases: DataFrame, kinds: list[tuple[str, int]], max_broadcast_bytes: int
) -> DataFrame:
    """Spans of patterns and phrases, found inside the scan's stage whatever the size of the lexicon.

    Two tables of bits are scalars of the plan.  The first has, for a token's hash, the kinds
    (label and length) of the phrases that it begins; the second tells a phrase, and the first
    two tokens of longer ones, by four bits of one word.  A first reading of the texts collects
    the 64-bit codes of what passes both; those that no phrase has are left out of the second
    reading by a broadcast.  So only codes, once a task, are shuffled here, and spans are exact
    up to 64-bit codes of token sequences.
    """
    spark = phrases.sparkSession
    table = literal_table(spark, "phrase_label STRING,phrase_tokens INT,kind INT", [(*kind, i) for i, kind in enumerate(kinds)])
    kind = F.col("kind")
    coded = phrases.join(F.broadcast(table), ["phrase_label", "phrase_tokens"]).select(
        F.xxhash64("first_token").alias("_first"), "kind", _phrase_code(F.xxhash64("phrase"), kind).alias("_code"),
        F.when(F.col("phrase_tokens") > 2, _pair_code(F.xxhash64(F.get("phrase", F.lit(0)), F.get("phrase", F.lit(1))), kind)).alias("_pair"),
    )
    sizes = coded.agg(F.approx_count_distinct("_first"), F.count("_code"), F.count("_pair")).first()
    slots, words = _power(2 * sizes[0], MAX_FIRST_SLOTS), _power((sizes[1] + sizes[2]) // 4, MAX_PHRASE_WORDS)
    last = F.lit(63)
    kinds_of = coded.groupBy(_low(F.col("_first"), slots).alias("id")).agg(F.bit_or(_bit(F.least(kind, last))).alias("word"))
    codes = coded.select(F.explode(F.array("_code", "_pair")).alias("_code")).where(F.col("_code").isNotNull())
    four_of = codes.groupBy(_low(F.col("_code"), words).alias("id")).agg(F.bit_or(_four_bits(F.col("_code"))).alias("word"))
    first_table, phrase_table = _dense(kinds_of, slots), _dense(four_of, words)

    def known(code: Column) -> Column:
        four = _four_bits(code)
        return F.get(phrase_table, _low(code, words).cast("int")).bitwiseAND(four) == four

    pos, count = F.col("pos"), F.col("_hit.n_tokens")
    opened = F.array(*[
        F.struct(F.lit(label).alias("label"), F.lit(n).alias("n_tokens"), F.lit(i).alias("kind")) for i, (label, n) in enumerate(kinds)
    ])
    begins = F.col("_kinds") != 0
    cut = _once(_once(parts, pieces=_pieces()), _tokens=F.transform("pieces", lambda piece: F.rtrim(piece)))
    placed = cut.select("*", F.posexplode_outer("_tokens").alias("pos", "token"))
    rows = _once(placed, _kinds=F.get(first_table, _low(F.xxhash64("token"), slots).cast("int")))
    if cfg.patterns:
        matched = F.array(*[
            F.when(_matches_at(p, pos), F.struct(F.lit(p.label).alias("label"), F.lit(p.n_tokens).alias("n_tokens"), F.lit(-1).alias("kind")))
            for p in cfg.patterns
        ])
        may_start = _may_start(F.col("token"), cfg.patterns)
        begins, opened = begins | may_start, F.concat(F.when(may_start, matched).otherwise(F.array().cast(_HITS)), opened)
    paired = _once(rows.where(F.col("token").isNotNull() & begins), _two=F.xxhash64("token", F.get("_tokens", pos + 1)))
    hits = paired.withColumn("_hit", F.explode_outer(opened)).where(F.col("_hit").isNotNull())
    own, lexical = F.col("_hit.kind"), F.col("_hit.kind") >= 0
    # Near the end of a sentence fewer tokens may be left than a phrase of that length has.
    hits = hits.where(pos + count <= F.size("pieces")).where(~lexical | (F.getbit("_kinds", F.least(own, last)) == 1))
    sequence = F.xxhash64(F.slice("_tokens", pos + 1, count))
    hits = _once(hits, _tested=(
        F.when(count == 1, _phrase_code(F.xxhash64("token"), own)).when(count == 2, _phrase_code(F.col("_two"), own))
        .otherwise(_pair_code(F.col("_two"), own))
    )).where(~lexical | known(F.col("_tested")))
    hits = _once(hits, _code=F.when(lexical, F.when(count > 2, _phrase_code(sequence, own)).otherwise(F.col("_tested"))))
    hits = hits.where(~lexical | (count <= 2) | known(F.col("_code")))
    unlike = cut_lineage(
        hits.where(lexical).select("_code").distinct().join(coded.select("_code"), "_code", "left_anti")
    )
    keys = ["_code"]
    if cfg.patterns:
        # Spans of patterns are like none; a code of their document keeps them apart if the join is shuffled.
        hits = hits.withColumn("_lexical", lexical).withColumn("_code", F.coalesce("_code", F.xxhash64("doc_id")))
        unlike, keys = unlike.withColumn("_lexical", F.lit(True)), ["_code", "_lexical"]
    kept = hits.join(sized(unlike, max_broadcast_bytes), keys, "left_anti")
    before = F.array_join(F.slice("pieces", F.lit(1), pos), "")
    return kept.select(
        "doc_id", "sent_id", "sentence", F.col("_hit.label").alias("label"), count.alias("n_tokens"),
        (F.col("sent_start") + F.length(before)).alias("start_char"),
        F.rtrim(F.array_join(F.slice("pieces", pos + 1, count), "")).alias("entity_text"),
    ).withColumn("end_char", F.col("start_char") + F.length("entity_text")).select(*SPAN_COLUMNS)


def resolved_sentences(spans: DataFrame) -> DataFrame:
    """One row per sentence with its surviving spans.

    Longest span in tokens first, then the earliest start, then the label; a span that
    overlaps one already kept is dropped.  Spans are sorted by start and cut into islands
    that nothing bridges; only spans of one island are compared with each other.
    """
    span = F.struct(
        "start_char", "end_char", F.negative("n_tokens").alias("rank"), "label", "entity_text"
    )
    placed = spans.groupBy("doc_id", "sent_id").agg(
        F.first("sentence").alias("sentence"),
        F.sort_array(F.collect_set(span)).alias("placed"),
    )
    ended = placed.withColumn("_ends", F.transform("placed", lambda s: s["end_char"]))
    topped = ended.withColumn("_tops", tx.running(F.col("_ends"), F.greatest))
    # Arrays meet by zipping: one that a lambda looked into could be computed for each element.
    before = F.concat(F.array(F.lit(0)), F.slice("_tops", F.lit(1), F.size("placed") - 1))
    apart = F.zip_with("placed", before, lambda s, top: s["start_char"] >= top)
    headed = topped.withColumn("_heads", F.filter(
        F.transform(apart, lambda free, i: F.when(free, i)), lambda head: head.isNotNull()
    ))
    ends = F.concat(F.slice("_heads", F.lit(2), F.size("_heads")), F.array(F.size("placed")))
    islands = headed.withColumn("_islands", F.zip_with(
        "_heads", ends, lambda head, end: F.slice("placed", head + 1, end - head)
    ))
    kept = F.flatten(F.transform("_islands", lambda island: F.when(
        F.size(island) == 1, island
    ).otherwise(_best_apart(island))))
    return islands.select("doc_id", "sent_id", "sentence", kept.alias("kept"))


def _best_apart(island: Column) -> Column:
    """Of spans that overlap in a chain, the ones kept in order of rank, start and label."""
    ranked = F.array_sort(F.transform(island, lambda s: F.struct(
        s["rank"].alias("rank"), s["start_char"].alias("start_char"), s["label"].alias("label"),
        s["end_char"].alias("end_char"), s["entity_text"].alias("entity_text"),
    )))
    best = F.aggregate(
        ranked,
        F.slice(ranked, 1, 0),
        lambda kept, span: F.when(
            F.exists(
                kept,
                lambda other: (other["start_char"] < span["end_char"])
                & (span["start_char"] < other["end_char"]),
            ),
            kept,
        ).otherwise(F.concat(kept, F.array(span))),
    )
    return F.transform(best, lambda s: F.struct(
        s["start_char"].alias("start_char"), s["end_char"].alias("end_char"), s["rank"].alias("rank"),
        s["label"].alias("label"), s["entity_text"].alias("entity_text"),
    ))


def scope(has_trigger: Column, has_competitor: Column) -> Column:
    return (
        F.when(has_trigger & has_competitor, "AMBIGUOUS")
        .when(has_trigger, "NGO")
        .when(has_competitor, "COMPETITOR")
        .otherwise("UNSPECIFIED")
    )


def entity_table(
    documents: DataFrame,
    cfg: Config,
    lexicon: DataFrame,
    max_broadcast_bytes: int = BROADCAST_BYTES,
    bounds: Bounds | None = None,
) -> DataFrame:
    """Every resolved mention with its sentence and, for target labels, its scope."""
    resolved = resolved_sentences(candidates(documents, cfg, lexicon, max_broadcast_bytes, bounds))
    has_trigger = F.lower("sentence").rlike("|".join(cfg.scope_triggers))
    has_competitor = F.exists("kept", lambda span: span["label"].isin(*cfg.competitor_labels))
    judged = resolved.select(
        "doc_id", "kept",
        F.trim("sentence").alias("context"),
        scope(has_trigger, has_competitor).alias("_scope"),
    )
    tagged = judged.select("doc_id", "context", "_scope", F.explode_outer("kept").alias("_m"))
    label = F.col("_m.label")
    return tagged.select(
        "doc_id",
        F.col("_m.entity_text").alias("entity_text"),
        label.alias("label"),
        F.when(label.isin(*cfg.target_labels), F.col("_scope")).alias("scope_tag"),
        "context",
        F.col("_m.start_char").alias("start_char"),
        F.col("_m.end_char").alias("end_char"),
    )


def scoped_only(entities: DataFrame, cfg: Config) -> DataFrame:
    return entities.where(F.col("label").isin(*cfg.target_labels)).select(*SCOPED_COLUMNS)


def preview(documents: DataFrame, cfg: Config, lexicon: DataFrame, n: int = 2) -> DataFrame:
    """Mentions of the first n documents by id."""
    return entity_table(documents.orderBy("doc_id").limit(n), cfg, lexicon)


def label_counts(entities: DataFrame) -> DataFrame:
    return entities.groupBy("label").agg(F.count(F.lit(1)).alias("n"))


def scope_counts(entities: DataFrame) -> DataFrame:
    tagged = entities.where(F.col("scope_tag").isNotNull())
    return tagged.groupBy("scope_tag").agg(F.count(F.lit(1)).alias("n"))


def per_document(entities: DataFrame) -> DataFrame:
    return entities.groupBy("doc_id").agg(F.count(F.lit(1)).alias("entity_count"))


def without_mentions(documents: DataFrame, entities: DataFrame) -> DataFrame:
    mentioned = entities.select("doc_id").distinct()
    return documents.select("doc_id").join(mentioned, "doc_id", "left_anti")


def distinct_measures(entities: DataFrame, cfg: Config) -> DataFrame:
    measured = entities.where(F.col("label").isin(*cfg.units))
    return measured.select("label", "entity_text").distinct()
