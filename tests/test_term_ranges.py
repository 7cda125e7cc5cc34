"""A long term list in ranges: the same terms are found, and a place is searched in its own range."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from papervein.operators import relevance, term_index


def indexed(terms):
    return term_index.build(pa.array(terms, pa.string()), np.arange(len(terms)), np.ones(len(terms), np.int64))


@pytest.mark.parametrize("alphabet, seed", [("ab", 1), ("a\0", 2), ("aé中😀 ", 3), ("a", 4)])
def test_ranges_find_what_the_whole_list_finds(alphabet, seed):
    """Cuts fall between terms that begin each other, shorter and longer than eight bytes."""
    rng = random.Random(seed)

    def strings(n, most):
        return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in range(n)]

    texts = [*strings(60, 60), None, "", alphabet * 9]
    terms = sorted({t for t in strings(200, 30) + [alphabet * 7, alphabet[0], alphabet * 8] if t}, key=str.encode)
    want = {(i, term) for i, text in enumerate(texts) for term in terms if term in (text or "")}
    for _ in range(5):
        cuts = [0, *sorted(rng.randrange(len(terms) + 1) for _ in range(4)), len(terms)]
        got = set()
        for low, high in zip(cuts, cuts[1:]):
            part = terms[low:high]
            got |= {(int(r) + s, part[t]) for s, _, row, term in term_index.found(indexed(part), pa.array(texts)) for r, t in zip(row, term)}
        assert got == want


def test_a_place_outside_a_range_is_not_searched():
    """Before, a place behind all terms was searched as any other."""
    index = indexed(["m", "motor", "motor core"])
    texts = b"zzzzzzzz a motor"
    at_byte = np.ndarray(len(texts) + 1, ">u8", np.frombuffer(texts + bytes(8), np.uint8), strides=(1,)).astype(np.uint64)
    place, _ = term_index._last_not_behind(index, at_byte, len(texts))
    assert place.tolist() == [texts.index(b"motor")]


def test_parts_are_ranges_of_the_list(spark):
    listed = relevance.term_table(spark.range(2000).select(F.concat(F.lit("term "), "id").alias("term")))
    bounds = sorted(tuple(p.agg(F.min("term"), F.max("term"), F.count("*")).first()) for p in relevance._parts(listed, 20_000))
    assert sum(n for *_, n in bounds) == 2000 and len(bounds) > 2
    assert all(last < first for (_, last, _), (first, _, _) in zip(bounds, bounds[1:]))
