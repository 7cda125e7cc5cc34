"""The one regex that sentences are searched with before they are cut into tokens."""

import random
import re

import pytest

from papervein.config import Config
from papervein.operators import extraction

BUILT_IN = sorted({p.tests[0].regex.removeprefix("^").removesuffix("$") for p in Config().patterns})


@pytest.mark.parametrize("cores", [BUILT_IN, ["a|b", "c"], ["[a-c-]x", "q"], ["x?y"], ["x{0,2}y"], ["(a|b)c", r"\d"], ["[0-2a-c]+z", "Q(u|v)"]])
def test_finds_what_the_alternatives_find(cores):
    rng = random.Random(len(cores))
    one, plain = extraction._any_of(cores), "|".join(f"(?:{core})" for core in cores)
    for _ in range(3000):
        text = "".join(rng.choice("abcqxyzQuvBMNOW0123489./k -") for _ in range(rng.randrange(12)))
        assert bool(re.search(one, text)) == bool(re.search(plain, text)), text


def test_the_built_in_patterns_look_at_each_character_once():
    assert extraction._any_of(BUILT_IN).startswith("(?=[")
    assert not extraction._any_of(["a|b"]).startswith("(?=[")
