import random
import re
import time

import pytest

from quernstone.operators.automaton import Forms, folded, match_forms


def by_regex(forms, text):
    """The same by one alternation, longest form first."""
    pattern = re.compile(rf"(?<!\w)(?:{'|'.join(map(re.escape, sorted(forms, key=len, reverse=True)))})(?!\w)")
    return [(m.start(), m.end(), forms[m[0]]) for m in pattern.finditer(text)]


@pytest.mark.parametrize("seed", range(20))
def test_equals_an_alternation(seed):
    rng = random.Random(seed)
    bits = ["a", "b", "ab", " ", "-", "_", "é", "1", "."]
    forms = {f: (f, "K") for f in {"".join(rng.choice(bits) for _ in range(rng.randint(1, 4))).strip() for _ in range(12)} if f}
    for _ in range(40):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))
        assert Forms(forms).spans(text) == by_regex(forms, text)


def test_without_case():
    forms = Forms({"Straße": ("S", "K"), "España": ("E", "K"), "corea del sur": ("C", "K"), "s": ("x", "K")}, fold=True)
    text = "STRASSE straße Straßen ESPAÑA Corea Del Sur ß"
    assert [(text[a:z], e[0]) for a, z, e in forms.spans(text)] == [("STRASSE", "S"), ("straße", "S"), ("ESPAÑA", "E"), ("Corea Del Sur", "C")]
    assert folded("aß")[1] == [0, 1, 1, 2] and folded("AB") == ("ab", None)
    assert Forms({}).spans("a") == [] and Forms({"": ("x", "K")}).spans("a") == []


def test_cost_follows_the_text_not_the_dictionary():
    few = {f"form {k}": (str(k), "K") for k in range(100)}
    many = {f"form {k}": (str(k), "K") for k in range(1_000_000)}
    text = " ".join(f"form {k * 9973 % 1_000_000} and" for k in range(20_000))
    took = []
    for forms in (few, many):
        made = Forms(forms)
        began = time.perf_counter()
        spans = made.spans(text)
        took.append(time.perf_counter() - began)
    assert len(spans) == 20_000
    assert took[1] < 1 + 50 * took[0]


def test_match_forms(spark):
    df = spark.createDataFrame([(1, "the NASA and ESA"), (2, None), (3, "nothing"), (4, "ESA ESA")], "i int, text string")
    got = match_forms(df, {"NASA": ("nasa", "ORG"), "ESA": ("esa", "ORG")}, "i").orderBy("i", "pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, 4, 8, "nasa", "ORG"), (1, 1, 13, 16, "esa", "ORG"), (4, 0, 0, 3, "esa", "ORG"), (4, 1, 4, 7, "esa", "ORG")]
