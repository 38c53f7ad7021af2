import re

import pytest

from lakestrata.llm import secrets

from .conftest import frame

ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
RULES = [(ASSIGN, 2, 12), (re.compile(r"AKIA[A-Z0-9]+"), 0, 18), (re.compile(r"[0-9a-f]+"), 0, 16)]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, (p, g, n) in enumerate(RULES)
                  for m in p.finditer(text or "") if len(m[g]) >= n)


def test_trigram_queries_of_the_rules():
    assign, access, hexes = (secrets.trigram_query(r.pattern) for r in secrets.RULES)
    assert len(assign) == 1 and ["oke", "ken", "tok"] not in assign[0]
    assert sorted(map(tuple, assign[0]))[0] == ("api", "i_k", "key", "pi_") or len(assign[0]) == 6
    assert access == [[["aki", "kia"]]] and hexes == []
    assert secrets.trigram_query("ab") == [] and secrets.trigram_query("a*bcd") == [[["bcd"]]]
    assert secrets.trigram_query("(?:x|abc)") == []


@pytest.mark.parametrize("literal", ["password", "passwd", "secret", "token", "apikey", "api_key"])
def test_each_literal_meets_its_query(literal):
    clause = secrets.trigram_query(secrets.RULES[0].pattern)[0]
    assert any(all(t in literal for t in conj) for conj in clause)


def test_spans_equal_those_of_a_plain_scan(spark, odd):
    key, hexa = "AKIA" + "Z9" * 8, "0123456789abcdef"
    texts = odd + [
        (1, f'é漢😀 password = "{hexa}{hexa}" and TOKEN:abcdefghijkl'), (2, f"x{key}y {key[:17]} AKIA{key}"),
        (3, "password=secret:longvalue1234567 secret=token=abcdefghijklm"), (4, f"{hexa}g{hexa[:15]} {hexa}{hexa}"),
        (5, "api-key: abcdefghijklmn apikey:abcdefghijklmn ApI_KeY ='abcdefghijklmn'"),
        (6, "paſſword=abcdefghijklmn toKen=abcdefghijklmn"), (6, "token=abcdefghijkl"),
        (7, f"secret='{key}' " * 300), (8, f"token={hexa}\n" + "a" * 70000)]
    got = secrets.scan(frame(spark, texts)).select("doc_id", "text", "__found", "node").collect()
    assert len(got) == len(texts) and {r.node for r in got} == {"node"}
    for r in got:
        assert [tuple(s) for s in r["__found"]] == brute(r.text), r.text and r.text[:80]


def test_an_empty_table(spark):
    assert secrets.scan(frame(spark, [])).count() == 0


def test_the_main_path_runs_no_python(spark):
    plan = secrets.scan(frame(spark, [(1, "x")]))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
