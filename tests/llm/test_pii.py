import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from almacen.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    s = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (2 if k % 2 else 1)
        s += v - 9 if v > 9 else v
    return s % 10 == 0


def brute(text):
    t = text or ""
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(t) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(digits(m)) <= 15]
    return sorted(out)


def row(i, t):
    spans = brute(t)
    text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in spans)
    return (i, *(sum(k == n for _, k, _ in spans) for n in range(4)), hashlib.sha256(text.encode()).hexdigest())


def wild(rnd):
    parts = ["a@b.c", "x.y+z@mail1.example.com", "a@b", "@", ".", "10.0.0.1", "256.1.1.1", "1.2.3.4.5.6.7.8", "001.02.3.255",
             "4111 1111 1111 1111", "4111-1111-1111-1111", "41111111111111111111", "+1 (415) 555-0101", "+44 20 7946 0958", "+12", "é🙂",
             " ", "\n", "_", "-", "9", "foo", "1  2", "+1.2.3.4.5.6.7.8.9.0"]
    return "".join(rnd.choice(parts) for _ in range(rnd.randrange(14)))


def test_equals_brute_force(make_docs):
    rnd = random.Random(4)
    rows = [*enumerate(wild(rnd) for _ in range(1500)), (None, "a@b.c"), (7, "dup a@b.cd"), (7, "dup a@b.cd"), (8, None), (9, "")]
    rows += [(-1, "x" * 50_000 + " " + "7" * 20_000 + "@a.b " + "1.2." * 5_000), (-2, "4 " * 9_000 + "a.b" * 5_000 + "@x.y" * 2_000)]
    got = pii.digest(pii.detect(make_docs(rows, extra=True))).collect()
    key = lambda r: (r[0] is not None, *(x or 0 for x in r[:5]), r[5])
    assert sorted((tuple(r)[:6] for r in got), key=key) == sorted((row(i, t) for i, t in rows), key=key)
    for r in got:
        base = [(a, k, b) for k, name in enumerate(pii.KINDS) for kind, a, b in (s.split(":") for s in r["spans"].split(",") if s) if kind == name]
        assert sum(k < 4 for _, k, _ in base) == sum(r[f"n_{x}"] for x in pii.KINDS[:4])


def test_disclosing_terms(make_docs):
    filler = ["".join(x) for x in itertools.product("bdfg", "aeiou", "lmnr", "aeo")]
    rnd = random.Random(1)
    some = lambda n: " ".join(rnd.choice(filler) for _ in range(n))
    rows = [f"{some(6)} Krzysztof, kz@corp.example.com {some(6)}" for _ in range(6)]
    rows += [f"{some(5)} m{k}@corp.example.com {some(9)} 10.0.0.{k}" for k in range(40)]
    rows += ["copied Unusual words near zz@corp.example.com here"] * 50  # copies are one context
    rows += [f"{some(4)} edited Passage {some(1)} qq@corp.example.com Unique ending" for _ in range(9)]  # as are edited copies
    rows += [f"later KRZYSZTOF came, Krzysztofs not {some(3)}", some(20)]
    got = {r["doc_id"]: r for r in pii.sanitise(pii.detect(make_docs(rows))).collect()}
    assert all(any(s["kind"] == "term" and s["value"].lower() == "krzysztof" for s in got[i]["spans"]) for i in range(6))
    last = got[len(rows) - 2]
    assert [(s["kind"], s["start"], s["end"]) for s in last["spans"]] == [("term", 6, 15)]
    assert last["clean"].startswith("later <term> came, Krzysztofs not")
    assert all(s["kind"] != "term" for i in range(6, len(rows) - 2) for s in got[i]["spans"])
    assert got[0]["clean"].count("<email>") == 1 and "@" not in got[0]["clean"]
    assert got[len(rows) - 1]["clean"] == rows[-1]


def test_a_name_of_two_words_and_a_signature(make_docs):
    filler = ["".join(x) for x in itertools.product("bdfg", "aeiou", "lmnr", "aeo")]
    rnd = random.Random(2)
    some = lambda n: " ".join(rnd.choice(filler) for _ in range(n))
    rows = [f"{some(8)} Ana Lopez, ana@corp.example.com {some(8)}" for _ in range(12)]
    rows += [f"{some(30)} Yours Zbigniew, zb@corp.example.com {some(3)}. {some(12)}" for _ in range(6)]
    rows += [f"{some(8)} m{k}@corp.example.com {some(9)} 10.0.0.{k}" for k in range(40)]
    got = [r["spans"] for r in pii.detect(make_docs(rows)).collect()]
    assert {s["value"].lower() for spans in got for s in spans if s["kind"] == "term"} >= {"ana", "lopez", "yours", "zbigniew"}


def test_surroundings_of_values(spark):
    """The words beside a place are those of the whole text before and behind it, near or far."""
    rnd = random.Random(3)
    rows = []
    for k in range(60):
        long = k % 3  # short words, words of about 60 and of up to 900 code points
        parts = [rnd.choice("aé🙂.(") * rnd.randrange(1, (6, 60, 900)[long]) + rnd.choice([" ", "\n", "  "]) for _ in range(rnd.randrange(90))]
        text = "".join(parts)
        rows += [(text, at, min(len(text), at + 3)) for at in (0, len(text), *(rnd.randrange(len(text) + 1) for _ in range(5)))]
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t)
    got = spark.createDataFrame(rows, "text string, a int, b int").select("text", "a", "b", pii.before(F.col("a")), pii.behind(F.col("b"))).collect()
    assert len(got) == len(rows)
    for text, a, b, left, right in got:
        assert (left, right) == (split(text[:a])[::-1][: pii.WIDE], split(text[b:])[: pii.WIDE])


def test_empty_and_native(make_docs):
    found = pii.detect(make_docs([]))
    assert found.count() == 0
    plan = pii.digest(pii.detect(make_docs(["a@b.c"])))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
