import hashlib
import math
import random
import re

import pytest

from tidemark.llm import pii
from tidemark.llm.pii import KINDS, base_spans, personal_data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    odd = [int(d) for d in digits[::-1][::2]]
    even = [sum(divmod(2 * int(d), 10)) for d in digits[::-1][1::2]]
    return (sum(odd) + sum(even)) % 10 == 0


def brute(text):
    digits = lambda m: re.sub(r"[^0-9]", "", m[0])
    spans = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    spans += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    spans += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    spans += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(spans)


TEXTS = [
    "", "a@b", "a@b.c", "a@b@c.de", "x.y+z%q@d-e.f.g.", "é.a@b.c", "a@b.c@d.e", "@b.c a@.c", "1.2.3.4", "1.2.3.4.5.6.7.8", "256.1.1.1 1.1.1.300",
    "001.02.3.0255 0000000255.1.1.1", "4539 1488 0343 6467", "4539-1488-0343-6467x", "+1 (017) 555-7713.", "+1((((((", "+12 345 678 901 234 567 8",
    "４５.1.1.1", "+٣ 1234567890", "1.1.1.1@h.io", "12345678901234 79927398713 49927398716", "+49.30.1234567-8 a-b@c--d.e-f",
]


@pytest.mark.parametrize("text", TEXTS)
def test_base_spans_of_edge_texts(text):
    assert base_spans(text) == brute(text)


def test_base_spans_of_random_texts():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choices("a@.1234567890+-() \né", k=rng.randrange(60)))
        assert base_spans(text) == brute(text), text


def test_long_runs_of_zeros():
    assert base_spans("0" * 5000 + ".1.1.1 " + "0" * 9000 + "9.0.0.256") == [(0, 1, 5006)]


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" + "(" * 300_000, "a@" * 150_000):
        base_spans(text)


def told(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_query_holds_the_base_of_whole_texts(spark):
    from tests.llm.conftest import FOLDER
    from tidemark.llm.queries import QUERIES

    docs = {d.doc_id: d.text for d in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    got = QUERIES["op3_bootstrapped_pii"](spark, FOLDER).collect()
    assert sorted(r.doc_id for r in got) == sorted(docs)
    for r in got:
        spans = brute(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(told(spans).encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(k == i for _, k, _ in spans) for i in range(4))
        assert set(told(spans).split(",")) <= set(r.spans.split(","))


def test_contexts_of_seeds_find_unseen_identifiers(documents):
    rng = random.Random(1)
    noise = lambda: " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "epsilon"], k=6))
    rows = [(i, f"{noise()} contact email: user{i}@mail{i}.example.com {noise()}") for i in range(60)]
    rows += [(100 + i, f"{noise()} contact email: user{i}(at)host{1000 + i} {noise()}") for i in range(5)]
    rows += [(200 + i, f"{noise()} ref{5000 + i} {noise()}") for i in range(40)]
    # Found in a trusted context once, then known anywhere.
    rows += [(300, f"{noise()} again user3(at)host1003 here")]
    got = {r.doc_id: r for r in personal_data(documents(rows)).collect()}
    text = dict(rows)
    for i in [*range(100, 105), 300]:
        start = text[i].index("user")
        assert got[i].spans == f"email:{start}:{text[i].index(' ', start)}"
        assert got[i].n_email == 0
    assert all(got[200 + i].spans == "" for i in range(40))
    assert all(got[i].n_email == 1 for i in range(60))


def test_edge_rows(documents):
    rows = [(1, None), (2, ""), (3, "x@y.z"), (3, "x@y.z"), (None, "x@y.z"), (4, "q " * 100_000 + "1.2.3.4")]
    df = documents(rows)
    df = df.withColumn("uid", df.text).withColumn("spans", df.doc_id).withColumn("kind", df.doc_id)
    got = sorted((str(r.doc_id), r.spans) for r in personal_data(df).collect())
    assert got == sorted([("1", ""), ("2", ""), ("3", "email:0:5"), ("3", "email:0:5"), ("None", "email:0:5"), ("4", "ip:200000:200007")])
    assert personal_data(documents([])).count() == 0


def test_grouped_and_spelled_identifiers_are_found_by_their_contexts(documents):
    rng = random.Random(2)
    noise = lambda: " ".join(rng.choices(["alpha", "beta", "gamma", "delta", "epsilon"], k=6))
    rows = [(i, f"{noise()} call me at +49 (0) {170 + i} 55{i:05d} {noise()}") for i in range(60)]
    rows += [(100 + i, f"{noise()} mail to user{i}@mail{i}.example.com {noise()}") for i in range(60)]
    planted = {200 + i: f"({500 + i}) {100 + i}-{4000 + i}" for i in range(10)} | {300 + i: f"{500 + i} {100 + i} {4000 + i}" for i in range(10)}
    rows += [(i, f"{noise()} call me at {found} {noise()}") for i, found in planted.items()]
    spelled = {400 + i: f"name{i} (at) host{i} dot com".replace(" dot ", " [dot] ") for i in range(10)}
    rows += [(i, f"{noise()} mail to {found} {noise()}") for i, found in spelled.items()]
    rows += [(500 + i, f"{noise()} numbers {i} 100 2000 {noise()}") for i in range(40)]
    got = {r.doc_id: r for r in personal_data(documents(rows)).collect()}
    text = dict(rows)
    for kind, cases in (("phone", planted), ("email", spelled)):
        caught = 0
        for i, found in cases.items():
            start = text[i].index(found)
            caught += got[i].spans == f"{kind}:{start}:{start + len(found)}"
        assert caught >= 0.9 * len(cases)
    assert all(got[500 + i].spans == "" for i in range(40))


def brute_beliefs(links):
    """The rounds on a small graph, by hand: patterns by Wilson's bound, instances by noisy or."""
    pairs = {}
    for pattern, instance, kind in links:
        pairs[pattern, instance] = max(kind, pairs.get((pattern, instance), -1))
    held = {}
    for (_, instance), kind in pairs.items():
        if kind >= 0:
            held.setdefault(instance, []).append((kind, 1.0))
    seeds = set(held)
    while True:
        masses = {}
        for pattern, instance in pairs:
            known = sorted(set(held.get(instance, [])), key=lambda k: (-k[1], k[0]))
            of, belief = known[0] if known else (None, pii.UNKNOWN)
            masses.setdefault(pattern, {}).setdefault(of, []).append(belief)
        trusted = {}
        for pattern, by in masses.items():
            total = sum(map(sum, by.values()))
            kinds = sorted(((-sum(v), k) for k, v in by.items() if k is not None))
            if kinds:
                p, z = -kinds[0][0] / total, 1.645
                low = (p + z * z / (2 * total) - z * (p * (1 - p) / total + z * z / (4 * total * total)) ** 0.5) / (1 + z * z / total)
                if low >= pii.TRUST:
                    trusted[pattern] = (kinds[0][1], low)
        votes = {}
        for pattern, instance in pairs:
            if pattern in trusted and instance not in held:
                kind, trust = trusted[pattern]
                votes.setdefault(instance, {}).setdefault(kind, []).append(1 - min(trust, 0.999))
        new = {}
        for instance, by in votes.items():
            kind, miss = min(((k, math.prod(v)) for k, v in by.items()), key=lambda x: (x[1], x[0]))
            if 1 - miss >= pii.BELIEF:
                new[instance] = [(kind, 1 - miss)]
        if not new:
            return {i: k[0][0] for i, k in held.items() if i not in seeds}
        held |= new


def test_beliefs_equal_brute_force(spark):
    rng = random.Random(9)
    links = []
    for chain in range(5):  # each pattern is learnt from what the one before it made believed
        for step in range(6):
            links += [(f"p{chain}.{step}", f"x{chain}.{step}.{i}", chain % 4 if step == 0 else -1) for i in range(30)]
            links += [(f"p{chain}.{step}", f"x{chain}.{step + 1}.{i}", -1) for i in range(30 if step < 5 else 3) if rng.random() < 0.9]
    links += [(f"r{rng.randrange(8)}", f"y{rng.randrange(60)}", rng.choice([-1, -1, 0, 1])) for _ in range(300)]
    got = pii.believed_instances(spark.createDataFrame(links, "pattern string, instance string, kind int"))
    assert {r.instance: r.kind for r in got.collect()} == brute_beliefs(links)


def test_instances_and_contexts_are_told_apart_whole():
    long = "9" * 300
    one, two = (pii.seen_instances(f"{'w' * 500}{x} id {long}{x}", []) for x in "12")
    assert one[0][3] != two[0][3]
    words = [pii.seen_instances(f"{'w' * 500}{x} 1234567", [])[0][4] for x in "ab"]
    assert words[0] != words[1]
    for text in ("5 " * 100_000, "(at) " * 60_000, "a" * 300_000 + " (at) b", "1-" * 150_000, "x (dot) " * 40_000):
        pii.seen_instances(text, base_spans(text))
