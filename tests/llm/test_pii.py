import hashlib
import random
import re

from fleetwane.llm import pii
from fleetwane.llm.queries import QUERIES

KINDS = ("email", "ip", "card", "phone")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def written(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def check(rows, texts):
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple([k for _, k, _ in want].count(i) for i in range(4)), texts[r.doc_id]
        assert r.base_sha256 == hashlib.sha256(written(want).encode()).hexdigest()
        spans = r.spans.split(",") if r.spans else []
        assert set(written(want).split(",") if want else []) <= set(spans) and len(spans) == len(want) + r.n_added


def test_spans_equal_plain_search(spark):
    rng = random.Random(11)
    parts = ["a", "b.c", "@", "@x", ".", "-", " ", "1", "12", "255", "256", "+", "+1", "(", ")", "4111 1111 1111 1111", "4111111111111111", "é", "😀",
             "192.168.0.1", "x_y%z", "\n", "0", "00", "+1 (262) 555-7240", "name@mail.example.com"]
    texts = {i: "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))) for i in range(1500)}
    rows = pii.find(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    check(rows, texts)


def test_query_equals_plain_search(spark, tables):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{tables}/documents.parquet").collect()}
    check(QUERIES["op2_pii"](spark, tables).collect(), texts)


def test_long_runs_take_linear_time(spark):
    texts = {1: "a" * 300_000, 2: "1" * 300_000, 3: "1.1." * 50_000, 4: "a@b" + ".c" * 100_000, 5: "+1" + "(" * 100_000, 6: "a@" * 50_000, 7: "1 " * 100_000}
    rows = pii.find(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    assert len(rows) == 7
    assert {r.doc_id: (r.n_email, r.n_ip) for r in rows} == {1: (0, 0), 2: (0, 0), 3: (0, 25_000), 4: (1, 0), 5: (0, 0), 6: (0, 0), 7: (0, 0)}


def test_odd_rows(odd_docs, no_docs):
    rows = pii.find(odd_docs).collect()
    assert len(rows) == odd_docs.count() and all(r.spans == "" for r in rows)
    assert pii.find(no_docs).count() == 0


def test_trees_add_what_looks_like_personal_data(spark):
    rng = random.Random(1)
    texts = []
    for i in range(400):
        number = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        texts += [f"word word {number} word", f"mail{i}@host.example.com is here", f"call it {rng.randint(1, 99999)} times or 12.5 percent"]
    texts.append("write to someone.else (at) host.example.com today")
    rows = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    check(rows, dict(enumerate(texts)))


def test_trees_add_other_formats(spark):
    rng = random.Random(2)
    texts = []
    for i in range(400):
        number = f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
        texts += [f"word word {number} word", f"mail{i}@host.example.com is here", f"call it {rng.randint(1, 99999)} times or 12.5 percent"]
    planted = {len(texts): "write to someone.else (at) host.example.com today", len(texts) + 1: "word word (262) 555-7240 word", len(texts) + 2: "x" * 80 + "(at)host.example.com is here"}
    texts += planted.values()
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    check(rows.values(), dict(enumerate(texts)))
    assert [rows[i].spans for i in planted] == ["email:9:43", "phone:10:24", "email:0:100"]


def test_other_formats_are_added_and_prose_is_not(spark):
    rng = random.Random(7)
    syllables = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]

    def word():
        return "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))

    def words(n):
        return " ".join(word() for _ in range(n))

    def card():
        body = "4" + "".join(rng.choice("0123456789") for _ in range(14))
        return next(body + c for c in "0123456789" if luhn(body + c))

    def phone():
        return f"({rng.randint(200, 999)}) {rng.randint(200, 999)}-{rng.randint(1000, 9999)}"

    texts = []
    for i in range(300):
        texts.append(f"{words(6)} {word()}.{word()}{i}@{word()}.{rng.choice(['com', 'org', 'net'])} {words(6)}")
        texts.append(f"{words(6)} +1 {phone()} {words(6)} {card()} {words(6)} 10.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(1, 255)} {words(6)}")
    first = len(texts)
    prose = [f"{words(4)} {word()}. At {word()}. {word().title()} {words(3)} {word()} at {word()}.{word().title()} {words(4)}" for _ in range(200)]
    formats = {
        "email": lambda: f"{word()}{rng.choice(['', '.' + word(), '7'])}{rng.choice([' (at) ', '(at)', ' [at] ', ' at '])}{word()}{rng.choice(['.', ' dot ', '[dot]'])}{rng.choice(['com', 'org'])}",
        "phone": lambda: phone().replace("(", "").replace(") ", "-"),
        "card": lambda: ".".join(re.findall("....", card())),
    }
    planted = [(kind, make()) for kind, make in formats.items() for _ in range(200)]
    lines = [f"{words(5)} {hit} {words(5)}" for _, hit in planted]
    everything = texts + prose + lines
    rows = {r.doc_id: r for r in pii.find(spark.createDataFrame(list(enumerate(everything)), "doc_id long, text string")).collect()}
    check(rows.values(), dict(enumerate(everything)))
    assert sum(rows[first + i].n_added for i in range(len(prose))) == 0
    right, added = dict.fromkeys(formats, 0), dict.fromkeys(formats, 0)
    for i, (kind, hit) in enumerate(planted):
        row = rows[first + len(prose) + i]
        start = lines[i].index(hit)
        right[kind] += f"{kind}:{start}:{start + len(hit)}" in row.spans.split(",")
        added[kind] += row.n_added
    assert all(right[k] >= 160 and right[k] >= 0.95 * added[k] for k in formats), (right, added)
