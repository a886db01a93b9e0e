import random
import re

from fleetwane.llm import lines

SPACE = re.compile(r"[ \t-\r]+")


def split(text):
    return [w for w in SPACE.split(text or "") if w]


def brute(text):
    text = text or ""
    w = split(text)
    windows = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    twice = {x for x in set(windows) if windows.count(x) > 1} if len(windows) < 3000 else {x for x, n in __import__("collections").Counter(windows).items() if n > 1}
    covered = {i + d for i, x in enumerate(windows) if x in twice for d in range(8)}
    full = [x for x in text.split("\n") if split(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(full) - len(set(full)), len(covered)


def figures(df):
    return sorted((r.doc_id is None, r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words), r.base_failed, r.kept) for r in df.collect())


def test_base_figures_equal_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for i in range(150):
        w = rng.choice([2, 3, 50])
        texts.append("".join(rng.choice([*(f"w{k}" for k in range(w)), "né|", "#"]) + rng.choice([" ", "  ", "\n", "\t", " \x0b"]) for _ in range(rng.randint(0, 120))))
    rows = figures(lines.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    for _, i, got, failed, kept in rows:
        want = brute(texts[i])
        assert got == want, texts[i]
        assert failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (failed and kept)


OTHER = "Nothing in the second one has been said before, so both of them stay."


def test_bad_lines_go(spark):
    prose = "This is a plain sentence that goes on for a while and ends well."
    text = "\n".join([prose, "Home | About | Contact | More", "All rights reserved.", "Menu", "WOW!! BUY!! NOW!!", OTHER])
    row = lines.judge(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.clean_text == prose + "\n" + OTHER and row.kept
    bad = "\n".join([prose] + ["Home | About | Contact | More | Other | Last"] * 5)
    assert not lines.judge(spark.createDataFrame([(1, bad)], "doc_id long, text string")).first().kept


def test_odd_rows(odd_docs, no_docs):
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    rows = figures(lines.judge(odd_docs))
    assert len(rows) == odd_docs.count()
    assert all(got == brute(texts[i]) for _, i, got, _, _ in rows)
    assert lines.judge(no_docs).count() == 0
