"""Contextual PII against a plain-Python version of its rounds, and candidates of any shape."""

import math
import random
import re
from collections import defaultdict

import pytest

from foehn.llm import pii, store

DIGITS = re.compile(r"(?<!\w)[+(]{0,2}[0-9](?:[\x20().-]{0,2}[0-9])*+(?!\w)")

INNER = re.compile(r"[A-Za-z0-9\x80-\U0010ffff]")
AROUND = re.compile(r"^[^A-Za-z0-9\x80-\U0010ffff]+|[^A-Za-z0-9\x80-\U0010ffff]+$")


def plain(texts):
    """(text, start, end) of the sure instances, word by word."""
    docs = []
    for text in texts:
        words = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
        base = sorted(x for own in pii.base_spans(text) for x in own)
        at = lambda p, words=words: max(i for i, (a, _) in enumerate(words) if a <= p)
        runs = [(m.start(), m.end(), at(m.start()), at(m.end() - 1)) for m in DIGITS.finditer(text)]
        docs.append((text, words, base, [r for r in runs if r[3] > r[2] and not INNER.search(text[words[r[2]][0] : r[0]] + text[r[1] : words[r[3]][1]])]))
    fold = lambda s: "".join(c.lower() if c.isascii() else c for c in s)

    def patterns(text, words, i, e):
        w = [fold(text[a:b]) for a, b in words]
        out = [(0, w[i - 1])] if i > 0 else []
        out += [(1, w[i - 2], w[i - 1])] if i > 1 else []
        out += [(2, w[e + 1])] if e + 1 < len(w) else []
        return out + ([(3, w[e + 1], w[e + 2])] if e + 2 < len(w) else [])

    n_pattern, n_form = defaultdict(int), defaultdict(int)
    for text, words, _, _ in docs:
        w = [fold(text[a:b]) for a, b in words]
        f = [AROUND.sub("", x) for x in w]
        for j in range(len(w)):
            n_form[f[j],] += 1
            if j + 1 < len(w):
                n_form[f[j], f[j + 1]] += 1
                n_pattern[0, w[j]] += 1
                if j:
                    n_pattern[1, w[j - 1], w[j]] += 1
            if j:
                n_pattern[2, w[j]] += 1
                if j + 1 < len(w):
                    n_pattern[3, w[j], w[j + 1]] += 1

    instances = []  # every word or run with its patterns
    edges = defaultdict(lambda: defaultdict(int))
    for d, (text, words, base, runs) in enumerate(docs):
        for a, b in base:
            i = max(k for k, (x, _) in enumerate(words) if x <= a)
            e = max(k for k, (x, _) in enumerate(words) if x <= b - 1)
            for p in patterns(text, words, i, e):
                edges[p][fold(text[a:b])] += 1
        covered = {k for _, _, i, e in runs for k in range(i, e + 1)}
        spans = [(a, b, i, e) for a, b, i, e in runs]
        for k, (a, b) in enumerate(words):
            inner = AROUND.sub("", text[a:b])
            if k not in covered and inner:
                start = a + text[a:b].index(inner)
                spans.append((start, start + len(inner), k, k))
        for a, b, i, e in spans:
            w = [AROUND.sub("", fold(text[x:y])) for x, y in words]
            form = (w[i],) if i == e else (w[i], w[i + 1])
            free = not any(x < b and y > a for x, y in base)
            instances.append((d, a, b, fold(text[a:b]), form, patterns(text, words, i, e), free))
    known, sure = set().union(*(set(x) for x in edges.values())) if edges else set(), {}
    while True:
        scores = {p: min(1, sum(x.values()) / n_pattern[p]) for p, x in edges.items() if len(x) >= pii.SUPPORT}
        fresh = {p: s for p, s in scores.items() if s >= pii.SURE and p not in sure}
        sure |= fresh
        if not fresh:
            break
        own, forms, hits = defaultdict(set), defaultdict(set), defaultdict(lambda: defaultdict(int))
        for _, _, _, s, form, ps, free in instances:
            for p in ps:
                if free and p in sure:
                    own[s].add(p)
                    forms[s].add(form)
                    hits[s][p[0]] += 1
        score = {s: (1 - math.prod(1 - min(sure[p], 0.999) for p in ps)) * min(1, max(hits[s].values()) / sum(n_form[f] for f in forms[s])) for s, ps in own.items()}
        new = {s for s, x in score.items() if x >= pii.SURE} - known
        if not new:
            break
        known |= new
        for _, _, _, s, _, ps, _ in instances:
            if s in new:
                for p in ps:
                    edges[p][s] += 1
    return {(texts[d], a, b) for d, a, b, s, _, ps, free in instances if free and s in known and any(p in sure for p in ps)}


def found(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = set()
    for r in pii.find_personal_data(spark, df).collect():
        out |= {(texts[r.doc_id], int(x.split(":")[1]), int(x.split(":")[2])) for x in r.spans.split(",") if x.startswith("id:")}
    return out


SHAPES = ["(555) 123 4567", "4111 1111 1111 1112", "jdoe_smith", "u9", "é12345678", "x" * 40 + "7" * 40]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = "alpha beta gamma delta the of and to in is at".split()
    line = lambda n: [rng.choice(words) for _ in range(n)]
    out = []
    for i in range(40):
        out.append(" ".join([*line(8), "reach", "me:", f"user{i}@ex{i}.example", "today", "please", *line(8)]))
    for s in SHAPES:
        out += [" ".join([*line(8), "reach", "me:", s + ",", "today", *line(9)]) for _ in range(2)]
        out.append(" ".join([*line(5), "badge", "no.", s, *line(5)]))  # the second round's pattern
    out.append(" ".join([*line(8), "badge", "no.", "qq-unseen", *line(9)]))
    out.append(" ".join([*line(8), "reach", "me:", "the", *line(9)]))  # a word of the language
    return [*out, *out[40:42], "", "(1 2"]


def test_candidates_of_any_shape_are_found_and_words_stay(spark, texts):
    got = found(spark, texts)
    strings = {t[a:b] for t, a, b in got}
    assert strings == {*SHAPES, "qq-unseen"}
    assert got == plain(texts)


def test_random_graphs_equal_the_plain_version(spark):
    rng = random.Random(11)
    words = ["a", "b", "c,", "é", "to", "id:"]
    for _ in range(3):
        texts = []
        for _ in range(60):
            w = [rng.choice([*words, f"u{rng.randrange(9)}@x.yz", f"k{rng.randrange(9)}", f"{rng.randrange(99)} {rng.randrange(99)}"]) if rng.random() < 0.8 else "mail " + rng.choice([f"v{rng.randrange(30)}@x.yz", f"q{rng.randrange(6)}"]) for _ in range(rng.randrange(14))]
            texts.append(rng.choice([" ", "\n", "\t"]).join(w))
        assert found(spark, texts) == plain(texts)


def test_hidden_text_of_contexts(spark, texts):
    df = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    hidden = {r.doc_id: r for r in pii.redact(spark, df).collect()}
    assert len(hidden) == len(texts) and all(len(r.text) == r.n_chars for r in hidden.values())
    assert "reach me: <ID>, today" in hidden[40].text and "(555)" not in hidden[42].text


def test_hidden_text_takes_one_worker_a_task(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    plan = pii.redact(spark, df)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan


def test_a_task_gives_its_memory_back(monkeypatch):
    done = []
    monkeypatch.setattr(store, "release", lambda: done.append("released"))
    assert list(store.releasing(lambda batches: (done.append(b) or b for b in batches))(iter([1, 2]))) == [1, 2]
    assert done == [1, 2, "released"]
