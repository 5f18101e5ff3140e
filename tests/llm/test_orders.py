"""Kneser-Ney models of any order against their formulas."""

import collections
import math
import re

import pytest
from foehn.llm import kneser_ney, kneser_ney_orders, toxicity

SF = "/root/testdata/sf0.001"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + [None]


def plain_scores(learned, texts, order):
    """Scores by the recursion, one token at a time."""
    top = [collections.Counter() for _ in range(order + 1)]
    for t in learned:
        w = ["<s>", *split(t)]
        for i in range(1, len(w)):
            for k in range(1, order + 1):
                if i - k + 1 >= 0:
                    top[k][tuple(w[i - k + 1 : i + 1])] += 1
    counts = [None] * (order + 1)
    counts[order] = top[order]
    for k in range(order - 1, 0, -1):
        counts[k] = collections.Counter({g: c for g, c in top[k].items() if g[0] == "<s>"})
        for g in top[k + 1]:
            counts[k][g[1:]] += 1
    d = [None, *(kneser_ney.discounts(*([sum(x == j for x in counts[k].values()) for j in (1, 2, 3, 4)])) for k in range(1, order + 1))]
    stats = [None, *(collections.defaultdict(lambda: [0, 0, 0, 0]) for _ in range(order))]
    for k in range(1, order + 1):
        for g, c in counts[k].items():
            stats[k][g[:-1]][0] += c
            stats[k][g[:-1]][min(c, 3)] += 1
    v = len({g[-1] for g in top[1]})

    def p(gram):
        k = len(gram)
        low = p(gram[1:]) if k > 1 else 1 / (v + 1)
        s = stats[k].get(gram[:-1])
        if s is None:
            return low
        c = counts[k].get(gram, 0)
        return max(c - d[k][min(c, 3)], 0) / s[0] + sum(x * y for x, y in zip(s[1:], d[k][1:], strict=True)) / s[0] * low

    out = []
    for t in texts:
        w = ["<s>", *split(t)]
        out.append(sum(math.log10(p(tuple(w[max(0, i - order + 1) : i + 1]))) for i in range(1, len(w))))
    vocabulary = [g[-1] for g in top[1]]
    return out, lambda context: sum(p((*context, w)) for w in vocabulary) + p((*context, "never seen"))


@pytest.mark.parametrize("order", [2, 3, 4])
def test_scores_equal_the_formula(spark, order, monkeypatch):
    if order == 3:  # many shards, frequent words and pairs spread
        monkeypatch.setattr(kneser_ney, "SHARD_TOKENS", 2_000)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    learned = docs.where(~toxicity.held_out("doc_id", 5))
    model = kneser_ney_orders.train(spark, learned, order=order)
    if order == 3:
        assert model.shards > 8 and len(model.hot[1]) > 1 and len(model.hot[2]) > 0
    rows = docs.select("doc_id", "text").collect()
    want, total = plain_scores([r.text for r in learned.select("text").collect()], [r.text for r in rows], order)
    found = {r.doc_id: r.score for r in kneser_ney_orders.score(docs, model).collect()}
    assert [found[r.doc_id] for r in rows] == pytest.approx(want)
    first = next(w for w in map(lambda r: split(r.text), rows) if len(w) > 4)
    assert total(tuple(first[: order - 1])) == pytest.approx(1) and total(("<s>",)) == pytest.approx(1)


def test_higher_orders_hold_out_better(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = toxicity.held_out("doc_id", 5)
    two, three = (kneser_ney_orders.score(docs.where(held), kneser_ney_orders.train(spark, docs.where(~held), order=n)).agg({"score": "sum"}).first()[0] for n in (2, 3))
    assert three > two


def test_order_two_is_the_bigram_model_and_odd_rows(spark):
    rows = [(1, "a b a"), (2, None), (2, None), (None, ""), (3, "x" * 100_000), (4, "w " * 3000), (5, "É a b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as shard", "3 as _text")
    columns = lambda df: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9), round(r.score, 9)) for r in df.collect())
    assert columns(kneser_ney_orders.score(docs, kneser_ney_orders.train(spark, docs, order=2))) == columns(kneser_ney.score(docs, kneser_ney.train(spark, docs)))
    none = kneser_ney_orders.train(spark, docs.limit(0))
    assert {r.n_known for r in kneser_ney_orders.score(docs, none).collect()} == {0}
    assert kneser_ney_orders.score(docs.limit(0), none).count() == 0
    with pytest.raises(ValueError, match="order"):
        kneser_ney_orders.train(spark, docs, order=1)
