"""Operators against brute force on generated data."""

import collections
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foehn.llm import bitsliced, ego_join, kneser_ney, ngram_join, packing, paragraphs, pii, toxicity
from foehn.llm.textvec import ALNUM, SPACE, slices

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text or "" for r in documents.collect()}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="abAB .\té\n_1-", max_size=40)), max_size=12))
def test_words_and_shingles(strings):
    import pyarrow as pa

    for kind, pattern in ((SPACE, r"[^\x20\x09-\x0D]+"), (ALNUM, r"[a-zA-Z0-9_\u0080-\U0010ffff]+")):
        hashes, ids = {}, {}
        for row, _, part in slices(pa.array(strings, pa.string()), max_bytes=30):
            words = part.words(kind)
            grams, first = words.shingles(3)
            for i in range(len(part)):
                want = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(pattern, strings[row + i] or "")]
                own = words.hashes[words.first[i] : words.first[i + 1]].tolist()
                assert len(own) == len(want)
                for word, h in zip(want, own, strict=True):
                    assert hashes.setdefault(word, h) == h and ids.setdefault(h, word) == word
                assert first[i + 1] - first[i] == (0 if not want else max(1, len(want) - 2))


def test_kneser_ney_equals_its_formula(spark, documents, texts):
    learned = documents.where(~toxicity.held_out("doc_id", 5))
    model = kneser_ney.train(spark, learned)
    found = {r["doc_id"]: r for r in kneser_ney.score(documents, model).collect()}
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) + [None]
    single, pairs = collections.Counter(), collections.Counter()
    for i, t in texts.items():
        if zlib.crc32(str(i).encode()) % 5 != 1:
            single.update(split(t))
            pairs.update(zip(["<s>", *split(t)], split(t), strict=False))
    n, v = sum(single.values()), len(single)
    after, context = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0, 0])
    for (a, b), c in pairs.items():
        after[b] += 1
        context[a][0] += c
        context[a][min(c, 3)] += 1
    counts = lambda c: [sum(x == k for x in c.values()) for k in (1, 2, 3, 4)]
    d2, d1 = kneser_ney.discounts(*counts(pairs)), kneser_ney.discounts(*counts(after))
    rest = sum(d1[min(x, 3)] for x in after.values()) / len(pairs)
    lower = lambda w: max(after[w] - d1[min(after[w], 3)], 0) / len(pairs) + rest / (v + 1)
    assert sum(map(lower, single)) + rest / (v + 1) == pytest.approx(1)
    for i, t in texts.items():
        score = base = 0.0
        for a, b in zip(["<s>", *split(t)], split(t), strict=False):
            c, own = pairs[a, b], context.get(a)
            p = lower(b) if own is None else max(c - d2[min(c, 3)], 0) / own[0] + sum(x * y for x, y in zip(own[1:], d2[1:], strict=True)) / own[0] * lower(b)
            score, base = score + math.log10(p), base + math.log10((single[b] + 0.5) / (n + 0.5 * (v + 1)))
        r = found[i]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(split(t)), sum(w in single for w in split(t)), n)
        assert r.score == pytest.approx(score) and r.base_score == pytest.approx(base)


def test_held_out_text_is_likelier_than_by_unigrams(spark, documents):
    model = kneser_ney.train(spark, documents.where(~toxicity.held_out("doc_id", 5)))
    r = kneser_ney.score(documents.where(toxicity.held_out("doc_id", 5)), model).selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


def test_hot_words_are_spread(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "the " + " the ".join(f"x{i}y{j}" for j in range(50))) for i in range(40)], "doc_id long, text string")
    whole = [r.score for r in kneser_ney.score(docs, kneser_ney.train(spark, docs)).orderBy("doc_id").collect()]
    monkeypatch.setattr(kneser_ney, "HOT_SHARE", 0.9)
    plain = [r.score for r in kneser_ney.score(docs, kneser_ney.train(spark, docs)).orderBy("doc_id").collect()]
    assert whole == pytest.approx(plain)


def test_starts_of_texts_are_spread(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"x{i} the") for i in range(300)], "doc_id long, text string")
    model = kneser_ney.train(spark, docs)
    assert kneser_ney.START in model.hot and model.hot_stats[model.hot == kneser_ney.START].tolist() == [[300, 300, 0, 0]]
    found = [r.score for r in kneser_ney.score(docs, model).orderBy("doc_id").collect()]
    monkeypatch.setattr(kneser_ney, "HOT_SHARE", 0.9)
    plain = kneser_ney.train(spark, docs)
    assert kneser_ney.START not in plain.hot
    assert found == pytest.approx([r.score for r in kneser_ney.score(docs, plain).orderBy("doc_id").collect()])


def test_counts_beyond_32_bits(spark, monkeypatch, tmp_path):
    many, plain = 5_000_000_000, kneser_ney.stored

    def multiplied(spark, df, name):
        def run(batches):
            for batch in batches:
                counts = [(np.frombuffer(x, np.int64) * many).tobytes() for x in batch["counts"].to_pylist()]
                yield batch.set_column(batch.schema.get_field_index("counts"), "counts", pa.array(counts, pa.binary()))

        return plain(spark, df.mapInArrow(run, df.schema) if name == "lm-words" else df, name)

    monkeypatch.setattr(kneser_ney, "stored", multiplied)
    model = kneser_ney.train(spark, spark.createDataFrame([("a b a",)], "text string"))
    _, _, texts = next(slices(pa.array(["a b a"])))
    words = np.unique(kneser_ney.sequence(texts)[0])
    assert sorted(kneser_ney.Reader(model).find("word", words, ["counts"])[0].tolist()) == [many, many, 2 * many]
    for counts, kind in (([1, many], np.int64), ([1, 2], np.uint32), ([], np.uint32)):
        kept = kneser_ney.narrowed(np.array(counts, np.int64))
        assert kept.tolist() == counts and kept.dtype == kind


def test_ngram_join_equals_all_pairs(spark, documents, texts):
    grams = {}
    for i, t in texts.items():
        w = re.findall(r"[a-z0-9_\u0080-\U0010ffff]+", t.lower())
        grams[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    links = collections.defaultdict(set)
    for a in grams:
        for b in grams:
            if a != b and grams[a] and len(grams[a] & grams[b]) >= 0.8 * len(grams[a] | grams[b]):
                links[a].add(b)
    root = {}
    for i in sorted(grams):
        stack = [i]
        while stack:
            x = stack.pop()
            if x not in root:
                root[x] = i
                stack += links[x]
    found = {r.doc_id: (r.class_id, r.n_links) for r in ngram_join.ngram_jaccard_join(spark, documents).collect()}
    assert found == {i: (root[i], len(links[i])) for i in grams}


def test_blocks_of_a_large_group(spark, monkeypatch):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        w[rng.randrange(120)] = f"z{i}"
        rows.append((i, " ".join(w)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(ngram_join, "BLOCK", 16)
    assert {(r.class_id, r.n_links) for r in ngram_join.ngram_jaccard_join(spark, docs).collect()} == {(0, 59)}


def test_passage_inside_unlike_lines(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    shared = [" ".join(word() for _ in range(51)) for _ in range(20)]
    rows = [(i, " ".join([*(word() for _ in range(90)), shared[i % 20], *(word() for _ in range(80))])) for i in range(40)]
    rows += [(100 + i, " ".join(word() for _ in range(200))) for i in range(20)]
    found = paragraphs.repeated_text(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in found} == set(range(40))
    assert {r.doc_id for r in found if r.removed} == set(range(20, 40)) and all(r.keeper_id == r.doc_id % 20 for r in found)


def test_adjacent_passages_keep_a_copy_each(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choices("abcdefgh", k=12))
    filler = lambda: [word() for _ in range(90)]
    both = [word() for _ in range(240)]
    held = {3: both[:140], 5: both, 9: both[100:], 11: both, 12: both[100:]}  # 3 holds P, 5 P and Q, 9 Q
    texts = {i: [*filler(), *own, *filler()] for i, own in held.items()}
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in texts.items()], "doc_id long, text string")
    found = paragraphs.repeated_text(spark, docs).collect()
    assert all(r.keeper_id != r.doc_id for r in found if r.removed) and {r.component_id for r in found} == {3}
    left = {i: list(t) for i, t in texts.items()}
    for r in found:
        if r.removed:
            left[r.doc_id][r.position : r.position + r.n_words] = [None] * r.n_words
    # besides the ends that are cut differently, one copy of each word is left
    for i in [*range(30, 100), *range(145, 210)]:
        assert [j for j in left if both[i] in left[j]] == [3 if i < 140 else 5]
    assert all(any(w in left[j] for j in left) for w in both)


def test_similar_lines(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    line = [word() for _ in range(100)]
    changed = [*line[:50], "new", *line[51:]]
    rows = [(1, f"{word()}\n{' '.join(line)}"), (2, f"{' '.join(changed)}\n{word()}"), (3, " ".join(word() for _ in range(100)))]
    found = {(r.doc_id, r.position, r.component_id, r.removed) for r in paragraphs.repeated_text(spark, spark.createDataFrame(rows, "doc_id long, text string")).where("unit = 'line'").collect()}
    assert found == {(1, 1, 1, False), (2, 0, 1, True)}


def test_top_k_equals_products(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(-3, 4, (300, 5)) / 256.0  # many ties
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    q = bitsliced.quantised(rows, "vec_id", "embedding")
    found = sorted(map(tuple, bitsliced.top_k(spark, q, q.where("id % 50 = 0"), block=70, chunk=3).collect()))
    ints = np.floor(256 * x).astype(int)
    want = []
    for i in range(0, 300, 50):
        scores = ints @ ints[i]
        order = [j for j in np.lexsort((np.arange(300), -scores)) if j != i][:5]
        want += [(i, k + 1, int(j), int(scores[j])) for k, j in enumerate(order)]
    assert found == sorted(want)


def test_ego_join_equals_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 6))
    x = centres[rng.integers(0, 30, 400)] + 0.08 * rng.normal(size=(400, 6))
    labels = rng.integers(0, 2, 400)
    monkeypatch.setattr(ego_join, "BLOCK", 16)
    monkeypatch.setattr(ego_join, "FANOUT", 2)
    monkeypatch.setattr(ego_join, "LEAF", 4)
    rows = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels, strict=True))], "vec_id long, embedding array<double>, label int")
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (labels[:, None] == labels[None, :])
    np.fill_diagonal(linked, False)
    found = {r.vec_id: (r.n_links, r.component_id) for r in ego_join.cosine_self_join(spark, rows).collect()}
    roots = ngram_join.local_roots(linked, np.arange(400))
    assert found == {i: (int(linked[i].sum()), int(roots[i])) for i in range(400)} and linked.any()


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 9), max_size=12))
def test_packing_plans(counts):
    plan = packing.pack_lengths(dict(counts), 30)
    packed = collections.Counter()
    for pattern, times in plan:
        assert times > 0 and sum(a * b for a, b in pattern) <= 30
        for length, each in pattern:
            packed[length] += each * times
    assert packed == collections.Counter(counts)
    total, used = sum(a * b for a, b in counts.items()), sum(t for _, t in plan)
    assert -(-total // 30) <= used <= max(1, 1.5 * -(-total // 30) + 1, sum(n for a, n in counts.items() if a > 15))


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 10), st.integers(1, 2), min_size=1, max_size=4))
def test_reduction_keeps_the_optimum(counts):
    items = sorted((a for a, n in counts.items() for _ in range(n)), reverse=True)

    def fewest(left, rooms, best):
        if len(rooms) >= best:
            return best
        if not left:
            return len(rooms)
        for i in range(len(rooms)):
            if rooms[i] >= left[0] and rooms[i] not in rooms[:i]:
                best = min(best, fewest(left[1:], [*rooms[:i], rooms[i] - left[0], *rooms[i + 1 :]], best))
        return min(best, fewest(left[1:], [*rooms, 10 - left[0]], best))

    left = packing._Lengths(dict(counts))
    fixed, optimum = [], fewest(items, [], len(items) + 1)
    for length in reversed(list(left.order)):
        if not left.counts.get(length):
            continue
        left.take(length, 1)
        others = packing._dominant(left, length, 10)
        left.counts[length] = left.counts.get(length, 0) + 1
        if length not in left.order:
            import bisect

            bisect.insort(left.order, length)
        if others is not None:
            rest = list(items)
            for x in (length, *others):
                rest.remove(x)
            fixed.append(1 + fewest(rest, [], len(rest) + 1))
    assert all(x == optimum for x in fixed)


def test_tokens_are_the_tokenizers(spark, documents, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    odd = ["a<|endoftext|>b <|startoftext|>", "é́  x　y\x1cz", "don't CAN'T I'll", "ΣΣ Σ", "\U0001f600‍❤ 1234"]
    rows = [*texts.items(), *((10_000 + i, t) for i, t in enumerate(odd))]
    found = collections.defaultdict(list)
    for r in packing.pack_documents(spark, spark.createDataFrame(rows, "doc_id long, text string"), path, capacity=512).collect():
        found[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert sorted(found[i]) == [(k // 512, k, len(ids[k : k + 512]), zlib.crc32(ids[k : k + 512].tobytes())) for k in range(0, len(ids), 512)]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="a@.-_+0159 ()\né", max_size=40))
def test_base_spans_equal_the_patterns(text):
    for kind, own in zip(pii.KINDS, pii.base_spans(text), strict=True):
        want = []
        for m in re.finditer(PATTERNS[kind], text):
            digits = re.sub(r"\D", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0):
                continue
            want.append(m.span())
        assert own == want


def test_contexts_find_unseen_identifiers(spark):
    rng = random.Random(1)
    words = "alpha beta gamma delta epsilon zeta eta theta".split()
    rows = []
    for i in range(60):
        w = [rng.choice(words) for _ in range(30)]
        w[10:10] = ["contact", "mail:", f"u{i}@ex{i}.example"] if i < 20 else ["contact", "mail:", f"user{i}77"] if i < 25 else [rng.choice(words), f"version{i}.{i}"]
        rows.append((i, " ".join(w)))
    found = {r.doc_id: r.n_id for r in pii.find_personal_data(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {i for i, n in found.items() if n} == set(range(20, 25))


def test_toxic_words_are_learned(spark):
    rng = random.Random(2)
    words = ["".join(rng.choices("abcdefgh", k=4)) for _ in range(300)]
    rows = []
    for i in range(900):
        toxic = i % 5 == 0
        w = [rng.choice(words) for _ in range(60)]
        if toxic:
            w[rng.randrange(60)] = rng.choice(["vile", "scum"])
        rows.append((i, " ".join(w), int(toxic)))
    data = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    found = toxicity.toxicity(spark, data.select("doc_id", "text"), data.select("doc_id", "toxic")).where("held_out").collect()
    right = sum(r.predicted == int(r.doc_id % 5 == 0) for r in found)
    assert right / len(found) > 0.97


def test_repeated_text_is_the_same_for_any_order_of_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plain = lambda df: sorted(map(str, paragraphs.repeated_text(spark, df).collect()))
    want = plain(docs)
    assert want == plain(docs.repartition(7)) == plain(docs.orderBy(F.rand(3)))


def test_a_line_in_repeated_rows(spark):
    line = " ".join(f"w{i}" for i in range(40))
    rows = [(1, f"a\n{line}")] * 3 + [(2, line), (None, line), (None, line)]
    found = paragraphs.repeated_text(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).where("unit = 'line'")
    assert sorted((r.doc_id or 0, r.position, r.removed) for r in found.collect()) == [(0, 0, True)] * 2 + [(1, 1, False)] * 3 + [(2, 0, True)]


def test_top_k_of_large_components(spark):
    vectors = [(0, [9.0e6, 1.0]), (1, [9.0e6, 2.0]), (2, [-3.0, 4.0]), (3, [1.0e13, 0.0]), (50, [-1.0, 0.5])]
    q = bitsliced.quantised(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    assert q.count() == 5
    found = {(r.query_id, r.vec_id): r.score for r in bitsliced.top_k(spark, q, q.where("id = 50")).collect()}
    ints = {i: [math.floor(256 * x) for x in v] for i, v in vectors}
    assert found == {(50, i): sum(a * b for a, b in zip(ints[50], ints[i], strict=True)) for i in (0, 1, 2, 3)}
    with pytest.raises(Exception):  # noqa: B017 - a score beyond a long is an error, not a missing row
        bitsliced.top_k(spark, q, q.where("id = 3")).collect()
    beyond = spark.createDataFrame([(0, [1.0e30])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        bitsliced.quantised(beyond, "vec_id", "embedding").collect()
