"""Quality classifier, filter audit and centroid clustering."""

import itertools
import re
import zlib
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from foehn.llm import filter_audit, nb_svm, ptolemaic
from foehn.llm.longtext import pieces
from foehn.llm.textvec import SPACE

SF = "/root/testdata/sf0.001"
TEXT = st.text(alphabet="aAbé \t\n#𝔸Z|x", max_size=60)


# --- pieces of long texts -------------------------------------------------------

@settings(max_examples=80, deadline=None)
@given(st.text(alphabet="abé  \n", max_size=80), st.integers(1, 30), st.integers(0, 3))
def test_pieces_cover_the_text_and_cut_no_word(text, size, back):
    buf = np.frombuffer(text.encode(), np.uint8)
    covered = 0
    for lo, hi in pieces(buf, size, back):
        assert lo <= covered <= hi
        assert hi == len(buf) or not SPACE[buf[hi]]
        assert lo == 0 or lo == covered or not SPACE[buf[lo - 1]]
        covered = hi
    assert covered == len(buf)


# --- filter audit ---------------------------------------------------------------

def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return [len(words), len(set(words)), len(re.findall("[A-Z]", text or "")), len(text or ""), len(re.findall(r"[#$%&*|]", text or ""))]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=8), st.sampled_from([1, 9, 50, 1 << 20]))
def test_counts_equal_plain_python(texts, slice_bytes):
    assert filter_audit.count_texts(pa.array(texts, pa.string()), slice_bytes).tolist() == [plain_counts(t) for t in texts]


def test_words_longer_than_eight_bytes_are_told_apart():
    stem = "x" * 70
    text = " ".join([stem + "a", stem + "b", stem + "a", "y" * 64, "y" * 63 + "z", "y" * 64, "abcdefgh1", "abcdefgh2", "abcdefgh1"])
    assert filter_audit.count_texts(pa.array([text]))[0].tolist()[:2] == [9, 6]


def test_equal_hashes_are_verified(monkeypatch):
    monkeypatch.setattr(filter_audit, "mix", lambda x: x * np.uint64(0))
    texts = ["a b a c", "a b", "", "b b " + "q" * 80 + " " + "r" * 80 + " " + "q" * 80]
    assert filter_audit.count_texts(pa.array(texts)).tolist() == [plain_counts(t) for t in texts]


def test_a_long_text_in_pieces():
    text = " ".join(f"w{i % 5000}É#" for i in range(300_000))
    assert filter_audit.count_texts(pa.array([text, "a"])).tolist() == [plain_counts(text), plain_counts("a")]


def plain_audit(docs, labels):
    """docs (doc_id, text, lang), labels (doc_id, quality, toxic)."""
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    rows = []
    for i, t, lang in docs:
        n = plain_counts(t)
        tests = [n[0] < 100, 100 * n[1] < 80 * n[0], 100 * n[2] > 10 * n[3], n[4] > 0, i is not None and i > first[t or ""]]
        fails = {c for c, x in zip("ABCDE", tests, strict=True) if x}
        own = [x for x in labels if i is not None and x[0] == i]
        rows.append((lang or "", fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out, shapley = {}, {}
    for part in {r[0] for r in rows}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [r for r in rows if r[0] == part]
            for step, f in enumerate(order, 1):
                hit, gone = [r for r in left if f in r[1]], [r for r in rows if r[0] == part and f in r[1] and set(order[: step - 1]) & r[1]]
                left = [r for r in left if f not in r[1]]
                unique = sum(r[0] == part and r[1] == {f} for r in rows)
                out[part, order, step] = (len(left), len(hit), len(gone), unique, sum(r[2] for r in hit), sum(r[3] for r in hit))
                shapley[part, f] = shapley.get((part, f), 0) + len(hit)
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_equals_brute_force_on_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(120))
    docs = [
        (1, long, "en"), (2, long, "en"), (2, long, "en"), (None, long, "fr"), (None, None, None), (3, "", None), (4, None, ""), (5, "A $ A", "fr"),
        (6, "a " * 200, "fr"), (7, "B" * 10 + " " + long, "fr"), (8, long + "|", "en"), (9, "x", None), (9, "y", "en"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (2, 1, None), (None, 1, 1), (5, None, 1), (7, 1, 1), (99, 1, 1)]
    frame = spark.createDataFrame([(*d, 0, 0) for d in docs], "doc_id long, text string, lang string, digest int, n_words int")
    found = filter_audit.interaction_audit(spark, frame, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert found.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {tuple(r) for r in found.collect()} == plain_audit(docs, labels)


def test_audit_of_no_documents(spark):
    docs, labels = spark.createDataFrame([], "doc_id long, text string, lang string"), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.interaction_audit(spark, docs, labels).count() == 0
    one = spark.createDataFrame([(1, "a", "en")], docs.schema)
    assert filter_audit.interaction_audit(spark, one, labels).count() == 600


# --- centroid clustering ----------------------------------------------------------

def plain_lloyd(vectors, k=16, rounds=3, scale=64):
    """vectors: (id, components); exact integers throughout."""
    rows = [(i, [int(np.floor(scale * np.float64(x))) for x in v]) for i, v in vectors]
    key = lambda r: (r[0] is None, sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    centroids = [v for _, v in sorted(rows, key=key)[:k]]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    near = lambda v: min((gap(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = [near(v)[1] for _, v in rows]
        for j in set(own):
            mine = [v for (_, v), o in zip(rows, own, strict=True) if o == j]
            centroids[j] = [sum(x) // len(mine) for x in zip(*mine, strict=True)]
    last = [(i, *near(v)) for i, v in rows]
    inertia = {j: sum(d for _, d, o in last if o == j) for j in range(len(centroids))}
    names = [sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted((-1 if i is None else i, j, d, inertia[j], sum(inertia.values()), names[j]) for i, d, j in last)


def found_clusters(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


@pytest.mark.parametrize(("spread", "huge"), [(0.02, 0.0), (1.0, 0.0), (1.0, 5.0e6)])
def test_clusters_equal_plain_lloyd(spark, spread, huge):
    rng = np.random.default_rng(3)
    middle = rng.normal(size=(5, 64))
    rows = [(i, [float(np.float32(x)) for x in middle[i % 5] * spread + rng.normal(size=64) * spread * 0.3]) for i in range(150)]
    if huge:  # components whose squares need care
        rows[7][1][5], rows[9][1][60] = huge, -huge
    rows += [(200, rows[3][1]), (201, rows[3][1]), (3, rows[3][1]), (None, rows[4][1])]
    odd = [(300, None), (301, rows[0][1][:63]), (302, [None, *rows[0][1][1:]]), (303, [float("nan"), *rows[0][1][1:]]), (304, [float("inf"), *rows[0][1][1:]]), (305, [])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows + odd], "vec_id long, embedding array<float>, cluster string, q int").repartition(3)
    found = ptolemaic.clustered(spark, df)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert found_clusters(found) == plain_lloyd(rows)


def test_few_equal_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert ptolemaic.clustered(spark, spark.createDataFrame([], schema)).count() == 0
    assert ptolemaic.cluster_vectors(spark, spark.createDataFrame([(1, [0.5] * 64)], schema), rounds=0).checks == []
    for rows in ([(1, [0.5] * 64)], [(i, [0.25] * 64) for i in range(40)], [(i, [float(i % 3)] * 64) for i in range(9)]):
        assert found_clusters(ptolemaic.clustered(spark, spark.createDataFrame(rows, schema))) == plain_lloyd(rows)


def test_other_shapes_and_too_large_components(spark):
    rows = [(i, [float(i % 7), float(i % 5) / 3]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found_clusters(ptolemaic.clustered(spark, df, k=4, rounds=5, dims=2, scale=100)) == plain_lloyd(rows, 4, 5, 100)
    with pytest.raises(Exception, match="too large"):
        ptolemaic.clustered(spark, spark.createDataFrame([(1, [1e30, 0.0])], df.schema), dims=2).count()


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.sampled_from([1, 1000, 2**40]))
def test_bounds_never_exceed_distances(seed, size):
    rng = np.random.default_rng(seed)
    q, c, p = (rng.integers(-size, size + 1, (n, 6)) for n in (20, 5, 5))
    c[0], c[1], c[2], p[4] = q[0], p[0], p[2], p[3]  # a row, another's pivot, its own pivot; equal pivots
    pivots = ptolemaic.Pivots(p)
    bound = pivots.bounds(pivots.distances(q), c)
    for j, centroid in enumerate(c):
        exact = ptolemaic.exact(q, centroid)
        assert all(b * b * (1 - ptolemaic.SLACK) <= float(d) * (1 + ptolemaic.SLACK) for b, d in zip(bound[:, j], exact, strict=True))


def test_bounds_skip_far_centroids(spark):
    rng = np.random.default_rng(5)
    middle = rng.normal(size=(16, 64)) * 10
    rows = [(i, [float(x) for x in middle[i % 16] + rng.normal(size=64) * 0.1]) for i in range(400)]
    found = ptolemaic.cluster_vectors(spark, spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.vectors == 400 and len(found.checks) == 3 and found.skipped() > 0.5


# --- quality classifier -------------------------------------------------------------

def plain_features(text):
    """Number of distinct n-grams of a text, by the definition."""
    tokens = re.findall(r"[a-zA-Z0-9_\u0080-\U0010ffff]+|[!-/:-@\[-^`{-~]+", text)
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    twice = any(a == b for a, b in itertools.pairwise(words))
    thrice = any(a == b == c for a, b, c in zip(words, words[1:], words[2:], strict=False))
    return len(set(tokens)) + len(set(itertools.pairwise(tokens))) + twice + thrice


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abC !|\n$é", max_size=50), min_size=1, max_size=5), st.sampled_from([1, 12, 1 << 20]))
def test_features_of_whole_texts(texts, slice_bytes):
    counts = [n for _, first in nb_svm.features(pa.array(texts), slice_bytes) for n in np.diff(first).tolist()]
    assert counts == [plain_features(t) for t in texts]  # 2**20 indices: no two of so few meet


def test_ratios_equal_their_formula():
    rows = [np.array([1, 5]), np.array([5]), np.array([7, 9])]
    ratios = nb_svm.log_count_ratios(rows, np.array([1, 1, 0]))
    n = 1 << nb_svm.BITS
    assert ratios[5] == pytest.approx(np.log((3 / (n + 3)) / (1 / (n + 2))))
    assert ratios[7] == pytest.approx(np.log((1 / (n + 3)) / (2 / (n + 2))))


def test_dual_descent_reaches_the_least_hinge_loss():
    """Against projected gradient steps on the same dual problem."""
    rng = np.random.default_rng(1)
    rows = [np.unique(rng.integers(2, 12, 4)) for _ in range(30)]
    labels = np.array([int(r[0] < 5) ^ int(rng.random() < 0.1) for r in rows])
    ratios = nb_svm.log_count_ratios(rows, labels)
    w, bias = nb_svm.dual_descent(rows, labels, ratios, epochs=2000)
    x = np.zeros((30, 13))
    for i, r in enumerate(rows):
        x[i, r], x[i, 12] = nb_svm.scaled(r, ratios), 1.0
    n1 = labels.sum()
    cost = np.where(labels == 1, max(1, (30 - n1) / n1), max(1, n1 / (30 - n1)))
    primal = lambda v: 0.5 * v @ v + cost @ np.maximum(0, 1 - (2 * labels - 1) * (x @ v))
    signed = x * (2 * labels - 1)[:, None]
    dual, step = np.zeros(30), 1 / np.linalg.norm(signed @ signed.T, 2)
    for _ in range(50_000):
        dual = np.clip(dual + step * (1 - signed @ (signed.T @ dual)), 0, cost)
    assert primal(np.append(w[:12], bias)) == pytest.approx(primal(signed.T @ dual), rel=1e-2)


def test_curve_orders_and_calibrates():
    margins = np.concatenate((np.linspace(-2, 0.5, 50), np.linspace(-0.5, 2, 150)))
    slope, offset = nb_svm.logistic_curve(margins, np.repeat((0, 1), (50, 150)))
    p = 1 / (1 + np.exp(-(slope * margins + offset)))
    assert slope > 0 and p.sum() == pytest.approx(150 * 151 / 152 + 50 / 52, rel=1e-3)


def test_held_out_quality(spark):
    """Trained on four fifths of sf0.01's labels, tested on the rest."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in nb_svm.quality(spark, docs, labels).collect()}
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for i, r in rows.items())
    known = [(r.quality, rows[r.doc_id].score) for r in labels.collect() if r.doc_id in rows and rows[r.doc_id].held_out]
    good, bad = [s for q, s in known if q], [s for q, s in known if not q]
    assert sum(a > b for a in good for b in bad) / len(good) / len(bad) > 0.9


def test_odd_rows_and_labels_of_one_kind(spark):
    docs = spark.createDataFrame(
        [(i, t, 0.1, "x") for i, t in [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "a b"), (4, "c " * 400_000), *((10 + i, f"good w{i}" if i % 2 else f"$$$ w{i}") for i in range(40))]],
        "doc_id long, text string, score double, _text string",
    )
    one = spark.createDataFrame([(i, 1) for i in (1, 2, 3)], "doc_id long, quality int")
    assert {r.score for r in nb_svm.quality(spark, docs, one).collect()} == {0.5}
    none = spark.createDataFrame([], one.schema)
    assert nb_svm.without_junk(spark, docs, none).count() == docs.count()
    both = spark.createDataFrame([(10 + i, i % 2) for i in range(40)] + [(None, 1), (11, None), (11, 0)], one.schema)
    found = nb_svm.quality(spark, docs, both)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == docs.count()
    scores = [(r.doc_id, r.score) for r in found.collect()]
    assert len({s for i, s in scores if i == 3}) == 1
    assert np.mean([s for i, s in scores if i and i > 9 and i % 2]) > np.mean([s for i, s in scores if i and i > 9 and not i % 2])
    kept = nb_svm.without_junk(spark, docs, both)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    assert nb_svm.quality(spark, docs.limit(0), both).count() == 0
