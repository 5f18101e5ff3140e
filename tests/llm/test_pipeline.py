"""The whole pipeline, row by row, against a plain version of its stages.

The plain version takes the trained weights of the classifier and the hash
that picks rows for an extra copy from Spark; all else is done one document,
or one pair, at a time.
"""

import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_contexts import plain as plain_contexts
from tokenizers import Tokenizer

import corpus_pipeline
from foehn.llm import mixing, pii, toxicity
from foehn.llm.packing import pack_lengths
from foehn.llm.queries import tokenizer_path
from foehn.llm.textvec import slices

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
PROSE = " ".join(f"w{i}" for i in range(80))
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def fixture_rows(spark):
    held = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 1000").select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long")).collect()]
    seeds = [f"alpha{i} beta gamma please reach me: user{i}@ex{i}.example today delta {i} epsilon" for i in range(8)]
    ids = ["first one please reach me: zx-77-q today or later", "second one please reach me: zx-77-q today or never"]
    own = [(PROSE, "a"), (PROSE, "b"), (PROSE + " more", None), (PROSE.upper() + ".", "a"), ("", "b"), (None, "b"), (None, None), (" \n", "a"), ("few words", "a"), ("Few, words", "c")]
    own += [(t, "a") for t in seeds + ids] + [("".join(chr(97 + i * i % 23) for i in range(12_000)), "b")]
    return held + [(900_000 + i, t, "en", s, len(t or "")) for i, (t, s) in enumerate(own)]


def plain_toxic(spark, rows, folder):
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = lambda df: df.where(~toxicity.held_out("doc_id", 3))
    index, weights = toxicity.train(spark, out(docs), out(labels).select("doc_id", F.col("toxic").alias("label")))
    weight = dict(zip(index.tolist(), weights.tolist(), strict=True))
    kept = []
    for r in rows:
        found = {toxicity.INTERCEPT}
        for _, _, texts in slices(pa.array([toxicity_case(r[1])])):
            found |= set(toxicity.features(texts)[1].tolist())
        if 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(weight.get(i, 0.0) for i in found))))) < toxicity.THRESHOLD:
            kept.append(r)
    return kept


def toxicity_case(text):
    return (text or "").lower()


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[a-zA-Z0-9_\u0080-\U0010ffff]+", text or "")]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_near(rows):
    sets = [shingles(r[1]) for r in rows]
    head = list(range(len(rows)))

    def root(i):
        while head[i] != i:
            i = head[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                head[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i])
    return [min(g) for g in groups.values()]


def plain_hidden(rows):
    texts = [r[1] or "" for r in rows]
    ids = defaultdict(list)
    for text, a, b in plain_contexts(texts):
        ids[text].append((a, b, "id"))
    out = []
    for r, text in zip(rows, texts, strict=True):
        spans = [(a, b, k) for k, own in zip(pii.KINDS, pii.base_spans(text), strict=True) for a, b in own] + ids[text]
        hidden, done = "", 0
        for a, b, kind in sorted(spans, key=lambda s: (s[0], -s[1], s[2])):
            if a >= done:
                hidden += text[done:a] + f"<{kind.upper()}>"
            done = max(done, b)
        hidden += text[done:]
        out.append((r[0], hidden, *r[2:4], len(hidden)) if spans else r)
    return out


def plain_targets(sizes):
    """Target of each source: by filling up, a little at a time, found by bisection of the level."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    total, low, high = sum(sizes.values()), 0.0, float(3 * sum(sizes.values()) + 1)
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(weight[s] * level, 3.0 * sizes[s]) for s in sizes) < total else (low, level)
    return {s: min(weight[s] * high, 3.0 * sizes[s]) for s in sizes}


def plain_mixed(spark, rows):
    size = [len(WORDS.findall(r[1] or "")) for r in rows]
    hashes = {
        (r["id"], r["size"]): r["h"]
        for r in spark.createDataFrame([(r[0], n) for r, n in zip(rows, size, strict=True)], "id long, size long").withColumn("h", F.xxhash64("id", "size", F.lit(11))).collect()
    }
    cells = defaultdict(lambda: defaultdict(list))
    for r, n in zip(rows, size, strict=True):
        cells[r[3]][n].append(r)
    sizes = {s: sum(n * len(x) for n, x in own.items()) for s, own in cells.items()}
    targets, out = plain_targets(sizes), []
    for source, own in cells.items():
        rate = lambda n, lam: min(3.0, math.exp(min(50.0, lam * n)))
        low, high = -60.0, 60.0
        for _ in range(300):
            lam = (low + high) / 2
            low, high = (lam, high) if sum(n * len(x) * rate(n, lam) for n, x in own.items()) < targets[source] else (low, lam)
        owed = 0.0
        for n in sorted(own, reverse=True):
            ranked = sorted(own[n], key=lambda r, n=n: (hashes[r[0], n], r[0]))
            copies = len(ranked)
            if n:
                owed += n * len(ranked) * rate(n, high)
                copies = min(max(round(owed / n), 0), 3 * len(ranked))
                owed -= copies * n
            for i, r in enumerate(ranked):
                out += [r] * (copies // len(ranked) + (i < copies % len(ranked)))
    return out


def plain_pieces(rows):
    tokenizer, out = Tokenizer.from_file(tokenizer_path()), []
    for r in rows:
        ids = [*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for k, start in enumerate(range(0, len(ids), 4096)):
            cut = np.array(ids[start : start + 4096], "<u4")
            out.append((r[0], k, start, len(cut), zlib.crc32(cut.tobytes())))
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(fixture_rows(spark), COLUMNS).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{SF}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_equals_its_plain_version(spark, folder):
    rows = fixture_rows(spark)
    plain = {"toxicity": lambda r: plain_toxic(spark, r, folder), "ngram_jaccard_join": plain_near, "pii": plain_hidden, "mixing": lambda r: plain_mixed(spark, r)}
    want, docs, changed = rows, spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, want = want, plain[name](want)
        docs = corpus_pipeline.stored(spark, stage(spark, docs, folder), f"test-{name}")
        got = Counter(tuple(r) for r in docs.select("doc_id", "text", "lang", "source", "n_chars").collect())
        assert got == Counter(want), (name, list((got - Counter(want)).items())[:3], list((Counter(want) - got).items())[:3])
        changed.append(Counter(before) != got)
    assert changed == [True] * 4  # each stage has something to do here
    want = plain_pieces(want)
    found = corpus_pipeline.run(spark, folder).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == Counter(want)
    places = sorted((r.sequence_id, r.offset, r.length) for r in found)
    for a, b in zip([(None, 0, 0), *places], places, strict=False):
        assert b[1] == (a[1] + a[2] if a[0] == b[0] else 0) and b[1] + b[2] <= 4096
    lengths = Counter(x[3] for x in want)
    least = -(-sum(k * n for k, n in lengths.items()) // 4096)
    assert least <= len({p[0] for p in places}) == sum(n for _, n in pack_lengths(dict(lengths))) <= 1.25 * least + 1
