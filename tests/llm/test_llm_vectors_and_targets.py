"""Clustering, importance resampling and decontamination against brute force, and their edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from outpulse.llm import clustering, decontamination, importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
CLASHING = "row long, key string, mark string, span int, lang string, h string, v string, cluster int"
LONG = " ".join(f"w{i % 89}x{i % 7}" for i in range(30000))


def words(text):
    return WORD.findall((text or "").translate(str.maketrans(importance.UPPER, importance.LOWER)))


def documents(spark, pairs):
    return spark.createDataFrame([(i, t, 1, "k", "m", 2, "en", "h", "v", 3) for i, t in pairs], f"doc_id long, text string, {CLASHING}")


def items(spark, pairs):
    return spark.createDataFrame([(i, t, 1, "k", "m", 2, "en", "h", "v", 3) for i, t in pairs], f"item_id long, text string, {CLASHING}")


def vectors(spark, pairs):
    return spark.createDataFrame([(i, v, 1, "k", "m", 2, "en", "h", "v", 3) for i, v in pairs], f"vec_id long, embedding array<double>, {CLASHING}")


# centroid clustering


def plain_clusters(pairs, k=16, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in pairs if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    centroids = [v for _, v in sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1]))[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in kept:
            members[near(v)[1]].append(v)
        centroids = [[sum(x) // len(members[n]) for x in zip(*members[n])] if n in members else c for n, c in enumerate(centroids)]
    placed = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in placed:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in placed)


def test_clusters_equal_brute_force(spark):
    rnd = random.Random(3)
    middle = [[rnd.gauss(0, 1) for _ in range(64)] for _ in range(9)]
    pairs = [(n, [x + rnd.gauss(0, 0.2) for x in middle[n % 9 if n % 3 else 0]]) for n in range(700)]
    pairs += [(7, pairs[7][1])] * 40 + [(None, pairs[9][1]), (900, None), (901, [1.0] * 63), (902, [None] + [1.0] * 63), (903, [float("nan")] + [1.0] * 63), (904, [float("inf")] + [0.0] * 63), (905, [0.0] * 64), (906, [-0.0] * 64)]
    got = Counter(map(tuple, clustering.cluster(vectors(spark, pairs).repartition(7)).collect()))
    assert got == plain_clusters(pairs)


def test_clusters_few_equal_and_no_vectors(spark):
    same = [(n, [0.5] * 64) for n in range(20)]  # every centroid ties: all to number 0, the others stay
    assert Counter(map(tuple, clustering.cluster(vectors(spark, same)).collect())) == plain_clusters(same)
    few = [(1, [0.5] * 64), (2, [-3.0] * 64)]
    assert Counter(map(tuple, clustering.cluster(vectors(spark, few)).collect())) == plain_clusters(few)
    empty = clustering.cluster(vectors(spark, []))
    assert empty.count() == 0 and empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    with pytest.raises(Exception, match="a component of more"):
        clustering.cluster(vectors(spark, [(1, [1e30] * 64)])).collect()


def test_pivots_bound_and_spare_distances():
    rnd = np.random.default_rng(5)
    middle = rnd.integers(-400, 400, (16, 64))
    x = middle[rnd.integers(0, 16, 3000)] + rnd.integers(-20, 20, (3000, 64))
    pivots = clustering.Pivots(clustering.far_apart(x[:16], clustering.PIVOTS))
    near = pivots.distances(x)
    exact = ((x[:, None] - middle[None]) ** 2).sum(axis=2)
    assert (pivots.bounds(near, middle) <= exact).all()
    which, best, computed = clustering.nearest(x, near, middle, pivots)
    assert (which == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
    assert computed < 0.5 * exact.size  # without bounds all are computed


# importance resampling


def plain_resample(docs, wanted, percent=5):
    def features(text):
        w = words(text)
        return len(w), [zlib.crc32(" ".join(w[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(w) - k + 1)]

    rows = [(i, *features(t)) for i, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in rows:
        s.update(f)
    for _, text in wanted:
        t.update(features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in range(10000)]
    out = []
    for i, n, f in rows:
        h = None if i is None else int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([i, len(f), weight, None if h is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    drawable = sorted((r for r in out if r[5] >= 20 and r[3] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for n, r in enumerate(drawable[: percent * len(drawable) // 100]):
        r[4] = n + 1
    return Counter(tuple(r[:5]) for r in out)


def made_documents(n=400):
    rnd = random.Random(8)
    vocabulary = [f"t{i}" for i in range(60)] + ["Öl", "漢字", "İ", "a1b"]
    lines = [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 9))) for _ in range(50)] + ["", " ", "one", "two words", "THE hot Line of all"]
    texts = ["\n".join(rnd.choice(lines + ["THE hot Line of all"] * 30) for _ in range(rnd.randint(1, 14))) for _ in range(n)]
    return list(enumerate(texts)) + [(3, texts[3])] * 30 + [(3, texts[5]), (None, texts[6]), (1001, None), (1002, ""), (1003, "\n\n"), (1004, LONG), (1005, "a\nb\nc\n\nd e\r\nf")]


def test_resample_equals_brute_force(spark):
    docs, wanted = made_documents(), [(1, "t1 t2 t3\nt4 t5"), (1, None), (2, "the hot line of all"), (None, "漢字 a1b t9")]
    got = Counter(map(tuple, importance.resample(documents(spark, docs).repartition(9), items(spark, wanted)).collect()))
    assert got == plain_resample(docs, wanted)
    assert sum(1 for r in got if r[4]) > 10


def test_resample_empty_tables(spark):
    docs = made_documents(60)
    assert Counter(map(tuple, importance.resample(documents(spark, docs), items(spark, [])).collect())) == plain_resample(docs, [])
    assert importance.resample(documents(spark, []), items(spark, [(1, "a b")])).count() == 0
    assert all(r["rank"] is None for r in importance.resample(documents(spark, [(1, "few words"), (2, None)]), items(spark, [(1, "a b")])).collect())


def test_distinct_lines_are_counted_once(spark):
    counted = importance.Counted(documents(spark, [(n, "the same line here\nand another one") for n in range(50)]), "doc_id")
    assert sorted(r.n for r in counted.lines.collect()) == [50, 50]
    assert {tuple(r.crossing) for r in counted.rows.collect()} == {tuple(zlib.crc32(x.encode()) % 10000 for x in ("line here and", "here and", "here and another"))}


# decontamination


def plain_scan(docs, wanted, span=10):
    windows = defaultdict(set)
    for i, text in wanted:
        w = words(text)
        n = min(span, len(w))
        for s in range(len(w) - n + 1) if w else ():
            windows[tuple(w[s : s + n])].add(i)
    lengths = {len(k) for k in windows}
    out = Counter()
    for i, text in docs:
        w, hit, named = words(text), set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[s : s + n]))) is not None:
                    hit |= set(range(s, s + n))
                    named |= {str(x) for x in found if x is not None}
        out[(i, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit))] += 1
    return out


def contaminated_case():
    rnd = random.Random(4)
    vocabulary = [f"v{i}" for i in range(12)]
    make = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    wanted = [(n, " ".join(make(rnd.choice([10, 11, 12, 30, 60])))) for n in range(25)]
    wanted += [(100, wanted[0][1]), (100, wanted[0][1]), (101, None), (102, ""), (103, "v1 v1 v1 v1 v1 v1 v1 v1 v1 v1 v1 v1"), (None, " ".join(make(14)))]
    docs = []
    for n in range(150):
        text = make(rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 3)):
            piece = words(rnd.choice(wanted)[1])
            cut = rnd.randint(0, 4)
            text += piece[cut : len(piece) - rnd.randint(0, 4)] + make(rnd.randint(0, 5))
        docs.append((n, "\n".join(text).upper() if n % 5 == 0 else ", ".join(text)))
    docs += [(1, docs[1][1])] * 20 + [(None, docs[2][1]), (900, None), (901, ""), (902, "v1 " * 25), (903, LONG + " " + wanted[4][1]), (1, "no match")]
    return docs, wanted


@pytest.mark.parametrize("few", [decontamination.FEW, 0])
def test_scan_equals_brute_force(spark, few):
    docs, wanted = contaminated_case()
    got = Counter(map(tuple, decontamination.scan(documents(spark, docs).repartition(5), items(spark, wanted), few).collect()))
    assert got == plain_scan(docs, wanted)
    assert sum(r[5] for r in got) > 50


def test_scan_short_items(spark):
    docs, wanted = contaminated_case()
    wanted = wanted[:5] + [(200 + n, " ".join(f"v{(n + i) % 12}" for i in range(n))) for n in range(1, 10)]
    got = Counter(map(tuple, decontamination.scan(documents(spark, docs), items(spark, wanted)).collect()))
    assert got == plain_scan(docs, wanted)


def test_scan_empty_tables(spark):
    docs = [(1, "a b c"), (2, None)]
    assert Counter(map(tuple, decontamination.scan(documents(spark, docs), items(spark, [])).collect())) == plain_scan(docs, [])
    assert decontamination.scan(documents(spark, []), items(spark, [(1, "a b")])).count() == 0


def test_scan_stays_in_the_jvm_and_keeps_few_grams(spark):
    docs, wanted = contaminated_case()
    grams, spans = decontamination.benchmark_grams(items(spark, wanted))
    plan = decontamination.spans_hit(documents(spark, docs), grams, spans, True)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    text = documents(spark, [(1, " ".join(f"u{i}" for i in range(20000)))])
    kept = text.select(decontamination.word_hashes(F.col("text")).alias("hs")).select(F.size(decontamination.winnowed(F.col("hs"), 10)).alias("n"))
    assert 0.25 < kept.first().n / 20000 < 0.32  # two in w + 1 = 7
