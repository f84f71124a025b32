"""The dealt operators against brute force, round trips and held-out labels, and their edge cases."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from outpulse.llm import bpe, chat, fingerprint, licenses, near_dedup, packing, quality, search, tokens_file, toxicity
from outpulse.llm.common import held_out, words
from outpulse.llm.queries import PROBE, vocabulary

ALPHABET = "ab  \n\n\t\r\x1c\x1d\x85   é'stllI1 2!?.漢字😀ñ​　<|>ΣςÀÉİ́ǅªº²½"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, label string, chunk string, node string"


def fuzz(n, size=40, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, size))) for _ in range(n)]


def frame(spark, pairs):
    return spark.createDataFrame([(i, t, "en", "s", None, "x", "x", "x", "x") for i, t in pairs], DOCS)


LONG = " ".join(f"word{i % 997} of{i % 13}" for i in range(12000))
EDGES = [(1, "one two three four five six seven"), (1, "one two three four five six seven"), (2, None), (3, ""), (None, "no id here"), (4, LONG), (5, LONG), (6, " \n\t "), (2, "another text of the id two")]


@pytest.fixture(scope="module")
def edges(spark):
    return frame(spark, EDGES)


@pytest.fixture(scope="module")
def nothing(spark):
    return frame(spark, [])


# byte-level BPE


def test_bpe_equals_library():
    path = vocabulary("ranks")
    mine = bpe.codec(path, public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=mine.ranks, special_tokens={})
    many = fuzz(3000) + ["a" * 1000, "ab" * 3000, " " * 700 + "x", "\n" * 300, "xyzzy" * 300, "é" * 400, ""]
    for text, ids in zip(many, mine.encode(many)):
        assert ids == np.array(theirs.encode_ordinary(text), "<u4").tobytes(), text[:60]
        assert mine.decode(ids) == text.encode()


def test_bpe_frames(edges, nothing):
    rows = bpe.digests(edges, vocabulary("ranks")).collect()
    assert len(rows) == len(EDGES)
    assert all(r.decoded_sha256 in {hashlib.sha256((t or "").encode()).hexdigest() for i, t in EDGES if i == r.doc_id} for r in rows)
    assert bpe.digests(nothing, vocabulary("ranks")).count() == 0


# token files


@pytest.mark.parametrize(("kind", "spaced"), [("bytes", True), ("words", False)])
def test_units_give_the_library_ids(kind, spaced):
    lib = tokens_file.library(vocabulary(kind), spaced)
    many = fuzz(2000) + ["<|endoftext|> <|startoftext|>a", "ΑΣ ΑΣ.", "don't 'S it'll", "  a", "a  ", ""]
    for text, ids in zip(many, lib.encode(many)):
        assert ids == np.array(lib.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text


@pytest.mark.parametrize("ids", [[], [0], [70000, 1, 2**32 - 1, 255, 256], list(range(0, 200000, 37))])
def test_codes_are_addressable(ids):
    d = tokens_file.Dac(tokens_file.dac_encode(np.array(ids, np.uint32)))
    assert d.all().tolist() == ids
    assert all(d.at(i) == ids[i] for i in range(0, len(ids), 1 + len(ids) // 50))
    with pytest.raises(IndexError):
        d.at(len(ids))


def test_token_file_round_trip(spark, edges, nothing, monkeypatch):
    monkeypatch.setattr(tokens_file, "SEGMENT_TOKENS", 50)
    lib = tokens_file.library(vocabulary("bytes"), True)
    rows = tokens_file.round_trip(spark, edges, vocabulary("bytes")).collect()
    order = sorted(EDGES, key=lambda x: (x[0] is not None, x[0] or 0, x[1] or ""))
    want, at = [], 0
    for doc_id, text in order:
        ids = lib.encode([text or ""])[0] + tokens_file.END
        want.append((doc_id, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(map(tuple, rows), key=str) == sorted(want, key=str)
    assert tokens_file.round_trip(spark, nothing, vocabulary("bytes")).count() == 0


# chat


def test_chat_round_trip(spark):
    nasty = [PROBE, "<\\|", "\\<|", "\\\\<|im_sep|>", "", None, "<", "|>", "a\nb", "<|im_sep|>", "\\n"]
    rnd = random.Random(1)
    rows = [(c, t, rnd.choice(["user", "assistant", "sys\\n\ntem", "<|x", None, "assistant"]), rnd.choice(nasty)) for c in range(30) for t in range(rnd.randint(1, 9))]
    rows += [(None, 0, "user", "no id"), (7, 3, "user", "tie"), (7, 3, "user", "tie"), (8, None, "assistant", "no turn")]
    turns = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    out = chat.format_conversations(turns)
    got = {r.conv_id: r for r in out.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}
    convs = defaultdict(list)
    for c, t, role, text in rows:
        convs[c].append((t is not None, t or 0, role or "", text or ""))
    for c, want in convs.items():
        want = [(r, t) for *_, r, t in sorted(want)]
        assert [tuple(x) for x in got[c].turns] == want
        assert got[c].loss == "".join(t for r, t in want if r == "assistant")
        blocks = sum(k == 0 or want[k][0] != want[k - 1][0] for k in range(len(want)))
        assert got[c].formatted.count(chat.START) == blocks and got[c].formatted.count(chat.SEP) == len(want) - blocks
    assert chat.digests(chat.format_conversations(turns.where("false"))).count() == 0


# fingerprints


def test_likeness_is_exact():
    rnd = random.Random(2)
    many = [" ".join(rnd.choice("ab cd ef gh. ij kl\nmn op".split(" ")) for _ in range(rnd.choice([0, 1, 5, 50, 3000]))) for _ in range(80)]
    d = fingerprint.Digests(many)
    one, two = np.arange(79), np.arange(1, 80)
    for i, got in enumerate(fingerprint.likeness(d, one, d, two)):
        a, b = (Counter(fingerprint.paragraphs(many[k])) for k in (i, i + 1))
        total = sum((a | b).values())
        assert got == pytest.approx(sum((a & b).values()) / total if total else 1.0)
    assert fingerprint.likeness(d, one, d, one).min() == 1
    assert fingerprint.fingerprints(d) == fingerprint.fingerprints(fingerprint.Digests(many))


def test_likeness_from_fingerprints_alone(spark):
    """What the query gives can be computed again from its two strings, and is near the share counted in the texts."""
    rnd = random.Random(4)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (0, 3, 30, 400, 400, 2000, 20000, 60000) for _ in range(12)]
    rate = [rnd.choice([0, 0.002, 0.05, 1]) for _ in base]
    other = [" ".join(rnd.choice(vocabulary) if rnd.random() < r else w for w in t.split(" ")) for t, r in zip(base, rate)]
    prints = [fingerprint.fingerprints(fingerprint.Digests(x)) for x in (base, other)]
    got = [r[0] for r in spark.createDataFrame(list(zip(*prints)) + [(None, "")], "a string, b string").coalesce(1).select(fingerprint.likeness_of("a", "b")).collect()]
    assert got.pop() is None
    errors = []
    for a, b, near in zip(base, other, got):
        x, y = (Counter(fingerprint.paragraphs(t)) for t in (a, b))
        apart, total = sum(((x - y) + (y - x)).values()), sum((x | y).values())
        errors.append(abs(near - ((total - apart) / total if total else 1)))
        if apart <= 8:
            assert errors[-1] < 1e-9
    assert np.mean(errors) < 0.05 and max(errors) < 0.5
    swapped = fingerprint.Ladders.read(prints[0][::-1])  # other fingerprints, other likeness: the texts have no say
    rows = np.arange(len(base))
    assert np.mean(fingerprint.ladder_likeness(swapped, rows, fingerprint.Ladders.read(prints[1]), rows)) < np.mean(got) - 0.3
    docs = frame(spark, list(enumerate(base)))
    for r in fingerprint.compare_with_next(docs).withColumn("again", fingerprint.likeness_of("fingerprint", "edited_fingerprint")).collect():
        assert r.again == r.near_edited


def test_likeness_of_fingerprints_is_exact():
    """Whatever differs: few digests of many, all of them, texts of very different lengths, repeated paragraphs."""
    rnd = random.Random(6)
    vocabulary = [f"w{k}" for k in range(500)]
    base = ["", "a b c. " * 40] + [" ".join(rnd.choice(vocabulary) for _ in range(n)) for n in (1, 9, 40, 150, 700, 700, 5000, 30000) for _ in range(5)]
    other = [" ".join(rnd.choice(vocabulary) if rnd.random() < r else w for w in t.split(" ")) for t in base for r in (0, 0.01, 0.1, 1)]
    one, two = (fingerprint.Ladders.read(fingerprint.fingerprints(fingerprint.Digests(x))) for x in (base, other))
    pairs = [(i, j) for i in range(len(base)) for j in {*range(4 * i, 4 * i + 4), *rnd.sample(range(len(other)), 4)}]
    for (i, j), got in zip(pairs, fingerprint.ladder_likeness(one, *np.array(pairs).T[:1], two, *np.array(pairs).T[1:])):
        a, b = (Counter(fingerprint.paragraphs(t)) for t in (base[i], other[j]))
        total = sum((a | b).values())
        assert got == pytest.approx(sum((a & b).values()) / total if total else 1.0, abs=1e-12)


def test_next_document(spark, edges, nothing):
    got = fingerprint.compare_with_next(edges).collect()
    order = sorted(EDGES, key=lambda x: (x[0] is None, -(x[0] or 0), x[1] or ""))
    want = Counter()
    for i, (doc_id, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        want[doc_id, len(text), hashlib.sha256((text[: len(text) - half] + after[:half]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert fingerprint.compare_with_next(nothing).count() == 0
    one = fingerprint.compare_with_next(frame(spark, [(9, "a b c. d e f")])).first()
    assert one.near_next == 1.0


# licences


def within(text, phrase, errors):
    row = list(range(len(phrase) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for j, p in enumerate(phrase, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != p)))
        row, best = new, min(best, new[-1])
    return best <= errors


def test_license_labels():
    rnd = random.Random(3)
    s = licenses.scanner()
    for _ in range(150):
        phrase = rnd.choice(licenses.NOTICES)[0]
        chars = list(phrase)
        for _ in range(rnd.randint(0, 5)):
            k = rnd.randrange(len(chars))
            chars[k : k + 1] = rnd.choice([[], ["q"], [chars[k], "z"]])
        joined = f" some {''.join(chars)} words that follow "
        got = {x.label for x in s.fuzzy(joined)}
        assert got == {label for p, label, e in licenses.NOTICES if within(joined, p, e)}, joined


@pytest.mark.parametrize(("text", "labels"), [
    ("the GNU General Public License, version 3 or later", {"gpl-3"}), ("GNU General Public License version 2", {"gpl-2"}),
    ("gnu generel public license version 2 or gnu general public license version 3.0", {"gpl-2", "gpl-3"}),
    ("gnu general public license version 2 3 clause", {"gpl-2"}), ("gnu general public license version3", {"gpl-3"}), ("gnu general public license version 1", set()),
    ("Mozilla Public License Version 1.1", set()), ("Mozilla Public License, v. 2.0. Mozila Public License Version 2.0", {"mpl-2"}),
    ("mozilla public license version 2", {"mpl-2"}), ("licensed under the apache license version 1 1", set()), ("Licensed under the Apache License, Version 2.0 (the", {"apache-2"}),
])
def test_license_versions(spark, text, labels):
    joined = f" {' '.join(words(text))} "
    assert {x.label for x in licenses.resolved(licenses.scanner().fuzzy(joined), joined)} == labels


@pytest.mark.parametrize(("text", "labels"), [
    ("Released under the BSD license", {"bsd"}), ("released under the ISC license.", {"isc"}), ("Released under the GPL license", {"gpl"}), ("Released under the MIT licence", {"mit"}),
    ("Relased under teh MIT license", {"mit"}), ("released under the zlib license", set()), ("released under the wtf license", set()),
    ("licensed under CC BY-ND 4.0", {"cc-by-nd"}), ("licensed under CC BY-SA 4.0", {"cc-by-sa"}), ("licenced under CC BY-NC 4.0", {"cc-by-nc"}), ("CC BY-SA 4.0", set()),
    ("licensed under CC BY 4.0", set()), ("GNU Affero General Public License, version 3", {"agpl-3"}), ("Affero General Public License version 3", set()),
    ("GNU Lesser General Public License", {"lgpl"}), ("Creative Commons Attribution-NoDerivatives", {"cc-by-nd"}), ("creative commons attribution non commercial", {"cc-by-nc"}),
    ("released under the mit license and released under the bsd license", {"mit", "bsd"}),
])
def test_license_neighbours(text, labels):
    joined = f" {' '.join(words(text))} "
    assert {x.label for x in licenses.resolved(licenses.scanner().fuzzy(joined), joined)} == labels


def test_license_base(spark, edges, nothing):
    text = "Under the MIT License. under the mit license\nCC-BY-NC Cc by nc Apache License, Version 2.0 É under the mit licenses"
    r = licenses.scan(frame(spark, [(1, text)])).first()
    w = words(text)
    places = [i for p, _ in licenses.BASE for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (len(w), len(places), min(places), max(places))
    assert r.base_labels == "apache-2,cc-by-nc,mit" and r.score == 1.0
    got = licenses.scan(edges).collect()
    assert len(got) == len(EDGES) and all(x.n_base == 0 and x.first_word is None and x.labels == "" for x in got)
    assert licenses.scan(nothing).count() == 0


# near duplicates


def test_signature_estimates_weighted_likeness():
    rng = np.random.default_rng(0)
    e = rng.integers(0, 2**63, 300).astype(np.uint64)
    w = rng.uniform(0.2, 3, 300)
    v = w * rng.uniform(0.4, 1, 300)
    got = (near_dedup.signature(e, w, 3000) == near_dedup.signature(e, v, 3000)).mean()
    assert got == pytest.approx(np.minimum(w, v).sum() / np.maximum(w, v).sum(), abs=0.04)
    assert len(set(near_dedup.signature(e[:1]).tolist())) == near_dedup.COORDINATES


def test_components_of_few_edges_take_few_files(spark):
    rnd = random.Random(3)
    edges = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(120)] + [(400, i) for i in range(330, 390)]
    more = [(rnd.randrange(400), rnd.randrange(400)) for _ in range(40)]

    def least(pairs):
        at = {x: x for p in pairs for x in p}
        for _ in at:
            for a, b in pairs:
                at[a] = at[b] = min(at[a], at[b])
        return {x: c for x, c in at.items() if x != c}

    def told(frame):
        return {r.node: r.comp for r in frame.collect()}

    first, then = (spark.createDataFrame(x, "a long, b long") for x in (edges, more))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = near_dedup.components(first)
        assert found.rdd.getNumPartitions() == 1  # a file per shuffle partition and round before
        assert told(found) == least(edges)
        assert told(near_dedup.further_components(found, then)) == least(edges + more)
        assert told(near_dedup.further_components(found, then.limit(0))) == least(edges)
        assert told(near_dedup.further_components(first.limit(0).selectExpr("a node", "b comp"), then)) == least(more)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_classes_equal_brute_force(spark):
    rnd = random.Random(4)
    vocabulary_ = ["".join(rnd.choice("abcdefg") for _ in range(5)) for _ in range(400)]
    docs = []
    for family in range(12):
        base = [rnd.choice(vocabulary_) for _ in range(120)]
        docs.append(list(base))
        for _ in range(rnd.choice([0, 1, 15])):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 2, 6])):
                copy[rnd.randrange(120)] = rnd.choice(vocabulary_)
            docs.append(copy)
    docs += [["short", "one"], ["short", "one"], ["short", "two"], [], []]
    rnd.shuffle(docs)
    pairs = [(i * 3, " ".join(d)) for i, d in enumerate(docs)]

    def shingles(d):
        return {tuple(d[i : i + 5]) for i in range(max(1, len(d) - 4))} if d else set()

    sets = [shingles(d) for d in docs]
    label = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            union = len(sets[i] | sets[j])
            if docs[i] == docs[j] or union and len(sets[i] & sets[j]) >= 0.8 * union:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    got = {r.doc_id: r.class_id for r in near_dedup.classes(frame(spark, pairs)).collect()}
    assert got == {i * 3: 3 * x for i, x in enumerate(label)}
    kept = near_dedup.deduplicated(frame(spark, pairs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({3 * x for x in label})
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]


def test_no_link_fails_the_bound(spark):
    """Pairs at or just over the threshold, of few and many elements: what the exact check keeps passes the bound."""
    rng, rows = np.random.default_rng(8), []
    for n in (1, 9, 10, 27, 90, 180, 360, 900, 9000):
        for _ in range(40):
            both = rng.integers(0, 2**32, 10 * n).astype(np.uint64) << np.uint64(32)
            apart = 2 * n if rng.random() < 0.7 else 4 * n
            cut = int(rng.integers(0, apart + 1))
            s, t = (near_dedup.short(x) for x in (both[apart - cut :], np.concatenate([both[: apart - cut], both[apart:]])))
            shared = len(np.intersect1d(s, t))
            rows.append((10 * shared >= 8 * (len(s) + len(t) - shared), *([*near_dedup.parities(x).view(np.int64).tolist(), len(x)] for x in (s, t))))
    got = spark.createDataFrame(rows, "linked boolean, x array<long>, y array<long>").select("linked", near_dedup.close("x", "y").alias("passed")).collect()
    assert sum(r.linked for r in got) > 100 and all(r.passed for r in got if r.linked)
    assert sum(not r.passed for r in got) > 50


def test_classes_edges(edges, nothing):
    got = Counter((r.doc_id, r.class_id) for r in near_dedup.classes(edges).collect())
    assert got == Counter({(1, 1): 2, (2, 2): 2, (3, 2): 1, (None, None): 1, (4, 4): 1, (5, 4): 1, (6, 2): 1})
    assert sorted(str(r.doc_id) for r in near_dedup.deduplicated(edges).collect()) == ["1", "2", "4", "None"]
    assert near_dedup.classes(nothing).count() == 0 and near_dedup.deduplicated(nothing).count() == 0


def test_one_row_of_every_class_without_own_ids(spark):
    one, two, three = "a text without id that stays", "another clean text that has none", "copies of a document with an id"
    rows = [(None, one), (None, one), (None, two), (None, three), (7, three), (9, three), (5, "first text of five"), (5, "second one of the same id"), (5, "First text of five"), (None, None), (3, "")]
    got = Counter((r.doc_id, r.text) for r in near_dedup.representatives(frame(spark, rows)).collect())
    assert got == Counter({(None, one): 1, (None, two): 1, (7, three): 1, (5, "First text of five"): 1, (5, "second one of the same id"): 1, (3, ""): 1})
    once = [(1, one), (None, two), (2, two)]
    assert sorted(r.doc_id for r in near_dedup.representatives(frame(spark, once)).collect()) == [1, 2]


def test_pipeline_equals_its_steps(spark, tmp_path):
    """The whole pipeline against accepted rows, classes by brute force and the library's ids."""
    rnd = random.Random(9)
    plain = ["".join(rnd.choice("aeioustrn") for _ in range(5)) for _ in range(300)]
    rows = [(i, " ".join(rnd.choice(plain) for _ in range(rnd.randint(20, 60)))) for i in range(60)]
    rows += [(i + 100, t) for i, t in rows[:20]] + [(None, t) for _, t in rows[30:40]] + [(None, "no id of one"), (None, "no id of two"), (3, "a second text of three")]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 0, 1) for i in range(60)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    left = corpus_pipeline.of_quality(spark, corpus_pipeline.without_toxic(spark, docs, str(tmp_path)), str(tmp_path)).collect()
    assert len(left) > 60 and sum(r.doc_id is None for r in left) > 1
    by_words = defaultdict(list)  # random texts have no near links but equal words
    for r in left:
        by_words[tuple(words(r.text))].append(r)
    lib, want = tokens_file.library(vocabulary("words"), False), Counter()
    for same in by_words.values():
        r = min(same, key=lambda r: (r.doc_id is None, r.doc_id or 0))
        ids = lib.encode([r.text])[0] + tokens_file.END
        want[r.doc_id, len(ids) // 4, zlib.crc32(ids)] += 1
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.length, r.ids_crc32) for r in got) == want


# packing


@pytest.mark.parametrize("n", [0, 1, 40, 20000])
def test_plan(n):
    rng = np.random.default_rng(n)
    lengths = np.minimum(2048, np.maximum(1, rng.lognormal(6, 1.2, n).astype(int)))
    histogram = Counter(lengths.tolist())
    found = packing.plan(histogram, 2048)
    used = Counter()
    for pattern, times in found:
        assert sum(pattern) <= 2048 and times > 0
        for x in pattern:
            used[x] += times
    assert used == histogram
    if n == 20000:
        assert sum(t for _, t in found) <= 1.01 * math.ceil(lengths.sum() / 2048)


@pytest.mark.parametrize(("histogram", "most"), [
    ({600: 3000}, 1000), ({1: 3000}, 2), ({300: 1000, 100: 2000}, 250), ({1025: 7, 1: 5000}, 8), ({1: 7000, 600: 2000, 40: 3}, 667),
])
def test_plan_shares_sequences_of_a_hot_length(histogram, most):
    found, used = packing.plan(histogram, 2048), Counter()
    for pattern, times in found:
        assert sum(pattern) <= 2048 and times > 0
        for x in pattern:
            used[x] += times
    assert used == histogram
    assert sum(t for _, t in found) <= most


@pytest.mark.parametrize("times", [1, 50])
def test_plan_is_the_fitted_one(times, monkeypatch):
    lengths = np.minimum(2048, np.maximum(1, np.random.default_rng(1).lognormal(6, 1.2, 20000).astype(int)))
    histogram = {n: c * times for n, c in Counter(lengths.tolist()).items()}
    bound = math.ceil(sum(n * c for n, c in histogram.items()) / 2048)
    fits = []
    monkeypatch.setattr(packing, "fitted", lambda counts, fit=packing.fitted: fits.append(fit(counts)) or fits[-1])
    found = packing.plan(histogram, 2048)
    assert sum(n for _, n in found) <= 1.002 * bound
    assert sum(n for _, n in fits[0]) >= 0.9 * bound  # nearly all sequences start as fitted patterns
    unit = 2048 // packing.COARSE
    starts = Counter()
    for pattern, n in found:
        starts[tuple(sorted(-(-x // unit) for x in pattern[: packing.DEPTH]))] += n
    kept = sum(min(n, starts[p]) for p, n in fits[0])
    assert kept >= 0.5 * bound  # and stay so in the result


def test_plan_fits_patterns_of_more_than_two():
    assert sum(t for _, t in packing.plan({1032: 6000, 528: 6000, 520: 6000, 496: 12000}, 2048)) == 9000
    lengths = np.random.default_rng(3).normal(500, 120, 20000).astype(int).clip(1, 2048)
    histogram = Counter(lengths.tolist())
    found, used = packing.plan(histogram, 2048), Counter()
    for pattern, times in found:
        assert sum(pattern) <= 2048 and times > 0
        for x in pattern:
            used[x] += times
    assert used == histogram
    assert sum(t for _, t in found) <= 1.01 * math.ceil(lengths.sum() / 2048)


def test_packed_sequences(edges, nothing):
    rows = packing.pack(edges, vocabulary("words"), size=64).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for found in by.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at <= 64
    lib = tokens_file.library(vocabulary("words"), False)
    want = Counter()
    for doc_id, text in EDGES:
        ids = lib.encode([text or ""])[0] + tokens_file.END
        for piece, k in enumerate(range(0, len(ids), 256)):
            want[doc_id, piece, k // 4, len(ids[k : k + 256]) // 4, zlib.crc32(ids[k : k + 256])] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    assert packing.pack(nothing, vocabulary("words")).count() == 0


def test_nnls_is_optimal():
    rng = np.random.default_rng(1)
    a, b = rng.random((12, 30)), rng.random(12)
    x = packing.nnls(a, b)
    gradient = a.T @ (b - a @ x)
    assert (x >= 0).all() and gradient.max() < 1e-6 and np.abs(gradient[x > 0]).max() < 1e-6


# classifiers


@pytest.mark.parametrize(("model", "target", "bad"), [(toxicity, "toxic", 1), (quality, "quality", 0)])
def test_classifier_on_held_out(spark, model, target, bad):
    rnd = random.Random(6)
    plain = ["".join(rnd.choice("aeioustrn") for _ in range(rnd.randint(2, 7))) for _ in range(300)]
    rows, labels = [], []
    for i in range(700):
        w = [rnd.choice(plain) for _ in range(rnd.randint(20, 120))]
        y = rnd.random() < 0.3
        if y and target == "toxic":
            w.insert(rnd.randrange(len(w)), rnd.choice(["blorg", "snarf"]))
        elif y:
            w = [x.upper() + "!!" for x in w]
        rows.append((i, " ".join(w)))
        labels.append((i, int(y) if bad else int(not y)))
    labels += [(5, labels[5][1]), (None, 1), (9999, 1)]
    docs = frame(spark, rows)
    told = spark.createDataFrame(labels, f"doc_id long, {target} int")
    got = model.score(docs, told).join(told.where("doc_id < 700").dropDuplicates(["doc_id"]), "doc_id").where(held_out(F.col("doc_id"))).collect()
    right = sum(r.predicted == r[target] for r in got)
    assert len(got) > 100 and right >= 0.95 * len(got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


@pytest.mark.parametrize("model", [toxicity, quality])
def test_classifier_edges(spark, edges, nothing, model):
    target = "toxic" if model is toxicity else "quality"
    none = spark.createDataFrame([], f"doc_id long, {target} int")
    one = spark.createDataFrame([(1, 1), (2, None), (3, 7)], f"doc_id long, {target} int")
    for labels in (none, one):
        got = model.score(edges, labels).collect()
        assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
        assert model.score(nothing, labels).count() == 0


# search


def bm25(docs, k):
    n = len(docs)
    tfs = [Counter(words(t or "")) for _, t in docs]
    size = [sum(t.values()) for t in tfs]
    mean = sum(size) / n
    df = Counter(w for t in tfs for w in t)
    out = {}
    for q, text in docs:
        if q is None or q % 100:
            continue
        asked = Counter(words(text or ""))
        scores = []
        for (i, _), tf, length in zip(docs, tfs, size):
            s = sum(
                c * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf[w] * (search.K1 + 1) / (tf[w] + search.K1 * (1 - search.B + search.B * length / mean))
                for w, c in asked.items() if w in tf
            )
            if s > 0:
                scores.append((-s, i))
        out[q] = sorted(scores)[:k]
    return out


def test_search_is_exact(spark, monkeypatch):
    rnd = random.Random(8)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 4))) for _ in range(200)]
    docs = [(i, " ".join(plain[min(199, int(rnd.expovariate(0.03)))] for _ in range(rnd.choice([0, 3, 40, 200])))) for i in range(900)]
    docs += [(2000 + i, docs[100][1]) for i in range(30)] + [(3000, None), (3100, "zzz unknown words")]
    want = bm25(docs, 10)
    table = frame(spark, docs).repartition(3)
    got = defaultdict(list)
    for r in search.top_k(table, table.where("doc_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((-r.score, r.doc_id))
    assert {q for q, s in want.items() if s} == set(got)
    for q, found in got.items():
        assert [i for _, i in found] == [i for _, i in want[q]]
        assert [s for s, _ in found] == pytest.approx([s for s, _ in want[q]])


def postings(rnd, n, terms):
    """A shard of ``n`` documents over few frequent and many rare terms, some documents repeated."""
    docs = [Counter(int(min(terms - 1, rnd.expovariate(0.02))) for _ in range(rnd.choice([1, 30, 150]))) for _ in range(n - 40)]
    docs += docs[:40]
    found = sorted({t for d in docs for t in d})
    held = [[(i, d[t]) for i, d in enumerate(docs) if t in d] for t in found]
    ids = rnd.sample(range(10 * n), n)
    flat = np.array([x for h in held for x in h], "<u4")
    return docs, search.Shard(ids, [sum(d.values()) for d in docs], found, [len(h) for h in held], flat[:, 0].tobytes(), flat[:, 1].tobytes(), 50.0)


def test_shard_multiplies_frequent_terms_for_many_queries_and_stays_exact():
    rnd = random.Random(5)
    docs, shard = postings(rnd, 700, 400)
    assert 0 < len(shard.rows) < len(shard.terms)
    asked = [sorted(d) for d in docs[::23]] + [[int(shard.terms[-1]), 10**6]]
    place = [np.array([np.searchsorted(shard.terms, t) if t in shard.terms else -1 for t in q]) for q in asked]
    weight = [np.array([rnd.random() + 0.1 for _ in q]) for q in asked]
    cuts = np.concatenate([[0], np.cumsum([len(q) for q in asked])])
    known = shard.frequent(np.concatenate(place), np.concatenate(weight), cuts)
    for p, w, of in zip(place, weight, known):
        want = np.zeros(shard.n)
        for t, x in zip(p, w):
            if t >= 0:
                own = slice(shard.start[t], shard.start[t + 1])
                want[shard.docs[own]] += shard.part[own] * x
        best = np.lexsort((shard.doc_ids, -want))[:10]
        best = best[want[best] > 0]
        for floor in (0.0, want[best[len(best) // 2]]):
            hold = best[want[best] >= floor]
            for rows, scores in (shard.search(p, w, 10, floor, of), shard.search(p, w, 10, floor)):
                assert rows.tolist() == hold.tolist() and scores.tolist() == want[hold].tolist()


def test_search_edges(edges, nothing):
    got = search.top_k(edges, edges.where("doc_id = 1")).collect()
    assert [(r.query_id, r.rank, r.doc_id) for r in got][:2] == [(1, 1, 1), (1, 2, 1)]
    assert search.top_k(nothing, nothing).count() == 0 and search.top_k(edges, nothing).count() == 0


def test_quality_score_is_the_calibrated_difference(spark):
    import zstandard

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(200).union(spark.createDataFrame([(10**9, None)], "doc_id long, text string").select(
        *[F.col(c) if c in ("doc_id", "text") else F.lit(None).alias(c) for c in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").columns]))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    docs = docs.checkpoint()
    bad, good, (intercept, slope) = quality.fit(docs, labels)
    size = lambda raw, d: len(zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=False, write_checksum=False, write_dict_id=False).compress(raw))
    for r in quality.score(docs, labels).collect():
        raw = (r.text or "").encode()
        parts = [raw[i : i + quality.BLOCK] for i in range(0, len(raw), quality.BLOCK)]
        d = sum(size(p, bad) - size(p, good) for p in parts) / (len(raw) + len(parts)) if parts else 0.0
        assert abs(r.score - 1 / (1 + math.exp(-(intercept + slope * d)))) < 1e-9
