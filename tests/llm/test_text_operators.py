import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from atlasweave.llm import ppm, tokens
from atlasweave.llm.classifier import Classifier, features, ftrl, train, with_scores
from atlasweave.llm.decontaminate import Decontamination, align, with_leaks
from atlasweave.llm.licenses import BASE_PHRASES, Finder, Scan, with_licenses
from atlasweave.llm.lm import Scoring, held_out_rows, score_documents
from atlasweave.llm.urls import filter_urls, url_keys

from . import cases


def test_tokens_agree_with_plain_python():
    import pyarrow as pa

    texts = [r[1] for r in cases.documents()] + ["Ärger im  HAUS\x0bende", "x" * 3_000_000]
    raw, offsets = tokens.text_buffer(pa.array(texts))
    seen = {}
    for lo, hi in tokens.blocks(offsets):
        w = tokens.words(raw, offsets, lo, hi)
        hashes, sets = w.hashes(), tokens.shingle_sets(w, 5)
        for i in range(hi - lo):
            own = [bytes(w.data[a:b]).decode() for a, b in zip(w.start[w.first[i] : w.first[i + 1]], w.end[w.first[i] : w.first[i + 1]], strict=True)]
            assert own == cases.words(cases.lower(texts[lo + i]))
            for word, h in zip(own, hashes[w.first[i] : w.first[i + 1]], strict=True):
                assert seen.setdefault(word, h) == h
            n = len({tuple(own[j : j + 5]) for j in range(len(own) - 4)}) if len(own) >= 5 else int(bool(own))
            assert sets[1][i + 1] - sets[1][i] == n
    assert len(set(seen.values())) == len(seen)


def test_index():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000, dtype=np.uint64))
    index = tokens.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()
    assert (tokens.Index(keys[:0]).find(keys) == -1).all()


def test_classifier_learns_and_keeps_held_out_apart(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        good = i % 3 > 0
        text = cases.prose(rng, 60) if good else " ".join(["BUY!!"] * 30 + [cases.prose(rng, 5)])
        rows.append((i, text, "a", "", "", "", 0))
    rows += [(1000, None, "a", "", "", "", 0), (1001, "", "a", "", "", "", 0), (None, "some words", "a", "", "", "", 0)]
    docs = cases.frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(400)] + [(3, None), (None, 1)], "doc_id long, quality int")
    weights = train(docs, labels, F.col("doc_id") % 4 != 2)
    got = {r.doc_id: r._score for r in with_scores(docs.withColumn("_score", F.lit("x")), weights).collect()}
    held = [i for i in range(400) if i % 4 == 2]
    assert np.mean([(got[i] >= 0.5) == (i % 3 > 0) for i in held]) > 0.95
    assert got[1000] == got[1001] and 0 <= got[1000] <= 1
    nothing = train(docs, labels.where("false"), F.lit(True))
    assert not nothing.any()
    assert with_scores(cases.frame(spark, []), weights).count() == 0
    with pytest.raises(ValueError):
        Classifier(bits=99)


def test_ftrl_is_the_plain_one():
    """Coordinate by coordinate, as the paper states it."""
    rng = random.Random(6)
    p = Classifier(bits=8, epochs=2)
    rows = []
    for _ in range(60):
        at = sorted(rng.sample(range(256), rng.randrange(1, 12)))
        rows.append((np.array(at, dtype=np.int32), np.array([rng.random() for _ in at], dtype=np.float32)))
    labels = np.array([float(rng.random() < 0.5) for _ in rows])
    z, n = [0.0] * 257, [0.0] * 257

    def weight(i):
        return 0.0 if abs(z[i]) <= p.l1 else -(z[i] - math.copysign(p.l1, z[i])) / ((p.beta + math.sqrt(n[i])) / p.alpha + p.l2)

    order = np.random.default_rng(5)
    for _ in range(p.epochs):
        for k in order.permutation(len(rows)):
            x = {**dict(zip(rows[k][0].tolist(), rows[k][1].tolist(), strict=True)), 256: 1.0}
            w = {i: weight(i) for i in x}
            error = 1 / (1 + math.exp(-sum(w[i] * v for i, v in x.items()))) - labels[k]
            for i, v in x.items():
                g = error * v
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / p.alpha * w[i]
                n[i] += g * g
    assert ftrl(rows, labels, p).tolist() == pytest.approx([weight(i) for i in range(257)], rel=1e-4, abs=1e-6)


def test_features_are_counts_of_ngrams():
    import pyarrow as pa

    texts = ["a b a b a", "", "a b", None, "x " * 200_000]
    raw, offsets = tokens.text_buffer(pa.array(texts))
    at, value, bounds = features(raw, offsets, 0, len(texts), 18, False)
    sizes = np.diff(bounds).tolist()
    assert sizes == [4, 0, 3, 0, 2]  # words and pairs: a, b, ab, ba; a, b, ab; x, xx
    want = np.log1p([3, 2, 2, 2])  # a, b, ab, ba
    assert sorted(value[:4].tolist()) == pytest.approx(sorted((want / np.linalg.norm(want)).tolist()), rel=1e-5)
    assert set(at[bounds[2] : bounds[3]]) <= set(at[:4])


def test_scores_of_repeated_rows_are_equal(spark):
    rows = [(i % 5, cases.prose(random.Random(i % 5), 30), "a", "", "", "", 0) for i in range(30)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(5)] * 2, "doc_id long, quality int")
    weights = train(cases.frame(spark, rows), labels, F.lit(True))
    got = {(r.doc_id, r._score) for r in with_scores(cases.frame(spark, rows), weights).collect()}
    assert len(got) == 5


def smith_waterman(a, b, p):
    best, h = 0.0, [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (1 if a[i - 1] == b[j - 1] else p.mismatch), h[i - 1][j] + p.gap, h[i][j - 1] + p.gap)
            best = max(best, h[i][j])
    return best


def test_alignment_is_smith_waterman():
    rng, p = random.Random(3), Decontamination()
    a = [[rng.randrange(2, 8) for _ in range(rng.randrange(3, 12))] for _ in range(60)]
    b = [[rng.randrange(2, 8) for _ in range(rng.randrange(3, 20))] for _ in range(60)]
    pad = lambda rows, fill: np.array([r + [fill] * (20 - len(r)) for r in rows], dtype=np.uint64)
    assert align(pad(a, 0), pad(b, 1), p).tolist() == pytest.approx([smith_waterman(x, y, p) for x, y in zip(a, b, strict=True)])


def test_leaks(spark):
    rng = random.Random(4)
    items = [(k, cases.prose(rng, 30, 5000)) for k in range(20)] + [(50, "tiny item"), (51, None), (None, "x y z"), (52, " .. ")]
    edited = items[3][1].split()
    for at in range(2, 30, 7):
        edited[at] = "changed"
    rows = cases.documents() + [(800, "before " * 9 + items[2][1].upper() + "." + " after" * 9, "a", "", "", "", 0), (801, cases.prose(rng, 200) + " " + " ".join(edited), "a", "", "", "", 0), (802, "a tiny item here", "a", "", "", "", 0)]
    docs = cases.frame(spark, rows).withColumn("_leak", F.lit(1))
    got = {r.doc_id: r._leak for r in with_leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {k for k, v in got.items() if v.contaminated} == {800, 801, 802}
    assert (got[800].item_id, got[801].item_id, got[802].item_id) == (2, 3, 50) and got[800].score == 1
    small = with_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), params=Decontamination(block_bytes=800))
    assert {r.doc_id: (r._leak.contaminated, r._leak.item_id) for r in small.collect()} == {k: (v.contaminated, v.item_id) for k, v in got.items()}
    assert with_leaks(docs, spark.createDataFrame([], "item_id long, text string")).where("_leak.contaminated").count() == 0
    assert with_leaks(cases.frame(spark, []), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def plain_leaks(text, items, p):
    """Best item and score, and how many items reach the threshold: all seeds, all passages, one word at a time."""
    form = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    words, found = form.findall(cases.lower(text)), []
    for k, item in items:
        w = form.findall(cases.lower(item))
        if k is None or not w:
            continue
        n = p.seed_words if len(w) >= p.seed_words else 1
        margin = 4 + len(w) // 4
        offsets = range(len(w) - n + 1) if n > 1 else [0]
        at = sorted((i - o, o) for i in range(len(words) - n + 1) for o in offsets if words[i : i + n] == w[o : o + n])
        runs = []
        for d, o in at:
            if runs and d - runs[-1][-1][0] <= margin:
                runs[-1].append((d, o))
            else:
                runs.append([(d, o)])
        need = min(p.hits, max(1, len(w) - p.seed_words + 1))
        scores = [smith_waterman(w, words[max(0, r[0][0] - margin) : r[-1][0] + len(w) + margin], p) / len(w) for r in runs if len({o for _, o in r}) >= need]
        if scores and max(scores) > 0:
            found.append((min(1.0, max(scores)), k))
    best = min(found, key=lambda f: (-f[0], f[1]), default=(0.0, None))
    many = sum(s >= p.threshold for s, _ in found)
    return many > 0, best[1] if best[0] >= p.threshold else None, round(best[0], 5), many


@pytest.mark.parametrize("p", [Decontamination(), Decontamination(block_bytes=400)])
def test_leaks_are_the_plain_ones(spark, p):
    rng = random.Random(21)
    items = [(k, cases.prose(rng, rng.randrange(1, 24), 60)) for k in range(25)] + [(30, None), (None, "w1 w2 w3"), (31, "...")]
    rows = []
    for i in range(120):
        words = cases.prose(rng, rng.randrange(0, 60), 60).split()
        if i % 2 and items[i % 25][1]:
            copy = [w if rng.random() > 0.15 else f"e{rng.randrange(9)}" for w in items[i % 25][1].split() if rng.random() > 0.1]
            at = rng.randrange(len(words) + 1)
            words[at:at] = copy
        rows.append((i, " ".join(words), "a", "", "", "", 0))
    rows += [(200, None, "a", "", "", "", 0), (201, rows[1][1], "a", "", "", "", 0), (202, "", "a", "", "", "", 0)]
    docs = cases.frame(spark, rows)
    got = {r.doc_id: (r.leak.contaminated, r.leak.item_id, round(r.leak.score, 5), r.leak.n_items) for r in with_leaks(docs, spark.createDataFrame(items, "item_id long, text string"), params=p, out="leak").collect()}
    assert got == {r[0]: plain_leaks(r[1], items, p) for r in rows}
    assert sum(v[0] for v in got.values()) > 20


def test_common_leak_keeps_its_seeds(spark):
    rng = random.Random(6)
    item = cases.prose(rng, 25, 9000)
    rows = [(i, cases.prose(rng, 40, 9000) + " " + item, "a", "", "", "", 0) for i in range(150)] + [(1000 + i, cases.prose(rng, 60, 9000), "a", "", "", "", 0) for i in range(50)]
    got = with_leaks(cases.frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(r.doc_id for r in got.where("_leak.contaminated").collect()) == list(range(150))


def test_edited_leak_is_found_in_any_number_of_copies(spark):
    rng = random.Random(12)
    item = cases.prose(rng, 32, 9000)
    edited = " ".join("changed" if k % 4 == 3 else word for k, word in enumerate(item.split()))
    rows = [(i, cases.prose(rng, 40, 9000) + " " + edited, "a", "", "", "", 0) for i in range(40)] + [(1000, cases.prose(rng, 60, 9000), "a", "", "", "", 0)]
    got = with_leaks(cases.frame(spark, rows), spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(r.doc_id for r in got.where("_leak.contaminated").collect()) == list(range(40))


def test_model_is_the_trie():
    rng = random.Random(3)
    docs = [bytes(rng.choice(b"abca ") for _ in range(rng.randint(0, 60))) for _ in range(40)]
    trie = ppm.Trie(3)
    for d in docs:
        trie.train(d)

    def packed(texts):
        return np.frombuffer(b"".join(texts), np.uint8), np.append(0, np.cumsum([len(t) for t in texts]))

    keys, counts = np.unique(ppm.grams(*packed(docs), 3)[0], return_counts=True)
    model = ppm.Model(keys, counts, 3)
    tests = [*docs[:10], b"", b"zzab", b"abzza", bytes(range(97, 123)) * 3]
    got, bounds = ppm.grams(*packed(tests), 3)
    assert np.add.reduceat(model.logs(got), bounds[:-1]).tolist() == pytest.approx([trie.cost(t, False) for t in tests], rel=1e-5)
    for past in (b"abc", b"zzz", b"a a"):
        assert sum(10 ** trie.symbol(past, s) for s in range(256)) == pytest.approx(1)
    fresh = ppm.Trie(3)
    assert fresh.cost(b"abab" * 20, True) > 20 * fresh.cost(b"q", False)  # it learns while it scores
    nothing = ppm.Model(keys[:0], counts[:0], 3)
    assert nothing.logs(got[:3]).tolist() == pytest.approx([-math.log10(256)] * 3)


@pytest.mark.parametrize("params", [Scoring(order=3), Scoring(order=3, hot_words=0, flush=500, nodes=200)])
def test_scores(spark, params):
    rows = cases.documents()
    got = score_documents(cases.frame(spark, rows), held_out_rows("doc_id"), params=params).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    counts = Counter()
    for r in rows:
        if not held(r[0]):
            counts.update([*cases.words(cases.lower(r[1])), None])
    n, v = sum(counts.values()), len(counts)
    want = []
    for r in rows:
        own = [*cases.words(cases.lower(r[1])), None]
        want.append((str(r[0]), held(r[0]), len(own), sum(counts[w] > 0 for w in own), n, round(sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in own), 6)))
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == sorted(want)
    assert all(r.score < 0 for r in got)


@pytest.mark.parametrize("nodes", [1, 200, 4_000_000])
def test_scores_are_the_tries_at_every_size(spark, nodes):
    rows = [r for r in cases.documents() if len(r[1] or "") < 3000] + [(i, t, "a", "", "", "", 0) for i, t in ((200, "zzz w1 w2"), (201, "".join(map(chr, range(32, 127)))))]
    held = F.col("doc_id").isNotNull() & (F.col("doc_id") % 3 == 2)
    trie = ppm.Trie(5)
    for r in rows:
        if r[0] is None or r[0] % 3 != 2:
            trie.train(cases.lower(r[1]).encode())
    got = score_documents(cases.frame(spark, rows), held, params=Scoring(nodes=nodes)).collect()
    want = [(str(r[0]), trie.cost(cases.lower(r[1]).encode(), False)) for r in rows]
    have = sorted((str(r.doc_id), r.score) for r in got)
    assert [k for k, _ in have] == [k for k, _ in sorted(want)]
    assert [v for _, v in have] == pytest.approx([v for _, v in sorted(want)], rel=1e-6)


def test_scores_without_training_rows(spark):
    got = score_documents(cases.frame(spark, cases.documents()[:5]), F.lit(True)).collect()
    assert len(got) == 5 and all(r.n_known == 0 and r.train_tokens == 0 for r in got)
    assert score_documents(cases.frame(spark, []), F.lit(False)).count() == 0


def test_licenses(spark):
    rows = cases.documents() + [(700, "Foo. All Rights, Reserved; CC-BY cc by cc by", "a", "", "", "", 0), (701, "x " * 40 + "Licensed under the Apach License, Version 2.0!", "a", "", "", "", 0), (702, "released\nunder the mit licence", "a", "", "", "", 0), (703, "occ by", "a", "", "", "", 0)]
    got = {r.doc_id: r._license for r in with_licenses(cases.frame(spark, rows).withColumn("_license", F.lit(0))).collect()}
    form = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for r in rows:
        if r[0] in (None, 11):
            continue
        w, m = form.findall(cases.lower(r[1])), got[r[0]]
        places = sorted((i, label) for phrase, label in BASE_PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split())
        assert m.n_words == len(w) and sorted((b.first_word, b.label) for b in m.base) == places
    assert [m.label for m in got[701].matches] == ["apache-2.0"] and got[701].matches[0].first_word == 40 and got[701].matches[0].edits == 1 and got[701].score < 1
    assert [m.label for m in got[702].matches] == ["mit"]
    assert not got[703].base and got[703].score == 0
    assert with_licenses(cases.frame(spark, [])).count() == 0


def test_bounded_errors_find_what_a_scan_of_all_windows_finds():
    rng, scan = random.Random(9), Scan(notices=(("released under the mit license", "mit"),))
    finder, notice, k = Finder(scan), " released under the mit license ", 2

    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    for _ in range(60):
        text = list("released under the mit license")
        for _ in range(rng.randrange(0, 5)):
            at = rng.randrange(len(text))
            text[at] = rng.choice(["", "q", text[at] + "z"])
        text = f" before {''.join(text)} after "
        near = any(distance(notice, text[i : i + n]) <= k for i in range(len(text)) for n in range(len(notice) - k, len(notice) + k + 1))
        assert bool(finder.find(text)[1]) == near


def test_every_place_of_a_repeated_notice_counts():
    finder = Finder(Scan(notices=(("licensed under the mit license", "mit"),)))
    exact, worse = "licensed under the mit license", "licensed undr the mit license"
    for parts in ([worse, exact], [exact, worse], [worse, exact, worse], [exact, exact], [worse, "by", exact, "or", worse]):
        text, at, want = " ", 0, []
        for part in parts:
            if len(part) > 2:
                want.append((len(text) - 1, int(part == worse)))
            text += part + " "
        assert [(a, edits) for _, a, _, edits in finder.find(text)[1]] == want


def test_mixed_notices_keep_their_places_and_edits():
    rng, scan = random.Random(31), Scan()
    finder = Finder(scan)
    for _ in range(40):
        text, want = " ", []
        for _ in range(rng.randrange(1, 12)):
            kind = rng.randrange(len(scan.notices))
            notice, edits = list(scan.notices[kind][0]), 0
            if rng.random() < 0.6:
                places = [i for i, c in enumerate(notice[:8]) if c != " " and i]  # not where notices differ from one another
                notice[rng.choice(places)] = "q"
                edits = 1
            want.append((scan.notices[kind][1], len(text) - 1, edits))
            text += "".join(notice) + " " + rng.choice(["", "and also ", "some other words in between "])
        got = [(scan.notices[k][1], a, e) for k, a, _, e in finder.find(text)[1]]
        assert got == want


def test_long_text_full_of_notices_and_its_spans(spark):
    notice = "licensed undr the mit license "
    text = notice * 20_000
    got = with_licenses(cases.frame(spark, [(1, text, "a", "", "", "", 0)])).first()._license
    assert len(got.matches) == 20_000 and got.n_words == 100_000
    assert all((m.first_word, m.last_word, m.edits) == (5 * i, 5 * i + 4, 1) for i, m in enumerate(got.matches))
    with pytest.raises(ValueError):
        Scan(letters_per_edit=2)


def test_url_keys(spark):
    def keys(url, depths=None):
        return spark.range(1).select(url_keys(F.lit(url).cast("string"), depths).alias("k")).first().k

    assert keys("http://10.0.0.1:80/a") == ["10.0.0.1", "10.0.0.1/a"] and keys("http://[::1]:8/") == ["[::1]"]
    assert keys("https://u@A.example.com./x//y/z?q#f") == ["a.example.com", "example.com", "a.example.com/x", "a.example.com/x/y", "a.example.com/x/y/z"]
    assert keys("http://localhost/x/y/z", [2, 9]) == ["localhost", "localhost/x/y"]
    assert keys(None) == keys("") == keys("mailto:x") == []


def test_deep_paths_long_urls_and_clashing_columns(spark):
    long = "http://long.example.com/" + "s/" * 50_000 + "?" + "q" * 100_000
    captures = spark.createDataFrame([(1, "http://b.example.com/A/b/c/d/e", 7, 8, 9, 10), (2, long, 7, 8, 9, 10), (3, "http://b.example.com/a/b/c", 7, 8, 9, 10)], "id long, url string, n int, best int, uid int, hit int").withColumn("fetched", F.to_timestamp(F.lit("2024-03-01 00:00:00")))
    lists = spark.createDataFrame([("l", "B.example.com/A/b/c/", "add", "x", "2024-01-01"), ("l", "long.example.com/" + "/".join(["s"] * 40_000), "add", "y", "2024-01-01")], "list string, key string, action string, category string, dated string").withColumn("dated", F.to_date("dated"))
    got = filter_urls(captures, lists)
    assert got.columns == [*captures.columns, "_url"]
    assert {r.id: (r._url.blocked, r._url.category, r.n, r.best) for r in got.collect()} == {1: (True, "x", 7, 8), 2: (True, "y", 7, 8), 3: (False, None, 7, 8)}


def test_urls(spark):
    captures = [(1, "http://a.b.Example.com/x/y?z", "2024-03-01 10:00:00"), (2, "http://a.b.example.com/x/y", "2024-05-01 00:00:00"), (3, None, "2024-05-01 00:00:00"), (4, "http://example.com", None), (5, "http://example.com/q", "2024-07-01 00:00:00"), (5, "http://example.com/q", "2024-07-01 00:00:00"), (6, "no url", "2024-07-01 00:00:00")]
    entries = [("l", "example.com", "add", "spam", "2024-02-01"), ("l", "example.com", "remove", None, "2024-04-01"), ("l", "example.com", "add", "adult", "2024-06-01"), ("l", "example.com", "add", "adult", "2024-06-01"), ("m", "a.b.example.com/x", "add", "bad", "2024-01-01"), ("m", None, "add", "bad", "2024-01-01"), ("m", "b.example.com", "add", "bad", None), ("n", "example.com", "add", "x", "2024-02-01"), ("n", "example.com", "remove", "x", "2024-02-01")]
    made = spark.createDataFrame(captures, "id long, url string, fetched string").withColumn("fetched", F.to_timestamp("fetched")).withColumn("key", F.lit("clash"))
    lists = spark.createDataFrame(entries, "list string, key string, action string, category string, dated string").withColumn("dated", F.to_date("dated"))
    got = [(r.id, r._url.blocked, r._url.n_active, r._url.key, r._url.category) for r in filter_urls(made, lists).collect()]
    assert sorted(got) == [(1, True, 2, "a.b.example.com/x", "bad"), (2, True, 1, "a.b.example.com/x", "bad"), (3, False, 0, None, None), (4, False, 0, None, None), (5, True, 1, "example.com", "adult"), (5, True, 1, "example.com", "adult"), (6, False, 0, None, None)]
    assert filter_urls(made.where("false"), lists).count() == 0
    assert filter_urls(made, lists.where("false")).where("_url.blocked").count() == 0
