"""Vector codes, MinHash, importance resampling and the near stage against brute force."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from redactory.llm import importance, minhash, set_links, vector_codes
from redactory.llm.simhash import similar_documents

RNG = random.Random(31)
WORDS = ["".join(RNG.choice("abcdehilnorst") for _ in range(RNG.randint(2, 8))) for _ in range(400)]


def lower(t):
    return (t or "").translate({c: c + 32 for c in range(65, 91)})


def components(ids, links):
    up = {i: i for i in ids}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def plain_codes(rows, parts, entries, rounds):
    """rows: (id, ints, label), whole ones only."""
    w = len(rows[0][1]) // parts
    cut = [[tuple(v[p * w : p * w + w]) for _, v, _ in rows] for p in range(parts)]
    first = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:entries]
    books = [[c[k] for k in first] for c in cut]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            of = {}
            for x in cut[p]:
                of.setdefault(near(x, books[p])[1], []).append(x)
            for j, xs in of.items():
                books[p][j] = tuple(sum(c) // len(xs) for c in zip(*xs))
    told = [[near(cut[p][k], books[p]) for p in range(parts)] for k in range(len(rows))]
    return [("".join(f"{j:02x}" for _, j in t), sum(d for d, _ in t)) for t in told], hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()


def test_vector_codes(spark):
    rng = random.Random(7)
    few = [[rng.uniform(-1, 1) for _ in range(4)] for _ in range(9)]
    vec = lambda: sum((rng.choice(few) if rng.random() < 0.6 else [rng.uniform(-2, 2) for _ in range(4)] for _ in range(4)), [])
    hot = vec()
    rows = [(i * 3 % 101, vec(), rng.choice((None, 1, 2))) for i in range(101)] + [(1000 + i, hot, 5) for i in range(60)] + [(7, vec(), 1), (7, vec(), None), (None, vec(), None), (None, hot, 2)] + [(5, hot, 5)] * 2
    bad = [(1, None, 1), (2, [None] * 16, 1), (3, [float("nan")] + [0.0] * 15, 1), (4, [float("inf")] * 16, None), (5, [-float("inf")] + [0.5] * 15, 1), (6, [1.0] * 4, 1), (-1, [], 1)]
    docs = spark.createDataFrame([(*r, "clash", 1, 2.0) for r in rng.sample(rows + bad, len(rows + bad))], "vec_id long, embedding array<float>, label int, code string, part int, row double").repartition(5)
    ints = [(i, [math.floor(1024 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows]
    for entries in (16, 256):
        want, digest = plain_codes(ints, 4, entries, 4)
        sums = {}
        for (_, _, lab), (_, e) in zip(ints, want):
            sums[lab] = sums.get(lab, 0) + e
        out, books = vector_codes.vector_codes(docs, entries=entries)
        assert vector_codes.books_digest(books) == digest
        assert sorted((r["id"] or -9, r["code"], r["error"], r["label_error"]) for r in out.collect()) == sorted((i or -9, c, e, sums[lab]) for (i, _, lab), (c, e) in zip(ints, want))
    assert vector_codes.books_table(spark, books).count() == 4 * books.shape[1]


def test_vector_codes_cases(spark):
    kind = "vec_id long, embedding array<float>, label int"
    out, books = vector_codes.vector_codes(spark.createDataFrame([], kind))
    assert out.count() == 0 and vector_codes.books_digest(books) == hashlib.sha256(b"").hexdigest()
    assert vector_codes.vector_codes(spark.createDataFrame([(1, None, None)], kind))[0].count() == 0
    with pytest.raises(ValueError):
        vector_codes.vector_codes(spark.createDataFrame([(1, [1.0] * 6, 1)], kind))
    big = np.array([[2**40, 0]], np.int64)
    with pytest.raises(OverflowError):
        vector_codes.nearest(big, big)
    exact = np.array([[2**27 + 1, 3], [2**27, 3]], np.int64)  # beyond doubles, within integers
    at, far = vector_codes.nearest(exact, exact)
    assert at.tolist() == [0, 1] and far.tolist() == [0, 0]


def near_corpus(rng, many):
    """Texts of one template and others, with copies on both sides of the threshold."""
    talk = lambda n: [rng.choice(WORDS) for _ in range(n)]
    template, texts = talk(120), []
    for k in range(many):
        base = template[:] if k % 2 else talk(rng.randint(20, 200))
        for _ in range(4):
            base[rng.randrange(len(base))] = f"own{rng.randrange(10**6)}"
        texts.append(base)
        for _ in range(k % 4):
            texts.append([w if rng.random() > rng.choice((0.003, 0.01, 0.03, 0.08)) else f"new{rng.randrange(99)}" for w in base] + talk(rng.choice((0, 0, 5, 30))))
    return [" ".join(t).upper() if rng.random() < 0.2 else " ".join(t) for t in texts]


def plain_sets(texts, n):
    out = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", lower(t))
        out.append({tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set())
    return out


def test_minhash(spark):
    rng = random.Random(12)
    texts = near_corpus(rng, 120) + ["one two", "ONE\ttwo", "one", "", None, " \n ", "a b c d e f g", "a b c d e f g h", "ß é \x00 x", "ß é \x00 x y " * 3000]
    ids = rng.sample(range(1000), len(texts))
    sets = plain_sets(texts, 3)
    links = [(ids[a], ids[b]) for a in range(len(texts)) for b in range(a) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    want = components(ids, links)
    rows = [(i, t, "clash", 1, 2) for i, t in zip(ids, texts)]
    got = {r["id"]: (r["n_shingles"], r["component"], r["kept"]) for r in minhash.minhash_documents(spark.createDataFrame(rows, "doc_id long, text string, key string, n int, row int").repartition(3)).collect()}
    assert len(links) > 40 and got == {i: (len(s), want[i], want[i] == i) for i, s in zip(ids, sets)}


def test_minhash_cases(spark):
    kind = "doc_id long, text string"
    assert minhash.minhash_documents(spark.createDataFrame([], kind)).count() == 0
    same = "a b c d e f g h i j k l m n o p q r s t u v w x"
    rows = [(5, same), (5, same), (9, same + " y"), (None, same), (None, "alone in the world today"), (None, None), (3, ""), (None, "x y z 1 2"), (4, "X y z 1 2")]
    got = sorted((r["id"] or 0, r["n_shingles"], r["component"] or 0, r["kept"]) for r in minhash.minhash_documents(spark.createDataFrame(rows, kind)).collect())
    assert got == sorted([(5, 22, 5, True)] * 2 + [(9, 23, 5, False), (0, 22, 5, False), (0, 3, 0, True), (0, 0, 0, True), (3, 0, 3, True), (0, 3, 4, False), (4, 3, 4, True)])


def test_densification_agrees():
    """The share of equal bins tells the index, for sets far smaller than the bins too."""
    rng, orders = np.random.default_rng(2), minhash.bin_orders(120)
    assert all(sorted(o) == list(range(120)) and o[0] == k for k, o in enumerate(orders.tolist()))
    for n, common in ((20, 17), (400, 340)):
        got = []
        for _ in range(300):
            x = rng.integers(0, 2**64, 2 * n - common, dtype=np.uint64)
            a, b = (minhash.signature(np.sort(s), orders) for s in (x[:n], x[n - common :]))
            got.append((a == b).mean())
        assert abs(np.mean(got) - common / (2 * n - common)) < 0.03


def test_near_pairs_bounds():
    """No pair that reaches the index fails a bound."""
    rng = np.random.default_rng(4)
    sets = []
    for _ in range(30):
        base = rng.integers(0, 2**64, rng.integers(5, 300), dtype=np.uint64)
        sets += [np.unique(base), np.unique(np.concatenate([base[: -max(1, len(base) // 12)], rng.integers(0, 2**64, 3, dtype=np.uint64)]))]
    bits = np.array([np.frombuffer(set_links.parity(s), "<u8") for s in sets])
    size, at = np.array([len(s) for s in sets]), np.arange(len(sets))
    got = {tuple(x) for a, b in set_links.near_pairs(at, at, size, np.zeros(len(sets), np.int64), bits, at, at, (4, 5)) for x in zip(a.tolist(), b.tolist())}
    want = {(a, b) for a in at.tolist() for b in range(a) if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert want and want <= got and len(got) < 3 * len(want)


@pytest.mark.parametrize("unit", [2048, 8])
def test_template_corpus_loses_no_twin(spark, unit, monkeypatch):
    """Documents of one template, each with a twin at 0.8 or more; mean index of the others 0.6."""
    monkeypatch.setattr(set_links, "UNIT", unit)
    rng = random.Random(77)
    template, rows, pairs = [rng.choice(WORDS) for _ in range(110)], [], 5000 if unit > 8 else 150
    for k in range(pairs):
        a = template[:]
        for at in rng.sample(range(110), 3):
            a[at] = f"own{rng.randrange(10**7)}"
        b = a[:]
        b[rng.randrange(110)] = f"new{rng.randrange(10**7)}"
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
    sets = plain_sets([t for _, t in rows], 5)
    index = lambda x, y: len(x & y) / len(x | y)
    twins = [k for k in range(pairs) if index(sets[2 * k], sets[2 * k + 1]) >= 0.8]
    others = [index(sets[i], sets[j]) for i, j in (rng.sample(range(2 * pairs), 2) for _ in range(300))]
    assert len(twins) > 0.95 * pairs and 0.5 < np.mean(others) < 0.75
    got = {r["id"]: r["component"] for r in similar_documents(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()}
    assert [k for k in twins if got[2 * k] != got[2 * k + 1]] == []


def plain_importance(rows, target, most, buckets, share, least):
    def features(t):
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t))
        return len(w), [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, most + 1) for i in range(len(w) - n + 1)]

    s, t = [0] * buckets, [0] * buckets
    for count, texts in ((s, [x for _, x in rows]), (t, target)):
        for x in texts:
            for f in features(x)[1]:
                count[f] += 1
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + buckets) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, x in rows:
        n, f = features(x)
        h = int(hashlib.sha256(f"2024:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[k] for k in f)
        out.append((i, n, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((x for x in out if x[1] >= least), key=lambda x: (-x[4], x[0] is None, x[0] or 0, x[3], x[2]))
    return out, [x[0] for x in able[: share * len(able) // 100]]


@pytest.mark.parametrize("most,chunk", [(1, 4096), (1, 7), (2, 50), (3, 4)])
def test_importance(spark, most, chunk):
    rng = random.Random(most)
    talk = lambda n: " ".join(rng.choice(WORDS).capitalize() + rng.choice(("", ",", "-x", "É")) for _ in range(n))
    texts = [talk(rng.randint(0, 120)) for _ in range(150)] + [talk(9000), "", None, "one two", "é1 Ａ b", "...", "x\x00y " * 30]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[3]), (None, talk(40)), (None, None)]
    target = [talk(30) for _ in range(9)] + [None, "", talk(3000)]
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, weight int, rank string").repartition(3)
    got = importance.importance(docs, spark.createDataFrame([(t,) for t in target], "text string"), most, 500, 20, chunk_words=chunk).collect()
    want, drawn = plain_importance(rows, target, most, 500, 20, 20)
    key = lambda x: (x[0] or -1, *x[1:])
    assert sorted(key((r["id"], r["n_words"], r["n_features"], r["weight"], r["score"])) for r in got) == sorted(map(key, want))
    ranks = sorted((r["rank"], r["id"]) for r in got if r["rank"])
    assert [k for k, _ in ranks] == list(range(1, len(drawn) + 1)) and [i for _, i in ranks] == drawn


def test_importance_cases(spark):
    kind = "doc_id long, text string"
    none = spark.createDataFrame([], kind)
    some = spark.createDataFrame([(i, "a b c d e f g h i j k l m n o p q r s t u" if i else None) for i in range(40)], kind)
    assert importance.importance(none, none).count() == 0
    got = importance.importance(some, none)
    assert got.filter("rank IS NOT NULL").count() == 3 and got.count() == 40
    drawn = importance.resampled(some, none)
    assert drawn.columns == ["doc_id", "text"] and drawn.count() == 3


def test_indexes_of_one_name(spark, tmp_path):
    from redactory.llm.exact_dedup import DigestIndex, digests

    texts = lambda *t: digests(spark.createDataFrame(list(enumerate(t)), "doc_id long, text string"))
    x, y = (DigestIndex(spark, str(tmp_path / d / "it's idx"), buckets=4) for d in "xy")
    assert x.add(texts("a", "b")).count() == 2 and y.rows().count() == 0
    assert y.add(texts("b", "c", "d")).count() == 3 and x.rows().count() == 2
    again = DigestIndex(spark, f"file:{tmp_path}/x/it's idx/")  # the same place, spelt otherwise
    assert again.table == x.table and again.add(texts("b", "e")).count() == 3 and y.rows().count() == 3


@pytest.mark.parametrize("how", [{"toward": 0.5}, {"toward": 0.9, "most_repeats": 50.0}, {"entropy": 0.7, "most_repeats": 1e9}, {"toward": 1.0, "most_repeats": 1.5}, {"entropy": 0.2, "most_repeats": 2.0}])
def test_temperature_against_another_solution(how):
    """The exponent by Newton's method on the entropy, or on the repeats where those are the limit."""
    from redactory.llm import mixing

    tokens = {"a": 100, "b": 500, "c": 3000, "d": 20000, "e": 21000}
    p = np.array(list(tokens.values()), float)
    at = lambda a: (p / p.max()) ** a / ((p / p.max()) ** a).sum()
    entropy = lambda a: -(at(a) * np.log(at(a))).sum() / np.log(len(p))
    repeats = lambda a: (lambda w: ((p / w).max() * w / p).max())(at(a))
    a, w, size, limit = mixing.tempering(tokens, **how)
    target = how.get("entropy", entropy(1.0) + how.get("toward", 0) * (1 - entropy(1.0)))
    most = how.get("most_repeats", 4.0)

    def solve(f, x):
        for _ in range(200):
            slope = (f(x + 1e-6) - f(x - 1e-6)) / 2e-6
            x = min(max(x - f(x) / slope, 0.0), 60.0)
        return x

    free = solve(lambda x: entropy(x) - target, 1.5 if target < entropy(1.0) else 0.5) if target < 1 else 0.0
    if repeats(free) > most:
        free = solve(lambda x: np.log(repeats(x) / most), 1.05 if free > 1 else 0.95)
        assert limit == "repeats" and abs(repeats(a) - most) < 1e-6
    else:
        assert limit == "entropy" and abs(entropy(a) - target) < 1e-9
    assert abs(a - free) < 1e-5 and np.allclose(list(w.values()), at(a)) and abs(size - (p / at(a)).max()) < 1e-6 * size
    assert a != 1 and max(abs(at(a) - at(1.0))) > 0.005  # the mix is not the natural one


def test_mixing_has_something_to_do(spark):
    from redactory.llm import mixing

    rows = [(i, "w " * 20, f"s{min(i % 20, 12)}") for i in range(1000)] + [(None, "same text", "s1")] * 300
    got = mixing.mixture(spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, source string, block string, weight double"), block_tokens=200).collect()
    assert len(got) > len(rows) and {r["id"] for r in got if r["id"] is not None} == set(range(1000))
    nulls = {r["block"] for r in got if r["id"] is None}
    assert len(nulls) > 1 and sum(r["id"] is None and r["pass"] == 0 for r in got) == 300 and {r["limit"] for r in got} == {"entropy"}
    assert mixing.tempering({"a": 7, "b": 7})[:2] == (1.0, {"a": 0.5, "b": 0.5}) and mixing.tempering({"a": 3})[1] == {"a": 1.0}


def test_words_among_many_spans():
    from redactory.llm import pii_crf

    base = [(0, 0, 3), (4, 3, 5), (4, 2, 6), (5, 1, 6), (5, 2, 7), (6, 3, 40), (50, 1, 60)]  # more than four before the one that holds the word
    nodes, label, *_ = pii_crf.graph("a@b 1234567890 and 12345 7777777 at 5555 55555", base)
    assert label[0] == 1 and label[1] > 0 and [b for n, b in zip(nodes, label) if n[0] > 40] == [0]
    rng = np.random.default_rng(1)
    model = {"chain": rng.normal(0, 3, (pii_crf.LABELS,) * 2), "skip": -4 * np.eye(pii_crf.LABELS)}
    edges = np.array([(i, j) for i in range(12) for j in range(i)])
    p = pii_crf.marginals(rng.normal(0, 2, (12, pii_crf.LABELS)), edges[:30], edges[30:], model)
    assert np.allclose(p.sum(1), 1) and np.isfinite(p).all()  # a frustrated graph comes to rest


def plain_repeats(rows, length=50):
    """(n_bytes, n_removed, n_spans, kept) of rows (id, text), in order of ids."""
    seen, out = {}, []
    for i, t in rows:
        b = (t or "").encode()
        for s in range(len(b) - length + 1):
            seen[b[s : s + length]] = min(i, seen.get(b[s : s + length], i))
    for i, t in rows:
        b = (t or "").encode()
        off = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] < i:
                off[s : s + length] = b"\1" * length
        out.append((i, len(b), sum(off), len(re.findall(b"\1+", bytes(off))), bytes(c for c, o in zip(b, off) if not o)))
    return sorted(out)


def test_suffix_family(spark, tmp_path):
    """Many batches, each against the levels before it; levels merge geometrically; the family is opened again."""
    from redactory.llm.suffix_dedup import SuffixIndex, remove_repeats

    rng = random.Random(41)
    talk = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    shared, rows = [talk(30) for _ in range(12)], []
    for i in range(160):
        rows.append((i, " ".join(rng.choice(shared) if rng.random() < 0.3 else talk(rng.randint(1, 25)) for _ in range(rng.randint(0, 6)))))
    rows += [(160, None), (161, "ab" * 300), (162, "ab" * 200), (162, "ab" * 250), (163, rows[5][1]), (164, rows[163 - 160][1] + "x"), (165, "z" * 700_000), (166, "z" * 49), (167, "y" + "z" * 60)]
    want = plain_repeats([r for r in rows if r[0] != 165 and r[0] < 166])
    long_ = plain_repeats([(165, "z" * 60), (166, "z" * 49), (167, "y" + "z" * 60)])  # a text beyond a segment, in short
    kind, got, sizes = "doc_id long, text string, unit string, codes int", [], []
    for lo in range(0, 168, 24):
        index = SuffixIndex(spark, str(tmp_path / "family"), unit_bytes=3000, bucket_bytes=1 << 12, buckets=2)  # opened anew each time
        part = [(*r, "clash", 1) for r in rows if lo <= r[0] < lo + 24]
        got += [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in index.add(spark.createDataFrame(rng.sample(part, len(part)), kind).repartition(2)).collect()]
        sizes.append([level.n_bytes for level in index.levels])
    got.sort()
    assert [g for g in got if g[0] < 165] == want and [g[2:4] for g in got if g[0] == 167] == [long_[2][2:4]] and [g[2] for g in got if g[0] in (165, 166)] == [0, 0]
    assert max(map(len, sizes)) <= 4 and sum(sizes[-1]) == sum(g[1] for g in got)
    assert all(a > 2 * b for s in sizes for a, b in zip(s, s[1:-1]))  # but for the newest, each is more than twice the next
    with pytest.raises(ValueError):
        index.add(spark.createDataFrame([(3, "late")], "doc_id long, text string"))
    assert index.add(spark.createDataFrame([(None, "a" * 60)], "doc_id long, text string")).first()["n_removed"] == 0
    df = spark.createDataFrame([r for r in rows if r[0] < 165] + [(None, rows[0][1])], "doc_id long, text string").repartition(5)
    for batches in (3,):
        again = [(r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in remove_repeats(df, batches=batches, unit_bytes=5000).collect() if r["id"] is not None]
        assert sorted(again) == want
