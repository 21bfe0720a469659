"""Small fixtures with nulls, empty and long texts, ties, repeats and clashing columns, against brute force."""

import hashlib
import random
import re

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from redactory.llm import bpe, hilbert, mixing, pii_crf, quality_model, warc
from redactory.llm.exact_dedup import DigestIndex, digests, exact_dedup
from redactory.llm.quality_rules import quality_rules
from redactory.llm.simhash import links, masks, near_duplicates, spanning
from redactory.llm.suffix_dedup import remove_repeats

RNG = random.Random(5)
WORDS = ["".join(RNG.choice("abcdehilnorst") for _ in range(RNG.randint(2, 8))) for _ in range(300)]
TALK = lambda n: " ".join(RNG.choice(WORDS) for _ in range(n))
SHARED = TALK(40)
TEXTS = [None, "", "  \n ", "one two", TALK(60), TALK(60) + " " + SHARED, SHARED + " " + TALK(30), SHARED, "É" + SHARED[:70] + "ß", "a" * 400, "a" * 300, TALK(3000), SHARED.upper(), SHARED, "x\x00" * 60, "mail me@a.bc or +1 (503) 555-6503 or 10.0.0.1 or 999.1.1.1 or 4111 1111 1111 1111"]
DOCS = [(i, t, "en", None if i % 5 == 0 else f"s{i % 2}", None, "clash", 1) for i, t in enumerate(TEXTS)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, digest string, kept int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA).repartition(3)


def text(t):
    return t or ""


text_of = text


def test_suffix_dedup(docs):
    seen, want = set(), {}
    for i, t, *_ in DOCS:
        b = text(t).encode()
        off = bytearray(len(b))
        for s in range(len(b) - 49):
            if b[s : s + 50] in seen:
                off[s : s + 50] = b"\1" * 50
        seen |= {b[s : s + 50] for s in range(len(b) - 49)}
        want[i] = (len(b), sum(off), len(re.findall(b"\1+", bytes(off))), bytes(c for c, o in zip(b, off) if not o))
    for unit in (100, 1 << 20):
        got = {r["id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in remove_repeats(docs, unit_bytes=unit).collect()}
        assert got == want


def test_suffix_dedup_nulls(spark):
    df = spark.createDataFrame([(None, SHARED), (None, SHARED), (1, SHARED), (1, SHARED), (2, SHARED)], "doc_id long, text string")
    assert sorted((r["id"] or 0, r["n_removed"] > 0) for r in remove_repeats(df).collect()) == [(0, False), (0, False), (1, False), (1, False), (2, True)]


def test_simhash(docs):
    got = {r["id"]: r for r in near_duplicates(docs).collect()}
    fp = {}
    for i, t, *_ in DOCS:
        w = re.findall(r"[^\x20\x09-\x0D]+", text(t).translate({c: c + 32 for c in range(65, 91)}))
        sh = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in sh]
        fp[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    assert {i: r["fp"] % 2**64 for i, r in got.items()} == fp
    assert got[13]["component"] == got[7]["component"] == 7 and got[0]["component"] == got[1]["component"] == 0


def test_simhash_bridges(spark, monkeypatch):
    """Fingerprints 0, 7 and 63 are 3 bits apart in turn; the middle one is held by a row without an id only."""
    import redactory.llm.simhash as s

    rows = [(1, 0), (None, 7), (2, 63), (3, 7 << 40), (3, 7 << 40), (None, 1 << 62 | 255 << 30), (4, -1)]
    monkeypatch.setattr(s, "fingerprints", lambda docs, *_: docs)
    got = s.near_duplicates(spark.createDataFrame(rows, "id long, fp long")).collect()
    assert sorted((r["id"] or 0, r["fp"], r["component"]) for r in got) == sorted((i or 0, f, {0: 1, 7: 1, 63: 1, 7 << 40: 1, -1: 4}.get(f)) for i, f in rows)


def test_simhash_components(spark):
    """Fingerprints around few centres against all pairs; a text beyond the block size; repeated rows."""
    import redactory.llm.simhash as s

    few = [" ".join(RNG.sample(WORDS, 60)) for _ in range(6)]
    texts = few + [t + " " + TALK(k) for t in few for k in (1, 2, 3)] + [TALK(40_000)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0]), (90, "")]
    fp = {i: s.fingerprint(t) for i, t in rows}
    up = {i: i for i in fp}
    for _ in fp:
        for a in fp:
            for b in fp:
                if (fp[a] ^ fp[b]).bit_count() <= 3:
                    up[a] = min(up[a], up[b])
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert len(got) == len(rows) and all(r["component"] == up[r["id"]] for r in got)


def test_components_alike_at_every_size(spark):
    from redactory.llm.simhash import components

    pairs = [(b, a) for a, b in (sorted(RNG.sample(range(300), 2)) for _ in range(260))]
    edges = spark.createDataFrame(pairs, "a long, b long")
    one, many = ({(r["node"], r["component"]) for r in components(edges, small=n).collect()} for n in (1000, 0))
    assert one == many and len(one) > 100


def test_covering_masks_and_large_buckets(spark):
    m = masks(3)
    for _ in range(2000):
        diff = sum(1 << b for b in RNG.sample(range(64), RNG.randint(1, 3)))
        assert any(diff & x == 0 for x in m)
    x = np.array(sorted({RNG.getrandbits(12) << 40 for _ in range(900)}), np.uint64)
    import redactory.llm.simhash as s

    small = spanning(x, np.arange(len(x)), 3, m[0])
    free = sum(1 << b for b in range(40, 52))
    try:
        s.PAIRWISE = 10
        probed = s.spanning(x, np.arange(len(x)), 3, (1 << 64) - 1 ^ free)
    finally:
        s.PAIRWISE = 6000

    def parts(pairs):
        up = list(range(len(x)))
        for _ in pairs:
            for a, b in pairs:
                up[a] = up[b] = min(up[a], up[b])
        return up

    assert parts(probed) == parts(small) and all((int(x[a]) ^ int(x[b])).bit_count() <= 3 for a, b in probed + small)  # each link is a pair in the radius
    rows = spark.createDataFrame([(int(v), i) for i, v in enumerate(x.tolist())], "fp long, node long")
    assert links(rows).count() > 0


def test_warc(spark):
    same, short = "<p>" + TALK(40), "tiny"
    rows = [(1, "http://a", same, 0), (2, None, None, 0), (3, "http://c\r\nx", same, 0), (4, "u", short, 0), (5, "u", short, 0), (6, "u", "é" * 90000, 0), (7, "u", "", 0), (9, "u", same, 0)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, digest int").repartition(2)
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.warc_round_trip(pages).collect()}
    body = {i: text(h).encode() for i, _, h, _ in rows}
    assert got == {i: (len(b), hashlib.sha256(b).hexdigest(), "revisit" if i in (3, 9) else "response", 1 if i in (3, 9) else None) for i, b in body.items()}
    records = [warc.record(i, "u", TALK(80).encode(), "0", None) for i in range(300)]
    packed = warc.pack(records)
    assert packed[:4] == warc.MAGIC and list(warc.unpack(packed)) == records


def test_warc_repeated_and_null_ids(spark, tmp_path):
    a, b = "<p>" + TALK(40), "<p>" + TALK(41)
    rows = [(5, None, a), (5, None, b), (1, None, a), (2, None, b), (None, "u", a), (None, "u", a), (None, "u", "<b>" + TALK(30)), (7, "u", a), (7, "u", a), (8, "u", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    records = warc.read_archives(spark.read.schema(warc.ARCHIVES).parquet(warc.write_archives(pages, str(tmp_path / "w")))).collect()
    digest = lambda t: hashlib.sha256(text(t).encode()).hexdigest()
    first = {a: 1, b: 2}
    want = sorted((i or 0, digest(h), first[h] if h in first and i != first[h] else 0) for i, _, h in rows)
    assert sorted((r["page_id"] or 0, r["payload_digest"], r["refers_to"] or 0) for r in records) == want
    assert {bytes(r["payload"]).decode() for r in records if r["record_type"] == "response"} == {text(h) for _, _, h in rows}
    folder = str(tmp_path)

    def save(name, content):
        with open(f"{folder}/{name}", "wb") as f:
            f.write(content)

    warc.export(spark.read.schema(warc.ARCHIVES).parquet(str(tmp_path / "w")), save)
    files = list(tmp_path.glob("*.warc.zst"))
    assert files and sum(len(list(warc.unpack(f.read_bytes()))) - 1 for f in files) == len(rows)


def test_pii(docs):
    got = {r["id"]: r for r in pii_crf.find_pii(docs, None).collect()}
    assert [(s["kind"]) for s in got[15]["base"]] == ["email", "phone", "ip", "card"]
    assert all(not r["base"] for i, r in got.items() if i != 15)
    for t in ("a@b.c@d.e", "1.2.3.4.5.6.7.8", "999.1.1.1 0001.2.3.4", "+1 23", "+12(345)6789-012x", "@a.b", "a@b", "1" * 3000 + ".1"):
        plain = [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        assert list(pii_crf.emails(t)) == plain
        assert [m.span() for m in pii_crf.IP.finditer(t)] == [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)]


def luhn_card(rng):
    body = [4] + [rng.randrange(10) for _ in range(14)]
    return "".join(map(str, body)) + next(c for c in "0123456789" if pii_crf.luhn("".join(map(str, body)) + c))


def test_pii_base_against_plain_patterns(spark):
    """Every kind by the stated patterns, digests as the query gives them."""
    rng = random.Random(4)
    parts = ["a.b@c.d", "x@y", "+1 (503) 555-6503", "10.0.0.1", "999.1.1.1", luhn_card(rng), "4111 1111 1111 1111", "4111-1111-1111-1112", "word", "+", "@", "1.2.3.4.5", "é", "+1", "\n", "00012.1.2.3", "12"]
    texts = ["".join(rng.choice(parts) + rng.choice(("", " ", ",", "-")) for _ in range(rng.randint(0, 14))) for _ in range(400)] + [None, "", "7" * 5000, ("a@b.c " * 3000)]
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fits(k, m):
        d = re.sub("[^0-9]", "", m)
        return k == "email" or k == "ip" and all(int(x) < 256 for x in m.split(".")) or k == "card" and 14 <= len(d) <= 19 and pii_crf.luhn(d) or k == "phone" and 10 <= len(d) <= 15

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    for r in pii_crf.find_pii(docs, None).collect():
        t = text(texts[r["id"]])
        want = sorted((m.start(), n, k, m.end()) for n, (k, p) in enumerate(kinds.items()) for m in re.finditer(p, t) if fits(k, m[0]))
        assert [(s["start"], s["kind"], s["end"]) for s in r["base"]] == [(a, k, e) for a, _, k, e in want] and r["base"] == r["spans"]


def test_pii_field_adds_what_patterns_lose(spark):
    """At the production threshold: cards and phones that stand too close for the patterns, and far repeats, against
    decoys of the same length that fail Luhn's test."""
    rng = random.Random(9)
    card, phone = lambda: luhn_card(rng), lambda: f"+1 ({rng.randint(200, 999)}) 555-{rng.randint(1000, 9999)}"
    decoy = lambda: next(d for d in iter(lambda: str(rng.randrange(10**15, 10**16)), None) if not pii_crf.luhn(d))
    rows = [(i, f"{TALK(20)} {card()} {TALK(15)} {phone()} {TALK(5)} 10.{i % 256}.0.7 {TALK(9)} {decoy()} {TALK(5)} version 3 of 12") for i in range(300)]
    twice = {i: (card(), card()) for i in range(300, 340)}
    rows += [(i, f"{TALK(10)} {a} {b} {TALK(8)}") for i, (a, b) in twice.items()]
    far = luhn_card(rng)
    rows += [(400, f"{far}, {TALK(400)} " + f"{far} {far} {TALK(200)} " * 30), (401, f"{TALK(30)} {decoy()} {decoy()} and 7"), (402, "7 of 12 in 2024")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["id"]: ([s for s in r["spans"] if s not in r["base"]], r["base"]) for r in pii_crf.find_pii(docs, pii_crf.train(docs)).collect()}
    found = sum(len(got[i][0]) for i in twice)
    assert found >= 0.9 * 2 * len(twice) and not any(got[i][1] for i in twice)  # the patterns find none of them
    assert len(got[400][0]) == 60 and len(got[400][1]) == 1
    assert not got[401][0] and not got[402][0] and sum(len(got[i][0]) for i in range(300)) <= 6


def test_quality_rules(docs):
    got = {r["id"]: r for r in quality_rules(docs).collect()}
    for i, t, *_ in DOCS:
        w = re.findall(r"[^\x20\x09-\x0D]+", text(t))
        win = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        rep = {k + d for k, x in enumerate(win) if win.count(x) > 1 for d in range(5)} if len(win) < 500 else set()
        assert (got[i]["n_words"], got[i]["word_chars"], got[i]["n_repeat_words"]) == (len(w), sum(map(len, w)), len(rep))
        assert not (got[i]["base_failed"] and got[i]["kept"])
    assert got[4]["kept"] and not got[0]["kept"]


def test_quality_rules_method(spark):
    """Base columns by brute force; verdicts beyond the base rules: a rule that never errs on good documents outvotes
    those that pass everything."""
    rng = random.Random(2)
    say = lambda n: " ".join(f"{rng.choice(WORDS)}{rng.randrange(1000)}" for _ in range(n))
    junk = [lambda: " ".join(w + rng.choice(("***", "$$$", "&&&")) for w in say(40).split()), lambda: say(40).upper().replace(" ", "!! "), lambda: say(40).replace(" ", " | ")]
    rows = [(i, say(60) + ". " + say(30) + ",\n" + say(9)) for i in range(400)] + [(1000 + i, junk[i % 3]()) for i in range(60)] + [(2000, say(60_000)), (2001, say(60_000)), (None, say(50)), (5000, "a\n\n b \na\na"), (5000, "a\n\n b \na\na")]
    got = quality_rules(spark.createDataFrame([(*r, "clash", 1) for r in rows], "doc_id long, text string, kept string, n_words int").repartition(4)).collect()
    by = {r["id"]: r for r in got}
    assert len(got) == len(rows)
    for i, t in rows:
        lines, seen = t.split("\n"), set()
        dup = sum(bool(x.split()) and (x in seen or seen.add(x) is not None) for x in lines)
        assert (by[i]["n_symbols"], by[i]["n_dup_lines"], by[i]["base_failed"]) == (sum(t.count(c) for c in "#*$%&|<>"), dup, len(t.split()) < 10)
    assert all(by[i]["kept"] for i in [*range(400), 2000, 2001, None])
    assert not any(by[1000 + i]["kept"] or by[1000 + i]["base_failed"] for i in range(60))


def test_quality_rules_repeats(spark):
    line = "a b c d e f"
    r = quality_rules(spark.createDataFrame([(1, f"{line}\n{line}\nx y z\n\n"), (2, "a a a a a a")], "doc_id long, text string")).orderBy("id").collect()
    assert [(x["n_repeat_words"], x["n_dup_lines"]) for x in r] == [(12, 1), (6, 0)]


def test_exact_dedup(docs, spark):
    low = {i: text(t).translate({c: c + 32 for c in range(65, 91)}) for i, t, *_ in DOCS}
    got = {r["id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs).collect()}
    assert got == {i: (k := max(j for j in low if low[j] == t), sum(x == t for x in low.values()), i == k) for i, t in low.items()}
    index = DigestIndex(spark, buckets=4)
    assert index.add(digests(docs)).count() == len(set(low.values())) == index.add(digests(docs)).count()
    again = DigestIndex(spark, index.path, buckets=99)  # found by its path, with its own buckets
    assert again.buckets == 4 and not any(r["kept"] for r in exact_dedup(docs.withColumn("doc_id", F.col("doc_id") + 100), again).collect())


def test_exact_dedup_batches(spark):
    """Copies on both sides of a batch's border, null and repeated ids: alike however many parts."""
    rows = [(i, f"t{i % 17}") for i in range(200)] + [(None, "t3"), (None, "only"), (None, None), (5, ""), (199, "T3"), (199, "T3")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    low = lambda t: (t or "").lower()
    want = sorted(str((i, max((j for j, u in rows if low(u) == low(t) and j is not None), default=None), sum(low(u) == low(t) for _, u in rows))) for i, t in rows)
    for n in (1, 2, 5):
        got = exact_dedup(df, batches=n).collect()
        assert sorted(str((r["id"], r["keep_id"], r["group_size"])) for r in got) == want
        assert all(r["kept"] == (r["id"] == r["keep_id"]) for r in got)
    least = {(r["id"], r["keep_id"]) for r in exact_dedup(df, keep="min").collect()}
    assert (20, 3) in least and (None, 3) in least


def test_mixing(spark):
    rows = [(i, "w " * (1 + i % 7), "big" if i % 3 else f"s{i % 4}") for i in range(600)] + [(None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mixture(docs, block_tokens=100).collect()
    assert {r["id"] for r in got} == {r[0] for r in rows}
    tokens = {}
    for i, t, s in rows:
        tokens[s or mixing.NULL_SOURCE] = tokens.get(s or mixing.NULL_SOURCE, 0) + max(1, len((t or "").split()))
    a, w, size = mixing.weights(tokens)
    for s in tokens:
        used = sum(r["n_tokens"] for r in got if (r["source"] or mixing.NULL_SOURCE) == s)
        assert round(size * w[s]) <= used < round(size * w[s]) + 8 and used <= 4 * tokens[s] + 8
    # every pass but the last is a permutation of the source; the last ends where the budget is met
    passes = {}
    for r in got:
        passes.setdefault((r["source"], r["pass"]), []).append(r["id"])
    for (s, k), ids in passes.items():
        assert len(ids) == len(set(ids)) and ((s, k + 1) not in passes or sorted(map(str, ids)) == sorted(str(i) for i, _, t in rows if t == s))
    _, _, same = mixing.weights(tokens, budget="same")
    assert same == sum(tokens.values()) and 0 <= a <= 1


def test_bpe(docs):
    got = {r["doc_id"]: r for r in bpe.byte_bpe(docs, P.path("byte_bpe_50k.tiktoken"), P.PATTERN).collect()}
    ranks = bpe.read_ranks(P.path("byte_bpe_50k.tiktoken"))
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, t, *_ in DOCS:
        assert np.frombuffer(bytes(got[i]["ids"]), "<u4").tolist() == enc.encode_ordinary(text(t))
        assert bytes(got[i]["decoded"]) == text(t).encode() and got[i]["kept"] == 1
    e = bpe.Encoder(ranks, P.PATTERN)
    for t in ("z" * 700, "日本語テキスト ½²Ⅷ\x1c\x85\xa0 x", "don't  stop\n\n ", "ﬀ" * 300, "été _a_ 12½"):
        assert np.frombuffer(e.encode([t])[0], "<u4").tolist() == np.frombuffer(e.encode_long(t), "<u4").tolist() == enc.encode_ordinary(t)


def test_quality_model(spark):
    bad = lambda: TALK(30).upper() + " *** ###"
    rows = [(i, bad() if i % 4 == 0 else TALK(40), "en", f"s{i % 3}", 100) for i in range(600)] + [(None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 > 0)) for i in range(400)], "doc_id long, quality int")
    model = quality_model.fit(docs, labels)
    score, y = model["held_out"]
    assert ((score >= model["threshold"]) == y).mean() > 0.97
    got = quality_model.score(docs, model).collect()
    known = [r for r in got if r["doc_id"] is not None]
    assert sum(not r["kept"] for r in known if r["doc_id"] % 4) <= 5  # good documents stay
    assert sum(not r["kept"] for r in known if r["doc_id"] % 4 == 0) >= 120  # of 150
    one_sided = labels.filter("quality = 1")
    assert quality_model.fit(docs, one_sided) is None and quality_model.score(docs, None).filter("kept").count() == 601
    few = quality_model.fit(docs, labels.filter("doc_id < 16"))  # four bad documents: the same rule
    assert 0 < few["threshold"] <= 0.5


def test_quality_model_cases(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, kept int"
    none = spark.createDataFrame([], schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    assert quality_model.fit(none, labels) is None and quality_model.score(none, None).count() == 0
    rows = [(i, TALK(20) if i % 2 else "# " * 30, None, None, None, "clash", 7) for i in range(40)] * 2 + [(50, "x " * 400_000, "en", "new", -3, "clash", 7), (None, "", None, None, None, None, None)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    model = quality_model.fit(docs, labels)
    got = quality_model.score(docs, model, keep=["doc_id", "score", "kept"])
    assert got.columns == ["doc_id", "p_text", "p_meta", "score", "kept"] and got.count() == 82
    assert {r["doc_id"] % 2 for r in got.filter("doc_id < 40 and kept").collect()} == {1}


def test_useless_view_spoils_nothing():
    rng = np.random.default_rng(3)
    y = (rng.random(600) > 0.2).astype(float)
    good, noise = y[:, None] * 2 + rng.normal(0, 0.3, (600, 1)), rng.normal(0, 1, (600, 20))
    w = quality_model.logistic(noise[:300], y[:300], l2=1.0)
    assert not quality_model.surest(np.arange(300), quality_model.margin(w, noise[300:]), (10, 10), 0.99)  # nothing is passed on
    assert ((quality_model.margin(quality_model.logistic(good[:300], y[:300]), good[300:]) > 0) == y[300:]).mean() > 0.98
    flat = np.column_stack([np.where(y > 0, 4.0, -4.0), np.full(600, np.log(y.mean() / (1 - y.mean())))])
    mix = quality_model.combined(flat, y)
    assert (0 <= mix[:2]).all() and (mix[:2] <= 1).all() and ((quality_model.margin(mix, flat) > 0) == y).all()
    few, many = quality_model.tail_threshold(rng.normal(5, 1, 40), 0.002), quality_model.tail_threshold(rng.normal(5, 1, 40_000), 0.002)
    assert 0 < few < 4 and abs(many - (5 - 2.88)) < 0.5  # the 0.002 quantile of the normal lies 2.88 below


def test_hilbert(docs, spark):
    n, bits = 3, 3
    grid = spark.range(1 << n * bits).select(*(F.shiftright("id", k * bits).bitwiseAND((1 << bits) - 1).cast("int").alias(f"c{k}") for k in range(n)))
    walk = hilbert.with_curve(grid, ["c0", "c1", "c2"], bits).orderBy("curve").collect()
    assert [r["curve"] for r in walk] == list(range(1 << n * bits))
    assert all(sum(abs(a[k] - b[k]) for k in range(n)) == 1 for a, b in zip(walk, walk[1:]))  # neighbours on the curve touch
    got = hilbert.hilbert_shards(docs, shards=3).collect()
    names = spark.createDataFrame([(f"v{i:03}",) for i in range(40)] + [("v007",)] * 30 + [(None,), ("",)], "v string")
    bounds = hilbert.category_bounds(names, "v", 3)
    cells = names.select("v", hilbert.category_cell(F.col("v"), bounds).alias("c")).distinct().collect()
    ordered = sorted(r["v"] for r in cells if r["v"] is not None)
    assert {r["v"]: r["c"] for r in cells} == {None: 0} | {v: i * 8 // len(ordered) for i, v in enumerate(ordered)}  # by rank among distinct values
    sizes = spark.createDataFrame([(x,) for x in (1, 2, 3, 4, 7, 8, 1 << 14, 1 << 20)] + [(None,)], "n long")
    assert [r[0] for r in sizes.select(hilbert.log_cell(F.col("n"), 4)).collect()] == [0, 1, 1, 2, 2, 3, 14, 15, 0]
    for s in range(3):
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots))) and len(slots) in (len(DOCS) // 3, len(DOCS) // 3 + 1)


def test_empty(spark):
    none = spark.createDataFrame([], SCHEMA)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for out in (remove_repeats(none), near_duplicates(none), exact_dedup(none), quality_rules(none), mixing.mixture(none), hilbert.hilbert_shards(none), pii_crf.find_pii(none, pii_crf.train(none)), warc.warc_round_trip(pages), bpe.byte_bpe(none, P.path("byte_bpe_50k.tiktoken"), P.PATTERN)):
        assert out.count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline as cp

    bad = lambda: "*** " + TALK(30).upper() + " ###"
    base = [(i, f"{TALK(60)}.", "en", f"s{i % 3}", 1) for i in range(60)] + [(i, bad(), "en", "s0", 1) for i in range(200, 230)]
    rows = base + [(100, base[3][1].upper(), "en", "s0", 1), (101, base[4][1], "en", "s0", 1), (102, base[5][1] + " more", "en", "s0", 1), (103, None, None, None, None), (None, "no id " * 5, "en", "s1", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 200), 0) for i, *_ in base if i % 4], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    passed = cp.quality(spark, docs, str(tmp_path))
    good = {r["doc_id"] for r in passed.collect()}
    assert not good & set(range(200, 230)) and set(range(60)) - {3} <= good
    ids = {r["doc_id"] for r in cp.exact(spark, docs, str(tmp_path)).collect()}
    assert 3 not in ids and 4 not in ids and {100, 101, 102, 103, None} <= ids
    got = cp.run(spark, str(tmp_path)).collect()
    assert {r["doc_id"] for r in got} == {r["doc_id"] for r in cp.exact(spark, passed, str(tmp_path)).collect()} - {102}
    text = {r[0]: text_of(r[1]) for r in rows}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for r in got:
        ids_ = enc.encode_ordinary(text[r["doc_id"]])
        assert r["n_tokens"] == len(ids_) and r["ids_sha256"] == hashlib.sha256(np.array(ids_, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text[r["doc_id"]].encode()).hexdigest()


def test_pipeline_near_copies(spark, tmp_path):
    import corpus_pipeline as cp

    rng = random.Random(8)
    talk = lambda n: [rng.choice(WORDS) for _ in range(n)]
    passage, texts = talk(50), []
    for k in range(40):
        words = talk(rng.randint(30, 300)) + passage * (k % 3 == 0)
        texts.append(words)
        for _ in range(k % 4):  # near copies: words replaced, or a tail, on both sides of 0.8
            copy = [w if rng.random() > rng.choice((0.005, 0.02, 0.05)) else "new" for w in words] + talk(rng.choice((0, 10, 60)))
            texts.append([w.upper() for w in copy] if rng.random() < 0.3 else copy)
    texts = [" ".join(t) for t in texts] + ["one two", "ONE  two", "one", "", " \n "]
    order = rng.sample(range(len(texts)), len(texts))
    rows = [(i, texts[k], "en", "s0", 1) for i, k in enumerate(order)] + [(None, texts[0], "en", "s0", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)

    sets = {}
    for i, t, *_ in rows[:-1]:
        w = t.lower().split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    up = {i: i for i in sets}
    links = [(a, b) for a in sets for b in range(a) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    for _ in sets:
        for a, b in links:
            up[a] = up[b] = min(up[a], up[b])
    got = {r["doc_id"] for r in cp.near(spark, docs, str(tmp_path)).collect()}
    assert len(links) > 15 and got == {i for i in up if up[i] == i} | {None}
