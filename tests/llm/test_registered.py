"""The registered queries over small tables with nulls, empty, long and repeated texts: against their SQL, or brute force."""

import hashlib
import random
import re

import duckdb
import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
import xxhash

from redactory.llm import bpe, queries

RNG = random.Random(19)
WORDS = ["".join(RNG.choice("abcdehilnorst") for _ in range(RNG.randint(2, 8))) for _ in range(200)]
talk = lambda n: " ".join(RNG.choice(WORDS) for _ in range(n))
SHARED = talk(40)
TEXTS = [None, "", " \n\t ", "one", "One two", talk(50), talk(200), SHARED, SHARED.upper(), SHARED + " " + talk(3), SHARED + " and more", talk(30) + " " + SHARED, "É ß ſ " + SHARED[:80], "a" * 500, "a" * 300, "é" * 200 + SHARED, talk(9000),
         "mail me@a.bc, me@a.bc or +1 (503) 555-6503 or 10.0.0.1 or 999.1.1.1 or 4111 1111 1111 1111", "a b c d e\na b c d e\n\n# $ % a b c d e", "日本語 テキスト 12½ don't  stop\n\n", SHARED, "x\u0000y " * 12] + [talk(RNG.randint(5, 60)) for _ in range(25)]
TEXTS += [t + " end" for t in TEXTS[-6:]] + TEXTS[-3:]


@pytest.fixture(scope="module")
def small(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    ids = RNG.sample(range(5000), len(TEXTS))
    docs = [(i, t, RNG.choice(("en", "fr", None)), RNG.choice(("s1", "s2", None)), None if t is None else len(t)) for i, t in zip(ids, TEXTS)]
    html = [None, "", "<p>" + SHARED, "<p>" + SHARED, "tiny", "tiny", "<b>é" * 400, "<p>" + SHARED, "<i>" + talk(2000)]
    vector = lambda: [RNG.uniform(-1, 1) for _ in range(64)]
    same = vector()
    vectors = [(i, RNG.choice((same, vector(), None, [None] * 64, [float("nan")] * 64)) if i % 3 else vector(), RNG.choice((1, 2, None))) for i in range(400)]
    tables = {"documents": (docs, "doc_id long, text string, lang string, source string, n_chars long"), "pages": ([(i * 3, f"http://{i}", h) for i, h in enumerate(html)], "page_id long, url string, html string"),
              "embeddings": (vectors, "vec_id long, embedding array<float>, label int"), "benchmark": ([(1, TEXTS[5]), (2, None), (3, talk(80))], "item_id long, text string"), "labels": ([(i, k % 2, 0) for k, i in enumerate(ids[:20])], "doc_id long, quality int, toxic int")}
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).repartition(3).write.parquet(f"{d}/{name}.parquet")
    return d, {i: t or "" for i, t, *_ in docs}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, small, name):
    d, _ = small
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{d}/{t}.parquet/*.parquet'")
    got = queries.QUERIES[name](spark, d)
    found = con.execute(queries.ORACLE_SQL[name])
    names, want = [c[0] for c in found.description], found.fetchall()
    assert sorted(names) == sorted(got.columns)
    assert sorted(str([r[c] for c in names]) for r in got.collect()) == sorted(str(list(r)) for r in want)


def test_simhash_query(spark, small):
    d, texts = small
    fp = {}
    for i, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t.translate({c: c + 32 for c in range(65, 91)}))
        h = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(max(1, len(w) - 2))] if w else []
        fp[i] = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
    up = {i: i for i in fp}
    for _ in fp:
        for a in fp:
            up[a] = min(up[b] for b in fp if (fp[a] ^ fp[b]).bit_count() <= 3)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in queries.op2_simhash(spark, d).collect()}
    assert got == {i: (f"{fp[i]:016x}", up[i]) for i in fp}


def test_pii_query(spark, small):
    d, texts = small
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fits(kind, m):
        digits = re.sub("[^0-9]", "", m)
        luhn = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(digits[::-1])) % 10 == 0
        return {"email": True, "ip": all(int(x) < 256 for x in m.split(".")) if kind == "ip" else False, "card": 14 <= len(digits) <= 19 and luhn, "phone": 10 <= len(digits) <= 15}[kind]

    for r in queries.op4_pii(spark, d).collect():
        spans = sorted((m.start(), k, kind, m.end()) for k, (kind, p) in enumerate(kinds.items()) for m in re.finditer(p, texts[r["doc_id"]]) if fits(kind, m[0]))
        told = [f"{kind}:{a}:{b}" for a, _, kind, b in spans]
        assert r["base_sha256"] == hashlib.sha256(",".join(told).encode()).hexdigest() and set(told) <= set(filter(None, r["spans"].split(",")))
        assert [r[f"n_{k}"] for k in kinds] == [sum(x[2] == k for x in spans) for k in kinds]


def test_quality_rules_query(spark, small):
    d, texts = small
    for r in queries.op5_quality_rules(spark, d).collect():
        t = texts[r["doc_id"]]
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        at: dict = {}
        for k in range(len(w) - 4):
            at.setdefault(tuple(w[k : k + 5]), []).append(k)
        repeats = {k + j for ks in at.values() if len(ks) > 1 for k in ks for j in range(5)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        failed = len(w) < 10 or 100 * len(repeats) > 20 * len(w)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(repeats), failed)
        assert not (failed and r["kept"])


def test_bpe_query(spark, small):
    d, texts = small
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for r in queries.op8_byte_bpe(spark, d).collect():
        ids = enc.encode_ordinary(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_queries_without_sql_give_every_row(spark, small):
    d, texts = small
    assert {r["doc_id"] for r in queries.op6_mixing(spark, d).collect()} == set(texts)
    assert {r["doc_id"] for r in queries.op9_quality_model(spark, d).collect()} == set(texts)
