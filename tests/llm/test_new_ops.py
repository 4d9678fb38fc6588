"""The prefix trie, whitening and suffix-array deduplication against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from strandloom.llm import byte_bpe, entries, pii, prefix_trie, suffix_dedup, token_store, whitening

SF = "/root/testdata/sf0.001"


# --- prefix trie ---


def brute_trie(rows, family=5, heads=9):
    """rows: (conv_id, turn, role, text)."""

    def md5(r, t):
        return hashlib.md5(f"{len(r)}:{r}{t}".encode()).digest()

    own = defaultdict(list)
    for c, n, r, t in rows:
        if c is not None:
            own[c].append((n, r or "", t or ""))
    own = {c: [(r, t) for _, r, t in sorted(v, key=lambda x: (x[0] is not None, x[0] or 0, md5(*x[1:])))] for c, v in own.items()}
    members = defaultdict(list)
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        path = own.get(c - c % family, [])[:h] + v[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append((c, d == len(path)))
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            children[p[:-1]] += 1
    for p, m in members.items():
        for a in range(len(p) + 1):
            leaves[p[:a]] += p not in children
            saved[p[:a]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    out = set()
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in m if last))
        parent = min(members[p[:-1]])[0] if p else None
        out.add((min(m)[0], len(p), parent, len(m), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return out


CONVS = "conv_id bigint, turn bigint, role string, text string, depth string, total string, n int, part int, block string"
NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def as_trie(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y", 1, 2, "z") for r in rows], CONVS)
    return prefix_trie.trie(df)


def test_trie_long_null_and_repeated(spark):
    rng = random.Random(5)
    rows = []
    for c in [*range(0, 22), 33, 34, 41, 999]:
        n = rng.choice([1, 2, 3, 8, 9, 16, 17, 45, 70])
        for i in range(n):
            rows.append((c, i if i else None, rng.choice(["user", "bot", None]), rng.choice(["a", "aé", "", None]) if i < 20 else "same"))
    rows += rows[:5] + [(None, 1, "user", "no conversation")] + [(2, 3, "user", t) for t in "ba"]
    got = as_trie(spark, rows)
    assert got.columns == NODE
    found = [tuple(r) for r in got.collect()]
    assert len(found) == len(set(found)) and set(found) == brute_trie(rows)


def test_trie_turnless_and_empty(spark):
    # 4 % 5 leads to a conversation 0 that isn't there, so its own first turns are cut and nothing takes their place
    rows = [(c, i, "user", "t") for c in (4, 13) for i in range(1)]
    assert {tuple(r) for r in as_trie(spark, rows).collect()} == brute_trie(rows)
    assert as_trie(spark, []).count() == 0


def test_trie_query_and_sql(spark):
    rows = duckdb.sql(f"select conv_id, turn, role, text from '{SF}/conversations.parquet'").fetchall()
    got = {tuple(r) for r in entries.QUERIES["op11_prefix_trie"](spark, SF).select(*NODE).collect()}
    c = duckdb.connect()
    c.execute(f"create view conversations as select * from '{SF}/conversations.parquet'")
    want = c.sql(entries.ORACLE_SQL["op11_prefix_trie"]).project(", ".join(NODE)).fetchall()
    assert got == brute_trie(rows) == set(want)


# --- whitening ---


def held_against(rows, vectors, components=4):
    """rows of ``whiten`` against a plain computation over (vec_id, vector)."""
    kept = [(i, v) for i, v in vectors if v is not None and all(c is not None and np.isfinite(c) for c in v)]
    x = np.array([[int(np.floor(256 * float(c))) for c in v] for _, v in kept])
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(axis=0)
    centred = (u * n - s) / n
    cov = centred.T @ centred / n
    values, directions = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    want = (x * n - s) / n @ directions[:, order] / np.sqrt(values[order])
    by = defaultdict(list)
    for r in rows:
        assert r.n == n and r.identity_error < 1e-9 and abs(r.explained - values[order][r.component - 1] / np.trace(cov)) < 1e-9
        by[r.component].append((r.vec_id, r.deviation, r.whitened))
    assert sorted(by) == list(range(1, len(order) + 1))
    for k, own in by.items():
        exact = [(i, int(((n * v - s) ** 2).sum())) for (i, _), v in zip(kept, x)]
        key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
        assert sorted((r[:2] for r in own), key=key) == sorted(exact, key=key)
        a = np.sort([r[2] for r in own])
        b = np.sort(want[:, k - 1])
        assert np.allclose(a, b, atol=1e-8) or np.allclose(a, np.sort(-b), atol=1e-8)


def test_whitening_edges(spark):
    rng = np.random.default_rng(3)
    vectors = [(int(i), [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(60, 6)))]
    vectors += [(7, vectors[0][1])] * 30 + [(None, vectors[1][1]), (61, None), (62, [1.0, None, 2.0, 3.0, 4.0, 5.0]), (63, [float("nan")] * 6), (64, [float("inf")] + [0.0] * 5)]
    schema = "vec_id bigint, embedding array<double>, index int, part string, x double, component string"
    df = spark.createDataFrame([(i, v, 1, "p", 0.5, "c") for i, v in vectors], schema)
    held_against(whitening.whiten(df).collect(), vectors)
    ragged = df.select("vec_id", "embedding").unionByName(spark.createDataFrame([(90, [1.0]), (91, [])], "vec_id bigint, embedding array<double>"))
    assert whitening.whiten(ragged).count() == whitening.whiten(df).count()


def test_whitening_few_and_huge(spark):
    schema = "vec_id bigint, embedding array<double>"
    assert whitening.whiten(spark.createDataFrame([], schema)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [])], schema)).count() == 0
    line = whitening.whiten(spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 1.0])], schema)).collect()
    assert [(r.component, round(abs(r.whitened), 9), round(r.explained, 9)) for r in line] == [(1, 1.0, 1.0)] * 2
    huge = whitening.whiten(spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 3.0]), (3, [0.0, 1.0])], schema)).collect()
    assert {r.deviation for r in huge if r.vec_id < 3} == {None}


def test_whitening_query(spark):
    vectors = duckdb.sql(f"select vec_id, embedding from '{SF}/embeddings.parquet'").fetchall()
    held_against(entries.QUERIES["op12_embedding_whitening"](spark, SF).collect(), vectors)


# --- suffix array ---


def brute_removed(texts, length):
    """Per text (n_bytes, n_removed, n_spans, kept_sha256, spans), texts in order."""
    seen, out = set(), []
    for text in texts:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for p in range(len(data) - length + 1):
            own = data[p : p + length]
            if own in seen:
                gone[p : p + length] = True
            seen.add(own)
        edge = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int), [0]])))
        spans = [list(s) for s in edge.reshape(-1, 2).tolist()]
        out.append((len(data), int(gone.sum()), len(spans), hashlib.sha256(np.frombuffer(data, np.uint8)[~gone].tobytes()).hexdigest(), spans))
    return out


def brute_repeats(stretches, length):
    """{(bytes, places)} of maximal repeats: no place left out, different or no bytes on the left, different or none on the right."""
    where = defaultdict(list)
    for s, data in enumerate(stretches):
        for a in range(len(data)):
            for b in range(a + length, len(data) + 1):
                where[data[a:b]].append((s, a))
    out = set()
    for own, places in where.items():
        left = {stretches[s][a - 1] if a else None for s, a in places}
        right = {stretches[s][a + len(own)] if a + len(own) < len(stretches[s]) else None for s, a in places}
        if len(places) > 1 and (len(left) > 1 or None in left) and (len(right) > 1 or None in right):
            out.add((own, tuple(places)))
    return out


@pytest.mark.parametrize("seed", range(6))
def test_interval_tree_finds_maximal_repeats(seed):
    rng = random.Random(seed)
    stretches = [bytes(rng.choice(b"ab\0") for _ in range(rng.randint(0, 40))) for _ in range(12)]
    stretches += [stretches[0] + stretches[1], stretches[2][3:], b"aaaaaaaaaaaaaaa"]
    ends = np.cumsum([len(s) for s in stretches], dtype=np.int64)
    begins = ends - np.array([len(s) for s in stretches])
    array, stretch, depth, first, last = suffix_dedup.maximal_repeats(np.frombuffer(b"".join(stretches), np.uint8), begins, ends, 4)
    got = set()
    for d, i, j in zip(depth, first, last):
        places = sorted((int(s), int(p - begins[s])) for p, s in zip(array[i : j + 1], stretch[i : j + 1]))
        s, a = places[0]
        got.add((stretches[s][a : a + d], tuple(places)))
    assert got == brute_repeats(stretches, 4)


def dedup_against_brute(spark, texts, length):
    df = spark.createDataFrame([(i, t, "x", 1, 2) for i, t in enumerate(texts)], "doc_id bigint, text string, data string, key int, lo int").repartition(5)
    got = [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, r.spans) for r in sorted(suffix_dedup.deduplicate(df, length, with_bytes=True).collect())]
    assert got == brute_removed(texts, length)


@pytest.mark.parametrize("heavy", [2048, 8])
def test_dedup_random(spark, monkeypatch, heavy):
    monkeypatch.setattr(suffix_dedup, "HEAVY", heavy)
    monkeypatch.setattr(suffix_dedup, "LEAST_BUCKETS", 8)
    rng = random.Random(heavy)
    passage = "".join(rng.choice("abcdé ") for _ in range(60))
    texts = [None, "", "short"]
    for i in range(150):
        own = ["".join(rng.choice("abé\n") for _ in range(rng.randint(0, 90))) for _ in range(3)]
        texts.append(own[0] + (passage if i % 3 else passage[5:50]) + own[1] + (texts[rng.randint(0, len(texts) - 1)] or "") [:200] + own[2])
    texts += [texts[9], texts[9], "a" * 500, "ab" * 300, " " * 700 + "b"]
    dedup_against_brute(spark, texts, 20)


def test_links_lead_to_equal_earlier_bytes(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LEAST_BUCKETS", 8)
    rng = random.Random(2)
    own = ["".join(rng.choice("abc ") for _ in range(80)) for _ in range(9)]
    texts = [(own[i % 9] + own[i * 7 % 9][i % 30 :] + own[i * 5 % 9][: 50 + i % 30]).encode() for i in range(60)]
    rows = suffix_dedup.keyed(spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id bigint, text string"))
    found = suffix_dedup.find_repeats(rows, 24).collect()
    gone = [np.zeros(len(t), bool) for t in texts]
    for r in found:
        assert (r.first_key, r.first_lo) < (r.key, r.lo) and r.hi - r.lo >= 24
        assert texts[r.key][r.lo : r.hi] == texts[r.first_key][r.first_lo : r.first_lo + r.hi - r.lo]
        gone[r.key][r.lo : r.hi] = True
    assert [int(g.sum()) for g in gone] == [w[1] for w in brute_removed([t.decode() for t in texts], 24)]


def test_dedup_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LEAST_BUCKETS", 8)
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh") for _ in range(suffix_dedup.SEGMENT + 3000))
    edge = suffix_dedup.SEGMENT
    dedup_against_brute(spark, [long, "x" + long[edge - 500 : edge + 700] + "y", long[edge - 50 : edge + 49], long[-300:] + long], 100)


def test_dedup_repeated_and_null_keys(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "LEAST_BUCKETS", 8)
    a, b = "abc" * 20 + "x" * 30, "qrs" * 30
    rows = [(1, a), (1, a), (None, b), (None, b), (2, b + a), (3, None)]
    got = suffix_dedup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string"), 40).collect()
    assert len(got) == 6
    # periodic texts repeat within themselves too, so only the order is held against brute force
    md5 = lambda t: hashlib.md5((t or "").encode()).hexdigest()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, md5(r[1])))
    want = [(i, *w[:4]) for (i, _), w in zip(order, brute_removed([t for _, t in order], 40))]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)
    assert suffix_dedup.deduplicate(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_dedup_query(spark):
    texts = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()
    got = sorted(tuple(r) for r in entries.QUERIES["op13_suffix_dedup"](spark, SF).collect())
    assert got == [(i, *w[:4]) for (i, _), w in zip(texts, brute_removed([t for _, t in texts], 100))]


# --- faults of earlier rounds ---


@pytest.mark.parametrize("white", [" ", "\n", " \n", "\u3000\t"])
def test_megabytes_of_white_space(spark, white):
    enc = byte_bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    for make in (lambda w: w, lambda w: f"word{w}", lambda w: f"{w}word", lambda w: f"one{w}two{w}3 !{w}x"):
        own = byte_bpe.LONG // len(white) + 7  # short enough for the library, long enough for the run to be taken out
        assert byte_bpe.encode_text(enc, make(white * own)) == enc.encode_ordinary(make(white * own))
    texts = ["a" + white * (2_000_000 // len(white)) + "b", white * (2_000_000 // len(white))]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = byte_bpe.round_trip(df, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN).orderBy("doc_id").collect()
    assert [r["decoded_sha256"] for r in rows] == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_a_title_is_no_name(spark):
    df = spark.createDataFrame([(1, "Mr Smith Mrs Smith met Frau Doe Herr Roe. Mrs Mrsic came.")], "doc_id bigint, text string")
    words = pii.replace(df, "key").first()["text"].replace(".", "").split()
    smith = words[1]
    assert words == ["Mr", smith, "Mrs", smith, "met", "Frau", words[6], "Herr", words[8], "Mrs", words[10], "came"]
    assert not {smith, words[6], words[8], words[10]} & {"Smith", "Doe", "Roe", "Mrsic"} and len({smith, words[6], words[8], words[10]}) == 4


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 1000])
def test_every_leaf_counts_in_a_tree(spark, n):
    leaves = [hashlib.sha256(str(i).encode()).hexdigest() for i in range(n)]

    def root(x):
        while len(x) > 1:
            x = [hashlib.sha256((x[i] + x[i + 1]).encode()).hexdigest() if i + 1 < len(x) else x[i] for i in range(0, len(x), 2)]
        return x[0]

    changed = [leaves[:i] + ["0" * 64] + leaves[i + 1 :] for i in {0, n // 2, n - 1}]
    df = spark.createDataFrame([(x,) for x in [leaves, *changed]], "leaves array<string>")
    got = [r[0] for r in df.select(token_store.tree(F.col("leaves"))).collect()]
    assert got == [root(x) for x in [leaves, *changed]] and len(set(got)) == 1 + len(changed)


def test_pipeline_drops_repeated_rows(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text), (3, "other " + text[::-1]), (None, "x"), (None, "x"), (None, "y")]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    got = corpus_pipeline.drop_near_duplicates(spark, df, SF)
    assert got.columns == df.columns
    assert sorted(((r["doc_id"] or 0, r["text"]) for r in got.collect())) == [(0, "x"), (0, "y"), (1, text), (3, "other " + text[::-1])]


def test_surrogates_on_the_table_are_distinct_and_the_same_everywhere(spark):
    """Entities found by another engine of patterns in the texts before and after: the same kinds in the same order, one surrogate for each, and none for two."""
    import regex

    patterns = {k: regex.compile(p.replace(r"\x{A0}", "\xa0")) for k, p in pii.KINDS.items()}
    every = regex.compile("|".join(f"(?:{p.pattern})" for p in patterns.values()))
    before = dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    after = {r["doc_id"]: r["text"] or "" for r in entries.QUERIES["op8_pii_surrogates"](spark, "/root/testdata/sf0.01").select("doc_id", "text").collect()}
    assert before.keys() == after.keys()

    def found(text):
        out = []
        for m in every.finditer(text):
            kind = next(k for k, p in patterns.items() if p.fullmatch(m[0]))
            key = m[0]
            if kind == "name":
                key = regex.findall(pii.WORD, m[0])[-1].lower()
            elif kind in ("card", "phone", "ssn"):
                key = regex.sub("[^0-9]", "", key)
            elif kind != "token":
                key = key.lower().replace(" ", "")
            out.append((kind, key))
        return out

    given, taken, n = {}, {}, 0
    for i, text in before.items():
        old, new = found(text), found(after[i])
        assert [k for k, _ in old] == [k for k, _ in new]
        for a, b in zip(old, new):
            n += 1
            assert given.setdefault(a, b) == b and taken.setdefault(b, a) == a and b not in given
    assert n > 100 and len({k for k, _ in given}) >= 3 and not set(taken) & set(given)
