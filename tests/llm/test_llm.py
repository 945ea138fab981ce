"""The training-data operators against brute force, round trips and held-out labels, and on odd inputs."""

import hashlib
import random
import re
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from check_queries import TABLES, compare
from loreweave.llm import bpe, exact_dedup, hilbert_ann, langid, mixing, pii, quality, simhash, toxicity, warc
from loreweave.llm.registered import CHECKS, QUERIES

DOCS = "doc_id long, text string, lang string, source string, n_chars long, fp string, c0 long, text2 string"
LONG = "word " * 30_000 + "x" * 3_000


def odd_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    texts = ["", None, "one two three four five", "one two three four five", LONG, LONG, " \n\t ", "12345 !!", "Ünïcödé 😀 text", "a"]
    rows = [(i, t, "en" if i % 2 else None, None if i % 3 else "s", i, "x", None, "y") for i, t in enumerate(texts)]
    rows += [rows[2], rows[2], (None, "one two three four five", None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), DOCS)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@pytest.mark.parametrize("name", list(CHECKS))
def test_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    import __spark_entry__

    assert __spark_entry__.queries()[name] is QUERIES[name]
    ok, note, _, _ = compare(spark, con, sf, name)
    assert ok, note


# -- language ------------------------------------------------------------------------------------------------------------


def test_langid_held_out(spark, sf):
    found = QUERIES["op7_langid"](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/documents.parquet").toPandas(), on="doc_id")
    held = found[found.held_out]
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert (held.lang == held.lang_pred).mean() >= 0.95


def test_langid_equals_plain_counting():
    labels, weights = ["a", "b"], np.random.default_rng(1).normal(size=(2, langid.BUCKETS)).astype(np.float32)
    model = langid.LanguageModel(labels, np.log([0.5, 0.5]), weights)
    texts = ["Hello", "", "x", "ab" * 50, "é😀"]
    want = []
    for t in texts:
        s = model.prior.copy()
        for order in langid.ORDERS:
            codes, _ = langid.codes_of([t])
            for b in langid.ngram_buckets(codes, order):
                s = s + weights[:, b]
        want.append(s)
    assert np.allclose(langid.log_scores(model, texts), want, atol=1e-4)


def test_langid_odd(odd, none):
    found = langid.identify(odd, "doc_id", "text", "lang").collect()
    assert len(found) == len(odd_rows())
    assert all((r.lang_pred == "und") == (r.score == 0) for r in found)
    assert {r.lang_pred for r in found if r.doc_id in (0, 1, 6, 7)} == {"und"}
    assert langid.identify(none, "doc_id", "text", "lang").count() == 0
    assert langid.keep_identified(odd).columns == odd.columns
    assert langid.keep_identified(none).count() == 0


# -- exact copies --------------------------------------------------------------------------------------------------------


def key(i):
    return (i is not None, i or 0)


@pytest.mark.parametrize("limit", [exact_dedup.TABLE_BYTES, 500])
def test_exact_odd(odd, limit):
    got = exact_dedup.duplicate_classes(odd, "doc_id", "text", limit).collect()
    groups = {}
    for r in odd_rows():
        groups.setdefault(r[1] or "", []).append(r[0])
    want = Counter()
    for t, ids in groups.items():
        for i in ids:
            want[(i, max(ids, key=key), len(ids), hashlib.sha256(t.encode()).hexdigest())] += 1
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups) and all(r.doc_id == r.keep_id for r in got if r.kept)
    stay = exact_dedup.exact_dedup(odd, limit=limit)
    assert stay.columns == odd.columns
    assert Counter((r.doc_id, r.text or "") for r in stay.collect()) == Counter((max(i, key=key), t) for t, i in groups.items())


def test_exact_empty(none):
    assert exact_dedup.duplicate_classes(none, "doc_id", "text").count() == exact_dedup.exact_dedup(none).count() == 0


def test_grace_spills_and_compares_whole_texts():
    rng = random.Random(3)
    texts = [f"text {rng.randrange(300)}" * 20 for _ in range(2_000)]
    # all digests equal in their first bytes, and some different texts with one digest
    records = [(b"\0\0" + hashlib.sha256(t[:9].encode()).digest()[2:], t, (i,)) for i, t in enumerate(texts)]
    found = {t: [m[0] for m in members] for _, t, members in exact_dedup.grace(iter(records), exact_dedup.append, 20_000)}
    want = {}
    for i, t in enumerate(texts):
        want.setdefault(t, []).append(i)
    assert {t: sorted(m) for t, m in found.items()} == want


# -- near copies ---------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(ids, fps):
    roots = list(range(len(fps)))

    def root(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                roots[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return [least.get(root(i)) for i in range(len(ids))]


def test_simhash_documents(spark, sf):
    got = QUERIES["op10_simhash"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert all(int(r.fingerprint, 16) == brute_fingerprint(texts[r.doc_id]) for r in got)
    assert [r.component_id for r in got] == brute_components([r.doc_id for r in got], [int(r.fingerprint, 16) for r in got])


@pytest.mark.parametrize("chunk", [4, 1_024])
def test_chains_and_hot_keys(spark, chunk):
    """Chains of near fingerprints, a crowd around one, and strangers: components as by brute force, few links."""
    rng = random.Random(7)
    fps, start = [], rng.getrandbits(64)
    for i in range(60):  # a chain: each four bits from the last
        fps.append(start)
        for b in rng.sample(range(64), 4):
            start ^= 1 << b
    center = rng.getrandbits(64)
    fps += [center ^ (1 << a) ^ (1 << b) for a in range(20) for b in range(a)]
    fps = list(dict.fromkeys(fps + [rng.getrandbits(64) for _ in range(100)]))
    rows = spark.createDataFrame([(i, x - (1 << 64) if x >> 63 else x, 0) for i, x in enumerate(fps)], "doc_id long, fp long, mark long")
    got = {r.fp % (1 << 64): r.component_id for r in simhash.grouped(rows, chunk).collect()}
    assert [got[x] for x in fps] == brute_components(list(range(len(fps))), fps)
    links = simhash.fingerprint_links(rows.select("fp"), chunk).count()
    assert links < 40 * len(fps)


def test_simhash_odd(odd, none):
    got = simhash.near_duplicates(odd, "doc_id", "text").collect()
    rows = odd_rows()
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = Counter(zip([r[0] for r in rows], [f"{x:016x}" for x in fps], brute_components([r[0] for r in rows], fps)))
    assert Counter(tuple(r) for r in got) == want
    assert simhash.near_duplicates(none, "doc_id", "text").count() == 0
    assert simhash.near_dedup(odd).columns == odd.columns and simhash.near_dedup(none).count() == 0


# -- mixture -------------------------------------------------------------------------------------------------------------


def test_mixture_odd(odd, none):
    assert mixing.mix(none, "doc_id", "source", "text").count() == 0
    got = mixing.mix(odd, "doc_id", "source", "text")
    assert got.columns == [*odd.columns, "copy_no", "mix_order"]
    joined = mixing.mix(odd, "doc_id", "source", "text", broadcast_rows=0)
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, joined.collect()))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan)


def test_mixture_meets_targets(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("ten chars.").alias("text"), F.when(F.col("id") % 4 == 0, "a").otherwise("b").alias("source"))
    got = {r.source: r["count"] for r in mixing.mix(docs, "doc_id", "source", "text", weights={"a": 3, "b": 1}).groupBy("source").count().collect()}
    assert abs(got["a"] - 15_000) < 500 and abs(got["b"] - 5_000) < 300


# -- tokens --------------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.no_truncation()
    t.no_padding()
    return t


def test_tree_concatenation_is_exact(library):
    ranks, special = bpe.read_vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    small = bpe.Codec(ranks, special, leaf=40, fine=15, unsplit=12, window=2)
    decoder = bpe.Decoder(small.bytes)
    pieces = ["a", "the", " ", "  ", "\n", "'", "'s", "'ll", "1", "23", "é", "你", "😀", "<|endoftext|>", "<|endo", "ftext|>", "!", "　", "aaaaaaaa", "        ", "==="]
    rng = random.Random(5)
    for _ in range(3_000):
        some = rng.sample(pieces, rng.choice([1, 2, 4, 12]))
        text = "".join(rng.choice(some) for _ in range(rng.randint(0, 120)))
        want = library.encode(text, add_special_tokens=False).ids
        assert small.encode(text) == small.direct(text) == want, text
        assert decoder.text(np.array(want, np.int64)) == library.decode(want, skip_special_tokens=False) == text


def test_bpe_odd(spark, odd, none, library):
    got = Counter(tuple(r) for r in bpe.encode_documents(odd).collect())
    want = Counter()
    for r in odd_rows():
        ids = library.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((r[1] or "").encode()).hexdigest())] += 1
    assert got == want
    assert bpe.encode_documents(none).count() == 0
    encoded = bpe.Bpe(spark, leaf=100).encode(odd, "text")
    assert encoded.columns == [*odd.columns, "ids"] and encoded.count() == len(odd_rows())


# -- archives ------------------------------------------------------------------------------------------------------------


def test_warc_round_trip(spark):
    big = "x" * 1_000
    pages = [(1, "http://A.example.com/p?q=1", big), (2, "http://a.example.com/p", big), (3, None, "small"), (4, "u\r\nv", "small"), (5, "http://b.org", None)]
    pages += [(6, "https://user@b.org:80/é#f", "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 3), (None, "http://c.net/", big), (7, "http://b.org", "é" * 600), (7, "http://b.org", "é" * 600)]
    rows = warc.archive_pages(spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")).collect()
    want = Counter()
    for i, _, html in pages:
        b = (html or "").encode()
        keep = max((p[0] or 0 for p in pages if (p[2] or "") == (html or "")), default=0) if len(b) >= 1000 else i
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "response" if keep == i else "revisit", None if keep == i else keep)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows) == want
    order = [(r.url_key, r.captured) for r in rows]
    assert order == sorted(order)
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_loser_tree():
    rng = random.Random(1)
    for k in range(9):
        runs = [sorted((rng.randrange(20),) for _ in range(rng.randrange(12))) for _ in range(k)]
        merged = [runs[r][i] for r, i in warc.LoserTree(runs)]
        assert merged == sorted(x for r in runs for x in r)


# -- neighbours ----------------------------------------------------------------------------------------------------------


def test_neighbours_recall(spark, sf):
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = hilbert_ann.nearest(spark.createDataFrame(rows), "vec_id", "embedding", F.col("vec_id") % 50 == 0, cells=16).toPandas()
    found = 0
    for q in ids[ids % 50 == 0]:
        s = hilbert_ann.exact_cosine(x, np.repeat(x[ids == q], len(x), 0))
        best = [i for i in ids[np.lexsort((ids, -s))] if i != q][:5]
        mine = got[got.query_id == q].sort_values("rank")
        found += len(set(best) & set(mine.vec_id))
        assert list(mine["rank"]) == [1, 2, 3, 4, 5] and np.allclose(mine.score, s[np.searchsorted(ids, mine.vec_id)], atol=1e-12)
    assert found >= 0.9 * 5 * (ids % 50 == 0).sum()


def test_neighbours_odd(spark):
    nan = float("nan")
    rows = [(i, [1.0, 0.0]) for i in range(20)] + [(100, [0.0, 0.0]), (150, None), (200, [nan, 1.0]), (250, [None, 1.0]), (300, [1.0, 1.0, 1.0]), (None, [1.0, 0.0]), (350, [0.0, 2.0])]
    got = hilbert_ann.nearest(spark.createDataFrame(rows, "vec_id long, vec array<double>"), "vec_id", "vec", F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in got] == [(0, k, k, 1.0) for k in range(1, 6)] + [(350, k + 1, k, 0.0) for k in range(5)]
    empty = spark.createDataFrame([], "vec_id long, vec array<double>")
    assert hilbert_ann.nearest(empty, "vec_id", "vec", F.col("vec_id") % 50 == 0).count() == 0


# -- quality and toxicity ------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("name, label, least", [("op1_quality", "quality", 0.95), ("op3_toxicity", "toxic", 0.9)])
def test_held_out_labels(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, sf).toPandas().merge(spark.read.parquet(f"{sf}/labels.parquet").toPandas(), on="doc_id")
    held = found[found.held_out]
    assert (held.predicted == held[label]).mean() >= least


@pytest.mark.parametrize("score", [quality.score_quality, toxicity.score_toxicity])
def test_scores_odd(spark, odd, none, score):
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(9)] + [(3, 1, 1), (None, None, None)], "doc_id long, quality int, toxic int")
    for few in (labels, labels.limit(0)):
        got = score(odd, few).collect()
        assert len(got) == len(odd_rows()) and all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in got)
        assert score(none, few).count() == 0


def test_grammar_reads_clauses():
    g = toxicity.Grammar(toxicity.seed_lexicon(), {"vequ": 1.0})
    plain, negated, said, aimed = (g.features(t)[0] for t in ("an idiot", "he is not an idiot", "he said idiot", "you idiot"))
    assert negated < plain < aimed and said < aimed
    assert g.features("kill it")[0] < g.features("i will kill you")[0]
    assert g.features("VEQUAIS de")[0] == 1.0 and g.features("")[0] == g.features("clean words")[0] == 0


# -- personal data -------------------------------------------------------------------------------------------------------

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def holds(kind, s):
    d = [int(c) for c in s if c in "0123456789"]
    luhn = sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(reversed(d))) % 10 == 0
    return {"email": True, "ip": all(int(x) <= 255 for x in s.split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]


def brute_spans(text):
    found = [(m.start(), j, f"{k}:{m.start()}:{m.end()}") for j, (k, p) in enumerate(PATTERNS.items()) for m in re.finditer(p, text or "") if holds(k, m.group())]
    return [x[2] for x in sorted(found)]


def test_pii_base(spark):
    rng = random.Random(2)
    parts = ["a", "b.c", "@", "x-y", ".com", ".", "12", "255", "256", "192.168.1.1", "4111 1111 1111 1111", "+1 (555) 555-1234", " ", "-", "0" * 30, "\n", "é", "😀", "", "$1", "_%", "user@mail.example.com", "[at]"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 25)))) for i in range(1_500)] + [(1_500, None), (1_500, None)]
    got = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = Counter()
    for i, t in rows:
        b = brute_spans(t)
        want[(i, *(sum(x.startswith(k) for x in b) for k in pii.KINDS), hashlib.sha256(",".join(b).encode()).hexdigest())] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    texts = dict(rows)
    assert all(set(brute_spans(texts[r.doc_id])) <= set(r.spans.split(",")) for r in got)


def test_pii_odd(odd, none):
    assert pii.personal_data(odd).count() == len(odd_rows()) and pii.personal_data(none).count() == 0
    plan = pii.personal_data(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian", plan)


# -- pipeline ------------------------------------------------------------------------------------------------------------


def test_pipeline_equals_its_parts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").toPandas()
    kept = docs[docs.text.str.contains(r"[^\W\d_]")]
    kept = kept.sort_values("doc_id").drop_duplicates("text", keep="last").sort_values("doc_id")
    # all pairs by plain sets; the smallest of a group stays
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in (t.lower().split() for t in kept.text)]
    links = [(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets[:i]) if 5 * len(a & b) >= 4 * len(a | b)]
    group = list(range(len(sets)))
    for i, j in links:
        low, high = sorted((group[i], group[j]))
        group = [low if g == high else g for g in group]
    kept = kept.iloc[sorted(set(group))]
    got = corpus_pipeline.run(spark, sf).toPandas()
    assert got.intact.all() and set(got.doc_id) <= set(kept.doc_id)
    mixed = mixing.mix_documents(spark.createDataFrame(kept)).toPandas()
    assert sorted(got.doc_id) == sorted(mixed.doc_id)
    assert [x for x, _ in corpus_pipeline.STAGES] == ["language", "exact_dedup", "near_dedup", "mixture", "tokens"]
