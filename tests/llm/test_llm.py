"""The training-data operators against brute-force versions, round trips, held-out accuracy and odd tables."""

import base64
import gzip
import hashlib
import random
import re
import urllib.parse
import uuid

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from biomesheaf.llm import catalog, decontamination, embeddings, graph, langid, licenses, lm, minhash, mixing, pii, toxicity, warc
from biomesheaf.llm.shared import fold
from biomesheaf.llm.words import hash_words, shingles
from checks.compare import DATA, _rows, duck

SMALL = f"{DATA}/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text):
    return (text or "").encode().lower().split()


def shingle_set(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(ids, linked):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in ids:
        for b in ids:
            if a < b and linked(a, b):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def odd(spark):
    """Nulls, empty and blank texts, a long text, repeated rows, no letters, a null id."""
    long = " ".join(f"w{i % 977}" for i in range(60_000))
    rows = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (5, "one"), (6, long), (7, long), (8, "1234 5678"), (None, "alone here")]
    return documents(spark, rows).withColumns({"_row": F.lit(1), "_key": F.lit("x"), "node": F.lit(2), "id": F.lit(3), "label": F.lit("y")})


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_query_agrees_with_sql(spark, name):
    df = catalog.QUERIES[name](spark, SMALL)
    got = _rows(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(SMALL).execute(catalog.ORACLES[name])
    assert got == _rows([d[0] for d in cur.description], cur.fetchall())


def test_words_are_those_of_the_contract():
    texts = ["A b\x0bc\x1fd", "", "Ä Ö", " x ", "é" * 5, "a"]
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    h, counts = hash_words(np.frombuffer(b"".join(data), np.uint8), offsets)
    plain = [re.findall(rb"[^\x20\x09-\x0D]+", d.lower()) for d in data]
    assert counts.tolist() == [len(p) for p in plain]
    flat = [w for p in plain for w in p]
    assert all((flat[i] == flat[j]) == (h[i] == h[j]) for i in range(len(flat)) for j in range(len(flat)))
    g, number = shingles(h, counts, 2)
    assert number.tolist() == [max(len(p) - 1, min(len(p), 1)) for p in plain] and len(g) == number.sum()


def test_near_duplicates_equal_brute_force(spark):
    rng = random.Random(4)
    rows, n = [], 0
    for _ in range(12):
        base = [rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.choice([4, 30, 120, 200]))]
        for _ in range(rng.randrange(1, 7)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = f"z{rng.randrange(99)}"
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n, None), (n + 1, ""), (n + 2, "  "), (n + 3, rows[0][1].upper())]
    sets = {i: shingle_set(t) for i, t in rows}
    want = brute_components(list(sets), lambda a, b: bool(sets[a]) and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]))
    got = {r.id: (r.n_shingles, r.component_id, r.kept) for r in minhash.near_duplicates(documents(spark, rows)).collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_index_keys_cover_the_distance():
    rng = np.random.default_rng(1)
    keys = minhash.index_keys()
    for _ in range(300):
        differs = np.zeros(minhash.INDEXED, bool)
        differs[rng.choice(minhash.INDEXED, minhash.CHUNKS * (minhash.ERRORS + 1) - 1, replace=False)] = True
        assert any(not differs[k].any() for k in keys)


def test_index_covers_the_reach_of_each_similarity():
    for similarity in (0.8, 0.85, 0.9):
        indexed, chunks = minhash.index_shape(similarity)
        assert chunks * (minhash.ERRORS + 1) - 1 >= minhash.reach(indexed, similarity)
        assert {p for held in minhash.index_keys(similarity) for p in held} == set(range(indexed))


def test_search_keeps_pairs_of_a_bucket_beyond_the_guaranteed_distance():
    """One chunk is equal, all other indexed parts differ: the pair meets, and over all parts it is within reach."""
    sig = np.zeros((2, minhash.PARTS), np.uint8)
    indexed, chunks = minhash.index_shape(0.85)
    sig[1, indexed // chunks : indexed] = 1
    assert indexed - indexed // chunks > chunks * (minhash.ERRORS + 1) - 1
    rows = {"k": [0, 0], "key": [5, 5], "i": [0, 0], "j": [0, 0], "node": [1, 2], "component": [1, 2], "block": [0, 0]}
    batch = pa.RecordBatch.from_arrays([*map(pa.array, rows.values()), pa.array([s.tobytes() for s in sig])], [*rows, "sig"])
    found = [tuple(r.values()) for b in minhash._search(0.85, False)(iter([batch])) for r in b.to_pylist()]
    assert found == [(1, 2, indexed - indexed // chunks)]


def test_near_dedup_stage_equals_brute_force_at_80(spark):
    rng = random.Random(8)
    rows = []
    for _ in range(60):
        base = [rng.choice("abcdefghij") + str(rng.randrange(900)) for _ in range(200)]
        rows.append((len(rows), " ".join(base)))
        for changed in (3, 4, 5):  # Jaccard of about 0.86, 0.82 and 0.78
            copy = list(base)
            for at in range(changed):
                copy[20 + 30 * at] = f"z{rng.randrange(10_000)}"
            rows.append((len(rows), " ".join(copy)))
    sets = {i: shingle_set(t) for i, t in rows}
    want = brute_components(list(sets), lambda a, b: 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]))
    between = [i for i in sets if i % 4 and 80 <= 100 * len(sets[i] & sets[i - i % 4]) / len(sets[i] | sets[i - i % 4]) < 85]
    assert len(between) >= 60
    got = {r.doc_id for r in corpus_pipeline.near_dedup(spark, documents(spark, rows), "").collect()}
    assert got == {i for i in want if want[i] == i}


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(40, 8))
    vectors = [(centres[i % 40] + rng.normal(size=8) * rng.choice([0.0, 0.1, 0.3])).astype(np.float32) for i in range(400)]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(400, None), (401, [0.0] * 8), (402, [float("nan")] * 8), (403, [1.0] * 3), (404, rows[0][1]), (405, (2 * vectors[0]).tolist())]
    ok = {i: np.array(v, np.float64) / np.linalg.norm(np.array(v, np.float64)) for i, v in rows if v and len(v) == 8 and np.isfinite(v).all() and any(v)}
    want = brute_components([i for i, _ in rows], lambda a, b: a in ok and b in ok and ok[a] @ ok[b] >= 0.95)
    n = {i: sum(1 for j in ok if j != i and ok[i] @ ok[j] >= 0.95) if i in ok else 0 for i, _ in rows}
    got = {r.id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()}
    assert all(got[i][0] <= n[i] for i in n)
    assert sum(g[0] for g in got.values()) >= 0.97 * sum(n.values())
    assert sum(got[i] == (n[i], want[i]) for i in n) >= 0.95 * len(n)


def test_vectors_of_every_length_and_size_are_searched(spark):
    rng = np.random.default_rng(8)
    rows, sizes = [], [1.0, 1e200, 1e-200]
    for i in range(180):
        base = np.random.default_rng(i % 9).normal(size=[3, 8, 5][i % 3])
        rows.append((i, ((base + rng.normal(size=len(base)) * 0.02) * sizes[i % 4 % 3]).tolist()))
    rows += [(200, [1.0]), (201, [2.0]), (202, [-1.0]), (203, []), (204, None)]
    largest = {i: max(map(abs, v)) for i, v in rows if v}
    ok = {i: np.array(v) / largest[i] / np.linalg.norm(np.array(v) / largest[i]) for i, v in rows if v}
    near = lambda a, b: a in ok and b in ok and len(ok[a]) == len(ok[b]) and ok[a] @ ok[b] >= 0.95
    want = brute_components([i for i, _ in rows], near)
    n = {i: sum(1 for j, _ in rows if j != i and near(i, j)) for i, _ in rows}
    got = {r.id: (r.n_links, r.component_id) for r in embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    assert got == {i: (n[i], want[i]) for i, _ in rows}


def test_multi_sequence_visits_nearest_cells():
    rng = np.random.default_rng(2)
    a, b = rng.random(9), rng.random(7)
    sums = (a[:, None] + b[None]).ravel()
    assert [round(sums[c], 12) for c in embeddings.multi_sequence(a, b, 30)] == [round(x, 12) for x in np.sort(sums)[:30]]
    assert len(embeddings.multi_sequence(a, b, 1000)) == 63


def test_alignment_scores():
    def plain(x, y):
        h = np.zeros((len(x) + 1, len(y) + 1))
        for i in range(len(x)):
            for j in range(len(y)):
                h[i + 1, j + 1] = max(0, h[i, j] + (2 if x[i] == y[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
        return h.max()

    rng = np.random.default_rng(5)
    pairs = [(rng.integers(2, 6, rng.integers(1, 12)).astype(np.uint64), rng.integers(2, 6, rng.integers(1, 20)).astype(np.uint64)) for _ in range(40)]
    assert decontamination.align([p[0] for p in pairs], [p[1] for p in pairs]).tolist() == [plain(*p) for p in pairs]


def test_leaks_exact_edited_short_and_clean(spark):
    rng = random.Random(9)
    text = lambda n: " ".join(rng.choice("abcdefgh") + str(rng.randrange(300)) for _ in range(n))
    items = [(1, text(30)), (2, text(50)), (3, "tiny item"), (4, None), (5, "")]
    edited = items[1][1].split()
    edited[7], edited[20:22], edited[40] = "x", ["y", "z", "q"], "w"
    rows = [(1, text(100) + " " + items[0][1].upper() + " " + text(60)), (2, " ".join(edited)), (3, text(400)), (4, None), (5, "a tiny item here"), (6, "")]
    rows += [(10 + i, text(5) + " " + items[0][1]) for i in range(30)]
    found = decontamination.leaks(documents(spark, rows), spark.createDataFrame(items, "item_id long, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == {(1, 1), (2, 2), (5, 3)} | {(10 + i, 1) for i in range(30)}
    assert decontamination.best_leak(found).count() == 33


def test_items_without_an_id_are_leaks_too(spark, tmp_path):
    text = [" ".join(f"{c}{i}" for i in range(20)) for c in "abc"]
    items = spark.createDataFrame([(None, text[0]), (None, text[1]), (None, text[0]), (3, text[2])], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = documents(spark, [(1, "x " + text[0]), (2, text[1] + " y"), (3, text[2]), (4, "nothing of the kind in here")])
    got = sorted((r.doc_id, r.item_id, r.score) for r in decontamination.leaks(docs, items).collect())
    assert got == [(1, None, 1.0), (2, None, 1.0), (3, 3, 1.0)]
    assert [r.doc_id for r in corpus_pipeline.benchmark_decontamination(spark, docs, str(tmp_path)).collect()] == [4]


def plain_alignment(x, y):
    h = np.zeros((len(x) + 1, len(y) + 1))
    for i in range(len(x)):
        for j in range(len(y)):
            h[i + 1, j + 1] = max(0, h[i, j] + (2 if x[i] == y[j] else -1), h[i, j + 1] - 1, h[i + 1, j] - 1)
    return h.max()


def test_leaks_split_by_foreign_words_equal_plain_alignment(spark):
    rng = random.Random(12)
    text = lambda n: [rng.choice("abcdefgh") + str(rng.randrange(3000)) for _ in range(n)]
    items, rows = {}, {}
    for k, (length, gap) in enumerate([(59, 30), (40, 25), (20, 15), (30, 0), (50, 38), (50, 44), (20, 17)]):
        item = text(length)
        items[k] = item
        rows[k] = text(150) + item[: length // 2] + text(gap) + item[length // 2 :] + text(150)
    want = {k: plain_alignment(items[k], rows[k]) / (2 * len(items[k])) for k in items}
    assert min(want.values()) < 0.6 < sorted(want.values())[2]
    found = decontamination.leaks(documents(spark, [(k, " ".join(t)) for k, t in rows.items()]), spark.createDataFrame([(k, " ".join(t)) for k, t in items.items()], "item_id long, text string"))
    got = {(r.doc_id, r.item_id): r.score for r in found.collect()}
    assert got == pytest.approx({(k, k): s for k, s in want.items() if s >= 0.6})


SAMPLE = (
    "mail a.b+c@x-y.example.com, or @no or a@b; ip 10.0.0.255 not 10.0.0.256, v1.2.3.4.5.6.7.8 card 4111 1111-1111 1111, 4111111111111112 "
    "+49 (30) 123-4567. +1 call é 🙂 x@y.zz_d@e.fr 00000000010.1.1.1"
)


def test_base_spans_equal_plain_patterns():
    def plain(text):
        out = [("email", m.start(), m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = re.sub(r"\D", "", m[0])
            if 13 <= len(d) <= 19 and pii._luhn(d):
                out.append(("card", m.start(), m.end()))
        return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(re.sub(r"\D", "", m[0])) <= 15]

    rng = random.Random(1)
    texts = [SAMPLE] + ["".join(rng.choice("a@.1 +-(4)0é\n_%") for _ in range(60)) for _ in range(3000)]
    assert all(pii.base_spans(t) == plain(t) for t in texts)
    assert pii._luhn("4111111111111111") and not pii._luhn("4111111111111112")


def test_bootstrap_finds_unseen_identifiers_and_masks(spark):
    rows = [(i, f"please write to mail{i}@x.example.com and call") for i in range(40)]
    rows += [(50 + i, f"please write to AKIA{i:02d}99ZZ{i:02d} and call") for i in range(8)] + [(90, "in 20010203 nothing"), (91, None), (92, SAMPLE)]
    found = {r["_row"]["doc_id"]: r for r in pii.located(documents(spark, rows)).withColumn("m", pii.masked(F.col("_row.text"), F.col("_spans"))).collect()}
    assert [[tuple(s) for s in found[50 + i]["_spans"]] for i in range(8)] == [[("id", 16, 28)]] * 8
    assert found[53]["m"] == "please write to <id> and call" and found[7]["m"] == "please write to <email> and call"
    assert not found[90]["_spans"] and not found[91]["_spans"] and found[91]["m"] is None
    assert len(found) == len(rows)


def test_tokens_and_contexts_of_any_length():
    token = "A" * 5000 + "1234"
    text = f"key: {token}{' ' * 500}after"
    assert list(pii._others(text, [])) == [(5, 5 + len(token), token.lower(), ["L:key:", "R:after", f"S:u{len(token)}"])]
    assert pii._context("x" * 300 + " " * 300 + "12345678", 600, 608) == ["L:" + "x" * 300]
    before = re.compile(r"([^\W\d_]+)[\s\"'(\[]*([:=#]?)[\s\"'(\[]*\Z")
    rng = random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choice("aé²1_ :=#\"'([\n.") for _ in range(rng.randrange(12)))
        m = before.search(text)
        assert pii._context(text, len(text), len(text)) == ([f"L:{m[1].lower()}{m[2]}"] if m else [])


def test_damaged_payloads_are_an_error_on_reading(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i % 3}") for i in range(60)], "page_id long, url string, html string")
    chunks = warc.read_chunks(warc.write_archives(pages, str(tmp_path / "w")))
    got = warc.read_pages(chunks).collect()
    assert len(got) == 60 and sorted(r.page_id for r in got if r.record_type == "response") == [57, 58, 59]
    assert {(r.page_id, r.refers_to) for r in got if r.refers_to is not None} == {(i, 57 + i % 3) for i in range(57)}
    with pytest.raises(Exception, match="not that of its digest: page 58"):
        warc.read_pages(chunks.withColumn("digest_so_far", F.when(F.col("record_id") == "58", "A").otherwise(F.col("digest_so_far")))).collect()


def test_archives_round_trip_in_chunks(spark, tmp_path):
    big = "xyé" * 5000
    rows = [(1, "http://a/é b\r\nc", big), (2, "u", big), (3, None, None), (4, "u", ""), (5, "u", "<p>"), (5, "u", "<p>"), (None, "u", "n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    manifest = warc.write_archives(pages, str(tmp_path / "w"), chunk=1000)
    chunks = warc.read_chunks(manifest, chunk=1000)
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.payload_digest) for r in warc.read_pages(chunks).collect()}
    sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
    assert got == {
        (1, "revisit", 2, 20000, sha(big)), (2, "response", None, 20000, sha(big)), (3, "revisit", 4, 0, sha("")),
        (4, "response", None, 0, sha("")), (5, "response", None, 3, sha("<p>")), (None, "response", None, 1, sha("n")),
    }
    mine = chunks.where("record_id = '2'").orderBy("chunk_no").collect()
    assert len(mine) == 20 and b"".join(bytes(r.chunk) for r in mine) == big.encode() and [r.last for r in mine] == [False] * 19 + [True]
    whole = b"".join(gzip.decompress(open(urllib.parse.urlparse(r.file).path, "rb").read()) for r in manifest.collect())
    assert whole.count(b"WARC/1.1\r\n") == 7 and whole.count(b"\r\n\r\n") >= 14


def test_language_is_told_on_held_out_rows(spark):
    g = catalog.QUERIES["op7_language_id"](spark, f"{DATA}/sf0.01").join(spark.read.parquet(f"{DATA}/sf0.01/documents.parquet"), "doc_id")
    held = g.where("held_out").select((F.col("lang_pred") == F.col("lang")).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert held > 0.98
    model = langid.fit(documents(spark, [(i, "the thing and that", ) for i in range(20)]))
    got = {r["_row"]["doc_id"]: (r["_lang"], r["_rejected"]) for r in langid.identified(odd(spark), model).where("_row.doc_id is not null").collect()}
    assert got[1] == got[2] == got[3] == got[8] == ("und", True) and got[4][0] == "en"


def test_toxicity_on_held_out_rows(spark):
    folder = f"{DATA}/sf0.1"
    g = catalog.QUERIES["op4_toxicity"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").where("held_out").toPandas()
    toxic, clean = g[g.toxic == 1].score.to_numpy(), g[g.toxic == 0].score.to_numpy()
    assert (toxic[:, None] > clean[None]).mean() > 0.95 and (g[g.toxic == 0].predicted == 0).mean() > 0.99
    none = toxicity.fit(odd(spark), spark.createDataFrame([], "doc_id long, toxic int"))
    assert odd(spark).withColumn("p", toxicity.toxicity(none)).where("p > 0.5 or p is null").count() == 0


def test_pairs_count_beyond_their_terms():
    """An insult at a group is toxic, either alone is not: the logit of the pair exceeds the sum of its terms'."""
    model = toxicity.FactorizationMachine(np.arange(2), np.ones(2), np.array([-1.0, -1.0]), np.array([[2.0], [2.0]]), -1.0)
    logit, _ = toxicity._logits(model, np.array([0, 1, 0, 1]), np.ones(4), np.array([0, 1, 2, 2]), 3)
    assert logit[0] < 0 and logit[1] < 0 and logit[2] > 0


def balanced_pairs(spark, n=480):
    """Two insults, two groups, each in half of the toxic and half of the clean texts: only their pairs tell."""
    rng, rows = random.Random(5), []
    for i in range(n):
        insult, group = rng.choice("pq"), rng.choice("xy")
        filler = [f"filler{rng.randrange(60)}" for _ in range(12)]
        words = [*filler, f"{insult}{insult}insult", f"{group}{group}group"]
        rng.shuffle(words)
        rows.append((i, " ".join(words), int((insult == "p") == (group == "x"))))
    return documents(spark, [r[:2] for r in rows]), spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")


def test_fit_learns_pairs_of_balanced_terms(spark):
    docs, labels = balanced_pairs(spark)
    model = toxicity.fit(docs, labels.where("doc_id % 4 <> 0"))
    got = docs.where("doc_id % 4 = 0").withColumn("p", toxicity.toxicity(model)).join(labels, "doc_id").toPandas()
    assert ((got.p >= 0.5) == (got.toxic == 1)).mean() > 0.95


def test_fit_does_not_depend_on_row_order_and_takes_one_text_an_id(spark):
    docs, labels = balanced_pairs(spark, 80)
    labels = labels.unionByName(spark.createDataFrame([(1, None), (None, 1), (900, 1)], "doc_id long, toxic int"))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs.unionByName(docs).repartition(7).orderBy(F.rand(3)), labels)
    assert (a.buckets == b.buckets).all() and (a.weight == b.weight).all() and (a.factors == b.factors).all() and a.bias == b.bias
    scored = odd(spark).withColumn("p", toxicity.toxicity(a)).collect()
    assert len(scored) == 10 and all(0 <= r.p <= 1 for r in scored) and len({r.p for r in scored if r.doc_id in (1, 2, 3)}) == 1
    assert len({r.p for r in scored if r.doc_id == 5}) == 1 and len({r.p for r in scored if r.doc_id in (6, 7)}) == 1
    empty = documents(spark, [])
    assert empty.withColumn("p", toxicity.toxicity(toxicity.fit(empty, labels))).count() == 0


def test_lm_base_score_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = {r.doc_id: r for r in catalog.QUERIES["op3_lm_scores"](spark, SMALL).collect()}
    rows = docs.select("doc_id", "text", (fold("doc_id", 7) == 2).alias("held")).collect()
    counts: dict = {}
    for r in rows:
        if not r.held:
            for w in [*words(r.text), None]:
                counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    for r in rows:
        own = [*words(r.text), None]
        base = sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in own)
        g = got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (r.held, len(own), sum(w in counts for w in own), n)
        assert abs(g.base_score - base) < 1e-6 * abs(base) and g.score < 0


def test_lm_learns_from_every_text_once(spark, tmp_path, monkeypatch):
    real, folder = lm._train, str(tmp_path)

    def noted(model, rate):
        inner = real(model, rate)

        def train(batches):
            def seen():
                for batch in batches:
                    with open(f"{folder}/{uuid.uuid4().hex}", "w") as out:
                        out.writelines(f"{len(x.as_py()) // 2}\n" for x in batch.column("ids"))
                    yield batch

            return inner(seen())

        return train

    monkeypatch.setattr(lm, "_train", noted)
    rows = spark.createDataFrame([(i, np.full(i + 2, 7, np.uint16).tobytes()) for i in range(200)], "_row long, ids binary")
    lm.train(rows, 16)
    assert sorted(int(n) for f in tmp_path.iterdir() for n in f.read_text().split()) == [i + 2 for i in range(200)]


def test_lm_gradient_and_windows():
    places, inside, text = lm._windows(np.array([0, 2, 100, 103]))
    late = inside[:, lm.CONTEXT :]
    seen = places[:, lm.CONTEXT :][late]
    assert sorted(seen.tolist()) == [0, *range(2, 99), 100, 101]
    model = lm.SubwordModel(np.arange(9), np.arange(9), np.zeros(9), {k: w.astype(np.float64) for k, w in lm.SubwordModel.fresh().items()})
    rng = np.random.default_rng(0)
    tokens, ins, target = rng.integers(0, 9, (3, lm.WINDOW)), np.ones((3, lm.WINDOW), bool), rng.integers(0, lm.CLASSES, (3, lm.SCORED))

    def loss():
        z = model.forward(tokens, ins)["z"]
        return -np.mean(np.take_along_axis(z, target[:, :, None], 2)[:, :, 0] - np.log(np.exp(z).sum(2)))

    before, taken = loss(), {}
    model._move = lambda name, at, g, rate: taken.setdefault(name, (at, g))
    model.step(tokens, ins, target, 0.1)
    for name in ("query", "key", "value", "out", "position"):
        w, at = model.weights[name], (1, 2)
        w[at] += 1e-5
        assert abs((loss() - before) / 1e-5 - taken[name][1][at]) < 1e-5
        w[at] -= 1e-5


def test_lm_class_scores_are_held_a_part_at_a_time():
    """No array of all places and classes is made; the gradient of tokens that repeat, in windows cut short, is that of the whole loss."""
    weights = {k: w.astype(np.float64) for k, w in lm.SubwordModel.fresh().items()}
    model = lm.SubwordModel(np.arange(9), np.arange(9), np.zeros(9), weights)
    rng = np.random.default_rng(1)
    h = rng.normal(size=(2 * lm.PLACES + 5, lm.WIDTH))
    parts = [(at, len(z), z.copy()) for at, z in model.class_scores(h)]
    assert [n for _, n, _ in parts] == [lm.PLACES, lm.PLACES, 5] and list(model.class_scores(h[:0])) == []
    assert all(np.allclose(z, h[at] @ weights["out"] + weights["bias"]) for at, _, z in parts)
    _, inside, _ = lm._windows(np.array([0, 3, 60, 62, 2000]))
    tokens, target = rng.integers(0, 9, inside.shape), rng.integers(0, lm.CLASSES, (len(inside), lm.SCORED))
    scored = inside[:, lm.CONTEXT :]

    def loss():
        z = model.forward(tokens, inside)["z"]
        return -((np.take_along_axis(z, target[:, :, None], 2)[:, :, 0] - np.log(np.exp(z).sum(2))) * scored).sum() / scored.sum()

    before, taken = loss(), {}
    model._move = lambda name, at, g, rate: taken.setdefault(name, (at, g))
    model.step(tokens, inside, target, 0.1)
    at, g = taken["token"]
    assert at.tolist() == sorted(set(tokens.ravel().tolist()))
    for i in range(9):
        weights["token"][i, 2] += 1e-5
        assert abs((loss() - before) / 1e-5 - g[i, 2]) < 1e-5
        weights["token"][i, 2] -= 1e-5


def test_raking_meets_its_targets(spark):
    docs = spark.createDataFrame([(i, "w " * (i % 7 + 1), "en" if i % 3 else "de", f"s{i % 4}", 0) for i in range(4000)] + [(9999, None, None, None, 0)], DOCS)
    topic = F.when(F.col("doc_id") % 5 == 0, "a").otherwise("b")
    out = mixing.raked(docs, {"en": 0.5, "de": 0.5}, {"a": 0.3, "b": 0.7}, keep=0.2, iterations=30, topic=topic).where("_tokens > 0").toPandas()
    mass = out["_tokens"] * out["_weight"]
    share = lambda key: (mass.groupby(out[key]).sum() / mass.sum()).to_dict()
    assert share("_lang") == pytest.approx({"en": 0.5, "de": 0.5}, abs=1e-6) and share("_topic") == pytest.approx({"a": 0.3, "b": 0.7}, abs=1e-6)
    assert abs((out["_tokens"] * out["_probability"]).sum() / out["_tokens"].sum() - 0.2) < 1e-6
    assert abs(out.loc[out["_kept"], "_tokens"].sum() / out["_tokens"].sum() - 0.2) < 0.05
    assert mixing.mix(docs.where("false")).count() == 0


def test_lm_attention_equals_brute_force_without_keys_and_values_of_all_places():
    model = lm.SubwordModel(np.arange(9), np.arange(9), np.zeros(9), {k: w.astype(np.float64) for k, w in lm.SubwordModel.fresh().items()})
    w, (_, inside, _) = model.weights, lm._windows(np.array([0, 1, 4, 60, 62, 300]))
    tokens = np.random.default_rng(2).integers(0, 9, inside.shape)
    found = model.attend(tokens, inside)
    h = found["h"].reshape(len(tokens), lm.SCORED, -1)
    for k in range(len(tokens)):
        x = w["token"][tokens[k]] + w["position"]
        for i in np.flatnonzero(inside[k, lm.CONTEXT :]):
            seen = [j for j in range(lm.CONTEXT + i + 1) if inside[k, j]]
            e = np.exp(x[seen] @ w["key"] @ (x[lm.CONTEXT + i] @ w["query"]) / np.sqrt(lm.WIDTH))
            assert np.allclose(h[k, i, : lm.WIDTH], e @ (x[seen] @ w["value"]) / e.sum() + x[lm.CONTEXT + i])
    late = len(tokens) * lm.SCORED
    assert all(len(v.reshape(-1, v.shape[-1])) <= late for name, v in found.items() if name != "x" and v.ndim > 1)


def test_lm_words_are_hashed_once_for_all_sums(spark):
    rows = [(1, "a b b c"), (2, "a d"), (2, "a d"), (3, None), (None, "b b e f f"), (5, "g a"), (5, "h")]
    docs = documents(spark, rows)
    found = lm.scores(docs, F.coalesce(F.col("doc_id"), F.lit(0)) != 5, head_words=3, rounds=1)
    assert found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("MapInArrow") == 1
    counts: dict = {}
    for d, t in rows:
        for w in [*words(t), None] if d != 5 else []:
            counts[w] = counts.get(w, 0) + 1
    n, v = sum(counts.values()), len(counts)
    want = []
    for d, t in rows:
        own = [*words(t), None]
        want.append((str(d), len(own), sum(w in counts for w in own), n, round(sum(np.log10((counts.get(w, 0) + 1) / (n + v + 1)) for w in own), 9)))
    got = [(str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 9)) for r in found.collect()]
    assert sorted(got) == sorted(want)


def test_licences_whole_and_in_lines(spark):
    mit = licenses.TEMPLATES[2][1]
    rows = [(1, "text\nReleased under the MIT License.\nmore"), (2, mit.upper()), (3, f"first part\n\n{mit}\n\nend of it"), (4, "nothing of the kind"), (5, None), (6, "")]
    got = {r.doc_id: (r.license, r.n_segments) for r in licenses.license_matches(documents(spark, rows)).collect()}
    assert got[1] == ("MIT", 1) and got[2][0] == "MIT" and got[3][0] == "MIT" and set(got) == {1, 2, 3}
    assert licenses.license_matches(odd(spark)).count() == 0


def test_licences_of_repeated_rows_and_rows_without_an_id(spark):
    mit, half = licenses.TEMPLATES[2][1], " ".join(licenses.TEMPLATES[2][1].split()[: len(licenses.TEMPLATES[2][1].split()) // 4])
    line = "Released under the MIT License."
    rows = [(1, mit), (1, mit), (2, line), (2, f"text\n{line}\nmore"), (2, line), (3, half), (3, half), (4, "none of it")]
    rows += [(None, line), (None, line), (None, f"{line}\nand here is much more text of another kind")]
    got = licenses.license_matches(documents(spark, rows)).collect()
    assert all(0.8 <= r.dice <= 1.0 for r in got)
    # With one word before and after the line the whole text scores exactly 0.8.
    assert sorted((r.doc_id or 0, r.license, r.n_segments) for r in got if r.doc_id != 1) == [(0, "MIT", 1), (0, "MIT", 1), (2, "MIT", 3)]
    assert [(r.license, r.dice) for r in got if r.doc_id == 1] == [("MIT", 1.0)]
    con = duckdb.connect()
    frame = documents(spark, rows).toPandas()
    con.register("documents", frame)
    cells = con.execute(catalog.ORACLES["op10_license_scan"]).fetchall()
    key = lambda r: (-1 if r[0] is None else int(r[0]), r[1], round(r[2], 9), r[3])
    assert sorted(map(key, cells)) == sorted(map(key, (tuple(r) for r in got)))


def test_odd_tables_pass_through_every_stage(spark, tmp_path):
    items = spark.createDataFrame([(1, None), (2, "one two three four five six"), (2, "one two three four five six")], "item_id long, text string")
    items.write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = odd(spark)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        assert set(docs.columns) <= set(out.columns), name
        empty = stage(spark, docs.where("false"), str(tmp_path))
        assert empty.count() == 0, name
    near = corpus_pipeline.near_dedup(spark, docs, str(tmp_path))
    assert sorted((r.doc_id for r in near.collect() if r.doc_id is not None)) == [1, 2, 3, 4, 6, 8]


def test_pipeline_equals_brute_force_where_it_is_exact(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    sets = {i: shingle_set(t) for i, t in texts.items()}
    roots = brute_components(list(sets), lambda a, b: bool(sets[a] & sets[b]) and 100 * len(sets[a] & sets[b]) >= corpus_pipeline.SIMILARITY * len(sets[a] | sets[b]))
    kept = {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, SMALL).collect()}
    assert kept == {i for i in roots if roots[i] == i}
    items = [" ".join(w.decode() for w in words(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in corpus_pipeline.benchmark_decontamination(spark, docs, SMALL).collect()}
    whole = {i for i, t in texts.items() if any(f" {x} " in " " + " ".join(w.decode() for w in words(t)) + " " for x in items)}
    assert not clean & whole and len(clean) >= len(texts) - 3 * len(whole) - 2
    out = corpus_pipeline.run(spark, SMALL)
    assert set(docs.columns) <= set(out.columns) and 0 < out.count() < docs.count()
    assert not [r.text for r in out.select("text").collect() if "@" in r.text and pii.base_spans(r.text)]
