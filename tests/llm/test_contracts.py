"""The queries themselves on small tables: columns, types, hold-out rules, what is never read, and brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import language, registry
from tests.llm import test_links as links
from tests.llm import test_text_operators as texts

WORDS = {"en": "the of and to in is that for it was on are with as his they".split(), "de": "der die und in den von zu das mit sich des auf für ist im dem".split()}
COLUMNS = {
    "op1_html_text": {"page_id": "bigint", "url": "string", "text": "string", "n_chars": "bigint"},
    "op2_ngram_jaccard": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op4_quality": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op5_language_id": {"doc_id": "bigint", "held_out": "boolean", "lang_pred": "string", "score": "double"},
    "op6_best_fit_packing": {"doc_id": "bigint", "piece": "int", "start": "bigint", "length": "bigint", "ids_crc32": "bigint", "sequence_id": "bigint", "offset": "bigint"},
    "op7_vector_dedup": {"vec_id": "bigint", "n_links": "bigint", "component_id": "bigint", "kept": "boolean"},
    "op8_byte_bpe": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op9_pii": {"doc_id": "bigint", "n_email": "bigint", "n_ip": "bigint", "n_card": "bigint", "n_phone": "bigint", "base_sha256": "string", "spans": "string"},
    "op10_fingerprint": {"doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string", "near_edited": "double", "near_next": "double"},
}


def documents():
    rng = random.Random(9)
    rows = []
    for k in range(160):
        lang = rng.choice(("en", "de"))
        good = rng.random() < 0.6
        body = " ".join(rng.choices(WORDS[lang], k=rng.randint(5, 60))) if good else "buy !!! $$$ " * rng.randint(3, 20)
        if k % 9 == 0:
            body += f" mail a{k}@b.org or +49 30 {k:07d}, 10.0.0.{k}, 4111 1111 1111 1111"
        rows.append((3 * k, body, lang, "web", int(good)))
    extra = [rows[0][1], rows[0][1], None, "", " \n", "ß" * 3000, "word " * 9000, "a"]
    return rows + [(1000 + k, t, None if k % 2 else "en", None, 1) for k, t in enumerate(extra)]


def crc_mod(doc_id, m):
    return zlib.crc32(str(doc_id).encode()) % m


def write(spark, folder, rows, flip=False, lang=None):
    """Tables of ``rows``. flip: labels of held-out documents are turned round; lang: what they are said to be in."""
    docs = [(i, t, lang if lang and crc_mod(i, 4) == 2 else v, s, len(t or "")) for i, t, v, s, _ in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 1 - q if flip and crc_mod(i, 5) == 0 else q, 0) for i, *_, q in rows]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    pages = [(k, f"u{k}", f"<html><body><nav><a href=x>Home</a></nav><article><h1>T{k}</h1><p>{(t or '')[:300]} End.</p></article><footer>Copyright</footer></body></html>") for k, (_, t, *_) in enumerate(rows[:40])]
    pages.append((99, "u", None))
    spark.createDataFrame(pages, "page_id long, url string, html string").write.parquet(f"{folder}/pages.parquet")
    vectors = [(i, [float(x) for x in v], z) for i, v, z in links.vector_rows(4)[:80]]
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").write.parquet(f"{folder}/embeddings.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def rows():
    return documents()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, rows):
    return write(spark, tmp_path_factory.mktemp("contract"), rows)


@pytest.fixture(scope="module")
def results(spark, folder):
    return {name: registry.QUERIES[name](spark, folder) for name in COLUMNS}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(results, rows, name):
    kinds = dict(results[name].dtypes)
    assert {c: kinds[c] for c in COLUMNS[name]} == COLUMNS[name]
    n = {"op1_html_text": 41, "op7_vector_dedup": 80}.get(name, len(rows))
    assert results[name].count() >= n if name == "op6_best_fit_packing" else results[name].count() == n


def test_main_texts(results, rows):
    for r in results["op1_html_text"].collect():
        assert r["n_chars"] == len(r["text"])
        if r["page_id"] == 99:
            assert r["text"] == ""
        elif r["page_id"] < 40:
            assert "Home" not in r["text"] and "Copyright" not in r["text"] and r["text"].endswith("End.")


def test_components(results, rows):
    sets = links.shingle_sets([(i, t) for i, t, *_ in rows])
    want = links.roots(sets, links.links(sets))
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in results["op2_ngram_jaccard"].collect()} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_classifiers_hold_out_what_they_must(spark, results, rows, tmp_path):
    other = write(spark, tmp_path, rows, flip=True, lang="xx")
    for name, m, kept in (("op4_quality", 5, 0), ("op5_language_id", 4, 2)):
        first, second = (sorted(map(tuple, df.collect())) for df in (results[name], registry.QUERIES[name](spark, other)))
        assert first == second  # labels of held-out rows are not read
        assert all(r[1] == (crc_mod(r[0], m) == kept) for r in first)
    scores = {r["doc_id"]: r for r in results["op4_quality"].collect()}
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in scores.values())
    right = [scores[i]["predicted"] == q for i, t, *_, q in rows if scores[i]["held_out"] and i < 1000]
    assert np.mean(right) > 0.9


def test_languages_equal_brute_force(results, rows):
    import math
    from collections import Counter

    counts, docs = {}, Counter()
    for i, t, lang, *_ in rows:
        if t is not None and lang is not None and crc_mod(i, 4) != 2:
            at, n = language.cells(t)
            c = counts.setdefault(lang, Counter())
            for a, k in zip(at.tolist(), n.tolist()):
                c[a] += k
            docs[lang] += 1
    total = sum(docs.values())
    for r in results["op5_language_id"].collect():
        text = dict((i, t) for i, t, *_ in rows)[r["doc_id"]] or ""
        at, n = language.cells(text)
        if not len(at):
            assert (r["lang_pred"], r["score"]) == (language.UNKNOWN, 0.0)
            continue
        size = 1 << language.BITS
        sums = {
            g: math.log(docs[g] / total) + sum(k * math.log((c[a] + language.SMOOTHING) / (sum(c.values()) + language.SMOOTHING * size)) for a, k in zip(at.tolist(), n.tolist()))
            for g, c in counts.items()
        }
        best = max(sums.values())
        assert math.isclose(sums[r["lang_pred"]], best, rel_tol=1e-9) and 0 <= r["score"] <= 1


def test_packing_is_gapless_and_whole(results, rows):
    pieces = results["op6_best_fit_packing"].toPandas()
    assert (pieces.groupby("sequence_id").length.sum() <= 4096).all()
    for _, g in pieces.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]]
    for i, g in pieces.sort_values("piece").groupby("doc_id"):
        assert g.piece.tolist() == list(range(len(g))) and g.start.tolist() == [0, *np.cumsum(g.length)[:-1]] and (g.length[:-1] == 4096).all()
    assert pieces.sequence_id.nunique() == -(-int(pieces.length.sum()) // 4096)  # the lower bound


def test_spans_and_digests(results, rows):
    found = {r["doc_id"]: r for r in results["op9_pii"].collect()}
    for i, t, *_ in rows:
        base = texts.brute(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert found[i]["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [found[i][f"n_{k}"] for k in texts.PATTERNS] == [sum(x[0] == k for x in base) for k in texts.PATTERNS]
        assert {x for x in text.split(",") if x} <= set(found[i]["spans"].split(","))


def test_decoded_texts_and_edits(results, rows):
    decoded = {r["doc_id"]: r["decoded_sha256"] for r in results["op8_byte_bpe"].collect()}
    edits = {r["doc_id"]: r for r in results["op10_fingerprint"].collect()}
    order = sorted((i, t or "") for i, t, *_ in rows)
    for k, (i, t) in enumerate(order):
        assert decoded[i] == hashlib.sha256(t.encode()).hexdigest()
        cut, following = len(t) // 4, order[(k + 1) % len(order)][1]
        assert edits[i]["edited_sha256"] == hashlib.sha256((t[: len(t) - cut] + following[:cut]).encode()).hexdigest() and edits[i]["n_chars"] == len(t)
        assert edits[i]["near_next"] in (0.0, 1.0)


def test_vectors_link_like_brute_force(spark, results, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    x = np.array([r["embedding"] for r in rows], dtype=float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    pairs = [(a, b) for a in range(len(rows)) for b in range(a) if rows[a]["label"] is not None and rows[a]["label"] == rows[b]["label"] and x[a] @ x[b] >= 0.93]
    want = links.roots(range(len(rows)), pairs)
    n = np.bincount(np.array(pairs, dtype=int).ravel(), minlength=len(rows))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in results["op7_vector_dedup"].collect()}
    assert got == {r["vec_id"]: (n[k], rows[want[k]]["vec_id"], want[k] == k) for k, r in enumerate(rows)}


def test_empty_tables(spark, tmp_path):
    for name in ("documents", "labels", "pages", "embeddings"):
        schema = {"documents": "doc_id long, text string, lang string, source string, n_chars long", "labels": "doc_id long, quality int, toxic int", "pages": "page_id long, url string, html string", "embeddings": "vec_id long, embedding array<float>, label int"}[name]
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name in (*COLUMNS, "op3_license_scan"):
        assert registry.QUERIES[name](spark, str(tmp_path)).count() == 0, name
