"""Brute-force comparisons and odd input of the operators that read one document at a time."""

import hashlib
import random
import re
import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import bpe, fingerprint, html_text, language, license_scan, packing, pii, quality

tokenizers = pytest.importorskip("public_tokenizers")

ODD = [None, "", " \n\t", "a", "É" * 3, "x" * 5000, "word " * 4000, "日本語 テキスト 😀😀", "Ábc ﬁ", "9" * 3000, "1 2 " * 2000, "\x00\x1c\x85"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, repeated rows, null ids, and extra columns whose names clash with the operators' own."""
    rows = [(k, t, "x", 1, 2.0) for k, t in enumerate(ODD)] + [(3, "a", "x", 1, 2.0), (None, "null id", "x", 1, 2.0), (None, None, None, None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, piece int, score double")


# ---------------------------------------------------------------- packing


@pytest.fixture(scope="module")
def word_tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizers.path("word_bpe_49k.json"))


def test_words_are_encoded_like_whole_texts(word_tokenizer):
    own = packing.WordTokeniser(tokenizers.path("word_bpe_49k.json"))
    texts = [t for t in ODD if t] + ["It's we'll 'S x's ½²³ ŉ İstanbul", "<|endoftext|> it''s 12ab_c", "a<|startoftext|>b  <|endoftext|>", "<|ENDOFTEXT|> <|end", "don't stop", "ΑΣ sigma", "à é"]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids, text


def test_words_of_new_chunks_are_encoded_once(word_tokenizer, monkeypatch):
    """A chunk that is new takes the ids of words that are known, and a full cache changes no ids."""
    texts = ["Alpha, beta. (gamma) it's", "alpha. beta; gamma delta", "(beta) delta, 's s 7 77", "alpha. beta; gamma delta"]
    for size in (400_000, 9, 0):
        monkeypatch.setattr(packing, "CACHE_WORDS", size)
        own = packing.WordTokeniser(tokenizers.path("word_bpe_49k.json"))
        encoded, words = [], own._words
        monkeypatch.setattr(own, "_words", lambda new: encoded.extend(new) or words(new))
        for text in texts:
            ids = own.encode([text])[0]
            assert np.frombuffer(ids, "<u4").tolist() == word_tokenizer.encode(text, add_special_tokens=False).ids, text
        assert len(own.chunks) <= size
        assert size < 400_000 or len(encoded) == len(set(encoded)), encoded


@pytest.mark.parametrize("seed", range(6))
def test_histogram_packing_is_whole_and_near_the_bound(seed):
    rng = random.Random(seed)
    counts = {}
    for _ in range(rng.choice([3, 40, 400])):
        w = rng.choice([rng.randint(1, 100), rng.randint(1, 60), 100, 50, 51, 34])
        counts[w] = counts.get(w, 0) + rng.randint(1, 5)
    patterns = packing.pack_histogram(counts, 100)
    used = {}
    for content, times in patterns:
        assert sum(content) <= 100 and times > 0
        for w in content:
            used[w] = used.get(w, 0) + times
    assert used == counts
    n, bound = sum(t for _, t in patterns), packing.lower_bound(counts, 100)
    assert bound <= n <= bound * 1.05 + 1


def exhaustive(items, capacity):
    """Fewest bins by trying everything."""
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k, room in enumerate(bins):
            if room >= items[i] and room not in bins[:k]:
                go(i + 1, [*bins[:k], room - items[i], *bins[k + 1 :]])
        go(i + 1, [*bins, capacity - items[i]])

    go(0, [])
    return best[0]


def test_reduction_keeps_an_optimum():
    rng = random.Random(3)
    for _ in range(60):
        items = sorted((rng.randint(1, 20) for _ in range(rng.randint(1, 9))), reverse=True)
        lengths = packing._Lengths({w: items.count(w) for w in items})
        fixed, changed = 0, True
        while changed and lengths.order:
            changed = False
            for w in reversed(list(lengths.order)):
                while w in lengths.counts and (chosen := packing._dominant(lengths, w, 20)):
                    times = packing._repeat(lengths, chosen)
                    if not times:
                        break
                    for v in chosen:
                        lengths.take(v, times)
                    fixed += times
                    changed = True
        rest = [w for w, n in lengths.counts.items() for _ in range(n)]
        assert fixed + exhaustive(sorted(rest, reverse=True), 20) == exhaustive(items, 20), items


def test_places_are_gapless(spark, odd, word_tokenizer):
    out = packing.pack(packing.pieces_of(odd, tokenizers.path("word_bpe_49k.json"))).toPandas()
    assert (out["length"] <= 4096).all() and len(out) >= odd.count()
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        ends = (seq["offset"] + seq["length"]).tolist()
        assert seq["offset"].tolist() == [0, *ends[:-1]] and ends[-1] <= 4096
    by = out[out["doc_id"] == 6].sort_values("piece")
    ids = [*word_tokenizer.encode(ODD[6], add_special_tokens=False).ids, 1]
    assert by["length"].tolist() == [len(ids[k : k + 4096]) for k in range(0, len(ids), 4096)]
    assert by["start"].tolist() == list(range(0, len(ids), 4096))
    assert by["ids_crc32"].tolist() == [zlib.crc32(np.array(ids[k : k + 4096], "<u4").tobytes()) for k in range(0, len(ids), 4096)]
    assert packing.pack(packing.pieces_of(odd.limit(0), tokenizers.path("word_bpe_49k.json"))).count() == 0


# ---------------------------------------------------------------- byte-level BPE


def test_bpe_equals_the_library_and_decodes(spark, odd):
    import tiktoken

    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    lib = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    out = bpe.encode_digests(odd, path, tokenizers.PATTERN).collect()
    assert len(out) == odd.count()
    texts = {k: t for k, t in enumerate(ODD)}
    for r in out:
        if r["doc_id"] is None:
            continue
        text = texts[r["doc_id"]] or ""
        ids = lib.encode_ordinary(text)
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_digests(odd.limit(0), path, tokenizers.PATTERN).count() == 0


def test_bpe_of_random_bytes(monkeypatch):
    import tiktoken

    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    monkeypatch.setattr(bpe, "STEP_ROWS", 400)  # many restarts
    monkeypatch.setattr(bpe, "CACHE_PIECES", 50)
    own = bpe.RankCodec(path, tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    rng = random.Random(1)
    for _ in range(20):
        text = "".join(rng.choice("abcdeéß日 '\n.19😀th") for _ in range(rng.randint(0, 150)))
        ids = lib.encode_ordinary(text)
        assert own.digests([text])[0][:2] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())


@pytest.mark.parametrize("kind", ["pair", "letters", "few", "one", "run", "spaces", "bytes"])
def test_bpe_of_long_pieces(monkeypatch, kind):
    import tiktoken

    path = tokenizers.path("byte_bpe_multi_50k.tiktoken")
    monkeypatch.setattr(bpe, "STEP_ROWS", 30_000)  # restarts
    own = bpe.RankCodec(path, tokenizers.PATTERN)
    lib = tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(2)
    text = {
        "pair": "ab" * 20_000,
        "letters": "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=100_000)),
        "few": "".join(rng.choices("aeinstrth", k=6_000)),
        "one": "a" * 9_999,
        "run": "".join(rng.choices(["the", "and", "ing", "on", "an", "s", "ation"], k=3_000)),
        "spaces": " " * 1_000_000,
        "bytes": "".join(rng.choices("é日ßabñ", k=4_000)),
    }[kind]
    pieces = own.split(text)
    ids = [i for p in pieces for i in lib._encode_single_piece(p)]
    assert own.digests([text])[0] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


# ---------------------------------------------------------------- language and quality


def test_language_learns_and_marks_what_it_cannot_tell(spark, odd):
    rng = random.Random(2)
    words = {"aa": ["bana", "kola", "mirado", "sento"], "bb": ["schtrk", "pfelz", "gronz", "wichtz"]}
    rows = [(k, " ".join(rng.choices(words[lang], k=20)), lang) for k, lang in enumerate(["aa", "bb"] * 40)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(train)
    out = {r["doc_id"]: r for r in language.predict(train, model).collect()}
    assert all(out[k]["lang_pred"] == lang and 0.5 < out[k]["lang_score"] <= 1 for k, _, lang in rows)
    found = language.predict(odd, model).collect()
    assert len(found) == odd.count() and found[0].asDict().keys() >= set(odd.columns)
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["lang_score"] <= 1
    empty = language.train(train.limit(0))
    assert {r["lang_pred"] for r in language.predict(train, empty).collect()} == {"und"}
    assert language.predict(train.limit(0), model).count() == 0


def test_cells_count_every_gram():
    at, n = language.cells("Ab, AB!")
    # the folded text is 0 a b 0 a b 0: 7 + 6 + 5 grams
    assert n.sum() == 18 and len(at) == len(set(at.tolist()))


def test_quality_learns_from_statistics(spark, odd):
    rng = random.Random(4)
    good = lambda: " ".join(rng.choices(["stone", "river", "walks", "under", "light", "seven"], k=80)).capitalize() + "."
    rows = [(k, good() if k % 2 else "SPAM!! " * 30, k % 2) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    forest = quality.train(docs.drop("quality"), docs.select("doc_id", "quality"))
    out = quality.score(docs, forest).collect()
    assert all((r["quality_score"] >= quality.THRESHOLD) == bool(r["quality"]) for r in out)
    assert all(0 <= r["quality_score"] <= 1 for r in quality.score(odd, forest).collect())
    none = quality.train(docs, docs.select("doc_id", "quality").limit(0))
    assert {round(r["quality_score"], 6) for r in quality.score(odd, none).collect()} == {0.5}
    assert quality.score(docs.limit(0), forest).count() == 0


def test_flat_trees_equal_recursive_walks():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    y = (x[:, 0] * x[:, 1] > 0).astype(float)
    forest = quality.grow(x, y, trees=30)

    def walk(tree, row):
        at = 0
        for _ in range(quality.DEPTH):
            at = 2 * at + (2 if row[forest.feature[tree, at]] > forest.threshold[tree, at] else 1)
        return forest.value[tree, at]

    slow = [forest.base + sum(walk(t, row) for t in range(30)) for row in x[:40]]
    assert np.allclose(slow, forest.raw(x[:40])) and ((forest.predict(x) > 0.5) == y).mean() > 0.9


# ---------------------------------------------------------------- personal data

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def passes(kind, hit):
    d = re.sub("[^0-9]", "", hit)
    return {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in hit.split(".")), "card": lambda: 16 <= len(d) <= 19 and luhn(d), "phone": lambda: 8 <= len(d) <= 15}[kind]()


def brute(text):
    return [(k, m.start(), m.end()) for k, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(k, m[0])]


def test_base_spans_equal_brute_force(spark, odd):
    rng = random.Random(8)
    bits = ["a@b.c", "@d.e", " ", ".", "+", "1.2.3.4", "255.0.0.001", "256.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 123-4567", "😀", "é", "-", "%x", "12", "token", "\n", "030 1234567"]
    texts = ["".join(rng.choices(bits, k=rng.randint(1, 25))) for _ in range(300)] + [t for t in ODD]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = pii.train(docs)
    for r in pii.scan(docs, model).collect():
        base = [(x["kind"], x["start"], x["end"]) for x in r["base"]]
        assert base == brute(r["text"]), r["text"]
        for x in r["added"]:
            assert not any(k == x["kind"] and s < x["end"] and x["start"] < e for k, s, e in base)
    out = pii.scan(odd, model)
    assert out.count() == odd.count() and out.columns == [*odd.columns, "base", "added"]
    assert pii.train(odd.limit(0)).keys() == model.keys() and pii.scan(odd.limit(0), model).count() == 0


def test_filters_lose_no_spans(spark):
    texts = ["pay 41 11 11 11 11 11 11 11 now", "4 1 1 1 1 1 1 1 1 1 1 1 1 1 1 1", "41-11-11-11-11-11-11-11", "4-1-1-1 1-1-1-1 1-1-1-1 1-1-1-1", "41 11 11 11 11 11 11 12"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = docs.select("text", pii.base_spans(F.col("text"))["card"].alias("card")).collect()
    for r in found:
        assert [("card", x["start"], x["end"]) for x in r["card"]] == brute(r["text"]), r["text"]
    assert [len(r["card"]) for r in found] == [1, 1, 1, 1, 0]
    forms = ["192[.]168[.]0[.]1", "10(.)0(.)0(.)1", "10 [.] 0 [.] 0 [.] 1", "10 . 0 . 0 . 1", "10.0.0.1"]
    docs = spark.createDataFrame([(f, f"host {f}") for f in forms], "form string, text string")
    for r in docs.select("form", pii.spans(F.col("text"), pii.WIDE["ip"], pii.NEEDS["ip"]).alias("ip")).collect():
        assert [x["hit"] for x in r["ip"]] == [r["form"]]
    # each pattern's matches in random texts, with and without the filter
    rng = random.Random(4)
    bits = ["4", "11", "1111", " ", "-", ".", "[.]", "(.)", "/", "[dot]", "(at)", "＠", "@", "a", "+", "(", ")"]
    docs = spark.createDataFrame([("".join(rng.choices(bits, k=rng.randint(4, 30))),) for _ in range(2000)], "text string")
    for kind in pii.KINDS:
        for pattern in (pii.BASE[kind], pii.WIDE[kind]):
            assert docs.where(F.col("text").rlike(pattern) & ~F.col("text").rlike(pii.NEEDS[kind])).isEmpty(), pattern


def test_added_spans_and_redaction(spark):
    rows = [(k, f"Mail bob{k}@example.com or call +1 555 123 4{k:03d} now; host 10.0.0.{k % 250}") for k in range(60)]
    rows += [(100, "write to ann (at) example (dot) org please"), (101, "nothing here 12")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.scan(docs, pii.train(docs))
    out = {r["doc_id"]: r for r in found.select("*", pii.redact(F.col("text"), F.concat("base", "added")).alias("clean")).collect()}
    assert out[0]["clean"] == "Mail [EMAIL] or call [PHONE] now; host [IP]"
    assert [x["kind"] for x in out[100]["added"]] == ["email"] and "ann" not in out[100]["clean"]
    assert out[101]["clean"] == "nothing here 12" and not out[101]["base"]


def test_overlapping_spans_are_redacted_whole(spark):
    found = F.expr("array(named_struct('kind', 'ip', 'start', 3, 'end', 6), named_struct('kind', 'phone', 'start', 5, 'end', 9), named_struct('kind', 'card', 'start', 9, 'end', 10))")
    one = spark.createDataFrame([("0123456789ab",)], "text string").select(pii.redact(F.col("text"), found).alias("out")).first()
    assert one["out"] == "012[IP][CARD]ab"
    spans = "named_struct('p', {}, 'end', {}, 'start', {}, 'kind', '{}')"
    best = F.expr("array(" + ", ".join(spans.format(*x) for x in ((0.5, 9, 0, "ip"), (0.7, 12, 8, "phone"), (0.7, 13, 8, "card"), (0.1, 20, 13, "ip"))) + ")")
    kept = spark.range(1).select(pii._best(best).alias("x")).first()["x"]
    assert [tuple(x) for x in kept] == [("card", 8, 13), ("ip", 13, 20)]


def test_users_columns_keep_their_values(spark, labeller):
    names = "base added matches runs quality_score Lang_Pred lang_score of_ip"
    docs = spark.createDataFrame([(1, "mail a@b.c, MIT License", *names.split())], "doc_id long, text string, " + ", ".join(f"{n} string" for n in names.split()))
    for out in (
        pii.scan(docs, pii.train(docs)), license_scan.with_runs(license_scan.scan(docs)),
        quality.score(docs, quality.grow(np.zeros((0, len(quality.NAMES))), np.zeros(0))), language.predict(docs, language.train(docs.where("false").withColumn("lang", F.lit("en")))),
    ):
        row = out.first().asDict()
        assert len(set(out.columns)) == len(out.columns)
        for n in names.split():
            assert n in (row.get(n), row.get(f"_{n}"))
    pages = spark.createDataFrame([(1, "<p>Hi</p>", "mine")], "page_id long, html string, text string")
    assert html_text.extract(pages, labeller).columns == ["page_id", "_text", "text"]


# ---------------------------------------------------------------- fingerprints and licences


def test_fingerprints_and_edits(spark):
    texts = ["Ａbc  déf", "abc def́".replace("f́", "f") and "abc déf", "ABC\tDÉF ", None, "", "x" * 9, "y", "abcdefgh"]
    ids = [5, 1, 900, -70, 12, 13, 100_000, 14]
    docs = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string").withColumn("hash", F.lit(1))
    out = {r["doc_id"]: r for r in fingerprint.resolved(docs, fingerprint.fingerprint(docs)).collect()}
    order = sorted(zip(ids, texts))
    for k, (i, t) in enumerate(order):
        t, following = t or "", order[(k + 1) % len(order)][1] or ""
        cut = len(t) // 4
        edited = t[: len(t) - cut] + following[:cut]
        assert out[i]["n_chars"] == len(t) and out[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        same = lambda a, b: " ".join(unicodedata.normalize("NFKC", a).lower().split()) == " ".join(unicodedata.normalize("NFKC", b).lower().split())
        assert out[i]["near_edited"] == float(same(t, edited)) and out[i]["near_next"] == float(same(t, following))
    assert out[5]["fingerprint"] == out[1]["fingerprint"] == out[900]["fingerprint"] != out[13]["fingerprint"]


def test_fingerprints_of_odd_input(spark, odd):
    assert fingerprint.resolved(odd, fingerprint.fingerprint(odd)).count() == odd.count()
    assert fingerprint.fingerprint(odd.limit(0)).count() == 0
    one = fingerprint.fingerprint(odd.where("doc_id = 5")).first()
    assert one["near_next"] == 1.0


def test_equal_hashes_of_different_forms_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "wide_hash", lambda form: F.char_length(form).cast("string"))
    docs = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "AA"), (4, "c")], "doc_id long, text string")
    out = {r["doc_id"]: r["fingerprint"] for r in fingerprint.resolved(docs, fingerprint.fingerprint(docs)).collect()}
    assert out[1] == out[3] != out[2] and len(set(out.values())) == 3


def test_edited_texts_are_told_apart_like_texts(spark, monkeypatch):
    monkeypatch.setattr(fingerprint, "wide_hash", lambda form: F.char_length(form).cast("string"))
    rows = [(1, "aaaa"), (2, "bbbb"), (3, "AAAA"), (4, "cccc"), (5, "AAAB"), (6, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("clash"))
    for out in (fingerprint.resolved(docs), fingerprint.resolved(docs, fingerprint.fingerprint(docs))):
        found = {r["doc_id"]: r for r in out.collect()}
        prints = {}  # by text
        for k, (i, t) in enumerate(rows):
            edited = (t or "")[:3] + (rows[(k + 1) % len(rows)][1] or "")[:1] if t else ""
            edited = t if t and not (rows[(k + 1) % len(rows)][1]) else edited
            prints.setdefault((t or "").lower(), set()).add(found[i]["fingerprint"])
            if found[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest():
                prints.setdefault(edited.lower(), set()).add(found[i]["edited_fingerprint"])
        assert all(len(x) == 1 for x in prints.values())
        assert len(set.union(*prints.values())) == len(prints)
        assert found[1]["near_next"] == 0.0 and found[1]["near_edited"] == 0.0 and found[6]["near_edited"] == 1.0


def dice(a, b):
    a, b = set(license_scan.bigrams_of(a)), set(license_scan.bigrams_of(b))
    return 2 * len(a & b) / (len(a) + len(b)) if a and b else 0.0


def test_licences_equal_brute_force(spark, odd):
    rng = random.Random(6)
    texts = []
    for _ in range(60):
        lines = []
        for _ in range(rng.randint(1, 4)):
            words = rng.choice(list(license_scan.TEMPLATES.values())).split()
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(["xyzzy", "the", "license"])
            wrapped = [" ".join(words[k : k + 9]) for k in range(0, len(words), 9)]
            lines += [" ".join(words)] if rng.random() < 0.7 else ["", *wrapped, " "]
        texts.append("\n".join(lines))
    docs = spark.createDataFrame([*enumerate(texts), (1000, None), (1001, "")], "doc_id long, text string")
    for r in license_scan.scan(docs).collect():
        text = r["text"] or ""
        units = text.split("\n") + [p for p in re.split(r"\n[ \t\r]*\n", text) if "\n" in p] + ([text] if "\n" in text else [])
        want = sorted((u, n, round(d, 6)) for u, unit in enumerate(units) for n, t in license_scan.TEMPLATES.items() if (d := dice(unit, t)) >= license_scan.LEAST - 1e-9)
        assert sorted((m["unit"], m["license"], m["dice"]) for m in r["matches"]) == want
    assert license_scan.scan(odd).count() == odd.count()


def brute_runs(text, template):
    """Most disjoint runs and best score, from every pair of ends."""
    own, least = license_scan.bigrams_of(template), license_scan.LEAST
    longest = int((len(license_scan.words_of(template)) - 1) * (2 - least) / least + 1e-9)
    if "\n" in text and dice(text, template) >= least - 1e-9:
        return 0, 0.0
    words = []
    for p in re.split(r"\n[ \t\r]*\n", text):
        if "\n" in p and dice(p, template) >= least - 1e-9:
            words.append("\n")
            continue
        for line in p.split("\n"):
            words += ["\n"] if dice(line, template) >= least - 1e-9 else license_scan.words_of(line)
    grams, runs = list(map(" ".join, zip(words, words[1:]))), []
    for a in range(len(grams)):
        for b in range(a, min(len(grams), a + longest)):
            d = set(grams[a : b + 1])
            score = 2 * len(d & set(own)) / (len(d) + len(own))
            if score >= least - 1e-9:
                runs.append((b, a, score))
    n, at = 0, -1
    for b, a, _ in sorted(runs):
        if a > at:
            n, at = n + 1, b
    return n, round(max((x for *_, x in runs), default=0.0), 6)


def test_licences_inside_lines(spark, tmp_path):
    mit, isc = license_scan.TEMPLATES["mit"], license_scan.TEMPLATES["isc"].split()
    wrapped = "\n * ".join(["Some header of a file", *(" ".join(isc[k : k + 7]) for k in range(0, len(isc), 7)), "and more words of the same comment that go on for some while"] * 1)
    texts = {
        0: f"Copyright 2020 Foo. {mit}",
        1: wrapped,
        2: f"one {mit} two three four five six seven {mit} eight",
        3: f"{mit}\nalso here: all of it was {mit}",
        4: mit,
        5: "the license of the software is the mit license",
        6: "x " * 300 + "All rights reserved. " + "y " * 300,
    }
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = {r["doc_id"]: (r["license"], r["dice"], r["n_units"], r["licenses"]) for r in license_scan.op3_license_scan(spark, str(tmp_path)).collect()}
    assert out[0] == ("mit", 1.0, 1, "mit") and out[1][0::3] == ("isc", "isc") and out[2] == ("mit", 1.0, 2, "mit")
    assert out[3] == ("mit", 1.0, 2, "mit") and out[4] == ("mit", 1.0, 1, "mit") and out[5] == (None, 0.0, 0, "")
    assert out[6] == ("all-rights-reserved", 1.0, 1, "all-rights-reserved")


def test_runs_equal_brute_force(spark):
    rng = random.Random(11)
    names = ["mit", "all-rights-reserved", "apache-2.0", "bsd-short", "isc"]
    texts = []
    for _ in range(60):
        words = []
        for _ in range(rng.randint(1, 4)):
            words += rng.choices(["xyzzy", "the", "license", "under", "foo"], k=rng.randint(0, 6))
            notice = license_scan.TEMPLATES[rng.choice(names)].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                notice[rng.randrange(len(notice))] = rng.choice(["xyzzy", "the", "license"])
            words += [*notice, rng.choice(["", "\n", "\n\n"])]
        texts.append(" ".join(words))
    docs = spark.createDataFrame([*enumerate(texts), (1000, None), (1001, "")], "doc_id long, text string")
    hits = 0
    for r in license_scan.with_runs(docs).collect():
        found = {n: brute_runs(r["text"] or "", t) for n, t in license_scan.TEMPLATES.items()}
        assert {x["license"]: (x["n"], x["dice"]) for x in r["runs"]} == {n: x for n, x in found.items() if x[0]}, r["text"]
        hits += len(r["runs"])
    assert hits > 50


# ---------------------------------------------------------------- pages


@pytest.fixture(scope="module")
def labeller():
    return html_text.train([], made_up=160)


def test_blocks_survive_broken_markup():
    cases = {
        "<p>a<b>c</b> d&amp;e&nbsp;&#233;<br>f": ["ac d&e é f"],
        "<!-- x <p>y": [],
        "<div><script>if(a<b){'</p>'}</script>z": ["z"],
        "<ul><li>1<li>2</ul><p>3<p>4": ["1", "2", "3", "4"],
        '<p title="a>b">x</p></div></section>y': ["x", "y"],
        "1 < 2 and 3 > 2": ["1 < 2 and 3 > 2"],
        "": [],
        None: [],
    }
    for page, want in cases.items():
        assert [b.text for b in html_text.blocks(page)] == want, page


def test_blocks_after_heads_and_dropped_elements_without_end():
    main = ["Main text."]
    cases = {
        "<html><head><title>T</title><body><article><p>Main text.</p></article>": main,
        "<html><head><title>T</title><meta charset=utf-8><p>Main text.</p>": main,
        "<head><title>T<body><p>Main text.</p>": main,
        "<head><title>T</title><link rel=x>Main text.": main,
        "<head><title>a <p> b</title><script>x</script></head><header>Main text.</header>": main,
        "<head><title>T</title><style>p{}</style></head><p>Main text.": main,
        '<svg viewBox="0 0 1 1"/><p>Main text.</p>': main,
        '<svg viewBox="0 0 1 1"><path d="M0"/><p>Main text.</p><svg><text>no</text></svg>': main,
        "<svg><svg><text>no</text></svg><text>no</text></svg><p>Main text.": main,
        "<iframe src=x /><video src=y><p>Main text.</p>": main,
        '<noscript><img alt="5" tall"></noscript><p>Main text.</p><noscript>"</noscript>': main,
        '<script src="a.js"/><p>Main text.</p>': main,
        "<script src=/js/>no</script><p>Main text.</p><script>no": main,
        "<object>no</object><template><p>no</template><p>Main text.<style>no": main,
        "<!-- <svg> --><p>Main text.</p><svg>no</svg>": main,
        "<head><title>T": [],
    }
    for page, want in cases.items():
        assert [b.text for b in html_text.blocks(page)] == want, page


def test_attributes_controls_and_formulas():
    cases = {
        "<article><a title=it's>one</a><p>two</p> it's three</article>": ["one", "two", "it's three"],
        "<p>A text <button>Go</button> continues <label>so</label> <select><option>1</select>on": ["A text continues so on"],
        "<p>x <math><mi>a</mi>=<mi>b</mi></math> y": ["x a=b y"],
        "<p a = '>' b=\"'>\" c='\">\" >'>in</p>out": ["in", "out"],
        "<p class=a'b\"c>in</p>out": ["in", "out"],
        "<p>in</p><p title='open>out</p>": ["in"] + ["out"],
        "<p>in <button>left open</p>out": ["in left open", "out"],
        "<p>a <b and so on": ["a <b and so on"],
        "<script src='x' />in": ["in"],
        "<script>no</script >in<!doctype html><? no ?>": ["in"],
    }
    for page, want in cases.items():
        assert [b.text for b in html_text.blocks(page)] == want, page


def test_hostile_pages_take_linear_time():
    import time

    n = 1_000_000
    pages = ["<a '" * (n // 4), '<a b="' * (n // 6), "<!-" * (n // 3), "<div>" * (n // 5), "<div>a" * (n // 6), "<p><b>" * (n // 6), "<svg>" * (n // 5), "<script>" * (n // 8), "<head><title>" * (n // 13), "=" * n, "<a =" * (n // 4)]
    for page in pages:
        began = time.process_time()
        found = html_text.blocks(page)
        assert time.process_time() - began < 5, page[:20]
    deep = "".join(f"<div class=c{k}>x{k}" for k in range(500)) + "</div>" * 500 + "end"
    found = html_text.blocks(deep)
    assert [b.text for b in found] == [*(f"x{k}" for k in range(500)), "end"] and not found[-1].path
    assert max(len(b.path) for b in found) == html_text.MAX_DEPTH


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = html_text.Labeller()
    x, mask = rng.normal(size=(2, 4, html_text.WIDTH)), np.array([[1, 1, 1, 1], [1, 1, 0, 0.0]])
    y = np.array([[1, 0, 1, 1], [0, 1, 0, 0.0]])

    def loss():
        p = net.forward(x, mask)
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    grad = net.gradient(x, mask, y)
    for name in net.w:
        w = net.w[name].reshape(-1)
        for k in rng.integers(0, len(w), 3):
            keep, w[k] = w[k], w[k] + 1e-5
            up = loss()
            w[k] = keep - 1e-5
            down = loss()
            w[k] = keep
            assert grad[name].reshape(-1)[k] == pytest.approx((up - down) / 2e-5, rel=1e-3, abs=1e-7)


def test_held_out_pages(labeller):
    rng = random.Random(77)
    texts = [[" ".join(rng.choices(["stone", "river", "walks", "light", "seven", "under"], k=rng.randint(6, 50))).capitalize() + "." for _ in range(8)] for _ in range(20)]
    right = total = 0
    for _ in range(60):
        page, y = html_text._made_up(texts, rng)
        for p, q in zip(labeller.probabilities([page])[0], y):
            right += (p >= 0.5) == bool(q)
            total += 1
    assert right / total > 0.97


def test_extraction_of_odd_pages(spark, labeller):
    page = "<html><head><title>T</title></head><body><nav><a href=/>Home</a></nav><article><h1>Head</h1><p>First &amp; foremost text of this page.</p><p>Second one.</p></article><footer>c</footer></body></html>"
    pages = spark.createDataFrame([(1, "u", page), (2, None, None), (2, None, ""), (None, "v", "<p>" * 500), (4, "w", page * 30)], "page_id long, url string, html string")
    out = html_text.extract(pages, labeller).collect()
    assert len(out) == 5 and next(r["text"] for r in out if r["page_id"] == 1) == "Head\nFirst & foremost text of this page.\nSecond one."
    assert [r["text"] for r in out if r["page_id"] in (2, None)] == ["", "", ""]
    assert html_text.extract(pages.limit(0), labeller).count() == 0
