"""Token counts, BPE codec, language identification, page text and fingerprints against libraries or brute force."""

import hashlib
import math
import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from churnlens.llm import fingerprint, html_text
from churnlens.llm.bpe_codec import encode_texts
from churnlens.llm.fingerprint import Digest, digests, entropy_classes, fingerprint_edits, likeness, rank_classes
from churnlens.llm.html_text import blocks_of, extract_main_text, labelled_pages, trained
from churnlens.llm.language_id import UNKNOWN, drop_unknown, fit_profiles, identify
from churnlens.llm.token_count import count_tokens

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_tokens long, score string"


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def edge_rows():
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing extra columns."""
    long = "Straße naïve 12,345 'RE don't  \t end\n" * 4000
    texts = ["", None, " ", "a", "Hello  world", "Hello  world", "x" * 30_000, long, "<|endoftext|> and<|startoftext|>it",
             "ΑΣ Σ İ ǅ ﬁ", "e\u0301 A\u030a", "\u200b\u3000\x1c\x1d\x85 \xa0", "日本語 テキスト 😀😀", "a\n\nb \n c\r\n", "''ll 're"]
    return [(i, t, "en", "s", 7, "x") for i, t in enumerate(texts)] + [(4, "Hello  world", None, None, None, None),
                                                                       (None, "no id", "en", None, None, None)]


def fuzz(n, seed):
    rnd = random.Random(seed)
    letters = [chr(c) for c in [*range(256), 0x200B, 0x2028, 0x3000, 0x130, 0x3A3, 0x300, 0x1100, 0xAC00, 0x1F600, 0xFB01, 0xBD]]
    letters += ["<|endoftext|>", "<|startoftext|>", "'s", " 'll"]
    return [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 50))), None, None, None, None) for i in range(n)]


@pytest.mark.parametrize("rows", [edge_rows(), fuzz(400, 1), []], ids=["edge", "fuzz", "none"])
def test_token_counts_equal_the_library(spark, rows):
    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    got = count_tokens(frame(spark, rows), path).collect()
    want = []
    for doc_id, text, *_ in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        want.append((doc_id, len((text or "").encode()), n, n > 512))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_token_counts_without_room_in_the_cache(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = frame(spark, edge_rows())
    assert sorted(count_tokens(docs, path, cache_words=3).collect(), key=str) == sorted(count_tokens(docs, path).collect(), key=str)


@pytest.mark.parametrize("rows", [edge_rows(), fuzz(400, 2), []], ids=["edge", "fuzz", "none"])
def test_codec_equals_the_library(spark, rows):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    want, plain = [], []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        plain.append((doc_id, len(ids), ids, decoded))
        want.append((doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(decoded.encode()).hexdigest()))
    got = encode_texts(frame(spark, rows), path, digests=True).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert sorted(str(tuple(r)) for r in encode_texts(frame(spark, rows), path).collect()) == sorted(map(str, plain))


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    profiles = fit_profiles(docs.filter(~held))
    assert profiles.groupBy("lang").count().filter("count > 300").count() == 0
    judged = identify(docs, profiles, carry=("lang",))
    right, n = judged.filter(held).agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 200 and right / n >= 0.97


def brute_grams(texts, k=300):
    grams = Counter()
    for text in texts:
        line = "".join(w + " " for w in "".join(c.lower() if c.isalpha() else " " for c in text).split())
        for n in (1, 2, 3):
            grams.update(line[i:i + n] for i in range(len(line) - n + 1) if line[i:i + n] != " ")

    def code(g):
        return sum(ord(c) << 16 * (len(g) - 1 - j) for j, c in enumerate(g))
    return [g for g, _ in sorted(grams.items(), key=lambda x: (-x[1], code(x[0])))][:k]


def test_language_distance_is_brute_force(spark):
    texts = {"en": ["the cat and the dog", "this is the thing", "and then"], "de": ["der hund und die katze", "das ist nicht"]}
    rows = [(i, t, lang, None, None, None) for i, (lang, t) in enumerate((lang, t) for lang, x in texts.items() for t in x)]
    profiles = fit_profiles(frame(spark, rows), fit_rows=10**6)
    want = {lang: brute_grams(x) for lang, x in texts.items()}
    got = {}
    for r in profiles.collect():
        got.setdefault(r["lang"], {})[r["rank"]] = r["gram"]
    for lang, grams in want.items():
        assert [got[lang][k] for k in range(len(grams))] == [
            sum(ord(c) << 16 * (len(g) - 1 - j) for j, c in enumerate(g)) for g in grams]
    asked = "the hund and cat"
    far = {}
    for lang, grams in want.items():
        own = brute_grams([asked])
        far[lang] = sum(abs(k - grams.index(g)) if g in grams else 300 for k, g in enumerate(own)) / (300 * len(own))
    row = identify(frame(spark, [(1, asked, None, None, None, None)]), profiles).first()
    best = min(sorted(far), key=far.get)
    assert row["lang_pred"] == best and math.isclose(row["score"], 1 - far[best], abs_tol=1e-12)


def test_language_edge_rows(spark):
    docs = frame(spark, edge_rows())
    profiles = fit_profiles(docs)
    got = identify(docs, profiles).collect()
    assert len(got) == len(edge_rows())
    by_id = {r["doc_id"]: r for r in got}
    for doc_id in (0, 1, 2, 11):
        assert (by_id[doc_id]["lang_pred"], by_id[doc_id]["score"]) == (UNKNOWN, 0.0)
    assert all(0 <= r["score"] <= 1 for r in got) and by_id[4]["lang_pred"] == "en"
    none = frame(spark, [])
    assert identify(none, fit_profiles(none)).count() == 0
    assert {r["lang_pred"] for r in identify(docs, fit_profiles(none)).collect()} == {UNKNOWN}
    kept = drop_unknown(docs)
    assert kept.columns == docs.columns and kept.count() == len(edge_rows()) - 4


def test_texts_stay_where_no_language_is_named(spark):
    docs = frame(spark, edge_rows()).withColumn("lang", F.lit(None).cast("string"))
    assert drop_unknown(docs).count() == len(edge_rows()) - 4


def test_pages_edge_rows(spark):
    model = trained(200)
    body = "<p>" + "This is one long enough sentence of the article, with marks. " * 4 + "</p>"
    pages = [
        (1, "u", f"<html><body><nav><ul><li><a href='/'>Home</a></li><li><a href='/a'>All</a></li></ul></nav><article><h1>Title &amp; "
                 f"more</h1>{body}<p>a&nbsp;b<br>c &lt;d&gt; <i>it</i>al</p><div class='ad'>Buy this now</div></article><div id='comments'>"
                 f"<h3>Comments</h3><div class='comment'><p>I think that this is great, and more of it.</p></div></div>"
                 f"<footer>&copy; site</footer><script>var x='<p>no</p>'</script></body></html>", "t", 3),
        (2, None, None, None, None), (3, "u", "", None, None), (None, "u", "<article>" + body * 3000, None, None),
        (5, "u", "<nav><a href='/'>Home</a></nav>", None, None), (5, "u", "<nav><a href='/'>Home</a></nav>", None, None),
        (6, "u", "<!-- <p>x</p> --><p", None, None)]
    docs = spark.createDataFrame(pages, "page_id long, url string, html string, text string, n_chars int")
    got = {r["page_id"]: r for r in extract_main_text(docs, model).collect()}
    sentence = ("This is one long enough sentence of the article, with marks. " * 4).strip()
    assert got[1]["text"] == f"Title & more\n{sentence}\na b c <d> ital"
    assert got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == got[3]["text"] == got[5]["text"] == got[6]["text"] == ""
    assert got[None]["text"] == "\n".join([sentence] * 3000)
    assert extract_main_text(docs.limit(0), model).count() == 0


def test_pages_held_out_blocks_and_tables(spark):
    model = trained()
    right = total = 0
    for html, labels in labelled_pages(200, seed=77):
        keep = model.decode(model.emissions(blocks_of(html)))
        right += sum(a == b for a, b in zip(keep, labels))
        total += len(labels)
    assert right / total >= 0.95
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    rows = pages.join(extract_main_text(pages, model).select("page_id", "text"), "page_id").collect()
    same = 0
    for r in rows:
        inside = html_text.blocks_of(r["html"])
        want = "\n".join(b.text for b in inside if "a:article" in b.path)
        same += want == r["text"]
    assert same / len(rows) >= 0.98


def test_pages_keep_formulas_drawings_and_objects(spark):
    text = "Energy <math><mi>E</mi>=mc2</math> is <object>fallback</object> and <svg><text>a label</text></svg> x, and more words follow here. "
    html = f"<body><nav><a href='/'>Home</a></nav><article><h1>On energy</h1><p>{text * 3}</p><p>{text * 2}</p></article></body>"
    got = extract_main_text(spark.createDataFrame([(1, "u", html)], "page_id long, url string, html string"), trained(120)).first()["text"]
    one = "Energy E=mc2 is fallback and a label x, and more words follow here."
    assert got == "On energy\n" + " ".join([one] * 3) + "\n" + " ".join([one] * 2)


def test_deep_pages_keep_their_outer_elements():
    model = trained(120)
    sentence = "A long enough sentence of plain words, with marks. " * 5
    inner = "<div><span>" * 300 + f"<p>{sentence}</p>" * 3
    shallow, deep = (blocks_of(f"<{tag}>{inner}", model.weights) for tag in ("article", "footer"))
    assert [b.text for b in shallow] == [b.text for b in deep] == [sentence.strip()] * 3
    names = [b.path for tag in ("article", "footer") for b in blocks_of(f"<{tag}>{inner}")]
    assert all("a:article" in p for p in names[:3]) and all("a:footer" in p for p in names[3:])
    own = model.emissions(blocks_of(f"<footer>{inner}"))
    assert all(math.isclose(a, b, abs_tol=1e-9) for a, b in zip(own, model.emissions(deep)))
    assert model.emissions(deep)[0] < model.emissions(shallow)[0]


def test_unmatched_tags_cost_time_in_proportion():
    import time
    for html in ("<div>" * 100_000 + "</section>" * 100_000, "<b>" * 100_000 + "<p>x" * 50_000, "<div class='a b c'><p>x" * 30_000,
                 "<i>" * 50_000 + "<div></div>" * 50_000 + "</u>" * 50_000):
        start = time.process_time()
        blocks_of(html, {})
        assert time.process_time() - start < 6


def test_viterbi_is_the_best_of_all_labellings():
    model = trained(60)
    rnd = random.Random(4)
    for _ in range(30):
        e = [rnd.uniform(-2, 2) for _ in range(rnd.randint(1, 9))]
        t = model.transitions

        def score(labels):
            return labels[0] * model.first + sum(x for x, y in zip(e, labels) if y) + sum(t[a, b] for a, b in zip(labels, labels[1:]))
        best = max(score([k >> j & 1 for j in range(len(e))]) for k in range(1 << len(e)))
        assert math.isclose(score([int(x) for x in model.decode(e)]), best, abs_tol=1e-9)


def test_entropy_classes_are_brute_force():
    data = np.random.default_rng(1).integers(0, 9, 3000).astype(np.uint8) + 97
    got = entropy_classes(data)
    w = fingerprint.WINDOW
    for i in range(0, len(data) - w, 41):
        h = -sum(c / w * math.log2(c / w) for c in Counter(data[i:i + w].tolist()).values())
        assert abs(got[i] - h / math.log2(w) * 1000) <= 1


def test_fingerprints_do_not_depend_on_their_neighbours():
    rnd = random.Random(2)
    texts = [bytes(rnd.choices(b"abcdefgh \n", k=rnd.choice([0, 3, 15, 16, 17, 40, 300, 9000]))) for _ in range(60)]
    rank = rank_classes(fingerprint.class_counts(texts))
    together = digests(texts, rank)
    assert [str(d) for d in together] == [str(digests([t], rank)[0]) for t in texts]
    for d, t in zip(together, texts):
        assert str(Digest.parse(str(d))) == str(d) and likeness(d, d) == 1.0
        assert (not d.sizes) == (not t)


def brute_digest(text, rank):
    """The chain of filters from the definition, window by window."""
    w, n = fingerprint.WINDOW, len(text) - fingerprint.WINDOW + 1
    mask, base = (1 << 64) - 1, int(fingerprint._BASE)

    def mixed(h):
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 & mask
        h = (h ^ h >> 27) * 0x94D049BB133111EB & mask
        return h ^ h >> 31
    features, keys = [], []
    for i in range(n):
        f = mixed(sum(c * pow(base, k, 1 << 64) for k, c in enumerate(text[i:i + w])) & mask)
        cls = int(entropy_classes(np.frombuffer(text[i:i + w] + bytes(1), np.uint8))[0])
        features.append(f)
        keys.append((int(rank[cls]), f >> 44, i))
    votes = Counter()
    for i in range(n):
        least = min(keys[i:i + fingerprint.NEIGHBOURS])
        if least[0] < fingerprint.CLASSES:
            votes[least[2]] += 1
    own = list(dict.fromkeys(features[i] for i in range(n) if votes[i] >= fingerprint.VOTES))
    if not own and text:
        own = [int.from_bytes(hashlib.sha256(text).digest()[:8], "big")]
    filters = []
    for at in range(0, len(own), fingerprint.FILTER_FEATURES):
        bits = {f >> 11 * p & (fingerprint.FILTER_BITS - 1) for f in own[at:at + fingerprint.FILTER_FEATURES] for p in range(fingerprint.PROBES)}
        filters.append((len(own[at:at + fingerprint.FILTER_FEATURES]), bits))
    return filters


def as_filters(d):
    return [(n, {int(k) for k in np.flatnonzero(np.unpackbits(row))}) for n, row in zip(d.sizes, d.filters)]


def brute_likeness(a, b):
    if not a or not b:
        return float(not a and not b)
    a, b = (a, b) if len(a) <= len(b) else (b, a)
    m = fingerprint.FILTER_BITS
    total = sum(n * max(0.0, max((len(x & y) - len(x) * len(y) / m) / (min(len(x), len(y)) - len(x) * len(y) / m) for _, y in b)) for n, x in a)
    return min(1.0, total / sum(n for n, _ in a))


@pytest.mark.parametrize("chunk", [1 << 18, 37])
def test_digests_are_brute_force(monkeypatch, chunk):
    rnd = random.Random(11)
    texts = [bytes(rnd.choices(b"abcdefgh ij\xc3\xa9", k=k)) for k in (0, 1, 15, 16, 17, 31, 64, 500, 2500, 4000)] + [b"aaaa" * 30, b"ab" * 200]
    texts.append(texts[7] + texts[6])
    rank = rank_classes(fingerprint.class_counts(texts))
    want = [brute_digest(t, rank) for t in texts]
    monkeypatch.setattr(fingerprint, "CHUNK", chunk)
    fingerprint._powers.cache_clear()
    assert (rank == rank_classes(fingerprint.class_counts(texts))).all()
    got = digests(texts, rank)
    fingerprint._powers.cache_clear()
    assert [as_filters(d) for d in got] == want
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert math.isclose(likeness(got[i], got[j]), brute_likeness(want[i], want[j]), abs_tol=1e-12)


def test_a_very_long_text_needs_memory_for_a_chunk():
    import tracemalloc
    text = np.random.default_rng(0).integers(97, 123, 32 << 20).astype(np.uint8).tobytes()
    rank = rank_classes(fingerprint.class_counts([text[:1 << 20]]))
    tracemalloc.start()
    digests([text], rank)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20


def test_edits_follow_in_descending_order(spark):
    rows = [r for r in edge_rows() if r[0] is not None]
    rng = random.Random(3)
    rows += [(100 + i, "".join(rng.choices("abcdefghij klmno", k=rng.randint(0, 900))), None, None, None, None) for i in range(300)]
    rng.shuffle(rows)
    got = fingerprint_edits(frame(spark, rows).repartition(7)).collect()
    order = sorted(rows, key=lambda r: (-r[0], r[1] or ""))
    want = []
    for row, after in zip(order, order[1:] + order[:1]):
        t, nxt = row[1] or "", after[1] or ""
        k = len(t) // 3
        want.append((row[0], len(t), hashlib.sha256((t[:len(t) - k] + nxt[:k]).encode()).hexdigest()))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    prints = {r["doc_id"]: r["fingerprint"] for r in got}
    assert prints[4] == prints[5]
    far = [r for r in got if r["n_chars"] >= 300]
    assert np.mean([r["near_edited"] for r in far]) > 0.5 > 0.2 > np.mean([r["near_next"] for r in far])


def test_edits_of_few_rows(spark):
    assert fingerprint_edits(frame(spark, [])).count() == 0
    one = fingerprint_edits(frame(spark, [(None, "a lonely text, its own successor", None, None, None, None)])).first()
    assert one["doc_id"] is None and one["near_next"] == 1.0


def test_crc_remainder_is_that_of_zlib(spark):
    row = frame(spark, [(12345, "", None, None, None, None)]).select(F.crc32(F.col("doc_id").cast("string"))).first()
    assert row[0] == zlib.crc32(b"12345")
