"""License scans, filter audit and whitening against brute force."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnlens.llm import queries as llm
from churnlens.llm.filter_audit import audit_orders, failing_rows, positional_counts, survival_word, survivors, text_failures
from churnlens.llm.license_scan import TEMPLATES, TEXTS, Template, license_spans, scan_licenses, template_hits
from churnlens.llm.whitening import bidiagonalise, fit_whitening, quantised, whiten_vectors

SF = "/root/testdata/sf0.001"


# --- 11 -------------------------------------------------------------------------------------------------------------

LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}


def license_words(text):
    return LICENSE_WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_base(text):
    w = license_words(text)
    places = [(i, label) for i in range(len(w)) for p, label in PHRASES.items() if tuple(w[i:i + len(p)]) == p]
    starts = [i for i, _ in places]
    return (len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({b for _, b in places})))


LICENSED = [
    None, "", " \t\n", "MIT License", "mit-license; MIT_License (mit license)", "the MIT, Licenses", "ÄPACHE apache License",
    "Apache License", "GNU GENERAL public license 3", "general public mit license general public license",
    "mit mit license license " * 3, "a", "license mit", "mit license " * 300_000, "x" * 500_000, "Mit Lİcense", "mit license", "mit license",
]


def test_license_base_against_brute_force(spark):
    rows = [(None if i % 5 == 0 else i % 7, t, 1, "x", 2) for i, t in enumerate(LICENSED)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row int, words string, template int").repartition(3)
    got = scan_licenses(docs).collect()
    want = [(i, *brute_base(t)) for i, t, *_ in rows]
    seen = [(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got]
    assert sorted(map(str, seen)) == sorted(map(str, want))
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert (r.score == 0) == (r.labels == "") and 0 <= r.score <= 1


def test_license_texts_with_edits(spark):
    rng = np.random.default_rng(5)
    rows, want = [], {}
    for n, t in enumerate(TEXTS):
        w = license_words(t.text)
        edited = list(w)
        for place in sorted(rng.choice(len(w), 3, replace=False), reverse=True):  # one change, one insertion, one deletion
            edited[place:place + 1] = [["zzz"], ["zzz", edited[place]], []][n % 3]
        rows += [(3 * n, "foo bar " * 50 + " ".join(edited).upper() + " baz" * 40), (3 * n + 1, " ".join(w[:len(w) // 3]) + " and so on"),
                 (3 * n + 2, " ".join(rng.permutation(w)))]
        want[3 * n] = t.label
    got = {r.doc_id: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, r in got.items():
        own = set(filter(None, r.labels.split(","))) - set(filter(None, r.base_labels.split(",")))
        if i in want:
            assert want[i] in r.labels.split(",") and r.score >= 0.6
        else:
            assert not own or r.score == 1.0  # a cut or shuffled text is none, but may hold a phrase


def test_license_spans_merge_neighbouring_diagonals(spark):
    t = (Template("own", " ".join(f"w{i}" for i in range(40)), 0.6),)
    text = " ".join(["a", "b"] + [f"w{i}" for i in range(20)] + ["new", "words"] + [f"w{i}" for i in range(20, 40)])
    far = " ".join([f"w{i}" for i in range(20)] + ["x"] * 30 + [f"w{i}" for i in range(20, 40)])
    docs = spark.createDataFrame([(1, text), (2, far)], "doc_id long, text string")
    hits = template_hits(docs, t)
    spans = license_spans(hits, t).collect()
    assert [(r.label, r.first_word, r.last_word, r.share) for r in spans] == [("own", 2, 43, 1.0)]
    assert license_spans(hits, t, shift=30).count() == 2


def test_license_empty_table(spark):
    assert scan_licenses(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    assert len({t.label for t in TEMPLATES}) > 5


# --- 12 -------------------------------------------------------------------------------------------------------------

def brute_audit(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    fails = []
    for i, text, part in rows:
        t = text or ""
        w = [x for x in re.split(r"[\x20\x09-\x0D]+", t) if x]
        f = {"A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
             "D": bool(re.search("[#$%&*|]", t)), "E": t in least and (i is None or least[t] < i)}
        fails.append((part or "", {x for x in f if f[x]}, i in good and i is not None, i in toxic and i is not None))
    out, total = {}, {}
    for part in {p for p, *_ in fails}:
        mine = [x for x in fails if x[0] == part]
        for order in itertools.permutations("ABCDE"):
            alive = mine
            for step, c in enumerate(order, 1):
                lost, alive = [x for x in alive if c in x[1]], [x for x in alive if c not in x[1]]
                out[part, "".join(order), step] = [len(alive), len(lost), sum(c in x[1] for x in mine) - len(lost),
                                                   sum(x[1] == {c} for x in mine), sum(x[2] for x in lost), sum(x[3] for x in lost)]
                total[part, c] = total.get((part, c), 0) + len(lost)
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(docs, labels):
    return audit_orders(survivors(failing_rows(docs, labels, text_failures(F.col("text")))))


def test_filter_audit_against_brute_force(spark):
    rng = np.random.default_rng(8)
    kinds = [" ".join(f"w{k}" for k in range(60)), " ".join(["a", "b"] * 40), "A" * 10 + " " + " ".join(f"w{k}" for k in range(60)), "x # y",
             None, "", " \n ", "\x0b" + " ".join(f"v{k}" for k in range(49)), " ".join(f"É{k}" for k in range(50)) + "\t", "B" * 400_000]
    rows = [(None if rng.random() < 0.2 else int(rng.integers(0, 90)), kinds[rng.integers(len(kinds))] if rng.random() < 0.8 else f"t{i} " * 55,
             [None, "", "s", "t"][rng.integers(4)]) for i in range(300)]
    rows += rows[:20]
    labels = [(int(rng.integers(0, 90)) if rng.random() < 0.9 else None, [0, 1, None][rng.integers(3)], [0, 1, None][rng.integers(3)]) for _ in range(80)]
    docs = spark.createDataFrame([(*r, "clash", 1, True) for r in rows],
                                 "doc_id long, text string, source string, part string, n int, good boolean").repartition(5)
    marks = spark.createDataFrame([(*x, 9) for x in labels], "doc_id long, quality int, toxic int, n int")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
           for r in audited(docs, marks).collect()}
    assert got == brute_audit(rows, labels)


def test_filter_audit_of_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert audited(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    one = audited(docs.unionByName(spark.createDataFrame([(None, None, None)], docs.schema)), None).collect()
    assert len(one) == 600 and {r.part for r in one} == {""} and sum(r.removed for r in one) == 120


@pytest.mark.parametrize("size", [0, 1, 2, 3, 7, 1000])
def test_positional_counts(size):
    rng = np.random.default_rng(size)
    words, n = rng.integers(0, 1 << 32, size).astype(np.uint64), rng.integers(1, 1 << 40, size)
    want = [sum(int(k) for w, k in zip(words, n) if int(w) >> s & 1) for s in range(32)]
    assert positional_counts(words, n, 32).tolist() == want


def test_survival_words():
    assert survival_word(0, 5) == (1 << 32) - 1 and survival_word(31, 5) == 1
    assert [survival_word(0b01, 2) >> s & 1 for s in range(4)] == [1, 0, 1, 0]


# --- 13 -------------------------------------------------------------------------------------------------------------

def brute_whitening(x):
    off = x - x.mean(0)
    values, turns = np.linalg.eigh(off.T @ off / len(x))
    return values[::-1], turns[:, ::-1], off


def check_whitened(got, ids, x, components=32):
    """Rows of the result against the eigenvectors of numpy; equal eigenvalues by their planes."""
    values, turns, off = brute_whitening(x)
    k = min(components, int((values > 1e-12 * values[0]).sum()))
    w = np.full((len(ids), k), np.nan)
    place = {i: n for n, i in enumerate(ids)}
    for r in got:
        w[place[r.vec_id], r.component - 1] = r.whitened
        assert r.n == len(x) and r.identity_error < 1e-9
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
    assert len(got) == len(ids) * k and not np.isnan(w).any()
    want = off @ turns[:, :k] / np.sqrt(values[:k])
    at = 0
    while at < k:
        to = at + 1
        while to < len(values) and values[to] > values[at] * (1 - 1e-9):
            to += 1
        if to <= k:
            assert np.allclose(w[:, at:to] @ w[:, at:to].T, want[:, at:to] @ want[:, at:to].T, atol=1e-6)
        at = to
    exact = [sum((len(x) * int(v) - int(s)) ** 2 for v, s in zip(row, x.sum(0))) for row in x.astype(int)]
    assert {r.vec_id: r.deviation for r in got} == dict(zip(ids, exact))


def test_whitening_of_the_given_table(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(64 * np.array([r.embedding for r in rows], float))
    check_whitened(llm.QUERIES["op13_embedding_whitening"](spark, SF).collect(), [r.vec_id for r in rows], x)


VECTORS = "vec_id long, embedding array<float>, x string, n int"


def test_whitening_drops_broken_vectors(spark):
    rng = np.random.default_rng(2)
    good = rng.normal(size=(60, 4)) * [1, 2, 3, 0]
    good = np.vstack([good, good[:5]])
    rows = [(i, v.tolist(), "x", 1) for i, v in enumerate(good)]
    bad = [(100, None, "x", 1), (101, [1.0, None, 1.0, 1.0], "x", 1), (102, [1.0, float("nan"), 1.0, 1.0], "x", 1), (105, [], "x", 1),
           (103, [1.0, float("inf"), 1.0, 1.0], "x", 1), (104, [1.0, 2.0], "x", 1)]
    got = whiten_vectors(spark.createDataFrame(rows + bad, VECTORS).repartition(4)).collect()
    check_whitened(got, list(range(65)), np.floor(64 * good.astype(np.float32).astype(float)))


@pytest.mark.parametrize("case", ["one hot", "rank one", "large", "graded"])
def test_whitening_of_hard_spectra(spark, case):
    rng = np.random.default_rng(4)
    x = {"one hot": np.eye(12)[np.arange(48) % 12], "rank one": np.outer(np.arange(30), [1, 2, 0, 4]),
         "large": rng.integers(-2 ** 18, 2 ** 18, (40, 5)) * 1.0, "graded": rng.normal(size=(200, 8)) * 10.0 ** -np.arange(0, 4, 0.5) * 100}[case]
    x = x.astype(float)
    got = whiten_vectors(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")).collect()
    check_whitened(got, list(range(len(x))), np.floor(64 * x))


def test_whitening_without_variance(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]):
        out = whiten_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
        assert out.count() == 0 and out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_bidiagonal_form():
    x = np.random.default_rng(1).normal(size=(50, 9))
    x -= x.mean(0)
    right, b = bidiagonalise(lambda y: (float((x @ y) @ (x @ y)), x.T @ (x @ y)), 9, np.linalg.norm(x))
    assert np.allclose(right @ right.T, np.eye(9), atol=1e-13) and np.allclose(np.tril(b, -1), 0) and np.allclose(np.triu(b, 2), 0)
    assert np.allclose(b.T @ b, right @ x.T @ x @ right.T, atol=1e-11)


def test_components_of_more_dimensions_than_rows(spark):
    x = np.random.default_rng(6).normal(size=(10, 40))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    fit = fit_whitening(quantised(frame))
    assert len(fit.eigenvalues) == 9 and fit.identity_error < 1e-9
    check_whitened(whiten_vectors(frame).collect(), list(range(10)), np.floor(64 * x))
