"""Mixing, URL filter, exact and near duplicates, repeated passages and the pipeline against brute force."""

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from churnlens.llm import queries as llm
from churnlens.llm.components import components
from churnlens.llm.exact_dedup import CuckooIndex, drop_copies, exact_dedup
from churnlens.llm.fm_index import FmIndex
from churnlens.llm.jaccard_join import drop_near_copies, jaccard_join, parity_bitmap, _fold
from churnlens.llm.mixing import cycling_weights, mix, plan_mix
from churnlens.llm.substring_dedup import remove_repeats
from churnlens.llm.url_filter import judge_urls
from churnlens.session import materialize

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, size int, cell string"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame([(*r, *[None] * (6 - len(r))) for r in rows], schema)


def words_of(text):
    return [w for w in SPACE.split(text or "") if w]


# --- SQL ------------------------------------------------------------------------------------------------------------

@pytest.mark.parametrize("name", sorted(llm.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = con.execute(llm.ORACLE[name])
    columns = [c[0] for c in result.description]
    got = llm.QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(str(tuple(r)) for r in got) == sorted(map(str, result.fetchall()))


# --- 1 --------------------------------------------------------------------------------------------------------------

def brute_targets(sizes, weights, budget, most=3.0):
    target, free, left = {}, set(sizes), budget
    while True:
        total = sum(weights[s] for s in free)
        over = {s for s in free if left * weights[s] / total > most * sizes[s]}
        if not over:
            return target | {s: left * weights[s] / total for s in free}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        free -= over


def test_mix_targets_and_words(spark):
    rnd = random.Random(5)
    names = ["b", "a", "Z", "é", None, "empty", "z"]
    share = [900, 30, 200, 400, 60, 0, 100]
    rows = [(i, " ".join("w" * rnd.randint(1, 3) for _ in range(rnd.randint(0, 40))), None, s, None, None)
            for i, s in enumerate(s for s, n in zip(names, share) for _ in range(n))]
    rows += [(10**6, None, None, "empty", None, None), (10**6 + 1, "", None, "empty", 4, "x"), (None, "no id here", None, "a", None, None)]
    docs = frame(spark, rows)
    got = plan_mix(docs, cycling_weights()).collect()
    assert len(got) == len(rows)
    sizes = {}
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words_of(r[1]))
    order = sorted((s for s in sizes if s is not None)) + [None]
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    want = brute_targets({s: n for s, n in sizes.items() if n}, weights, sum(sizes.values())) | {"empty": 0.0}
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and math.isclose(r["target"], want[r["source"]], rel_tol=1e-9)
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["size"] * r["repeats"]
    for s in sizes:
        taken = sum(r["taken"] for r in got if r["source"] == s)
        assert abs(taken - want[s]) <= 0.02 * max(want[s], 500)
    again = plan_mix(docs.repartition(11), cycling_weights()).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    mixed = mix(docs, cycling_weights())
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r["repeats"] for r in got)


def test_mix_given_weights_and_few_rows(spark):
    docs = frame(spark, [(1, "a b c", None, "x"), (2, "a", None, "y"), (3, None, None, None)])
    weights = spark.createDataFrame([("x", 1.0), ("y", 1.0), (None, 1.0)], "source string, weight double")
    got = {r["doc_id"]: r for r in plan_mix(docs, weights).collect()}
    assert (got[1]["taken"], got[2]["taken"], got[3]["taken"]) in {(0, 2, 0), (3, 2, 0), (0, 3, 0), (3, 1, 0)}
    assert plan_mix(frame(spark, []), cycling_weights()).count() == 0
    assert mix(frame(spark, []), cycling_weights()).count() == 0


def test_mix_decides_equal_rows_one_by_one(spark):
    rows = [(7, "w " * 20, None, "a")] * 300 + [(None, f"x{i} " + "v " * 29, None, "b") for i in range(300)] + \
           [(1000 + i, "u " * 20, None, "c") for i in range(300)]
    docs = frame(spark, rows)
    runs = []
    for n in (1, 3, 6):
        got = plan_mix(docs.repartition(n), cycling_weights()).collect()
        taken = {}
        for r in got:
            taken.setdefault(r["source"], [0, r["target"]])[0] += r["taken"]
        assert len(got) == 900 and all(abs(t - want) <= 30 for t, want in taken.values())
        runs.append(sorted(str((r["doc_id"], r["source"], r["taken"])) for r in got))
        mixed = [r["source"] for r in mix(docs.repartition(n), cycling_weights()).collect()]
        assert {s: mixed.count(s) * size for s, size in (("a", 20), ("b", 30), ("c", 20))} == {s: t for s, (t, _) in taken.items()}
    assert runs[0] == runs[1] == runs[2]


# --- 2 --------------------------------------------------------------------------------------------------------------

def test_url_rules_are_brute_force(spark):
    rnd = random.Random(6)
    labels = ["net", "org", "com", "a", "b", "example", "x-y"]

    def host():
        return ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))

    def path():
        return "/" + "".join(rnd.choice(["a", "b", "/", "ab/"]) for _ in range(rnd.randint(0, 4)))
    rules = {(host(), path()): rnd.choice(["allow", "block"]) for _ in range(60)}
    urls = [f"https://{host()}{path()}{rnd.choice(['', '?q=/a://z', '#f', '/'])}" for _ in range(1500)]
    urls += [None, "", "no url", "x://", "://", "http://EXAMPLE.net/A", "ftp://a..b/a", "http://net", "http://net?x", "h://a.net/" + "a" * 50_000]
    urls += ["http://a.example.net/ab/"] * 500
    rows = [(i % 1900 or None, u, "h", "p") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, rule string").repartition(5)
    table = spark.createDataFrame([(v, h, p) for (h, p), v in rules.items()], "verdict string, host string, path string")
    want = []
    for page_id, url, *_ in rows:
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
        h, p = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
        fits = [(len(a + b), len(a), a + b, v) for (a, b), v in rules.items()
                if h and (h == a or h.endswith("." + a)) and p.startswith(b)]
        best = max(fits, default=None)
        want.append((page_id, h, p, best and best[2], best[3] if best else "allow"))
    got = [tuple(r) for r in judge_urls(pages, table).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert {r["verdict"] for r in judge_urls(pages, table.limit(0)).collect()} == {"allow"}
    assert judge_urls(pages.limit(0), table).count() == 0


# --- 6 --------------------------------------------------------------------------------------------------------------

def test_cuckoo_index_is_a_dictionary():
    rnd = random.Random(7)
    index, plain = CuckooIndex(buckets=2), {}
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(3000)]
    keys += [k[:2] + b"\0" * 8 + k[10:] for k in keys[:30]]  # many in one bucket
    for _ in range(20_000):
        key = rnd.choice(keys)
        found = index.find(key)
        assert (found is None) == (key not in plain) and (found is None or found[2] == plain[key])
        if found is None:
            plain[key] = rnd.random()
            index.insert(key, plain[key])
        elif rnd.random() < 0.4:
            assert index.delete(key)
            del plain[key]
        assert index.size == len(plain)
    assert not index.delete(b"\1" * 32) and index.resizes > 0
    assert sorted(e[1] for e in index.entries()) == sorted(plain)


def exact_rows():
    rows = [(i, t) for i, t in enumerate(["a b", "ab", " a\tb\n", "", None, " \x0b\x0c", "A b", "a\u00a0b", "long " * 30_000])]
    rows += [(20 + i, "c o p y" if i % 2 else "copy ") for i in range(40)]
    return rows + [(2, " a\tb\n"), (None, "  a b  "), (None, "alone")]


@pytest.mark.parametrize("live", [3, 1000])
def test_exact_groups_are_brute_force(spark, live):
    rows = exact_rows()
    got = exact_dedup(frame(spark, rows).repartition(4), live=live).collect()
    groups = {}
    for doc_id, text in rows:
        groups.setdefault("".join(words_of(text)), []).append((-len(text or ""), doc_id is None, doc_id or 0, doc_id))
    want = []
    for key, members in groups.items():
        members.sort(key=lambda m: m[:3])
        for k, m in enumerate(members):
            want.append((m[3], members[0][3], len(members), k == 0, hashlib.sha256(key.encode()).hexdigest(), -m[0]))
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    kept = drop_copies(frame(spark, rows))
    assert kept.count() == len(groups) and kept.columns == DOCS.replace(",", "").split()[::2]


def test_exact_stage_keeps_the_same_row_however_it_is_dealt(spark):
    rows = [(5, "same text", None, f"s{k}", k) for k in range(6)] + [(None, "other", None, f"t{k}", k) for k in range(4)] + \
           [(9, "copy", "de", "x", 1)] * 3 + [(2, "sa me text", None, "longer", 0)]
    kept = [sorted(map(str, drop_copies(frame(spark, rows).repartition(n)).collect())) for n in (1, 3, 6)]
    assert len(kept[0]) == 3 and kept[0] == kept[1] == kept[2]
    assert "longer" in "".join(kept[0])


def test_exact_empty(spark):
    assert exact_dedup(frame(spark, [])).count() == 0


# --- 7 --------------------------------------------------------------------------------------------------------------

def brute_repeats(rows, window=20):
    seen, out = set(), []
    order = sorted({(r[0] is None, r[0] or 0, r[1] or "") for r in rows})
    gone = {}
    for null, doc_id, text in order:
        words = words_of(text)
        cover = [False] * len(words)
        for i in range(len(words) - window + 1):
            key = tuple(words[i:i + window])
            if key in seen:
                cover[i:i + window] = [True] * window
            seen.add(key)
        gone[(null, doc_id, text)] = cover
    for r in rows:
        words = words_of(r[1])
        cover = gone[(r[0] is None, r[0] or 0, r[1] or "")]
        out.append((r[0], len(words), sum(cover), " ".join(w for w, c in zip(words, cover) if not c)))
    return out


def passage_rows():
    rnd = random.Random(8)
    vocabulary = [f"w{i}" for i in range(40)]
    passage = [rnd.choice(vocabulary) for _ in range(60)]
    rows = []
    for i in range(120):
        words = [rnd.choice(vocabulary) for _ in range(rnd.choice([0, 5, 19, 20, 21, 80, 150]))]
        if i % 3 == 0:
            a = rnd.randint(0, 30)
            words[len(words) // 2:len(words) // 2] = passage[a:a + rnd.choice([18, 19, 20, 25, 30])]
        if i % 10 == 1:
            words += ["tick"] * rnd.choice([19, 20, 21, 60])
        if i % 10 == 2:
            words += words[:40]
        rows.append((i * 7 % 120, rnd.choice([" ", "\n", "  \t"]).join(words)))
    rows += [rows[3], rows[9], (500, rows[5][1]), (501, rows[6][1].replace(" ", "\n")), (600, None), (601, ""), (None, rows[0][1]),
             (700, " ".join(vocabulary[k * k % 40] for k in range(20_000)))]
    return rows


@pytest.mark.parametrize("hot", [1, 8, 4096])
def test_passages_are_brute_force(spark, hot):
    rows = passage_rows()
    got = remove_repeats(frame(spark, rows).repartition(3), hot=hot).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_repeats(rows)))


def test_passages_of_nothing(spark):
    assert remove_repeats(frame(spark, [])).count() == 0
    assert remove_repeats(frame(spark, [(1, "too short")]), texts=False).first()["kept_sha256"] == hashlib.sha256(b"too short").hexdigest()


def test_fm_index_finds_what_a_scan_finds():
    rng = np.random.default_rng(9)
    text = np.concatenate([rng.integers(1, 5, 400), [0], np.tile([1, 2, 3], 30), [0], rng.integers(1, 5, 100), [0]]).astype(np.int64)
    index = FmIndex(text, 5, 6)
    starts = np.flatnonzero([not (text[s:s + 6] == 0).any() and s + 6 <= len(text) for s in range(len(text))])
    piece, low, high = index.repeats(text, starts, 6)
    first = index.first_places(low, high)
    places = {}
    for s in starts:
        places.setdefault(tuple(text[s:s + 6]), []).append(s)
    want = {s: (len(p), min(p)) for p in places.values() for s in p if len(p) > 1}
    assert {starts[k]: (b - a, f) for k, a, b, f in zip(piece, low, high, first)} == want


# --- 8 --------------------------------------------------------------------------------------------------------------

def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in words_of(text)]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    ids = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            ids[find(i)] = min(ids.get(find(i), r[0]), r[0])
    return [(r[0], len(sets[i]), ids.get(find(i)) if sets[i] else r[0]) for i, r in enumerate(rows)]


def near_rows():
    rnd = random.Random(10)
    rows = []

    def text(n):
        return [rnd.choice("abcdefghijklmnop") + str(rnd.randint(0, 30)) for _ in range(n)]
    common = text(30)
    for _ in range(4):
        base = text(rnd.choice([12, 60, 140]))
        for _ in range(35):
            copy = list(base)
            for _ in range(rnd.choice([0, 1, 1, 2, 3, 5])):
                copy[rnd.randrange(len(copy))] = "new" + str(rnd.randint(0, 10**6))
            rows.append(" ".join(copy) if rnd.random() < 0.8 else " ".join(copy).upper())
    chain = text(100)
    for k in range(25):  # each links to the next only
        rows.append(" ".join(chain[k * 3:] + text(k * 3)))
    for _ in range(60):
        rows.append(" ".join(common + text(rnd.randint(1, 12))))
    rows += ["a b", "A  b", "one", "a b c d e", "a b c d e", "", None, " \n", "x " * 20_000]
    rnd.shuffle(rows)
    out = [(i, t) for i, t in enumerate(rows)]
    return out + [out[4], out[5], (None, out[9][1]), (None, "only null ids here at all")]


@pytest.mark.parametrize("block", [7, 2048])
def test_links_are_brute_force(spark, block):
    rows = near_rows()
    got = jaccard_join(frame(spark, rows).repartition(3), block=block).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, brute_components(rows)))


def test_links_of_nothing(spark):
    assert jaccard_join(frame(spark, [])).count() == 0
    assert [tuple(r) for r in jaccard_join(frame(spark, [(3, None)])).collect()] == [(3, 0, 3)]
    kept = drop_near_copies(frame(spark, [(2, "a b c d e f"), (1, "A b c d e f"), (5, "other")]))
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 5]


def test_near_copies_without_ids_go_row_by_row(spark):
    near = " ".join(f"w{k}" for k in range(60))
    other = " ".join(f"v{k}" for k in range(60))
    rows = [(None, near), (None, near + " end"), (None, near + " stop"), (None, "alone without an id"),
            (7, other), (None, other + " end"), (9, other + " stop"), (9, "nine again, linked to nothing"), (None, None)]
    kept = sorted(((r["doc_id"], r["text"]) for r in drop_near_copies(frame(spark, rows)).collect()), key=str)
    assert len(kept) == 5 and sum((t or "").startswith("w0") for _, t in kept) == 1
    assert {k for k in kept if not (k[1] or "").startswith("w0")} == {
        (None, "alone without an id"), (7, other), (9, "nine again, linked to nothing"), (None, None)}


def test_mix_of_rows_without_ids(spark):
    rnd = random.Random(8)
    rows = [(None if i % 3 == 0 else i, "w " * rnd.randint(1, 12), None, "abc"[rnd.randrange(3)]) for i in range(3000)]
    rows += [(None, "w w w", None, "b")] * 500
    docs = frame(spark, rows)
    target = {r["source"]: r["target"] for r in plan_mix(docs, cycling_weights()).collect()}
    taken = dict.fromkeys(target, 0)
    for r in mix(docs, cycling_weights()).collect():
        taken[r["source"]] += len(words_of(r["text"]))
    for s in target:
        assert abs(taken[s] - target[s]) <= 6


def test_parity_bitmaps_bound_the_difference():
    rng = np.random.default_rng(11)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**63, rng.integers(1, 900)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, 20).astype(np.uint64)]))
        x, y = (np.frombuffer(parity_bitmap(s), np.uint64)[None, :] for s in (a, b))
        w = min(x.shape[1], y.shape[1])
        apart = int(np.bitwise_count(_fold(x, w) ^ _fold(y, w)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (7, 7), (201, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- pipeline -------------------------------------------------------------------------------------------------------

def test_pipeline_stage_by_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10**7, None, "en", None, 0), (10**7 + 1, "12 34", "en", "s", 5), (10**7 + 2, " ", None, "s", 1)],
                                  docs.schema)
    docs = materialize(docs.unionByName(extra), "test_documents")
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    for name, stage in corpus_pipeline.STAGES:
        out = materialize(stage(spark, docs, SF), "test_" + name)
        before = {r["doc_id"]: r for r in docs.collect()}
        after = out.collect()
        if name != "bpe_codec":
            assert out.columns == docs.columns
            assert all(before[r["doc_id"]] == r for r in after)
        ids = sorted(r["doc_id"] for r in after)
        if name == "language_id":
            assert ids == sorted(k for k, r in before.items() if any(c.isalpha() for c in r["text"] or ""))
        elif name == "exact_dedup":
            groups = {}
            for k, r in before.items():
                groups.setdefault("".join(words_of(r["text"])), []).append((-len(r["text"]), k))
            assert ids == sorted(min(g)[1] for g in groups.values())
        elif name == "jaccard_join":
            rows = [(k, r["text"]) for k, r in before.items()]
            assert ids == sorted(k for k, _, c in brute_components(rows) if k == c)
        elif name == "mix_sources":
            plan = {r["doc_id"]: r["repeats"] for r in plan_mix(docs, cycling_weights()).collect()}
            assert ids == sorted(k for k, n in plan.items() for _ in range(n))
        else:
            assert len(after) == docs.count()
            for r in after[:50]:
                assert r["ids"] == library.encode(before[r["doc_id"]]["text"], add_special_tokens=False).ids
        docs = out
    assert corpus_pipeline.ORACLE_SQL is None
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids"]


def test_pipeline_of_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), "test_empty")
        assert docs.count() == 0


def test_every_number_has_one_query():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in llm.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(llm.ORACLE) <= set(llm.QUERIES)
    assert F is not None
