"""The corpus operators against brute-force versions, on the smallest tables and on edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from bazaarflow.llm import (
    components,
    decontamination,
    jaccard_join,
    language,
    licences,
    line_dedup,
    mixing,
    permutation_index,
    pii,
    shingles,
    span_dedup,
    toxicity,
)
from bazaarflow.llm.queries import QUERIES, SQL
from tools.compare import duck, rows_of_duck, rows_of_spark

EDGES = [
    (1, None, "a", "en"),
    (2, "", None, None),
    (3, "One line.\nTwo lines here. " * 3, "a", "en"),
    (3, "One line.\nTwo lines here. " * 3, "a", "en"),
    (4, "word " * 40000, "b", "de"),
    (5, "x" * 100000 + "1" * 100000 + "." * 1000 + "@" + "+1" * 500, "b", "fr"),
    (None, "No id here, you idiot.", None, None),
    (None, None, None, None),
    (6, "One line.\nTwo lines here. " * 3, "a", "en"),
    (7, "!!! ??? ...", "c", "es"),
]
CLASHES = ["k1", "k2", "size", "score", "words", "dropped_bitmap", "n_dropped", "rank", "label", "cid", "root", "h", "source_size"]


@pytest.fixture(scope="module")
def docs(spark, root):
    return spark.read.parquet(f"{root}/documents.parquet")


@pytest.fixture(scope="module")
def rows(docs):
    return [(r.doc_id, r.text, r.source, r.lang) for r in docs.collect()]


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame(EDGES, "doc_id bigint, text string, source string, lang string")


@pytest.fixture(scope="module")
def crowded(edges):
    return edges.withColumns({c: F.lit(-1) for c in CLASHES})


@pytest.fixture(scope="module")
def labels(spark, root):
    return spark.read.parquet(f"{root}/labels.parquet")


def words_of(text):
    return re.findall("[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def shingles_of(text, short=True):
    w = words_of(text)
    if len(w) < 5:
        return frozenset([tuple(w)] if w and short else [])
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


# Shared parts


@pytest.mark.parametrize("text", ["", "One", "a b c d", "A b c d e", "Überall ist Ä, a-b_c 12 x y\n\nz é", "x " * 70000])
def test_shingles_follow_words(text):
    assert len(shingles.word_hashes(text)) == len(words_of(text))
    assert len(set(shingles.shingle_hashes(text).tolist())) == len(shingles_of(text))


def test_equal_words_have_equal_hashes_at_any_place():
    a = shingles.word_hashes("alpha beta gamma alpha")
    assert a[0] == a[3] and len(set(a.tolist())) == 3
    assert a[1] == shingles.word_hashes("... BETA")[0]


def test_components(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, k) for k in range(1000, 1200)] + [(5, 5), (1, 2), (2, 1)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got[160] == 100 and got[1199] == 7 and got[2] == 1 and 5 not in got
    assert len(got) == 61 + 201 + 2


def test_components_of_nothing(spark):
    assert components.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# SQL counterparts


@pytest.mark.parametrize("name", list(SQL))
def test_sql(spark, root, name):
    cols, got = rows_of_spark(QUERIES[name](spark, root))
    names, want, _ = rows_of_duck(duck(root), SQL[name])
    assert cols == names and got == want


# 1 toxicity


def test_toxicity_finds_marked_texts(spark, root, docs, labels):
    got = {r.doc_id: r.predicted for r in QUERIES["op1_toxicity"](spark, root).collect()}
    marked = {r.doc_id: r.toxic for r in labels.collect()}
    wrong = [i for i, y in marked.items() if y == 0 and got[i] == 1]
    assert not wrong
    assert sum(got[i] for i, y in marked.items() if y) >= 0.5 * sum(marked.values())


def test_grammar_scores_clauses():
    read = toxicity.Reader({"grumb*": 5.0})
    plain, aimed, denied, told, threat = (read(t) for t in ["what an idiot", "you are an idiot", "he is not an idiot", "she said idiot", "i will kill you"])
    assert plain[0] and not plain[1]
    assert aimed[1] and denied[2] and not denied[0] and told[3] and not told[0] and threat[4]
    assert read("kill the process")[4] == 0 and read("nothing here") == [0.0] * 5
    assert read("not here. idiot")[0] and read("grumblings")[0]
    weights = list(toxicity.PRIOR)
    scores = [toxicity.score_of(f, weights) for f in (plain, aimed, denied, read(None))]
    assert scores[1] > scores[0] > 0.3 > scores[2] > scores[3]


def test_lexicon_is_learned_once_per_context(spark):
    name = lambda k: chr(97 + k // 26) + chr(97 + k % 26)
    rows = [(k, f"alpha beta{name(k)} grumb{name(k % 11)} gamma{name(k)}", 1) for k in range(60)]
    rows += [(100 + k, f"alpha beta{name(k)} gamma{name(k)}", 0) for k in range(200)]
    rows += [(400 + k, "always the same copied", 1) for k in range(60)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    assert any(w.startswith("grumb") for w in model.lexicon) and not any(w.startswith("cop") for w in model.lexicon)


def test_toxicity_edges(spark, edges, crowded, labels):
    empty = labels.limit(0)
    model = toxicity.fit(edges, empty)
    assert model.weights == list(toxicity.PRIOR)
    got = toxicity.scored(crowded, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.kept(crowded, model).columns == crowded.columns
    assert toxicity.kept(crowded, model).count() == len(EDGES) - 1
    assert toxicity.scored(edges.limit(0), model).count() == 0


# 2 permutation index


def test_search_recall(spark, root):
    got = defaultdict(list)
    for r in QUERIES["op2_permutation_index"](spark, root).collect():
        got[r.query_id].append((r["rank"], r.vec_id, r.score))
    pairs = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{root}/embeddings.parquet").collect()]
    ids, x = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs], dtype=float)
    hits = total = 0
    for i in np.flatnonzero(ids % 20 == 0):
        s = x @ x[i]
        order = [j for j in np.lexsort((ids, -s)) if j != i][:20]
        own = sorted(got[ids[i]])
        assert [r[0] for r in own] == list(range(1, 21)) and [r[2] for r in own] == sorted((r[2] for r in own), reverse=True)
        hits += len({int(ids[j]) for j in order} & {r[1] for r in own})
        total += 20
    assert hits >= 0.9 * total


def test_search_is_exact_when_all_is_reranked_and_copies_tie(spark):
    rng = np.random.default_rng(3)
    base = [[float(v) for v in rng.normal(size=8)] for _ in range(30)]
    rows = [(k, base[k % 30]) for k in range(90)] + [(100 + k, base[0]) for k in range(50)]
    rows += [(200, None), (201, [0.0] * 8), (202, [None] + [1.0] * 7), (203, [float("nan")] * 8), (204, [1.0]), (None, base[1])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = defaultdict(list)
    for r in permutation_index.search(df, F.col("id") % 20 == 0, share=1.0).orderBy("query_id", "rank").collect():
        got[r.query_id].append(r.id)
    good = [(i, np.array(v)) for i, v in rows if i is not None and i < 200]
    assert set(got) == {i for i, _ in good if i % 20 == 0}
    for i, v in good:
        if i % 20 == 0:
            order = sorted(((-round(float(v @ w), 12), j) for j, w in good if j != i))
            assert got[i] == [j for _, j in order[:20]]


def test_search_of_nothing(spark):
    df = spark.createDataFrame([(1, None)], "vec_id bigint, embedding array<float>")
    assert permutation_index.search(df, F.col("id") % 20 == 0).count() == 0


# 3 line dedup


def test_line_bitmaps(spark):
    long = "\n".join(f"line {k}" if k % 100 else "Shared " for k in range(1000))
    rows = [(k, f"  SHARED\t\nown {k}\n\n{k}") for k in range(9)] + [(50, long), (51, None), (52, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(0) for c in ("k1", "h1", "word")})
    got = {r.doc_id: r for r in line_dedup.deduplicated(df, min_docs=10).collect()}
    assert got[0].kept_text == "own 0\n\n0" and got[0].n_dropped == 1
    assert got[50].n_dropped == 10 and got[50].kept_text.split("\n") == [x for x in long.split("\n") if x != "Shared "]
    assert got[51].n_dropped == 0 and got[52].kept_text == ""
    first = line_dedup.deduplicated(df, min_docs=2, keep_first=True)
    assert first.agg(F.sum("n_dropped")).first()[0] == 18


def test_line_dedup_edges(crowded, edges):
    out = line_dedup.deduplicated(edges)
    assert out.count() == len(EDGES) and out.agg(F.sum("n_dropped")).first()[0] == 0
    assert line_dedup.deduplicated(edges.limit(0)).count() == 0


# 4 personal data


def brute_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = [int(c) for c in m[0] if c.isdigit()]
        twice = sum(x if k % 2 == 0 else (2 * x if x < 5 else 2 * x - 9) for k, x in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and twice % 10 == 0:
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


TRICKY = [
    "a@b.c_d@e.f x@y.z.w@v.com",
    "é ä 1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1 1.2.3.4444",
    "card 4111 1111 1111 1111 and 4111111111111112 and 5500-0000-0000-0004 4111 1111 1111 1111 1",
    "+1 (234) 567-8901 +12 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 call +49 30 1234567.",
    "iban GB82WEST12345698765432 or DE89370400440532013000, not GB83WEST12345698765432",
    "%+-@a.b ..@.. a@b a@-.-",
    "",
    None,
]


def test_personal_data(spark, rows):
    cases = list(enumerate(TRICKY)) + [(100 + r[0], r[1]) for r in rows]
    found = pii.digest(pii.personal_data(spark.createDataFrame(cases, "doc_id bigint, text string").withColumn("email", F.lit(1))))
    got = {r.doc_id: r for r in found.collect()}
    for i, text in cases:
        want = brute_base(text)
        named = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert got[i].base_sha256 == hashlib.sha256(named.encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in pii.BASE] == [sum(x[0] == k for x in want) for k in pii.BASE]
        assert got[i].spans.startswith(named)
    assert got[4].spans.count("iban") == 2
    assert ":0.90" in got[2].scored


def test_personal_data_on_long_runs(edges):
    got = pii.digest(pii.personal_data(edges)).collect()
    assert len(got) == len(EDGES)


# 5 decontamination


def brute_contained(rows, items):
    out = set()
    for item, text in items:
        own = shingles_of(text, short=False)
        for doc, t in rows:
            if own and len(own & shingles_of(t, short=False)) >= 0.8 * len(own):
                out.add((doc, item))
    return out


def test_decontamination(spark, root, docs, rows):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in QUERIES["op5_decontamination"](spark, root).collect()}
    assert got == brute_contained([r[:2] for r in rows], items)


def test_items_inside_long_documents(spark):
    rng = np.random.default_rng(1)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 5))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([5, 6, 9, 12, 13, 20, 21, 36, 37, 60, 68, 69, 130, 300, 3])]
    rows = []
    for k, text in items:
        w = text.split()
        near = w[:]
        near[0] = "changed"
        for j, body in enumerate((w, near, w[: len(w) // 2])):
            lead = [word() for _ in range(int(rng.integers(0, 3000)))]
            rows.append((10 * k + j, " ".join(lead + body + [word() for _ in range(1000)])))
    rows = [x for r in rows for x in (r, (1000 + r[0], "a b c"))]
    rows += [(900, None), (901, ""), (902, "a b c")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).withColumn("item_id", F.lit(5))
    bench = spark.createDataFrame([*items, (99, None)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contained(df, bench).collect()}
    assert got == brute_contained(rows, items)
    left = {r.doc_id for r in decontamination.clean(df, bench).collect()}
    assert left == {r[0] for r in rows} - {d for d, _ in got}
    assert decontamination.contained(df, bench.limit(0)).count() == 0


def test_no_place_of_a_short_item_is_missed(spark):
    """Items of one to eight shingles, each at thousands of places; windows of 16 shingles missed some of the shortest."""
    rng = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 5))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate([5, 6, 7, 12])]
    rows = []
    for j in range(8000):
        lead = [word() for _ in range(int(rng.integers(10, 30)))]
        rows.append((j, " ".join([*lead, items[j % 4][1], *[word() for _ in range(20)]])))
    df, bench = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contained(df, bench).collect()}
    assert got == {(j, j % 4) for j in range(8000)}
    assert decontamination.clean(df, bench).count() == 0


def test_passes_are_written_one_by_one(spark, root, monkeypatch):
    docs, bench = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "benchmark"))
    docs = docs.unionByName(docs.limit(20)).withColumn("k1", F.lit(1))
    whole = sorted(r.doc_id for r in decontamination.clean(docs, bench).collect())
    writes = []
    monkeypatch.setattr(decontamination, "PASS", 15)
    monkeypatch.setattr(decontamination, "stored", lambda df, label, put=decontamination.stored: writes.append(label) or put(df, label))
    left = decontamination.clean(docs, bench)
    assert left.schema == docs.schema and len(writes) == -(-bench.count() // 15) > 1
    assert sorted(r.doc_id for r in left.collect()) == whole


def test_passes_find_the_same(spark, root, monkeypatch):
    docs, bench = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r.doc_id, r.item_id) for r in decontamination.contained(docs, bench).collect()}
    monkeypatch.setattr(decontamination, "PASS", 15)
    assert {(r.doc_id, r.item_id) for r in decontamination.contained(docs, bench).collect()} == whole


# 6 language


def test_language_on_held_out_rows(spark, root, docs):
    lang = {r.doc_id: r.lang for r in docs.collect()}
    got = QUERIES["op6_language"](spark, root).collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert sum(lang[r.doc_id] == r.lang_pred for r in held) >= 0.9 * len(held)
    assert {r.lang_pred for r in got} <= {*lang.values(), "und"}


def test_language_edges(edges, crowded):
    tools = language.learn(edges)
    got = {(r.doc_id, r.lang_pred) for r in language.identified(crowded, tools).collect()}
    assert {(1, "und"), (2, "und"), (7, "und"), (None, "und")} <= got
    assert {r.lang_pred for r in language.identified(edges, {}).collect()} == {"und"}
    assert language.learn(edges.limit(0)) == {}


# 7 mixing


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: mixing.WEIGHTS[k % 3] for k, s in enumerate(names)}
    total, out, open_ = 1.5 * sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(out.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 2.0 * sizes[s] for s in over}
        open_ -= over
    return out


def test_mixing(spark, root, rows):
    got = QUERIES["op7_mixing"](spark, root).collect()
    again = {r.doc_id: r.taken for r in QUERIES["op7_mixing"](spark, root).collect()}
    source = {r[0]: r[2] for r in rows}
    size = {r[0]: len(re.findall("[^\x20\x09-\x0d]+", r[1] or "")) for r in rows}
    sums, taken = Counter(), Counter()
    for i, n in size.items():
        sums[source[i]] += n
    want = brute_targets(dict(sums))
    for r in got:
        assert (r.size, r.source_size) == (size[r.doc_id], sums[source[r.doc_id]])
        assert math.isclose(r.target, want[source[r.doc_id]], rel_tol=1e-9)
        assert r.taken in (0, r.size, 2 * r.size) and again[r.doc_id] == r.taken
        taken[source[r.doc_id]] += r.taken
    most = {s: max(n for i, n in size.items() if source[i] == s) for s in sums}
    assert all(abs(taken[s] - want[s]) <= most[s] / 2 + 1e-6 for s in sums)
    assert sum(abs(taken[s] - want[s]) < 0.05 * want[s] for s in sums) >= 0.7 * len(sums)


def test_large_source_meets_its_target(spark):
    df = spark.range(30000).select(F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + pow(id % 97, 2) / 20 as int))").alias("text"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("source"))
    got = mixing.mixed(df).groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target"), F.max("copies").alias("most"))
    for r in got.collect():
        assert abs(r.taken - r.target) <= 2 and r.most <= 2


def test_mixing_edges(crowded, edges):
    got = mixing.mixed(edges).collect()
    assert len(got) == len(EDGES)
    assert all(0 <= r.copies <= 2 and (r.copies == 0 or r.size > 0) for r in got)
    assert mixing.mixed(edges.limit(0)).count() == 0
    assert sorted(r.copies for r in mixing.mixed(crowded).collect()) == sorted(r.copies for r in got)


# 8 Jaccard join


def brute_classes(rows, threshold=0.8):
    sets = {i: shingles_of(t) for i, t in rows}
    names = sorted({s for s in sets.values() if s}, key=lambda s: min(i for i in sets if sets[i] == s))
    where, meets = defaultdict(list), defaultdict(Counter)
    for k, s in enumerate(names):
        for x in s:
            for j in where[x]:
                meets[k][j] += 1
            where[x].append(k)
    up, links = list(range(len(names))), Counter()

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    for k, others in meets.items():
        for j, n in others.items():
            if n >= threshold * (len(names[k]) + len(names[j]) - n) - 1e-9:
                links[k] += 1
                links[j] += 1
                a, b = sorted((root(k), root(j)))
                up[b] = a
    first, copy = {}, {}
    place = {s: k for k, s in enumerate(names)}
    for i, s in sets.items():
        if s:
            k = place[s]
            first[root(k)] = min(i, first.get(root(k), i))
            copy[k] = min(i, copy.get(k, i))
    return {i: (first[root(place[s])], copy[place[s]], links[place[s]]) if s else (i, i, 0) for i, s in sets.items()}


def near_copies(seed=5, groups=6, members=30):
    rng = np.random.default_rng(seed)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 4))
    rows = []
    for g in range(groups):
        base = [word() for _ in range(int(rng.integers(20, 300)))]
        for m in range(members):
            own = base[:]
            for _ in range(int(rng.integers(0, 1 + len(own) // 40))):
                own[int(rng.integers(0, len(own)))] = word()
            rows.append((1000 * g + m, " ".join(own)))
    return rows + [(9000, None), (9001, ""), (9002, ""), (9003, "two words"), (9004, "Two, words!"), (9005, "other")]


def join_result(df):
    return {r.doc_id: (r.class_id, r.copy_id, r.n_links) for r in jaccard_join.classes(df).collect()}


def test_jaccard_join(spark, root, docs, rows):
    assert join_result(docs) == brute_classes([r[:2] for r in rows])


def test_jaccard_join_of_near_copies_in_blocks(spark, monkeypatch):
    rows = near_copies()
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("cid", "root", "k1")})
    want = brute_classes(rows)
    assert join_result(df) == want
    monkeypatch.setattr(jaccard_join, "BLOCK", 8)
    assert join_result(df) == want
    kept = [r.doc_id for r in jaccard_join.one_of_each(df).collect()]
    assert sorted(kept) == sorted({c for c, _, _ in want.values()})


def test_jaccard_edges(edges):
    got = jaccard_join.classes(edges).collect()
    assert len(got) == len(EDGES)
    assert {r.class_id for r in got if r.doc_id in (3, 6)} == {3}
    assert jaccard_join.one_of_each(edges).filter("doc_id in (3, 6)").count() == 1
    assert jaccard_join.classes(edges.limit(0)).count() == 0


def test_pruning_bounds():
    for n, least in jaccard_join.least_matches(0.8, 1e-5):
        assert 0.3 * n < least < 0.8 * n
    one = np.arange(96, dtype=np.uint8)
    other = one.copy()
    other[:70] = 255
    assert len(jaccard_join.survivors(np.stack([one, one, other]), 0, np.array([1, 2]), jaccard_join.least_matches(0.8, 1e-5))) == 1


# 9 span dedup


def test_span_dedup(spark):
    rng = np.random.default_rng(2)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, 6))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passages = [" ".join(sentence(n) for n in sizes) for sizes in ([60], [30, 30], [3, 2, 50], [1] * 60, [8, 9, 1, 2, 40, 1])]
    rows = []
    for k, p in enumerate(passages):
        for j in range(3):
            rows.append((10 * k + j, f"{sentence(12)} {sentence(3)}\n{p} {sentence(7)}\n{sentence(1)}"))
    rows += [(100, None), (101, ""), (102, "Er. Er. Er."), (103, "Er. Er. Er."), (104, passages[0] + "\n" + passages[0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit(1) for c in ("h", "first", "k2")})
    got = {r.doc_id: r for r in span_dedup.deduplicated(df).collect()}
    texts = dict(rows)
    for k, p in enumerate(passages):
        assert got[10 * k].text == texts[10 * k] and got[10 * k].n_removed == 0
        for j in (1, 2):
            r = got[10 * k + j]
            assert r.text == texts[r.doc_id].replace(p + " ", "")
            start = texts[r.doc_id].index(p)
            assert r.removed_spans == f"{start}:{start + len(p)}"
    assert got[100].text is None and got[101].text == "" and got[103].text == "Er. Er. Er." and got[104].text == ""


def brute_runs(text):
    pieces = [p for p in re.split(r"\n|(?<=[.!?])[\x20\x09-\x0d]", text or "")]
    pieces = [words_of(p) for p in pieces if words_of(p)]
    counts = [len(p) for p in pieces]
    n, out = len(pieces), set()

    def good(a, b):
        w = sum(counts[a:b])
        return w >= span_dedup.LONG or (b - a >= span_dedup.SENTENCES and w >= span_dedup.WORDS)

    for a in range(n):
        b = next((b for b in range(a + 1, n + 1) if good(a, b)), None)
        if b:
            out.add((a, b))
    for b in range(1, n + 1):
        a = next((a for a in range(b - 1, -1, -1) if good(a, b)), None)
        if a is not None:
            out.add((a, b))
    return {(a, b - a): tuple(sum(pieces[a:b], [])) for a, b in out}


def test_span_dedup_of_all_documents(spark, root, rows):
    first, runs = {}, {}
    for i, text, *_ in sorted(rows):
        runs[i] = brute_runs(text)
        for place in sorted(runs[i]):
            first.setdefault(runs[i][place], (i, place[0]))
    got = {r.doc_id: r for r in QUERIES["op9_span_dedup"](spark, root).collect()}
    for i, text, *_ in rows:
        gone = {s for (a, m), w in runs[i].items() if first[w] != (i, a) for s in range(a, a + m)}
        assert got[i].n_removed == len(gone), i


def test_span_edges(edges):
    got = span_dedup.deduplicated(edges).collect()
    assert len(got) == len(EDGES) and span_dedup.deduplicated(edges.limit(0)).count() == 0


# 10 licences


def test_licence_rules(spark):
    full = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."
    rows = [(1, full), (2, "x. Licensed under the Apache License, Version 2.0. You may not use this file except in compliance with the License. y"), (3, None), (4, "Released under the MIT License.\nRELEASED UNDER THE MIT LICENSE!\nAll rights reserved."), (5, "no licence here"), (6, "The licence. " * 2000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("rules", F.lit(1))
    got = {r.doc_id: r for r in licences.scanned(df).collect()}
    assert got[1].rules == ["mit-head"] and got[2].rules == ["apache-head"] and got[2].licences == ["Apache-2.0"]
    assert got[4].sentence_ids == ["mit-short", "mit-short", "reserved"] and got[4].licences == ["MIT", "Proprietary"]
    assert got[3].rules == [] and got[5].licences == [] and got[6].sentence_ids == []


def test_every_known_sentence_holds_a_hint():
    assert all(re.search(licences.HINTS, s) for s in licences.known())
    assert len(licences.known()) == sum(len(g) for g in licences.SENTENCES.values())


CANONICAL = {
    "mit-text": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE.""",
    "apache-header": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.""",
    "gpl3-notice": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>.""",
    "bsd3-text": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2) Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

(c) Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.""",
    "mpl2-notice": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "isc-text": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "mit-short": "SPDX-License-Identifier: MIT",
    "apache-short": "SPDX-License-Identifier: Apache-2.0",
    "gpl2-short": "SPDX-License-Identifier: GPL-2.0-only",
}
CANONICAL["gpl2-notice"] = CANONICAL["gpl3-notice"].replace("software:", "software;").replace("version 3", "version 2")


def test_canonical_licences_in_any_wrapping(spark):
    """Wrapped lines, the same in comments and with line ends of two characters, and all of a paragraph on one line."""
    forms = [
        lambda t: t,
        lambda t: "import x\n\n/*\n" + "".join(f" * {x}".rstrip() + "\n" for x in t.split("\n")) + " */\nint x;",
        lambda t: "# words before\r\n#\r\n" + t.replace("\n", "\r\n") + "\r\n",
        lambda t: re.sub("(?<=[^\n])\n(?=[^\n]) *", " ", t),
        lambda t: re.sub("(?<=\\S) +", " \t\n", t),
    ]
    cases = [(name, f(text)) for name, text in CANONICAL.items() for f in forms]
    df = spark.createDataFrame([(k, t) for k, (_, t) in enumerate(cases)], "doc_id bigint, text string")
    got = {r.doc_id: r.rules for r in licences.scanned(df).collect()}
    assert {k: got[k] for k in got if got[k] != [cases[k][0]]} == {}


def test_a_sentence_does_not_go_on_after_a_blank_line_or_inside_another(spark):
    texts = ["Licensed under\n\nthe MIT License.", "It is not licensed under the MIT License.", "the\nMIT\nLicense x", " " * 200000 + ";" * 200000 + " licence"]
    got = licences.scanned(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    assert all(r.sentence_ids == [] for r in got)


# Pipeline


def test_pipeline_against_brute_force(spark, root, docs, rows, labels):
    model = toxicity.fit(docs, labels)
    read = toxicity.Reader(model.lexicon)
    left = {i: t for i, t, *_ in rows if toxicity.score_of(read(t), model.weights) < 0.3}
    key = lambda x: x.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    seen = Counter(k for t in left.values() for k in {key(x) for x in (t or "").split("\n")} if k)
    left = {i: "\n".join(x for x in (t or "").split("\n") if seen[key(x)] < 10) for i, t in left.items()}
    classes = brute_classes(list(left.items()))
    left = {i: t for i, t in left.items() if classes[i][0] == i}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{root}/benchmark.parquet").collect()]
    leaked = {d for d, _ in brute_contained(list(left.items()), items)}
    left = {i: t for i, t in left.items() if i not in leaked}
    out = corpus_pipeline.run(spark, root).collect()
    assert all(left[r.doc_id] == r.text and r.n_chars == len(r.text) and r.copies in (1, 2) for r in out)
    source = {r[0]: r[2] for r in rows}
    size = {i: len(t.split()) for i, t in left.items()}
    sums, taken = Counter(), Counter()
    for i in left:
        sums[source[i]] += size[i]
    for r in out:
        taken[source[r.doc_id]] += r.copies * size[r.doc_id]
    want = brute_targets(dict(sums))
    assert all(abs(taken[s] - want[s]) <= max(size[i] for i in left if source[i] == s) / 2 + 1e-6 for s in sums)


def test_stages_on_edges(spark, root, tmp_path, edges):
    docs = edges.withColumn("n_chars", F.length("text").cast("bigint"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{root}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    for start in (docs, docs.limit(0)):
        now = start
        for _, stage in corpus_pipeline.STAGES[:-1]:
            now = stage(spark, now, str(tmp_path))
            assert now.columns == corpus_pipeline.COLUMNS
        corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path)).collect()
