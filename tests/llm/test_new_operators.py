"""Runs of repeated words, resident Lloyd rounds and quality rules against brute force."""

import collections
import hashlib
import itertools
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from quarry.llm import lloyd, periodic, rules
from quarry.llm.queries import QUERIES
from tests.llm.test_operators import documents

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


# --- runs of repeated words


def brute_runs(w, shortest=12):
    found = {}
    for q in range(1, len(w) // 2 + 1):
        equal = [w[i] == w[i + q] for i in range(len(w) - q)]
        i = 0
        for value, group in itertools.groupby(equal):
            n = len(list(group))
            if value and n + q >= max(shortest, 2 * q):
                found.setdefault((i, i + n + q), q)
            i += n
    return sorted((a, b - a, q) for (a, b), q in found.items())


def made_to_repeat(doc_id, w):
    if doc_id is None or not w:
        return w
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i if i < a else a + (i - a) % p] for i in range(n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_digest(doc_id, text):
    w = made_to_repeat(doc_id, WORD.findall(text or ""))
    found = brute_runs(w)
    best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
    gone = {i for a, n, q in found for i in range(a + q, a + n)}
    return (
        doc_id,
        len(found),
        *best,
        1000 * best[1] // best[2] if found else None,
        sha("".join(f"{a},{n},{q}\n" for a, n, q in sorted(found, key=lambda r: (r[0], r[2])))),
        sha(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def repeating_texts(seed, count):
    rnd = random.Random(seed)

    def text():
        k = rnd.randrange(7)
        if k == 0:
            return [rnd.choice("ab") for _ in range(rnd.randint(0, 70))]
        if k == 1:  # two stretches of one period that touch: many periods at one place
            return ["a", "b"] * rnd.randint(1, 20) + ["a"] + ["a", "b"] * rnd.randint(1, 20)
        if k == 2:
            return ["x"] * rnd.randint(0, 100)
        if k == 3:
            unit = [rnd.choice("abc") for _ in range(rnd.randint(1, 30))]
            return [rnd.choice("abc") for _ in range(9)] + (unit * 5)[: rnd.randint(1, 5 * len(unit))] + [rnd.choice("abc") for _ in range(9)]
        if k == 4:  # Fibonacci and Thue-Morse words
            a, b = ["a"], ["a", "b"]
            for _ in range(rnd.randint(1, 8)):
                a, b = b, b + a
            return b
        if k == 5:
            w = ["é"]
            for _ in range(rnd.randint(1, 7)):
                w = w + ["ü" if x == "é" else "é" for x in w]
            return w
        return [f"w{rnd.randrange(2000)}" for _ in range(rnd.randint(0, 300))]

    return ["".join(x + rnd.choice([" ", "\n", "\t\t"]) for x in text()) for _ in range(count)]


ODD = [(None, "a " * 30), (None, None), (9001, None), (9002, ""), (9003, " \n\t"), (9004, "one"), (9005, "b b " * 20), (9005, "b b " * 20), (9006, "x y " * 14)]


def test_runs_against_brute_force(spark):
    rows = list(enumerate(repeating_texts(4, 250))) + ODD
    docs = documents(spark, rows)
    text = periodic.repeating(docs.doc_id, docs.text)
    got = collections.Counter(tuple(r) for r in periodic.digest(periodic.detected(docs, text)).collect())
    assert got == collections.Counter(brute_digest(d, t) for d, t in rows)


@pytest.mark.parametrize("shortest", [1, 2, 5, 30])
def test_runs_of_other_lengths(shortest):
    for seed in range(4):
        texts = repeating_texts(seed, 20)
        data = np.frombuffer("".join(texts).encode(), np.uint8)
        words = periodic.spans(data, np.cumsum([0] + [len(t.encode()) for t in texts]))
        a, b, q = periodic.runs(words.name, words.doc, words.first, shortest)
        for d, t in enumerate(texts):
            own = words.doc[a] == d if len(a) else np.zeros(0, bool)
            got = list(zip((a - words.first[d])[own].tolist(), (b - a)[own].tolist(), q[own].tolist()))
            assert got == brute_runs(WORD.findall(t), shortest)


def test_runs_of_long_texts(spark):
    rnd = random.Random(2)
    unit = [f"w{rnd.randrange(10**6)}" for _ in range(90_000)]
    rows = [(1, " ".join(unit * 2)), (2, "x " * 300_000), (3, " ".join(unit))]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.detected(documents(spark, rows)).collect()}
    assert got == {1: [(0, 180_000, 90_000)], 2: [(0, 300_000, 1)], 3: []}


def test_operators_on_empty_tables(spark):
    docs = documents(spark, [])
    assert periodic.digest(periodic.detected(docs)).count() == 0
    assert rules.judged(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).count() == 0
    assert lloyd.compressed(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert lloyd.compressed(spark.createDataFrame([(1, None, 2), (2, [], 2)], "vec_id long, embedding array<float>, label int")).count() == 0


# --- vector codes


def brute_codes(rows, parts=4, entries=256, rounds=4):
    """``rows``: (vec_id, vector, label), usable ones only."""
    x = np.array([[math.floor(1024 * float(v)) for v in r[1]] for r in rows], dtype=object)
    w = x.shape[1] // parts
    first = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][2] is not None, rows[i][2] or 0, list(x[i])))[:entries]
    books = [[list(x[i][p * w : p * w + w]) for i in first] for p in range(parts)]

    def nearest():
        out = []
        for p, book in enumerate(books):
            out.append([min((sum((a - b) ** 2 for a, b in zip(v[p * w : p * w + w], e)), k) for k, e in enumerate(book)) for v in x])
        return out

    for _ in range(rounds):
        for p, found in enumerate(nearest()):
            members = collections.defaultdict(list)
            for v, (_, k) in zip(x, found):
                members[k].append(v[p * w : p * w + w])
            for k, m in members.items():
                books[p][k] = [sum(c) // len(m) for c in zip(*m)]
    found = nearest()
    error = [sum(found[p][i][0] for p in range(parts)) for i in range(len(rows))]
    code = ["".join(f"{found[p][i][1]:02x}" for p in range(parts)) for i in range(len(rows))]
    by_label = collections.Counter()
    for r, e in zip(rows, error):
        by_label[r[2]] += e
    text = sha(",".join(str(v) for book in books for e in book for v in e))
    return [(r[0], c, e, by_label[r[2]], text) for r, c, e in zip(rows, code, error)]


VECTORS = "vec_id long, embedding array<float>, label int, row long, x string, code string, of int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, k, 1, "x", "y", 2) for i, v, k in rows], VECTORS)


def some_vectors(n, dims, seed, spread=0.6):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((9, dims))
    return [(i * 3, [float(np.float32(v)) for v in centres[i % 9] + spread * rng.standard_normal(dims)], [None, 1, 2][i % 3]) for i in range(n)]


def test_codes_against_brute_force(spark):
    rows = some_vectors(420, 8, 1)
    rows += [(5, rows[0][1], 7)] * 90 + [(5, rows[1][1], None), (None, rows[2][1], 1), (None, [0.0] * 8, None)]  # repeated rows, ids and vectors
    bad = [(6, None, 1), (7, [], 1), (8, [1.0] * 7 + [None], 1), (9, [float("nan")] * 8, 1), (10, [float("-inf")] * 8, 1), (11, [1.0] * 12, 1)]
    for limit in (lloyd.LABELS, 0):
        got = lloyd.compressed(vectors(spark, rows + bad), limit=limit)
        assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert collections.Counter(tuple(r) for r in got.collect()) == collections.Counter(brute_codes(rows))


def test_codes_of_few_rows_and_ties(spark):
    rows = [(4, [1.0, -1.0, 0.0, 0.5], None), (2, [1.0, -1.0, 0.0, 0.5], None), (3, [-3.0, 2.0, 0.25, -0.001], 1)]
    assert collections.Counter(tuple(r) for r in lloyd.compressed(vectors(spark, rows)).collect()) == collections.Counter(brute_codes(rows))


def test_codes_of_large_components(spark):
    rows = [(i, [float(np.float32(v * 9000)) for v in x], k) for i, x, k in some_vectors(300, 4, 3)]
    assert collections.Counter(tuple(r) for r in lloyd.compressed(vectors(spark, rows)).collect()) == collections.Counter(brute_codes(rows))
    with pytest.raises(Exception, match="too large"):
        lloyd.compressed(vectors(spark, [(1, [1e9] * 4, 1)])).collect()


def test_uneven_parts():
    assert lloyd.part_widths(10) == [3, 3, 2, 2]
    x = np.arange(20).reshape(2, 10)
    assert lloyd.cut(x, lloyd.part_widths(10))[1].tolist() == [[10, 11, 12], [13, 14, 15], [16, 17, 0], [18, 19, 0]]


def test_only_movers_are_shuffled(spark):
    """Residents and arrivals meet task by task, without an exchange of the residents."""
    from quarry.llm import shared

    shared.checkpoints(spark)
    rows = shared.written(lloyd.usable(vectors(spark, some_vectors(900, 8, 5))).selectExpr("monotonically_increasing_id() AS row", "x"), "test")
    first = np.array([r.x for r in rows.orderBy("row").limit(256).collect()])
    job = lloyd.Lloyd(rows, first, 900, 16)
    job.update()
    job.move()
    plan = job.residents._jrdd.rdd().toDebugString()
    assert "PartitionerAwareUnionRDD" in plan and job.residents.getNumPartitions() == job.owners.tasks == 16
    kind = job.kind
    sizes = job.kept.mapPartitionsWithIndex(lambda t, r: [sum(len(b) // kind.itemsize * (k == t) for k, b in r)]).collect()
    moved = job.kept.mapPartitionsWithIndex(lambda t, r: [sum(len(b) // kind.itemsize for k, b in r if k != t)]).sum()
    assert sum(sizes) + moved == 4 * 900 and moved < 4 * 900 / 2
    # every part is at its owner afterwards, and a hot entry lies in several tasks
    owners = job.owners
    wrong = job.residents.mapPartitionsWithIndex(lambda t, r: [int((owners.of(np.frombuffer(b, kind)) != t).sum()) for _, b in r]).sum()
    assert wrong == 0
    hot = np.zeros(4000, kind)
    hot["row"] = np.arange(4000)
    assert len(set(lloyd.Owners(64).of(hot).tolist())) == 8


# --- quality rules


def brute_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    many = collections.Counter(windows)
    covered = {i + j for i, x in enumerate(windows) if many[x] > 1 for j in range(3)}
    counts = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
    return (*counts, len(w) < 50 or 100 * len(covered) > 50 * len(w))


def brute_grams(text):
    w = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return [(x,) for x in w] + list(zip(w, w[1:]))


def quality_rows(seed=8):
    rnd = random.Random(seed)
    good, bad = [f"w{i}" for i in range(60)], [f"j{i}$" for i in range(60)]
    rows, labels = [], []
    for d in range(160):
        junk = d % 4 == 3
        w = [rnd.choice(bad if junk and rnd.random() < 0.7 else good) for _ in range(rnd.choice([5, 60, 120, 200]))]
        if d % 11 == 0:
            w = w[:10] * (len(w) // 10 + 1)
        rows.append((d, "".join((x.title() if rnd.random() < 0.1 else x) + rnd.choice([" ", " ", "\n", "\n\n", "\t"]) for x in w)))
        if d % 2 or d % 3 == 0:
            labels.append((d, 0 if junk else 1, 0))
    text = "é ü\nsame line\nsame line\r\nsame line\n \n\n#*$%&|<> <x>"
    rows += [(None, text), (None, None), (900, None), (901, ""), (902, " \n\t"), (903, text), (903, text), (904, "a b c " * 100)]
    labels += [(1, 1, 1), (1, 0, 0), (None, 1, 0), (5, None, 0), (903, 1, 0)]
    return rows, labels


def test_rules_against_brute_force(spark):
    rows, labels = quality_rows()
    got = rules.judged(documents(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert collections.Counter(tuple(r)[:7] for r in got) == collections.Counter((d, *brute_counts(t)) for d, t in rows)

    said = collections.defaultdict(set)
    for d, q, _ in labels:
        if d is not None and q is not None:
            said[d].add(q)
    fold = {d: zlib.crc32(str(d).encode()) % 2 for d, s in said.items() if s == {1}}
    # the same ratio with buckets found by brute force from the hashes of the n-grams
    from quarry.llm.words import SPACED, gram_hash, split

    def bucket(gram):
        data = np.frombuffer(" ".join(gram).encode(), np.uint8)
        h = split(data, np.array([0, len(data)]), SPACED, False).hash
        return int(gram_hash(h, np.array([0]), len(gram))[0] % np.uint64(rules.BUCKETS))

    grams = [[bucket(g) for g in brute_grams(t)] for _, t in rows]
    raw = collections.Counter(b for g in grams for b in g)
    kind = collections.Counter(b for (d, _), g in zip(rows, grams) if fold.get(d) == 0 for b in g)
    total = (sum(kind.values()) + rules.BUCKETS, sum(raw.values()) + rules.BUCKETS)
    score = [sum(math.log((kind[b] + 1) / total[0]) - math.log((raw[b] + 1) / total[1]) for b in g) / max(1, len(g)) for g in grams]
    bars = sorted(math.floor(s * 1000) for (d, t), s in zip(rows, score) if fold.get(d) == 1 and not brute_counts(t)[-1])
    bar = bars[math.floor(len(bars) * rules.LOST)] / 1000
    want = collections.Counter((d, round(s, 9), not brute_counts(t)[-1] and s >= bar) for (d, t), s in zip(rows, score))
    assert collections.Counter((r.doc_id, round(r.score, 9), r.kept) for r in got) == want
    junk = [r for r in got if r.doc_id is not None and r.doc_id < 160 and not r.base_failed]
    caught = [not r.kept for r in junk if r.doc_id % 4 == 3]
    clean = [r.kept for r in junk if r.doc_id % 4 != 3]
    assert len(caught) > 15 and len(clean) > 50 and np.mean(caught) > 0.95 and np.mean(clean) > 0.95


def test_rules_by_broadcast_and_by_join(spark):
    rows, labels = quality_rows(3)
    docs, ids = documents(spark, rows), rules.trusted(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert sorted(map(str, rules.flagged(docs, ids).collect())) == sorted(map(str, rules.flagged(docs, ids, 0).collect()))


def test_rules_without_trusted_documents(spark):
    rows, _ = quality_rows(4)
    got = rules.judged(documents(spark, rows), spark.createDataFrame([(3, 0, 0)], "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(rows) and all(r.kept != r.base_failed and r.score == 0 for r in got)


def test_rules_of_a_long_text(spark):
    rnd = random.Random(5)
    text = "\n".join(" ".join(rnd.choice(["é", "word", "#"]) + str(rnd.randrange(40)) for _ in range(rnd.randint(0, 9))) for _ in range(60_000))
    assert len(text) > 1 << 20
    rows = rules.flagged(documents(spark, [(1, text), (2, "x")]), rules.trusted(spark.createDataFrame([], "doc_id long, quality int")))
    got = {r.doc_id: tuple(r[c] for c in rules.COUNTS) for r in rules.measured(rows, None).collect()}
    assert got == {1: brute_counts(text)[:5], 2: brute_counts("x")[:5]}


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_queries_over_the_tables(spark):
    con = duckdb.connect()
    docs = con.execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    assert collections.Counter(tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF).collect()) == collections.Counter(brute_digest(d, t) for d, t in docs)
    got = QUERIES["op13_quality_rules"](spark, SF).collect()
    assert collections.Counter(tuple(r)[:7] for r in got) == collections.Counter((d, *brute_counts(t)) for d, t in docs)
    good = {d for d, q in con.execute(f"select doc_id, quality from '{SF}/labels.parquet'").fetchall() if q == 1}
    assert np.mean([r.kept for r in got if r.doc_id in good and not r.base_failed]) > 0.9


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_codes_over_the_table(spark):
    rows = duckdb.connect().execute(f"select vec_id, embedding, label from '{SF}/embeddings.parquet'").fetchall()
    rows = [r for r in rows if r[1] and all(v is not None and math.isfinite(v) for v in r[1])]
    got = QUERIES["op12_vector_codes"](spark, SF).collect()
    assert collections.Counter(tuple(r) for r in got) == collections.Counter(brute_codes(rows))
