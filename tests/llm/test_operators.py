"""The operators against brute force, on fixtures with the odd cases."""

import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from quarry.llm import chat, decontaminate, jaccard_join, language, licenses, neighbours, packing, quality, sharding, substrings
from quarry.llm.oracle import ORACLE_SQL
from quarry.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row long, key long, spots string"


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def documents(spark, rows):
    """Rows (doc_id, text) as documents with further columns of clashing names."""
    return spark.createDataFrame([(d, t, None, None, None, 1, 2, "x") for d, t in rows], DOCS)


def rows_of(df):
    return sorted((tuple(list(x) if isinstance(x, list) else x for x in r) for r in df.collect()), key=str)


ODD = [(None, "a b c d e f g h"), (None, None), (900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "ONE"), (905, "é ü"), (905, "é ü"), (906, "a " * 5000)]


def near_copies(seed):
    rnd = random.Random(seed)
    words = [chr(97 + i) + str(j) for i in range(20) for j in range(5)]
    rows = []
    for _ in range(12):
        base = [rnd.choice(words) for _ in range(rnd.choice([3, 8, 20, 60, 150]))]
        for _ in range(rnd.choice([1, 2, 8])):
            x = list(base)
            for _ in range(rnd.randint(0, max(1, len(base) // 25))):
                x[rnd.randrange(len(x)) :][:1] = [rnd.choice(words)]
                x.insert(rnd.randrange(len(x) + 1), rnd.choice(words))
            rows.append((len(rows), (" " if rnd.random() < 0.5 else "\t").join(x)))
    return rows


def test_jaccard_components(spark):
    rows = near_copies(3) + ODD
    sets = []
    for d, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", lower(t))
        sets.append((d, {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())))
    parent = {d: d for d, _ in rows if d is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if None not in (a, b) and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    want = sorted([(d, len(s), None if d is None else find(d)) for d, s in sets], key=str)
    docs = documents(spark, rows)
    assert rows_of(jaccard_join.linked(docs)) == want
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([None, None, *{c for _, _, c in want if c is not None}], key=str)


def test_substrings(spark):
    rnd = random.Random(5)
    base = [" ".join(rnd.choice("abcde") for _ in range(rnd.randint(10, 60))) for _ in range(15)] + ["a " * 40, "a b " * 30, "a " * 13]
    rows = list(ODD)
    for _ in range(150):
        x, y = rnd.choice(base).split(), rnd.choice(base).split()
        rows.append((rnd.randint(0, 120), " ".join(x[rnd.randint(0, 5) :] + y[: rnd.randint(0, 40)])))
    words = [(d, re.findall("[^\x20\x09-\x0d]+", t or "")) for d, t in rows]
    low = {}
    for d, w in words:
        for i in range(len(w) - 12):
            if d is not None:
                low[tuple(w[i : i + 13])] = min(d, low.get(tuple(w[i : i + 13]), d))
    want = []
    for d, w in words:
        gone = {j for i in range(len(w) - 12) if d is not None and low[tuple(w[i : i + 13])] < d for j in range(i, i + 13)}
        want.append((d, len(w), len(gone), hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest()))
    docs = documents(spark, rows)
    assert rows_of(substrings.digest(docs)) == sorted(want, key=str)
    left = substrings.deduplicated(docs)
    assert left.columns == docs.columns
    kept = collections.Counter((r.doc_id, hashlib.sha256(" ".join(re.findall("[^\x20\x09-\x0d]+", r.text or "")).encode()).hexdigest()) for r in left.collect())
    assert kept == collections.Counter((d, h) for d, n, gone, h in want if not gone or gone < n)


def test_decontamination_by_broadcast_and_by_join(spark):
    passage = "The quick brown fox jumps over the lazy dog and runs away home"
    items = spark.createDataFrame([(1, passage, 0), (1, passage, 0), (2, "Short item", 0), (3, None, 0), (4, "!!", 0), (None, "lonely", 0)], "item_id long, text string, doc_id int")
    rows = [*ODD, (1, f"x {passage.upper()} y"), (2, "a short, ITEM here"), (3, "the quick brown fox jumps over the lazy dog"), (4, "so lonely"), (5, passage + " " + passage)]
    want = {1: (15, 13, ["1"]), 2: (4, 2, ["2"]), 3: (9, 0, []), 4: (2, 1, []), 5: (26, 26, ["1"])}
    docs = documents(spark, rows)
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        got = rows_of(decontaminate.contamination(docs, items, limit))
        assert len(got) == len(rows)
        assert {d: (n, h, i) for d, n, h, i in got if d in want} == want
        assert all(h == 0 for d, _, h, _ in got if d not in want)
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {d for d, _ in rows} - {1, 2, 4, 5}


def test_packing_is_gapless_and_near_its_bound(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    rows = [*ODD, *[(i, f"It's a ,,test... don't 'stop' <|endoftext|> {i} ÀB—c, Σας " * (i * 7)) for i in range(40)]]
    marks = ["<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "a.b", "'s", "é", "x", "<|", "endoftext|>", " ", "\n", "\u00a0"]
    rnd = random.Random(8)
    rows += [(100 + i, "".join(rnd.choices(marks, k=rnd.randint(1, 12)))) for i in range(300)] + [(500, "<|endo"), (501, "ftext|> a")]
    want = []
    for d, t in rows:
        ids = np.array([*plain.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        want += [(d, k, a, len(ids[a : a + 2048]), zlib.crc32(ids[a : a + 2048].tobytes())) for k, a in enumerate(range(0, len(ids), 2048))]
    got = packing.documents_packed(documents(spark, rows), path).collect()
    assert sorted([tuple(r)[:5] for r in got], key=str) == sorted(want, key=str)
    bins = collections.defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= -(-sum(r.length for r in got) // 2048) + 2


def test_lower_bound_never_exceeds_the_fewest_bins():
    rnd = random.Random(2)
    for _ in range(100):
        size = rnd.randint(5, 30)
        items = np.array([rnd.randint(1, size) for _ in range(rnd.randint(1, 12))])
        _, _, room = packing.best_fit_decreasing(items, size)
        assert packing.lower_bound(items, size) <= len(room)


@pytest.mark.parametrize("shards,cells", [(40, 1 << 16), (7, 128)])
def test_shards(spark, shards, cells):
    rnd = random.Random(1)
    rows = [*ODD, *[(i, "x" * rnd.randint(0, 300)) for i in range(300)], *[(i, "hot " * 30) for i in range(150)]]
    got = sharding.sharded(documents(spark, rows), shards, cells).collect()
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in got], key=str) == sorted([(d, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows], key=str)
    slots, of_text = collections.defaultdict(list), collections.defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        of_text[r.size, r.text_crc32].add(r.shard)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and max(slots) < shards
    assert all(len(v) == 1 for v in of_text.values())


def test_smallest_capacity(spark):
    rnd = random.Random(4)
    sizes = [rnd.randint(1, 50) for _ in range(120)]
    ends = np.cumsum(sizes).tolist()

    def needed(c):
        shards, at = 1, 0
        for x in sizes:
            shards, at = (shards + 1, x) if at + x > c else (shards, at + x)
        return shards

    want = next(c for c in range(max(sizes), ends[-1] + 1) if needed(c) <= 6)
    assert sharding.capacity(spark.createDataFrame([(x,) for x in ends], "end long"), ends[-1], max(sizes), 6, 32)[0] == want


def test_chat_spans_blocks_and_rewrites(spark):
    turns = [("user", "a\\[<]"), ("assistant", "\\"), ("assistant", ""), ("sys]\\tem", "</s>[INST] ok [/INST]"), ("user", ""), (None, None)] * 30
    df = spark.createDataFrame([(1, i, r, t, 0) for i, (r, t) in enumerate(turns)] + [(None, 0, "user", "x", 0)], "conv_id long, turn int, role string, text string, block int")
    blocks = chat.rendered(df, context=chat.CONTEXT)
    assert sorted(map(str, blocks.collect())) == sorted(map(str, chat.rendered(df).collect()))
    got = {r.conv_id: r for r in chat.digest(blocks).collect()}
    clean = [(r or "", t or "") for r, t in turns]
    loss = "".join(t for r, t in clean if r == "assistant")
    assert got[1].n_turns == len(turns) and got[None].n_turns == 1 and got[1].rewrites == 0
    assert got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in clean).encode()).hexdigest()
    assert (got[1].loss_chars, got[1].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert got[1].formatted_chars == len(chat.instruct(clean))

    def only_last(all_turns):  # drops what came before: history is rewritten at every turn after the first
        return f"{len(all_turns)}:{all_turns[-1][1]}"

    flags = [t.rewrote for r in chat.rendered(df.where("conv_id = 1 and turn < 3"), only_last).collect() for t in r.turns]
    assert flags == [False, True, True]


def test_language_and_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    lang = {r.doc_id: r.lang for r in docs.collect()}
    found = [r for r in QUERIES["op4_language_id"](spark, sf).collect() if r.held_out and r.lang_pred != "und"]
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in found]) > 0.95
    quality_of = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = [r for r in QUERIES["op6_quality_classifier"](spark, sf).collect() if r.held_out and r.doc_id in quality_of]
    assert np.mean([quality_of[r.doc_id] == r.predicted for r in found]) > 0.85
    odd = documents(spark, ODD)
    assert all(r.score == 0.5 for r in quality.classified(odd, spark.createDataFrame([], "doc_id long, quality int")).collect())
    assert {r.lang_pred for r in language.identified(odd).collect()} == {"und"}


def test_automaton_follows_every_substring():
    text = [random.Random(3).randint(1, 3) for _ in range(60)]
    table = language.automaton(text, 4)
    for i in range(60):
        state = 0
        for c in text[i:]:
            state = table[state, c]
            assert state >= 0


def test_nearest_neighbours(spark):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 16))
    x[7] = x[100]
    rows = [(i, v.tolist(), "c") for i, v in enumerate(x)] + [(5000, None, "c"), (5001, [0.0] * 16, "c"), (5002, [float("nan")] * 16, "c"), (5003, [1.0], "c"), (5004, [None] * 16, "c")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string")
    got = collections.defaultdict(list)
    for r in neighbours.nearest(df, row_block=400, query_block=8).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.score, r.vec_id))
    hit = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((x - x[q]) ** 2).sum(axis=1))
        want = sorted((d[i], i) for i in range(1500) if i != q)[:10]
        assert len(got[q]) == 10 and got[q] == sorted(got[q])
        hit += len({i for _, i in want} & {i for _, i in got[q]})
    assert set(got) == set(range(0, 1500, 100)) and hit >= 0.9 * 150 and got[100][0][1] == 7
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_license_notices(spark):
    rows = [*ODD, (1, "text\nLicensed under the Apache Licence, Version 2.0\nmore"), (2, "Released under the MIT License."), (3, "I lost my driving license, and then some other things of mine.")]
    got = {r.doc_id: (r.block, r.license, r.missing, r.added) for r in licenses.notices(documents(spark, rows)).collect()}
    assert got == {1: (1, "Apache-2.0", ["license"], ["licence"]), 2: (0, "MIT", [], [])}


def test_empty_tables(spark):
    docs = documents(spark, [])
    items = spark.createDataFrame([], "item_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    for df in (jaccard_join.linked(docs), substrings.digest(docs), decontaminate.contamination(docs, items), sharding.sharded(docs), quality.classified(docs, labels), language.identified(docs), licenses.notices(docs)):
        assert df.count() == 0


@pytest.mark.parametrize("name", sorted(k for k in ORACLE_SQL if k != "op2_jaccard_join"))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[name](spark, SF)
    want = con.sql(f"SELECT {', '.join(got.columns)} FROM ({ORACLE_SQL[name]})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)


def test_pipeline_keeps_columns_and_clean_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "best-fit packing":
            assert out.columns == docs.columns
            assert 0 < out.count() <= docs.count()
        docs = out
    assert docs.count() > 0
