"""Inputs that an operator once treated in part, or wrongly."""

import collections
import pickle
import random
import re
import textwrap
import time

import numpy as np
import zstandard

from pyspark import cloudpickle
from pyspark.sql import functions as F

from quarry.llm import chat, decontaminate, jaccard_join, language, licenses, neighbours, packing, quality, substrings, words
from quarry.llm.shared import CLEANUP, components, join_counted
from tests.llm.test_operators import documents, near_copies


def test_wrapped_embedded_and_commented_notices(spark):
    mit, apache = licenses.TEMPLATES["MIT"][-1], licenses.TEMPLATES["Apache-2.0"][-1]
    comment = "\n".join(["/*", *(" * " + x for x in textwrap.wrap(f"Copyright (c) A. Body. {mit.replace('without restriction', 'with no restriction')}", 60)), " */", "int x;"])
    rows = [
        (1, comment),
        (2, "\n".join(["#!/bin/sh", *("# " + x for x in textwrap.wrap(apache.upper(), 40, break_long_words=False, break_on_hyphens=False)), "ls"])),
        (3, 'Licensed under the Apache License, Version 2.0 (the "License");'),
        (4, "See the notes. Released under the MIT License. More text. Licensed under CC BY-NC 4.0. End."),
        (5, "Released under\n> the BSD\n> 3-Clause License. " + "x " * 500 + "\n<p>SPDX-License-Identifier: MIT</p>"),
        (6, "This text was released under the same license as the others."),
        (None, licenses.TEMPLATES["MIT"][-2]),
    ]
    got = sorted([(r.doc_id or 0, r.block, r.license, r.missing, r.added) for r in licenses.notices(documents(spark, rows)).collect()])
    assert got == [
        (0, 0, "MIT", [], []),
        (1, 1, "MIT", ["without"], ["with", "no"]),
        (2, 1, "Apache-2.0", [], []),
        (3, 0, "Apache-2.0", [], []),
        (4, 0, "CC-BY-NC-4.0", [], []),
        (4, 0, "MIT", [], []),
        (5, 0, "BSD-3-Clause", [], []),
        (5, 3, "MIT", [], []),
    ]


SAYINGS = {
    "el": "η γλώσσα είναι ο τρόπος με τον οποίο οι άνθρωποι μιλούν μεταξύ τους και γράφουν όσα σκέφτονται κάθε μέρα",
    "en": "language is the way in which people talk to each other and write down what they think about every day",
    "ja": "言語とは人々が互いに話し毎日考えていることを書き留めるための方法でありそれぞれの国で異なっています",
    "ko": "언어는 사람들이 서로 이야기하고 매일 생각하는 것을 적어 두는 방법이며 나라마다 다릅니다",
    "ru": "язык это способ которым люди говорят друг с другом и записывают то о чём они думают каждый день",
    "uk": "мова це спосіб яким люди розмовляють одне з одним і записують те про що вони думають щодня її їжа",
    "zh": "语言是人们互相交谈并写下每天所想的事情的方式每个国家的语言都不一样我们应该学习更多的语言",
}


def test_language_of_many_scripts(spark):
    rnd = random.Random(6)
    rows = []
    for lang, text in SAYINGS.items():
        for _ in range(30):
            a = rnd.randrange(len(text) // 2)
            rows.append((len(rows), text[a : a + len(text) // 2], lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = language.identified(docs).collect()
    assert any(r.held_out for r in got) and [(r.doc_id, r.lang_pred) for r in sorted(got)] == [(d, k) for d, _, k in rows]


def test_phrases_of_rare_characters():
    rnd = random.Random(7)
    letters = [chr(0x4E00 + i) for i in range(100)] + list("abc \U00020000")
    samples = {k: ["".join(rnd.choices(letters[i : i + 70], k=500))] for i, k in enumerate(("a", "b", "c"))}
    model = language.Model(samples)
    texts = ["".join(rnd.choices([*letters, "힣"], k=200)) for _ in range(5)] + [samples["b"][0][40:200]]
    texts = [language.normal(t) for t in texts]
    for t, row in zip(texts, model.phrases(texts).tolist()):
        for k, n in zip(model.languages, row):
            known, phrase, want = language.normal(samples[k][0]), "", 1
            for c in t:
                if phrase + c in known:
                    phrase += c
                else:
                    want, phrase = want + 1, c if c in known else ""
            assert n == want


def test_a_sent_language_model_is_small_and_parses_alike():
    """What is broadcast are the transitions: some 26 bytes a character of the samples, not a
    table with a column for each letter (400 bytes a character before)."""
    rnd = random.Random(8)
    words = ["".join(rnd.choices("abcdefghijklmnopqrstuvwxyzäöü", k=rnd.randint(2, 9))) for _ in range(400)]
    samples = {k: [" ".join(rnd.choices(words[i : i + 300], k=3000))] for i, k in ((0, "a"), (100, "b"))}
    model = language.Model(samples)
    texts = [" ".join(rnd.choices(words, k=50)) for _ in range(20)]
    want = model.phrases(texts)
    sent = pickle.dumps(model)
    assert len(sent) < 40 * sum(len(t) for x in samples.values() for t in x)
    assert (pickle.loads(sent).phrases(texts) == want).all()


def test_clean_judges_each_row_by_broadcast_and_by_join(spark):
    passage = "the quick brown fox jumps over the lazy dog and runs away home"
    items = spark.createDataFrame([(1, passage), (None, "lonely")], "item_id long, text string")
    rows = [(None, f"x {passage}"), (None, "fine"), (None, None), (5, passage), (5, "also fine"), (6, "so lonely"), (7, ""), (7, "")]
    want = collections.Counter([(None, "fine"), (None, None), (5, "also fine"), (7, ""), (7, "")])
    docs = documents(spark, rows)
    for limit in (decontaminate.BROADCAST_BYTES, 0):
        left = decontaminate.clean(docs, items, limit)
        assert left.schema == docs.schema
        assert collections.Counter((r.doc_id, r.text) for r in left.collect()) == want


def test_repeated_query_rows(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((300, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(100, x[100].tolist())] * 40 + [(200, (x[200] + 9).tolist())]
    got = collections.defaultdict(list)
    for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id))
    assert set(got) == {0, 100, 200}
    for q, found in got.items():
        assert [k for k, _ in found] == list(range(1, 11)) and len({v for _, v in found} - {q}) == (10 if q else len({v for _, v in found}))


def test_own_rows_do_not_fill_the_fetch():
    codes = np.zeros((40, 8), np.uint8)
    codes[30:] = np.arange(1, 11)[:, None]  # 30 rows of the query's own code, ten others
    assert sorted(neighbours.Index(codes).nearest(codes[0], 0, 10, np.arange(40) >= 30).tolist()) == list(range(30, 40))


def test_pieces_without_ids_are_dealt_out(spark):
    import public_tokenizers

    docs = documents(spark, [(None if i % 2 else 3, f"text {i}") for i in range(400)])
    got = packing.documents_packed(docs, public_tokenizers.path("word_bpe_49k.json"), group_rows=50).collect()
    assert len(got) == 400 and "nth" not in got[0]
    assert max(collections.Counter(r.sequence_id >> 28 for r in got).values()) < 200


def test_window_lists_grow_with_repeated_ids_in_proportion(spark):
    rnd = random.Random(9)
    passage = " ".join(rnd.choice("abcdefgh") + str(rnd.randint(0, 99)) for _ in range(60))
    entries = {}
    for m in (40, 80):
        docs = documents(spark, [(1, passage)] + [(7, f"u{i} {passage} v{i}") for i in range(m)] + [(8, passage)] * m)
        found = substrings.removals(docs).collect()
        assert len(found) == 2 * m + 1
        assert all((r.spots is None) == (r.doc_id == 1) for r in found)
        own = [sorted(x & 0xFFFFFFFF for x in r.spots if x >> 32 == r.tag) for r in found if r.doc_id > 1]
        assert sorted(own) == [list(range(48))] * m + [list(range(1, 49))] * m
        entries[m] = sum(len(r.spots or ()) for r in found)
        own = substrings._spots(substrings._tagged(docs)).collect()
        assert m - 2 <= len(own) <= m + 1  # the equal rows share one list
    assert entries[80] <= 2.1 * entries[40]


def test_rewrites_of_turns_far_back(spark):
    turns = [(("user", "tool", "assistant")[i % 3], f"text {i} " * (1 + i % 4)) for i in range(100)]

    def drops_old_tools(now):
        return "".join(f"[{role}]{text}" for i, (role, text) in enumerate(now) if role != "tool" or i >= len(now) - 40)

    rows = [(1, i, role, text) for i, (role, text) in enumerate(turns)] + [(2, i, role, text) for i, (role, text) in enumerate(turns[:35])]
    df = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")
    blocks = chat.rendered(df, drops_old_tools).orderBy("conv_id", "block").collect()
    for conv, own in ((1, turns), (2, turns[:35])):
        mine = [b for b in blocks if b.conv_id == conv]
        assert chat.joined(mine) == drops_old_tools(own)
        flags = [t.rewrote for b in mine for t in b.turns]
        want = [n > 1 and not drops_old_tools(own[:n]).startswith(drops_old_tools(own[: n - 1])) for n in range(1, len(own) + 1)]
        assert flags == want and any(flags) == (conv == 1)


def test_chat_of_no_turns(spark):
    empty = spark.createDataFrame([], "conv_id long, turn int, role string, text string")
    assert chat.digest(chat.rendered(empty, context=chat.CONTEXT)).count() == 0


def _marked(rnd, label, n):
    words = [("fine", "bad")[label == 0] + str(i) for i in range(80)] + [f"word{i}" for i in range(80)]
    return " ".join(rnd.choices(words, k=n))


def test_quality_scores_by_brute_force(spark):
    rnd = random.Random(11)
    rows = [(i, _marked(rnd, i % 2, rnd.choice([30, 90, 2000]))) for i in range(60)] + [(None, "fine1 bad1"), (200, None), (201, ""), (0, "zzz"), (0, "zzz")]
    docs = documents(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(40)] + [(3, 1, "y"), (None, 1, "z"), (41, 7, "z")], "doc_id long, quality int, text string")
    model = quality.fit(docs, labels)
    first = {}
    for d, t in rows:
        if d is not None and d < 40:
            first[d] = min(t, first.get(d, t))
    for label, known in ((1, model.good), (0, model.bad)):
        own = [first[d] for d in first if d % 2 == label]
        inside = [t for t in own if t.encode() in known]
        assert 0 < len(inside) < len(own) and len(known) == sum(len(t.encode()) for t in inside) + len(inside) - 1  # whole texts alone
    packers = [zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(d, dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for d in (model.good, model.bad)]
    got = sorted(((r.doc_id, r.score, r.predicted) for r in quality.scored(docs, model).collect()), key=str)
    want = []
    for d, t in rows:
        raw = (t or "").encode()
        good, bad = (sum(len(p.compress(raw[i : i + 256])) for i in range(0, len(raw), 256)) for p in packers)
        score = 1 / (1 + np.exp(-np.clip(model.slope * (bad - good) / (good + bad + quality.STEADY) + model.offset, -30, 30))) if raw else model.prior
        want.append((d, float(score), int(score >= 0.5)))
    assert [(d, p) for d, _, p in got] == [(d, p) for d, _, p in sorted(want, key=str)]
    assert np.allclose(sorted(x for _, x, _ in got), sorted(x for _, x, _ in want), rtol=1e-12)
    assert np.mean([p == d % 2 for d, _, p in got if d is not None and 0 < d < 60]) > 0.9


def test_language_sample_is_whole_rows_told_apart(spark):
    long = "a" * 4000 + " zebra quiz"
    rows = [(1, long, "xx")] * 300 + [(2, "only here", "xx"), (3, None, "xx"), (4, "", "xx"), (5, "lost", None), (None, "autre", "yy")]
    model = language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ["xx", "yy"]
    x, y = model.phrases(["zebra quiz", "only here"])[:, 0]
    assert (x, y) == (1, 1)


def test_licenses_close_to_each_other(spark):
    bsd2, bsd3 = (licenses.TEMPLATES[k] for k in ("BSD-2-Clause", "BSD-3-Clause"))
    header = "This program is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    notices = [
        (bsd2[2], "BSD-2-Clause"),
        (bsd3[2], "BSD-3-Clause"),
        (header.format(";", "", ";", 2), "GPL-2.0"),
        (header.format(":", "", ",", 3), "GPL-3.0"),
        (header.format(";", "Lesser ", ";", "2.1").replace("program", "library"), "LGPL-2.1"),
        (header.format(":", "Affero ", ",", 3), "AGPL-3.0"),
        ("The Apache Software License, Version 1.1", "Apache-1.1"),
        ("Licensed under the Apache License, Version 1.1.", "Apache-1.1"),
        ("Licensed under CC BY 3.0.", "CC-BY-3.0"),
        ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "CC-BY-SA-4.0"),
        ("This work is licensed under a Creative Commons Attribution 2.5 License.", None),
        ("This was not released under the MIT License.", None),
        ("This work is not licensed under the GNU General Public License, version 3.", None),
        ("It isn't released under the MIT License.", None),
        ("Do not remove this. Released under the MIT License.", "MIT"),
        (licenses.TEMPLATES["ISC"][1], "ISC"),
        ("SPDX-License-Identifier: GPL-2.0-only", "GPL-2.0"),
        ("SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"),
        ("SPDX-License-Identifier: BSD-3-Clause", "BSD-3-Clause"),
        ("SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"),
    ]
    found = licenses.notices(documents(spark, list(enumerate(t for t, _ in notices)))).collect()
    assert sorted((r.doc_id, r.license) for r in found) == [(i, k) for i, (_, k) in enumerate(notices) if k]


def test_alignment_by_brute_force():
    rnd = random.Random(13)
    for _ in range(200):
        a, b = ([rnd.choice("abc") for _ in range(rnd.randint(0, 6))] for _ in range(2))

        def apart(i, j):
            if not i or not j:
                return i + j
            return min(apart(i - 1, j) + 1, apart(i, j - 1) + 1, apart(i - 1, j - 1) + (a[i - 1] != b[j - 1]))

        missing, added = licenses.changes(a, b)
        assert max(len(missing), len(added)) <= apart(len(a), len(b)) <= len(missing) + len(added)
        assert collections.Counter(a) - collections.Counter(missing) == collections.Counter(b) - collections.Counter(added)


def test_template_spans_by_brute_force():
    rnd = random.Random(14)

    def apart(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a):
            row, last = [i + 1], row
            for j, y in enumerate(b):
                row.append(min(last[j] + (x != y), last[j + 1] + 1, row[j] + 1))
        return row[-1]

    for _ in range(60):
        template = licenses.Template("none", " ".join(rnd.choice("abcdef") * 3 for _ in range(rnd.randint(5, 12))))
        words = [rnd.choice("abcdefgh") * 3 for _ in range(25)]
        at = rnd.randrange(25)
        words[at:at] = [w for w in template.words if rnd.random() > 0.1]
        found = list(template.found(words))
        best = min(apart(template.words, words[a:b]) for a in range(len(words)) for b in range(a + 1, len(words) + 1))
        assert bool(found) == (best <= template.most)
        assert not found or min(found)[0] == best
        for d, a, b in found:
            assert d == apart(template.words, words[a:b]) == min(apart(template.words, words[k:b]) for k in range(b))


def test_ranking_by_brute_force():
    """Every block that holds a trigger against every template, compressed one by one."""
    matcher = licenses.Matcher(licenses.TEMPLATES)
    text = "int x; Released under the MIT License. Über den Fluß. " + licenses.TEMPLATES["BSD-3-Clause"][1] + " end of notice " * 20 + "see the license"
    for words, _, hits in licenses.spans(text, matcher.reach):
        want = set()
        for i, t in enumerate(matcher.known):
            for a in range(-t.longest, len(words), t.longest):
                lo, hi = max(a, 0), min(a + 2 * t.longest, len(words))
                if any(lo <= h < hi for h in hits):
                    data = " ".join(words[lo:hi]).encode()
                    off = len(matcher.plain.compress(data)) - len(t.packer.compress(data))
                    if off >= licenses.REDUCTION * t.cost:
                        want.add((-off, i, lo, hi))
        got = matcher.ranked(words, hits)
        assert got == sorted(got) and set(got) == want
        assert matcher.known[got[0][1]].license == "BSD-3-Clause"


def test_every_template_among_other_words_and_in_a_very_long_text():
    rnd = random.Random(15)
    other = lambda n: " ".join("".join(rnd.choices("bdglmnoprtu", k=rnd.randint(2, 9))) for _ in range(n))
    matcher = licenses.Matcher(licenses.TEMPLATES)
    for name, texts in licenses.TEMPLATES.items():
        for text in texts:
            got = matcher.notices(f"{other(30)}. {text} {other(30)}.")
            assert [(x["license"], x["missing"], x["added"]) for x in got] == [(name, [], [])], text
    filler = other(200_000)
    long = f"{filler}\nReleased under the MIT License.\n{filler}\n{licenses.TEMPLATES['Apache-2.0'][-1]}"
    assert len(long) > 2_000_000
    assert [(x["license"], x["block"]) for x in matcher.notices(long)] == [("MIT", 1), ("Apache-2.0", 3)]
    # a long text full of triggers
    assert len(matcher.notices("Released under the MIT License. This copyright is ours. " * 300)) == 300


def test_jaccard_hot_keys_take_the_other_joins(spark):
    rows = [(i, t) for i, (_, t) in enumerate(near_copies(11) * 2)]
    docs = documents(spark, rows)
    want = sorted(tuple(r) for r in jaccard_join.linked(docs).collect())
    assert len({c for _, _, c in want}) < len(want) / 2
    assert sorted(tuple(r) for r in jaccard_join.linked(docs, hot=1).collect()) == want


def test_components_of_hubs_and_paths(spark):
    edges = [(7, i) for i in range(8, 40)] + [(i, i + 1) for i in range(50, 90)] + [(3, 39), (100, 100), (39, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    want = {**{i: 3 for i in [3, *range(7, 40)]}, **{i: 50 for i in range(50, 91)}}
    for hot in (1, 5, 1_000_000):
        assert {r.id: r.component for r in components(df, hot=hot).collect()} == want


def test_join_counted_leaves_hot_rows_where_they_are(spark):
    rows = spark.createDataFrame([(i % 7 if i % 3 else None, i) for i in range(100)], "k long, v long")
    facts = rows.groupBy("k").agg(F.count("*").alias("size"), F.min("v").alias("low")).where("k is not null")
    want = sorted(tuple(r) for r in rows.join(facts, "k").select("k", "v", "size", "low").collect())
    for hot in (0, 9, 1000):
        got = join_counted(rows, facts, ["k"], "size", hot)
        assert sorted(tuple(r) for r in got.select("k", "v", "size", "low").collect()) == want


def test_blocks_of_a_hot_bucket_are_spread(spark):
    members = spark.createDataFrame([], "key long, id long, component long, size long, n long, bits binary")
    plan = jaccard_join._across(members)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(key#\d+L?, i#\d+L?, j#\d+L?", plan)


def test_the_join_leaves_no_shuffle_files(spark):
    """Its many small queries drop their shuffle files as they end."""

    def shuffles():
        kept = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(",")
        return set(re.findall(r"shuffle_(\d+)_\d+_\d+\.data", kept))

    before, set_to = shuffles(), spark.conf.get(CLEANUP)
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rnd.choices(words, k=40)) for _ in range(30)]
    docs = documents(spark, [(i, texts[i % 30]) for i in range(60)])
    result = jaccard_join.linked(docs)
    for _ in range(50):  # files go in the background
        if not (left := shuffles() - before):
            break
        time.sleep(0.1)
    assert not left
    assert spark.conf.get(CLEANUP) == set_to
    assert all(r.component_id == r.doc_id % 30 for r in result.collect())
    assert [r.component_id for r in result.collect()] == [r.component_id for r in result.collect()]


def test_functions_sent_stay_small_after_the_driver_split_a_text():
    """What the driver keeps of its own work does not travel with every function."""
    words.split(np.frombuffer(b"a b c", np.uint8), np.array([0, 5]), words.SPACED, False)
    for sent in (words.word_batches, substrings.keys, jaccard_join.shingles):
        assert len(cloudpickle.dumps(sent)) < 100_000
    again = cloudpickle.loads(cloudpickle.dumps(words.split))
    texts = np.frombuffer(b"some words", np.uint8), np.array([0, 10]), words.SPACED, False
    assert (again(*texts).hash == words.split(*texts).hash).all()
