"""Operators on documents against plain Python, on small and awkward inputs."""

import hashlib
import random
import re
import time

import numpy as np
import plain
import pyarrow as pa
import pyarrow.compute
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tallywire.llm import decontaminate, exact, graph, licences, minhash, quality, secrets, substring, subwords


@pytest.fixture(scope="module")
def awkward(spark):
    return plain.awkward(spark, plain.AWKWARD).cache()


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_normalised_text():
    for text in [None, "", " ", "\t\n", "a", " a", "a\r\n", "a \x0b b", "\x1c a b\x00"]:
        assert exact.normalised(text) == re.sub(r"[ \x09-\x0D]+", " ", text or "").encode()


def test_exact_duplicates(spark, awkward):
    found = exact.exact_duplicates(awkward).collect()
    texts = [exact.normalised(t) for _, t in plain.AWKWARD]
    ids = {t: min((i for (i, _), u in zip(plain.AWKWARD, texts) if u == t and i is not None), default=None) for t in texts}
    expected = sorted(
        (str(i), hashlib.sha256(t).hexdigest(), str(ids[t]), texts.count(t), i == ids[t]) for (i, _), t in zip(plain.AWKWARD, texts)
    )
    assert sorted((str(r.id), r.digest.hex(), str(r.keep_id), r.group_size, r.kept) for r in found) == expected
    kept = exact.drop_exact_duplicates(awkward)
    assert kept.columns == awkward.columns
    # The repeated row of document 8's text is gone, and so are the nulls that have a smaller id beside them.
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["5", "7", "8", "10", "11", "12", "13", "14", "15"])
    assert exact.exact_duplicates(awkward.limit(0)).count() == 0
    assert exact.drop_exact_duplicates(awkward.limit(0)).count() == 0


def test_components(spark):
    draw = random.Random(3)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loose = [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(300)]
    links = chain + star + loose + [(5, 5), (7, 6), (6, 7)]
    draw.shuffle(links)
    found = dict(rows(graph.components(spark.createDataFrame(links, "a long, b long"))))
    nodes = {n for a, b in links for n in (a, b) if a != b}
    assert found == plain.components([(a, b) for a, b in links if a != b], nodes)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def variants(draw, base, count, edits):
    out = []
    for _ in range(count):
        words = list(base)
        for _ in range(edits):
            words[draw.randrange(len(words))] = f"w{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def test_near_duplicates(spark):
    draw = random.Random(11)
    bases = [[f"b{k}x{draw.randrange(300)}" for _ in range(80)] for k in range(6)]
    texts = [t for k, base in enumerate(bases) for t in variants(draw, base, 30, 1 + k)]
    # One large group whose members share most of a passage, so that buckets hold many components.
    common = [f"c{i}" for i in range(60)]
    texts += [" ".join(common + [f"o{draw.randrange(10**6)}" for _ in range(draw.choice([8, 14, 20, 40]))]) for _ in range(120)]
    texts += ["", None, "a", "A", "a b c", "a b  C", " ".join(common)]
    draw.shuffle(texts)
    numbered = [(3 * i + 1, t) for i, t in enumerate(texts)]
    found = minhash.near_duplicates(plain.awkward(spark, numbered)).collect()
    assert {r.id: (r.size, r.component_id) for r in found} == plain.near(numbered)


def test_near_duplicates_of_awkward_rows(spark, awkward):
    found = minhash.near_duplicates(awkward).collect()
    assert sorted(str((r.id, r.component_id)) for r in found) == sorted(
        ["(5, 5)", "(6, 6)", "(7, 7)", "(8, 8)", "(9, 8)", "(9, 8)", "(None, 10)", "(None, 10)", "(10, 10)", "(11, 11)"]
        + ["(12, 11)", "(13, 13)", "(14, 14)", "(15, 15)"]
    )
    kept = minhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns
    assert minhash.near_duplicates(awkward.limit(0)).count() == 0


def test_near_duplicates_with_repeated_and_null_ids(spark):
    """Where an id repeats, the copy goes and the other text stays; copies without an id go, other texts without one stay."""
    passage = " ".join(f"p{k}" for k in range(60))
    other = " ".join(f"q{k}" for k in range(60))
    texts = [(1, passage), (2, passage + " end"), (2, other), (None, "start " + passage), (None, "one of its own"), (None, "one of its own"), (3, None), (3, "")]
    kept = minhash.drop_near_duplicates(plain.awkward(spark, texts)).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(map(str, [texts[0], texts[2], *texts[4:]]))


def test_difference_cover():
    for i in range(substring.PERIOD):
        for j in range(substring.PERIOD):
            assert any(
                (i + d) % substring.PERIOD in substring.COVER and (j + d) % substring.PERIOD in substring.COVER for d in range(substring.PERIOD)
            )
    values = np.array([0, 1, 2**40 - 1, 2**56 - 1], np.uint64)
    assert (substring.expand(substring.squeeze(values, 7), 7) == values).all()


def test_windows_are_told_apart_by_both_hashes():
    # The first hash takes forty values here, so most windows agree on it with windows that the second tells apart.
    draw = np.random.default_rng(3)
    into, width = 3, substring.WINDOW_BYTES
    batches, expected = [], {}
    for k in range(4):
        ids = np.sort(draw.integers(-5, 40, 300)).astype(np.int64)
        hashes = np.stack([draw.integers(0, 40, 300) << 40, draw.integers(0, 4, 300)], axis=1).astype(np.uint64)
        batches.append((ids, hashes))
    held = {}
    for ids, hashes in batches:
        for i, (a, b) in zip(ids.tolist(), hashes.tolist()):
            held.setdefault((a, b), set()).add(i)
    for pair, docs in held.items():
        for i in docs - {min(docs)}:
            expected.setdefault(i, []).append(pair[0])

    def grouped(table, step):
        numbers = sorted(set(table["bucket"].to_pylist()))
        return [step(table.filter(pa.compute.equal(table["bucket"], n))) for n in numbers]

    packed = pa.Table.from_batches([substring._table(substring._packed(i, h, into, width, True)) for i, h in batches])
    met = pa.concat_tables(grouped(packed, substring._meet(into, width, True)))
    found = {}
    for table in grouped(met, substring._gather(substring.TOLD_BYTES)):
        for row in table.to_pylist():
            found[row["id"]] = set(substring.expand(row["hashes"], substring.TOLD_BYTES).tolist())
    assert found == {i: set(firsts) for i, firsts in expected.items()}
    # Held by the first hash alone, more would be found.
    alone = {a: min(i for (b, _), docs in held.items() if b == a for i in docs) for a, _ in held}
    assert sum(map(len, found.values())) < sum(i > alone[a] for a, i in {(a, i) for (a, _), docs in held.items() for i in docs})


def test_groups_of_hashes_follow_the_data(spark):
    least = substring.buckets(spark)
    assert substring._groups(spark, 0) == substring._groups(spark, least) == least
    assert substring._groups(spark, 1000 * least * substring.GROUP_WORDS) == 1000 * least


def test_repeated_words(spark, awkward):
    draw = random.Random(5)
    passages = [[f"p{k}w{draw.randrange(50)}" for _ in range(n)] for k, n in enumerate((12, 13, 14, 40, 90))]
    texts = []
    for i in range(150):
        words = [f"d{draw.randrange(40)}" for _ in range(draw.randrange(0, 60))]
        for _ in range(draw.randrange(3)):
            at = draw.randrange(len(words) + 1)
            words[at:at] = draw.choice(passages)
        texts.append((i, " ".join(words)))
    texts += [(500, "same " * 200), (501, "same " * 30), (502, texts[3][1]), (503, None), (504, "")]
    found = substring.repeated_words(plain.awkward(spark, texts)).collect()
    expected = plain.repeated(texts)
    assert {r.id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == {
        i: (len(a), len(a) - len(b), hashlib.sha256(" ".join(b).encode()).hexdigest()) for i, (a, b) in expected.items()
    }
    cleaned = {r.id: r.text for r in substring.remove_repeated(plain.awkward(spark, texts)).collect()}
    assert cleaned == {i: " ".join(b) for i, (_, b) in expected.items()}
    found = {str(r.id): (r.n_words, r.n_removed) for r in substring.repeated_words(awkward).collect()}
    assert found["12"] == (40_001, 40_000) and found["11"][1] == 0 and found["5"] == (0, 0)
    assert substring.repeated_words(awkward.limit(0)).count() == 0


def test_repeated_words_of_rows_without_id_or_with_the_same(spark):
    one, two, three, four = (" ".join(f"{name}{i}" for i in range(30)) for name in "abcd")
    texts = [(1, one), (None, one), (None, two), (None, f"{three} x {two}"), (7, one), (7, four), (8, four), (None, three + " x " + two)]
    found = substring.remove_repeated(plain.awkward(spark, texts)).collect()
    got = sorted((str(r.id), r.text) for r in found)
    # Rows without an id stand behind all ids, so of what they share only the first by digest keeps it.
    first = min([two, f"{three} x {two}"], key=lambda t: hashlib.sha256(t.encode()).digest())
    rest = [two, f"{three} x", f"{three} x"] if first == two else ["", f"{three} x {two}", f"{three} x {two}"]
    assert got == sorted([("1", one), ("7", ""), ("7", four), ("8", ""), ("None", ""), *(("None", t) for t in rest)])


def test_myers():
    draw = random.Random(1)
    for _ in range(200):
        item = "".join(draw.choice("abc ") for _ in range(draw.randrange(1, 90)))
        text = "".join(draw.choice("abc ") for _ in range(draw.randrange(0, 120)))
        assert decontaminate.myers(item, text)[0] == plain.part_distance(item, text)


def test_leaks(spark, awkward):
    draw = random.Random(2)
    words = [f"{a}{b}{c}" for a in "bdgk" for b in "aeiou" for c in ("n", "rt", "l", "ss")]
    items = [(i, " ".join(draw.choice(words) for _ in range(draw.choice([12, 30, 50])))) for i in range(25)] + [(90, None), (91, "?!"), (None, "odd one")]
    texts = []
    for i in range(120):
        body = [draw.choice(words) for _ in range(40)]
        if i % 3:
            leak = list(draw.choice(items[:25])[1])
            for _ in range(int(len(leak) * draw.choice([0, 0.02, 0.05, 0.08]))):
                at = draw.randrange(len(leak))
                leak[at : at + 1] = draw.choice(["", "z", leak[at] + "q"])
            body.insert(draw.randrange(40), "".join(leak).upper() if i % 2 else "".join(leak).replace(" ", ", "))
        texts.append((i, " ".join(body)))
    docs, benchmark = plain.awkward(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    expected = {}
    for i, text in texts:
        for k, item in items:
            short = decontaminate.normalised(item)
            if short and (d := plain.part_distance(f" {short} ", f" {decontaminate.normalised(text)} ")) <= int(0.05 * len(short)):
                expected[i, k] = d
    found = decontaminate.leaks(docs, benchmark, block_chars=900)
    assert {(r.doc_id, r.item_id): r.distance for r in found.collect()} == expected
    assert 20 < len(expected) < 100
    kept = {r.doc_id for r in decontaminate.drop_leaks(docs, benchmark, block_chars=900).collect()}
    assert kept == {i for i, _ in texts} - {i for i, _ in expected}
    odd = decontaminate.leaks(awkward, spark.createDataFrame([(1, "THREE, four five")], "item_id long, text string"))
    assert sorted(str(r.doc_id) for r in odd.collect()) == ["10", "None"]
    # Words count whole, and a match ends before the space behind it.
    short = plain.awkward(spark, [(1, "my eyes hurt"), (2, "Oh, YES!"), (3, "yes"), (4, "so yes it is"), (5, "")])
    told = decontaminate.leaks(short, spark.createDataFrame([(1, "yes")], "item_id long, text string")).collect()
    assert sorted((r.doc_id, r.distance, r.match_end) for r in told) == [(2, 0, 6), (3, 0, 3), (4, 0, 6)]
    assert decontaminate.leaks(docs, benchmark.limit(0)).count() == 0
    assert decontaminate.drop_leaks(docs.limit(0), benchmark).count() == 0


def test_regions_of_a_text_full_of_hits():
    assert list(decontaminate._regions([0, 3, 50, 52, 200], 10, 2)) == [(0, 15), (48, 64), (198, 212)]
    item = "ab " * 40 + "end of it all"
    find = decontaminate._finder([(1, item)], 0.05)
    started = time.perf_counter()
    assert find("ab " * 30_000 + "nothing") == {}
    assert find("ab " * 30_000 + "end of it al")[0][0] == 1
    assert time.perf_counter() - started < 30


def test_secrets(spark, awkward):
    live = "Zx81mnop45QrStuv99Ab"
    texts = [
        (1, f'PassWord: "abcdefghijklmnop" and {live} é𝒳 token=secret:abcdefghijklmnop'), (2, "api_key = short"),
        (3, "key Api-Key-1x2y3z4w5v6u7t8s9r0q api_key=abcdefghijklmnop"), (4, "password = abcdefghijklmnop"),
        (5, "passwd=abcdefghijklmnop AKIAABCDEFGHIJKLM AKIAABCDEFGHIJKLMN"),
    ]
    docs = plain.awkward(spark, texts).withColumn("source", F.concat(F.lit("o"), F.col("doc_id").cast("string")))
    found = {r.id: r for r in secrets.secret_spans(docs).withColumn("text", secrets.span_text(F.col("spans"))).collect()}
    assert found[1].text == "assign:0:27,token:33:53"
    assert found[2].text == "" and found[4].text == "assign:0:27"
    assert found[5].text == "assign:0:23,access:42:60"
    assert [(s.n_owners, s.live) for s in found[4].spans] == [(4, False)]
    assert [(s.n_owners, s.live) for s in found[1].spans] == [(4, False), (1, True)]
    assert found[3].text == "token:4:32,assign:33:57"
    odd = {str(r.id): r.text for r in secrets.secret_spans(awkward).withColumn("text", secrets.span_text(F.col("spans"))).collect()}
    assert odd["14"] == "assign:0:24,access:25:45,hex:46:63" and odd["5"] == ""
    assert secrets.secret_spans(awkward.limit(0)).count() == 0


def spans_by_definition(text):
    """Base spans and free tokens of one text, by Python's own patterns."""
    base = [(m.start(), 0, m.end()) for m in re.finditer(secrets.ASSIGN, text) if len(m.group(2)) >= 12]
    base += [(m.start(), 1, m.end()) for m in re.finditer(secrets.ACCESS, text) if m.end() - m.start() >= 18]
    base += [(m.start(), 2, m.end()) for m in re.finditer(secrets.HEX, text)]
    tokens = [(m.start(), 3, m.end()) for m in re.finditer(secrets.TOKEN, text) if all(re.search(c, m.group()) for c in ("[A-Z]", "[a-z]", "[0-9]"))]
    return sorted(base + [t for t in tokens if not any(a < t[2] and t[0] < b for a, _, b in base)])


def test_secrets_that_touch_and_overlap(spark):
    draw = random.Random(5)
    parts = ["token=", "secret: ", "AKIA", "0123456789abcdef", "Ab1", "Zz_9-", " ", "é", "𝒳", "=", "Q7", "deadbeef", "ABCDEFGH12345678", "/"]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 60))) for _ in range(400)]
    # Each token stands in one document only, or in few, so that none counts as an example.
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("source", F.lit("one"))
    found = {r.id: [(s.start, s.kind, s.end) for s in r.spans] for r in secrets.secret_spans(docs).collect()}
    assert found == {i: spans_by_definition(t) for i, t in enumerate(texts)}


def test_secrets_of_one_very_long_text(spark):
    text = " ".join(f"{hashlib.md5(str(i).encode()).hexdigest()} Tok{i:08d}abcdefghijklm" for i in range(64_000))
    docs = spark.createDataFrame([(1, text, "one")], "doc_id long, text string, source string")
    started = time.perf_counter()
    (found,) = secrets.secret_spans(docs).select(F.size("spans").alias("n"), F.element_at("spans", -1)["end"].alias("end")).collect()
    assert (found.n, found.end) == (128_000, len(text))
    assert time.perf_counter() - started < 60


def test_licences(spark, awkward):
    gpl = "This work is licensed under the GNU General Public License, version 3"
    texts = [
        (1, "Intro.\nLicensed under the Apache License, Version 2.0.\nYou may not use this file except in compliance with the License. Bye"),
        (2, f"{gpl}, or so.\n{gpl}; either version 3 of the License, or (at your option) any later version."),
        (3, "Some words. Released under the MIT License. Licensed under CC BY-NC 4.0."), (4, "a license to nothing"), (5, None),
        (6, "We say: released under the mit license"), (7, "licensed under the bsd 3 clause license\n" + "x.\n" * 9 + "all rights reserved."),
    ]
    found = {r.id: [x.licence for x in r.licences] for r in licences.licence_scan(plain.awkward(spark, texts)).collect()}
    assert found == {
        1: ["Apache-2.0"], 2: ["GPL-3.0-or-later"], 3: ["MIT", "CC-BY-NC-4.0"], 4: [], 5: [], 6: ["MIT"], 7: ["BSD-3-Clause", "Proprietary"],
    }
    spans = {r.id: [(x.start, x.end) for x in r.licences] for r in licences.licence_scan(plain.awkward(spark, texts)).collect()}
    for i, text in texts:
        for start, end in spans[i]:
            assert licences.identify(text[start:end].split("\n")[0])
    assert licences.licence_scan(awkward).count() == len(plain.AWKWARD)
    assert licences.licence_scan(awkward.limit(0)).count() == 0


APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License.
"""
MIT = """MIT License

Copyright (c) 2024 Some One

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.
"""
BSD = """Copyright (c) 2024, Some One
All rights reserved.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED.
"""
GPL = """This program is free software{} you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation{} either version {} of the License, or
(at your option) any later version.
"""


def test_real_licence_headers(spark):
    def comment(text, sign):
        return "".join(f"{sign}{line}\n" for line in text.split("\n"))

    bsd_2 = BSD[: BSD.index("3. Neither")] + BSD[BSD.index("THIS SOFTWARE") :]
    headers = [
        (APACHE, "Apache-2.0"), (MIT, "MIT"), (BSD, "BSD-3-Clause"), (bsd_2, "BSD-2-Clause"),
        (GPL.format(":", ",", 3), "GPL-3.0-or-later"), (GPL.format(";", ";", 2), "GPL-2.0-or-later"),
        (GPL.format(";", ";", "2.1").replace("GNU", "GNU Lesser"), "LGPL-2.1-or-later"),
        (GPL.format(":", ",", 3).replace("GNU", "GNU Affero"), "AGPL-3.0-or-later"),
        ("SPDX-License-Identifier: GPL-2.0-or-later", "GPL-2.0-or-later"), ("SPDX-License-Identifier: MIT", "MIT"),
        ("Licensed under the GNU General Public License, version 2 or later.", "GPL-2.0-or-later"),
    ]
    texts = [(i * 10 + k, comment(t, sign)) for i, (t, _) in enumerate(headers) for k, sign in enumerate(["", " * ", "# ", "// ", "dnl "])]
    found = {r.id: [x.licence for x in r.licences] for r in licences.licence_scan(plain.awkward(spark, texts)).collect()}
    assert found == {i: [headers[i // 10][1]] for i, _ in texts}


def test_quality_features():
    words = ["naïve", "ab", "ab", "x", "ab"]
    at, used = quality.features(" ".join(words))
    counted = dict(zip(at.tolist(), used.tolist()))
    grams = sum(max(0, len(f"<{w}>".encode()) - n + 1) for w in words for n in quality.GRAMS)
    assert counted.pop(quality.AGAIN) == quality.AGAIN_TIMES
    assert sum(counted.values()) == grams + len(words)
    draw = np.random.default_rng(0)
    model = quality.Model(draw.normal(size=quality.ROWS), 0.25)
    texts = [" ".join(words), "", None, "ab", "x x x", "naïve ab"]
    for text, score in zip(texts, model.scores(texts)):
        at, used = quality.features(text)
        mean = float(used @ model.weights[at] / used.sum()) if len(at) else 0.0
        assert score == pytest.approx(1 / (1 + np.exp(-mean - 0.25)))


def test_quality_on_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(5, 0), (8, 1), (8, 1), (None, 1), (11, None), (13, 1)], "doc_id long, quality int")
    model = quality.train(awkward, labels)
    scored = awkward.select(quality.score_column(model, F.col("text")).alias("s")).collect()
    assert len(scored) == len(plain.AWKWARD) and all(0 <= r.s <= 1 for r in scored)
    assert quality.drop_low_quality(awkward, labels.limit(0)).count() == len(plain.AWKWARD)
    assert quality.drop_low_quality(awkward.limit(0), labels).columns == awkward.columns


def test_training_does_not_depend_on_the_order_of_rows(spark):
    labels = spark.createDataFrame([(1, 0), (2, 1)], "doc_id long, quality int")
    texts = [(1, "one text here"), (1, "quite another one"), (2, "good words")]
    models = [quality.train(spark.createDataFrame(t, "doc_id long, text string").coalesce(1), labels) for t in (texts, texts[::-1])]
    assert (models[0].weights == models[1].weights).all()


def test_tokens_of_bpe_model(spark, awkward):
    library = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    found = {(r.id, r.ids is not None): r for r in subwords.encode(awkward).collect()}
    for i, text in plain.AWKWARD:
        assert found[i, True].ids == library.encode(text or "")
        assert found[i, True].round_trip
    decoded = {r.id: r.text for r in subwords.decode(subwords.encode(awkward)).collect()}
    assert decoded[11] == plain.LONG and decoded[5] == ""
    assert subwords.encode(awkward.limit(0)).count() == 0


def test_tokens_of_unigram_model():
    draw = random.Random(4)
    pieces = ["<unk>"] + [f"<0x{b:02X}>" for b in range(256)]
    texts = sorted({"".join(draw.choice("abcd▁") for _ in range(draw.randrange(1, 4))) for _ in range(60)} | set("abcd▁"))
    model = subwords.Model(
        pieces + texts, [0.0] * 257 + [-draw.random() * 9 for _ in texts], [2] + [subwords.BYTE] * 256 + [subwords.NORMAL] * len(texts), False, True, False
    )
    machine = subwords.Transducer(model)

    def least(text):
        if not text:
            return 0.0
        starts = [text[:n] for n in range(1, len(text) + 1) if text[:n] in machine.ids or n == 1]
        return min(-machine.scores.get(s, machine.unknown) + least(text[len(s) :]) for s in starts)

    for _ in range(60):
        text = "".join(draw.choice("abcd é") for _ in range(draw.randrange(0, 9)))
        path = [p for part in machine.cut.findall(machine.normalise(text)) for p in machine.path(part)]
        weight = sum(-machine.scores.get(p, machine.unknown) for p in path)
        assert weight == pytest.approx(least(machine.normalise(text)))
        assert machine.decode(machine.encode(text)) == text


def message(*fields):
    """A protocol buffer message of small numbers, floats and bytes."""
    out = b""
    for number, value in fields:
        if isinstance(value, int):
            out += bytes([number << 3, value])
        elif isinstance(value, float):
            out += bytes([number << 3 | 5]) + np.float32(value).tobytes()
        else:
            out += bytes([number << 3 | 2]) + (bytes([len(value)]) if len(value) < 128 else bytes([len(value) & 127 | 128, len(value) >> 7])) + value
    return out


@pytest.mark.parametrize("kind", [subwords.UNIGRAM, subwords.BPE])
def test_tokens_of_models_without_bytes_and_with_pieces_of_a_user(tmp_path, kind):
    draw = random.Random(9)
    letters = sorted("abcd▁")
    longer = sorted({"".join(draw.choice("abcd") for _ in range(2)) for _ in range(9)} | {"▁a", "▁b"})
    longer += sorted({x + y for x in longer for y in "ab"})[:8]
    pieces = [("<unk>", 0.0, subwords.UNKNOWN), ("<sep>", 0.0, subwords.USER), ("cab", 0.0, subwords.USER), ("<sep>x", 0.0, subwords.USER)]
    # A merge comes before those that need it; no two ways through a text weigh the same.
    pieces += [(p, -1.0 - i * 0.37 - 0.011 * i * i, subwords.NORMAL) for i, p in enumerate(longer + letters)]
    body = b"".join(message((1, message((1, p.encode()), (2, s), (3, k)))) for p, s, k in pieces)
    body += message((2, message((3, kind))), (3, message((1, b"identity"), (3, 1), (4, 1), (5, 1))))
    path = tmp_path / "tiny.model"
    path.write_bytes(body)
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    machine = subwords.Transducer(subwords.Model.load(str(path)))
    for _ in range(400):
        text = "".join(draw.choice(["a", "b", "c", "d", " ", "é", "zz", "<sep>", "cab", "<sep>x", "x"]) for _ in range(draw.randrange(0, 14)))
        assert machine.encode(text).tolist() == library.encode(text), text
        assert machine.decode(machine.encode(text)) == library.decode(library.encode(text)), text


def rules_by_definition(found, gap=licences.GAP):
    """The first rule that fits anywhere, at its first place; then the same with what stands before and behind."""
    for licence, rule in licences.RULES:
        n = len(rule)
        for i in range(len(found) - n + 1):
            run = found[i : i + n]
            if tuple(x[3] for x in run) == rule and all(b[0] - a[0] <= gap + 1 for a, b in zip(run, run[1:])):
                whole = (licence, run[0][1], run[-1][2])
                return sorted([*rules_by_definition(found[:i], gap), whole, *rules_by_definition(found[i + n :], gap)], key=lambda x: x[1:])
    return []


def test_rules_against_their_definition():
    draw = random.Random(9)
    known = sorted({x for _, rule in licences.RULES for x in rule})
    some = [k for k in known if k.split("-")[0] in ("gpl", "lgpl", "mit", "as", "bsd", "all", "apache")]
    for _ in range(300):
        number, found = 0, []
        for k in range(draw.randrange(14)):
            number += draw.choice([0, 1, 1, 2, 4, 6])
            found.append((number, 10 * k, 10 * k + 9, draw.choice(some)))
        assert licences.match_rules(found) == rules_by_definition(found)


def test_a_hundred_thousand_licence_lines():
    began = time.perf_counter()
    text = "All rights reserved.\n" * 100_000
    assert len(licences.match_rules(licences.identifiers(text))) == 100_000
    assert time.perf_counter() - began < 30


@pytest.mark.parametrize(
    "text, wanted",
    [
        ("SPDX-License-Identifier: MIT", ["MIT"]),
        ("# SPDX-License-Identifier: MIT-0\n", ["MIT-0"]),
        ("// SPDX-License-Identifier: GPL-2.0+ */", ["GPL-2.0-or-later"]),
        ("SPDX-License-Identifier: GPL-2.0", ["GPL-2.0-only"]),
        ("SPDX-License-Identifier: MIT OR Apache-2.0\ncode", ["MIT", "Apache-2.0"]),
        ("SPDX-License-Identifier: (GPL-2.0-only WITH Classpath-exception-2.0) AND BSD-3-Clause", ["GPL-2.0-only", "BSD-3-Clause"]),
        ("SPDX-License-Identifier: Zlib. Released under the MIT License.", ["Zlib", "MIT"]),
        ("This is not licensed under the MIT License.", []),
        ("It is no longer licensed under the MIT License; released under the MIT License.", ["MIT"]),
        ("It isn't released under the MIT License.", []),
        ("Under the Apache-2.0 license.", ["Apache-2.0"]),
        ("Licensed under AGPL v3.0.", ["AGPL-3.0-only"]),
        ("Distributed under the Boost Software License, Version 1.0.", ["BSL-1.0"]),
        ("This is free and unencumbered software released into the public domain.", ["Unlicense"]),
        ("made available under the terms of the Eclipse Public License v2.0", ["EPL-2.0"]),
        ("made available under the terms of the Eclipse Public License v. 2.0", ["EPL-2.0"]),
    ],
)
def test_expressions_negations_and_more_licences(text, wanted):
    assert [m[0] for m in licences.match_rules(licences.identifiers(text))] == wanted
