"""Toxicity, hard negatives and ranked search against plain Python, on small and awkward inputs."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallywire.llm import negatives, ranked, toxicity

# --- toxicity ---------------------------------------------------------------------------------------------------------


def evidence_of(texts, classes, order=toxicity.ORDER, discount=toxicity.DISCOUNT):
    """The evidence of a text by definition, all counts kept by context."""
    counts = {c: Counter() for c in (0, 1)}
    for text, c in zip(texts, classes):
        for word in set(text.lower().split()):
            held = "\x02" * (order - 1) + word + "\x03"
            counts[c].update(held[a : a + order] for a in range(len(held) - order + 1))
    kinds = {order: set(counts[0]) | set(counts[1])}
    times = {}
    for size in range(order - 1, 0, -1):
        times[size] = Counter(g[1:] for g in kinds[size + 1])
        kinds[size] = set(times[size])

    def shared(gram):
        if not gram:
            return 1 / (len(kinds[1]) + 1)
        after = {g: n for g, n in times[len(gram)].items() if g[:-1] == gram[:-1]}
        total = sum(after.values())
        return (after[gram] - discount) / total + discount * len(after) / total * shared(gram[1:])

    def likely(gram, c):
        after = {g: n for g, n in counts[c].items() if g[:-1] == gram[:-1]}
        if not after:
            return shared(gram[1:])
        total = sum(after.values())
        return max(after.get(gram, 0) - discount, 0) / total + discount * len(after) / total * shared(gram[1:])

    def left(context, c):
        after = [n for g, n in counts[c].items() if g[:-1] == context]
        return discount * len(after) / sum(after) if after else 1.0

    def of_word(word):
        held = "\x02" * (order - 1) + word + "\x03"
        total = 0.0
        for a in range(len(held) - order + 1):
            gram = held[a : a + order]
            if gram in kinds[order]:
                total += math.log(likely(gram, 1) / likely(gram, 0))
            else:
                # Nobody counted it, so the shared model stands on both sides.
                total += math.log(left(gram[:-1], 1) / left(gram[:-1], 0))
        return total

    def of_text(text):
        found = text.lower().split()
        runs = [found[a : a + 4] for a in range(max(len(found) - 3, 1))]
        return max((sum(map(of_word, r)) / sum(len(w) + 1 for w in r) for r in runs if r), default=0.0)

    return of_text


def toxic_corpus():
    """Ids, texts and labels; toxic texts hold one of two stems, spelled on."""
    draw = random.Random(4)
    common = ["".join(draw.choice(["ta", "lo", "mi", "re", "nu"]) for _ in range(draw.randrange(1, 4))) for _ in range(60)]
    rows = []
    for i in range(400):
        found = [draw.choice(common) for _ in range(draw.randrange(3, 120))]
        toxic = int(draw.random() < 0.3)
        if toxic:
            for _ in range(2):
                found.insert(draw.randrange(len(found)), draw.choice(["zog", "Grux"]) + draw.choice(["", "ta", "lomi", "nu"]))
        rows.append((i, " ".join(found), toxic))
    return rows


def tables(spark, rows):
    docs = plain.awkward(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    return docs, labels


@pytest.mark.parametrize("most", [10**6, 0])
def test_evidence(spark, most):
    """With models sent to the tasks, and by joins."""
    texts = ["good zog day", "a good day", "zog zog off", "what a day it is today", "off", ""]
    classes = [1, 0, 1, 0, 0, 0]
    train = spark.createDataFrame(list(zip(texts, classes)), "text string, toxic int")
    partial = train.mapInArrow(toxicity._counted, "gram string, ordinary long, toxic long")
    counts = partial.groupBy("gram").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).cache()
    of_text = evidence_of(texts, classes)
    asked = [*texts, "zogs are off today", "ZOG", "unseen words only here", None, " \t", "x\x02zog\x03y", "é 漢字 𝒳 zog good day"]
    docs = spark.createDataFrame(list(enumerate(asked)), "n int, text string")
    found = toxicity.evidence(docs, toxicity.evidence_table(counts), "text", most)
    got = {r.n: r._evidence for r in found.collect()}
    want = {n: of_text((t or "").replace("\x02", " ").replace("\x03", " ")) for n, t in enumerate(asked)}
    assert got.keys() == want.keys()
    for n in want:
        assert got[n] == pytest.approx(want[n], abs=1e-9), asked[n]


def test_counting_many_words_takes_little_memory():
    """Arrays over all words held at once took 100 bytes a character; two workers share what an executor has beside its heap."""
    found = [f"{'abcdefgh'[i % 8]}{i:07d}{'tuvwxyz'[i % 7]}" for i in range(100_000)]
    texts = [" ".join(found[a : a + 500]) for a in range(0, len(found), 500)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array([n % 2 for n in range(len(texts))])], ["text", "toxic"])
    tracemalloc.start()
    counted = list(toxicity._counted(iter([batch])))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = Counter()
    for n, text in enumerate(texts):
        for word in text.split():
            held = toxicity.spelled(word)
            want.update((held[a : a + 5], n % 2) for a in range(len(held) - 4))
    assert len(counted) == 1 and len(set(counted[0]["gram"].to_pylist())) == counted[0].num_rows
    got = {(r["gram"], c): r[name] for r in counted[0].to_pylist() for c, name in enumerate(["ordinary", "toxic"]) if r[name]}
    assert got == dict(want)
    assert most < 80e6


def test_words_judged_in_parts(monkeypatch):
    """Also a word that is longer than a part."""
    found = ["zog", "x" * 100, *(f"w{i}" for i in range(50)), "", "y" * 40]
    cut = toxicity.grams(found)
    keys = np.unique(cut.keys)[::2]
    contexts = np.unique(cut.contexts)
    model = toxicity.Model(keys, np.sin(np.arange(len(keys))), contexts, np.cos(np.arange(len(contexts))))
    whole = model.of_words(found)
    monkeypatch.setattr(toxicity, "MOST_CHARACTERS", 30)
    parts = list(toxicity._parts(found))
    assert len(parts) > 10 and [w for p in parts for w in p] == found
    assert model.of_words(found).tolist() == whole.tolist()


def test_tables_stored_for_a_model(spark, monkeypatch):
    """Each stored file starts six processes, each of which looks as large as the executor for a moment."""
    stored = []
    kept = toxicity.stage
    monkeypatch.setattr(toxicity, "stage", lambda df, label: stored.append(label) or kept(df, label))
    docs, labels = tables(spark, toxic_corpus())
    assert toxicity.score(docs, labels).count() == 400
    assert len(stored) == 3


def test_toxic_documents_are_told_apart(spark):
    rows = toxic_corpus()
    docs, labels = tables(spark, rows)
    found = {}
    for most in (10**6, 0):
        allowed = ~toxicity.held_out(F.col("doc_id"))
        scored = toxicity.score(docs, labels, allowed=allowed, most_labels=most, most_grams=max(most, 1)).collect()
        found[most] = {r.id: r.score for r in scored}
    assert found[0].keys() == found[10**6].keys() == {i for i, _, _ in rows}
    assert all(found[0][i] == pytest.approx(s, abs=1e-9) for i, s in found[10**6].items())
    assert [i for i, _, y in rows if (found[0][i] >= 0.5) != y] == []


def test_labels_held_out_are_no_input(spark):
    rows = toxic_corpus()
    docs, labels = tables(spark, rows)
    changed = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    allowed = ~toxicity.held_out(F.col("doc_id"))
    scores = [sorted(map(tuple, toxicity.score(docs, given, allowed=allowed).collect())) for given in (labels, changed)]
    assert scores[0] == scores[1]


def test_toxicity_of_awkward_documents(spark):
    rows = toxic_corpus()
    _, labels = tables(spark, rows)
    docs = plain.awkward(spark, [*plain.AWKWARD, *((i + 1000, t) for i, t, _ in rows)])
    labels = labels.withColumn("doc_id", F.col("doc_id") + 1000)
    labels = labels.union(spark.createDataFrame([(None, 1, 1), (8, 1, None), (1001, 1, None)], labels.schema))
    found = toxicity.score(docs, labels).collect()
    assert len(found) == len(plain.AWKWARD) + len(rows)
    assert all(0 <= r.score <= 1 for r in found)
    empty = {r.score for r in found if r.id in (5, 6, 7)}
    assert len(empty) == 1 and empty.pop() < 0.5
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert {r.score for r in toxicity.score(docs, labels.withColumn("toxic", F.lit(0))).collect()} == {0.0}


def test_threshold():
    slope, threshold = toxicity.calibrated([(10, 0, 90), (40, 0, 5), (100, 1, 7), (150, 1, 3)])
    assert threshold == pytest.approx((40.5 + 100.5) / 2 / toxicity.BINS) and slope > 1
    # Errors are what counts, whichever class they are in.
    _, threshold = toxicity.calibrated([(0, 0, 50), (0, 1, 1), (50, 0, 2), (50, 1, 40)])
    assert 0 < threshold * toxicity.BINS < 51
    # Toxic texts without a toxic word lie among the ordinary ones: one of them less is no reason to go lower.
    ordinary = [(20, 0, 500), (30, 0, 60), (40, 0, 20), (45, 0, 5), (50, 0, 4), (55, 0, 2)]
    toxic = [(20, 1, 3), (30, 1, 3), (40, 1, 3), (45, 1, 6), (50, 1, 4), (55, 1, 2), (80, 1, 20), (200, 1, 50)]
    _, threshold = toxicity.calibrated(ordinary + toxic)
    assert 45 < threshold * toxicity.BINS < 80


# --- hard negatives ---------------------------------------------------------------------------------------------------


def mined(rows):
    """By definition, every pair of an anchor and a row."""
    usable = []
    for i, label, vector in rows:
        if i is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        usable.append((i, (label + 1) % 10 if i % 7 == 0 else label, tuple(math.floor(256 * x) for x in vector)))
    out = []
    for i, label, vector in {r for r in usable if r[0] % 50 == 0}:
        scored = [(sum(a * b for a, b in zip(vector, v)), j, k) for j, k, v in usable if j != i]
        first = sorted([(-s, j) for s, j, k in scored if k == label])[:5]
        others = sorted((-s, j) for s, j, k in scored if k != label)
        for negative, j in first:
            inside = [(s, k) for s, k in others if 50 * -negative <= 100 * -s <= 95 * -negative][:3]
            out += [(i, j, rank, k, -negative, -s) for rank, (s, k) in enumerate(inside, 1)]
    return sorted(out)


VECTORS = "vec_id long, label int, embedding array<float>, id long, vector string, anchor int, score double"


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, 3.0) for r in rows], VECTORS)


def clustered(seed, count, width=12):
    draw = random.Random(seed)
    centres = [[draw.gauss(0, 1) for _ in range(width)] for _ in range(8)]
    out = []
    for i in range(count):
        centre = draw.choice(centres)
        vector = [float(np.float32(c + draw.gauss(0, 0.3))) for c in centre]
        out.append((i, draw.randrange(10) if draw.random() < 0.7 else 3, vector))
    return out


@pytest.mark.parametrize("block", [2048, 3])
def test_hard_negatives(spark, block):
    rows = clustered(1, 700)
    # A third of all rows share a vector.
    rows = [(i, k, rows[0][2] if i % 3 == 1 else v) for i, k, v in rows]
    got = sorted(map(tuple, negatives.hard_negatives(embeddings(spark, rows).repartition(5), block_anchors=block).collect()))
    assert got == mined(rows) and len(got) > 50


def test_hard_negatives_of_awkward_rows(spark):
    rows = clustered(2, 160, 4)
    inf, nan = float("inf"), float("nan")
    rows += [
        (200, 1, None), (250, None, [1.0] * 4), (300, 2, [1.0, nan, 0.0, 0.0]), (350, 2, [1.0, inf, 0.0, 0.0]), (None, 1, [1.0] * 4),
        (400, 3, [1.0, None]), (450, 3, []), (500, 3, [0.5]), (550, 3, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6]), (101, 3, [9.0] * 4),
        (100, 3, [2.0] * 4), (100, 3, [2.0] * 4), (101, 3, [9.0] * 4), (3, 4, [0.0] * 4), (600, 3, [-1.0] * 4),
        (1003, 3, [3e30, 1.0, 1.0, 1.0]), (650, 5, [1e15, -1e15, 1.0, 1.0]), (1005, 6, [1e15, 1e15, 1.0, 2.0]), (1007, 5, [1e9, 1e9, 3.0, 1.0]),
    ]
    floats = [(i, k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, k, v in rows]
    wanted = [(a, p, r, n, min(ps, 2**63 - 1), min(s, 2**63 - 1)) for a, p, r, n, ps, s in mined(floats)]
    got = sorted(map(tuple, negatives.hard_negatives(embeddings(spark, floats)).collect()))
    big = {650, 1003, 1005}
    assert [r for r in got if not big & {r[0], r[1], r[3]}] == [r for r in wanted if not big & {r[0], r[1], r[3]}]
    assert negatives.hard_negatives(embeddings(spark, [])).count() == 0
    assert negatives.hard_negatives(embeddings(spark, [(1, 1, [1.0])])).count() == 0


def test_products_are_exact():
    draw = random.Random(3)
    rows = [[draw.randrange(-(2**40), 2**40) for _ in range(5)] for _ in range(20)]
    anchor = [draw.randrange(-(2**30), 2**30) for _ in range(5)]
    found = negatives.products(np.array(rows, float), np.array(anchor, float))
    exact = [min(max(sum(a * b for a, b in zip(r, anchor)), -(2**63)), 2**63 - 1) for r in rows]
    assert found.tolist() == exact


def test_bounds_spare_products():
    """Rows whose interval misses the window are not scored, and no row inside it is missed."""
    rows = clustered(5, 600, 6)
    vectors = negatives.quantised([v for _, _, v in rows])
    anchors = vectors[:40]
    tree = negatives.spanning_tree(0, np.arange(40), np.arange(40), anchors)
    assert sorted(tree.ids) == list(range(40)) and all(p < k for k, p in enumerate(tree.parent))
    exact = vectors @ tree.vectors.T
    window = np.quantile(exact, 0.97)
    met = set()

    def found(k, which, scores):
        assert scores.tolist() == exact[which, k].tolist()
        met.update((k, int(w)) for w in which if exact[w, k] >= window)

    norms = np.sqrt((vectors**2).sum(axis=1))
    scored = negatives.walk(tree, vectors, norms, lambda k, low, high: high >= window, found)
    assert met == {(int(k), int(w)) for w, k in zip(*np.nonzero(exact >= window))}
    assert scored < 0.7 * exact.size


# --- ranked search ----------------------------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def said(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def best(texts, items, top=10):
    docs = [(i, Counter(said(t))) for i, t in texts]
    sizes = [sum(c.values()) for _, c in docs]
    count, total = sum(n > 0 for n in sizes), sum(sizes)
    holders = Counter(t for _, c in docs for t in c)
    out = []
    for item, text in items:
        scores = []
        for (i, held), size in zip(docs, sizes):
            m = 100 - 75 + (75 * size * count) // max(total, 1)
            score = 0
            for term in said(text):
                if held[term]:
                    weight = math.floor(1000 * math.log((2 * count + 2) / (2 * holders[term] + 1)))
                    score += weight * ((1_000_000_000 * held[term]) // (1000 * held[term] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, rank, None if gone else i, -s) for rank, (s, gone, i) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=str)


def test_terms():
    for text in [None, "", "a-b c", "A1_É漢字 x", "\x00\x7f\x80 z", "it's 3.5\t\nTWO", "𝒳y\x85z\xa0q"]:
        assert [t.decode() for t in ranked.terms(text)] == said(text)


@pytest.mark.parametrize("block", [ranked.BLOCK_CHARS, 400])
def test_ranked_search(spark, block, monkeypatch):
    monkeypatch.setattr(ranked, "PART_DOCUMENTS", 100)
    draw = random.Random(8)
    vocabulary = [f"w{k}" for k in range(150)]
    often = [1 / (k + 1) for k in range(150)]
    texts = [(i, " ".join(draw.choices(vocabulary, often, k=draw.randrange(1, 60)))) for i in range(500)]
    # A third of the documents are alike, so that scores are equal across the tenth place.
    texts = [(i, texts[0][1] if i % 3 == 2 else t) for i, t in texts]
    items = [(k, " ".join(draw.choices(vocabulary, often, k=draw.randrange(1, 30)))) for k in range(12)]
    items += [(20, ""), (21, None), (22, "nowhere said"), (23, "w149 W149 w149, w0"), (None, "w5 w6"), (23, "w149 W149 w149, w0")]
    asked = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    found = ranked.search(plain.awkward(spark, texts).repartition(3), asked, block_chars=block).select("item_id", "rank", "id", "score")
    assert sorted(map(tuple, found.collect()), key=str) == best(texts, list(dict.fromkeys(items)))


def test_ranked_search_of_awkward_documents(spark):
    items = [(1, "one two three"), (2, "word5x5 end É 漢字"), (3, plain.LONG), (4, "token abcdefghijkl0123")]
    asked = spark.createDataFrame(items, "item_id long, text string")
    docs = plain.awkward(spark, plain.AWKWARD)
    found = ranked.search(docs, asked).select("item_id", "rank", "id", "score")
    assert sorted(map(tuple, found.collect()), key=str) == best(plain.AWKWARD, items)
    assert ranked.search(docs.limit(0), asked).count() == 0
    assert ranked.search(docs, asked.limit(0)).count() == 0


def test_reading_stops_early():
    """Two lists of a hundred thousand postings, of which the first few hundred settle the answer."""
    draw = np.random.default_rng(2)
    lists = []
    for _ in range(2):
        impact = np.sort(draw.pareto(1.0, 100_000) * 1000 + 1).astype(np.int64)[::-1]
        lists.append((draw.permutation(100_000), impact, 1))
    # The same documents lead both lists.
    lead = np.arange(20)
    for docs, _, _ in lists:
        for place, d in enumerate(lead):
            at = int(np.flatnonzero(docs == d)[0])
            docs[[place, at]] = docs[[at, place]]
    found, scores, read = ranked.resolve(lists, 100_000)
    total = np.zeros(100_000, np.int64)
    for docs, impact, _ in lists:
        total[docs] += impact
    want = np.lexsort((np.arange(100_000), -total))[:10]
    order = np.lexsort((found, -scores))[:10]
    assert found[order].tolist() == want.tolist() and scores[order].tolist() == total[want].tolist()
    assert read < 100_000


def test_impacts_beyond_64_bits():
    lengths = np.array([10**9, 5], np.int64)
    found = ranked.impacts(np.array([7, 7]), np.array([3, 3]), lengths, 10**10, 10**12)
    for k, n in enumerate(lengths.tolist()):
        m = 25 + 75 * n * 10**10 // 10**12
        assert found[k] == 7 * (1_000_000_000 * 3 // (1000 * 3 + 8 * m))

