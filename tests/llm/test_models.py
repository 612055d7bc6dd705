"""Language ID, toxicity and language model: held-out quality, brute force, edge cases."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakelayers.llm import brown, langid, toxicity
from lakelayers.llm.shipping import ship
from lakelayers.llm.tables import table
from lakelayers.scratch import stage

SF = "/root/testdata/sf0.01"


def rest(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


# --- language ----------------------------------------------------------------------------


def test_languages_of_held_out_documents(spark):
    docs = table(spark, SF, "documents")
    found = {r.doc_id: r for r in langid.identify(docs).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    assert all(found[r.doc_id].held_out == (rest(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if rest(r.doc_id, 5) == 0]
    assert sum(found[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert sum(r.rejected for r in found.values()) <= 0.02 * len(rows)


def test_prediction_uses_the_text_only(spark):
    docs = table(spark, SF, "documents")
    model = langid.fit(docs.limit(300).select("doc_id", "text", "lang"))
    frame = docs.limit(50)
    one = langid.predict(frame, model).collect()
    other = langid.predict(frame.selectExpr("doc_id + 7 doc_id", "text", "'xx' lang", "'y' source"), model).collect()
    assert [(r.lang_pred, r.score) for r in one] == [(r.lang_pred, r.score) for r in other]


def test_language_edge_cases(documents):
    rows = [(i, t, la, None) for i, (t, la) in enumerate([("the house and", "en"), ("der hund und", "de")] * 20)]
    rows += [(100, None, "en", None), (101, "", None, None), (102, "12 !? \n", "de", None), (None, "the and", "en", None), (5, "the house", "en", None), (5, "the house", "en", None)]
    got = langid.identify(documents(rows).selectExpr("*", "'q' lang_pred", "0.5D score", "1 rejected")).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    for d in (100, 101, 102):
        assert (by[d].lang_pred, by[d].score, by[d].rejected) == ("und", 0.0, True)
    assert by[0].lang_pred == "en" and by[1].lang_pred == "de"
    kept = langid.accepted(documents(rows))
    assert kept.columns == ["doc_id", "text", "lang", "source"] and not {100, 101, 102} & {r.doc_id for r in kept.collect()}
    nothing = langid.identify(documents([(1, "words", None, None)])).first()
    assert (nothing.lang_pred, nothing.rejected) == ("und", True)
    assert langid.identify(documents([])).count() == 0


def test_subwords_do_not_cross_texts():
    alone = [set(langid.subwords([t])[0].tolist()) for t in ("Ab, c", "é9f")]
    buckets, bounds = langid.subwords(["Ab, c", None, "é9f", ""])
    assert [set(buckets[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])] == [alone[0], set(), alone[1], set()]


def plain_buckets(text):
    """Buckets of bigrams and trigrams of runs of letters between two spaces, in a loop."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower())
    found, wrap = [], 2**32
    for run in letters.split():
        points = [32, *map(ord, run), 32]
        for i, (a, b) in enumerate(zip(points, points[1:])):
            two = (a * 0x9E3779B1 ^ b * 0x85EBCA77) % wrap
            keys = [two] if b != 32 else []
            if i + 2 < len(points):
                keys.append((two * 0xC2B2AE3D ^ points[i + 2] * 0x27D4EB2F) % wrap)
            found += [key * 0x2C1B3C6D % wrap >> 32 - 13 for key in keys]
    return found


def test_predictions_equal_a_plain_loop_whole_and_in_parts(documents):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["the", "House", "der", "hund,", "été", "x9y", "ΟΔΟΣ", "--", "naïve", "\n", "東京"], k=rng.randint(1, 50))) for _ in range(40)]
    texts += ["", None, "12 !?", "the house " * 80_000]
    for text in texts[:41]:
        want = Counter(plain_buckets(text))
        assert Counter(langid.subwords([text])[0].tolist()) == want
        for limit in (8, 64):
            got = langid.bucket_counts(pa.array([text]), limit)
            assert {b: n for b, n in enumerate(got.tolist()) if n} == want
    train = [(i, t, la) for i, (t, la) in enumerate([("the house and", "en"), ("der hund und", "de"), ("été naïve", "fr")] * 30)]
    model = langid.fit(documents(train).select("doc_id", "text", "lang"))
    got = {r.doc_id: r for r in langid.predict(documents(list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        buckets = plain_buckets(text or "")
        if not buckets:
            assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
            continue
        logits = [(sum(float(model.scores[b, k]) for b in buckets) / len(buckets) + float(model.bias[k])) / model.temperature for k in range(3)]
        chance = [math.exp(x - max(logits)) for x in logits]
        best = max(range(3), key=lambda k: chance[k])
        assert got[i].lang_pred == model.langs[best] and got[i].score == pytest.approx(chance[best] / sum(chance), rel=1e-4)


# --- toxicity ----------------------------------------------------------------------------


def test_toxicity_of_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/sf0.1", "documents"), table(spark, "/root/testdata/sf0.1", "labels")
    found = {r.doc_id: r for r in toxicity.score_toxicity(docs, labels).collect()}
    assert all(r.held_out == (rest(d, 4) == 2) and r.predicted == (r.score >= 0.3) and 0 <= r.score <= 1 for d, r in found.items())
    held = [(found[r.doc_id], r.toxic) for r in labels.collect() if rest(r.doc_id, 4) == 2]
    right = sum(f.predicted and t for f, t in held)
    assert right >= 0.9 * sum(t for _, t in held)
    assert right >= 0.9 * sum(f.predicted for f, _ in held)


def test_held_out_labels_change_nothing(documents, spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices("abcdefgh", k=20)) + (" idiot moron" if i % 5 == 0 else "")) for i in range(300)]
    labels = [(i, int(i % 5 == 0)) for i, _ in rows]
    kind = "doc_id long, toxic int"
    one = toxicity.score_toxicity(documents(rows), spark.createDataFrame(labels, kind)).collect()
    turned = [(i, 1 - y if rest(i, 4) == 2 else y) for i, y in labels]
    other = toxicity.score_toxicity(documents(rows), spark.createDataFrame(turned, kind)).collect()
    assert {r.doc_id: r.score for r in one} == pytest.approx({r.doc_id: r.score for r in other})
    assert {r.doc_id for r in one if r.predicted} == {i for i, y in labels if y}


def simulated(voters, rows=4000):
    """Votes of voters given as (copied voter or -1, chance under class 1, under class 0), with labels."""
    rng = np.random.default_rng(0)
    truth = rng.random(rows) < 0.2
    votes = np.zeros((rows, len(voters)), bool)
    for j, (of, yes, no) in enumerate(voters):
        votes[:, j] = votes[:, of] if of >= 0 else rng.random(rows) < np.where(truth, yes, no)
    label = (truth ^ (rng.random(rows) < 0.05)).astype(int)
    return truth, votes, label, toxicity.label_model(*np.nonzero(votes), len(voters), label)


def test_label_model_finds_accuracies_and_copies():
    truth, votes, label, model = simulated([(-1, 0.9, 0.05), (0, 0, 0), (0, 0, 0), (-1, 0.3, 0.2), (-1, 0.6, 0.1)])
    assert ((model.posterior > 0.5) == truth).mean() > 0.95
    chain = model.parent[:3]
    assert (chain >= 0).sum() == 2 and set(chain[chain >= 0]) <= {0, 1, 2}  # copies hang together
    for j in np.flatnonzero(chain >= 0):
        assert (model.chance[:, j, 1] > 0.95).all() and (model.chance[:, j, 0] < 0.05).all()  # smoothed by STRENGTH
    assert model.chance[1, 4].max() > 0.5 and model.chance[0, 4].max() < 0.25
    lone = simulated([(-1, 0.9, 0.05), (-1, 0.3, 0.2), (-1, 0.6, 0.1)])[3]
    twice = simulated([(-1, 0.9, 0.05), (-1, 0.3, 0.2), (-1, 0.6, 0.1), (0, 0, 0), (0, 0, 0)])[3]
    assert np.abs(lone.posterior - twice.posterior).mean() < 0.01  # a copy adds no evidence


def test_posteriors_equal_a_plain_loop():
    _, votes, label, model = simulated([(-1, 0.9, 0.05), (0, 0, 0), (-1, 0.3, 0.2), (-1, 0.6, 0.1)], 300)
    posterior = [0.9 if y else 0.03 for y in label]
    pairs, size = toxicity.pair_counts, votes.shape[1]
    first = np.concatenate([[0], np.cumsum(votes.sum(axis=1))])
    for weight in (np.ones(300), np.arange(300) / 300):
        got = pairs(np.nonzero(votes)[1], first, weight, size, limit=7)
        assert np.allclose(got, [[sum(w for w, v in zip(weight, votes) if v[i] and v[j]) for j in range(size)] for i in range(size)])
    for step in range(toxicity.ROUNDS):
        chance = {}
        if step in toxicity.RELINKED:
            joint = np.stack([pairs(np.nonzero(votes)[1], first, np.array([1 - p for p in posterior]), size), pairs(np.nonzero(votes)[1], first, np.array(posterior), size)])
            parent = toxicity.linked(joint, np.array([300 - sum(posterior), sum(posterior)]))
        for c in (0, 1):
            weight = [p if c else 1 - p for p in posterior]
            for j in range(size):
                usual = (sum(w for w, v in zip(weight, votes) if v[j]) + 0.5) / (sum(weight) + 1)
                for given in (0, 1):
                    rows = [(w, v[j]) for w, v in zip(weight, votes) if (parent[j] >= 0 and v[parent[j]]) == given]
                    x = (sum(w for w, y in rows if y) + toxicity.STRENGTH * usual) / (sum(w for w, _ in rows) + toxicity.STRENGTH)
                    chance[c, j, given] = min(max(x, 1e-6), 1 - 1e-6)
        evidence = []
        for v in votes:
            total = 0.0
            for j in range(size):
                given = int(parent[j] >= 0 and v[parent[j]])
                yes, no = chance[1, j, given], chance[0, j, given]
                total += math.log(yes / no) if v[j] else math.log((1 - yes) / (1 - no))
            evidence.append(total)
        slope, shift = dense_logistic(np.array(evidence)[:, None], label, 1e-3)
        said = [(sum(w for w, y in zip(weight, label) if y) + 0.5) / (sum(weight) + 1) for weight in ([1 - p for p in posterior], posterior)]
        posterior = [
            1 / (1 + math.exp(-(slope * e + shift + (math.log(said[1] / said[0]) if y else math.log((1 - said[1]) / (1 - said[0]))))))
            for e, y in zip(evidence, label)
        ]
    assert np.allclose(model.posterior, posterior, atol=1e-4)


def dense_logistic(x, goal, penalty):
    """Newton's method on whole matrices."""
    x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, ridge = np.zeros(x.shape[1]), np.array([penalty] * (x.shape[1] - 1) + [1e-6])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.clip(np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(ridge), x.T @ (goal - p) - ridge * w), -5, 5)
    return w


def test_links_are_a_tree_of_the_largest_information():
    rng = np.random.default_rng(2)
    votes = rng.random((2000, 5)) < 0.3
    votes[:, 2] = votes[:, 0] ^ (rng.random(2000) < 0.1)
    votes[:, 4] = votes[:, 2] ^ (rng.random(2000) < 0.1)
    joint = np.stack([votes.T.astype(float) @ votes] * 2) / 2
    parent = toxicity.linked(joint, np.array([1000.0, 1000.0]))
    assert {frozenset((j, int(p))) for j, p in enumerate(parent) if p >= 0} == {frozenset((0, 2)), frozenset((2, 4))}


NORMAL = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def plain_counts(text, voters):
    """Counts of whole words and beginnings (as (word, None) and (beginning, size)), and the totals, in loops."""
    words = [w.strip(NORMAL) for w in re.split("[\x20\x09-\x0d]+", text.lower())]
    words = [w.encode() for w in words if w]
    counts, hits = Counter(), 0
    for w in words:
        own = [x for x in [(w, None), *((w[:k], k) for k in toxicity.BEGINNINGS if len(w) > k)] if x in voters]
        counts.update(own)
        hits += bool(own)
    raw = text.encode()
    shares = [sum(65 <= b <= 90 for b in raw), sum(b in b"!?" for b in raw), sum(b in b"#*$%&|<>@" for b in raw), sum(48 <= b <= 57 for b in raw)]
    return counts, [len(raw), *shares, len(words), sum(a == b for a, b in zip(words, words[1:])), sum(len(w) == 1 for w in words), hits]


def test_counts_of_texts_equal_a_plain_loop_whole_and_in_parts():
    rng = random.Random(3)
    every = ["idiot", "Idiots!", "fool", "a", "A", "stupidity", "(scum)", "--", "nice", "day,", "é", "9", "moron moron", "you\tyou", "#$"]
    texts = [" ".join(rng.choices(every, k=rng.randint(0, 60))) for _ in range(30)] + ["", None, "idiot", "idiot"]
    voters = [(b"idiot", None), (b"idiot", 5), (b"stupid", 6), (b"scum", None), (b"moron", None)]

    def hashed(word, size):
        words = toxicity.find_words(pa.array([word.decode()]))
        return toxicity.word_hashes(words) if size is None else toxicity.mixed(toxicity.word_hashes(words) + np.uint64(size))

    hashes = np.concatenate([hashed(*v) for v in voters])
    order = np.argsort(hashes)
    known, names = hashes[order], [voters[i] for i in order]
    gate = toxicity.gate_of(known)
    together = toxicity.counts_of(pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], ["text"]), known, gate)
    for i, text in enumerate(texts):
        counts, totals = plain_counts(text or "", set(voters))
        alone = toxicity.counts_of(pa.RecordBatch.from_arrays([pa.array([text], pa.string())], ["text"]), known, gate, limit=16)
        for votes, at in ((together, i), (alone, 0)):
            mine = votes.text == at
            assert {names[v]: n for v, n in zip(votes.voter[mine], votes.n[mine])} == counts
            assert votes.totals[at].tolist() == totals


def test_scores_are_those_of_the_plain_formula():
    rng = np.random.default_rng(7)
    counts = rng.poisson(0.4, (200, 6))
    totals = rng.integers(1, 50, (200, 9)).astype(float)
    label = (counts[:, 0] > 0).astype(int)
    text, voter = np.nonzero(counts)
    votes = toxicity.Votes(text, voter, counts[text, voter], totals)
    model = toxicity.train(votes, label, np.arange(6, dtype=np.uint64))
    x = np.concatenate([np.log1p(counts), toxicity.dense_inputs(totals)], axis=1)
    assert np.allclose(toxicity.margins(votes, model.weights, model.bias), x @ model.weights + model.bias)
    goal = toxicity.label_model(*toxicity.ballots(votes, 6), 6 + toxicity.PATTERN_VOTERS, label).posterior
    scaled = (x - x.mean(axis=0)) / (x.std(axis=0) + 0.05)
    w = dense_logistic(scaled, goal, 20.0)
    slope, shift = dense_logistic((scaled @ w[:-1] + w[-1])[:, None], label, 1e-3)
    assert np.allclose(1 / (1 + np.exp(-(x @ model.weights + model.bias))), 1 / (1 + np.exp(-((scaled @ w[:-1] + w[-1]) * slope + shift))), atol=1e-3)


def test_toxicity_edge_cases(documents, spark):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 0), (5, 1), (6, 0)], "doc_id long, toxic int")
    rows = [(1, "you idiot"), (3, "hello"), (4, None), (4, ""), (None, "x"), (5, "idiot scum"), (5, "idiot scum"), (6, "nice day")]
    got = toxicity.score_toxicity(documents(rows).selectExpr("*", "1 toxic", "2 score"), labels).collect()
    assert len(got) == len(rows) and len({r.score for r in got if r.doc_id == 4}) == 1
    assert {r.score for r in toxicity.score_toxicity(documents(rows), labels.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(documents([]), labels).count() == 0


# --- language model ----------------------------------------------------------------------


def tokens(text):
    lowered = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    return [*re.findall(rb"[^\x20\x09-\x0D]+", lowered), None]


def base(rows):
    counts = Counter(t for d, text in rows if rest("" if d is None else d, 7) != 2 for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return n, [
        (len(tokens(t)), sum(counts[w] > 0 for w in tokens(t)), sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in tokens(t)))
        for _, t in rows
    ]


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()]
    n, want = base(rows)
    got = {r.doc_id: r for r in brown.score(table(spark, SF, "documents"), head_words=2000, clustered=300, classes=24).collect()}
    for (d, _), (length, known, score) in zip(rows, want):
        r = got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (rest(d, 7) == 2, length, known, n)
        assert r.base_score == pytest.approx(score) and r.perplexity == pytest.approx(10 ** (-r.score / length))
    held = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(3)
    table_of = rng.poisson(0.3, (44, 44)).astype(float)
    table_of[:20, 20:40] += 3

    def likelihood(owner):
        member = np.eye(owner.max() + 1)[owner]
        joint = member.T @ table_of @ member
        return brown._entropy(joint).sum() - brown._entropy(joint.sum(0)).sum() - brown._entropy(joint.sum(1)).sum()

    steps = [likelihood(brown.exchange(table_of, 40, 4, r)) for r in range(4)]
    assert steps == sorted(steps) and steps[-1] > steps[0]


def test_transitions_and_emissions_are_distributions(spark, documents):
    rows = [(i, " ".join(random.Random(i).choices(["ab", "cd.", "é", "x,", "y!"], k=8))) for i in range(60)]
    docs = documents(rows)
    ship(spark)
    summed = docs.select("text").mapInArrow(brown._counted, brown._COUNTS).groupBy("word")
    counts = stage(summed.agg(F.min("shape").alias("shape"), F.sum("n").alias("n")), "counts")
    model = brown.fit(docs, counts, clustered=3, classes=2, head_words=4)
    assert np.allclose((10**model.transition).sum(axis=1), 1)
    for c in set(model.unit_class[:3]):
        assert np.isclose((10 ** model.emission[:3][model.unit_class[:3] == c]).sum(), 1)
    top = {r.word for r in counts.orderBy(F.desc("n"), "word").limit(3).collect()}
    for shape in range(brown.SHAPES):
        own = [r.n for r in counts.collect() if r["shape"] == shape and r.word not in top]
        assert np.isclose((sum(n + 1 for n in own) + 1) * 10 ** model.emission[3 + shape], 1)


def test_language_model_edge_cases(documents):
    held = next(i for i in range(100) if rest(i, 7) == 2)
    rows = [(held, "only held out"), (held, "only held out"), (held, None)]
    got = brown.score(documents(rows)).collect()
    assert sorted(r.n_tokens for r in got) == [1, 4, 4] and {r.train_tokens for r in got} == {0} and {r.base_score for r in got} == {0.0}
    rows = [(1, "a b"), (1, "a b"), (1, "c"), (None, "a"), (2, None), (3, ""), (held, "a zz")]
    n, want = base(rows)
    got = brown.score(documents(rows).selectExpr("*", "1 word", "2 n", "3 score"), head_words=2, clustered=1).collect()
    assert sorted((r.n_tokens, r.n_known, round(r.base_score, 9)) for r in got) == sorted((a, b, round(c, 9)) for a, b, c in want)
    assert brown.score(documents([])).count() == 0


def test_gains_are_differences_of_the_likelihood():
    rng = np.random.default_rng(5)
    classes, size = 4, 4 + brown.SHAPES
    text, owner = rng.integers(0, 30, 600), rng.integers(0, size, 30)
    words = np.zeros((30, 30))
    np.add.at(words, (text, np.roll(text, -1)), 1)  # the text is a ring: as many words begin a pair as end one

    def likelihood(of):
        member = np.eye(size)[of]
        joint = member.T @ words @ member
        return brown._entropy(joint).sum() - 2 * brown._entropy(joint.sum(0)).sum()

    member = np.eye(size)[owner]
    own = np.diag(words)
    before, after = words.T @ member, words @ member
    before[np.arange(30), owner] -= own
    after[np.arange(30), owner] -= own
    gain = brown.gains(member.T @ words @ member, owner, before, after, own, classes)
    for w in range(30):
        moved = [likelihood(np.where(np.arange(30) == w, c, owner)) for c in range(classes)]
        assert np.allclose(gain[w] - gain[w, 0], np.array(moved) - moved[0])


def test_every_training_word_has_a_class_and_scores_equal_brute_force(spark, documents):
    rng = random.Random(4)
    names, verbs = [f"n{i}" for i in range(60)], [f"v{i}." for i in range(60)]
    rows = [(i, " ".join(w for _ in range(8) for w in ("the", rng.choice(names), "will", rng.choice(verbs)))) for i in range(80)]
    rows += [(80, "once twice"), (81, "n1 n2 n2 v3. v4. zz"), (82, ""), (83, None), (84, "n5 n6"), (84, "n5 n6")]
    rows += [(i, "new n7 n8 words, n9") for i in range(85, 120)]
    train = [r for r in rows if rest(r[0], 7) != 2]
    ship(spark)
    frame = documents(train).select("text")
    summed = frame.mapInArrow(brown._counted, brown._COUNTS).groupBy("word")
    counts = stage(summed.agg(F.min("shape").alias("shape"), F.sum("n").alias("n")), "counts")
    seed = brown.fit(frame, counts, clustered=40, classes=6, head_words=60)
    classed = brown.classify(frame, counts, seed, 6)
    found = {r["word"]: r for r in classed.collect()}
    every = {r.word: r for r in counts.collect()}
    clustered = {int(w): int(seed.unit_class[u]) for w, u in zip(seed.head.words.view(np.int64), seed.head.units) if u >= 0}
    assert set(found) | set(clustered) == set(every) and not set(found) & set(clustered)
    assert all((r["n"], r["shape"]) == (every[w].n, every[w]["shape"]) and 0 <= r["class"] < 6 for w, r in found.items())

    def hashed(text):
        hashes, kinds, _ = brown.tokens(documents([(0, text)]).select("text").toArrow().to_batches()[0])
        return list(zip(hashes.view(np.int64).tolist(), kinds.tolist()))

    size, end = 6 + brown.SHAPES, int(np.array([brown.END]).view(np.int64)[0])
    kind = {w: r["class"] for w, r in found.items()} | clustered
    of = [{kind[w] for w, _ in hashed(" ".join(group))[:-1] if w in found} for group in (names[10:], verbs)]
    assert of[0] and of[1] and not of[0] & of[1]  # words with other neighbours are in other classes
    again = {w: 6 + r["shape"] for w, r in found.items() if r["n"] == 1 and w != end}
    pair = np.zeros((size, size))
    for _, text in train:
        line = [end, *[w for w, _ in hashed(text)]]
        for a, b in zip(line, line[1:]):
            for x in {kind[a], again.get(a, kind[a])}:
                for y in {kind[b], again.get(b, kind[b])}:
                    pair[x, y] += 1
    prior = (pair.sum(0) + 1) / (pair.sum() + size)
    transition = (pair + brown.STRENGTH * prior) / (pair.sum(1, keepdims=True) + brown.STRENGTH)
    often = Counter()
    for w, r in every.items():
        often[kind[w]] += r.n
        often[6 + r["shape"]] += 1
    want = []
    for d, text in rows:
        total, last = 0.0, kind[end]
        for w, shape in hashed(text):
            now = kind.get(w, 6 + shape)
            total += math.log10(transition[last, now]) + (math.log10(every[w].n / often[now]) if w in every else -math.log10(often[now] + 1))
            last = now
        want.append((d, round(total, 6)))
    for head_words in (60, 1000):
        got = brown.score(documents(rows), head_words=head_words, clustered=40, classes=6).collect()
        assert sorted((r.doc_id, round(r.score, 6)) for r in got) == sorted(want)
