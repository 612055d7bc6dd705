import itertools
import math
import random
import string
from collections import Counter

import numpy as np
import pyarrow as pa

from lakelayers.llm.decontaminate import BLOCK, Index, clean, contaminations, normal_words
from lakelayers.llm.words import PIECE_BYTES, word_hashes


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def sentence(rng, n, letters="abcdefghijklmnopqrst"):
    return " ".join("".join(rng.choices(letters, k=rng.randint(1, 4))) for _ in range(n))


def made(seed, count):
    rng = random.Random(seed)
    hashes = []
    for _ in range(count):
        words = normal_words(pa.array([sentence(rng, rng.randint(5, 30), "abcde")]))
        hashes.append(word_hashes(words))
    frequency = {}
    for h in hashes:
        for x in np.unique(h).tolist():
            frequency[x] = frequency.get(x, 0) + 1
    return Index([(i, h.tobytes()) for i, h in enumerate(hashes)], frequency, count, sum(map(len, hashes)) / count), hashes


def test_wand_finds_exactly_what_full_scoring_finds():
    index, hashes = made(3, 90)
    rng = random.Random(4)
    for _ in range(60):
        query = np.unique(np.concatenate([rng.choice(hashes), rng.choice(hashes)[: rng.randint(1, 9)]]))
        terms = sorted({int(t) for t in index.terms(query) if t >= 0})
        score = np.zeros(index.blocks * BLOCK)
        for t in terms:
            at = slice(index.first[t], index.first[t + 1])
            score[index.entry[at]] += index.impact[at]
        for threshold in (0.2, 0.6, 0.95):
            found = index.wand(terms, set(range(index.blocks)), threshold)
            assert sorted(found) == np.flatnonzero(score >= threshold - 1e-9).tolist()
            assert all(abs(found[e] - score[e]) < 1e-9 for e in found)


def test_no_open_block_is_missed():
    index, hashes = made(5, 90)
    rng = random.Random(6)
    for _ in range(40):
        query = np.unique(np.concatenate([rng.choice(hashes), rng.choice(hashes)]))
        terms = np.array(sorted({int(t) for t in index.terms(query) if t >= 0}))
        every = index.wand(terms.tolist(), set(range(index.blocks)))
        _, blocks = index.open_blocks(np.zeros(len(terms), int), terms, 1)
        assert {e // BLOCK for e in every} <= set(blocks.tolist())


def test_planted_items_are_found_and_clean_texts_left_alone(spark, documents):
    rng = random.Random(7)
    bench = [(i, sentence(rng, rng.choice([6, 20, 50, 90, 200]))) for i in range(40)]
    docs, want = [], set()
    for d in range(150):
        text = [sentence(rng, rng.randint(0, 300))]
        for i, item in rng.sample(bench, rng.choice([0, 0, 1, 2])):
            shown = rng.choice([item, item.upper(), item.replace(" ", "\n "), item.replace(" ", "!! ", 3)])
            text += [shown, sentence(rng, rng.randint(0, 100))]
            want.add((d, i))
        docs.append((d, " ".join(text)))
    docs += [(500, None), (501, ""), (502, bench[3][1][: len(bench[3][1]) // 3])]
    for shard_bytes in (1 << 21, 6000):
        found = contaminations(documents(docs), items(spark, bench), shard_bytes=shard_bytes).collect()
        assert {(r.doc_id, r.item_id) for r in found} == want
    kept = clean(documents(docs), items(spark, bench))
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}


def test_question_alone_is_no_contamination(spark, documents):
    words = [f"w{i}" for i in range(30)]
    bench = items(spark, [(1, " ".join(words))])
    docs = documents([(1, " ".join(words[:22]) + " other"), (2, " ".join(words))])
    assert [(r.doc_id, r.item_id) for r in contaminations(docs, bench).collect()] == [(2, 1)]


def test_edge_cases(spark, documents):
    docs = documents([(1, "one two three four five six"), (1, "one two three four five six"), (None, "one two three four five six")])
    bench = items(spark, [(1, None), (2, "..."), (3, "one two three four five six"), (4, "one two three four five six"), (None, "one two three four five six")])
    found = {(r.doc_id, r.item_id) for r in contaminations(docs.selectExpr("*", "1 item_id", "2 words"), bench).collect()}
    assert found == {(d, i) for d in (1, None) for i in (3, 4, None)}
    assert contaminations(docs, items(spark, [])).count() == 0
    assert contaminations(documents([]), bench).count() == 0
    assert clean(docs, items(spark, [])).count() == 3


def test_clean_judges_every_row(spark, documents):
    rng = random.Random(17)
    item = sentence(rng, 40)
    dirty, fine = f"{sentence(rng, 9)} {item} {sentence(rng, 9)}", sentence(rng, 60, "uvwxyz")
    rows = [(None, dirty), (None, fine), (None, None), (3, fine), (3, dirty), (4, dirty), (5, ""), (6, fine)]
    kept = clean(documents(rows), items(spark, [(1, item), (None, None)]))
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted([r for r in rows if r[1] != dirty], key=repr)


def test_a_long_text_is_searched_in_parts(spark, documents):
    """Items anywhere in a text of megabytes, at the words they begin at; memory is that of a part."""
    rng = random.Random(23)
    bench = [(i, sentence(rng, rng.choice([20, 60, 150]))) for i in range(12)]
    filler = [sentence(rng, 40_000, "uvwxyz") for _ in range(13)]
    text, begins = filler[0], {}
    for (i, item), more in zip(bench, filler[1:], strict=True):
        begins[i] = len(text.split())
        text += f" {item}. {more}"
    assert len(text) > 2 * PIECE_BYTES
    found = contaminations(documents([(1, text), (2, filler[3])]), items(spark, bench)).collect()
    assert {r.item_id for r in found} == set(begins) and {r.doc_id for r in found} == {1}
    assert all(abs(r.word - begins[r.item_id]) <= 2 * 64 for r in found)


def plain_contaminations(docs, bench):
    """Pairs of document and item by whole BM25 scores of every passage and sets of shingles, in loops."""

    def normal(text):
        return [w for w in (x.strip(string.punctuation) for x in (text or "").lower().split()) if w]

    def cut(words):
        n = -(-len(words) // 64)
        size, more = divmod(len(words), n)
        ends = list(itertools.accumulate([size + 1] * more + [size] * (n - more), initial=0))
        return [words[a:b] for a, b in itertools.pairwise(ends)]

    def shingled(words):
        width = min(5, len(words))
        return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)} if width else set()

    items_words = {i: normal(text) for i, text in bench}
    entries = [(i, part) for i, words in items_words.items() if words for part in cut(words)]
    mean = sum(len(part) for _, part in entries) / len(entries)
    df = Counter(w for _, part in entries for w in set(part))

    def impacts(part):
        tf = Counter(part)
        raw = {w: math.log(1 + (len(entries) - df[w] + 0.5) / (df[w] + 0.5)) * k * 2.2 / (k + 1.2 * (0.25 + 0.75 * len(part) / mean)) for w, k in tf.items()}
        return {w: x / sum(raw.values()) for w, x in raw.items()}

    scored = [(i, impacts(part)) for i, part in entries]
    out = set()
    for doc, text in docs:
        words = normal(text)
        hits = {}
        for p in range(max(1, -(-len(words) // 64) - 1)):
            held = set(words[64 * p : 64 * (p + 2)])
            for i, impact in scored:
                if sum(x for w, x in impact.items() if w in held) >= 0.6:
                    hits.setdefault(i, []).append(p)
        for i, places in hits.items():
            own = words[64 * min(places) : 64 * (max(places) + 2)]
            third = -(-2 * len(items_words[i]) // 3)
            shares = []
            for part in (items_words[i][:third], items_words[i][third:]):
                want = shingled(part)
                width = len(next(iter(want))) if want else 0
                have = {tuple(own[k : k + width]) for k in range(len(own) - width + 1)} if want else set()
                shares.append(len(want & have) / len(want) if want else 1.0)
            if min(shares) >= 0.8:
                out.add((doc, i))
    return out


def test_equals_whole_scores_in_loops(spark, documents):
    """Items copied whole, edited, cut and put together, in texts of words that items have too."""
    rng = random.Random(29)
    bench = [(i, sentence(rng, rng.choice([1, 4, 15, 40, 70, 140]), "abcde")) for i in range(25)]
    docs = []
    for d in range(90):
        text = [sentence(rng, rng.randint(0, 150), "abcde")]
        for _, item in rng.sample(bench, rng.choice([1, 2])):
            words = item.split()
            for _ in range(rng.choice([0, 0, 1, 2, 5])):
                words[rng.randrange(len(words))] = rng.choice(["zz", "", "a", "Bc!"])
            text += [" ".join(words[: rng.choice([len(words), len(words), len(words) * 3 // 4])]), sentence(rng, rng.randint(0, 90), "abcde")]
        docs.append((d, " ".join(text)))
    found = {(r.doc_id, r.item_id) for r in contaminations(documents(docs), items(spark, bench)).collect()}
    assert found == plain_contaminations(docs, bench) and 30 < len(found) < 500


def test_recall_of_edited_items(spark, documents):
    """One word in ten changed breaks half of the shingles and hides an item; one word in sixty does not."""
    rng = random.Random(31)
    bench = [(i, sentence(rng, 60)) for i in range(60)]

    def planted(every, at):
        rows = []
        for i, item in bench:
            words = item.split()
            words[at::every] = ["changed"] * len(words[at::every])
            rows.append((i, f"{sentence(rng, 30)} {' '.join(words)} {sentence(rng, 30)}"))
        return {r.doc_id for r in contaminations(documents(rows), items(spark, bench)).collect()}

    assert len(planted(60, 20)) == 60 and not planted(10, 5)
