import random
import re

import numpy as np
import pyarrow as pa
import xxhash

from lakelayers.llm.components import component_roots
from lakelayers.llm.simhash import BLOCKS, WIDE_BLOCKS, anchors_of, links, long_fingerprint, near_duplicates, one_of_each


def fingerprint(text):
    lowered = (text or "").encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123))))
    words = re.findall(rb"[^\x20\x09-\x0D]+", lowered)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def classes(fps):
    root = list(range(len(fps)))
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return root


def test_anchors_cover_every_pair_at_distance_four():
    rng = np.random.default_rng(1)
    for _ in range(100):
        a = rng.integers(0, 2**63, dtype=np.uint64)
        b = a
        for bit in rng.choice(64, 4, replace=False):
            b ^= np.uint64(1) << np.uint64(bit)
        for blocks in (BLOCKS, WIDE_BLOCKS):
            key, owner, home = anchors_of(np.array([a, b]), blocks)
            of = [set(key[owner == i]) for i in (0, 1)]
            assert set(key[(owner == 0) & home]) & of[1] or set(key[(owner == 1) & home]) & of[0]
            assert home.sum() == 2 * len(blocks) and len(key) == sum(map(len, of))


def test_links_connect_what_brute_force_connects(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    fps = set(base)
    for _ in range(400):
        x = rng.choice(sorted(fps))
        for _ in range(rng.randint(1, 6)):
            x ^= 1 << rng.randrange(64)
        fps.add(x)
    fps = sorted(fps)
    signed = [int(np.uint64(x).astype(np.int64)) for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = classes(fps)
    for chunk, blocks in ((16_384, BLOCKS), (10, BLOCKS), (16_384, WIDE_BLOCKS)):
        roots = {r.node: r.root for r in component_roots(links(frame, chunk, blocks)).collect()}
        got = [roots.get(x, x) for x in signed]
        assert [got.index(g) for g in got] == [want.index(w) for w in want]


def test_documents_equal_brute_force(documents):
    rng = random.Random(8)
    base = [" ".join(rng.choices("abcdefghijklmnop", k=80)) for _ in range(8)]
    rows = [(i, rng.choice(base) + rng.choice(["", "", " END", " x y"])) for i in range(80)]
    rows += [(200, None), (201, ""), (202, " "), (203, "One two"), (204, "one TWO"), (5, rows[5][1])]
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in near_duplicates(documents(rows)).collect()}
    fps = [fingerprint(t) for _, t in rows]
    root = classes(fps)
    least = {r: min(d for (d, _), x in zip(rows, root) if x == r) for r in root}
    assert got == {(d, f"{f:016x}", least[r]) for (d, _), f, r in zip(rows, fps, root)}


def test_one_document_of_each_group_stays(documents):
    rows = [(1, "a b c d e"), (2, "A b c d e"), (2, "A b c d e"), (3, "other words here now then"), (3, "other words here now then"), (None, "n")]
    frame = documents(rows).selectExpr("*", "'x' fp", "1 component_id")
    out = one_of_each(frame)
    assert out.columns == frame.columns
    assert sorted((r.doc_id for r in out.collect()), key=str) == [1, 3, None]


def test_empty_table_and_null_ids(documents):
    assert near_duplicates(documents([])).count() == 0
    only = near_duplicates(documents([(None, "a"), (None, "a")])).collect()
    assert [r.component_id for r in only] == [None, None]


def test_one_of_each_does_not_depend_on_order(spark):
    rng = random.Random(8)
    texts = [" ".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=40)) for _ in range(4)]
    a, b, c, d = texts
    rows = [(1, a, "x"), (5, a, "y"), (5, b, "z"), (5, b, "y"), (6, b, "z"), (7, c, "p"), (7, d, "q"), (7, c, "r"), (8, None, "n"), (9, "", "n"), (None, a, "u"), (None, None, "v")]
    seen = set()
    for _ in range(6):
        rng.shuffle(rows)
        frame = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
        seen.add(tuple(sorted(map(tuple, one_of_each(frame).collect()), key=repr)))
    (kept,) = seen
    assert {(r[0], r[1]) for r in kept} == {(1, a), (5, b), (7, c), (7, d), (8, None), (None, a), (None, None)}
    assert len(kept) == 7


def test_one_of_each_keeps_one_row_of_each_component(spark):
    """Repeated ids, copies and near copies against components found pair by pair."""
    rng = random.Random(12)
    base = ["".join(rng.choices("abcdefgh ", k=120)) for _ in range(12)]
    rows = []
    for i in range(90):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            text[rng.randrange(len(text))] = rng.choice("xyz")
        rows.append((rng.randint(0, 40), "".join(text)))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    marked = {}
    for text in {t for _, t in rows}:
        marked[text] = None
    ordered = sorted(marked)
    for row in near_duplicates(spark.createDataFrame(list(enumerate(ordered)), "doc_id long, text string")).collect():
        marked[ordered[row.doc_id]] = row.component_id
    least = {}
    for i, text in rows:
        least[marked[text]] = min(i, least.get(marked[text], i))
    kept = one_of_each(frame).collect()
    assert sorted((marked[r.text], r.doc_id) for r in kept) == sorted(least.items())
    assert {tuple(r) for r in kept} <= set(rows)


def test_long_texts_are_read_in_parts():
    rng = random.Random(14)
    texts = ["".join(rng.choices(["Ab", "c", " ", "\t", "d é"], k=rng.randint(1, 400))) for _ in range(40)] + ["", " ", "one two", "x" * 500]
    for text in texts:
        for limit in (16, 100):
            assert int(long_fingerprint(pa.array([text]), limit)[0]) == fingerprint(text)
