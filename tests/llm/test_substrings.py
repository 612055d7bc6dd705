import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from lakelayers.llm import substrings
from lakelayers.llm.substrings import candidate_windows, dedup_substrings, places_of_documents, repeated_places, unbundle, without_repeats


def brute(rows, width):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - width + 1):
            if d is not None:
                key = tuple(w[i : i + width])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, w in words:
        goes = [False] * len(w)
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                goes[i : i + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, goes) if not g)
        out.append((d, len(w), sum(goes), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted(((r[0], r[1], r[2], r[3]) for r in frame.collect()), key=repr)


def texts():
    rng = random.Random(3)
    passage = " ".join(rng.choices("abcdefghij", k=30))
    rows = [(i, " ".join(rng.choices("abcdefghij", k=rng.randint(0, 40)))) for i in range(60)]
    rows += [(100 + i, f"{rng.random()} {passage} {rng.random()}") for i in range(40)]
    return rows


def test_equals_brute_force(documents):
    rows = texts()
    for width in (3, 13):
        assert found(dedup_substrings(documents(rows), width=width)) == brute(rows, width)


def test_collisions_in_a_tiny_sketch_change_nothing(documents):
    rows = texts()
    assert found(dedup_substrings(documents(rows), width=5, max_log2_cells=4)) == brute(rows, 5)


def test_nulls_empties_ties_and_repeated_rows(documents):
    long = " ".join(map(str, range(20)))
    rows = [
        (5, None), (6, ""), (7, " \n\t"), (None, long), (None, None), (9, long), (9, long), (9, "x " + long), (10, long + "\n"), (3, "a b"),
    ]
    assert found(dedup_substrings(documents(rows))) == brute(rows, 13)


def test_empty_table(documents):
    assert dedup_substrings(documents([])).count() == 0


def test_clashing_columns_and_stage(documents):
    frame = documents([(1, "a b c d"), (2, "x a b c y"), (3, "a b c"), (4, "")]).selectExpr("*", "1L n_words", "'k' row", "'p' places", "5L n_chars")
    out = without_repeats(frame, width=3)
    assert out.columns == frame.columns
    assert {(r.doc_id, r.text, r.n_words, r.row, r.n_chars) for r in out.collect()} == {
        (1, "a b c d", 1, "k", 5), (2, "x y", 1, "k", 3), (4, "", 1, "k", 5),
    }


def test_a_hot_window_sends_one_place_a_flush(monkeypatch):
    """A passage in all documents: its range gets one standing place a flush and window, and holds no more
    than its distinct windows; the other places go by document."""
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(20))
    rows = [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(3000)]
    rng.shuffle(rows)
    monkeypatch.setattr(substrings, "FLUSH_ROWS", 500)
    monkeypatch.setattr(substrings, "HELD_ROWS", 40)
    batch = pa.RecordBatch.from_pydict({"doc_id": [d for d, _ in rows], "text_key": [d * 7 for d, _ in rows], "text": [t for _, t in rows]})
    every = [np.full(1 << 13, 255, np.uint8)] * 2
    shared = type("Shared", (), {"value": every})
    bundled = [row for i in range(0, 3000, 50) for out in candidate_windows(13, 16, 4, shared)(iter([batch.slice(i, 50)])) for row in out.to_pylist()]
    standing = [unbundle(row) for row in bundled if not row["local"]]
    hashes = Counter(h for part in standing for h in part["h1"].tolist())
    assert sum(n > 1 for n in hashes.values()) == 8 and max(hashes.values()) <= 60
    by_document = Counter(row["range"] for row in bundled if row["local"])
    assert len(by_document) == 4
    bundled.sort(key=lambda row: row["range"])
    sizes, merge = [], substrings.without_larger
    monkeypatch.setattr(substrings, "without_larger", lambda every: sizes.append(len(every)) or merge(every))
    kinds = {n: k for n, k in (x.split() for x in substrings._BUNDLE.split(", "))}
    arrow = {"int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_()}
    given = pa.Table.from_pylist(bundled, pa.schema([(n, arrow[k]) for n, k in kinds.items()])).to_batches()
    dealt = [row for out in repeated_places(4)(iter(given)) for row in out.to_pylist()]
    distinct = 3000 * 10
    assert max(sizes) <= distinct
    assert all(row["local"] for row in dealt)
    dealt.sort(key=lambda row: row["range"])
    gone = {}
    for out in places_of_documents(iter(pa.Table.from_pylist(dealt, given[0].schema).to_batches(5))):
        for row in out.to_pylist():
            assert row["text_key"] == row["doc_id"] * 7 and row["doc_id"] not in gone
            gone[row["doc_id"]] = np.frombuffer(row["places"], np.int32).tolist()
    assert gone == {d: list(range(1, 9)) for d in range(1, 3000)}


def test_long_texts_are_read_in_parts():
    rng = random.Random(21)
    for width in (3, 13):
        for _ in range(20):
            words = [rng.choice(["a", "bc", "déf", "g" * 30]) for _ in range(rng.randint(0, 120))]
            text = "".join(w + rng.choice([" ", "\n ", "\t"]) for w in words)
            places = sorted(rng.sample(range(max(1, len(words) - width + 1)), k=min(4, max(0, len(words) - width + 1))))
            packed = np.array(places, np.int32).tobytes() if places else None
            piece = pa.RecordBatch.from_arrays([pa.array([text]), pa.array([packed], pa.binary())], ["text", "places"])
            gone = {at + i for at in places for i in range(width)}
            left = " ".join(w for i, w in enumerate(words) if i not in gone).encode()
            for counts, removed, texts in (substrings.kept_of(piece, width), substrings.kept_of_long(piece, width, 40), substrings.kept_of_long(piece, width, 200)):
                assert (counts.tolist(), removed.tolist(), texts) == ([len(words)], [len(gone)], [left])
            for limit in (40, 200):
                seen = []
                for before, part in substrings.parts_of(piece, width, limit):
                    part_words = [part.data[a:b].tobytes().decode() for a, b in zip(part.starts, part.ends)]
                    seen += [(before + at, part_words[at : at + width]) for at in substrings.window_starts(part, width)]
                assert seen == [(at, words[at : at + width]) for at in range(len(words) - width + 1)]


def test_a_long_text_gives_its_passages_to_others(documents):
    rng = random.Random(22)
    long = [f"w{rng.randrange(10**6)}" for _ in range(120_000)]
    cut = 70_000
    got = {r.doc_id: r for r in substrings.dedup_substrings(documents([(1, " ".join(long)), (2, "x " + " ".join(long[cut : cut + 20]) + " y"), (3, " ".join(long[5:]))])).collect()}
    assert [(got[d].n_words, got[d].n_removed) for d in (1, 2, 3)] == [(120_000, 0), (22, 20), (119_995, 119_995)]
