import zlib

import numpy as np

from lakelayers.llm.sharding import assign_shards, jump, write_shards


def slow_jump(key, shards):
    b, j = -1, 0
    while j < shards:
        b = j
        key = (key * 2862933555777941757 + 1) & (2**64 - 1)
        j = int((b + 1) * (2.0**31 / ((key >> 33) + 1)))
    return b


def test_jump_equals_the_plain_loop_and_moves_only_into_the_new_shard():
    keys = np.array([0, 1, 2**63, 2**64 - 1, *range(100, 600)], np.uint64)
    for n in (1, 2, 24, 25, 1000):
        assert jump(keys.copy(), n).tolist() == [slow_jump(int(k), n) for k in keys]
    before, after = jump(keys.copy(), 24), jump(keys.copy(), 25)
    assert set(after[before != after]) == {24}


def test_assignment(documents):
    rows = [(i, "é" * (i % 7)) for i in range(500)] + [(7, "x"), (7, "x"), (None, None), (None, "a"), (-3, "")]
    got = assign_shards(documents(rows)).collect()
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id is not None) == sorted(
        (d, len(t.encode()) + 8, zlib.crc32(t.encode())) for d, t in rows if d is not None
    )
    slots = {}
    for r in got:
        key = -1 if r.doc_id is None else r.doc_id
        assert (r.law, r.shard, r.grown_shard) == ("key", slow_jump(key % 2**64, 24), slow_jump(key % 2**64, 25))
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_empty_table(documents):
    assert assign_shards(documents([])).count() == 0


def test_written_shards_hold_all_rows(documents, spark, tmp_path):
    frame = documents([(i, str(i)) for i in range(60)])
    write_shards(frame, str(tmp_path / "s"), shards=4, buckets=2)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert {(r.doc_id, r.shard) for r in back.collect()} == {(i, slow_jump(i, 4)) for i in range(60)}
