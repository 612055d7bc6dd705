import random
from collections import Counter, defaultdict

from lakelayers.llm.packing import Bins, pack


def words(n, tag=""):
    return " ".join(f"{tag}{i}" for i in range(n))


def check(rows, placed, capacity, per_source):
    want = Counter()
    for _, text, _ in rows:
        want[len((text or "").split())] += 1
    bins = defaultdict(list)
    for r in placed:
        bins[r.group_id, r.bin].append(r)
    by_id = defaultdict(int)
    for r in placed:
        by_id[r.doc_id] += r.n_words
    total = defaultdict(int)
    for d, text, _ in rows:
        total[d] += len((text or "").split())
    assert by_id == total
    source = {d: s for d, _, s in rows}
    text = {d: t for d, t, _ in rows}
    for held in bins.values():
        assert sum(r.n_words for r in held) == held[0].bin_words <= capacity
        assert max(Counter(source[r.doc_id] for r in held).values()) <= per_source
        filled = [text[r.doc_id] for r in held if text[r.doc_id] is not None]
        assert len(filled) == len(set(filled))
    return bins


def test_bins_keep_all_constraints(documents):
    rng = random.Random(6)
    rows = [(i, words(rng.randint(0, 120), rng.choice("abc")), rng.choice(["s", "s", "t", "u", None])) for i in range(400)]
    for per_source in (1, 2):
        frame = documents([(d, t, None, s) for d, t, s in rows])
        placed = pack(frame, capacity=50, per_source=per_source, group_rows=150).collect()
        check(rows, placed, 50, per_source)


def test_long_documents_are_cut_without_loss(documents):
    placed = pack(documents([(1, words(130), None, "s")]), capacity=50).collect()
    assert sorted((r.piece, r.start, r.n_words) for r in placed) == [(0, 0, 50), (1, 50, 50), (2, 100, 30)]
    assert len({r.bin for r in placed}) == 3


def test_the_tightest_compatible_bin_is_found():
    bins = Bins(10, 1)
    assert [bins.put(7, 1, 0), bins.put(6, 2, 1), bins.put(5, 4, 2)] == [0, 1, 2]  # residuals 3, 4, 5
    assert bins.put(3, 8, 0) == 0  # fits exactly
    assert bins.put(4, 2, 0) == 2  # bin 1 is tighter but holds the source
    assert bins.put(4, 16, 1) == 3  # bin 1 holds the cluster
    assert bins.put(4, 32, 0) == 1


def test_copies_and_nulls(documents):
    rows = [(i, "same text here", "s") for i in range(30)] + [(None, None, None), (99, "", None), (98, "", None)]
    placed = pack(documents([(d, t, None, s) for d, t, s in rows]), capacity=20).collect()
    bins = check(rows, placed, 20, 2)
    assert len(bins) >= 30 and len(placed) == len(rows)


def test_empty_table(documents):
    assert pack(documents([])).count() == 0


def test_every_put_takes_the_tightest_compatible_bin():
    """Against a plain scan of all bins."""
    rng = random.Random(21)
    for per_source in (1, 2, 3):
        bins, held = Bins(40, per_source), []
        for _ in range(900):
            size, source, cluster = rng.randint(0, 40), 1 << rng.randint(0, 5), rng.choice([0, 0, 1 << rng.randint(0, 30)])
            fits = [
                40 - sum(s for s, _, _ in b) for b in held
                if sum(s for s, _, _ in b) + size <= 40
                and sum(o == source for _, o, _ in b) < per_source
                and not any(cluster and c == cluster for _, _, c in b)
            ]
            before = [40 - sum(s for s, _, _ in b) for b in held]
            number = bins.put(size, source, cluster)
            if number == len(held):
                assert not fits
                held.append([])
            else:
                assert before[number] == min(fits)
            held[number].append((size, source, cluster))
        assert [40 - sum(s for s, _, _ in b) for b in held] == bins.residual


def test_equal_rows_and_null_ids_spread_over_groups(documents, monkeypatch):
    import lakelayers.llm.packing as packing

    monkeypatch.setattr(packing, "COPIES", 70)
    rows = [(7, "a b c", None, "s")] * 600 + [(None, "d e", None, "t")] * 300 + [(1000 + i, "x", None, None) for i in range(100)]
    placed = pack(documents(rows), capacity=10, group_rows=100).collect()
    assert len(placed) == 1000 and sum(r.n_words for r in placed) == 2500
    groups = Counter(r.group_id for r in placed if r.doc_id == 7)
    assert len(groups) == 11 and max(groups.values()) < 120
    bins = Counter((r.group_id, r.bin) for r in placed if r.doc_id == 7)
    assert max(bins.values()) == 1  # one cluster: never twice in a bin
