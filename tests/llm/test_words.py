import random
import re

import numpy as np
import pyarrow as pa
from hypothesis import given
from hypothesis import strategies as st

from lakelayers.llm.words import find_words, long_parts, pieces, window_hashes, window_starts, word_hashes

TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="ab é\t\n\x0b\x1c ", max_size=30)), max_size=6)


def plain(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())


@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    words = find_words(pa.array(texts, pa.string()))
    found = [bytes(words.data[a:b]) for a, b in zip(words.starts, words.ends)]
    assert found == [w for t in texts for w in plain(t)]
    assert words.counts.tolist() == [len(plain(t)) for t in texts]


@given(TEXTS)
def test_equal_words_have_equal_hashes_and_others_not(texts):
    words = find_words(pa.array(texts, pa.string()))
    by_word = {}
    for a, b, h in zip(words.starts, words.ends, word_hashes(words)):
        assert by_word.setdefault(bytes(words.data[a:b]), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_windows_stay_within_a_text():
    words = find_words(pa.array(["a b c", "a b", None, "a b c d"]))
    starts = window_starts(words, 3)
    assert starts.tolist() == [0, 5, 6]
    hashes = window_hashes(word_hashes(words), starts, 3, 12345)
    assert hashes[0] == hashes[1] != hashes[2]


def test_pieces_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 5, None, "y" * 50, "", "z"])], ["text"])
    parts = [p.column("text").to_pylist() for p in pieces(batch, limit=10)]
    assert parts == [["x" * 5, None], ["y" * 50], ["", "z"]] or sum(parts, []) == batch.column("text").to_pylist()
    assert not list(pieces(batch.slice(0, 0)))


def test_lower_case_is_ascii_only():
    words = find_words(pa.array(["AbÉ"]), lower=True)
    assert bytes(words.data).decode() == "abÉ"
    assert np.diff(words.first).tolist() == [1]


def test_parts_of_a_long_text_share_no_window():
    rng = random.Random(9)
    for _ in range(60):
        text = "".join(rng.choices(["a", "bé", " ", "\n", "cccccccccccc", "  "], k=rng.randint(0, 300)))
        raw = text.encode()
        whole = re.findall(rb"[^\x20\x09-\x0D]+", raw)
        for overlap, limit in ((0, 7), (1, 3), (3, 10), (5, 64)):
            windows = []
            for at, part in long_parts(pa.array([text]), overlap, limit):
                data = part.cast(pa.large_binary())[0].as_py()
                assert raw[at : at + len(data)] == data
                words = re.findall(rb"[^\x20\x09-\x0D]+", data)
                windows += [tuple(words[i : i + overlap + 1]) for i in range(len(words) - overlap)]
            assert windows == [tuple(whole[i : i + overlap + 1]) for i in range(len(whole) - overlap)]


def test_very_long_words_have_the_hash_of_one_sum(monkeypatch):
    texts = pa.array(["ab " + "xyz" * 50 + " c", "q" * 64, None, "r" * 65 + " " + "s" * 200])
    whole = word_hashes(find_words(texts))
    monkeypatch.setattr("lakelayers.llm.words.LONG_WORD", 16)
    assert (word_hashes(find_words(texts)) == whole).all()


def test_hashes_and_shapes_are_those_of_plain_sums_and_made_without_an_entry_for_each_byte():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from lakelayers.llm import brown, words as w

    rng = np.random.default_rng(3)
    tokens = ["".join(chr(c) for c in rng.choice([97, 98, 46, 44, 39, 228, 0x4E2D, 48], rng.integers(1, n))) for n in [3, 9, 31, 32, 33, 34, 70, 300] * 40]
    found = w.find_words(pa.array([" ".join(tokens[:100]) + " ", None, "", "\t".join(tokens[100:])]))
    hashes, kinds = w.word_hashes(found), brown.shapes(found)
    assert len(hashes) == len(tokens) and kinds.dtype == np.int8
    keys, power = [int(x) for x in w._BYTE_KEYS], [pow(int(w._STEP), i, 2**64) for i in range(2000)]
    for i, token in enumerate(tokens):
        data = token.encode()
        total = (sum(keys[b] * power[k] for k, b in enumerate(data)) + len(data)) % 2**64
        assert hashes[i] == w.mixed(np.array([total], np.uint64))[0]
        end = 1 if data[-1] == 46 else 2 if data[-1] == 44 else 0 if data[-1] >= 128 or chr(data[-1]) in "ab0" else 3
        assert kinds[i] == 2 * end + any(b >= 128 for b in data)
    text = w.find_words(pa.array(["walking through " * 30_000]))
    w.word_hashes(text)
    tracemalloc.start()
    w.word_hashes(text)
    assert tracemalloc.get_traced_memory()[1] < 16 * len(text.data)
    tracemalloc.stop()
