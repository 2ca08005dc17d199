import zlib

import numpy as np
import pytest
from conftest import SF01
from helpers import docs, table
from tokenizers import Tokenizer

from sparkcivic.llm import packing, q_packing

PATH = q_packing.tokenizer_path()
HARD = ["A\x1cb İΣ ΑΣ x y z 1234 é <|endoftext|> don't 'RE", "", "  ", "a" * 200 + " b", "it'restaurant we'll!!'s 'S,'t '' 's9t ß×÷ÀÖØÞ é 12'd",
        "é ﬁ ŉ ſ", "tab\tnew\r\nline x", "<|startoftext|>", "日本語 text"]


def test_ids_equal_the_tokenizer():
    t = Tokenizer.from_file(PATH)
    texts = HARD + [r["text"] or "" for r in table("documents")]
    for cached in (10 ** 6, 5):
        units = packing.Units(PATH, cached)
        for run in packing.groups(texts, 3000):
            for i, ids in zip(run, units.encode_batch([texts[i] for i in run])):
                assert ids.tolist() == t.encode(texts[i], add_special_tokens=False).ids


def made_units(n):
    """Distinct words of 5 to 17 letters."""
    out = []
    for i in range(n):
        w = ""
        while i or not w:
            w, i = w + "etaoinshrdlu"[i % 12], i // 12
        out.append(w + "q" * (5 + len(out) % 13 - len(w)))
    return list(dict.fromkeys(out))


def test_units_take_little_memory_and_common_ones_stay():
    import tracemalloc
    words = made_units(30_000)
    units = packing.Units(PATH, 10 ** 6)
    tracemalloc.start()
    for a in range(0, len(words), 3000):
        list(units.encode_batch([" ".join(words[a:a + 3000])]))
    per_unit = tracemalloc.get_traced_memory()[0] / len(words)
    tracemalloc.stop()
    assert per_unit < 100
    few, coded = packing.Units(PATH, 4000), []
    learn = few.learn
    few.learn = lambda new, *rest: (coded.extend(new), learn(new, *rest))
    for a in range(0, len(words), 1000):
        list(few.encode_batch(["again and " + " ".join(words[a:a + 1000])]))
        assert len(few.hash) <= 4000 + 1002 and len(few.longer) <= len(few.hash)
    assert coded.count("again") == coded.count("and") == 1


def test_a_shared_hash_changes_no_id(monkeypatch):
    monkeypatch.setattr(packing, "_SPREAD", np.uint64(0))  # units that share eight bytes share the hash
    t, texts = Tokenizer.from_file(PATH), ["internationally", "one internationale international two", "x <|", "three"]
    units = packing.Units(PATH)
    for run in (texts[:1], texts, texts):
        for text, ids in zip(run, units.encode_batch(run)):
            assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


def test_long_texts_are_cut_at_blanks(monkeypatch):
    monkeypatch.setattr(packing, "RUN_CHARS", 50)
    t, units = Tokenizer.from_file(PATH), packing.Units(PATH)
    texts = ["It's a LONG text,\n\nwith 12345 'signs'!!'s and\ta" + "b" * 90 + " end  " * 40 + "l", "short", "\u65e5" * 80, "x" * 200, " " * 120, ""]
    for text, ids in zip(texts, units.encode_batch(texts)):
        assert ids.tolist() == t.encode(text, add_special_tokens=False).ids


def brute_best_fit(lengths, capacity):
    rooms, out = [], []
    for size in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms[rooms.index(min(fits))] -= size
        else:
            rooms.append(capacity - size)
        out.append(size)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 65, 500)
    bins, offsets = packing.best_fit_decreasing(lengths, 64)
    rooms = [64 - lengths[bins == b].sum() for b in range(bins.max() + 1)]
    assert sorted(rooms) == brute_best_fit(lengths.tolist(), 64)
    for b in range(bins.max() + 1):
        own = np.argsort(offsets[bins == b])
        o, n = offsets[bins == b][own], lengths[bins == b][own]
        assert o[0] == 0 and (o[1:] == (o + n)[:-1]).all()


def check(rows, texts):
    t = Tokenizer.from_file(PATH)
    places, total = {}, 0
    for r in rows:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for p in places.values():
        p.sort()
        assert p[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(p, p[1:])) and sum(n for _, n in p) <= 2048
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    for i, text in texts.items():
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids + [0], dtype="<u4")
        own = sorted(by[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 2048)) and [r["piece"] for r in own] == list(range(len(own)))
        for r in own:
            part = ids[r["start"]:r["start"] + 2048]
            assert r["length"] == len(part) and r["ids_crc32"] == zlib.crc32(part.tobytes())
        total += len(ids)
    return len(places), -(-total // 2048)


def test_documents(spark):
    rows = q_packing.query(spark, SF01).collect()
    used, least = check(rows, {r["doc_id"]: r["text"] for r in table("documents", SF01)})
    assert used <= least + 2


def test_edge_rows(spark):
    texts = dict(enumerate([None, "", *HARD, "word " * 30_000]))
    rows = packing.tokenize_and_pack(docs(spark, list(texts.items()), clash=True), PATH).collect()
    check(rows, texts)
    big = 2 ** 62 + 1
    ids = {r["doc_id"] for r in packing.tokenize_and_pack(docs(spark, [(big, "a"), (None, "b")]).coalesce(1), PATH).collect()}
    assert ids == {big, None}  # exact beside a NULL
    twice = packing.tokenize_and_pack(docs(spark, [(1, "a"), (1, "a"), (None, "b")]), PATH).collect()
    assert len(twice) == 3 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 3
    assert packing.tokenize_and_pack(docs(spark, ["a"]).limit(0), PATH).count() == 0


def test_small_shards_lose_no_piece(spark):
    pieces = packing.cut_pieces(docs(spark, ["w " * (k % 40 + 1) for k in range(300)]), PATH)
    rows = packing.pack(pieces, 300, shard=20).collect()
    assert len(rows) == 300 and len({(r["sequence_id"], r["offset"]) for r in rows}) == 300
