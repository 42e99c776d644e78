"""Operators 4 and 9: the tokenizer libraries and exact round trips."""

import random
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from texts import corpus
from tokenizers import Tokenizer

from tallyframe.llm import arrays, byte_tokens, packing, piece_tokens
from tallyframe.llm.catalog import tokenizer

BPE, PIECES = tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model")
ODD = ["a  b", "a   b", " \n a", " x ", "a\n ", "it's  don't 's", "it's don't x's", "<|endoftext|> hi<|endoftext|>", "　 a", "a   b", "tab\t x",
       "\r\n b", "² ½ x", "  ", "", "é́ x", None, "a b  ", "日本語のテキスト 🎉🎉 x", "a" * 200, "ééé" * 50, "\n\n\n   \t x", "<s> </s> <unk> <0x41>", "▁x ▁", "x\x00y \x1c z"]


def test_byte_ids_equal_the_library():
    texts = ODD + [t for _, t in corpus(3)] + ODD
    lib = Tokenizer.from_file(BPE)
    ids, off = byte_tokens.byte_tokens(BPE).encode(*arrays.text_bytes(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == lib.encode(t or "", add_special_tokens=False).ids, t


def test_piece_ids_equal_the_library():
    texts = [t or "" for t in ODD] + [t or "" for _, t in corpus(4)]
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    p = piece_tokens.pieces(PIECES)
    ids, off, _ = p.encode(texts)
    got = [ids[a:b].tolist() for a, b in zip(off, off[1:])]
    assert got == lib.encode(texts)
    assert p.decode(ids, off) == lib.decode(got)


def test_piece_query_round_trip(make):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(100, None)]
    out = piece_tokens.encode(make(rows), PIECES)
    got = {r.doc_id: r for r in out.collect()}
    assert all(r.decodes_back and r.n_ids == len(r.ids) for r in got.values()) and got[100].ids == []
    back = {r.doc_id: r.text for r in piece_tokens.decode(out, PIECES).collect()}
    assert back[0] == "a  b" and back[18] == ODD[18] and back[100] == ""
    assert piece_tokens.encode(make([]), PIECES).collect() == []


def test_long_words_and_known_words(monkeypatch):
    """Words without blanks are relaxed on their own; words met before give the same ids."""
    import random

    import sentencepiece
    rng = random.Random(4)
    lib = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = "etaoinshrdlu" * 3 + "ABCxyz019+/=éß中文字🙂"
    texts = ["".join(rng.choices(letters, k=n)) for n in (200, 257, 300, 5000, 40_000)] + ["a" * 3000, "ab" * 2000, "中" * 700, "x " + "the" * 400 + " y", " " * 900]
    texts += [" ".join("".join(rng.choices(letters, k=rng.randrange(1, 12))) for _ in range(400)) for _ in range(5)]
    want = lib.encode(texts)
    for most in (1 << 19, 500, 3):
        monkeypatch.setattr(piece_tokens, "MOST_KNOWN", most)
        p = piece_tokens.Pieces(PIECES)
        for _ in range(3):
            ids, off, _ = p.encode(texts)
            assert [ids[off[i]:off[i + 1]].tolist() for i in range(len(texts))] == want
            assert len(p.known.first) <= most


def test_a_word_of_a_million_characters():
    import random

    import sentencepiece
    rng = random.Random(5)
    text = "".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", k=1_000_000))
    ids, off, _ = piece_tokens.Pieces(PIECES).encode([text])
    assert ids.tolist() == sentencepiece.SentencePieceProcessor(model_file=PIECES).encode(text)


def check_plan(count, capacity):
    got = {}
    for n, lengths in packing.plan(count, capacity):
        assert n > 0 and sum(lengths) <= capacity
        for w in lengths:
            got[w] = got.get(w, 0) + n
    assert got == {w: c for w, c in count.items() if c}


def optimum(items, capacity):
    """Fewest bins, by trying."""
    items, best = sorted(items, reverse=True), [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, bins[:k] + [bins[k] + items[i]] + bins[k + 1 :])
        place(i + 1, [*bins, items[i]])

    place(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(8))
def test_plan_uses_every_piece(seed):
    rng = random.Random(seed)
    for _ in range(40):
        capacity, count = rng.choice([7, 30, 100]), {}
        for _ in range(rng.randint(0, 60)):
            w = rng.randint(1, capacity)
            count[w] = count.get(w, 0) + rng.randint(1, 3)
        check_plan(count, capacity)


def test_reduction_keeps_the_optimum():
    """Fixing dominating sets never costs a sequence."""
    rng = random.Random(5)
    for _ in range(120):
        capacity = rng.choice([10, 17, 24])
        items = [rng.randint(1, capacity) for _ in range(rng.randint(1, 9))]
        fixed, rest = packing.reduce_by_dominance({w: items.count(w) for w in items}, capacity)
        left = [w for w, c in rest.items() for _ in range(c)]
        assert sum(n for n, _ in fixed) + optimum(left, capacity) == optimum(items, capacity)


def test_packing(make):
    rng = random.Random(1)
    words = "alpha beta gamma delta epsilon zeta".split()
    rows = corpus(2, 30) + [(200 + k, " ".join(rng.choice(words) for _ in range(n))) for k, n in enumerate([5000, 2047, 2048, 4094, 1, 900, 1100, 2600])]
    rows += [(300, "same text"), (300, "same text"), (301, None)]
    docs = make(rows)
    got = packing.pack(docs, BPE, bucket_rows=7).collect()
    lib = Tokenizer.from_file(BPE)
    want = []
    for i, t in rows:
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 0]
        first = len(ids) % 2048 or 2048
        cuts = [0, *range(first, len(ids), 2048), len(ids)] if len(ids) > 2048 else [0, len(ids)]
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want.append((i, p, a, b - a, zlib.crc32(struct.pack(f"<{b - a}I", *ids[a:b]))))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= -(-sum(r.length for r in got) // 2048) + 2
    assert packing.pack(make([]), BPE).collect() == []


def test_no_empty_array_surprises():
    ids, off = byte_tokens.byte_tokens(BPE).encode(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    assert len(ids) == 0 and off.tolist() == [0]


def test_a_batch_is_encoded_in_small_slices():
    """Encoding a batch of many texts holds arrays for a small slice of it, and gives each text's own ids."""
    import tracemalloc

    class Docs:
        def select(self, *names):
            return self

        def mapInArrow(self, run, schema):
            return run

    rng = random.Random(9)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choices(words, k=900)) for _ in range(2500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])
    run = packing.pieces(Docs(), BPE)
    model, rows = byte_tokens.byte_tokens(BPE), []
    assert batch.nbytes > 12 << 20
    tracemalloc.start()
    for out in run(iter([batch])):
        rows += out.select(["doc_id", "piece", "start", "length"]).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 128 << 20
    sizes = {}
    for r in rows:
        assert r["start"] == sizes.get(r["doc_id"], 0)
        sizes[r["doc_id"]] = r["start"] + r["length"]
    assert sizes == {i: len(model.whole(t)) + 1 for i, t in enumerate(texts)}
