import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(packing.tokenizer_path())


def check_round_trip(rows, texts, tokenizer, length=packing.SEQUENCE):
    """Pieces cover every document and every sequence is gapless."""
    ids = {k: [*tokenizer.encode(t or "", add_special_tokens=False).ids, packing.END_ID] for k, t in texts.items()}
    covered, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["doc_tokens"] == len(own)
        piece = np.array(own[r["start"] : r["start"] + r["length"]], "<u4")
        assert len(piece) == r["length"] and zlib.crc32(piece.tobytes()) == r["ids_crc32"]
        covered[r["doc_id"]].append((r["start"], r["length"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(covered) == set(ids)
    for spans, end in [(sorted(covered[k]), len(ids[k])) for k in ids] + [(sorted(s), None) for s in sequences.values()]:
        at = 0
        for start, n in spans:
            assert start == at
            at += n
        assert at == end if end is not None else at <= length
    return sequences


def test_documents_come_back(documents, tokenizer):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    sequences = check_round_trip(packing.pack(documents).collect(), texts, tokenizer)
    used = sum(n for s in sequences.values() for _, n in s)
    assert used / (len(sequences) * packing.SEQUENCE) > 0.98


def test_odd_rows(odd, none, odd_rows, tokenizer):
    rows = packing.pack(odd).collect()
    per_text = Counter((r["doc_id"], r["start"]) for r in rows)
    assert per_text[2, 0] == 2 and per_text[None, 0] == 2
    texts = {i: t for i, t, _, _ in odd_rows}
    unique = odd.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    check_round_trip(packing.pack(unique).collect(), {i: t for i, t in texts.items() if i is not None}, tokenizer)
    assert packing.pack(none).collect() == []


@pytest.mark.parametrize("text", [
    "it's DON'T x'll", "<|endoftext|> and <|startoftext|>x", "a\x1cb c\x1f", "ΣΑΣ İstanbul", "1234 ½² a1b2", "é ́x",
    " x y", "中文 \U0001f600!", "### $$$a&&&", "", "♥ ♥", "a" * 5000, "don't!!!'s", "x\u0085y", "'something 'really l'el 'l 've've'", "a'S'T'Re'd9's", "'", "¿qué? ªº ǅ Ǆ ŉ ß \xad\xa0x", "ends'",
])
def test_ids_are_the_tokenizers(text, tokenizer):
    own = packing.WordTokens(packing.tokenizer_path())
    assert [list(a) for a in own.ids([text, text + " " + text, None])] == [
        tokenizer.encode(t, add_special_tokens=False).ids for t in (text, text + " " + text, "")]


def test_packs_hold_every_length():
    r = np.random.default_rng(3)
    for room in (1, 7, 64):
        counts = {n: int(r.integers(0, 50)) for n in range(1, room + 1)}
        packs = packing.pack_histogram(counts, room)
        held = Counter()
        for lengths, number in packs:
            assert sum(lengths) <= room and list(lengths) == sorted(lengths, reverse=True)
            for n in lengths:
                held[n] += number
        assert held == Counter({n: c for n, c in counts.items() if c})


def naive_packs(counts, room):
    """Each piece, longest first, into the pack with the fewest tokens, if it has room there."""
    sizes = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            k = min(range(len(sizes)), key=sizes.__getitem__) if sizes else -1
            if k >= 0 and sizes[k] + length <= room:
                sizes[k] += length
            else:
                sizes.append(length)
    return sorted(sizes)


@pytest.mark.parametrize("seed", range(8))
def test_as_many_packs_as_piece_by_piece(seed):
    r = np.random.default_rng(seed)
    room = int(r.integers(5, 80))
    counts = {n: int(r.integers(1, 9)) for n in range(1, room + 1) if r.random() < 0.5}
    packs = packing.pack_histogram(counts, room)
    assert sum(number for _, number in packs) == len(naive_packs(counts, room))
