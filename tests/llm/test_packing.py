from __future__ import annotations

import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from cases import awkward, awkward_rows, clashing, empty
from statewatt.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def direct(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_ids_are_the_tokenizer_s(spark):
    odd = [
        None, "", "  ", "Hello, WORLD. it's we'll I'D don't.", "a.b,c..", "İstanbul ΣΑΣ. straße ﬁn Å é é", "x y z \u0085 \x1c\x1f", "1234 5,6. ..",
        "<|endoftext|> a<|startoftext|>b", "end <|endoftext|> of.<|endoftext|>, <|END|> ª º µ ß ŉ ſ ſs. ǰ ŒUVRE, ñÑ.", "😀😀 中文字, ok", "﻿bom", "ａｂｃ", "tab\tline\r\n\x0bform\x0c", "'s 's. 'S", "ǅ ᾼ", "́a", "IDIOT!!", "a" * 300 + ".",
    ]
    rng = random.Random(3)
    odd += ["".join(rng.choice("abCD.,' \n'éÉ1!") for _ in range(200)) for _ in range(60)]
    tokenizer = packing.WordTokenizer(PATH)
    for _ in range(2):  # at first from the vocabulary, then from memory
        for text, ids in zip(odd, tokenizer.encode(pa.array(odd, pa.string()))):
            assert ids.tolist() == direct(text), text


def test_letters_that_normalise_to_a_mark():
    """All letters whose normal form ends in something that is no letter, before a full stop or comma."""
    letters = [c for c in map(chr, range(0x80, 0x110000)) if c.isalpha() and not unicodedata.normalize("NFC", c).lower().isalpha()]
    assert len(letters) > 50 and "İ" in letters
    texts = [f"{word}{mark}" for c in letters for word in (c, f"geld{c}", f"geld{c}m") for mark in ("", ".", ",")] + ["GELDİ.", "GELDİ", "école.", "ÉCOLE,"]
    tokenizer = packing.WordTokenizer(PATH)
    want = {t: tokenizer.tokenizer.encode(t, add_special_tokens=False).ids for t in texts}
    for _ in range(2):
        for text, ids in zip(texts, tokenizer.encode(pa.array(texts, pa.string()))):
            assert ids.tolist() == want[text], text


def test_forgetting_does_not_matter(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 50)
    tokenizer = packing.WordTokenizer(PATH)
    texts = [r[1] for r in awkward_rows()][:12]
    assert [i.tolist() for i in tokenizer.encode(pa.array(texts, pa.string()))] == [direct(t) for t in texts]
    assert len(tokenizer.numbers) < 20_000 and len(tokenizer.pool) == tokenizer.size.sum()


def test_every_latin_letter(spark):
    letters = [c for c in map(chr, range(0x250)) if c.isalpha()]
    texts = [f"{a}{b}{mark}" for a in letters for b in ("", "a", "É", letters[-1]) for mark in ("", ".", ",")]
    for text, ids in zip(texts, packing.WordTokenizer(PATH).encode(pa.array(texts))):
        assert ids.tolist() == direct(text), text


def check(rows, docs, length):
    ids = defaultdict(list)
    for r in docs:
        ids[r[0]].append(direct(r[1]) + [packing.END])
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    assert set(by_doc) == set(ids)
    for doc, pieces in by_doc.items():
        want = sorted((n, zlib.crc32(np.array(own, "<u4").tobytes())) for own in ids[doc] for n in [len(own)])
        assert sum(p["length"] for p in pieces) == sum(n for n, _ in want)
        assert {p["doc_tokens"] for p in pieces} == {n for n, _ in want}
        if len(ids[doc]) == 1:
            at, own = 0, ids[doc][0]
            for p in sorted(pieces, key=lambda p: p["start"]):
                assert p["start"] == at and p["length"] > 0
                assert p["ids_crc32"] == zlib.crc32(np.array(own[at : at + p["length"]], "<u4").tobytes())
                at += p["length"]
            assert at == len(own)
    padding = 0
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= length
        padding += 0 if at & (at - 1) == 0 else length - at
    assert padding == 0


def test_pieces_hold_each_id_once(spark):
    for docs in (awkward(spark), clashing(awkward(spark))):
        check(packing.pack(docs, PATH).collect(), awkward_rows(), 4096)
    check(packing.pack(awkward(spark), PATH, length=64, window=512).collect(), awkward_rows(), 64)


def test_costs_are_balanced():
    rng = random.Random(1)
    items = [(i, 0, rng.randrange(1, 60)) for i in range(400)]
    n = sum(x[2] for x in items) // 100
    pieces, rest = packing.assign(items, [100] * n)
    assert sum(p.length for p in pieces) == 100 * n
    assert sum(x[2] for x in rest) == sum(x[2] for x in items) - 100 * n
    spent = np.zeros(n)
    for p in pieces:
        spent[p.sequence] += packing.cost(p.length)
    assert spent.max() < 1.1 * spent.min()
    assert packing.powers(0) == [] and packing.powers(1300) == [1024, 256, 16, 4]


def test_empty_table(spark):
    assert packing.pack(empty(spark), PATH).count() == 0
