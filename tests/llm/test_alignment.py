"""Alignment of two tokenizers against plain loops over tokens and pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from candlewick.llm import alignment
from candlewick.llm.queries import QUERIES

from .conftest import EDGES, SMALL

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment.byte_alphabet()
    spell_a = lambda i: bytes(letters[c] for c in a.id_to_token(i))
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return lambda text: a.encode(" " + text, add_special_tokens=False).ids, lambda text: b.encode(text), spell_a, spell_b


def brute(rows, sides):
    encode_a, encode_b, spell_a, spell_b = sides

    def spans(ids, spell):
        out, at = [], 0
        for i in ids:
            out.append((i, at, at + len(spell(i))))
            at = out[-1][2]
        return out

    linked, digests = [], []
    for _, text in rows:
        ids_a, ids_b = (encode_a(text), encode_b(text)) if text else ([], [])
        want = (" " + text).encode() if text else b""
        if b"".join(map(spell_a, ids_a)) != want or b"".join(map(spell_b, ids_b)) != want:
            ids_a, ids_b = [], []
        a, b = spans(ids_a, spell_a), spans(ids_b, spell_b)
        links, j = [], 0
        for x, start, end in a:
            while j < len(b) and b[j][2] <= start:
                j += 1
            k = j
            while k < len(b) and b[k][1] < end:
                links.append((x, b[k][0]))
                k += 1
        common = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, low = [], 0
        for high in common:
            inside = [",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in (a, b)] if len(text) < 3000 else []
            groups.append("|".join(inside))
            low = high
        linked.append((len(a), len(b), len(common), links))
        digests.append(None if a and len(text) >= 3000 else hashlib.sha256(";".join(groups).encode()).hexdigest() if a else "")
    counts = Counter(p for *_, links in linked for p in set(links))
    most = Counter()
    for (x, _), n in counts.items():
        most[x] = max(most[x], n)
    return [
        (i, na, nb, ng, len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), digest)
        for (i, _), (na, nb, ng, links), digest in zip(rows, linked, digests, strict=True)
    ]


def found(spark, docs, **limits):
    rows = alignment.aligned(docs, A, public_tokenizers.PATTERN, B, **limits).collect()
    order = lambda r: (r[0] is None, r[0] or 0, r[1:])
    return sorted((tuple(r) for r in rows), key=order)


def same(got, want):
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[1:7]))
    assert [r[:7] for r in got] == [r[:7] for r in want]
    assert all(b[7] is None or a[7] == b[7] for a, b in zip(got, want, strict=True))


def awkward():
    dice = random.Random(3)
    words = ["the", "Haus", "été", "漢字", "😀", "it's", "1234", "<|endoftext|>", "</s>", "<unk>", "naïvé", "x" * 30, "\0", "ﬁ", "▁", "<0x41>"]
    texts = [dice.choice(["", " "]).join(dice.choices(words, k=dice.randint(1, 40))) for _ in range(60)]
    return list(enumerate(texts + ["two  spaces", " lead", "trail ", "line\nbreak\t\ttab", " ", "\n", "a b", "the the the"] * 3, 100))


@pytest.mark.parametrize("fan, rows", [(48, 1 << 15), (2, 3)])
def test_against_loops(spark, docs_of, sides, fan, rows, monkeypatch):
    monkeypatch.setattr(alignment, "RUN_ROWS", rows)
    table = awkward() + EDGES
    same(found(spark, docs_of(table).repartition(3), fan=fan), brute(table, sides))


def test_tables(spark, docs_of, sides):
    assert found(spark, docs_of([])) == []
    assert found(spark, docs_of([(1, None), (2, "")])) == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]
    small = spark.read.parquet(f"{SMALL}/documents.parquet")
    got = sorted(tuple(r) for r in QUERIES["op12_tokenizer_alignment"](spark, SMALL).collect())
    same(got, brute([(r.doc_id, r.text) for r in small.collect()], sides))


def test_fast_side_for_all_code_points(sides):
    """The two libraries cut at the same characters: every code point beside letters, digits, marks and spaces."""
    side = alignment.ByteLevel(open(A, encoding="utf-8").read(), public_tokenizers.PATTERN)
    assert side._fast is not None
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for start in range(0, len(points), 4000):
        text = "".join(f"a{c}b 1{c}2 !{c}? {c} {c}z" for c in points[start : start + 4000])
        assert side.encode(text) == side._slow.encode(text, add_special_tokens=False).ids
    assert len(side.encode(" " * 100_000)) == len(side._slow.encode(" " * 100_000).ids)


def test_merging():
    dice = np.random.default_rng(1)
    runs = []
    for n in (0, 5, 400, 1, 300):
        pairs = np.unique(dice.integers(0, 1 << 19, n))
        runs.append((pairs, dice.integers(1, 9, len(pairs))))
    want = Counter()
    for pairs, counts in runs:
        want.update(dict(zip(pairs.tolist(), counts.tolist(), strict=True)))
    pairs, counts = alignment.merge_runs(runs)
    assert list(zip(pairs.tolist(), counts.tolist(), strict=True)) == sorted(want.items())
    for values in (np.zeros(0, np.int64), np.array([3, 70_000, 2**40])):
        assert (alignment._unpacked(alignment._packed(alignment._small(values))) == values).all()
