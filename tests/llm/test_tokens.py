"""Token ids against the libraries themselves, on whole tables and on awkward texts."""

import hashlib
import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from candlewick.llm import bpe, planes
from candlewick.llm.queries import QUERIES
from candlewick.session import scratch_path

from .conftest import EDGES, SMALL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ALPHABET = "ab \n\t\r\x0b\x0c\x1c\x1f\x85 　   '  stéÄ123!?<|endoftext|>漢字😀\x00​.,'lls"


def awkward(count):
    dice = random.Random(7)
    return ["".join(dice.choice(ALPHABET) for _ in range(dice.randint(0, 60))) for _ in range(count)]


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(RANKS), special_tokens={})


def test_encoder_gives_the_ids_of_the_ranks(reference):
    coder = bpe.Encoder(bpe.serialize_model(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    texts = awkward(3000)
    coded = coder.encode(texts)
    assert coded == [packed(reference.encode_ordinary(t)) for t in texts]
    assert [coder.decode(x) for x in coded] == [t.encode() for t in texts]


def test_every_token_encodes_to_itself_or_its_merges(reference):
    coder = bpe.Encoder(bpe.serialize_model(bpe.read_ranks(RANKS)), public_tokenizers.PATTERN)
    texts = [t.decode() for t in list(bpe.read_ranks(RANKS))[::7] if t.decode(errors="ignore").encode() == t]
    assert coder.encode(texts) == [packed(reference.encode_ordinary(t)) for t in texts]


def test_ranks_must_be_complete():
    with pytest.raises(ValueError):
        bpe.serialize_model({bytes([b]): b for b in range(255)})
    with pytest.raises(ValueError):
        bpe.serialize_model({bytes([b]): b + 1 for b in range(256)})


def test_byte_bpe_on_whole_documents(spark, reference):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op2_byte_bpe"](spark, SMALL).collect():
        ids = packed(reference.encode_ordinary(texts[r.doc_id]))
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_encoding_keeps_rows_and_columns(spark, docs_of):
    coder = bpe.ByteBpe(spark, RANKS, public_tokenizers.PATTERN)
    docs = docs_of(EDGES)
    done = coder.decode(coder.encode(docs))
    assert done.columns == [*docs.columns, "ids", "decoded"]
    rows = done.collect()
    assert sorted((r.text or "") for r in rows) == sorted((t or "") for _, t in EDGES)
    assert all(bytes(r.decoded).decode() == (r.text or "") for r in rows)
    assert coder.encode(docs.limit(0)).count() == 0
    again = coder.encode(docs.withColumn("ids", F.lit(3)))
    assert again.columns == [*docs.columns, "ids"]


def test_tokens_are_those_of_whole_texts():
    source = open(JSON).read()
    plain, whole = planes.Tokens(source, 0), Tokenizer.from_str(source)
    whole.encode_special_tokens = True
    texts = awkward(3000)
    want = [packed([*x.ids, 0]) for x in whole.encode_batch(texts, add_special_tokens=False)]
    assert plain._plain and plain.encode(texts) == want


def test_lines_and_marks_are_cut_where_the_library_cuts():
    source = open(JSON).read()
    plain, whole = planes.Tokens(source, 0), Tokenizer.from_str(source)
    whole.encode_special_tokens = True
    dice = random.Random(11)
    signs = ["\n", "\n", "\n\n", "\r\n", " ", " ", " ", "\t", ".", ",", "'", "'s", "..", "<|endoftext|>", "²", "ǅ", "\u0378", "漢", "a", "word", "É"]
    texts = ["".join(dice.choices(signs, k=dice.randint(0, 30))) for _ in range(20_000)]
    texts += ["\n", "a\n", "\na b", "a\n\nb c", "a b\nc\n\nd e", "a \nb c", "a b\n c", "a b.\n.c d", "a b\n...\nc"]
    assert plain.encode(texts) == [packed([*x.ids, 0]) for x in whole.encode_batch(texts, add_special_tokens=False)]


def test_words_meet_the_library_once():
    tokens = planes.Tokens(open(JSON).read(), 0)
    words, marks = [f"w{i}ord" for i in range(60)], [".", ",", "!!", "&&&", ".)", "?", ";", ":", '."', "..."]
    text = "start " + " ".join(w + m for m in marks for w in words) + " " + "\n".join(w + m for w in words for m in marks)
    seen, inner = [], tokens._whole
    tokens._whole = lambda texts: seen.extend(texts) or inner(texts)
    tokens.encode([text])
    assert sum(map(len, seen)) < 3 * sum(map(len, words)) + 100


def test_other_tokenizers_see_whole_texts():
    source = open(public_tokenizers.path("word_bpe_49k.json")).read()
    other, whole = planes.Tokens(source, 5), Tokenizer.from_str(source)
    whole.encode_special_tokens = True
    texts = awkward(300)
    assert not other._plain
    assert other.encode(texts) == [packed([*x.ids, 5]) for x in whole.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("bits", [False, True])
def test_planes_round_trip(bits):
    for count in (0, 1, 7, 8, 1000):
        ids = np.random.default_rng(1).integers(0, 2**32, count, dtype=np.uint64).astype("<u4")
        assert (planes.join_planes(planes.split_planes(ids, bits), count) == ids).all()


def test_crc_of_parts():
    dice = random.Random(3)
    parts = [dice.randbytes(dice.randint(0, 200)) for _ in range(30)]
    assert planes.crc32_of_parts([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@pytest.mark.parametrize("bits, block_ids", [(False, 1 << 18), (False, 100), (True, 7)])
def test_files_give_the_ids_back(spark, docs_of, bits, block_ids):
    rows = [x for x in EDGES if len(x[1] or "") < 10_000] if block_ids == 7 else EDGES
    path = scratch_path(spark, "planes")
    planes.write_ids(docs_of(rows), path, JSON, block_ids=block_ids, bits=bits)
    whole = Tokenizer.from_file(JSON)
    whole.encode_special_tokens = True
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is not None, rows[i][0] or 0))
    want, start = [], 0
    for i in order:
        ids = np.array([*whole.encode(rows[i][1] or "", add_special_tokens=False).ids, 0], "<u4")
        want.append((rows[i][0], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    got = [tuple(r) for r in planes.read_digests(spark, path).orderBy("start").select("id", "start", "n_tokens", "ids_crc32").collect()]
    assert got == want
    segments = planes.read_segments(spark, path)
    assert segments.agg(F.sum(F.size("ids"))).first()[0] == start
    index = planes.read_index(spark, path).orderBy("start").collect()
    assert [r.start for r in index] == [sum(x.n_ids for x in index[:i]) for i in range(len(index))]
    assert all(r.n_ids <= block_ids for r in index)


def test_no_documents_no_blocks(spark, docs_of):
    path = scratch_path(spark, "planes")
    planes.write_ids(docs_of([(1, "a")]).limit(0), path, JSON)
    assert planes.read_digests(spark, path).count() == 0
