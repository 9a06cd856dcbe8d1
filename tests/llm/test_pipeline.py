"""The pipeline stage by stage against plain Python on the small table."""

import hashlib

import public_tokenizers
import tiktoken

import corpus_pipeline
from candlewick.llm import bpe, quality

from .conftest import SMALL
from .test_duplicates import brute_groups, brute_lines, words  # noqa: F401


def test_rows_of_the_pipeline(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    ledger = quality.with_ledger(spark.read.parquet(f"{SMALL}/documents.parquet"))
    good = {r.doc_id for r in quality.apply_policy(ledger, corpus_pipeline.POLICY).collect()}
    docs = {i: t for i, t in docs.items() if i in good}
    cleaned = brute_lines(list(docs.items()))
    docs = {i: t for i, t in cleaned.items() if t == docs[i] or words(t)}
    kept = {i for i, _, component in brute_groups(list(docs.items()), 5, 80) if i == component}
    docs = {i: t for i, t in docs.items() if i in kept}
    items = [" ".join(words(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    docs = {i: t for i, t in docs.items() if not any(x in " ".join(words(t)) for x in items)}
    coder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, special_tokens={},
        mergeable_ranks=bpe.read_ranks(public_tokenizers.path(corpus_pipeline.RANKS)),
    )
    got = corpus_pipeline.run(spark, SMALL).collect()
    assert all(r.exact for r in got)
    digest = lambda ids: hashlib.sha256(bytes(ids)).hexdigest()
    want = {i: b"".join(x.to_bytes(4, "little") for x in coder.encode_ordinary(t)) for i, t in docs.items()}
    assert {r.doc_id: (r.n_tokens, digest(r.ids)) for r in got} == {i: (len(x) // 4, digest(x)) for i, x in want.items()}


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SMALL).columns == docs.columns
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0


def test_stages_keep_columns_of_any_name_and_odd_rows(spark):
    names = ["_id", "_mark", "_ledger", "_lines", "_removed", "_leaked", "row", "mark", "n_removed_lines"]
    text = " ".join(f"plainword{i} and others" for i in range(30))
    rows = [(i, t, "en", "web", len(t or "")) for i, t in [(1, text), (1, text), (None, text + " end"), (3, None), (4, "")]]
    docs = spark.createDataFrame(
        [(*r, *names) for r in rows], "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names)
    )
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SMALL)
        assert kept.columns == docs.columns, name
        found = kept.select("doc_id", *names).collect()
        assert all(tuple(r)[1:] == tuple(names) for r in found), name
        ids = sorted(r.doc_id or 0 for r in found)
        assert ids in ([0, 1, 1], [0, 1, 1, 3, 4], [0, 3, 4], [1, 1, 3, 4]), (name, ids)
