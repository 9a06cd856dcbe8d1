"""Groups of documents and lines against brute force, on small tables made for the awkward cases."""

import itertools
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from candlewick.llm import contamination, graph, jaccard, lines, substrings
from candlewick.llm.queries import QUERIES

from .conftest import EDGES, SMALL


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    return {n: find(n) for n in nodes}


def corpus(seed):
    """Documents that share passages, copies and near copies, some within one document."""
    dice = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: [dice.choice(vocabulary) for _ in range(n)]
    passages = [text(n) for n in (20, 34, 35, 36, 60, 90)]
    docs = [text(dice.randint(0, 120)) for _ in range(25)]
    for _ in range(25):
        parts = [text(dice.randint(0, 40))]
        for _ in range(dice.randint(0, 3)):
            parts += [dice.choice(passages), text(dice.randint(0, 30))]
        docs.append(list(itertools.chain(*parts)))
    for base in dice.sample(docs, 15):
        copy = list(base)
        for _ in range(dice.randint(0, 3)):
            if copy:
                copy[dice.randrange(len(copy))] = dice.choice(vocabulary)
        docs.append(copy)
    return [(i, " ".join(d)) for i, d in enumerate(docs)] + [(900 + i, t) for i, t in EDGES if i and i != 5]


# ---- components


def test_components_of_random_links(spark):
    dice = random.Random(2)
    links = [(dice.randint(0, 300), dice.randint(0, 300)) for _ in range(160)] + [(i, i + 1) for i in range(1000, 1100)]
    links += [(2000, i) for i in range(2001, 2100)] + [(5, 5)]
    of = roots({n for x in links for n in x}, links)
    least = {}
    for n, r in of.items():
        least[r] = min(n, least.get(r, n))
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {n for n in of if all(n not in x or x[0] == x[1] for x in links)}
    assert got == {n: least[r] for n, r in of.items() if n not in alone}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- n-gram Jaccard


def brute_groups(rows, n, percent):
    sets = {}
    for i, (_, text) in enumerate(rows):
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    links = [
        (a, b) for a, b in itertools.combinations(sets, 2)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    of, least = roots(sets, links), {}
    for i, r in of.items():
        if rows[i][0] is not None:
            least[r] = min(rows[i][0], least.get(r, rows[i][0]))
    return Counter((rows[i][0], len(sets[i]), least.get(r) if sets[i] else rows[i][0]) for i, r in of.items())


@pytest.mark.parametrize("seed, n, percent", [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_jaccard_groups(docs_of, seed, n, percent):
    rows = corpus(seed) + [(950, "One two THREE four five"), (951, "one two three four FIVE"), (952, "é É"), (953, "É é"), *EDGES[4:7]]
    got = jaccard.similar_groups(docs_of(rows), n=n, percent=percent)
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got.collect()) == brute_groups(rows, n, percent)


def test_large_group_of_near_copies(docs_of):
    dice = random.Random(4)
    base = [f"w{dice.randint(0, 999)}" for _ in range(150)]
    rows = []
    for i in range(120):
        copy = list(base)
        for _ in range(3):
            copy[dice.randrange(150)] = f"x{dice.randint(0, 99999)}"
        rows.append((i, " ".join(copy)))
    got = jaccard.similar_groups(docs_of(rows), n=4, percent=85)
    assert Counter((r.id, r.n_shingles, r.component_id) for r in got.collect()) == brute_groups(rows, 4, 85)


def test_one_of_each_group_stays(docs_of):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words are here now yes"), (4, None), (5, ""), (3, "other words are here now yes")]
    kept = jaccard.keep_one_of_each(docs_of(rows))
    assert sorted((r.doc_id, r.text) for r in kept.collect() if r.text) == [(1, rows[0][1]), (3, rows[2][1]), (3, rows[2][1])]
    assert kept.count() == 5 and kept.columns == docs_of(rows).columns
    assert jaccard.keep_one_of_each(docs_of(rows).limit(0)).count() == 0
    with pytest.raises(ValueError):
        jaccard.similar_groups(docs_of(rows), percent=40)


# ---- substrings


def brute_removal(rows, window):
    split = [words(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1))
    out = Counter()
    for (doc, _), w in zip(rows, split, strict=True):
        drop = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                drop.update(range(i, i + window))
        out[(doc, len(w), len(drop), " ".join(x for k, x in enumerate(w) if k not in drop))] += 1
    return out


@pytest.mark.parametrize("seed, window", [(1, 35), (2, 35), (3, 12)])
def test_removed_substrings(docs_of, seed, window):
    rows = corpus(seed) + EDGES[4:7]
    got = substrings.remove_duplicates(docs_of(rows), window=window)
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == brute_removal(rows, window)


def test_texts_of_one_id_are_told_apart(docs_of):
    """Pairs of texts under one id (and under none) whose hashes agree in their last 23 bits."""
    dice, seen, pairs = random.Random(8), {}, []
    passage = [f"p{i}" for i in range(40)]
    while len(pairs) < 4:
        text = " ".join([str(dice.random()) for _ in range(dice.randint(0, 80))] + passage)
        low = xxhash.xxh64_intdigest(text.encode(), 42) & ((1 << 23) - 1)
        if seen.setdefault(low, text) != text:
            pairs.append((seen[low], text))
    rows = [(1 if i < 2 else None, t) for i, pair in enumerate(pairs) for t in pair]
    got = substrings.remove_duplicates(docs_of(rows))
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got.collect()) == brute_removal(rows, 35)


def test_factors_are_copies(docs_of):
    rows = corpus(5)
    texts = {i: words(t) for i, t in rows}
    found = 0
    for r in substrings.remove_duplicates(docs_of(rows)).collect():
        for f in r.factors:
            found += 1
            here = texts[r.doc_id][f.start : f.start + f.length]
            assert f.length >= 35 and here == texts[f.document][f.position : f.position + f.length]
            assert (f.document, f.position) != (r.doc_id, f.start)
    assert found > 10
    assert substrings.remove_duplicates(docs_of(rows).limit(0)).count() == 0


# ---- lines


def normal(line):
    return re.sub("[1-9]", "0", re.sub(r"[\W_]+", " ", line.lower()).strip(" "))


def similar_pairs(texts):
    """All pairs of distinct lines with an edit similarity of 0.8, measured by another engine.

    Pairs that letters and pairs of letters rule out are left out: an edit changes one letter and two pairs of
    letters on either side. That engine counts bytes, so every letter becomes one byte.
    """
    texts = sorted(texts, key=len)
    letters = [c for c, _ in Counter("".join(texts)).most_common()]
    assert len(letters) < 127
    to_byte = str.maketrans({c: chr(i + 1) for i, c in enumerate(letters)})
    coded = [t.translate(to_byte) for t in texts]
    raw = [np.frombuffer(t.encode(), np.uint8).astype(int) for t in coded]
    bags = np.array([np.bincount(x, minlength=128) for x in raw], np.int16).reshape(len(texts), -1)
    twos = np.array([np.bincount((x[:-1] * 131 + x[1:]) % 509, minlength=509) for x in raw], np.int16).reshape(len(texts), -1)
    sizes = np.array([len(t) for t in texts])
    near = []
    for i in range(len(texts)):
        end = np.searchsorted(sizes, sizes[i] / 0.8 + 1e-9, side="right")
        most = np.floor(0.2 * sizes[i + 1 : end] + 1e-9)
        at = i + 1 + np.flatnonzero(np.abs(bags[i + 1 : end] - bags[i]).sum(axis=1) <= 2 * most)
        at = at[np.abs(twos[at] - twos[i]).sum(axis=1) <= 4 * most[at - i - 1]]
        near += [(i, int(j)) for j in at]
    con = duckdb.connect()
    con.register("rows", pa.table({"a": [coded[i] for i, _ in near], "b": [coded[j] for _, j in near], "i": [i for i, _ in near], "j": [j for _, j in near]}))
    found = con.execute(
        "SELECT i, j FROM rows WHERE levenshtein(a, b) <= floor(greatest(length(a), length(b)) * 0.2 + 1e-9)"
    ).fetchall() if near else []
    return [(texts[i], texts[j]) for i, j in found]


def line_places(rows):
    """(document, number, normalised line) of every line with five words or more."""
    found = [(doc, k, normal(line)) for doc, text in rows for k, line in enumerate((text or "").split("\n"))]
    return [x for x in found if len(x[2].split(" ")) >= 5]


def without_duplicates(rows, group_of):
    """Texts that keep the first line, by document and number, of each group of normalised lines."""
    seen, drop = set(), set()
    for doc, k, n in sorted(line_places(rows), key=lambda x: x[:2]):
        if group_of[n] in seen:
            drop.add((doc, k))
        seen.add(group_of[n])
    return {d: None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in drop) for d, t in rows}


def brute_lines(rows):
    """Texts without duplicate lines by the definition: similar lines, whatever their fingerprints are."""
    nodes = {n for *_, n in line_places(rows)}
    return without_duplicates(rows, roots(nodes, similar_pairs(nodes)))


def check_lines(docs, rows, least_share):
    """Links are right, nearly all are found, and removal follows from the groups."""
    nodes = {n for *_, n in line_places(rows)}
    pairs = similar_pairs(nodes)
    truth = roots(nodes, pairs)
    text_of = {(d, k): n for d, k, n in line_places(rows)}
    found = {text_of[r.id, r.line]: r.group for r in lines.groups(docs).collect()}
    assert set(found) == nodes
    whole = {}
    for n, group in found.items():
        assert whole.setdefault(group, truth[n]) == truth[n]
    together = sum(found[a] == found[b] for a, b in pairs)
    assert len(pairs) > 30 and together >= least_share * len(pairs), (together, len(pairs))
    got = {r.doc_id: r.text for r in lines.remove_duplicate_lines(docs).collect()}
    assert got == without_duplicates(rows, found)
    return together, len(pairs)


def line_corpus(seed):
    dice = random.Random(seed)
    vocabulary = ["".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(dice.randint(2, 9))) for _ in range(200)]
    base = [[dice.choice(vocabulary) for _ in range(dice.randint(3, 60))] for _ in range(15)]
    base.append([dice.choice(vocabulary) for _ in range(200)])
    rows = []
    for i in range(60):
        out = []
        for _ in range(dice.randint(0, 5)):
            line = list(dice.choice(base))
            for _ in range(dice.randint(0, 2)):
                line[dice.randrange(len(line))] = dice.choice(vocabulary)
            out.append(dice.choice([" ", "  ", ", "]).join(line) + dice.choice(["", ".", " 17"]))
        rows.append((i, "\n".join(out)))
    return rows + [(900, None), (901, ""), (902, "\n\n"), (903, "Reordered words do stay here"), (904, "here stay do words Reordered")]


@pytest.mark.parametrize("seed", [1, 2])
def test_lines_against_brute_force(docs_of, seed):
    rows = line_corpus(seed)
    check_lines(docs_of(rows), rows, 0.97)


def test_lines_of_a_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    check_lines(docs, [tuple(r) for r in docs.collect()], 0.97)


def test_compared_lines_grow_with_the_lines(spark):
    """Rows of blocks that lines share, for each line: no larger for ten times the lines."""
    share = []
    for folder in ("sf0.001", "sf0.01"):
        docs = spark.read.parquet(f"/root/testdata/{folder}/documents.parquet")
        texts = lines._lines(docs, "doc_id", "text", 5).groupBy("node").agg(F.first("normal").alias("normal"))
        keys = lines.block_keys(texts)
        n, (rows, largest) = texts.count(), keys.groupBy("key").count().where("count > 1").agg(F.sum("count"), F.max("count")).first()
        assert largest <= 16
        share.append(rows / n)
    assert share[1] < 1.5 * share[0] + 0.5


def test_many_lines_that_share_blocks_are_not_all_compared(spark, docs_of):
    """Lines of one long common passage and different ends: similar to none, but alike in many blocks."""
    dice = random.Random(9)
    word = lambda: "".join(dice.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7))
    passage = [word() for _ in range(60)]
    rows = [(i, " ".join(passage + [word() for _ in range(40)])) for i in range(400)]
    plain = lines._lines(docs_of(rows), "doc_id", "text", 5)
    keys = lines.block_keys(plain.groupBy("node").agg(F.first("normal").alias("normal")))
    rest = lines._rest(keys.withColumn("component", F.col("node"))).count()
    assert rest < 0.2 * 400 * 399 / 2
    got = {r.doc_id: r.text for r in lines.remove_duplicate_lines(docs_of(rows)).collect()}
    assert got == dict(rows)


def test_plans_of_lines_compile(spark, docs_of):
    """No plan is too large for the compiler."""
    spark.conf.set("spark.sql.codegen.fallback", "false")
    spark.conf.set("spark.sql.codegen.factoryMode", "CODEGEN_ONLY")
    try:
        assert lines.remove_duplicate_lines(docs_of(line_corpus(3))).count() == 65
    finally:
        spark.conf.unset("spark.sql.codegen.fallback")
        spark.conf.unset("spark.sql.codegen.factoryMode")


CLASHES = ["_id", "_mark", "_lines", "id", "mark", "line", "node", "normal", "first", "key", "_ledger", "lines", "n_removed_lines"]


def test_clashing_names_are_kept(spark):
    rows = [(1, "a line with some more words in it\nnext", *CLASHES), (2, "a line with some more words in it", *CLASHES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"{c} string" for c in CLASHES))
    cleaned = lines.remove_duplicate_lines(docs, count="n_gone")
    assert cleaned.columns == [*docs.columns, "n_gone"]
    assert {r.doc_id: (r.text, r.n_gone, r.n_removed_lines) for r in cleaned.collect()} == {
        1: (rows[0][1], 0, "n_removed_lines"), 2: ("", 1, "n_removed_lines")
    }
    assert lines.remove_duplicate_lines(docs).columns == docs.columns
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns and kept.count() == 1  # four of five shingles are common
    items = spark.createDataFrame([(1, "a line with some more words in it")], "item_id long, text string")
    leaked = contamination.with_leaks(docs, items)
    assert set(docs.columns) <= set(leaked.columns) and leaked.count() == 2
    assert contamination.clean(docs, items).columns == docs.columns


def test_line_edges(docs_of):
    docs = docs_of(EDGES)
    cleaned = lines.remove_duplicate_lines(docs)
    assert cleaned.columns == [*docs.columns, "n_removed_lines"] and cleaned.count() == len(EDGES)
    assert lines.remove_duplicate_lines(docs.limit(0)).count() == 0


def test_lines_need_no_python(docs_of):
    plan = lines.remove_duplicate_lines(docs_of(EDGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---- benchmark

ITEMS = [
    (1, "A farmer has 12 apples and sells 12 apples each day to Anna and Bob for 3 dollars until none remain."),
    (2, "what is the capital city of France"), (3, None), (4, "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15"), (2, "what is the capital city of France"),
]


@pytest.mark.parametrize(
    "text, leaked",
    [
        (f"before. {ITEMS[0][1]} after", [1]),
        ("A farmer has 15 apples and sells 15 apples each day to Maria and Tom for 4 dollars until none remain.", [1]),
        ("A farmer has 15 apples and sells 16 apples each day", []),
        ("A farmer has 15 apples and sells 15 apples", []),
        ("so what is the capital city of Spain then", [2]),
        ("numbers 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20", []),
        ("a text about quite other things than those that were asked in there", []),
        (None, []), ("", []), ("word " * 30_000, []),
    ],
)
def test_leaks(spark, docs_of, text, leaked):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = contamination.with_leaks(docs_of([(1, text), (1, text), (None, text)]), items).collect()
    assert [sorted({x["item"] for x in r.leaked}) for r in rows] == [leaked] * 3
    kept = contamination.clean(docs_of([(1, text)]), items)
    assert kept.count() == (0 if leaked else 1)


def test_verbatim_items_leak_whatever_their_words_are(spark, docs_of):
    texts = [
        "In what year did Albert Einstein win the Nobel Prize in Physics?", "3 7 11 15 19 23 27 31", "Paris London Rome",
        "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15",
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = docs_of([(i, f"so then {t} and more") for i, t in enumerate(texts)] + [(9, "years 4 8 12 16 20 24 28 32 in Berlin Madrid")])
    assert sorted((r.id, r["item"]) for r in contamination.leaks(docs, items).collect()) == [(i, i) for i in range(len(texts))]


def test_names_at_sentence_starts_and_number_words_are_slots(spark, docs_of):
    texts = [
        "Tom has 3 apples. Tom buys 4 more apples. How many apples does Tom have?",
        "the shop sold three red pens and twelve blue pens to NASA staff on that day",
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    docs = docs_of([
        (0, "Anna has 7 apples. Anna buys 9 more apples. How many apples does Anna have?"),
        (1, "the shop sold seven red pens and twenty blue pens to ESA staff on that day"),
        (2, "Anna has 7 apples. Bob buys 9 more apples. How many apples does Eve have?"),
    ])
    assert sorted((r.id, r["item"]) for r in contamination.leaks(docs, items).collect()) == [(0, 0), (1, 1)]


def test_slots_must_agree():
    window = lambda at, values, found: {
        "item_at": at, "doc_at": at + 10, "size": len(values), "n_words": 30, "item_values": values, "doc_values": found
    }
    agree = [window(0, ["a", "12", "b"], ["a", "15", "b"]), window(1, ["12", "b", "12"], ["15", "b", "15"])]
    clash = [window(0, ["a", "12", "b"], ["a", "15", "b"]), window(1, ["12", "b", "12"], ["15", "b", "16"])]
    merged = [window(0, ["1", "x", "2"], ["7", "x", "7"])]
    assert contamination._longest(agree) == (4, 30)
    assert contamination._longest(clash) == (3, 30)
    assert contamination._longest(merged) == (0, 0)


def test_empty_benchmark_and_many_blocks(spark, docs_of, monkeypatch):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = docs_of([(1, ITEMS[0][1]), (2, "nothing of it")])
    assert contamination.leaks(docs, items.limit(0)).count() == 0
    assert contamination.leaks(docs.limit(0), items).count() == 0
    monkeypatch.setattr(contamination, "BLOCK_WINDOWS", 3)
    assert [(r.id, r["item"]) for r in contamination.leaks(docs, items).collect()] == [(1, 1)]


def test_whole_items_are_found_in_the_small_table(spark):
    items = {r.item_id: " ".join(words(r.text)) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    texts = {r.doc_id: " ".join(words(r.text)) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op9_benchmark_leaks"](spark, SMALL).collect():
        assert set(r.item_ids) >= {i for i, t in items.items() if t in texts[r.doc_id]}
        assert r.leaked == bool(r.item_ids)
