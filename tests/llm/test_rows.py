"""Extraction, personal data, chats and quality rules on small cases with known results."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from candlewick.llm import chat, html, pii, quality
from candlewick.llm.queries import QUERIES

from .conftest import EDGES, SMALL

# ---- pages


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""), ("", ""), ("<html><body></body></html>", ""), ("plain &amp; text", "plain & text"),
        ("<body><p>one <b>two</b>\n three</p><p>four</p></body>", "one two three\nfour"),
        ("<body><article><h1>T</h1><p>a<p>b</article><footer>f</footer></body>", "T\na\nb"),
        ("<body><div class='sidebar'>x x x x x x x x x</div><div><p>the text of it all, and more</p></div></body>",
         "the text of it all, and more"),
        ("<body><article><p>kept words</p><script>var a='<p>no</p>'</script><form>no<input></form></article></body>", "kept words"),
        ("<body><article><p>kept</p></article><section id=comments><p>" + "reader words " * 50 + "</p></section></body>", "kept"),
        ("<body><nav><a href=x>" + "menu " * 50 + "</a></nav><article><p>short</p></article></body>", "short"),
        ("<body><article><p>unclosed &lt;tag&gt; &#233;&eacute;", "unclosed <tag> éé"),
        ("<div>" * 5000 + "deep" + "</div>" * 5000, "deep"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_main_text_of_the_pages_is_the_article(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    import html as entities

    for r in QUERIES["op5_main_text"](spark, SMALL).collect():
        inside = re.search(r"<article>(.*)</article>", pages[r.page_id], re.DOTALL).group(1)
        parts = (re.sub(r"\s+", " ", entities.unescape(re.sub(r"</?b>", "", x))).strip() for x in re.split(r"</?p>|<br>|</?h1>", inside))
        assert r.text == "\n".join(x for x in parts if x)
        assert r.n_chars == len(r.text)


def test_text_outweighs_links():
    link = "<a href=x>many linked words stand here in a row</a> "
    page = f"<body><div>{link * 20}</div><div><p>{'plain words of the text ' * 20}</p><p>{'and more of them ' * 20}</p></div></body>"
    assert "linked" not in html.main_text(page)



def test_all_dense_sections_of_a_page_without_article():
    part = lambda name, n: f"<div class={name}>" + "".join(f"<p>{f'{name} number {i} ' * 20}</p>" for i in range(n)) + "</div>"
    links = "<ul>" + "<li><a href=x>link</a></li>" * 6 + "</ul>"
    text = html.main_text(f"<body><div id=content><h1>A title</h1>{part('s1', 5)}{part('s2', 4)}</div>{links}<p>{'alone ' * 50}</p></body>")
    assert all(f"{name} number {i}" in text for name, n in (("s1", 5), ("s2", 4)) for i in range(n))
    assert "alone" in text and "link" not in text
    assert text.count("s1 number 0") == 20


# ---- personal data

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


CASES = [
    "mail a.b+c@x-y.example.com, a@b.c_d@e.f and @no.at x@y",
    "ip 1.2.3.4 and 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004",
    "card 4111 1111 1111 1111, 4111-1111-1111-1112 and 4111111111111111 40000000000000000000001",
    "call +1 (555) 123-4567 or +49.30.1234567 or +1 2 and +123456789012345678",
    "😀 é +1 (171) 555-2028 x@y.z", "1" * 30_000, "a" * 30_000 + "@b.c", "1.2.3.4 " * 3000, "4111 " * 4000, "a.b@c.d" + ".e" * 20_000,
]


def test_base_spans_are_those_of_plain_patterns(spark, docs_of):
    rows = list(enumerate(CASES)) + [(i, t) for i, t in EDGES if i not in range(len(CASES))]
    found = pii.find(docs_of(rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        got = [f"{x.kind}:{x.start}:{x.end}" for x in r.personal if x.kind in pii.base_kinds()]
        assert got == plain_spans(r.text or "")


def test_base_spans_of_whole_documents(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op6_personal_data"](spark, SMALL).collect():
        want = plain_spans(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x.startswith(k) for x in want) for k in BASE]


def test_checksums_and_context_decide_on_further_spans(spark, docs_of):
    rows = [
        (1, "IBAN DE89 3704 0044 0532 0130 00."), (2, "IBAN DE88 3704 0044 0532 0130 00."),
        (3, "amex card 378282246310005"), (4, "number 378282246310005"), (5, "phone: 030 123 4567"), (6, "order 030 123 4567"),
    ]
    got = {r.doc_id: [x.kind for x in r.personal] for r in pii.find(docs_of(rows)).collect()}
    assert got == {1: ["iban"], 2: [], 3: ["card_short"], 4: [], 5: ["phone_local"], 6: []}


def test_personal_data_needs_no_python(spark, docs_of):
    plan = pii.find(docs_of(EDGES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# ---- chats

TEXTS = ["", "plain", r"\### Assistant: </turn> ok", "<turn>", r"<\turn/>", r"<\\/turn>\n", "a<turn/>b</turn>\nc", "<" * 9 + "turn", "\\"]


def test_texts_come_back(spark):
    rows = [(i, f'{{"messages": [{{"role": "r<turn>", "content": {a}}}, {{"role": "assistant", "content": {b}}}]}}')
            for i, (a, b) in enumerate((__import__("json").dumps(x), __import__("json").dumps(y)) for x in TEXTS for y in TEXTS)]
    done = chat.format_records(spark.createDataFrame(rows, "n int, record string"))
    for r in done.select("turns", chat.read_turns(F.col("formatted")).alias("back"), chat.read_loss(F.col("formatted"), F.col("loss")).alias("under")).collect():
        assert r.back == r.turns
        assert r.under == [r.turns[1].text]


def test_layouts_by_fingerprint(spark):
    records = {
        '{"prompt": "p", "completion": "c"}': ("prompt", [("user", "p"), ("assistant", "c")]),
        '{"completion": "c", "prompt": null, "id": 3}': ("prompt", [("user", ""), ("assistant", "c")]),
        '{"instruction": "i", "input": "x", "output": "o"}': ("instruction_input", [("user", "i"), ("user", "x"), ("assistant", "o")]),
        '{"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}': ("exchange", [("user", "h"), ("assistant", "g")]),
        '{"other": 1}': (None, None), "not json": (None, None), "": (None, None),
    }
    rows = [(x,) for x in records] + [(None,)]
    for r in chat.canonical_turns(spark.createDataFrame(rows, "record string")).collect():
        name, turns = records.get(r.record, (None, None))
        assert (r.mapping, r.turns and [tuple(x) for x in r.turns]) == (name, turns)


def test_rows_by_turn(spark):
    rows = [(1, 1, "assistant", None, "e"), (1, 0, None, "q", "e"), (None, None, "user", "x", "e"), (2, 0, "user", "b", "e"), (2, 0, "user", "a", "e")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, record string")
    done = {r.conversation: [tuple(x) for x in r.turns] for r in chat.format_records(chat.records_of_turns(table)).collect()}
    assert done == {1: [("", "q"), ("assistant", "")], None: [("user", "x")], 2: [("user", "a"), ("user", "b")]}
    assert chat.format_records(chat.records_of_turns(table.limit(0))).count() == 0


# ---- quality

def test_measurements():
    assert dict(zip(quality.MEASURES, quality.measure_text("a b c d e a b c d e!\nx\nx\n \n# é"), strict=True)) == {
        "n_words": 14, "word_chars": 15, "n_symbols": 1, "n_dup_lines": 1, "n_lines": 4, "n_repeat_words": 0, "n_echo_words": 1,
        "n_exclaims": 1, "n_letters": 12, "n_upper": 0,
    }
    assert quality.measure_text("a b c d e a b c d e")[quality.MEASURES.index("n_repeat_words")] == 10
    assert quality.measure_text("a a a a a a")[quality.MEASURES.index("n_repeat_words")] == 6


def test_ledger_and_policies(spark, docs_of):
    ledger = quality.with_ledger(docs_of(EDGES))
    assert ledger.count() == len(EDGES)
    assert quality.with_ledger(docs_of(EDGES).limit(0)).count() == 0
    empty = ledger.where("text is null or text = ''").select("ledger.*").collect()
    assert all(r.n_words == 0 and r.failed & 1 for r in empty)
    kept = quality.apply_policy(ledger, "v1").count()
    rows = {r["rule"]: r for r in quality.ablations(ledger, "v1").collect()}
    assert set(rows) == set(quality.POLICIES["v1"])
    for name, r in rows.items():
        without = quality.bits_of([x for x in quality.POLICIES["v1"] if x != name])
        want = ledger.where(F.col("ledger.failed").bitwiseAND(F.lit(without).cast("long")) == 0).count()
        assert r.n_kept_without == want == kept + r.n_failed_alone


def test_clean_labelled_documents_stay(spark):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1").select("doc_id")
    good = QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("not base_failed")
    assert good.where("not kept").count() == 0
