"""Secrets, personal data and page text against brute force."""

import hashlib
import html
import math
import random
import re

import pyarrow as pa
import pytest

from meterflow.llm import html_blocks, pii_bootstrap, secrets_entropy
from meterflow.llm.common import bytes_of, table

SMALL = "/root/testdata/sf0.01"


def secrets_by_regex(text):
    found = []
    either = lambda word: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)
    names = "|".join([*map(either, ("password", "passwd", "secret", "token")), either("api") + "_?" + either("key")])
    for m in re.finditer(rf"""(?:{names})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[1]) >= 12:
            found.append((m.start(), "assign", m.end()))
    for kind, pattern, least in (("access", "AKIA[A-Z0-9]+", 18), ("hex", "[0-9a-f]+", 16)):
        found += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text) if len(m[0]) >= least]
    return sorted(found, key=lambda x: (x[0], secrets_entropy.KINDS.index(x[1])))


def personal_by_regex(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(digits[::-1])) % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def garbled(alphabet, n, seed=1, parts=("",)):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) if rng.random() < 0.9 else rng.choice(parts) for _ in range(rng.randint(0, 70))) for _ in range(n)]


def test_secret_base_equals_regex():
    texts = garbled("aé f0:= \"'9_-", 20_000, parts=("token", "PassWord", "api_key", "APIKEY", "AKIA", "AKIAQ" * 5, "0123456789abcdef", "ſecret", "toKen"))
    found = secrets_entropy.scan(*bytes_of(pa.array(texts)))
    for k, text in enumerate(texts):
        got = [(s, secrets_entropy.KINDS[kind], e) for s, kind, e in found.get(k, []) if kind < 3]
        assert got == secrets_by_regex(text), repr(text)


def test_window_entropy_is_what_counting_says():
    rng = random.Random(4)
    for text in (bytes(rng.choice(b"abcdef019") for _ in range(n)) for n in (3, 16, 17, 90)):
        for i, bits in enumerate(secrets_entropy.window_entropies(text, 16)):
            part = text[i:i + 16]
            assert bits == pytest.approx(-sum(part.count(c) / 16 * math.log2(part.count(c) / 16) for c in set(part)))
        assert len(secrets_entropy.window_entropies(text, 16)) == max(0, len(text) - 15)


@pytest.mark.parametrize("text, caught", [
    ("key Zx8Kq2Lm9Pw4Rt7Yb3Nc end", True), ("aws wJalrXUtnFEMI/K7MDENG/bPxRfiCYzQ9T8 x", True), ("F3A91C0B77D2E46A58BB", True),
    ("internationalisationsbestrebungen", False), ("2024-01-15T10-20-30-40-50", False), ("a_very-long_name-of_a-thing2", False),
    ("01234567890123456789012345", False), ("exampleZx8Kq2Lm9Pw4Rt7Yb3Nc", False), ("aaaaaaaaaaaaaaaaaaaa1111111111", False),
    ("123e4567-E89b-12d3-a456-426614174000", False)])
def test_entropy_and_the_allow_list(text, caught):
    found = secrets_entropy.scan(*bytes_of(pa.array([text])))
    assert any(kind == 3 for _, kind, _ in found.get(0, [])) == caught


@pytest.mark.parametrize("text, caught", [
    ("id q7-Zk2_Lm9Pw4Rt7Yb3NcX end", True), ("at sample/keys/Zx8Kq2Lm9Pw4Rt7Yb3Nc", True), ("20480153F3A91C0B77D2E46A", True),
    ("20240115F3A91C0B77D2E46A", True), ("keys/example/F3A91C0B77D2E46A58BB", True), ("2024-01-15-Some-Longer-Post-Title-2", False),
    ("2024-01-15T10-20-30-40Z", False), ("keys/exampleZx8Kq2Lm9Pw4Rt7Yb3Nc", False)])
def test_short_keys_and_keys_beside_allowed_parts(text, caught):
    """Runs of 20 to 23 with separators had no window; one allowed part let the whole run go."""
    found = secrets_entropy.scan(*bytes_of(pa.array([text])))
    assert any(kind == 3 for _, kind, _ in found.get(0, [])) == caught


def test_secrets_of_whole_tables_and_odd_rows(spark):
    rows = [(1, None, None), (2, "", 0), (3, "é token=" + "q9" * 8 + " é", 25), (3, "é token=" + "q9" * 8 + " é", None), (None, "x" * 200_000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "'s' as spans")
    got = secrets_entropy.find(docs).collect()
    assert [(r.doc_id, r.n_assign, r.spans) for r in got] == [(1, 0, ""), (2, 0, ""), (3, 1, "assign:2:24"), (3, 1, "assign:2:24"), (None, 0, "")]
    assert got[2].base_sha256 == hashlib.sha256(b"assign:2:24").hexdigest()
    clean = secrets_entropy.redact(docs)
    assert clean.columns == docs.columns
    assert [(r.text, r.n_chars) for r in clean.collect()][1:4] == [("", 0), ("é [secret] é", 12), ("é [secret] é", None)]
    assert secrets_entropy.find(docs.limit(0)).count() == 0
    whole = table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in whole.select("doc_id", "text").collect()}
    for r in secrets_entropy.find(whole).collect():
        base = ",".join(f"{kind}:{s}:{e}" for s, kind, e in secrets_by_regex(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
    again = secrets_entropy.find(secrets_entropy.redact(whole)).where("n_assign + n_access + n_hex > 0")
    assert again.count() == 0


def test_personal_base_equals_regex():
    texts = garbled("aA.0 @-+1(25)%\n_9é", 30_000, parts=("4111 1111 1111 1111", "+1 (555) 123-4567", "10.0.0.1", "a@b.co"))
    for text in texts:
        at = [0]
        for c in text:
            at.append(at[-1] + len(c.encode()))
        assert pii_bootstrap.base(text.encode()) == [(at[s], k, at[e]) for s, k, e in personal_by_regex(text)], repr(text)


def test_personal_of_whole_tables(spark):
    whole = table(spark, SMALL, "documents")
    texts = {r.doc_id: r.text for r in whole.select("doc_id", "text").collect()}
    for r in pii_bootstrap.find(whole).collect():
        base = personal_by_regex(texts[r.doc_id])
        told = ",".join(f"{pii_bootstrap.KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert r.base_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[1] == k for x in base) for k in range(4))
        assert set(filter(None, told.split(","))) <= set(r.spans.split(","))


def test_contexts_teach_unseen_identifiers(spark):
    seeds = [(i, f"Please call hotline: +1 555 123 00{i:02d} today, the plan is good and the day is long", 0) for i in range(12)]
    hidden = [(100, "Please call hotline: 0049-221-77801 now", 0), (101, "the 0049-221-99999 is the number of the part and the price", 0)]
    odd = [(200, None, 0), (201, "", 0), (100, "Please call hotline: 0049-221-77801 now", 0)]
    docs = spark.createDataFrame(seeds + hidden + odd, "doc_id long, text string, k int")
    rows = pii_bootstrap.find(docs).collect()
    assert len(rows) == len(seeds) + 5
    by_id = {r.doc_id: r for r in rows}
    assert by_id[100].spans == "context_phone:21:35" and by_id[101].spans == "" and by_id[200].spans == ""
    assert [r.spans for r in rows if r.doc_id == 100] == ["context_phone:21:35"] * 2
    assert all(by_id[i].n_phone == 1 and by_id[i].spans.startswith("phone:21:") for i in range(12))
    assert pii_bootstrap.find(docs.limit(0)).count() == 0


def test_pages_of_the_table(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    for r, p in zip(html_blocks.extract(pages).collect(), pages.collect(), strict=True):
        inner = p.html[p.html.index("<article>") + 9:].split("</article>")[0].split("<footer")[0]
        blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?p>|</?h1>", inner)]
        assert r.text == "\n\n".join(b for b in blocks if b) and r.n_chars == len(r.text)


def test_pages_of_other_shapes():
    tree = html_blocks.grow(html_blocks.LABELLED)
    share = sum((html_blocks.chance(tree, r[:-1]) >= 0.5) == r[-1] for r in html_blocks.LABELLED) / len(html_blocks.LABELLED)
    assert share == 1.0
    story = "This is a paragraph of the story with more than twenty words in it, so that every reader of it takes it for text &amp; nothing else."
    page = f"""<html><head><title>t</title><script>if (a < b) x = "</p>";</script></head><body><div id=top-menu><a href=/>Home</a>
    <a href=/n>News of the day and of the week</a></div><div class="cookie-notice">We use cookies on this site to make it better for
    you and for all of us, please accept them all now.</div><h2>A title</h2><p>{story}<p>{story}<br>{story}<div class="sidebar">{story}</div>
    <section id=comments><p>{story}</section><form>{story}<input></form><footer>{story}</footer></body>"""
    text = html.unescape(story)
    assert html_blocks.main_text(page, tree) == f"A title\n\n{text}\n\n{text} {text}"
    nested = "<main><header><h1>Title</h1></header><p>One&nbsp;word.</p><aside>No</aside><ul><li>first</li><li>second <b>item</b></li></ul></main>"
    assert html_blocks.main_text(nested, tree) == "Title\n\nOne word.\n\nfirst\n\nsecond item"
    for odd in (None, "", "<", "<article", "<!-- x", "<script>x", "&am", "<a href='x>y</a>", "</article></p>"):
        assert isinstance(html_blocks.main_text(odd, tree), str)
    assert html_blocks.main_text("<article>cut <b>off &am", tree) == "cut off &am"


@pytest.mark.parametrize("wrapper, inner, stays", [
    ('<div class="content with-sidebar">', "<article>", True), ('<div class="page has-comments">', "<article>", True),
    ('<div class="elementor-widget elementor-widget-theme-post-content">', "<div>", True), ('<div class="left-sidebar">', "<main>", True),
    ('<div class="page sidebar">', "<article>", True), ('<div class="search-page">', '<div class="entry-content">', True),
    ('<div class="sidebar">', "<div>", False), ('<div class="comments">', "<article>", False), ("<nav>", "<main>", False),
    ('<div class="related">', '<article class="post">', False), ('<div class="no-touch ads">', "<div>", False)])
def test_layout_names_of_a_wrapper_do_not_drop_the_article(wrapper, inner, stays):
    tree = html_blocks.grow(html_blocks.LABELLED)
    story = "This is a paragraph of the story with more than twenty words in it, so that every reader of it takes it for text and nothing else."
    found = html_blocks.main_text(f"<body>{wrapper}{inner}<p>{story}</p><p>{story}</p>", tree)
    assert found == (f"{story}\n\n{story}" if stays else "")


def test_odd_pages(spark):
    rows = [(1, "u", None, 1), (1, "u", None, 1), (2, None, "", 1), (None, "u", "<article><p>" + "word " * 50_000, 1)]
    got = html_blocks.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert [(r.page_id, r.url, r.n_chars) for r in got] == [(1, "u", 0), (1, "u", 0), (2, None, 0), (None, "u", 249_999)]
    assert html_blocks.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0
