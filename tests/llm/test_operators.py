"""Every operator against a plain version of it on small tables with awkward rows."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from driftline.llm import chat, counts, exact, html, lines, mixing, near, packing, pii, quality, tokens
from pyspark.sql import functions as F
from tests.conftest import SF_SMALL

VOCABULARY = tokens.default_path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SENTENCE = "the quick brown fox jumps over the lazy dog while seven other animals look on and say nothing at all "
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))

#: Null ids and texts, empty texts, ties, repeated rows, a very long text.
TEXTS = [
    (3, "alpha  beta\tgamma"), (1, "alpha beta gamma"), (2, "alpha beta\n\ngamma"), (4, None), (5, ""), (6, " \n\t"),
    (7, SENTENCE * 3), (8, SENTENCE * 3 + "end"), (9, SENTENCE + "but then it changed"), (9, SENTENCE + "but then it changed"),
    (None, "alpha beta gamma"), (None, "only here, without an id"), (10, LONG), (11, LONG + " tail"), (12, "é" * 20 + "\nÉ" * 3),
    (13, "One Shared Line Here\nown line of thirteen\n one shared line here \nÉCOLE du soir\n"),
    (14, "one shared line here\nÉCOLE du soir\nécole DU SOIR\nshort\nshort"), (15, "short\n\n\n"), (16, "x\x1cy z  w<|endoftext|>v"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"src{n % 3}" if n % 4 else None, n, "clash", True) for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(
        rows, "doc_id long, text string, source string, n_words long, component_id string, kept boolean").repartition(3)


def smallest(ids):
    return min((i for i in ids if i is not None), default=None)


def words(text):
    return WORD.findall(text or "")


def test_empty_tables(spark, docs):
    none = docs.where("false")
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    for made in (exact.exact_dedup(none), quality.quality_rules(none), lines.line_dedup(none),
                 near.near_duplicates(none), mixing.mix(none), packing.pack_documents(none, VOCABULARY),
                 counts.token_counts(none, VOCABULARY), pii.find_pii(none), chat.format_chat(turns),
                 html.extract_html(none.withColumnRenamed("text", "html"))):
        assert made.collect() == []


def test_exact_dedup(docs):
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    want = Counter((i, smallest(ids), len(ids), hashlib.sha256(t.encode()).hexdigest())
                   for t, ids in groups.items() for i in ids)
    found = exact.exact_dedup(docs).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == len(groups) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_of_one_large_group(spark):
    rows = spark.range(5000).selectExpr("id as doc_id", "if(id % 3 = 0, 'the  same', concat('own ', id)) as text")
    found = exact.exact_dedup(rows).collect()
    hot = [r for r in found if r.group_size > 1]
    assert len(hot) == 1667 == hot[0].group_size and {r.keep_id for r in hot} == {0}
    assert sum(r.kept for r in hot) == 1 and sum(r.kept for r in found) == 3334


def plain_quality(text):
    w = words(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    marked = set()
    for i in range(len(w) - 2):
        if windows[tuple(w[i:i + 3])] > 1:
            marked |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(marked),
            len(w) < 50 or 100 * len(marked) > 50 * len(w))


def test_quality_rules(docs):
    found = quality.quality_rules(docs).collect()
    want = Counter((i, *plain_quality(t)) for i, t in TEXTS)
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
                   for r in found) == want
    assert not any(r.kept and r.base_failed for r in found)


def test_repeats_against_all_pairs():
    random = np.random.RandomState(3)
    for size, kinds in ((0, 1), (1, 1), (40, 1), (60, 2), (80, 4), (120, 40)):
        w = [f"w{x}" for x in random.randint(0, kinds, size)]
        deep = [max((next((k for k in range(size) if max(i, j) + k >= size or w[i + k] != w[j + k]), size)
                     for j in range(size) if j != i), default=0) for i in range(size)]
        ids = np.array([int(x[1:]) for x in w], dtype=np.int64)
        assert quality.repeat_depths(ids, np.full(size, size)).tolist() == deep
        cover = {i + k for i, d in enumerate(deep) if d >= 8 for k in range(d)}
        got = quality.measure([" ".join(w)])
        assert got[5][0] == len(cover) and got[6][0] == max(deep, default=0)


def test_repeats_by_scan(monkeypatch):
    random = np.random.RandomState(4)
    sizes = [0, 1, 300, 50, 2, 400]
    ids = np.concatenate([d * 100 + random.randint(0, 1 + 3 * d, n) for d, n in enumerate(sizes)])
    ends = np.repeat(np.cumsum(sizes), sizes)
    want = quality.repeat_depths(ids, ends)
    for limit in (0, 2000):
        monkeypatch.setattr(quality, "LEVEL_RANKS", limit)
        assert quality.repeat_depths(ids, ends).tolist() == want.tolist()


def test_quality_keeps_clean_texts_and_rejects_repeats():
    random = np.random.RandomState(5)
    clean = " ".join(f"w{x}" for x in random.randint(0, 300, 400))
    passage = " ".join(f"p{x}" for x in range(90))
    n, covered, longest = (quality.measure([clean, clean + " " + passage + " mid " + passage])[k] for k in (0, 5, 6))
    assert covered[0] <= quality.MAX_COVERED * n[0] and longest[1] == 90 and covered[1] == 180


def lowered(line):
    return line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})


def test_line_dedup(docs):
    holder = defaultdict(set)
    for i, t in TEXTS:
        for line in (t or "").split("\n"):
            if len(lowered(line)) >= 10:
                holder[lowered(line)].add(i)
    want = Counter()
    for i, t in TEXTS:
        own = (t or "").split("\n")
        kept = [x for x in own if len(lowered(x)) < 10 or smallest(holder[lowered(x)]) == i]
        want[i, "\n".join(kept), len(own), len(own) - len(kept)] += 1
    found = lines.line_dedup(docs).collect()
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in found) == want
    assert "n_words" in found[0] and found[0].component_id == "clash"


def test_line_dedup_of_long_texts(spark):
    """A text of many lines, all but every seventh of which an earlier one holds (more than are sought one by one)."""
    shared = [f"a line that two documents hold, number {i}" for i in range(30_000)]
    own = ["mine alone, " + x if i % 7 == 0 else x for i, x in enumerate(shared)]
    few = [*shared[:5], "", "short", "one line of its own"]
    docs = spark.createDataFrame([(1, "\n".join(shared)), (2, "\n".join(own)), (3, "\n".join(few))],
                                 "doc_id long, text string")
    found = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in lines.line_dedup(docs).collect()}
    kept = own[::7]
    assert found == {1: ("\n".join(shared), 30_000, 0), 2: ("\n".join(kept), 30_000, 30_000 - len(kept)),
                     3: ("\n".join(few[5:]), 8, 5)}


def test_line_dedup_without_ids(spark):
    """Rows without an id are one holder, the last one; each is cut by its own lines, copies among them alike."""
    texts = [(None, f"shared line of all\nline of row {i % 40}, alone\nheld by document {i % 3}") for i in range(300)]
    texts += [(1, "shared line of all\nheld by document 0"), (1, "shared line of all\nheld by document 1"), (2, None)]
    found = lines.line_dedup(spark.createDataFrame(texts, "doc_id long, text string")).collect()
    want = Counter()
    for i, t in texts:
        rows = (t or "").split("\n")
        gone = {"shared line of all", "held by document 0", "held by document 1"} if i is None else set()
        want[i, "\n".join(x for x in rows if x not in gone), len(rows)] += 1
    assert Counter((r.doc_id, r.text, r.n_lines) for r in found) == want


def test_line_runs_merge_levels(spark):
    runs = lines.Runs(spark, fanout=2)
    for k in range(5):
        batch = spark.range(10 * k, 10 * k + 15).selectExpr("md5(cast(id as string)) as h")
        new = spark.createDataFrame(runs.unseen(batch).collect(), "h string")
        assert new.count() == (15 if k == 0 else 10)
        runs.add(new)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    runs.drop()


def shingles(text):
    w = tuple((text or "").translate({c: c + 32 for c in range(65, 91)}).split())
    return frozenset(w[i:i + 5] for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([w] if w else [])


def plain_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                label[root(a)] = root(b)
    least = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        least[root(n)].append(i)
    return Counter((i, len(sets[n]), smallest(least[root(n)])) for n, (i, _) in enumerate(rows))


def test_near_duplicates(docs):
    rows = [(i, t) for i, t in TEXTS if t is None or "\x1c" not in t]
    found = near.near_duplicates(docs.where("doc_id IS NULL OR doc_id <> 16")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == plain_components(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_near_duplicates_of_a_crowded_region(spark):
    """Copies of one text with few to many changes: chains, isolated ones, several components."""
    random = np.random.RandomState(11)
    base = [f"w{x}" for x in random.randint(0, 5000, 120)]
    rows = []
    for i in range(260):
        own = list(base)
        for at in random.randint(0, 120, i % 13):
            own[at] = f"new{i}x{at}"
        rows.append((i, " ".join(own)))
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == plain_components(rows)


@pytest.mark.parametrize("unlike", [8, 13])
def test_near_duplicates_of_many_open_classes(spark, monkeypatch, unlike):
    """More open classes than a block holds: the join on rare shingles finds the same components."""
    monkeypatch.setattr(near, "BLOCK", 8)
    used = []
    whole = near.prefix_links
    monkeypatch.setattr(near, "prefix_links", lambda *a: used.append(1) or whole(*a))
    random = np.random.RandomState(unlike)
    base = [f"w{x}" for x in random.randint(0, 5000, 150)]
    rows = []
    for i in range(300):  # from near copies to documents of one template that aren't linked
        own = list(base)
        for at in random.randint(0, 150, i % unlike):
            own[at] = f"new{i % 200}x{at}"
        rows.append((i, " ".join(own[:150 - i % 7])))
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert used and Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == plain_components(rows)


def test_prefix_links_against_all_pairs(spark):
    random = np.random.RandomState(5)
    sets = [np.unique(random.choice(60, random.randint(1, 50)).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            for _ in range(120)]
    sets += [np.r_[s[:-1]] for s in sets[:40] if len(s) > 1]
    rows = [(i, i % 100, i % 3 > 0, bytearray(s.tobytes())) for i, s in enumerate(sets)]
    found = near.prefix_links(spark.createDataFrame(
        rows, "node long, component long, open boolean, members binary"), 0.75).collect()
    want = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))
            if i % 100 != j % 100 and (i % 3 > 0 or j % 3 > 0)
            and 100 * len(set(sets[i]) & set(sets[j])) >= 75 * len(set(sets[i]) | set(sets[j]))}
    assert want and len(found) == len(want) and {(r.a, r.b) for r in found} == want


def test_links_of_low_agreement(spark):
    # similarity 12 / 16 each, but only 74 and 69 of 128 signature values agree
    rows = []
    for i, seed in enumerate((11334, 21770)):
        own = [f"w{seed}x{j}" for j in range(20)]
        rows += [(2 * i, " ".join(own[:16])), (2 * i + 1, " ".join(own))]
    found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in found} == {0: 0, 1: 0, 2: 2, 3: 2}


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a = "</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
<div class="ad">Buy this now</div><div class="cookie-notice"><p>We use cookies, really a lot of them.</p></div>
<div id=story><article><h1>The  title &amp; more</h1><p>First <b>bold</b>
 paragraph &lt;here&gt; with some words.<p>Second one<br>goes on &#233; and on.</article></div>
<aside><p>Related things to read on this site.</p></aside><form><p>Your name</p><input></form>
<section id="comments"><p>Great article, thank you so much!</p><p>I do not agree with it at all.</p></section>
<footer>&copy; Site</footer></body></html>"""


def test_html(spark):
    want = "The title & more\nFirst bold paragraph <here> with some words.\nSecond one goes on é and on."
    pages = [(1, "u", PAGE), (2, "u", None), (3, "u", ""), (4, None, "no markup at all"), (5, "u", PAGE[:-300]),
             (1, "u", PAGE), (6, "u", "<div>" * 3000 + "deep" + "</div>" * 3000), (7, "u", "<p>" + "long text " * 50_000)]
    found = {r.page_id: r for r in html.extract_html(spark.createDataFrame(
        [(*p, "old") for p in pages], "page_id long, url string, html string, text string")).collect()}
    assert found[1].text == want and found[5].text.startswith("The title & more\nFirst bold")
    assert found[2].text == found[3].text == "" and found[4].text == "no markup at all" and found[6].text == "deep"
    assert found[7].text == ("long text " * 50_000).strip() and all(r.n_chars == len(r.text) for r in found.values())


def test_html_parts_of_one_text():
    part = "".join(f"<p>{SENTENCE}{i}</p>" for i in range(4))
    page = f"<body><div id=c><div>{part}</div><div class='ad-box'>Buy</div><div>{part}</div></div><div>short</div></body>"
    assert html.main_text(page).count("lazy") == 8 and "Buy" not in html.main_text(page)


def marked(n: int, mark: str) -> str:
    return f"{mark} " + "x" * (n - len(mark))


def test_html_short_pieces_stay():
    def sections(n: int, mark: str) -> str:
        return "<section>" + "".join(f"<p>{marked(500, f'{mark}{i}')}</p>" for i in range(n)) + "</section>"

    links = "<div>" + "".join(f"<a href=/{i}>Link number {i}</a> " for i in range(4)) + "</div>"
    story = f"<h1>{marked(30, 'head')}</h1><p>{marked(200, 'lead')}</p>{sections(10, 'long')}{sections(2, 'short')}"
    want = ["head", "lead", *(f"long{i}" for i in range(10)), "short0", "short1"]
    for page in (f"<body>{links}<article>{story}</article></body>", f"<body>{links}<div>{story}</div></body>",
                 f"<body>{links}<main><h1>{marked(30, 'top')}</h1><article>{story}</article></main></body>",
                 f"<body><article>{story}</article>{links}<article><p>{marked(40, 'next')}</p></article></body>"):
        found = [x.split()[0] for x in html.main_text(page).split("\n")]
        assert [x for x in found if x not in ("top", "next")] == want
        assert ("top" in found) == (">top" in page) and ("next" in found) == (">next" in page)


@pytest.mark.parametrize("wrapper", [
    "div class='content-sidebar-wrap'", "div class='page has-sidebar'", "form id='aspnetForm'", "div id=overflow-hidden"])
def test_html_named_wrappers_stay(wrapper):
    def page(before: str, text: str, after: str = "") -> str:
        return f"<body>{before}<{wrapper}>{text}</{wrapper.split()[0]}>{after}</body>"

    paragraphs = "".join(f"<p>{marked(300, f'text{i}')}</p>" for i in range(5))
    junk = f"<div class='ad-box'>{marked(20, 'buy')}</div><form class=search><p>{marked(20, 'find')}</p></form>"
    comments = f"<div id=comments><article>{marked(90, 'comment')}</article></div>"
    for text in (f"<article>{paragraphs}</article>", f"<main>{paragraphs}</main>", f"<div>{paragraphs}</div>"):
        for whole in (page(junk, junk + text), page("<p>Some words</p>", text, junk),
                      f"<body><main><h1>Title</h1>{page('', text + junk)[6:-7]}</main></body>"):
            found = html.main_text(whole)
            assert [x.split()[0] for x in found.split("\n") if x.startswith("text")] == [f"text{i}" for i in range(5)]
            assert "buy" not in found and "find" not in found
    assert "comment" not in html.main_text(f"<body><article>{paragraphs}</article>{comments}{junk}</body>")
    assert "text4" not in html.main_text(page("", "<p>text4</p>", f"<article><p>{marked(300, 'other')}</p></article>"))
    assert html.main_text(f"<body hidden><div hidden><article>{paragraphs}</article></div></body>") == ""


def test_html_names_only_raise_doubt():
    text = "x " * 200
    article = "".join(f"<{tag} {name}>{mark} {text}</{tag}>" for tag, name, mark in (
        ("p", "class=notice-board-history", "A1"), ("p", "class='search-algorithms'", "A2"), ("p", "id=ad-hoc", "A3"),
        ("section", 'class="related-work"', "A4")))
    junk = "".join(f"<div {name}>{mark} more</div>" for name, mark in (
        ("class=adContainer", "J1"), ("class=adsbygoogle", "J2"), ("class=cookieBanner", "J3"), ("id=commentList", "J4"),
        ("class=gdpr", "J5"), ("class='ad-box'", "J6")))
    links = "".join(f"<a href=/{i}>{text}</a>" for i in range(3))
    found = html.main_text(f"<body><article><h1>Head</h1>{article}{junk}<div class=search-links>J7{links}</div></article></body>")
    assert [x.split()[0] for x in found.split("\n")] == ["Head", "A1", "A2", "A3", "A4"]
    assert html.main_text(f"<main><h1>T</h1><p>{text}</p><article class=comment><p>C1</p></article></main>") == f"T\n{text.strip()}"
    page = f"<div><a href=/>home</a> <a href=/x>x</a></div><div><p>{text}</p><p>{text}</p></div><div class=foot>F1</div>"
    assert html.main_text(f"<body>{page}</body>") == f"{text.strip()}\n{text.strip()}"


@pytest.mark.parametrize("page, want", [
    ("<p data-x=don't>long text it's</p>", "long text it's"), ('<p title=5">five</p>', "five"),
    ('<p title="a>b" class=\'q>r\'>quoted</p>', "quoted"), ("<p a=b/c =x / y = 'z>'>slash</p>", "slash"),
    ('<p title="open>text</p><p>more</p>', "text\nmore"), ("<p hidden>no</p><p>short</p>", "short")])
def test_html_attributes(page, want):
    assert html.main_text(page) == want


def test_densities_against_plain_recursion(spark):
    """Density and density sum of every element of every page, by the formulas."""

    def numbers(node):
        below = [numbers(x) for x in node.parts if isinstance(x, html.Node) and not x.drop]
        chars = sum(len("".join(x.split())) for x in node.parts if isinstance(x, str)) + sum(b[0] for b in below)
        tags = sum(1 + b[1] for b in below)
        links = (chars, tags + 1) if node.tag == "a" else (sum(b[2] for b in below), sum(b[3] for b in below))
        return chars, tags, *links

    def density(node, share):
        chars, tags, link_chars, link_tags = numbers(node)
        if not chars:
            return 0.0
        base = math.log(chars / max(1, chars - link_chars) * link_chars + share * chars + math.e)
        ratio = max(chars / max(1, link_chars) * max(1, tags) / max(1, link_tags), 1.0 + 1e-9)
        return chars / max(1, tags) * math.log(ratio) / base

    seen = 0
    for row in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("html").collect() + [(PAGE,)]:
        root = html.parse(row[0] or "")
        body = next((x for x in root.parts if isinstance(x, html.Node) and x.tag == "body"), root)
        body.parent = None
        nodes = html.judge(html.ordered(body))
        html.densities(nodes)
        chars, _, link_chars, _ = numbers(body)
        share = link_chars / chars if chars else 0.0
        for node in nodes:
            below = [x for x in node.parts if isinstance(x, html.Node) and not x.drop]
            assert node.density == pytest.approx(density(node, share))
            assert node.total == pytest.approx(sum(density(x, share) for x in below))
            seen += 1
    assert seen > 500


def test_near_duplicates_without_ids(spark):
    """Rows whose ids are null or all alike are as quick and as right as others."""
    random = np.random.RandomState(13)
    texts = []
    for i in range(150):
        base = [f"w{x}" for x in random.randint(0, 900, 40)]
        texts += [" ".join(base), " ".join([*base, f"end{i}"])] if i % 3 else [" ".join(base)] * 3
    for same in (None, 5):
        rows = [(same, t) for t in texts]
        found = near.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == plain_components(rows)


def test_mixing(docs):
    found = mixing.mix(docs).collect()
    size = Counter()
    for r in found:
        assert r.taken <= 2 * r["size"]
    for n, (i, t) in enumerate(TEXTS):
        size[f"src{n % 3}" if n % 4 else None] += len(words(t))
    names = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(size.values()), {}, set(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 2 * size[s]}
        for s in over or open_:
            target[s] = 2.0 * size[s] if over else unit * weight[s]
            left -= target[s] if over else 0
        open_ = open_ - over if over else set()
    assert Counter(r["size"] for r in found) == Counter(len(words(t)) for _, t in TEXTS)
    assert {(r.source_size, round(r.target, 6)) for r in found} == {(size[s], round(target[s], 6)) for s in names}
    taken = Counter()
    for r in found:
        taken[r.source_size] += r.taken
    for s in names:
        assert abs(taken[size[s]] - sum(target[x] for x in names if size[x] == size[s])) <= len(names)
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter(map(tuple, found)) == Counter(map(tuple, again))


def test_mixed_rows(docs):
    carried = mixing.mix(docs, carry=("text", "n_words"))
    total = carried.agg(F.sum("taken")).first()[0]
    rows = mixing.repeated(carried).collect()
    assert sum(len(words(r.text)) for r in rows) == total and all(words(r.text) for r in rows)


def tokenized(text):
    return tokens.library(VOCABULARY).encode(text or "", add_special_tokens=False).ids


def test_packing(docs):
    found = packing.pack_documents(docs, VOCABULARY).collect()
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id].append(r)
    for s in sequences.values():
        end = 0
        for offset, length in sorted(s):
            assert offset == end
            end += length
        assert end <= 1024 and end & (end - 1) == 0
    wanted = defaultdict(Counter)
    for i, t in TEXTS:
        wanted[i][len(tokenized(t)) + 1] += 1
    for i, t in TEXTS:
        if i is not None and sum(wanted[i].values()) == 1:
            ids = np.array([*tokenized(t), 0], dtype="<u4")
            end = 0
            for r in sorted(pieces[i], key=lambda r: r.start):
                assert r.start == end and r.doc_tokens == len(ids)
                end += r.length
                assert r.ids_crc32 == zlib.crc32(ids[r.start:end].tobytes())
            assert end == len(ids)
    assert sum(r.length for r in found) == sum(len(tokenized(t)) + 1 for _, t in TEXTS)


def test_steps_are_balanced():
    load = Counter()
    lengths = [1024] * 100 + [512] * 33 + [256, 4, 1]
    for n, g in zip(lengths, packing.steps(lengths, 8192)):
        load[g] += n
    assert max(load.values()) - min(load.values()) <= 1024


def test_token_counts(docs):
    found = counts.token_counts(docs, VOCABULARY, limit=30).collect()
    assert Counter(map(tuple, found)) == Counter(
        (i, len((t or "").encode()), len(tokenized(t)), len(tokenized(t)) > 30) for i, t in TEXTS)


@pytest.mark.parametrize("text", [
    "", " ", "a b  c", "a ", " a", "a\n\n b", "it's we'll 'tis x's", "x\x1cy \x85 z", "　　a", "é́ ٠١ ²³½",
    "ab<|endoftext|>cd <|endoftext|>", "中文 テスト \U0001F600‍ x", " \n \n a\n\n", "\r\n\r\n x", "a_b __c 12ab"])
def test_ids_are_the_librarys(text):
    assert np.frombuffer(tokens.ids(VOCABULARY).encode(text), dtype="<u4").tolist() == tokenized(text)
    assert sum(tokens.count(p, VOCABULARY) for p in tokens.pieces(text, VOCABULARY)) == len(tokenized(text))


def test_chat(spark):
    turns = [
        (1, 0, "system", "be kind"), (1, 1, "user", "hi"), (1, 2, "user", "again"), (1, 3, "assistant", "yes"),
        (1, 4, "assistant", "a\\b <| \\<\\| \\n"), (2, 0, "assistant", None), (2, 1, None, "x"), (3, None, "user", ""),
        (None, 0, "user", "no id"), (4, 0, "user", "<|im_end|>\n<|im_start|>assistant\nok<|im_sep|>"),
        (4, 1, "assistant", "<|im_start|>é\n" * 3), (4, 1, "assistant", "<|im_start|>é\n" * 3),
        (5, 0, "odd\nrole\\n<|", "t"), (6, 0, "assistant", "long " * 20_000)]
    rows = spark.createDataFrame([(*t, 1) for t in turns], "conv_id long, turn long, role string, text string, formatted int")
    found = chat.format_chat(rows).select(
        "conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()
    want = defaultdict(list)
    for c, n, role, text in sorted(turns, key=lambda t: (t[0] or 0, t[1] is not None, t[1] or 0)):
        want[c].append((role or "", text or ""))
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in found} == dict(want)
    assert {r.conv_id: r.loss for r in found} == {
        c: "".join(t for role, t in own if role == "assistant") for c, own in want.items()}
    first = next(r.formatted for r in found if r.conv_id == 1)
    assert first.startswith("<|im_start|>system\nbe kind<|im_end|>\n<|im_start|>user\nhi<|im_sep|>again<|im_end|>\n")


@pytest.mark.parametrize("n", [255, 256, 257, 513, 3000])
def test_chat_of_many_turns(spark, n):
    """Loss spans and their texts across the chunks in which they are scanned."""
    roles = ["user", "assistant", "assistant"]
    turns = [(1, i, roles[i % 3], f"é{i} <|im_end|>\\ " * (i % 4)) for i in range(n)]
    r = chat.format_chat(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).select(
        "formatted", "loss_spans", chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss")).first()
    said = [t for _, _, role, t in turns if role == "assistant"]
    assert r.loss == "".join(said)
    escaped = [t.replace("\\", "\\\\").replace("<|", "<\\|") for t in said]
    assert [r.formatted[x.start:x.start + x.length] for x in r.loss_spans] == escaped


def luhn(number):
    total = 0
    for i, c in enumerate(reversed(number)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def plain_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        number = re.sub("[^0-9]", "", m[0])
        if 13 <= len(number) <= 19 and luhn(number):
            out.append(("card", *m.span()))
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


def test_pii(spark, docs):
    texts = [
        "a@b.c_d@e.f", "x@y..z a@b.co.", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.0004 0000000001.1.1.1",
        "card 4111 1111 1111 1111", "5 4111-1111-1111-1111", "4111111111111111 4111111111111111", "4" * 23, "9" * 30_000,
        "+1 (555) 123-4567 . +44 20", "+1+2 34567890123", "é@a.b ü+1 555 555 5555x", None, "", "mail me at jo.do@mail.com",
        "call (212) 555-0199 now", "a." * 9000 + "@b.c", "a@" + "b." * 9000 + "c", "3.8 and 12 of 40", "\U0001F600 1.2.3.4"] * 2
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(
        docs.select("doc_id", "text").where("doc_id IS NULL"))
    for r in pii.find_pii(rows).collect():
        text = None if r.doc_id is None else texts[r.doc_id]
        base = [(s.kind, s.start, s.end) for s in r.base]
        spans = [(s.kind, s.start, s.end) for s in r.spans]
        assert base == plain_pii(text or "")
        assert set(base) <= set(spans) and spans == sorted(spans, key=lambda s: (pii.KINDS.index(s[0]), s[1]))
        assert text != "3.8 and 12 of 40" or not spans


def test_pii_of_many_matches(spark):
    """Matches over many chunks and blocks of one text, with characters of all widths between them."""
    text = "".join(f"x{i}@mail{i}.com é\U0001F600 (212) 555-{i:04d} a.b{i}[at]c.org {i % 300}.1.1.1\n" for i in range(600))
    (r,) = pii.find_pii(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert [(s.kind, s.start, s.end) for s in r.base] == plain_pii(text)
    assert {text[s.start:s.end] for s in r.spans} >= {f"x{i}@mail{i}.com" for i in range(600)}


def test_pii_places_in_blocks(spark):
    text = "".join(chr(0x61 + i % 26) + "\U0001F600\n"[i % 3:i % 3 + 1] for i in range(3000))
    places = [(at, n) for at in (0, 1, 1023, 1024, 2047, 4000, len(text) - 1, len(text)) for n in (0, 1, 40)]
    rows = spark.createDataFrame([(text, at, n) for at, n in places], "text string, at int, n int")
    found = rows.select("at", "n", pii.part(pii.in_blocks(F.col("text")), F.col("at"), F.col("n")).alias("got")).collect()
    assert all(r.got == text[r.at:r.at + r.n] for r in found)
