"""Page text, archive and page language: hand cases, brute force, round trip."""

import hashlib
import random
import re

import numpy as np
import pytest

from sorigil.llm import host_suffix_array as hsa
from sorigil.llm import html_blocks, language_fusion, warc_store
from sorigil.llm.common import work_folder

SMALL = "/root/testdata/sf0.001"
PAGES = "page_id long, url string, html string, text string, host string, digest string, id int"


def text_of(page):
    found = html_blocks.blocks(page)
    kind = min((k for k, _ in found), default=3)
    return "\n".join(t for k, t in found if k == kind != 3)


@pytest.mark.parametrize(
    "page, want",
    [
        (None, ""),
        ("", ""),
        ("plain  words\n here", "plain words here"),
        ("<article><h1>A&amp;b&lt;</h1><p>one <b>two</b>\n three<br>four<p>five</article>", "A&b<\none two three four\nfive"),
        ("<nav>menu</nav><article><p>x</p><div class='comments'><p>c</p></div><p>y</p></article><footer>f</footer>", "x\ny"),
        ("<header><h1>site</h1></header><main><header><h1>T</h1></header><p>a<script>if (a</b) '</p>'</script>b</p></main>", "T\nab"),
        ("<body><aside>s</aside><div id=cookie-banner>c<div>d</div>e</div><p>p</p><form>f<p>g</p></form></body>", "p"),
        ("<body><nav>never closed <p>m</p><article>a</article>", "a"),
        ("<p title='a > b'>x</p><p title=\"q>y</p><!-- c --><p>z", "x\ny\nz"),
        ("<ARTICLE><P>Upper</P><SCRIPT>x</SCRIPT></ARTICLE><p>out</p>", "Upper"),
        ("<body><form id=aspnetForm><input type=hidden name=__VIEWSTATE value=x><div id=menu>m</div><p>a</p><p>b</p></form></body>", "a\nb"),
        ("<form><main><p>a</p></main></form><form>search</form>", "a"),
        ("<div id=content class='with-sidebar wide'><p>a</p><div class=sidebar>s</div></div>", "a"),
        ("<article><section id=related-work><p>a</p></section><div id=comments-section>c</div><div class=related-posts>r</div></article>", "a"),
        ("<article><p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p></article>", "so x=2 holds"),
        ("1 < 2 &am &amp 3 &#233; &nosuch;", "1 < 2 &am & 3 é &nosuch;"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table></article>", "a\nb\nc\nd"),
        ("<section role=navigation>n</section><p>t</p><div class='ad'>x</div>", "t"),
    ],
)
def test_blocks(page, want):
    assert text_of(page) == want


def plain_repeated(pages, least):
    out = []
    seen = {}
    for p, ws in enumerate(pages):
        for k in range(len(ws) - least + 1):
            seen.setdefault(tuple(ws[k : k + least]), set()).add(p)
    for ws in pages:
        cover = [False] * len(ws)
        for k in range(len(ws) - least + 1):
            if len(seen[tuple(ws[k : k + least])]) > 1:
                cover[k : k + least] = [True] * least
        out += cover
    return out


@pytest.mark.parametrize("seed", range(5))
def test_repeated_substrings_match_brute_force(seed):
    rng = np.random.default_rng(seed)
    pages = [list(rng.integers(0, 3, rng.integers(0, 60))) for _ in range(8)]
    pages += [pages[0], [1] * 40, [1] * 5]
    words = np.array([w for p in pages for w in p], np.uint64) + np.uint64(10)
    number = np.repeat(np.arange(len(pages)), [len(p) for p in pages])
    assert hsa.repeated(words, number, 6).tolist() == plain_repeated(pages, 6)


def test_boilerplate_of_a_host_goes_and_unique_runs_stay(spark):
    boiler = "<div>" + " ".join(f"b{k}" for k in range(15)) + "</div>"
    rows = [(k, f"https://a.example/{k}", f"<body>{boiler}<p>own words of page {k} " + " ".join(f"u{k}_{j}" for j in range(20)) + "</p></body>") for k in range(6)]
    rows += [(20, "https://b.example/", f"<body>{boiler}<p>x</p></body>"), (21, None, None), (22, "x", ""), (None, "https://a.example/n", f"<body>{boiler}<p>n</p></body>")]
    rows += [(30 + k, "https://c.example/", f"<article><p>{boiler}</p></article>") for k in range(2)]
    rows += [(40, "https://d.example/", f"<body>{boiler}</body>"), (41, "https://d.example/", f"<body>{boiler}</body>"), (0, "https://a.example/0", rows[0][2])]
    df = spark.createDataFrame([(*r, "t", "h", "d", 1) for r in rows], PAGES)
    got = [(r.page_id, r.text) for r in hsa.main_texts(df).collect()]
    assert len(got) == len(rows)
    text = dict(got)
    plain = " ".join(f"b{k}" for k in range(15))
    assert all(text[k].startswith(f"own words of page {k} ") and "b3" not in text[k] for k in range(6))
    assert text[20] == plain + "\nx" and text[21] == "" and text[22] == "" and text[None] == "n"
    assert text[30] == text[31] == plain  # marked as article
    assert text[40] == text[41] == plain  # copies keep what they have
    assert hsa.main_texts(df.limit(0)).collect() == []


def test_a_long_host_is_worked_in_stretches(spark, monkeypatch):
    from sorigil.llm.queries import QUERIES

    want = {r.page_id: r.text for r in QUERIES["op2_host_suffix_array"](spark, SMALL).collect()}
    html = {r.page_id: r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    assert want == {k: text_of(v) for k, v in html.items()}  # every page there has an article


@pytest.mark.parametrize("host_pages, stream", [(5, 1 << 20), (1000, 60), (7, 90)])
def test_repeats_are_found_over_the_whole_host(spark, host_pages, stream):
    rng = np.random.default_rng(3)
    words = [[f"w{x}" for x in rng.integers(0, 10**6, 40)] for _ in range(60)]
    for a, b in ((0, 59), (3, 31), (17, 18)):  # passages that just two pages have
        words[b][10:25] = words[a][5:20]
    ids = [*range(50), *[None] * 4, *[77] * 6]
    for k in range(54, 59):
        words[k] = words[59][:]  # copies by id are no evidence
    rows = [(i, f"https://{h}/{k}", f"<body><p>{' '.join(w)}</p></body>") for h in ("a", "b") for k, (i, w) in enumerate(zip(ids, words)) if h == "a" or k < 2]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.url: r.n_repeated for r in hsa.main_texts(df, host_pages=host_pages, stream=stream).collect()}
    seen = {}
    for i, w in zip(ids, words):
        for k in range(len(w) - 11):
            seen.setdefault(tuple(w[k : k + 12]), set()).add(i)
    want = {}
    for k, w in enumerate(words):
        cover = set()
        for j in range(len(w) - 11):
            if len(seen[tuple(w[j : j + 12])]) > 1:
                cover.update(range(j, j + 12))
        want[f"https://a/{k}"] = len(cover)
    assert got == want | {"https://b/0": 0, "https://b/1": 0}


def test_repeats_between_shares_are_found_whatever_pages_lie_beside_them(spark):
    """Shares of a host that share a task, ahead of which short hosts change where stretches end."""
    rng = np.random.default_rng(5)
    words = [[f"w{x}" for x in rng.integers(0, 10**6, 40)] for _ in range(120)]
    for a in range(0, 120, 2):
        words[a + 1][10:25] = words[a][5:20]
    rows = [(k, f"https://m/{k}", f"<p>{' '.join(w)}</p>") for k, w in enumerate(words)]
    rows += [(1000 + k, f"https://h{k}/", f"<p>{' '.join(f'v{x}' for x in rng.integers(0, 10**6, 30))}</p>") for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    for host_pages, stream in ((5, 1 << 20), (5, 700), (3, 400), (500, 1 << 20)):
        got = {r.page_id: r.n_repeated for r in hsa.main_texts(df, host_pages=host_pages, stream=stream).collect()}
        assert got == {k: 15 if k < 120 else 0 for k in got} and len(got) == 160


def test_blocks_of_a_long_host_are_dealt_once(spark):
    rows = [(k, "https://a/", f"<p>{' '.join(f'w{k // 2}_{j}' for j in range(20))}</p>") for k in range(40)]
    df = hsa.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string"), host_pages=5)
    assert len(df.collect()) == 40
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("MapInArrow _read(") == 1 and len(re.findall(r"ReusedExchange \[host", plan)) == 2


@pytest.mark.parametrize("seed", range(3))
def test_only_windows_with_a_shared_minimizer_are_sent(seed):
    rng = np.random.default_rng(seed)
    texts = [[f"w{x}" for x in rng.integers(0, 10**6, 3000)] for _ in range(2)]
    texts[1][500:540] = texts[0][700:740]
    stretches = []
    for share, words in enumerate(texts):
        stretches.append(hsa.Stretch())
        stretches[-1].add(share, "u", ("a", share), 2, [(2, " ".join(words))])
    short = [np.sort(np.concatenate([v * n + b for _, n, b, _, _, v in s.distinct(True)])) for s in stretches]
    assert all(len(x) < 3000 / 3 for x in short)
    both = np.intersect1d(*short)
    for s in stretches:
        assert list(s.distinct(False)) == []
        s.shared = [both]
    sent = [np.concatenate([v * n + b for _, n, b, _, _, v in s.distinct(False)]) for s in stretches]
    assert len(np.intersect1d(*sent)) == 40 - 11 and all(len(x) < 200 for x in sent)


def test_coded_numbers_come_back():
    rng = np.random.default_rng(1)
    for top, n in ((1, 1), (2, 2), (50, 50), (1 << 20, 1000), ((1 << 64) - 1, 1), ((1 << 64) - 1, 3000), (1 << 58, 7)):
        values = np.unique(rng.integers(0, top, n, dtype=np.uint64, endpoint=True))
        values[-1] = top
        data = hsa.coded(values)
        assert hsa.decoded(data).tolist() == values.tolist()
        assert len(data) * 8 <= 64 + len(values) * (max(np.log2(top / len(values)), 0) + 3)


def test_archive_round_trip(spark):
    big, small = "é" * 60, "x" * 99
    rows = [(5, "http://a/\r\nX: y", big), (3, None, big), (9, "http://b", big), (1, "u", small), (2, "u", small), (4, "u", None), (6, "u", ""), (None, "n", big), (7, "u", "p" * 100), (None, "m", "q" * 200), (9, "http://b", big)]
    df = spark.createDataFrame([(*r, "t", "h", "d", 1) for r in rows], PAGES)
    folder = work_folder(spark, "warc-test")
    warc_store.write_archive(df, folder)
    assert spark.read.parquet(f"{folder}/payloads").count() == 5  # each distinct payload once
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc_store.archive_and_read(df).collect()), key=str)
    want = [(5, 120, "revisit", 3), (3, 120, "response", None), (9, 120, "revisit", 3), (9, 120, "revisit", 3), (1, 99, "response", None), (2, 99, "response", None), (4, 0, "response", None), (6, 0, "response", None), (None, 120, "revisit", 3), (7, 100, "response", None), (None, 200, "response", None)]
    assert got == sorted(want, key=str)
    records = {r.record_id: bytes(r.record) for r in warc_store.records(spark, folder).collect()}
    head, block = records[3].split(b"\r\n\r\n", 1)
    assert block == big.encode() + b"\r\n\r\n" and b"Content-Length: 120" in head and hashlib.sha256(big.encode()).hexdigest().encode() in head
    assert b"WARC-Target-URI: http://a/%0D%0AX: y" in records[5] and b"Refers-To: <urn:page:3>" in records[5]
    assert warc_store.archive_and_read(df.limit(0)).collect() == []


def test_a_changed_payload_is_noticed(spark):
    df = spark.createDataFrame([(1, "u", "a" * 200)], "page_id long, url string, html string")
    folder = work_folder(spark, "warc-test")
    warc_store.write_archive(df, folder)
    bad = spark.read.parquet(f"{folder}/payloads").selectExpr("digest", "cast('b' as binary) as payload").collect()
    spark.createDataFrame(bad, "digest string, payload binary").write.mode("overwrite").parquet(f"{folder}/payloads")
    with pytest.raises(Exception, match="differs"):
        warc_store.read_back(spark, folder).collect()


def test_language_fusion(spark):
    docs = spark.createDataFrame([("de", "der hund und die katze sind im haus " * 5), ("en", "the dog and the cat are in the house " * 5), ("fr", "le chien et le chat sont dans la maison " * 5), (None, "x"), ("en", None)], "lang string, text string")
    pages = [(k, f"https://h.de/{k}", "<html lang='de'><article>die katze und der hund</article>") for k in range(8)]
    pages += [(20, "https://h.de/q", "<article></article>"), (21, "https://one.fr/", "<html lang=fr>le chat et le chien sont dans la maison"), (22, None, None), (23, "https://h.de/x", "<html lang='de'><p>the cat and the dog are in the house and the dog is the cat</p>"), (23, "https://h.de/x", "<html lang='xx'><p>the cat and the dog are in the house and the dog is the cat</p>")]
    df = spark.createDataFrame([(*p, "t", "h", "d", 1) for p in pages], PAGES)
    got = language_fusion.identify(df, docs).collect()
    assert len(got) == len(pages)
    lang = {r.page_id: r.lang for r in got}
    assert lang[0] == "de" and lang[20] == "de" and lang[21] == "fr" and lang[23] == "en" and lang[22] in ("de", "en", "fr")
    assert all(0 < r.probability <= 1 for r in got)
    assert language_fusion.identify(df.limit(0), docs).collect() == []
    assert {r.lang for r in language_fusion.identify(df, docs.limit(0)).collect()} == {None}


def test_hostile_pages_take_time_in_proportion_to_their_length():
    import time

    from sorigil.llm.html_blocks import blocks

    began = time.perf_counter()
    for page in ("<a" * 500_000, "<" + "a" * 1_000_000, "<a " * 300_000, "<nav><main>" * 60_000, "<p>x" * 200_000, "<!--" * 200_000, "<a href='" * 100_000, "< " * 400_000, "&" * 500_000, "<form>" * 150_000 + "<main>", "<form><p>" * 100_000 + "</form>", "<form><main>" * 80_000, "<form>" * 150_000 + "<main></form>"):
        blocks(page)
    assert time.perf_counter() - began < 9
    assert blocks("<p>one</p> tail <!-- open comment") == [(2, "one"), (2, "tail")]
    assert [t for _, t in blocks("<p>a</p><a")] == ["a", "<a"]


def test_every_language_of_the_documents_is_an_answer(spark):
    rng = random.Random(8)
    names = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwy", k=3)) for _ in range(90)} - {"mul", "und", "mis"})[:78] + ["fi", "fil"]
    words = {n: ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(40)] for n in names}
    docs = [(k, " ".join(rng.choices(words[n], k=30)), n) for k, n in enumerate(names)]
    docs += [(k, " ".join(rng.choices(words["fi"], k=30)), "fi-FI") for k in range(1000, 1600)] + [(9, "nothing", "und"), (9, "nothing", "no language")]
    pages = [(k, f"https://h{k % 7}.net/", f"<p>{' '.join(rng.choices(words[n], k=20))}</p>") for k, n in enumerate(names)]
    pages += [(900, "https://only.net/", "<html lang='fil'></html>"), (901, "https://one.net/", "<html lang=\"fi-FI\"></html>")]
    df = spark.createDataFrame([(*p, "t", "h", "d", 1) for p in pages], PAGES)
    table = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    assert language_fusion.learn(table, sample=160)[0] == sorted(names)
    got = {r.page_id: r for r in language_fusion.identify(df, table).collect()}
    assert [got[k].lang for k in range(len(names))] == names
    assert (got[900].declared, got[900].lang, got[901].lang) == ("fil", "fil", "fi")


def test_language_fusion_is_bayes_rule(spark):
    """A plain form over a whole small table: counts, likelihoods and the three smoothed levels one page at a time."""
    import math
    from collections import Counter, defaultdict

    from sorigil.llm.html_blocks import blocks
    from sorigil.llm.queries import QUERIES

    small = "/root/testdata/sf0.001"

    def grams(text):
        b = bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode())
        return [((b[i] << 16 | b[i + 1] << 8 | b[i + 2]) * 2654435761 % 2**32) >> 19 for i in range(len(b) - 2)]

    counts = defaultdict(Counter)
    for r in spark.read.parquet(f"{small}/documents.parquet").collect():
        if r.lang and r.text is not None:
            counts[r.lang].update(grams(r.text))
    names = sorted(counts)
    size = {n: sum(counts[n].values()) + 0.5 * 8192 for n in names}
    pages = []
    for r in spark.read.parquet(f"{small}/pages.parquet").collect():
        html = r.html or ""
        seen = grams("\n".join(t for kind, t in blocks(html) if kind < 3))
        m = re.search(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]+)", html, re.I)
        like = {n: sum(math.log((counts[n][g] + 0.5) / size[n]) for g in seen) * min(len(seen), 50) / max(len(seen), 1) for n in names}
        if m and m[1].lower() in names:
            for n in names:
                like[n] += math.log(0.9 if n == m[1].lower() else 0.1 / (len(names) - 1))
        odds = {n: math.exp(like[n] - max(like.values())) for n in names}
        host = re.match(r"\w+://([^/:?#]*)", r.url or "")
        host = host[1].lower() if host else ""
        pages.append((r.page_id, host, re.search(r"[^.]*$", host)[0], like, {n: v / sum(odds.values()) for n, v in odds.items()}))
    levels = [Counter(), Counter(), Counter()]
    number = [Counter(), Counter(), Counter()]
    for _, host, suffix, _, vote in pages:
        for level, key in enumerate((None, suffix, host)):
            number[level][key] += 1
            for n in names:
                levels[level][key, n] += vote[n]
    got = {r.page_id: (r.lang, r.probability) for r in QUERIES["op5_bayesian_fusion"](spark, small).collect()}
    assert len(got) == len(pages)
    for i, host, suffix, like, vote in pages:
        post = {}
        for n in names:
            prior = 1 / len(names)
            for level, key in enumerate((None, suffix, host)):
                prior = (max(levels[level][key, n] - vote[n], 0) + 5 * prior) / (number[level][key] - 1 + 5)
            post[n] = like[n] + math.log(prior)
        odds = {n: math.exp(post[n] - max(post.values())) for n in names}
        best = max(names, key=odds.get)
        assert got[i][0] == best and abs(got[i][1] - odds[best] / sum(odds.values())) < 1e-4
