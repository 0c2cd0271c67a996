"""Operators that answer each text by itself, against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

from conftest import SF_SMALL
from storelake.llm import bpe, html_text, licenses, pii, registry, token_store

SCHEMA = "doc_id long, text string, pos int, line string, key string, ids string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 1, "x", "y", "z") for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


ODD = [(900, None), (901, ""), (902, "a" * 30000), (903, " \n\n"), (904, "x"), (904, "x"), (None, "y z")]


# 1: personal data

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    d = [int(c) for c in digits[::-1]]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def base_spans(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m[0].split(".")),
                    "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 9 <= len(digits) <= 15}[kind]():
                out.append((m.start(), rank, m.end(), kind))
    return sorted(out)


def test_pii_base_spans_equal_brute_force(spark, small):
    random.seed(1)
    noise = [(1000 + i, "".join(random.choice("a.@-+ 0123456789é😀()_%") for _ in range(random.randint(0, 200))))
             for i in range(400)]
    rows = small + ODD + noise + [(2000, "4111 1111 1111 1111 x 4111 1111 1111 1112"), (2001, "1." * 3000), (2002, "a@b.c." * 500)]
    got = pii.pii_report(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for i, t in rows:
        spans = base_spans(t)
        text = ",".join(f"{k}:{a}:{e}" for a, _, e, k in spans)
        n = Counter(k for *_, k in spans)
        want[(i, *(n[k] for k in PATTERNS), hashlib.sha256(text.encode()).hexdigest())] += 1
    assert Counter((r["doc_id"], r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == want


def test_pii_checks_and_context(spark):
    rows = [(1, "GB82 WEST 1234 5698 7654 32"), (2, "GB82 WEST 1234 5698 7654 33"), (3, "my ssn is 123-45-6789"),
            (4, "part 123-45-6789"), (5, "call +49 170 1234567 or mail a@b.org")]
    got = {r["doc_id"]: r for r in pii.pii_report(frame(spark, rows)).collect()}
    assert got[1]["spans"] == "iban:0:27" and got[2]["spans"] == ""
    assert got[3]["spans"] == "ssn:10:21" and got[4]["spans"] == ""
    assert got[5]["spans"] == "phone:5:20,email:29:36" and got[5]["scores"] == "1.0,1.0"
    gone = {r["doc_id"]: r["text"] for r in pii.redact(frame(spark, rows + [(6, None)])).collect()}
    assert gone[5] == "call [removed] or mail [removed]" and gone[6] is None
    assert pii.pii_report(frame(spark, rows).limit(0)).count() == 0


def test_pii_runs_without_python(spark):
    plan = pii.pii_report(frame(spark, [(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("Exchange", "")


# 2: byte-level BPE

def reference_encoding():
    import base64
    import tiktoken
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_public_library(spark, small):
    enc = reference_encoding()
    random.seed(2)
    noise = [(1000 + i, "".join(random.choice("ab the's \n\t  é😀ñ'll123.,!  \x1c\x85") for _ in range(random.randint(0, 80))))
             for i in range(1000)]
    rows = small + ODD + noise + [(1, "ab" * 3000), (2, " " * 3000), (3, "!" * 999), (4, "<|endoftext|> a\n")]
    got = bpe.encode_report(frame(spark, rows)).collect()
    want = Counter()
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        want[(i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
              hashlib.sha256((t or "").encode()).hexdigest())] += 1
    assert Counter(tuple(r) for r in got) == want
    assert bpe.encode_report(frame(spark, []).limit(0)).count() == 0
    ids = {r["doc_id"]: r["ids"] for r in bpe.encode(frame(spark, [(1, "hello world"), (2, None)])).collect()}
    assert enc.decode(ids[1]) == "hello world" and ids[2] == []


def test_long_piece_equals_the_matrix():
    b = bpe.load(*bpe.vocabulary(None, None))
    random.seed(3)
    pieces = ["".join(random.choice("abcdeth ing") for _ in range(random.randint(2, 250))).encode() for _ in range(200)]
    for p, ids in zip(pieces, b.encode_pieces(pieces)):
        assert ids.tolist() == b._long(p).tolist()


# 5: token shards

def test_store_round_trip(spark, small):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    rows = sorted(small + [(5000, None), (5001, ""), (5002, "É'll\tx 😀" * 50)])
    got = {r["doc_id"]: r for r in token_store.store_report(frame(spark, random.sample(rows, len(rows)))).collect()}
    start = 0
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, token_store.END_ID]
        r = got[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_added_tokens_equal_the_unmodified_library():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    texts = ["one<|endoftext|>two <|startoftext|> three", "<|endoftext|>.", "a <|ENDOFTEXT|> b", "É<|EndOfText|>x<|endoftext|>a.",
             "😀<|endoftext|>\tZ", "<|endoftext", "<|Other|> <|endoftext|>"]
    got = token_store.ChunkTokenizer(path)
    want = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, got.dtype).tolist() for x in got.encode(texts)] == want
    assert 49407 in want[0] and 49407 not in want[2]


def test_store_repeated_and_missing_ids(spark):
    got = token_store.store_report(frame(spark, [(None, "x y"), (3, None), (3, "b c"), (3, "b c"), (-5, "")])).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in got) == [
        (False, 0, 3), (True, -5, 1), (True, 3, 1), (True, 3, 3), (True, 3, 3)]
    assert sorted(r["start"] for r in got)[:2] == [0, 3]
    assert token_store.store_report(frame(spark, []).limit(0)).count() == 0


def test_shard_lookup_rejects_unknown_keys(tmp_path):
    w = token_store.ShardWriter(str(tmp_path / "0.ids"), np.dtype("<u2"))
    for k in range(5000):
        w.add(k * 7, np.arange(k % 5, dtype="<u2").tobytes())
    w.close()
    r = token_store.ShardReader(str(tmp_path / "0.ids"))
    keys = np.arange(5000) * 7
    at, n = r.find(keys, np.zeros(5000, np.int64))
    assert (n == np.arange(5000) % 5).all()
    assert r.read(at[4], n[4]).tolist() == [0, 1, 2, 3]
    _, n = r.find(keys + 1, np.zeros(5000, np.int64))
    assert (n == -1).all()
    slots = token_store.PerfectHash.build(token_store.hash_keys(keys, np.zeros(5000, np.int64))).slots(
        token_store.hash_keys(keys, np.zeros(5000, np.int64)))
    assert sorted(slots) == list(range(5000))


# 6: licences

def test_licence_base_places(spark, small):
    rows = small + ODD + [(1, "CC BY cc-by 4.0"), (2, "All rights reserved. all  rights\nRESERVED"), (3, "éall rights reserved")]
    got = licenses.scan(frame(spark, rows)).collect()
    want = Counter()
    for i, t in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        at = sorted((k, label) for p, label in licenses.BASE_PHRASES.items() for k in range(len(ws))
                    if ws[k:k + len(p.split())] == p.split())
        want[(i, len(ws), len(at), at[0][0] if at else None, at[-1][0] if at else None,
              ",".join(sorted({label for _, label in at})))] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
               for r in got)


def test_licence_templates(spark):
    mit, bsd = licenses.TEMPLATES["mit"][0], licenses.TEMPLATES["bsd"][0]
    edited = mit.replace("hereby granted free", "hereby granted, free").replace("obtaining", "getting")
    shuffled = " ".join(sorted(bsd.split()))
    rows = [(1, f"Ab cd. {edited} ef"), (2, shuffled), (3, "ab " * 500 + bsd), (4, "ab cd"), (5, None)]
    got = {r["doc_id"]: r for r in licenses.scan(frame(spark, rows)).collect()}
    assert got[1]["labels"] == "mit" and 0.6 <= got[1]["score"] < 1
    assert got[2]["labels"] == "" and got[3]["labels"] == "bsd" and got[4]["score"] == 0.0
    assert licenses.scan(frame(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 3, 10])
def test_licence_with_words_set_in_keeps_its_label(spark, n):
    rng = random.Random(n)
    rows = []
    for i, label in enumerate(("mit", "apache-2.0", "bsd", "gpl-notice")):
        text, keys = licenses.TEMPLATES[label]
        ws = text.split()
        for _ in range(n):      # anywhere but inside a key phrase
            free = [k for k in range(1, len(ws)) if not any(" ".join(ws[max(0, k - d):k - d + len(q.split())]).lower() == q
                                                            for q in keys for d in range(1, len(q.split())))]
            ws.insert(rng.choice(free), f"x{rng.randint(0, 99)}")
        rows.append((i, "some words before it " + " ".join(ws) + " and after", label))
    got = {r["doc_id"]: r["labels"].split(",") for r in licenses.scan(frame(spark, [r[:2] for r in rows])).collect()}
    assert all(label in got[i] for i, _, label in rows)


def test_long_texts_take_linear_time(spark):
    import time
    def seconds(op, text):
        op(frame(spark, [(1, text)])).collect()
        t = time.time()
        op(frame(spark, [(1, text)])).collect()
        return time.time() - t
    assert seconds(licenses.scan, "all rights reserved cc by " * 80000) < 8
    one = " ".join(f"write to name{k}@host{k}.org or" for k in range(30000))
    assert len(one) > 900_000 and seconds(pii.pii_report, one) < 8
    r = pii.pii_report(frame(spark, [(1, one)])).first()
    assert r["n_email"] == 30000
    spans = [tuple(map(int, x.split(":")[1:])) for x in r["spans"].split(",")]
    assert all(one[a:b] == f"name{k}@host{k}.org" for k, (a, b) in enumerate(spans))


# 9: pages

def test_main_text_of_marked_pages(spark):
    import html
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    got = {r["page_id"]: r for r in registry.QUERIES["op9_html_text"](spark, SF_SMALL).collect()}
    assert len(got) == pages.count()
    for r in pages.collect():
        m = re.search(r"<article>(.*?)(</article>|\Z)", r["html"], re.S)
        body = re.sub(r"<[^>]*\Z", "", m[1])
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", " ", re.sub(r"</?b>", "", body))).split())
        assert got[r["page_id"]]["text"] == want and got[r["page_id"]]["n_chars"] == len(want)


def test_main_text_of_odd_pages(spark):
    menu = "<div>" + "home about our shop contact press jobs and legal" + "</div>"
    rows = [(1, "http://a/x", f"{menu}<p>own one &amp; only &lt;b&gt;</p>"), (2, "http://a/y", f"{menu}<p>own two</p>"),
            (3, None, None), (None, "http://a/z", ""), (4, "http://b/", "<p>a<b>b</b><br>c<script>'</p>'</script> d"),
            (5, "http://b/2", "<main>T<div class='comments'>bad</div><form>no</form>x&nbsp; y</main><p>out</p><p cut"),
            (6, "http://c/", "<p>same " + "z " * 20000 + "</p>"), (6, "http://c/", "<p>same " + "z " * 20000 + "</p>")]
    d = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, text string, chunk int")
    got = sorted(((r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_text.extract(d).collect()))
    long = "same " + "z " * 20000
    assert got == [(0, "", 0), (1, "own one & only <b>", 18), (2, "own two", 7), (3, "", 0), (4, "ab c d", 6),
                   (5, "T x y", 5), (6, long.strip(), len(long) - 1), (6, long.strip(), len(long) - 1)]
    assert html_text.extract(d.limit(0)).count() == 0


@pytest.mark.parametrize("page, text", [
    ('<main class="col no-sidebar"><p>Main text.', "Main text."),
    ('<article class="category-social post"><p>Body text', "Body text"),
    ('<article id="search-algorithms"><p>Body', "Body"),
    ('<article><p class="share">x<p>Body', "Body"),
    ('<article><ul><li class="ad">x<li>Main item</ul>', "Main item"),
    ('<div id="content"><p>main</p></div><article>small card</article>', "main"),
    ('<div class="site-footer">foot</div><p>real text of the page here', "real text of the page here"),
    ('<div class="page widget-area"><p>all of the page is here</p></div>', "all of the page is here"),
    ("<table><tr><td class=ad>x<td>cell<tr><td>more</table>", "cell more"),
    ('<dl><dt class="nav">a<dd>def</dl>', "def"),
    ("<ul><li>one<ul><li>inner</ul><li class=menu>no<li>two</ul>", "one inner two"),
    ("<article><p>a<div class=comments>c</div><p>b</article><div>out", "a b"),
    ('<article class="ad_banner">not dropped</article>', "not dropped"),
    ("<div class=my_sidebar>side words</div><article>the article has more words</article>", "the article has more words"),
])
def test_names_and_open_elements(spark, page, text):
    assert [r["text"] for r in html_text.extract(pages_of(spark, [page])).collect()] == [text]


def pages_of(spark, found, host="h"):
    return spark.createDataFrame([(k, f"http://{host}/{k}", p) for k, p in enumerate(found)], "page_id long, url string, html string")


def test_repeats_decide_beside_a_small_article(spark, monkeypatch):
    """Pages with an article: what their host repeats outside it goes, what is their own stays."""
    menu = "<div>home about our shop contact press jobs and legal notes of this site</div>"
    pages = [f"{menu}<div>own story {' '.join(f'w{k}x{i}' for i in range(20))}</div><article>card {k}</article>"
             for k in range(6)]
    d = pages_of(spark, pages)
    texts = {r["page_id"]: r["text"] for r in html_text.extract(d).collect()}
    assert all("own story" in t and f"card {k}" in t and "contact press" not in t for k, t in texts.items())
    monkeypatch.setattr(html_text, "repeated", lambda rows, hosts: spark.createDataFrame([], "host string, rank long"))
    assert all("contact press" in r["text"] for r in html_text.extract(d).collect())


def test_repeats_are_those_of_brute_force(spark):
    random.seed(4)
    n = html_text.REPEAT
    hosts = {h: [[[random.choice("abc") for _ in range(random.randint(1, 12))] for _ in range(random.randint(1, 6))] for _ in range(12)]
             for h in ("x", "y")}
    hosts["x"].append(hosts["x"][0])                            # a copy of a page is no second page
    rows, want = [], {}
    for h, found in hosts.items():
        streams = [tuple(w for block in page for w in block) for page in found]
        held = {}
        for s in streams:
            for i in range(len(s) - n + 1):
                held.setdefault(s[i:i + n], set()).add(s)
        for k, (page, s) in enumerate(zip(found, streams)):
            marks = [any(len(held[s[i:i + n]]) > 1 for i in range(max(0, j - n + 1), min(j, len(s) - n) + 1)) for j in range(len(s))]
            kept, at = [], 0
            for block in page:
                share = marks[at:at + len(block)]
                at += len(block)
                if sum(share) < html_text.COVERED * len(block):
                    kept.append(" ".join(block))
            rows.append((k, f"http://{h}/{k}", "".join(f"<p>{' '.join(block)}</p>" for block in page)))
            want[h, k] = " ".join(kept)
    d = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = {(r["url"][7], r["page_id"]): r["text"] for r in html_text.extract(d).collect()}
    assert got == want and len(set(want.values())) > 5


def own(k, n):
    return " ".join(f"w{k}x{i}" for i in range(n))


def test_runs_of_the_whole_site_decide_inside_articles(spark, monkeypatch):
    """A nameless notice in all articles goes; what half of them share stays, and so do copies and small hosts."""
    notice = "<div>read also our ten best stories of this week and tell your friends</div>"
    shared = "<p>this line stands in half of the articles and is a part of each one</p>"
    pages = [f"<article><p>{own(k, 30)}</p>{notice}{shared if k % 2 else ''}<p>{own(k + 100, 9)}</p></article>" for k in range(12)]
    want = [" ".join([own(k, 30), *([re.sub("<.*?>", "", shared)] if k % 2 else []), own(k + 100, 9)]) for k in range(12)]
    d = pages_of(spark, pages)
    assert [r["text"] for r in html_text.extract(d).orderBy("page_id").collect()] == want
    # beside a small article's page and in its article the runs hold as well
    more = pages_of(spark, [*pages, f"<div>{own(50, 200)}</div><article>{notice}<p>{own(51, 30)}</p></article>"])
    assert [r["text"] for r in html_text.extract(more).orderBy("page_id").collect()] == [*want, own(50, 200) + " " + own(51, 30)]
    few = html_text.extract(d.filter(f"page_id < {html_text.SITE_PAGES - 1}")).collect()
    assert len(few) == 9 and all("your friends" in r["text"] for r in few)
    monkeypatch.setattr(html_text, "site_runs", lambda cut_up: spark.createDataFrame([], "host string, site array<long>"))
    assert all("your friends" in r["text"] for r in html_text.extract(d).collect())


def test_copies_of_an_article_stay(spark):
    """Equal pages count once, and a page that would lose most of its main part keeps it."""
    same = [f"<article><p>{own(0, 60)}</p><p>{own(1, 20)}</p></article>"] * 20
    near = [f"<article><p>{own(2, 60)}</p><p>{own(3, 20)}</p><p>edit {k}</p></article>" for k in range(20)]
    for pages in (same, near):
        got = [r["text"] for r in html_text.extract(pages_of(spark, pages)).orderBy("page_id").collect()]
        assert got == [re.sub("(<.*?>)+", " ", p).strip() for p in pages]


@pytest.mark.parametrize("tokens, pages, parts", [(4_000_000, 8, 1), (300, 0, 7), (300, 8, 7), (1, 0, 3)])
def test_site_runs_are_those_of_brute_force(spark, monkeypatch, tokens, pages, parts):
    """Whatever the groups, the runs are those that stand on enough of a host's pages."""
    monkeypatch.setattr(html_text, "GROUP_TOKENS", tokens)
    monkeypatch.setattr(html_text, "GROUP_PAGES", pages)
    monkeypatch.setattr(html_text, "COUNTED_RUNS", tokens)
    random.seed(9)
    found, held = [], {}
    for h, n, share in (("x", 40, 0.85), ("y", 25, 0.8), ("z", 9, 1), ("v", 30, 0.78), ("u", 10, 0.9), ("t", 60, 0.3)):
        lines = [own(f"{h}{j}", 12) for j in range(8)]
        texts = [[*(x for x in lines if random.random() < share), own(f"{h}p{k}", 5)] for k in range(n)]
        texts += [texts[0]] * (n // 4)                          # copies
        for k, t in enumerate(texts):
            found.append((k, f"http://{h}/{k}", "<main>" + "".join(f"<p>{x}</p>" for x in t) + "</main>"))
            stream = html_text._stream(t)
            for r in set(html_text.suffix_ranks(stream).tolist()):
                held.setdefault((h, r), []).append(stream.tobytes())
        held[h] = len(texts)
    want = {k for k, v in held.items() if isinstance(k, tuple) and 5 * len(v) >= 4 * held[k[0]] and len(set(v)) >= html_text.SITE_PAGES}
    d = spark.createDataFrame(found, "page_id long, url string, html string").repartition(parts)
    seen, real = [], html_text.site_runs
    monkeypatch.setattr(html_text, "site_runs", lambda cut_up: seen.append(real(cut_up)) or seen[0])
    html_text.extract(d).collect()
    got = {(r["host"], x) for r in seen[0].collect() for x in r["site"]}
    assert got == want and len({h for h, _ in want}) >= 2


def test_a_large_host_equals_the_same_pages_in_any_partitioning(spark, monkeypatch):
    """A repeat that stands on two pages of a host is found wherever they lie."""
    pages = [f"<div>{' '.join(f'm{k // 2}y{i}' for i in range(10))}</div><p>{' '.join(f't{k}z{i}' for i in range(400))}</p>" for k in range(1200)]
    d = pages_of(spark, pages)
    monkeypatch.setattr(html_text, "BATCH_TOKENS", 5000)
    one = {r["page_id"]: r["text"] for r in html_text.extract(d.repartition(1)).collect()}
    many = {r["page_id"]: r["text"] for r in html_text.extract(d.repartition(23)).collect()}
    assert one == many and not any("y0" in t for t in one.values()) and all(f"t{k}z0" in t for k, t in one.items())
