"""Operators 11 to 13 against brute-force versions."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from conftest import SF_SMALL
from storelake.llm import hard_negatives, repetition, token_align

SPACE = re.compile("[\x20\x09-\x0d]+")
ODD = [(900, None), (901, ""), (902, "a" * 30000), (903, " \n\n"), (904, "x"), (904, "x"), (None, "y z"),
       (905, "a b c " * 400), (906, "line one\n" * 60), (907, "é ü\x1c ö " * 40)]


@pytest.fixture(scope="module")
def small(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]


def documents(spark, rows):
    """Documents with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, 1, True, "x", "y") for i, t in rows],
                                 "doc_id long, text string, n_words long, kept boolean, block string, places string")


# 11: quality rules

def rules(text):
    text = text or ""
    words = [w for w in SPACE.split(text) if w]
    lines = [x for x in text.split("\n") if SPACE.sub("", x)]
    out = {"n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
           "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines))}
    seen, out["dup_line_chars"] = set(), 0
    for x in lines:
        out["dup_line_chars"] += len(SPACE.sub("", x)) if x in seen else 0
        seen.add(x)

    def windows(n):
        return [tuple(words[k:k + n]) for k in range(len(words) - n + 1)]

    def covered(places, n):
        return {p for k in places for p in range(k, k + n)}

    three = windows(3)
    often = Counter(three)
    out["n_repeat_words"] = len(covered([k for k, w in enumerate(three) if often[w] > 1], 3))
    for n in repetition.TOP_SHARE:
        out[f"top_{n}_chars"] = max([c * sum(map(len, w)) for w, c in Counter(windows(n)).items() if c > 1], default=0)
    for n in repetition.REPEAT_SHARE:
        seen, places = set(), []
        for k, w in enumerate(windows(n)):
            places += [k] if w in seen else []
            seen.add(w)
        out[f"dup_{n}_chars"] = sum(len(words[p]) for p in covered(places, n))
    out["base_failed"] = out["n_words"] < 50 or 100 * out["n_repeat_words"] > 50 * out["n_words"]
    over = [100 * out["n_symbols"] > 10 * out["n_words"], 100 * out["n_dup_lines"] > 30 * out["n_lines"],
            100 * out["dup_line_chars"] > 20 * out["word_chars"],
            *(100 * out[f"top_{n}_chars"] > s * out["word_chars"] for n, s in repetition.TOP_SHARE.items()),
            *(100 * out[f"dup_{n}_chars"] > s * out["word_chars"] for n, s in repetition.REPEAT_SHARE.items())]
    out["kept"] = not (out["base_failed"] or any(over))
    return out


def as_bag(rows):
    return Counter(tuple(sorted(r.items(), key=lambda x: x[0])) for r in rows)


def test_quality_rules_equal_brute_force(spark, small):
    random.seed(3)
    noise = [(2000 + k, " ".join(random.choice(["a", "bb", "é", "#c", "d\n"]) for _ in range(random.randint(0, 300)))) for k in range(60)]
    rows = small + ODD + noise
    got = repetition.quality_rules(documents(spark, rows)).collect()
    assert as_bag(r.asDict() for r in got) == as_bag({"doc_id": i, **rules(t)} for i, t in rows)


def test_quality_rules_do_not_depend_on_batches(small):
    texts = [t or "" for _, t in small]
    whole = repetition.measure(texts)
    for k, t in enumerate(texts[:40]):
        assert {c: v[0] for c, v in repetition.measure([t]).items()} == {c: v[k] for c, v in whole.items()}


def test_hash_collisions_count_nothing(monkeypatch, small):
    texts = [t or "" for _, t in small][:30]
    right = repetition.measure(texts)
    monkeypatch.setattr(repetition, "_BASE", np.uint64(2**48))      # most of a window is shifted out of its hash
    again = repetition.measure(texts)
    for c in ("word_chars", "n_dup_lines"):
        assert (right[c] == again[c]).all()
    assert all((again[c] <= right[c]).all() for c in right if c.startswith("dup_"))


def test_repeated_passage_is_rejected_and_clean_text_kept():
    random.seed(5)
    clean = " ".join(f"w{random.randint(0, 5000)}" for _ in range(400))
    passage = " ".join(f"p{k}" for k in range(60))
    m = repetition.measure([clean, f"{clean} {passage} {passage} {passage}", "same line here again\n" * 30])
    assert m["kept"].tolist() == [True, False, False]


def test_quality_rules_of_an_empty_table(spark):
    assert repetition.quality_rules(documents(spark, [])).collect() == []


# 12: hard negatives

VECTORS = "vec_id long, embedding array<double>, label int, q string, block long, score double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, l, "q", 1, 0.5) for i, v, l in rows], VECTORS)


def mined(rows, is_anchor, relabel=lambda i, l: l):
    usable = {}
    for i, v, l in rows:
        if i is not None and l is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable[(i, relabel(i, l), tuple(int(np.floor(256.0 * x)) for x in v))] = None
    usable, out = list(usable), Counter()
    for a, la, qa in (r for r in usable if is_anchor(r[0])):
        scored = sorted({(-sum(x * y for x, y in zip(qa, q)), i, l == la) for i, l, q in usable if i != a})
        positives = [(-s, i) for s, i, same in scored if same][:5]
        for ps, p in positives:
            hits = [(-s, i) for s, i, same in scored if not same and 30 * ps <= -100 * s <= 90 * ps][:10]
            out.update((a, p, rank, n, ps, ns) for rank, (ns, n) in enumerate(hits, 1))
    return out


def found(df):
    return Counter((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def random_vectors(seed, n, dim, spread=1.0):
    g = np.random.default_rng(seed)
    centres = g.normal(size=(6, dim))
    return [(int(k), [float(x) for x in centres[k % 6] * spread + g.normal(size=dim) * 0.5], int(g.integers(0, 4))) for k in range(n)]


def test_hard_negatives_equal_brute_force(spark):
    rows = random_vectors(1, 900, 8)
    nan, inf = float("nan"), float("inf")
    rows += [(5000, None, 1), (5100, [nan] * 8, 1), (5200, [inf] + [0.0] * 7, 1), (None, [1.0] * 8, 1), (5300, [1.0] * 8, None),
             (5400, [None] + [1.0] * 7, 2), (5500, [0.0] * 8, 1), (5600, [], 2), (5700, [2.0, 1.0], 3), (5800, [1.0] * 8, 0), (-700, [0.4] * 8, 2)]
    rows += rows[:50] + [(7, [0.1] * 8, 1), (200, [0.3] * 8, 2)]        # repeated rows, and ids with a second vector
    rows += [(6000 + k, [1.5] * 8, k % 3) for k in range(60)]           # ties
    got = found(hard_negatives.hard_negatives(vectors(spark, rows).repartition(5)))
    want = mined(rows, lambda i: i % 100 == 0, lambda i, l: (l + 1) % 10 if i % 7 == 0 else l)
    assert want and got == want


@pytest.mark.parametrize("block, anchors", [(7, 3), (64, 1000)])
def test_hard_negatives_do_not_depend_on_blocks(spark, monkeypatch, block, anchors):
    from pyspark.sql import functions as F
    monkeypatch.setattr(hard_negatives, "TOGETHER", 2)
    rows = random_vectors(2, 200, 5, 0.2)
    got = found(hard_negatives.mine(vectors(spark, rows).repartition(3), F.col("vec_id") % 25 == 0, block=block, anchor_block=anchors))
    assert got == mined(rows, lambda i: i % 25 == 0)


@pytest.mark.parametrize("size", [2.0**21, 2.0**23])
def test_large_components_are_exact(spark, size):
    from pyspark.sql import functions as F
    rows = [(k, [size * (1 + k / 64) / 8 + k / 7, size * ((k * 5 % 17) / 17)], k % 2) for k in range(60)]
    got = found(hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0))
    assert got == mined(rows, lambda i: i % 10 == 0) and any(n[4] > 2**53 for n in got)


def test_scores_beyond_a_long_are_held_at_its_limit(spark):
    from pyspark.sql import functions as F
    rows = [(k, [2.0**40 * (k + 1), 3.0 * k], k % 2) for k in range(30)]
    assert found(hard_negatives.mine(vectors(spark, rows), F.col("vec_id") % 10 == 0)) == Counter()


def test_reading_stops_before_the_end():
    g = np.random.default_rng(4)
    x = (g.normal(size=(5000, 6)) * 20).astype(np.int64)
    x[:40] += 400
    lists = hard_negatives.Lists(np.arange(5000), np.zeros(5000, np.int64), x, 500)
    anchor = np.full(6, 300)
    read = sum(len(r) for r, _, t in lists.reads(anchor) if t is None or t >= np.sort(x @ anchor)[-5])
    assert read < 2500
    (rows, scores), = lists.top(anchor, np.ones(5000, bool), [(float("-inf"), float("inf"))], 5)
    assert sorted(scores, reverse=True) == sorted((x @ anchor).tolist(), reverse=True)[:5]


def test_hard_negatives_of_an_empty_table(spark):
    assert hard_negatives.hard_negatives(vectors(spark, [])).collect() == []
    assert hard_negatives.hard_negatives(vectors(spark, [(1, [1.0], 1)])).collect() == []


# 13: alignment

@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def aligned(libraries, text):
    """Ids and byte ranges of both sides, or nothing."""
    a_lib, b_lib = libraries
    if not text:
        return [], []
    raw = (" " + text).encode()
    e = a_lib.encode(" " + text, add_special_tokens=False)
    # the bytes that a byte-level entry stands for, from the library's own decoder
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in own}
    table |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in own)}
    a, b, at = [], [], 0
    for i, t in zip(e.ids, e.tokens):
        a.append((i, at, at := at + len(t), bytes(table[c] for c in t)))
    at = 0
    for i in b_lib.encode(text):
        p = b_lib.id_to_piece(i)
        data = bytes([int(p[3:5], 16)]) if b_lib.is_byte(i) else p.replace("▁", " ").encode()
        b.append((i, at, at := at + len(data), data))
    if b"".join(x[3] for x in a) != raw or b"".join(x[3] for x in b) != raw:
        return [], []
    return a, b


def alignment(libraries, rows):
    per_doc, held = [], Counter()
    for i, t in rows:
        a, b = aligned(libraries, t)
        links = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] if len(a) < 400 else quick_links(a, b)
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups, lo = [], 0
        for c in cuts:
            groups.append(",".join(str(x[0]) for x in a if lo < x[2] <= c) + "|" + ",".join(str(y[0]) for y in b if lo < y[2] <= c))
            lo = c
        per_doc.append((i, a, b, links, groups))
        held.update(set(links))
    top = defaultdict(int)
    for (x, _), n in held.items():
        top[x] = max(top[x], n)
    return Counter((i, len(a), len(b), len(g), len(l), sum(held[p] == top[p[0]] for p in l), sum(held[p] for p in l),
                    hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for i, a, b, l, g in per_doc)


def quick_links(a, b):
    out, j = [], 0
    for x in a:
        while b[j][2] <= x[1]:
            j += 1
        k = j
        while k < len(b) and b[k][1] < x[2]:
            out.append((x[0], b[k][0]))
            k += 1
    return out


TRICKY = [(3000, "<|endoftext|> and <s> </s> <unk> <0x0A>"), (3001, "a▁b"), (3002, "  two  blanks \n\n tabs\t\t "), (3003, " "),
          (3004, "日本語のテキスト と 한국어 😀😀 नमस्ते"), (3005, "x\x00y\x01"), (3006, "﻿bom ­ soft"), (3007, "aaaa" * 50),
          (3008, "trailing "), (3009, "ﬁ ½ Å"), (None, "no id"), (3010, "same"), (3010, "same"), (3011, "<|endoftext|>" * 5), (3012, "\r\n\r\n  x")]


def reported(df):
    return Counter((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def test_alignment_equals_brute_force(spark, small, libraries):
    random.seed(8)
    noise = [(4000 + k, "".join(random.choice("ab é😀\n<|s>▁ 0_-") for _ in range(random.randint(0, 80)))) for k in range(200)]
    rows = [(i, (t or "")[:1500]) for i, t in small] + TRICKY + ODD[:2] + ODD[3:] + noise
    got = reported(token_align.alignment_report(documents(spark, rows).repartition(3)))
    assert got == alignment(libraries, rows)


def test_alignment_does_not_depend_on_blocks(spark, small, monkeypatch):
    docs = documents(spark, small + TRICKY).repartition(2)
    whole = reported(token_align.alignment_report(docs))
    monkeypatch.setattr(token_align, "BLOCK_PAIRS", 50)
    monkeypatch.setattr(token_align, "BATCH_CHARS", 3000)
    monkeypatch.setattr(token_align, "PART", 7)
    assert reported(token_align.alignment_report(docs)) == whole


@pytest.mark.parametrize("piece", [1, 2, 3, 7, 256])
def test_merge_path_equals_two_pointers(piece):
    g = np.random.default_rng(piece)
    for n in (0, 1, 2, 5, 40, 300):
        total = 3 * n
        ends = [np.unique(np.append(g.integers(1, total, g.integers(0, n + 1)), total)) if n else np.zeros(0, np.int64) for _ in "ab"]
        a, b = (x.astype(np.int64) for x in ends)
        left, right, ga, gb = token_align.merge_ends(a, b, piece)
        ranges = [list(zip(np.concatenate([[0], x[:-1]]).tolist(), x.tolist())) if len(x) else [] for x in (a, b)]
        want = [(i, j) for i, x in enumerate(ranges[0]) for j, y in enumerate(ranges[1]) if x[0] < y[1] and y[0] < x[1]]
        assert sorted(zip(left.tolist(), right.tolist())) == want
        both = np.intersect1d(a, b)
        assert (ga == np.searchsorted(both, a)).all() and (gb == np.searchsorted(both, b)).all()


def test_alignment_itself_and_a_long_text(spark, libraries):
    text = "Numbers 123456 and wörter, " * 12000
    row, = token_align.align(documents(spark, [(1, text)])).collect()
    a, b = aligned(libraries, text)
    assert row.a_ids == [x[0] for x in a] and row.b_ids == [x[0] for x in b]
    both = np.intersect1d([x[2] for x in a], [x[2] for x in b])
    assert row.group_a == np.searchsorted(both, [x[2] for x in a]).tolist()
    assert row.group_b == np.searchsorted(both, [x[2] for x in b]).tolist()


def test_alignment_of_an_empty_table(spark):
    assert token_align.alignment_report(documents(spark, [])).collect() == []
