"""Quality classifier (operator 10): an interpolated modified Kneser-Ney character n-gram model.

The grams are runs of ``ORDER`` code points, as they stand; nothing is folded, so the tables grow with what the corpus holds. A gram is
named by a 64-bit hash, and so are the shorter gram inside it and their contexts. The counts come from all trusted documents
(labelled good and not toxic), summed per task first; discounts, context totals and lower orders are joins and groupings of the
count tables, sharded by gram. The grams that the documents ask for are scored by joins with these tables, level by level, also
those never seen in training. Documents meet their grams' scores in a join: a row per document and distinct gram, summed up in the
task that holds the document. The score table is broadcast as long as it has at most ``MAX_BROADCAST_GRAMS`` rows.

A document's score is its perplexity per character. The bands come from trusted documents that the model hasn't seen: one of ``FOLDS``,
by a hash of its id, is kept from training (the lower end also looks at the others). Perplexity spreads more the shorter a text is, so quantiles are taken per language
and length class (powers of two), at ``TAIL`` from both ends: too low a perplexity (one word over and over) is rejected like too
high a one (marks, capitals, tables). The band is widened by ``MARGIN`` of its width. A length class with
fewer than ``MIN_TRUSTED`` such documents is pooled with its neighbours, shorter and longer, until
there are as many; a language with fewer in all takes its own whole range and the band over all
languages together. No band is open.

Null or empty texts have perplexity null and are kept: there is nothing to judge. Null languages are
a language of their own; a language without trusted documents takes the band over all languages.
Without any trusted document nothing is rejected. Repeated labels for a document count once; it is
trusted if no label calls it bad or toxic. Rows with equal ``doc_id`` are scored one by one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import broadcast_within, grouped, stored, tidy

ORDER = 4
MAX_BROADCAST_GRAMS = 1_000_000
BATCH_CHARS = 500_000
TAIL = 0.001
MARGIN = 0.5
MIN_TRUSTED = 20
FOLDS = 3                   # one trusted document of so many is kept from training, for the bands

_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def grams(texts: list[str], order: int = ORDER) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(text, names, contexts) of every character: ``names[k]`` is the gram of ``k`` characters that ends in it, ``contexts[k]`` that
    gram without its last one. Before a text stand ``order - 1`` marks."""
    points = [np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32) for t in texts]
    pad = np.zeros(order - 1, np.uint64)
    flat = np.concatenate([x for p in points for x in (pad, p.astype(np.uint64) + _U(1))] or [pad])
    size = np.array([len(p) for p in points], np.int64)
    owner = np.repeat(np.arange(len(texts)), size)
    real = np.arange(len(owner)) + (owner + 1) * (order - 1)
    names, ends = [np.zeros(len(real), np.uint64)], [np.zeros(len(flat), np.uint64)]
    for k in range(1, order + 1):
        before = np.concatenate([np.zeros(k - 1, np.uint64), flat[:len(flat) - k + 1]])
        ends.append(_mix(ends[-1] * _U(0x9E3779B97F4A7C15) + before + _U(k)))
        names.append(ends[-1][real])
    contexts = [names[0]] + [ends[k - 1][real - 1] for k in range(1, order + 1)]
    return owner, [x.view(np.int64) for x in names], [x.view(np.int64) for x in contexts]


def _parts(order: int) -> list[str]:
    return [f"{kind}{k}" for k in range(order, 0, -1) for kind in "gc"]


def _found(docs: DataFrame, order: int, counted: bool) -> DataFrame:
    """A row per gram of the texts with the names of its parts (``g<k>``, ``c<k>``), and how often it stands, if ``counted``. A task adds up
    its own texts first."""
    def run(batches):
        for b in batches:
            for part in grouped(b.column("text").to_pylist(), BATCH_CHARS):
                _, names, contexts = grams(part, order)
                _, first, n = np.unique(names[order], return_index=True, return_counts=True)
                cols = [pa.array(x[k][first]) for k in range(order, 0, -1) for x in (names, contexts)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(n)], [*_parts(order), "n"])

    schema = ", ".join(f"{c} long" for c in [*_parts(order), "n"])
    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), schema)
    others = [F.min(c).alias(c) for c in _parts(order)[1:]]
    return rows.groupBy(f"g{order}").agg(*others, *([F.sum("n").alias("n")] if counted else []))


def gram_counts(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The grams of all texts with their parts and their number ``n``."""
    return _found(docs, order, True)


def _discounts(counts: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney, from the counts of counts."""
    n = counts.agg(*[F.count_if(F.col("n") == k).alias(f"c{k}") for k in (1, 2, 3, 4)]).first()
    c = [0, *(n[f"c{k}"] for k in (1, 2, 3, 4))]
    y = c[1] / (c[1] + 2 * c[2]) if c[1] + 2 * c[2] else 0.0
    return [min(max(k - (k + 1) * y * c[k + 1] / c[k], 0.1), float(k)) if c[k] else 0.5 for k in (1, 2, 3)]


def kneser_ney(counts: DataFrame, order: int = ORDER) -> tuple[dict[int, DataFrame], dict[int, DataFrame], float]:
    """(probabilities, rests, floor): per level the probability of each seen gram (g, p) and the weight that each context leaves to the
    level below (c, rest); ``floor`` is the probability of any character below the first level. Level ``order`` counts
    grams; lower levels count distinct left neighbours."""
    levels = {order: counts}
    for k in range(order - 1, 0, -1):
        others = [F.min(c).alias(c) for c in _parts(order)[2 * (order - k) + 1:]]
        levels[k] = stored(levels[k + 1].groupBy(f"g{k}").agg(F.count("*").alias("n"), *others), f"grams-{k}")
    floor = 1.0 / (levels[1].count() + 1)       # one for a character never seen
    p, rests = {}, {}
    for k in range(1, order + 1):
        d = _discounts(levels[k])
        n = F.col("n")
        cut = F.when(n == 1, d[0]).when(n == 2, d[1]).otherwise(d[2])
        stats = levels[k].groupBy(F.col(f"c{k}").alias("c")).agg(F.sum("n").alias("total"), F.sum(cut).alias("taken"))
        stats = stored(stats.withColumn("rest", F.col("taken") / F.col("total")), f"contexts-{k}")
        rows = levels[k].withColumnRenamed(f"c{k}", "c").join(stats, "c")
        if k == 1:
            below = F.lit(floor)
        else:
            rows = rows.join(p[k - 1].select(F.col("g").alias(f"g{k - 1}"), F.col("p").alias("below")), f"g{k - 1}")
            below = F.col("below")
        p[k] = stored(rows.select(F.col(f"g{k}").alias("g"), ((n - cut) / F.col("total") + F.col("rest") * below).alias("p")), f"model-{k}")
        rests[k] = stats.select("c", "rest")
    return p, rests, floor


def gram_scores(asked: DataFrame, model, order: int = ORDER) -> DataFrame:
    """(gram, bits): log2 probability of every gram of ``asked`` (the parts of grams): its own, or what its context leaves of the shorter
    gram's."""
    p, rests, floor = model
    below = None
    for k in range(1, order + 1):
        names = [f"g{k}", f"c{k}"] + ([f"g{k - 1}"] if k > 1 else [])
        rows = asked.select(*names).dropDuplicates([f"g{k}"])
        rows = rows.join(p[k].withColumnRenamed("g", f"g{k}"), f"g{k}", "left") \
                   .join(rests[k].withColumnRenamed("c", f"c{k}"), f"c{k}", "left")
        lower = F.lit(floor)
        if below is not None:
            rows, lower = rows.join(below, f"g{k - 1}"), F.col("below")
        value = F.coalesce("p", F.coalesce("rest", F.lit(1.0)) * lower)
        below = stored(rows.select(f"g{k}", value.alias("below")), f"scores-{k}")
    return below.select(F.col(f"g{order}").alias("gram"), F.log2("below").alias("bits"))


def train(docs: DataFrame, labels: DataFrame, order: int = ORDER):
    """The model of all trusted documents. The labels grow with the corpus, so the join is a merge
    join at every size."""
    trusted = docs.select("doc_id", "text").join(trusted_ids(labels).filter(~_apart()).hint("merge"), "doc_id")
    return kneser_ney(stored(gram_counts(trusted, order), "gram-counts"), order)


def perplexities(rows: DataFrame, model, order: int = ORDER) -> DataFrame:
    """``rows`` (numbers, and ``text``) without the text, with ``perplexity`` per character: null where there is no text. Rows may be equal."""
    bits = gram_scores(stored(_found(rows, order, False), "asked"), model, order)
    keys = [c for c in rows.columns if c != "text"]
    names = [f"k{i}" for i in range(len(keys))]

    def run(batches):
        row = TaskContext.get().partitionId() << 40
        for b in batches:
            at = 0
            for part in grouped(b.column("text").to_pylist(), BATCH_CHARS):
                owner, found, _ = grams(part, order)
                cut = np.searchsorted(owner, np.arange(len(part) + 1))
                each = [np.unique(found[order][i:j], return_counts=True) for i, j in zip(cut, cut[1:])]
                n = np.array([max(1, len(g)) for g, _ in each])     # a text without grams has one row as well
                which = np.repeat(np.arange(len(part)), n)
                first = np.append(True, which[1:] != which[:-1])
                none = np.repeat(np.array([len(g) == 0 for g, _ in each]), n)
                gram = np.concatenate([g if len(g) else np.zeros(1, np.int64) for g, _ in each])
                times = np.concatenate([t if len(t) else np.zeros(1, np.int64) for _, t in each])
                # the row's columns stand on its first gram
                held = pa.array(np.where(first, which, 0) + at, mask=~first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row + which), *(b.column(c).take(held) for c in names), pa.array(gram, mask=none), pa.array(times)],
                    ["row", *names, "gram", "times"])
                row, at = row + len(part), at + len(part)

    source = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keys, names)], F.col("text").cast("string").alias("text"))
    kinds = [source.schema[n].dataType.simpleString() for n in names]
    schema = ", ".join(["row long", *(f"{n} {t}" for n, t in zip(names, kinds)), "gram long", "times long"])
    scored = source.mapInArrow(tidy(run), schema).join(broadcast_within(bits, MAX_BROADCAST_GRAMS), "gram", "left")
    total = scored.groupBy("row").agg(*[F.max(n).alias(n) for n in names], F.sum("times").alias("chars"),
                                      F.sum(F.col("times") * F.col("bits")).alias("bits"))
    return total.select(*[F.col(n).alias(c) for n, c in zip(names, keys)], F.when(F.col("chars") > 0, F.pow(
        F.lit(2.0), -F.col("bits") / F.col("chars"))).alias("perplexity"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    good = F.min((F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) == 0))
    return labels.groupBy("doc_id").agg(good.alias("_good")).filter("_good").select("doc_id")


def _apart() -> Column:
    """Trusted documents that the model isn't trained on: the bands are made from them."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(FOLDS)) == 0


def _length_class(n: Column) -> Column:
    return F.floor(F.log2(F.greatest(n, F.lit(1)))).cast("int")


def _lang() -> Column:
    return F.coalesce(F.col("lang"), F.lit(""))


def bands(scored: DataFrame, labels: DataFrame) -> DataFrame:
    """(lang, length, low, high): accepted perplexities by language and length class, every class between the shortest and the
    longest of the language; '*' is for all languages. A row per language and class, made and kept in Spark.

    A class is pooled with its neighbours, one more on each side at a time, until ``MIN_TRUSTED`` documents are in it."""
    own = scored.filter(F.col("perplexity").isNotNull()).join(trusted_ids(labels), "doc_id")
    both = stored(own.select(F.explode(F.array(_lang(), F.lit("*"))).alias("lang"), "length", "perplexity",
                             F.when(_apart(), F.col("perplexity")).alias("unseen")), "trusted")
    n = both.groupBy("lang", "length").agg(F.count("unseen").alias("n"))
    spans = n.groupBy("lang").agg(F.min("length").alias("shortest"), F.max("length").alias("longest"), F.sum("n").alias("all"))
    # documents in a window of classes: running counts at its ends (a language has at most some thirty classes)
    classes_ = spans.select("lang", "shortest", "longest", "all", F.explode(F.sequence("shortest", "longest")).alias("length"))
    reach = F.explode(F.sequence(F.lit(0), F.col("longest") - F.col("shortest"))).alias("reach")
    windows = classes_.select("lang", "shortest", "longest", "all", "length", reach)
    held = windows.join(n.select("lang", F.col("length").alias("at"), "n"), "lang") \
                  .filter(F.abs(F.col("at") - F.col("length")) <= F.col("reach")) \
                  .groupBy("lang", "all", "length", "longest", "shortest", "reach").agg(F.sum("n").alias("held")) \
                  .filter((F.col("held") >= MIN_TRUSTED) | (F.col("reach") == F.col("longest") - F.col("shortest"))) \
                  .groupBy("lang", "all", "length").agg(F.min("reach").alias("reach"))
    pools = stored(held.select("lang", "all", "length", (F.col("length") - F.col("reach")).alias("first"),
                               (F.col("length") + F.col("reach")).alias("last")), "pools")
    # texts that the model has seen are mostly below the others: they widen the lower end
    low, high = (F.percentile_approx("perplexity", x, 10000) for x in (TAIL, 1 - TAIL))
    high = F.greatest(high, F.percentile_approx("unseen", 1 - TAIL, 10000))
    # a document stands in the few windows that reach its class; quantiles are gathered per window, by partial sketches
    found = both.join(pools.select("lang", "first", "last").distinct(), "lang") \
                .filter(F.col("length").between(F.col("first"), F.col("last"))) \
                .groupBy("lang", "first", "last").agg(low.alias("low"), high.alias("high"))
    wide = MARGIN * (F.col("high") - F.col("low"))
    banded = pools.join(found, ["lang", "first", "last"]).select(
        "lang", "all", "length", F.greatest(F.lit(0.0), F.col("low") - wide).alias("low"), (F.col("high") + wide).alias("high"))
    banded = stored(banded, "bands")
    # a language too small to tell gets what all languages are granted as well
    common = banded.filter("lang = '*'").select("length", F.col("low").alias("any_low"), F.col("high").alias("any_high"))
    small = F.col("all") < MIN_TRUSTED
    return stored(banded.join(common, "length", "left").select(
        "lang", "length", F.when(small, F.least("low", "any_low")).otherwise(F.col("low")).alias("low"),
        F.when(small, F.greatest("high", "any_high")).otherwise(F.col("high")).alias("high")), "bands")


def _judged(held: DataFrame, found: DataFrame) -> DataFrame:
    """``held`` (lang, length, perplexity, ...) with ``kept``: whether the perplexity is within its band. Below the shortest and
    beyond the longest class of a language, that class holds; a language without a band takes that of all languages."""
    spans = found.groupBy("lang").agg(F.min("length").alias("_first"), F.max("length").alias("_last"))
    named = spans.select(F.col("lang").alias("_of"), F.lit(True).alias("_known"))
    h = held.withColumn("_lang", _lang()).join(named, F.col("_lang") == F.col("_of"), "left") \
            .withColumn("_of", F.when(F.col("_known"), F.col("_lang")).otherwise(F.lit("*")))
    h = h.join(spans.withColumnRenamed("lang", "_of"), "_of", "left") \
         .withColumn("_at", F.greatest("_first", F.least("_last", "length")))
    b = found.select(F.col("lang").alias("_of"), F.col("length").alias("_at"), "low", "high")
    return h.join(b, ["_of", "_at"], "left") \
            .withColumn("kept", F.coalesce(F.col("perplexity").between(F.col("low"), F.col("high")), F.lit(True)))


def _scored(docs: DataFrame, labels: DataFrame, **more: Column) -> DataFrame:
    """doc_id, lang, length class, perplexity and the further numbers of every document. The language goes as a number through the sum over
    grams (a sum that carries text would have to be sorted) and is named again after it."""
    lang = F.col("lang").cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(lang).alias("_lang"),
                       _length_class(F.char_length("text")).alias("length"), *[c.alias(n) for n, c in more.items()], "text")
    names = stored(docs.select(lang.alias("lang")).distinct().select(F.xxhash64("lang").alias("_lang"), "lang"), "languages")
    return stored(perplexities(rows, train(docs, labels)).join(names, "_lang", "left").drop("_lang"), "perplexity")


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, lang, length class, perplexity, kept."""
    scored = _scored(docs, labels)
    return _judged(scored, bands(scored, labels)).select("doc_id", "lang", "length", "perplexity", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, columns as before. The verdict goes by language and text, so the rejected ones are told by
    these; they grow with the corpus, so the join is a merge join at every size."""
    same = {"_h1": F.xxhash64("text"), "_h2": F.xxhash64(F.lit("second"), F.col("text")), "_lang": F.struct(F.col("lang").cast("string"))}
    scored = _scored(docs, labels, h1=same["_h1"], h2=same["_h2"])
    gone = _judged(scored, bands(scored, labels)).filter(~F.col("kept")) \
        .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), F.struct("lang").alias("_lang")).distinct()
    held = docs.select(F.struct("*").alias("row"), *[c.alias(n) for n, c in same.items()])
    return held.join(gone.hint("merge"), list(same), "left_anti").select("row.*")
