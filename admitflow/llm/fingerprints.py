"""I-Match fingerprints: hashes of the terms that are neither too common nor too rare.

A term's document frequency is counted over the whole corpus, by class: a hash puts terms into a fixed number of classes,
so the lexicon is a bitmap of fixed size. At a million classes the rare terms that share a class stay far below the lower
end of the band. Of a document's terms those in the band are kept, sorted, and hashed: all of them, and the members of
each of several randomised parts of the lexicon. The parts are sparse, so that some survive an edit.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CLASSES = 1 << 20
# The band: share of documents that hold a term. At most (terms in a document / LEAST_SHARE) classes can be in it.
LEAST_SHARE = 0.002
MOST_SHARE = 0.2
LEAST_DOCUMENTS = 2
# Parts of the lexicon: for each size eight parts, each with one of so many terms, drawn by a hash of its own.
PART_SIZES = (32, 64, 128)
PARTS_EACH = 8
# Documents that are put in order within one task, and how many such runs there are at most.
RUN_ROWS = 2048
MAX_RUNS = 50_000

_BREAKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: Column) -> Column:
    """A text's different words in lower case."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), _BREAKS, -1), ""))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is named."""
    return F.transform(F.array(value), body)[0]


def _class(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(CLASSES)).cast("int")


def lexicon(docs: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> bytes:
    """One byte for each class of terms: 1 if it lies in the band. Counted over all documents."""
    texts = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    held = texts.select(F.explode(F.array_distinct(F.transform(terms_of(F.col("text")), _class))).alias("c"))
    total = docs.count()
    low, high = max(LEAST_DOCUMENTS, math.ceil(least * total)), max(most * total, LEAST_DOCUMENTS)
    band = held.groupBy("c").count().where(F.col("count").between(low, high))
    bits = bytearray(CLASSES)
    for row in band.select("c").collect():
        bits[row.c] = 1
    return bytes(bits)


def fingerprint(text: Column, bits: bytes) -> Column:
    """Hash of all kept terms, then of each part's, joined by dots; a part that holds none of them is empty.

    A text none of whose terms lie in the band keeps all its terms; one without terms is hashed as it is.
    """
    known, yes = F.lit(bytearray(bits)), F.lit(bytearray(b"\x01"))
    short = lambda terms, size: F.substring(F.md5(F.concat_ws(" ", terms).cast("binary")), 1, size)

    def part(members: Column, i: int) -> Column:
        own = F.filter(members, lambda m: m["part"] == i)
        return _let(own, lambda o: F.when(F.size(o) == 0, "").otherwise(short(o["term"], 8)))

    def parts(kept: Column, size: int) -> Column:
        drawn = F.transform(
            kept, lambda t: F.struct(t.alias("term"), F.pmod(F.xxhash64(t, F.lit(size)), F.lit(size)).alias("part"))
        )
        members = F.filter(drawn, lambda m: m["part"] < PARTS_EACH)
        return _let(members, lambda ms: F.concat_ws(".", *[part(ms, i) for i in range(PARTS_EACH)]))

    def hashed(kept: Column) -> Column:
        return _let(
            F.array_sort(kept), lambda ts: F.concat_ws(".", short(ts, 16), *[parts(ts, size) for size in PART_SIZES])
        )

    blank = F.concat(
        F.substring(F.md5(text.cast("binary")), 1, 16), F.lit("." * (len(PART_SIZES) * PARTS_EACH))
    )
    inside = lambda terms: F.filter(
        terms, lambda t: F.substring(known, _class(t) + 1, F.lit(1)) == yes
    )
    return _let(
        terms_of(text),
        lambda terms: F.when(F.size(terms) == 0, blank).otherwise(
            hashed(_let(inside(terms), lambda band: F.when(F.size(band) == 0, terms).otherwise(band)))
        ),
    )


def likeness(a: Column, b: Column) -> Column:
    """1 for equal fingerprints, else the share of equal hashes among the parts that are not empty in both."""
    pairs = F.filter(
        F.arrays_zip(F.split(a, r"\.", -1).alias("a"), F.split(b, r"\.", -1).alias("b")),
        lambda p: (p["a"] != "") | (p["b"] != ""),
    )
    equal = F.size(F.filter(pairs, lambda p: p["a"] == p["b"]))
    return F.when(a == b, 1.0).when(F.size(pairs) == 0, 0.0).otherwise(equal / F.size(pairs)).cast("double")


def _runs(rows: DataFrame, run_rows: int) -> Column:
    """Number of a row's run: runs follow each other in the order of doc_id and hold about ``run_rows`` rows.

    The borders are quantiles of the ids, so the run is a function of the id alone and no retry can move it.
    """
    found = rows.select("doc_id").groupBy().agg(F.count("doc_id").alias("n")).first()
    runs = min(max(1, math.ceil(found.n / run_rows)), MAX_RUNS)
    if runs == 1:
        return F.when(F.col("doc_id").isNull(), -1).otherwise(0)
    shares = [i / runs for i in range(1, runs)]
    borders = rows.select(F.percentile_approx("doc_id", shares, 10 * runs).alias("b")).first().b
    borders = sorted(set(borders))
    width = math.isqrt(len(borders)) + 1
    rows_of = [borders[i : i + width] for i in range(0, len(borders), width)]
    firsts = F.from_json(F.lit(json.dumps([r[0] for r in rows_of])), "array<bigint>")
    table = F.from_json(F.lit(json.dumps(rows_of)), "array<array<bigint>>")
    below = lambda values: F.size(F.filter(values, lambda b: b <= F.col("doc_id")))
    coarse = below(firsts)
    fine = F.when(coarse == 0, 0).otherwise((coarse - 1) * width + below(F.get(table, coarse - 1)))
    return F.when(F.col("doc_id").isNull(), -1).otherwise(fine).cast("int")


def _with_followers(docs: DataFrame, run_rows: int) -> DataFrame:
    """(doc_id, text, tie, run, extra) with one extra row at the end of each run: what follows it, by falling doc_id."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    run = _runs(rows, run_rows)
    rows = rows.select("doc_id", "text", F.xxhash64("text").alias("tie"), run.alias("run"))
    first = rows.groupBy("run").agg(F.max(F.struct("doc_id", "tie")).alias("f"))
    heads = sorted(((r.run, r.f.doc_id, r.f.tie) for r in first.collect()), reverse=True)  # a row per run
    follows = [(before[0], *after[1:]) for before, after in zip(heads, heads[1:] + heads[:1])]
    names = "run int, doc_id long, tie long"
    wanted = docs.sparkSession.createDataFrame(follows, names)
    # The head of a run, once for each run that it follows. Rows that agree in id and tie are the same text.
    same = (F.col("a.tie") == F.col("w.tie")) & F.col("a.doc_id").eqNullSafe(F.col("w.doc_id"))
    extra = (
        rows.alias("a")
        .join(F.broadcast(wanted.alias("w")), same)
        .groupBy("w.run", "a.doc_id", "a.tie")
        .agg(F.min("a.text").alias("text"))
        .select("doc_id", "text", "tie", "run", F.lit(True).alias("extra"))
    )
    return rows.withColumn("extra", F.lit(False)).unionByName(extra)


def scan(spark: SparkSession, docs: DataFrame, run_rows: int = RUN_ROWS) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document has the next smaller id, the first after the last; null ids come last, equal ids go by a hash of
    the text. A single document follows itself. A null text is empty; texts are read whole. Other columns are not read
    and an empty table gives none.
    """
    bits = lexicon(docs)
    order = Window.partitionBy("run").orderBy("extra", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    rows = _with_followers(docs, run_rows).withColumn("next_text", F.lead("text").over(order))
    size = F.char_length("text")
    cut = F.floor(size / 3).cast("int")
    edited = F.concat(
        F.substring(F.col("text"), F.lit(1), size - cut),
        F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), cut),
    )
    rows = rows.withColumn("edited", F.when(~F.col("extra"), edited).otherwise(F.lit("")))
    rows = rows.select(
        "run",
        "extra",
        "doc_id",
        "tie",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("text"), bits).alias("fingerprint"),
        fingerprint(F.col("edited"), bits).alias("edited_fingerprint"),
    )
    rows = rows.withColumn("next", F.lead("fingerprint").over(order)).where(~F.col("extra"))
    return rows.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
